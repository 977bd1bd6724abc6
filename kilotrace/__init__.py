"""Reconciliation, rules and anomaly scores over purchases and sales, as Spark jobs."""
