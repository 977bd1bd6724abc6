"""Column expressions that clean identifiers, quantities, dates and text."""
