"""Reconciliation, cleaning, rules and scores on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kilotrace.functions import clean as C
from kilotrace.operators import gold as G
from kilotrace.operators import quality as Q
from kilotrace.operators import score as K
from kilotrace.operators import signals as S


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    out = f(F.col("c"))
    cols = out if isinstance(out, tuple) else (out,)
    rows = df.select("i", *[c.alias(f"x{k}") for k, c in enumerate(cols)]).orderBy("i").collect()
    return [tuple(r)[1:] if len(cols) > 1 else r.x0 for r in rows]


def test_plates(spark):
    assert column(spark, ["t1a-123 15/07/2023", " T1A123 ", "T1A12", None], C.plate) == [("T1A123", "15/07/2023"), ("T1A123", None), (None, None), (None, None)]
    assert column(spark, ["T2N - 841 CAMION", "B2E-983 (24/7/23)", "PLANTA", "#N/A", "C1D 555 PICK UP"], C.plate6) == [("T2N841", None, None), ("B2E983", "24/7/23", None), (None, None, "PLANTA"), (None, None, None), ("C1D555", None, None)]


def test_documents(spark):
    assert column(spark, ["20100070970", "20100070971", "123.0", "", None, "123456789"], C.document) == [("20100070970", "RUC"), ("20100070971", "INVALIDO"), ("00000123", "DNI"), (None, "VACIO"), (None, "VACIO"), ("123456789", "INVALIDO")]
    assert column(spark, ["1234567", "123456789"], C.dni) == ["01234567", None]


def test_quantities(spark):
    assert column(spark, ["5 000 kg", "1,250.5", "12,5", "1,250", "FALSO", "", None, "1e3", "x"], C.to_kg) == [5000.0, 1250.5, 12.5, 1250.0, None, None, None, 13.0, None]
    assert column(spark, ["1e3", "12,5"], C.number_or_kg) == [1000.0, 12.5]
    assert column(spark, ["GLP 10 KG", "BL45", "GLP ENVASE DE 10 KLG", "GRANEL", "115 KG"], C.package_kg) == [10.0, 45.0, 10.0, None, None]
    assert column(spark, ["sí", "VENCIDO", "quizá", None], C.to_bool) == [True, False, None, None]


def test_dates(spark):
    d = dt.date
    assert column(spark, ["15/07/2023", "1/2/23", "1/2/70", "2020-01-31 10:00:00", "31/02/2020", "44607", "01.02.2020"], lambda c: C.to_date(F.lit("s"), c)) == [d(2023, 7, 15), d(2023, 2, 1), d(1970, 2, 1), d(2020, 1, 31), None, None, d(2020, 2, 1)]
    assert column(spark, ["44607", "5"], lambda c: C.to_date(F.lit("n"), c)) == [d(2022, 2, 15), None]
    assert column(spark, ["Setiembre", "SET", "09", "13", "ma", "mar", None], C.month_number) == [9, 9, 9, None, None, 3, None]


def movements(spark, rows):
    return spark.createDataFrame(rows, "placa_norm string, fecha date, id_producto string, anio int, mes int, kg_comprados double, kg_despachados double, kg_vendidos double, documento string, linea int")


def test_reconciliation(spark):
    d = dt.date(2020, 1, 2)
    mov = movements(spark, [("A", d, "P", 2020, 1, 10.0, 10.0, 0.0, "1", 0), ("A", d, "P", 2020, 1, None, 0.0, 4.0, "2", 1), (None, d, "P", 2020, 1, 1.0, 1.0, 0.0, "3", 0)])
    fleet = spark.createDataFrame([("A", 30.0, True)], "placa_norm string, capacidad_kg double, habilitada boolean")
    got = {r.placa_norm: r for r in G.reconcile(mov, fleet).collect()}
    assert (got["A"].kg_diferencia, got["A"].pct_diferencia, got["A"].capacidad_kg, got["A"].n_operaciones) == (6.0, 0.6, 30.0, 2)
    assert got[None].kg_comprados == 1.0  # kilos are conserved
    assert sorted(map(str, G.reconcile(mov, fleet, salts=4).collect())) == sorted(map(str, got.values()))
    plan = G.reconcile(mov, fleet, years=[2020])._jdf.queryExecution().toString()
    assert "partial_sum" in plan and "CartesianProduct" not in plan


def test_pruning(spark, tmp_path):
    from kilotrace.sources import lake as L

    df = spark.range(100).select(F.col("id").alias("kg"), (2019 + F.col("id") % 3).cast("int").alias("anio"), (1 + F.col("id") % 2).cast("int").alias("mes"))
    path = f"{tmp_path}/t"
    L.write_partitioned(df, path)
    L.write_partitioned(df.filter("anio = 2020"), path)
    assert spark.read.parquet(path).count() == 100
    one = L.read_table(spark, path, df.schema, F.col("anio") == 2020)
    assert one.count() == 33 and "PartitionFilters: [isnotnull(anio" in one._jdf.queryExecution().toString()
    assert L.read_table(spark, f"{tmp_path}/none", df.schema).count() == 0
    assert L.regenerate(spark, path, df, 2020, 1, "kg")


def test_joins(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert {r.v for r in G.anti(left, right, ["k"]).collect()} == {2, 3}
    assert [r.v for r in G.semi(left, right, ["k"]).collect()] == [1]
    with pytest.raises(ValueError):
        G.many_to_one(left, right, ["k"])
    buys = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 1),), (None,)], "fecha date")
    rates = spark.createDataFrame([(dt.date(2024, 1, 5), 3.7), (dt.date(2024, 1, 3), 3.6)], "fecha date, tc_oficial double")
    assert {r.fecha: r.tc_oficial for r in G.as_of(buys, rates).collect()} == {dt.date(2024, 1, 6): 3.7, dt.date(2024, 1, 1): None, None: None}


def test_scores(spark):
    rows = [(f"u{i}", "reparto", 100.0 + i % 7, 0.0, 50.0) for i in range(60)] + [("x", "reparto", 100.0, 0.0, 5000.0), ("z", "reparto", 0.0, 0.0, 9.0), ("t", "transporte", 0.0, 10.0, 5.0)]
    um = spark.createDataFrame(rows, "unidad_id string, rol string, kg_vendidos double, kg_transportados double, gasto_combustible double")
    got = {r.unidad_id: r for r in K.mad_score(um).collect()}
    assert [u for u, r in got.items() if r.alerta_base] == ["x"]
    assert got["z"].estado_puntaje == "sin_combustible_o_volumen_positivo" and got["t"].estado_puntaje == "mad_cero_o_sin_grupo_evaluable"
    ties = spark.createDataFrame([("s", 1.0), ("s", 1.0), ("s", 2.0)], "senal string, puntaje double")
    assert sorted(r.percentil for r in K.average_percentile(ties, "puntaje", "senal").collect()) == [0.5, 0.5, 1.0]


def test_rules(spark):
    c = spark.createDataFrame([("1", dt.date(2020, 1, 2), 5.0, None), ("2", dt.date(2020, 1, 3), 6.0, "S"), ("3", dt.date(2020, 1, 3), 6.0, "S "), ("4", dt.date(2019, 1, 3), 6.0, "S"), ("5", dt.date(2020, 2, 3), 6.0, "T")], "factura_id string, fecha date, kg double, codigo_scop string")
    got = {r.factura_id: r for r in S.s2(c, F.year("fecha") == 2020).collect()}
    assert set(got) == {"1", "2", "3"} and got["1"].motivo == "compra_sin_scop" and got["2"].motivo == "scop_repetido"
    import hashlib
    import json

    keys = ["S2", "regla", "factura", "2020-01-02 00:00:00", None, "1", "compra_sin_scop"]
    assert got["1"].id_alerta == hashlib.sha256(json.dumps(keys, ensure_ascii=False).encode()).hexdigest()[:24]
    good, bad = Q.split_rejects(c, [("tarde", F.col("fecha") >= "2020-01-01"), ("poco", F.col("kg") > 5)])
    assert {r.factura_id: r.motivo for r in bad.collect()} == {"4": "tarde", "1": "poco"} and good.count() == 3
    assert Q.first_of(c, ["codigo_scop"], ["factura_id"]).filter("unico").count() == 4


def test_empty_tables(spark):
    d = dt.date(2020, 1, 2)
    mov = movements(spark, [("A", d, "P", 2020, 1, 10.0, 10.0, 0.0, "1", 0)]).limit(0)
    fleet = spark.createDataFrame([], "placa_norm string, capacidad_kg double, habilitada boolean")
    assert G.reconcile(mov, fleet).count() == 0 and G.month_base(G.reconcile(mov, fleet)).count() == 0


def test_entry_without_subpackage(monkeypatch):
    import __spark_entry__ as entry

    whole, real = entry.queries(), entry.find_spec
    monkeypatch.setattr(entry, "find_spec", lambda name: None if name in ("kilotrace.llm", "corpus_pipeline") else real(name))
    part = entry.queries()
    assert "conciliacion" in part and not any(n.startswith("op") and n[2].isdigit() for n in part) and len(part) < len(whole) + 1
    assert set(entry.oracle_sql()) <= set(part)


def test_files_and_rows_a_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), (None, 4), ("b", 3)], "k string, o int")
    assert sorted((r.k or "", r.o) for r in Q.first_rows(df, ["k"], ["o"]).collect()) == [("", 4), ("a", 1), ("b", 3)]
    assert sorted(r.k or "" for r in Q.repeats(df, ["k"]).collect()) == ["", "a"]
    plan = Q.first_rows(df, ["k"], ["o"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan  # ranks are limited before the shuffle


def test_input_conditions(spark):
    rows = [("u1", "2020", "1", "reparto", "true", "2020-01-05"), ("u1", "2020", "1", "reparto", None, "2020-02-31"), (" ", "20.5", "13", "otro", "quizá", "2020-01-05"), (None, "1800", "2", "transporte", "False", None)]
    df = spark.createDataFrame(rows, "unidad_id string, anio string, mes string, rol string, habilitada string, fecha string")
    options = {"roles": "rol", "dates": ("fecha",), "whole": ("anio", "mes"), "flags": ("habilitada",)}
    got = Q.violations(df, ["unidad_id", "anio", "mes"], ["unidad_id"], **options).first().asDict()
    assert got == {"claves_nulas": 1, "claves_repetidas": 1, "identificadores_vacios": 2, "fechas_invalidas": 2, "no_enteros": 1, "banderas_invalidas": 1, "meses_invalidos": 1, "anios_invalidos": 2, "roles_invalidos": 1}
    with pytest.raises(ValueError, match="claves_nulas"):
        Q.validated(df, ["unidad_id", "anio", "mes", "rol"], [], ["unidad_id", "anio", "mes"], ["unidad_id"])
    with pytest.raises(ValueError, match="columns missing"):
        Q.validated(df, ["kg"], [], ["unidad_id"], [])
    good = Q.validated(df.limit(1), ["unidad_id", "anio", "mes", "rol"], ["habilitada", "capacidad"], ["unidad_id", "anio", "mes"], ["unidad_id"], **{**options, "dates": ()})
    assert good.columns == ["unidad_id", "anio", "mes", "rol", "habilitada"] and good.count() == 1


def test_measures_clean_each_cell_once(spark):
    """Measures of rows counted by their cells are those of the rows, and a cell that many rows have is cleaned once."""
    from kilotrace.operators import silver as V

    kilos, units = ["5 000 kg", "1,250.5", "12,5", "1,250", "-3", "0", "FALSE", "x", "", None, "9" * 400, "7."], ["kg", "galones", "UNIDAD", "caja", None]
    details = [(f"{i % 31 + 1}/02/2020", ("T1A-001 camion", "planta sur", None)[i % 3], ("GLP 10 KG", "arroz 5 kg", "glp granel", None)[i % 4], units[i % 5], kilos[i % 7], kilos[i * 5 % 12]) for i in range(3000)]
    raw = spark.createDataFrame(details, "fecha string, proyecto string, articulo string, unidad_medida string, cantidad string, kg string").withColumns({"cliente_codigo": F.lit("c"), "vendedor": F.lit("v")})
    months = spark.createDataFrame([(2020, ("Enero", "set", "13", None)[i % 4], ("T1A-001", "planta", None)[i % 3], kilos[i % 12] if i % 12 != 10 else "4") for i in range(3000)], "_anio int, mes_texto string, proyecto string, kg string").withColumn("vendedor", F.lit("v"))
    for name, table, made, most in (("ventas_detalle", raw, lambda t: V.sale_details(t, "s"), 420), ("ventas_unidad_mes", months, lambda t: V.unit_months(t, "s"), 40)):
        seen = []
        got = V.cell_measures(name, table, lambda t, made=made, seen=seen: seen.append(t.count()) or made(t))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, V.measures(name, made(table)).collect()))
        assert max(seen) <= most < table.count()
    none = V.cell_measures("ventas_unidad_mes", months.limit(0), lambda t: V.unit_months(t, "s"))
    assert {x.valor for x in none.collect()} == {0.0}
