"""Releases, the ledger of files, digests in stretches, row positions and heavy plates."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_failed_check_leaves_the_former_release(spark, tmp_path):
    from kilotrace.sources.releases import Releases

    r = Releases(spark, f"file://{tmp_path}/salida")
    assert r.current() is None
    first = r.stage()
    spark.range(3).write.parquet(first)
    r.publish(first, [("rows", lambda: spark.read.parquet(first).count() == 3)], note="one")
    assert r.current()["path"] == first and r.current()["note"] == "one"
    bad = r.stage()
    spark.range(9).write.parquet(bad)
    with pytest.raises(ValueError, match="too many, never"):
        r.publish(bad, [("fine", lambda: True), ("too many", lambda: spark.read.parquet(bad).count() < 5), ("never", lambda: False)])
    assert r.current()["path"] == first and spark.read.parquet(first).count() == 3 and not os.path.exists(bad.removeprefix("file://"))
    second = r.stage()
    spark.range(4).write.parquet(second)
    assert r.publish(second, [])["number"] == 2 and r.current()["path"] == second
    left = r.stage()
    spark.range(1).write.parquet(left)  # never published
    r.prune()
    assert r.current()["path"] == second and spark.read.parquet(second).count() == 4
    assert [f for f in os.listdir(f"{tmp_path}/salida") if f.startswith("release")] == [second.rsplit("/", 1)[1]]


def test_export_shows_nothing_that_fails(spark, tmp_path):
    from kilotrace.queries.files import exported
    from kilotrace.sources.releases import Releases

    r = Releases(spark, f"file://{tmp_path}/salida")
    alerts = spark.createDataFrame([("a", "S1", 1.0), ("b", "S1", 2.0)], "id_alerta string, senal string, puntaje double")

    def write(dossier, scores=alerts):
        path = r.stage()
        alerts.write.option("header", True).csv(f"{path}/alertas")
        alerts.groupBy("senal").count().write.json(f"{path}/resumen")
        scores.write.parquet(f"{path}/puntajes")
        dossier.write.option("header", True).csv(f"{path}/expediente_ciego")
        return path

    good = write(alerts.select("id_alerta", "senal"))
    r.publish(good, exported(spark, good, alerts))
    for path in (write(alerts), write(alerts.select("id_alerta"), alerts.limit(1)), write(alerts.select("id_alerta").union(alerts.select("id_alerta"))), write(alerts.select(F.lit("x").alias("id_alerta")))):
        with pytest.raises(ValueError, match="not published"):
            r.publish(path, exported(spark, path, alerts))
        assert r.current()["path"] == good


def test_signals_that_share_an_identifier(spark, tmp_path):
    """Two signals' alerts of one identifier both count, as in the SQL; the identifier has one score."""
    from kilotrace.queries.files import exported, outputs, write_alerts

    path = f"file://{tmp_path}/salida"
    lines = spark.createDataFrame([("a", "S10", 0.2), ("a", "S5", 1.5), ("a", "S5", 1.2), ("b", "S5", 1.1)], "id_alerta string, senal string, puntaje double")
    write_alerts(lines, path)
    lines.select("id_alerta").distinct().write.option("header", True).csv(f"{path}/expediente_ciego")
    assert all(check() for _, check in exported(spark, path, lines))
    assert rows_of(spark.read.parquet(f"{path}/puntajes").select("id_alerta", "puntaje")) == [("a", 1.5), ("b", 1.1)]
    assert {(x.salida, x.senal): x.filas for x in outputs(spark, path).collect()} == {
        ("alertas", "S10"): 1, ("alertas", "S5"): 2, ("resumen", "S10"): 1, ("resumen", "S5"): 2, ("expediente_ciego", None): 2, ("puntajes", None): 2,
    }


def test_compaction_of_a_larger_table(spark, tmp_path):
    """Files of more sales than 64 files of the wanted size hold are still fewer than the small ones they come of."""
    from kilotrace.queries.files import compact_files

    spark.range(1).selectExpr("id AS p_partkey", "'p' AS p_type").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(1).selectExpr("id AS o_orderkey", "id AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1_600_000).selectExpr(
        "id AS l_orderkey", "0L AS l_partkey", "id % 1000 AS l_suppkey", "CAST(id % 7 AS int) AS l_linenumber", "CAST(id % 50 AS double) AS l_quantity", "1.0D AS l_extendedprice", "0.0D AS l_tax",
        "'A' AS l_returnflag", "'F' AS l_linestatus", "timestamp_seconds(800000000 + id % 2500 * 86400) AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert compact_files(spark, str(tmp_path)).first().asDict() == {"filas": 1_600_000, "kg": 39_200_000.0, "menos_archivos": True, "cerca_del_tamano": True}


def test_ledger_follows_its_folder(spark, tmp_path):
    """Files that come, come again, change, are emptied, are repeated and go: the rows are those of what is there."""
    from kilotrace.streaming.ingest import Ledger

    schema, source = StructType.fromDDL("k int, v string"), f"{tmp_path}/bronze"
    os.makedirs(source)
    ledger = Ledger(spark, f"file://{tmp_path}/silver")

    def put(name, *lines):
        with open(f"{source}/{name}", "w") as f:
            f.write("k,v\n" + "".join(f"{x}\n" for x in lines))

    def sync():
        return ledger.sync(f"file://{source}", schema, lambda b: b.filter("v <> 'drop'"), "csv", header=True)

    have = lambda: rows_of(ledger.rows(schema).select("k", "v"))
    assert have() == []
    put("a.csv", "1,x", "2,y", "3,drop")
    put("b.csv", "4,z")
    assert sync() == {"nuevos": 2, "cambiados": 0, "retirados": 0, "iguales": 0} and have() == [(1, "x"), (2, "y"), (4, "z")]
    assert sync() == {"nuevos": 0, "cambiados": 0, "retirados": 0, "iguales": 2} and len(have()) == 3
    put("a.csv", "1,other")
    put("c.csv", "4,z")  # b's content under another name is another file
    assert sync() == {"nuevos": 1, "cambiados": 1, "retirados": 0, "iguales": 1} and have() == [(1, "other"), (4, "z"), (4, "z")]
    put("a.csv", "9,drop")  # read again without a row
    assert sync()["cambiados"] == 1 and have() == [(4, "z"), (4, "z")]
    assert {r.ruta.rsplit("/", 1)[1]: r.filas for r in ledger.files().collect()} == {"a.csv": 0, "b.csv": 1, "c.csv": 1}
    os.remove(f"{source}/b.csv")
    assert sync()["retirados"] == 1 and have() == [(4, "z")]
    ledger.vacuum()
    assert have() == [(4, "z")] and len([x for x in os.listdir(f"{tmp_path}/silver/data") if x.startswith("origen")]) == 1


def test_batch_that_fails_counts_for_nothing(spark, tmp_path):
    from kilotrace.streaming.ingest import Ledger

    schema, source = StructType.fromDDL("k int"), f"{tmp_path}/bronze"
    ledger = Ledger(spark, f"file://{tmp_path}/silver")
    spark.range(5).selectExpr("CAST(id AS int) AS k").write.parquet(source)
    ledger.sync(f"file://{source}", schema, lambda b: b)
    spark.range(5, 9).selectExpr("CAST(id AS int) AS k").write.mode("append").parquet(source)
    publish = ledger.releases.publish
    ledger.releases.publish = lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost"))  # rows are written, the ledger is not
    with pytest.raises(RuntimeError):
        ledger.sync(f"file://{source}", schema, lambda b: b)
    assert rows_of(ledger.rows(schema).select("k")) == [(i,) for i in range(5)]
    ledger.releases.publish = publish
    ledger.sync(f"file://{source}", schema, lambda b: b)
    assert rows_of(ledger.rows(schema).select("k")) == [(i,) for i in range(9)]


def test_digests_in_stretches(spark, tmp_path):
    from kilotrace.sources.lake import digests

    r, want = os.urandom(3_000_000), {}
    for name, data in (("small.bin", b"abc"), ("large one.bin", r), ("more.gz", r[:2_000_000])):
        (tmp_path / name).write_bytes(data)
        want[name] = (len(data), hashlib.sha256(data).hexdigest())
    got = {x.ruta.rsplit("/", 1)[1].replace("%20", " "): (x.bytes, x.sha256) for x in digests(spark, f"file://{tmp_path}", whole=1_000_000).collect()}
    assert got == want


def test_digest_of_a_file_beyond_two_gigabytes(spark, tmp_path):
    from kilotrace.sources.lake import digests

    size, zeros, h = (2 << 30) + 12345, bytes(8 << 20), hashlib.sha256()
    with open(tmp_path / "huge.bin", "wb") as f:
        f.truncate(size)  # no blocks are used
    left = size
    while left:
        h.update(zeros[: min(left, len(zeros))])
        left -= min(left, len(zeros))
    assert [(x.bytes, x.sha256) for x in digests(spark, f"file://{tmp_path}").collect()] == [(size, h.hexdigest())]


def test_positions_in_files(spark, tmp_path):
    """Places in files of several blocks, against the lines as they stand."""
    from kilotrace.sources.lake import positions

    for name, n in (("a.csv", 5000), ("b.csv", 1), ("c.csv", 0)):
        (tmp_path / name).write_text("k,v\n" + "".join(f"{name[0]}{i},{'x' * (i % 50)}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = positions(spark.read.schema("k string, v string").option("header", True).csv(f"file://{tmp_path}"), first=2)
        assert found.columns == ["k", "v", "archivo", "fila"]
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((x.archivo.rsplit("/", 1)[1][0], x.fila, x.k) for x in rows) == sorted([("a", i + 2, f"a{i}") for i in range(5000)] + [("b", 2, "b0")])


def moves(spark, rows):
    return spark.createDataFrame(rows, "placa_norm string, fecha string, id_producto string, anio int, mes int, documento string, linea int, kg_comprados double, kg_despachados double, kg_vendidos double")


def test_heavy_plates_alone_are_salted(spark):
    from kilotrace.operators.gold import heavy_plates, salted_sums, sums

    even = moves(spark, [(f"p{i % 500}", "d", "g", 2020, 1, str(i), 0, 1.0, 1.0, None) for i in range(3000)])
    assert heavy_plates(even) == [] and salted_sums(even)._jdf.queryExecution().toString().count("Aggregate") == sums(even)._jdf.queryExecution().toString().count("Aggregate")
    rows = [("hot" if i % 2 else f"p{i % 97}" if i % 3 else None, f"d{i % 5}", "g", 2020, 1, str(i), 0, float(i % 7), 1.0, None if i % 11 else 2.0) for i in range(3000)]
    hot = moves(spark, rows)
    assert set(heavy_plates(hot)) == {"hot", None}
    assert sorted(map(str, salted_sums(hot).collect())) == sorted(map(str, sums(hot).collect()))
    assert "sal" in salted_sums(hot)._jdf.queryExecution().toString()
    assert heavy_plates(even.limit(0)) == []


def test_no_tables_are_left(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no tables")
    from kilotrace.queries.files import external_tables

    before = {t.name for t in spark.catalog.listTables()}
    assert external_tables(spark, "/root/testdata/sf0.001").count() == 8
    assert {t.name for t in spark.catalog.listTables()} == before


def test_owner_deletes_what_was_made(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no tables")
    from kilotrace.queries import QUERIES
    from kilotrace.sources.lake import Owner, once

    with Owner(spark) as outer:
        kept = once(spark.range(3).toDF("k"), "fuera")
        with Owner(spark) as inner:
            rows = QUERIES["write_per_source"](spark, "/root/testdata/sf0.001").collect()
        assert rows and inner.paths and not any(os.path.exists(p.removeprefix("file://")) for p in inner.paths)
        assert kept.count() == 3 and len(outer.paths) == 1
    assert not os.path.exists(outer.paths[0].removeprefix("file://"))


def test_windows_of_a_stream(spark, tmp_path):
    """Windows go on over batches; a batch that is repeated changes nothing; rows later than the watermark are left out."""
    from kilotrace.streaming.ingest import present_windows, stream_windows

    base = f"file://{tmp_path}"
    put = lambda *rows: spark.createDataFrame(list(rows), "t string, event_type string, value double").selectExpr("CAST(t AS timestamp) AS ts", "event_type", "value").coalesce(1).write.mode("append").parquet(f"{base}/in")
    schema = StructType.fromDDL("ts timestamp, event_type string, value double")
    run = lambda: stream_windows(spark, f"{base}/in", schema, f"{base}/out", f"{base}/state")
    put(("2024-01-01 10:05:00", "a", 1.0), ("2024-01-01 10:40:00", "a", 2.0), ("2024-01-01 10:50:00", "b", 4.0))
    run()
    put(("2024-01-01 10:55:00", "a", 8.0), ("2024-01-01 13:00:00", "a", 16.0))
    run()
    run()  # nothing has come
    put(("2024-01-01 10:59:00", "a", 32.0), ("2024-01-01 12:55:00", "a", 64.0))  # the first is hours late, the second within ten minutes
    run()
    got = {(str(x.desde)[11:13], x.event_type): (x.n, x.suma) for x in present_windows(spark, f"{base}/out").collect()}
    assert got == {("10", "a"): (3, 11.0), ("10", "b"): (1, 4.0), ("12", "a"): (1, 64.0), ("13", "a"): (1, 16.0)}
