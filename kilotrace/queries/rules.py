"""Queries of the rule signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from kilotrace.operators import signals as S
from kilotrace.queries.gold import rounded
from kilotrace.queries.registry import query
from kilotrace.sources.domain import PILOT, table

P = PILOT


def alert_sql(signal: str, plate: str, source: str, score: str = "1e0") -> str:
    return f"""SELECT substr(md5(concat_ws('|', '{signal}', documento, coalesce({plate}, 'None'))), 1, 12) AS id_alerta, '{signal}' AS senal, 'regla' AS tipo, fecha,
      {plate} AS placa_norm, documento, kg, kg * 2.1 AS valor_soles, round({score}, 6) AS puntaje, '{S.CATALOGUE[signal][1]}' AS grado_evidencia, 'pendiente' AS estado_revision, anio, mes FROM {source}"""


V2 = {
    "S1": alert_sql("S1", "placa_cargada", "compras WHERE flag_placa_divergente"),
    "S4": alert_sql("S4", "placa_cargada", "compras JOIN flota f ON placa_cargada = f.placa_norm WHERE kg > capacidad_kg", "kg / capacidad_kg"),
    "S5": alert_sql("S5", "placa_norm", "ventas JOIN (SELECT card_code, capacidad_kg AS cap FROM maestro) m USING (card_code) WHERE kg > cap", "kg / cap"),
    "S7": alert_sql("S7", "placa_cargada", "compras WHERE placa_cargada NOT IN (SELECT placa_norm FROM flota WHERE habilitada)"),
    "S8": alert_sql("S8", "placa_norm", "ventas WHERE codigo_scop IS NOT NULL AND codigo_scop NOT IN (SELECT codigo_scop FROM compras WHERE codigo_scop IS NOT NULL)"),
    "S10": alert_sql("S10", "placa_norm", "(SELECT *, median(precio) OVER (PARTITION BY canal, id_producto, anio, mes) AS mediana FROM ventas) WHERE precio < mediana * 0.9", "1 - precio / mediana"),
}
V2_ALL = " UNION ALL ".join(V2.values())


def _v2(spark, sf_dir):
    return {n: table(spark, sf_dir, n) for n in ("compras", "ventas", "flota", "maestro")}


def all_v2(spark, sf_dir):
    t = _v2(spark, sf_dir)
    return S.all_v2(t["compras"], t["ventas"], t["flota"], t["maestro"])


SCORED = {"puntaje": 6}


@query("s1_plate_divergence", V2["S1"])
def s1_plate_divergence(spark, sf_dir):
    return rounded(S.s1(table(spark, sf_dir, "compras")), SCORED)


@query("s4_over_capacity", V2["S4"])
def s4_over_capacity(spark, sf_dir):
    return rounded(S.s4(table(spark, sf_dir, "compras"), table(spark, sf_dir, "flota")), SCORED)


@query("s5_over_local_capacity", V2["S5"])
def s5_over_local_capacity(spark, sf_dir):
    return rounded(S.s5(table(spark, sf_dir, "ventas"), table(spark, sf_dir, "maestro")), SCORED)


@query("s7_v2_not_enabled", V2["S7"])
def s7_v2_not_enabled(spark, sf_dir):
    return rounded(S.s7(table(spark, sf_dir, "compras"), table(spark, sf_dir, "flota")), SCORED)


@query("s8_sale_without_purchase", V2["S8"])
def s8_sale_without_purchase(spark, sf_dir):
    return rounded(S.s8(table(spark, sf_dir, "ventas"), table(spark, sf_dir, "compras")), SCORED)


@query("s10_below_median", V2["S10"])
def s10_below_median(spark, sf_dir):
    return rounded(S.s10(table(spark, sf_dir, "ventas")), SCORED)


@query("all_signals_v2", V2_ALL)
def all_signals_v2(spark, sf_dir):
    return rounded(all_v2(spark, sf_dir), SCORED)


@query("alert_v2", f"SELECT id_alerta, senal, documento, placa_norm, count(*) AS lineas FROM ({V2_ALL}) GROUP BY ALL")
def alert_v2(spark, sf_dir):
    return all_v2(spark, sf_dir).groupBy("id_alerta", "senal", "documento", "placa_norm").agg(F.count("*").alias("lineas"))


@query("signal_summary_v2", "SELECT senal, count(*) AS alertas, sum(kg) AS kg, count(DISTINCT placa_norm) AS unidades, CASE senal WHEN 'S10' THEN 'H4' ELSE 'H1' END AS hipotesis, CASE senal "
    + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in S.CATALOGUE.items()) + f" END AS descripcion FROM ({V2_ALL}) GROUP BY senal")
def signal_summary_v2(spark, sf_dir):
    return S.summary(all_v2(spark, sf_dir))


# the newer rules

WIDE = f"(year(fecha) = {P} OR fecha BETWEEN DATE '{P + 1}-02-01' AND DATE '{P + 2}-08-31')"
LATE = f"fecha BETWEEN DATE '{P + 1}-02-01' AND DATE '{P + 2}-08-31'"
OCTOBER = f"fecha BETWEEN DATE '{P - 1}-10-01' AND DATE '{P - 1}-10-31'"
YEAR = f"anio = {P}"


def emit_sql(signal: str, source: str, reason: str, score: str = "1e0", kind: str = "'regla'", kg: str = "kg", bill: bool = True, unit: bool = True, value: str = "CAST(NULL AS DOUBLE)", date: str = "fecha", role: bool = False) -> str:
    res, grade, sources = (S.RULES | S.PENDING)[signal]
    unit_key = "concat('\"', unidad_id, '\"')" if unit else "'null'"
    bill_key = "concat('\"', factura_id, '\"')" if bill else "'null'"
    return f"""SELECT substr(sha256(concat('["{signal}", "', tipo_, '", "{res}", "', CAST({date} AS string), ' 00:00:00", ', {unit_key}, ', ', {bill_key}, ', "', motivo_, '"]')), 1, 24) AS id_alerta,
      '{signal}' AS senal, tipo_ AS tipo, '{res}' AS resolucion, {date} AS fecha, {'unidad_id' if unit else 'CAST(NULL AS VARCHAR)'} AS unidad_id, {'rol' if role else 'CAST(NULL AS VARCHAR)'} AS rol, {'factura_id' if bill else 'CAST(NULL AS VARCHAR)'} AS factura_id,
      {'codigo_scop' if bill and unit else 'CAST(NULL AS VARCHAR)'} AS codigo_scop, {kg} AS kg, {value} AS valor_soles, round({score}, 6) AS puntaje, '{grade}' AS grado_evidencia, 'pendiente' AS estado_revision, motivo_ AS motivo, '{sources}' AS fuentes,
      CAST(year({date}) AS INT) AS anio, CAST(month({date}) AS INT) AS mes FROM (SELECT *, {kind} AS tipo_, {reason} AS motivo_ FROM {source})"""


Z = f"""(SELECT *, z_abs > 3.5 IS TRUE AS odd, gasto_combustible > 0 AND kg_base_rol = 0 AS vacio FROM (SELECT *, abs(0.6745 * (x - mid) / nullif(mad, 0)) AS z_abs FROM (SELECT *, median(abs(x - mid)) OVER (PARTITION BY rol) AS mad FROM (
  SELECT *, median(x) OVER (PARTITION BY rol) AS mid FROM (SELECT *, CASE WHEN kg_base_rol > 0 AND gasto_combustible > 0 THEN ln(gasto_combustible / (kg_base_rol / 1000)) END AS x FROM (
    SELECT *, CASE WHEN rol = 'reparto' THEN kg_vendidos ELSE kg_transportados END AS kg_base_rol FROM unidad_mes6 WHERE {YEAR}))))))"""
MONTH_DATE = "make_date(anio, mes, 1)"
V6 = {
    "S2": emit_sql("S2", f"(SELECT *, count(*) OVER (PARTITION BY codigo_scop) AS n FROM compras6 WHERE {WIDE}) WHERE codigo_scop IS NULL OR n > 1", "CASE WHEN codigo_scop IS NULL THEN 'compra_sin_scop' ELSE 'scop_repetido' END"),
    "S3": emit_sql("S3", f"""(SELECT *, abs(precio_usd_kg - base) / base AS off FROM (SELECT *, CASE WHEN precio_pactado_usd_kg > 0 THEN precio_pactado_usd_kg ELSE median(precio_usd_kg) OVER (PARTITION BY proveedor_id, year(fecha), month(fecha)) END AS base
        FROM compras6 WHERE {WIDE})) WHERE off > 0.05""", "CASE WHEN precio_pactado_usd_kg > 0 THEN 'precio_fuera_de_lo_pactado' ELSE 'precio_fuera_de_mediana_proveedor_mes' END", "off"),
    "S6": emit_sql("S6", f"(SELECT c.*, abs(tipo_cambio - tc_oficial) / tc_oficial AS off FROM compras6 c JOIN tc t USING (fecha) WHERE {LATE}) WHERE off > 0.01 AND tipo_cambio > 0", "'tipo_cambio_difiere_del_oficial'", "off"),
    "S7": emit_sql("S7", f"unidad_mes6 JOIN unidades6 u USING (unidad_id) WHERE {YEAR} AND NOT u.habilitada AND greatest(gasto_total, gasto_combustible, kg_vendidos, kg_transportados) > 0", "'actividad_en_unidad_no_habilitada'", kg="CASE WHEN rol = 'reparto' THEN kg_vendidos ELSE kg_transportados END", bill=False, date=MONTH_DATE, role=True),
    "S9": emit_sql("S9", f"{Z} WHERE odd OR vacio", "CASE WHEN vacio THEN 'combustible_sin_volumen_del_rol' ELSE 'combustible_por_tonelada_atipico' END", "CASE WHEN odd THEN z_abs ELSE 1.0 END", "CASE WHEN odd THEN 'regla_y_modelo' ELSE 'regla' END", kg="kg_base_rol", bill=False, date=MONTH_DATE, role=True),
    "S11": emit_sql("S11", f"produccion WHERE {OCTOBER} AND abs(stock_inicial + produccion - ventas - bonificaciones - stock_final) <= 1e-6 AND stock_final_es_calculado",
                    "CASE WHEN produccion < 0 AND abs(produccion + stock_inicial) <= 1e-6 THEN 'cierre_calculado_con_ajuste' ELSE 'cierre_calculado_sin_medicion_independiente' END", kg="CAST(NULL AS DOUBLE)", bill=False, unit=False),
}
BILLS = "SELECT factura_id, fecha, kg * precio_usd_kg AS monto_facturado_soles, kg * precio_pactado_usd_kg AS monto_pactado_soles FROM compras6"
CONTROL = emit_sql("S3", f"({BILLS}) WHERE {WIDE} AND monto_pactado_soles > 0 AND monto_facturado_soles - monto_pactado_soles > 0", "'sobrecobro_control_F08'", "(monto_facturado_soles - monto_pactado_soles) / monto_pactado_soles", kg="CAST(NULL AS DOUBLE)", unit=False, value="monto_facturado_soles - monto_pactado_soles")
SHOWN = {"puntaje": 6}


def v6(spark, sf_dir, signal: str):
    t = lambda n: table(spark, sf_dir, n)
    wide, late, october, year = (F.expr(x) for x in (WIDE, LATE, OCTOBER, YEAR))
    if signal == "S2":
        return S.s2(t("compras6"), wide)
    if signal == "S3":
        return S.s3(t("compras6"), wide)
    if signal == "S6":
        return S.s6(t("compras6"), t("tc"), late)
    if signal == "S7":
        return S.s7_v6(t("unidad_mes6"), t("unidades6"), year)
    if signal == "S9":
        return S.s9(t("unidad_mes6"), year)
    return S.s11(t("produccion"), october)


def all_v6(spark, sf_dir):
    out = v6(spark, sf_dir, "S2")
    for s in ("S3", "S6", "S7", "S9", "S11"):
        out = out.unionByName(v6(spark, sf_dir, s))
    return out


@query("s2_missing_or_repeated_scop", V6["S2"])
def s2_missing_or_repeated_scop(spark, sf_dir):
    return rounded(v6(spark, sf_dir, "S2"), SHOWN)


@query("s3_purchase_price", V6["S3"])
def s3_purchase_price(spark, sf_dir):
    return rounded(v6(spark, sf_dir, "S3"), SHOWN)


@query("s3_overcharge_control", CONTROL)
def s3_overcharge_control(spark, sf_dir):
    from kilotrace.sources.domain import sql

    return rounded(S.s3_control(sql(spark, sf_dir, BILLS), F.expr(WIDE)), SHOWN)


@query("s6_fx_deviation", V6["S6"])
def s6_fx_deviation(spark, sf_dir):
    return rounded(v6(spark, sf_dir, "S6"), SHOWN)


@query("s7_v6_not_enabled", V6["S7"])
def s7_v6_not_enabled(spark, sf_dir):
    return rounded(v6(spark, sf_dir, "S7"), SHOWN)


@query("s9_fuel_without_volume", V6["S9"])
def s9_fuel_without_volume(spark, sf_dir):
    return rounded(v6(spark, sf_dir, "S9"), SHOWN)


@query("s11_calculated_closing", V6["S11"])
def s11_calculated_closing(spark, sf_dir):
    return rounded(v6(spark, sf_dir, "S11"), SHOWN)


ORDER_OF = "CAST(substr(factura_id, 1, length(factura_id) - 2) AS bigint)"
TREASURY = f"SELECT factura_id, fecha, unidad_id, codigo_scop, kg + CASE WHEN {ORDER_OF} % 7 = 0 THEN 5 ELSE 0 END AS kg FROM compras6 WHERE {ORDER_OF} % 11 <> 0"
LOGISTICS = f"SELECT factura_id, fecha, unidad_id, codigo_scop, kg FROM compras6 WHERE {ORDER_OF} % 13 <> 0"
S12 = emit_sql("S12", f"""(SELECT * FROM (SELECT coalesce(l.factura_id, t.factura_id) AS factura_id, coalesce(l.fecha, t.fecha) AS fecha, coalesce(l.unidad_id, t.unidad_id) AS unidad_id, coalesce(l.codigo_scop, t.codigo_scop) AS codigo_scop, coalesce(l.kg, t.kg) AS kg, t.kg AS kt, l.kg AS kl
      FROM ({TREASURY}) t FULL JOIN ({LOGISTICS}) l ON t.factura_id = l.factura_id) WHERE {LATE}) WHERE kt IS NULL OR kl IS NULL OR kt <> kl""",
    "CASE WHEN kt IS NULL THEN 'factura_solo_en_logistica' WHEN kl IS NULL THEN 'factura_solo_en_tesoreria' ELSE 'kg_distinto' END", "CASE WHEN kt <> kl THEN abs(kt - kl) / greatest(kt, kl) ELSE 1.0 END")


@query("s12_treasury_logistics", S12)
def s12_treasury_logistics(spark, sf_dir):
    from kilotrace.sources.domain import sql

    return rounded(S.s12(sql(spark, sf_dir, TREASURY), sql(spark, sf_dir, LOGISTICS), F.expr(LATE)), SHOWN)


V6_ALL = " UNION ALL ".join(V6.values())


@query("all_signals_v6", V6_ALL)
def all_signals_v6(spark, sf_dir):
    return rounded(all_v6(spark, sf_dir), SHOWN)


@query("alert_v6", f"SELECT senal, grado_evidencia, count(*) AS alertas, count(DISTINCT id_alerta) AS ids FROM ({V6_ALL}) GROUP BY ALL")
def alert_v6(spark, sf_dir):
    return all_v6(spark, sf_dir).groupBy("senal", "grado_evidencia").agg(F.count("*").alias("alertas"), F.count_distinct("id_alerta").alias("ids"))


@query("signal_summary_v6", f"SELECT s.senal, coalesce(a.n, 0) AS alertas FROM (SELECT unnest(['S2', 'S3', 'S6', 'S7', 'S9', 'S11']) AS senal) s LEFT JOIN (SELECT senal, count(DISTINCT id_alerta) AS n FROM ({V6_ALL}) GROUP BY senal) a USING (senal)")
def signal_summary_v6(spark, sf_dir):
    return S.summary_v6(all_v6(spark, sf_dir))


@query("signal_window", f"SELECT count(*) FILTER (WHERE {WIDE}) AS s2_s3, count(*) FILTER (WHERE {LATE}) AS s6, count(*) FILTER (WHERE {OCTOBER}) AS s11, count(*) FILTER (WHERE year(fecha) = {P}) AS otras FROM compras6")
def signal_window(spark, sf_dir):
    c = table(spark, sf_dir, "compras6")
    return c.agg(*[F.count_if(F.expr(x)).alias(n) for x, n in ((WIDE, "s2_s3"), (LATE, "s6"), (OCTOBER, "s11"), (f"year(fecha) = {P}", "otras"))])


@query("evaluability", f"""SELECT 'S2' AS senal, count(*) AS filas, NULL::BIGINT AS comparables FROM compras6 WHERE {WIDE}
  UNION ALL SELECT 'S3', count(*), count(*) FILTER (WHERE precio_usd_kg > 0) FROM compras6 WHERE {WIDE}
  UNION ALL SELECT 'S6', count(*), count(*) FILTER (WHERE tc_oficial > 0 AND tipo_cambio > 0) FROM compras6 LEFT JOIN tc USING (fecha) WHERE {LATE}
  UNION ALL SELECT 'S7', count(*), count(u.habilitada) FROM unidad_mes6 LEFT JOIN unidades6 u USING (unidad_id) WHERE {YEAR}
  UNION ALL SELECT 'S11', count(*), count(stock_final_es_calculado) FROM produccion WHERE {OCTOBER}""")
def evaluability(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    say = lambda df, s, c: df.agg(F.lit(s).alias("senal"), F.count("*").alias("filas"), c.alias("comparables"))
    c = t("compras6")
    six = c.filter(LATE).join(t("tc"), "fecha", "left")
    parts = [
        say(c.filter(WIDE), "S2", F.lit(None).cast("long")), say(c.filter(WIDE), "S3", F.count_if(F.col("precio_usd_kg") > 0)),
        say(six, "S6", F.count_if((F.col("tc_oficial") > 0) & (F.col("tipo_cambio") > 0))),
        say(t("unidad_mes6").filter(YEAR).join(t("unidades6"), "unidad_id", "left"), "S7", F.count("habilitada")), say(t("produccion").filter(OCTOBER), "S11", F.count("stock_final_es_calculado")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
