"""Rule signals: rows that break a rule become alerts with stable identifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilotrace.operators.gold import GROUP, REFERENCE_PRICE, anti, group_median, group_values

# Fixed values.
CATALOGUE = {
    "S1": ("Placa cargada distinta de la facturada", "alto"), "S4": ("Carga superior a la capacidad del vehículo", "medio"),
    "S5": ("Entrega superior a la capacidad del local", "medio"), "S7": ("Volumen asignado a unidad no habilitada", "medio"),
    "S8": ("Venta sin compra SCOP asociada", "alto"), "S10": ("Precio por debajo de la mediana del canal", "medio"),
}
#: Signal to (resolution, grade, sources) of the newer rules.
RULES = {
    "S2": ("factura", "alto", "F06,F07"), "S3": ("factura", "medio", "F08,F06"), "S6": ("factura", "alto", "F04,F06,PU-02"),
    "S7": ("unidad_mes", "medio", "F26,F17,F20"), "S9": ("unidad_mes", "medio", "F17,F20,F07"), "S11": ("dia", "alto", "F36"),
}
#: A rule that the catalogue names and that no summary counts yet.
PENDING = {"S12": ("factura", "alto", "F01,F02,F03,F04,F06")}
HYPOTHESES = {"S1": "H1", "S4": "H1", "S5": "H1", "S7": "H1", "S8": "H1", "S10": "H4"}
PRICE_TOLERANCE, LOW_PRICE, RATE_TOLERANCE, STOCK_TOLERANCE, Z_LIMIT = 0.05, 0.10, 0.01, 1e-6, 3.5


def alert(df: DataFrame, signal: str, plate: str, score: Column | None = None) -> DataFrame:
    """The alert contract. The identifier hashes signal, document and plate: lines of one document share it."""
    doc, own = F.col("documento"), F.col(plate)
    key = F.concat_ws("|", F.lit(signal), doc, F.coalesce(own, F.lit("None")))
    return df.select(
        F.substring(F.md5(key), 1, 12).alias("id_alerta"), F.lit(signal).alias("senal"), F.lit("regla").alias("tipo"), "fecha", own.alias("placa_norm"),
        doc.alias("documento"), "kg", (F.col("kg") * REFERENCE_PRICE).alias("valor_soles"), (score if score is not None else F.lit(1.0)).alias("puntaje"),
        F.lit(CATALOGUE[signal][1]).alias("grado_evidencia"), F.lit("pendiente").alias("estado_revision"), "anio", "mes",
    )


def s1(purchases: DataFrame) -> DataFrame:
    return alert(purchases.filter("flag_placa_divergente"), "S1", "placa_cargada")


def s4(purchases: DataFrame, fleet: DataFrame) -> DataFrame:
    cap = fleet.select(F.col("placa_norm").alias("placa_cargada"), "capacidad_kg")
    over = purchases.join(cap, "placa_cargada").filter("kg > capacidad_kg")
    return alert(over, "S4", "placa_cargada", F.col("kg") / F.col("capacidad_kg"))


def s5(sales: DataFrame, master: DataFrame) -> DataFrame:
    cap = master.select("card_code", F.col("capacidad_kg").alias("cap"))
    return alert(sales.join(cap, "card_code").filter("kg > cap"), "S5", "placa_norm", F.col("kg") / F.col("cap"))


def s7(purchases: DataFrame, fleet: DataFrame) -> DataFrame:
    """Purchases by plates that are not enabled, unknown ones included."""
    enabled = fleet.filter("habilitada").select(F.col("placa_norm").alias("placa_cargada"))
    return alert(purchases.join(enabled, "placa_cargada", "left_anti"), "S7", "placa_cargada")


def s8(sales: DataFrame, purchases: DataFrame) -> DataFrame:
    return alert(anti(sales.filter("codigo_scop is not null"), purchases, ["codigo_scop"]), "S8", "placa_norm")


def s10(sales: DataFrame, tolerance: float = LOW_PRICE) -> DataFrame:
    priced = group_median(sales.filter("precio is not null"), "precio", GROUP)
    low = priced.filter(F.col("precio") < F.col("mediana") * (1 - tolerance))
    return alert(low, "S10", "placa_norm", 1 - F.col("precio") / F.col("mediana"))


def all_v2(purchases: DataFrame, sales: DataFrame, fleet: DataFrame, master: DataFrame) -> DataFrame:
    parts = [s1(purchases), s4(purchases, fleet), s5(sales, master), s7(purchases, fleet), s8(sales, purchases), s10(sales)]
    return reduce(DataFrame.unionByName, parts)


def _json(c: Column) -> Column:
    """A text as a JSON string, or null's word."""
    text = F.replace(F.replace(c.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, short in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(short))
    return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit("null"))


def emit(df: DataFrame, signal: str, reason: Column, score: Column | None = None, kind: Column | None = None, value: Column | None = None) -> DataFrame:
    """The newer alert contract; the identifier hashes the JSON list of the alert's keys."""
    resolution, grade, sources = (RULES | PENDING)[signal]
    has = lambda c, t="string": (F.col(c) if c in df.columns else F.lit(None)).cast(t)
    date = F.col("fecha") if "fecha" in df.columns else F.make_date("anio", "mes", F.lit(1))
    kg = has("kg", "double") if "kg" in df.columns else has("kg_base_rol", "double")
    kind = F.lit("regla") if kind is None else kind
    stamp = F.concat(date.cast("string"), F.lit(" 00:00:00"))
    keys = [F.lit(signal), kind, F.lit(resolution), stamp, has("unidad_id"), has("factura_id"), reason]
    ident = F.substring(F.sha2(F.concat(F.lit("["), F.concat_ws(", ", *[_json(k) for k in keys]), F.lit("]")), 256), 1, 24)
    return df.select(
        ident.alias("id_alerta"), F.lit(signal).alias("senal"), kind.alias("tipo"), F.lit(resolution).alias("resolucion"), date.alias("fecha"),
        has("unidad_id").alias("unidad_id"), has("rol").alias("rol"), has("factura_id").alias("factura_id"), has("codigo_scop").alias("codigo_scop"), kg.alias("kg"),
        (F.lit(None).cast("double") if value is None else value).alias("valor_soles"), (F.lit(1.0) if score is None else score).alias("puntaje"),
        F.lit(grade).alias("grado_evidencia"), F.lit("pendiente").alias("estado_revision"), reason.alias("motivo"), F.lit(sources).alias("fuentes"),
        F.year(date).alias("anio"), F.month(date).alias("mes"),
    )


def s2(purchases: DataFrame, window: Column) -> DataFrame:
    """Purchases without an order code, or with one that others in the window have."""
    c = purchases.filter(window).withColumn("_scop", F.trim(F.coalesce("codigo_scop", F.lit(""))))
    often = c.filter("_scop <> ''").groupBy("_scop").count().filter("count > 1").select("_scop", F.lit(True).alias("_rep"))
    c = c.join(often, "_scop", "left").filter("_scop = '' or _rep")
    return emit(c, "S2", F.when(F.col("_scop") == "", "compra_sin_scop").otherwise("scop_repetido"))


def s3(purchases: DataFrame, window: Column, tolerance: float = PRICE_TOLERANCE) -> DataFrame:
    """Prices that differ from the agreed one, or else from the supplier's monthly median."""
    price = F.when(F.col("precio_usd_kg") > 0, F.col("precio_usd_kg"))
    c = purchases.filter(window).withColumns({"_p": price, "_a": F.year("fecha"), "_m": F.month("fecha")})
    c = group_values(c, ["proveedor_id", "_a", "_m"], F.median("_p").alias("_mid"))
    agreed = F.col("precio_pactado_usd_kg") if "precio_pactado_usd_kg" in c.columns else F.lit(None).cast("double")
    by_deal = F.coalesce(agreed > 0, F.lit(False))
    base = F.when(by_deal, agreed).otherwise(F.when(F.col("proveedor_id").isNotNull(), F.col("_mid")))
    off = F.abs(F.col("_p") - base) / F.when(base > 0, base)
    reason = F.when(by_deal, "precio_fuera_de_lo_pactado").otherwise("precio_fuera_de_mediana_proveedor_mes")
    return emit(c.withColumns({"_off": off, "_why": reason}).filter(F.col("_off") > tolerance), "S3", F.col("_why"), F.col("_off"))


def s3_control(bills: DataFrame, window: Column) -> DataFrame:
    over = F.col("monto_facturado_soles") - F.col("monto_pactado_soles")
    c = bills.filter(window & (F.col("monto_facturado_soles") >= 0) & (F.col("monto_pactado_soles") > 0) & (over > 0))
    return emit(c, "S3", F.lit("sobrecobro_control_F08"), over / F.col("monto_pactado_soles"), value=over)


def s6(purchases: DataFrame, rates: DataFrame, window: Column, tolerance: float = RATE_TOLERANCE) -> DataFrame:
    """Rates that differ from the official one of the very day."""
    c = purchases.filter(window).join(rates.select("fecha", "tc_oficial"), "fecha", "left")
    off = F.abs(F.col("tipo_cambio") - F.col("tc_oficial")) / F.when(F.col("tc_oficial") > 0, F.col("tc_oficial"))
    c = c.withColumn("_off", off).filter((F.col("_off") > tolerance) & (F.col("tipo_cambio") > 0))
    return emit(c, "S6", F.lit("tipo_cambio_difiere_del_oficial"), F.col("_off"))


def s12(treasury: DataFrame, logistics: DataFrame, window: Column, tolerance: float = 1e-6) -> DataFrame:
    """Invoices that treasury or logistics lacks, or whose kilos differ. Both sides are summed by invoice first, so an
    invoice in several rows is one; rows without an invoice number have nothing to be compared by and are left out."""
    side = lambda df, k: df.filter("factura_id IS NOT NULL").groupBy("factura_id").agg(F.sum("kg").alias(f"kg_{k}"), F.min("fecha").alias(f"fecha_{k}"), F.min("unidad_id").alias(f"unidad_{k}"), F.min("codigo_scop").alias(f"scop_{k}"))
    both = side(treasury, "t").join(side(logistics, "l"), "factura_id", "full_outer")
    first = lambda name: F.coalesce(f"{name}_l", f"{name}_t")
    both = both.withColumns({"fecha": first("fecha"), "unidad_id": first("unidad"), "codigo_scop": first("scop"), "kg": first("kg")}).filter(window)
    off = F.abs(F.coalesce(F.col("kg_t"), F.lit(0.0)) - F.coalesce(F.col("kg_l"), F.lit(0.0)))
    why = F.when(F.col("fecha_t").isNull(), "factura_solo_en_logistica").when(F.col("fecha_l").isNull(), "factura_solo_en_tesoreria").when(off > tolerance, "kg_distinto")
    score = F.when(F.col("_why") == "kg_distinto", off / F.greatest(F.abs("kg_t"), F.abs("kg_l"))).otherwise(1.0)
    return emit(both.withColumn("_why", why).filter("_why IS NOT NULL"), "S12", F.col("_why"), score)


def role_volume() -> Column:
    return F.when(F.col("rol") == "reparto", F.col("kg_vendidos")).otherwise(F.col("kg_transportados"))


def s7_v6(months: DataFrame, units: DataFrame, window: Column) -> DataFrame:
    """Activity of units known not to be enabled."""
    um = months.filter(window).join(units.select("unidad_id", "habilitada"), "unidad_id", "left")
    active = F.greatest(*[F.coalesce(c, F.lit(0.0)) for c in ("gasto_total", "gasto_combustible", "kg_vendidos", "kg_transportados")]) > 0
    return emit(um.filter((~F.col("habilitada")) & active).withColumn("kg_base_rol", role_volume()), "S7", F.lit("actividad_en_unidad_no_habilitada"))


def s9(months: DataFrame, window: Column, limit: float = Z_LIMIT) -> DataFrame:
    """Fuel without the role's volume, or fuel a tonne far from the role's median."""
    from kilotrace.operators.score import mad_score

    p = mad_score(months.filter(window), limit)
    empty = F.coalesce((F.col("gasto_combustible") > 0) & (F.col("kg_base_rol") == 0), F.lit(False))
    odd = F.col("alerta_base")
    p = p.withColumns({"_why": F.when(empty, "combustible_sin_volumen_del_rol").otherwise("combustible_por_tonelada_atipico"), "_score": F.when(odd, F.col("puntaje")).otherwise(1.0), "_kind": F.when(odd, "regla_y_modelo").otherwise("regla")})
    return emit(p.filter(empty | odd), "S9", F.col("_why"), F.col("_score"), F.col("_kind"))


STOCK = ["stock_inicial", "produccion", "ventas", "bonificaciones", "stock_final"]


def residual() -> Column:
    return F.col("stock_inicial") + F.col("produccion") - F.col("ventas") - F.col("bonificaciones") - F.col("stock_final")


def s11(days: DataFrame, window: Column, tolerance: float = STOCK_TOLERANCE) -> DataFrame:
    """Closings that were calculated rather than measured."""
    p = days.filter(window).filter((F.abs(residual()) <= tolerance) & F.col("stock_final_es_calculado"))
    fixed = (F.col("produccion") < 0) & (F.abs(F.col("produccion") + F.col("stock_inicial")) <= tolerance)
    return emit(p, "S11", F.when(fixed, "cierre_calculado_con_ajuste").otherwise("cierre_calculado_sin_medicion_independiente"))


def summary(alerts: DataFrame) -> DataFrame:
    """Alerts, kilos and plates of each signal, with its hypothesis and description."""
    say = lambda pairs: F.try_element_at(F.create_map(*[F.lit(x) for p in pairs for x in p]), F.col("senal"))
    out = alerts.groupBy("senal").agg(F.count("id_alerta").alias("alertas"), F.sum("kg").alias("kg"), F.count_distinct("placa_norm").alias("unidades"))
    return out.withColumns({"hipotesis": say(HYPOTHESES.items()), "descripcion": say([(k, v[0]) for k, v in CATALOGUE.items()])})


def summary_v6(alerts: DataFrame) -> DataFrame:
    """Distinct alerts of each of the six signals, none left out."""
    names = alerts.sparkSession.createDataFrame([(s,) for s in RULES], "senal string")
    counts = alerts.groupBy("senal").agg(F.count_distinct("id_alerta").alias("alertas"))
    return names.join(counts, "senal", "left").fillna(0, ["alertas"])


def check_alerts(alerts: DataFrame, contract: list[str], key: list[str] | None = None) -> DataFrame:
    """The contract's columns of alerts whose identifiers (or else ``key``) are unique; anything else is an error."""
    if missing := set(contract) - set(alerts.columns):
        raise ValueError(f"columns missing: {sorted(missing)}")
    if alerts.groupBy(*(key or ["id_alerta"])).count().filter("count > 1").limit(1).count():
        raise ValueError("repeated alert identifiers")
    return alerts.select(*contract)
