"""Silver tables from raw purchases, sales, fleet and customers."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOVEMENT = ["tipo_mov", "documento", "linea", "placa_norm", "fecha", "id_producto", "kg_comprados", "kg_despachados", "kg_vendidos", "codigo_scop", "card_code", "precio", "canal", "anio", "mes"]


def movements(purchases: DataFrame, sales: DataFrame) -> DataFrame:
    """One row for each purchase and sale with a valid plate."""
    none = F.lit(0.0)
    c = purchases.withColumns({
        "tipo_mov": F.lit("compra"), "linea": F.lit(0), "placa_norm": F.col("placa_cargada"), "kg_comprados": F.col("kg"), "kg_despachados": F.col("kg"), "kg_vendidos": none,
        "card_code": F.lit(None).cast("string"), "precio": F.lit(None).cast("double"), "canal": F.lit(None).cast("string"),
    })
    v = sales.withColumns({"tipo_mov": F.lit("venta"), "kg_comprados": none, "kg_despachados": none, "kg_vendidos": F.col("kg")})
    return c.select(*MOVEMENT).unionByName(v.select(*MOVEMENT)).filter("placa_norm is not null")


def purchases(raw: DataFrame, years: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of purchases: plates, divergence, state and order code; dates out of scope go first, then
    repeated documents among what is left. raw: documento, placa_cargada_raw, placa_facturada_raw, fecha, kg,
    codigo_scop, estado, orden (a total order)."""
    from kilotrace.functions import clean as C
    from kilotrace.operators import quality as Q

    loaded, _ = C.plate(F.col("placa_cargada_raw"))
    billed, dated = C.plate(F.col("placa_facturada_raw"))
    df = raw.withColumns({"placa_cargada": loaded, "placa_facturada": billed, "fecha_en_placa": dated, "estado": C.state(F.col("estado")), "codigo_scop": C.some(F.col("codigo_scop"))})
    df = df.withColumn("flag_placa_divergente", F.coalesce(F.col("placa_cargada") != F.col("placa_facturada"), F.lit(False)))
    good, late = Q.split_rejects(df, [("fecha_fuera_de_alcance", Q.date_in_scope(F.col("fecha"), *years))])
    twice = Q.repeats(good, ["documento"]).select("documento", F.lit("duplicado").alias("motivo"))
    good = Q.first_rows(good, ["documento"], ["orden"]).withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")})
    return good.drop("placa_cargada_raw", "placa_facturada_raw"), late.select("documento", "motivo").union(twice)


def sales(raw: DataFrame, years: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of sale lines, with a flag on odd prices. raw: documento, linea, placa_raw, fecha, kg, precio,
    canal, id_producto, codigo_scop, orden."""
    from kilotrace.functions import clean as C
    from kilotrace.operators import quality as Q

    df = raw.withColumns({"placa_norm": C.plate(F.col("placa_raw"))[0], "codigo_scop": C.some(F.col("codigo_scop"))})
    good, late = Q.split_rejects(df, [("fecha_fuera_de_alcance", Q.date_in_scope(F.col("fecha"), *years))])
    twice = Q.repeats(good, ["documento", "linea"]).select("documento", F.lit("duplicado").alias("motivo"))
    good = Q.first_rows(good, ["documento", "linea"], ["orden"])
    good = Q.price_in_range(good.withColumns({"anio": F.year("fecha"), "mes": F.month("fecha")}), name="_ok")
    good = good.withColumn("flag_precio_atipico", ~F.col("_ok"))
    return good.drop("placa_raw", "_ok"), late.select("documento", "motivo").union(twice)


def fleet(raw: DataFrame, salt: str) -> DataFrame:
    """One row a valid plate, the first in ``orden``; drivers as pseudonyms."""
    from kilotrace.functions import clean as C
    from kilotrace.operators import quality as Q

    df = raw.withColumns({"placa_norm": C.plate(F.col("placa_raw"))[0], "conductor_hash": C.pseudonym(F.col("conductor"), salt)}).filter("placa_norm is not null")
    return Q.first_rows(df, ["placa_norm"], ["orden"]).select("placa_norm", "capacidad_kg", "habilitada", "conductor_hash")


def customers(raw: DataFrame, salt: str) -> DataFrame:
    """One row a customer: document class, tax number, pseudonym and state."""
    from kilotrace.functions import clean as C
    from kilotrace.operators import quality as Q

    doc, kind = C.document(F.col("documento_raw"))
    df = raw.withColumns({"documento_norm": doc, "clase_documento": kind, "estado": C.state(F.col("estado"))})
    df = df.withColumns({"ruc": F.when(F.col("clase_documento") == "RUC", F.col("documento_norm")), "ruc_valido": F.col("clase_documento") == "RUC", "documento_hash": C.pseudonym(F.col("documento_norm"), salt)})
    return Q.first_rows(df, ["card_code"], ["orden"]).select("card_code", "ruc", "ruc_valido", "clase_documento", "documento_hash", "capacidad_kg", "canal", "estado")


# the newer tables, from sheet rows whose cells are text

def _text(c: str):
    from kilotrace.functions import clean as C

    return F.upper(C.cell_text(F.lit("s"), F.col(c)))


def _has(raw: DataFrame, c: str):
    """A column that a delivery may lack."""
    return F.col(c) if c in raw.columns else F.lit(None).cast("string")


def lineage(df: DataFrame, source: str, key: list[str]) -> DataFrame:
    """``df`` with its source, and a mark on rows whose key is repeated; hoja and fila come with the rows."""
    from kilotrace.operators.quality import repeated

    return repeated(df.withColumn("origen", F.lit(source)), key)


def invoices(raw: DataFrame, salt: str) -> DataFrame:
    """Purchase invoices: swapped dates, kilos (or the sum of both kinds), plate or cost centre, rate flag, amounts.

    Deliveries with one quantity, ``kg``, have the kind of gas in ``tipo``. ``hoja`` and ``fila`` stay, if there."""
    from kilotrace.functions import clean as C

    raw = raw.withColumn("_fecha", C.to_date(F.lit("s"), F.col("fecha_factura")))
    date, how = C.unswapped(F.col("_fecha"), F.col("_anio"), F.col("_mes"))
    plate, _, centre = C.plate6(_has(raw, "placa"))
    plain, upper = lambda c: C.cell_text(F.lit("s"), _has(raw, c)), lambda c: F.upper(C.cell_text(F.lit("s"), _has(raw, c)))
    number = lambda c: C.to_kg(_has(raw, c))
    kinds = {"e": number("kg_glp_e"), "g": number("kg_glp_g")}
    total = F.when(kinds["e"].isNotNull() | kinds["g"].isNotNull(), F.coalesce(kinds["e"], F.lit(0.0)) + F.coalesce(kinds["g"], F.lit(0.0)))
    if "kg" in raw.columns:
        total = number("kg")
        kinds = {k: F.when(upper("tipo") == f"GLP-{k.upper()}", total) for k in "eg"}
    rate = number("tipo_cambio")
    return raw.select(
        F.col("_anio").alias("anio"), F.col("_mes").alias("mes"), upper("proveedor").alias("proveedor"), plain("codigo_osinergmin").alias("codigo_osinergmin"), C.some(C.digits(F.col("nro_scop"))).alias("nro_scop"),
        date.alias("fecha_factura"), how.alias("estado_fecha"), upper("serie").alias("serie"), upper("numero").alias("numero"), upper("tipo").alias("tipo"),
        kinds["e"].alias("kg_glp_e"), kinds["g"].alias("kg_glp_g"), total.alias("kg"), plate.alias("placa_norm"), centre.alias("centro_costo"), plain("guia").alias("guia"),
        number("monto_usd").alias("monto_usd"), rate.alias("tipo_cambio"), C.rate_valid(rate).alias("tc_valido"), number("monto_pagado").alias("monto_pagado"), number("precio_unitario").alias("precio_unitario"),
        number("total").alias("total"), upper("estado").alias("estado"), C.pseudonym(_has(raw, "conductor"), salt).alias("conductor_hash"), *_placed(raw),
    )


def _upper(raw: DataFrame, c: str):
    from kilotrace.functions import clean as C

    return F.upper(C.cell_text(F.lit("s"), _has(raw, c))).alias(c)


def _number(raw: DataFrame, c: str, kind: str = "double"):
    from kilotrace.functions import clean as C

    x = C.to_kg(_has(raw, c))
    return (F.bround(x, 0) if kind == "int" else x).cast(kind).alias(c)


def _placed(raw: DataFrame) -> list[str]:
    """Where a row stands in its source, if the reader has said so, and how many rows it is for."""
    return [c for c in ("hoja", "fila", "veces") if c in raw.columns]


def orders(raw: DataFrame) -> DataFrame:
    """Purchase orders with both plates, what was written beside the second, and whether they differ."""
    from kilotrace.functions import clean as C

    loaded, _, _ = C.plate6(F.col("placa_cargada"))
    billed, dated, _ = C.plate6(F.col("placa_facturada"))
    text = lambda c: _upper(raw, c)
    return raw.select(
        C.to_date(F.lit("s"), F.col("fecha")).alias("fecha"), C.some(C.digits(F.col("nro_scop"))).alias("nro_scop"), text("producto"), text("proveedor"), text("lugar_origen"),
        loaded.alias("placa_cargada"), billed.alias("placa_facturada"), dated.alias("fecha_en_placa"), F.coalesce(loaded != billed, F.lit(False)).alias("flag_placa_divergente"), text("factura"), text("estado"), *_placed(raw),
    )


def units(raw: DataFrame) -> DataFrame:
    """Vehicle masters; rows without a valid plate are kept. The company is the column's, else the sheet's."""
    from kilotrace.functions import clean as C

    text = lambda c: _upper(raw, c)
    return raw.select(
        F.coalesce(text("empresa"), "_empresa").alias("empresa"), text("zonal"), _text("placa").alias("placa_texto"), C.plate6(F.col("placa"))[0].alias("placa_norm"), text("clase"), text("marca"), text("modelo"),
        _number(raw, "anio_fabricacion", "int"), _number(raw, "capacidad_glp_kg"), C.cell_text(F.lit("s"), _has(raw, "cert_mercancias_peligrosas")).alias("cert_mercancias_peligrosas"), text("uso"), text("estado_soat"),
        C.to_bool(_has(raw, "traslada_gas")).alias("traslada_gas"), *_placed(raw),
    )


def unit_months(raw: DataFrame, salt: str) -> DataFrame:
    """A vehicle's sales of a month and article."""
    from kilotrace.functions import clean as C

    plate, _, centre = C.plate6(F.col("proyecto"))
    text = lambda c: _upper(raw, c)
    return raw.select(
        F.col("_anio").alias("anio"), C.month_number(F.col("mes_texto")).alias("mes"), text("proyecto"), plate.alias("placa_norm"), centre.alias("centro_costo"), text("articulo"), text("tipo"), text("unidad_negocio"), text("unidad_medida"),
        _number(raw, "cantidad"), _number(raw, "precio_promedio"), C.pseudonym(_has(raw, "vendedor"), salt).alias("vendedor_hash"), _number(raw, "kg"), _number(raw, "balones_galones"), *_placed(raw),
    )


def sale_details(raw: DataFrame, salt: str) -> DataFrame:
    """Sale lines with kilos as registered, else derived from units, and where they come from."""
    from kilotrace.functions import clean as C

    plate, _, centre = C.plate6(F.col("proyecto"))
    text = lambda c: _upper(raw, c)
    df = raw.select(
        C.to_date(F.lit("s"), F.col("fecha")).alias("fecha"), text("proyecto"), plate.alias("placa_norm"), centre.alias("centro_costo"), _number(raw, "linea", "int"), text("articulo_codigo"), text("articulo"), text("unidad_medida"),
        _number(raw, "cantidad"), _number(raw, "precio_unitario"), _number(raw, "importe"), _number(raw, "kg").alias("_kg"), C.pseudonym(_has(raw, "cliente_codigo"), salt).alias("cliente_id"), text("indicador"), text("documento"),
        C.pseudonym(_has(raw, "vendedor"), salt).alias("vendedor_hash"), *_placed(raw),
    )
    lpg = C.is_lpg(F.col("articulo"))
    derived = F.when(lpg, C.units_to_kg(F.col("unidad_medida"), F.col("cantidad"), F.col("articulo")))
    stated = F.when(lpg, F.col("_kg"))
    origin = F.when(stated.isNotNull(), "registrado").when(derived.isNotNull(), "derivado").when(lpg, "sin_conversion").otherwise("no_glp")
    return df.withColumns({"anio": F.year("fecha"), "mes": F.month("fecha"), "es_glp": lpg, "kg": F.coalesce(stated, derived), "kg_origen": origin}).drop("_kg")


#: The contracts: a table's natural key, and its columns in order. Fixed values.
CONTRACTS = {
    "compras_glp": (["proveedor", "serie", "numero"], "origen hoja fila anio mes proveedor codigo_osinergmin nro_scop fecha_factura estado_fecha serie numero tipo kg_glp_e kg_glp_g kg placa_norm centro_costo guia monto_usd tipo_cambio tc_valido monto_pagado precio_unitario total estado conductor_hash llave_repetida"),
    "scop": (["nro_scop"], "origen hoja fila fecha nro_scop producto proveedor lugar_origen placa_cargada placa_facturada fecha_en_placa flag_placa_divergente factura estado llave_repetida"),
    "unidades": (["origen", "hoja", "fila"], "origen hoja fila empresa zonal placa_texto placa_norm clase marca modelo anio_fabricacion capacidad_glp_kg cert_mercancias_peligrosas uso estado_soat traslada_gas llave_repetida"),
    "ventas_unidad_mes": (["anio", "mes", "proyecto", "articulo", "vendedor_hash"], "origen hoja fila anio mes proyecto placa_norm centro_costo articulo tipo unidad_negocio unidad_medida cantidad precio_promedio vendedor_hash kg balones_galones llave_repetida"),
    "ventas_detalle": (["origen", "fila"], "origen hoja fila anio mes fecha proyecto placa_norm centro_costo linea articulo_codigo articulo es_glp unidad_medida cantidad precio_unitario importe kg kg_origen cliente_id indicador documento vendedor_hash llave_repetida"),
}


def contracted(name: str, df: DataFrame, source: str) -> DataFrame:
    """A table as its contract has it: lineage, a mark on rows whose natural key is repeated, and no other columns.

    A column that the transformation has not made is an error."""
    key, columns = CONTRACTS[name]
    marked = lineage(df, source, key)
    if missing := [c for c in columns.split() if c not in marked.columns]:
        raise ValueError(f"{name}: the columns {missing} are missing")
    return marked.select(*columns.split())


# what control reports say of the newer tables

def measures(name: str, df: DataFrame, only: list[str] | None = None) -> DataFrame:
    """(tabla, metrica, valor) of one of the newer tables, or ``only`` some, in one aggregate. A row with ``veces`` is
    for so many rows."""
    c, n, plate = F.col, F.col("veces") if "veces" in df.columns else F.lit(1), F.col("placa_norm").isNotNull() if "placa_norm" in df.columns else None
    lpg = c("es_glp") if "es_glp" in df.columns else None
    count = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0))
    known = lambda name: count(c(name).isNotNull())
    #: the share of all rows (or of ``those``) that meet a condition; 0 where there are none
    share = lambda cond, those=F.lit(True): F.coalesce(F.bround(count(cond) / F.nullif(count(those), F.lit(0)), 4), F.lit(0.0))
    wanted = {
        "compras_glp": lambda: {
            "placa_valida": share(plate), "scop_presente": share(c("nro_scop").isNotNull()), "scop_11_digitos": share(F.length("nro_scop") == 11), "scop_repetidos": known("nro_scop") - F.count_distinct("nro_scop"),
            "fechas_invertidas": count(c("estado_fecha") == "invertida"), "fechas_que_discrepan": count(c("estado_fecha") == "discrepa"), "tc_registrados": known("tipo_cambio"),
            "tc_fuera_de_rango": count(c("tipo_cambio").isNotNull() & ~F.coalesce(c("tc_valido"), F.lit(False))), "kg_positivo": share(c("kg") > 0),
        },
        "scop": lambda: {
            "ordenes_con_ambas_placas": count(c("placa_cargada").isNotNull() & c("placa_facturada").isNotNull()), "ordenes_con_placa_divergente": count(c("flag_placa_divergente")), "fecha_valida": share(c("fecha").isNotNull()),
        },
        "unidades": lambda: {
            "placa_valida": share(plate), "con_capacidad": known("capacidad_glp_kg"), "traslada_gas_si": count(c("traslada_gas")), "traslada_gas_si_con_placa_valida": count(c("traslada_gas") & plate),
            "placas_distintas": F.count_distinct("placa_norm"), "traslada_gas_declarado": known("traslada_gas"),
        },
        "ventas_unidad_mes": lambda: {
            "mes_reconocido": share(c("mes").isNotNull()), "filas_con_placa": share(plate), "kg_con_placa_valida": F.coalesce(F.bround(F.sum(F.when(plate, c("kg") * n)) / F.nullif(F.sum(c("kg") * n), F.lit(0.0)), 4), F.lit(0.0)),
        },
        "ventas_detalle": lambda: {
            "fecha_valida": share(c("fecha").isNotNull()), "lineas_glp": count(lpg), "lineas_no_glp": count(~lpg), "lineas_glp_convertibles_a_kg": share(lpg & c("kg").isNotNull(), lpg),
            "kg_registrado": count(c("kg_origen") == "registrado"), "kg_derivado": count(c("kg_origen") == "derivado"), "filas_con_placa": share(plate),
        },
    }[name]()
    wanted = {k: v for k, v in wanted.items() if only is None or k in only}
    sums = df.agg(*[v.cast("double").alias(k) for k, v in wanted.items()])
    return sums.select(F.lit(name).alias("tabla"), F.explode(F.array(*[F.struct(F.lit(k).alias("metrica"), F.col(k).alias("valor")) for k in wanted])).alias("m")).select("tabla", "m.*")


#: The cells that measures depend on, and those measures. Whether kilos are a number shows in a cell's shape, whichever
#: digits it has.
CELLS = {
    "compras_glp": [
        (["placa"], ["placa_valida"]), (["nro_scop"], ["scop_presente", "scop_11_digitos", "scop_repetidos"]), (["_anio", "_mes", "fecha_factura"], ["fechas_invertidas", "fechas_que_discrepan"]),
        (["tipo_cambio"], ["tc_registrados", "tc_fuera_de_rango"]), (["kg_glp_e", "kg_glp_g"], ["kg_positivo"]),
    ],
    "scop": [(["placa_cargada", "placa_facturada"], ["ordenes_con_ambas_placas", "ordenes_con_placa_divergente"]), (["fecha"], ["fecha_valida"])],
    "unidades": [(["placa", "capacidad_glp_kg", "traslada_gas"], ["placa_valida", "con_capacidad", "traslada_gas_si", "traslada_gas_si_con_placa_valida", "placas_distintas", "traslada_gas_declarado"])],
    "ventas_unidad_mes": [(["mes_texto"], ["mes_reconocido"]), (["proyecto", "kg"], ["filas_con_placa", "kg_con_placa_valida"])],
    "ventas_detalle": [
        (["fecha"], ["fecha_valida"]), (["proyecto"], ["filas_con_placa"]),
        (["articulo", "unidad_medida", "cantidad", "translate(kg, '123456789', '000000000') AS kg"], ["lineas_glp", "lineas_no_glp", "lineas_glp_convertibles_a_kg", "kg_registrado", "kg_derivado"]),
    ],
}


def cell_measures(name: str, raw: DataFrame, made: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The measures of what ``made`` makes of ``raw``. Rows are first counted by the cells that a measure depends on,
    so a cell that any number of rows have is cleaned once."""
    parts = []
    for cells, only in CELLS[name]:
        few = raw.selectExpr(*cells)
        few = few.groupBy(*few.columns).agg(F.count("*").alias("veces"))
        few = few.withColumns({c: F.lit(None).cast(kind) for c, kind in raw.dtypes if c not in few.columns})
        parts.append(measures(name, made(few), only))
    return reduce(DataFrame.unionByName, parts)
