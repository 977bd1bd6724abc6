"""Cleaning of identifiers, quantities, dates and text, as column expressions.

Every function takes and returns columns; none throws on bad input, under ANSI mode either.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ACCENTED = "ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇÑÝáàâäãåéèêëíìîïóòôöõúùûüçñýÿ"
PLAIN = "AAAAAAEEEEIIIIOOOOOUUUUCNYaaaaaaeeeeiiiiooooouuuucnyy"
RUC_WEIGHTS = (5, 4, 3, 2, 7, 6, 5, 4, 3, 2)
STATES = {
    "ATENDIDO": "ATENDIDO", "ATENDIDA": "ATENDIDO", "PENDIENTE": "PENDIENTE", "ANULADO": "ANULADO", "ANULADA": "ANULADO",
    "ACTIVO": "ACTIVO", "HABIDO": "HABIDO", "NO HABIDO": "NO HABIDO", "BAJA": "BAJA", "BAJA DE OFICIO": "BAJA",
}
MONTHS = {
    "ENERO": 1, "FEBRERO": 2, "MARZO": 3, "ABRIL": 4, "MAYO": 5, "JUNIO": 6, "JULIO": 7, "AGOSTO": 8, "SETIEMBRE": 9, "SEPTIEMBRE": 9,
    "OCTUBRE": 10, "NOVIEMBRE": 11, "DICIEMBRE": 12,
}
TRUE_WORDS, FALSE_WORDS = ("SI", "S", "TRUE", "1", "X", "VIGENTE"), ("NO", "N", "FALSE", "0", "VENCIDO")
EXCEL_ERRORS = ("#VALUE!", "#N/A", "#REF!", "#DIV/0!", "#NAME?", "#NULL!", "#NUM!")
BROKEN_FORMULAS = ("TRUE", "FALSE", "VERDADERO", "FALSO")
RATE_MIN, RATE_MAX = 3.2, 4.2
KG_PER_GALLON, KG_PER_LITRE = 2.04, 0.54
VEHICLES = "(CAMION|CISTERNA|TRACTO|GRANELERO|LABO|PICK ?UP|CAMIONETA)"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def some(c: Column) -> Column:
    """Null for an empty text. (nullif works out its argument once, a condition on it twice.)"""
    return F.nullif(c, F.lit(""))


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\s+", " "))


def plain(c: Column) -> Column:
    """Without accents."""
    return F.translate(c, ACCENTED, PLAIN)


def normal_name(c: Column) -> Column:
    return F.upper(squeeze(plain(c)))


def normal_header(c: Column) -> Column:
    return squeeze(F.regexp_replace(F.upper(plain(F.coalesce(c, F.lit("")))), "[^A-Z0-9#]", " "))


def file_slug(name: Column) -> Column:
    stem = F.regexp_replace(F.regexp_replace(name, "^.*/", ""), r"(?<=.)\.[^.]*$", "")
    return F.regexp_replace(F.regexp_replace(F.lower(plain(stem)), "[^a-z0-9]+", "_"), "^_|_$", "")


def plate(c: Column) -> tuple[Column, Column]:
    """(plate, date text) of a cell such as 't1a-123 15/07/2023'; the plate is null unless it has six characters."""
    date = r"\d{2}/\d{2}/\d{4}"
    up = F.upper(c)
    bare = F.regexp_replace(F.regexp_replace(up, date, ""), "[^A-Z0-9]", "")
    return some(F.regexp_extract(bare, r"^[A-Z0-9]{6}\z", 0)), some(F.regexp_extract(up, date, 0))


def blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "") | F.upper(strip(c)).isin(*EXCEL_ERRORS)


def plate6(c: Column) -> tuple[Column, Column, Column]:
    """(plate, date text, cost centre): what is no plate is a place or an area."""
    date = r"\d{1,2}/\d{1,2}/\d{2,4}"
    up = strip(F.upper(c))
    loose = F.regexp_replace(F.regexp_replace(up, r"\(.*?\)", ""), date, "")
    tight = F.regexp_replace(F.regexp_replace(loose, r"\s+", ""), VEHICLES + r"\z", "")
    good = ~blank(c) & tight.rlike(r"^[A-Z0-9]{3}-?[0-9]{3}\z")
    return F.when(good, F.regexp_replace(tight, "-", "")), F.when(good, some(F.regexp_extract(up, date, 0))), F.when(~good & ~blank(c), some(squeeze(loose)))


def digits(c: Column) -> Column:
    bare = strip(F.coalesce(c, F.lit("")))
    return F.regexp_replace(F.regexp_replace(bare, r"^(\d+)\.0+\z", "$1"), r"\D", "")


def ruc_valid(c: Column) -> Column:
    """Eleven digits of which the last is the module-11 check digit."""
    d = digits(c)
    total = sum((F.try_to_number(F.substring(d, i + 1, 1), F.lit("9")).cast("int") * w for i, w in enumerate(RUC_WEIGHTS)), F.lit(0))
    check = F.lit(11) - total % 11
    check = F.when(check == 10, 0).when(check == 11, 1).otherwise(check)
    return F.coalesce((F.length(d) == 11) & (check == F.try_to_number(F.substring(d, 11, 1), F.lit("9")).cast("int")), F.lit(False))


def dni(c: Column) -> Column:
    d = digits(c)
    return F.when((d != "") & (F.length(d) <= 8), F.lpad(d, 8, "0"))


def document(c: Column) -> tuple[Column, Column]:
    """(normalised document, class RUC / DNI / INVALIDO / VACIO)."""
    d = digits(c)
    kind = F.when(d == "", "VACIO").when((F.length(d) == 11) & ruc_valid(c), "RUC").when(F.length(d) <= 8, "DNI").otherwise("INVALIDO")
    return F.when(kind == "DNI", F.lpad(d, 8, "0")).when(kind != "VACIO", d), kind


def pseudonym(c: Column, salt: str) -> Column:
    return F.when(strip(c) != "", F.substring(F.sha2(F.concat(F.lit(salt), F.upper(strip(c))), 256), 1, 16))


def state(c: Column) -> Column:
    name = normal_name(c)
    known = F.create_map(*[F.lit(x) for pair in STATES.items() for x in pair])
    return F.when(name != "", F.coalesce(F.try_element_at(known, name), F.lit("OTRO")))


def number(c: Column) -> Column:
    """A finite number, or null."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def to_kg(c: Column) -> Column:
    """Kilos of text such as '5 000 kg', '1,250.5' or '12,5'; broken formulas are null."""
    up = F.upper(strip(c))
    bare = F.regexp_replace(up, r"[A-Z\s]", "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(",")))
    decimal = (commas == 1) & (F.length(F.element_at(F.split(bare, ","), -1)) != 3) & ~F.contains(bare, F.lit("."))
    fixed = F.when(decimal, F.replace(bare, F.lit(","), F.lit("."))).otherwise(F.replace(bare, F.lit(",")))
    return F.when(~up.isin(*BROKEN_FORMULAS) & (up != "") & fixed.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)\z"), fixed.try_cast("double"))


def number_or_kg(c: Column) -> Column:
    """A plain number where the text is one, else kilos."""
    return F.coalesce(number(strip(c)), to_kg(c))


def to_bool(c: Column) -> Column:
    up = F.upper(strip(plain(c)))
    return F.when(up.isin(*TRUE_WORDS), True).when(up.isin(*FALSE_WORDS), False)


def adjustment(production: Column, before: Column) -> Column:
    return F.coalesce((production < 0) & (F.abs(production + before) < 1e-6), F.lit(False))


def month_number(c: Column) -> Column:
    """A number from 1 to 12, or a Spanish name, or a prefix of three letters or more of one."""
    s = F.upper(strip(plain(c)))
    out = F.when(s.rlike(r"^[0-9]+\z") & s.try_cast("int").between(1, 12), s.try_cast("int"))
    for name, n in MONTHS.items():
        out = out.when((s == name) | ((F.length(s) >= 3) & F.startswith(F.lit(name), s)), n)
    return F.when(~blank(c), out)


def to_date(kind: Column, c: Column) -> Column:
    """A date of a typed cell: kind 'd' holds an ISO date, 'n' a spreadsheet's serial number, others text in one of six
    formats. Two-digit years from 69 on are of the last century."""
    s = strip(c)
    serial = F.when(number(s).between(20000.0000001, 79999.9999999), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(number(s)).cast("int")))

    def parts(pattern: str, order: str) -> Column:
        at = {k: F.regexp_extract(s, pattern, order.index(k) + 1).try_cast("int") for k in "ymd"}
        year = F.when(at["y"] < 69, at["y"] + 2000).otherwise(at["y"] + 1900) if pattern.endswith(r"(\d{2})\z") else at["y"]
        made = F.try_make_timestamp(year, at["m"], at["d"], F.lit(0), F.lit(0), F.lit(0)).cast("date")
        return F.when(s.rlike(pattern), made)

    text = F.coalesce(
        parts(r"^(\d{1,2})/(\d{1,2})/(\d{4})\z", "dmy"), parts(r"^(\d{1,2})/(\d{1,2})/(\d{2})\z", "dmy"), parts(r"^(\d{1,2})-(\d{1,2})-(\d{4})\z", "dmy"),
        parts(r"^(\d{4})-(\d{1,2})-(\d{1,2})\z", "ymd"), parts(r"^(\d{4})-(\d{1,2})-(\d{1,2}) \d{1,2}:\d{1,2}:\d{1,2}\z", "ymd"), parts(r"^(\d{1,2})\.(\d{1,2})\.(\d{4})\z", "dmy"),
    )
    return F.when(blank(c), None).when(kind == "n", serial).when(kind == "d", F.substring(s, 1, 10).try_cast("date")).otherwise(text)


def unswapped(date: Column, year: Column, month: Column) -> tuple[Column, Column]:
    """(date, ok / invertida / discrepa / sin_fecha): day and month change places where only that fits the sheet."""
    same_year = year.isNull() | (F.year(date) == year)
    fits = month.isNull() | ((F.month(date) == month) & same_year)
    swaps = (F.dayofmonth(date) <= 12) & (F.dayofmonth(date) == month) & same_year
    how = F.when(date.isNull(), "sin_fecha").when(fits, "ok").when(swaps, "invertida").otherwise("discrepa")
    swapped = F.try_make_timestamp(F.year(date), F.dayofmonth(date), F.month(date), F.lit(0), F.lit(0), F.lit(0)).cast("date")
    return F.when(how == "invertida", swapped).otherwise(date), how


def rate_valid(c: Column) -> Column:
    return F.coalesce(c.between(RATE_MIN, RATE_MAX), F.lit(False))


def package_kg(c: Column) -> Column:
    """Kilos a cylinder, of descriptions such as 'GLP 10 KG' or 'BL10'."""
    pattern = r"(?<!\d)(5|10|15|45)\s*(?:KGS?|KLGS?|KILOS?)\b|\bBL?(05|10|15|45)\b"
    s = F.upper(plain(c))
    return F.when(~blank(c), F.coalesce(F.regexp_extract(s, pattern, 1).try_cast("double"), F.regexp_extract(s, pattern, 2).try_cast("double")))


def units_to_kg(unit: Column, amount: Column, description: Column) -> Column:
    u = F.upper(strip(plain(F.coalesce(unit, F.lit("")))))
    kg = F.when(u.rlike("^(KILO|KG|KLG)"), amount).when(u.rlike("^GAL"), amount * KG_PER_GALLON).when(u.rlike("^(LITRO|LT)"), amount * KG_PER_LITRE)
    return F.when(~F.isnan(amount), kg.when(u.rlike("^(UNID|UND|BAL)"), amount * package_kg(description)))


def is_total(c: Column) -> Column:
    return F.coalesce(~blank(c) & F.upper(strip(plain(c))).rlike("^(TOTAL|SUBTOTAL|SUMA )"), F.lit(False))


def is_lpg(c: Column) -> Column:
    return F.coalesce(~blank(c) & F.upper(plain(c)).rlike(r"\bGLP\b"), F.lit(False))


def cell_text(kind: Column, c: Column) -> Column:
    """A typed cell as clean text: whole numbers without decimals, dates as dd/mm/yyyy, single spaces."""
    whole = F.regexp_replace(c, r"^(-?\d+)\.0+\z", "$1")
    date = F.date_format(F.substring(c, 1, 10).try_cast("date"), "dd/MM/yyyy")
    return F.when(~blank(c), F.when(kind == "n", whole).when(kind == "d", date).otherwise(squeeze(c)))


def cell_type(kind: Column, c: Column) -> Column:
    """vacia / texto / numero / fecha of a typed cell."""
    s = strip(c)
    bare = F.translate(s, "  S/$%()',", "")
    numeric = bare.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\z")
    return (
        F.when(kind.isNull() | c.isNull() | (s == ""), "vacia").when(kind == "b", "texto").when(kind == "d", "fecha").when(kind == "n", "numero")
        .when(numeric, "numero").when(s.rlike(r"^\d{1,4}[-/]\d{1,2}[-/]\d{1,4}"), "fecha").otherwise("texto")
    )
