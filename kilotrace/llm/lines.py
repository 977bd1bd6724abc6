"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

Lines are compared with white space apart. Of equal lines the earliest, by (doc_id, place), stays. Lines are also
near-copies within one edit (a unit inserted, deleted or replaced) in ten: the units of lines of ten words or more are
words, those of other lines are the characters of their words joined by spaces. The longer of both lines must have ten
units; so a line under nine characters has copies alone. A line goes if an earlier one is a copy or near-copy of it.

Null texts stay null, blank lines always stay. A row repeated whole loses its lines to the first such row; null
doc_ids come first. Documents keep all their other columns; an added column whose name is taken gets an underscore.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilotrace.llm.common import SPACE, Scratch, documents, free

#: Hashes that are added up keep 40 bits, so that sums over lines of 8 million words stay within a long.
ADDED = (1 << 40) - 1
BLANKS = " \t\n\x0b\x0c\r"


def _split(text: Column) -> Column:
    return F.split(text, "\n")


def _words(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(BLANKS)), SPACE)


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) == ""


def _forms(words: Column, units: int) -> Column:
    """What a line is compared by: its units, what they are, and whether only a longer line can be its near-copy."""
    n, text = F.size(words), F.array_join(words, " ")
    letters = F.split(text, "")
    form = lambda of, kind: F.struct(of.alias("units"), F.lit(kind).alias("kind"), (F.size(of) < units).alias("short"))
    by_word, by_letter = F.when(n >= units - 1, form(words, "word")), F.when((n < units) & (F.length(text) >= units - 1), form(letters, "letter"))
    return F.filter(F.array(by_word, by_letter), lambda x: x.isNotNull())


def _halves(form: Column) -> Column:
    """Hashes of both ends of a line: lines within one edit share an end, for an edit touches one half at most."""
    units, n = form["units"], F.size(form["units"])

    def ends(m: Column) -> list[Column]:
        return [F.xxhash64(form["kind"], F.lit(0), m, F.slice(units, 1, m)), F.xxhash64(form["kind"], F.lit(1), m, F.slice(units, n - m + 1, m))]

    return F.array(*ends((n / 2).cast("int")), *ends(((n - 1) / 2).cast("int")))


def _added(*cols: Column) -> Column:
    return F.xxhash64(*cols).bitwiseAND(F.lit(ADDED))


def _total(hashes: Column) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, x: a + x)


def _hashed(lines: DataFrame) -> DataFrame:
    """``lines`` (place, kind, units, short) with hashes of units at their places and of neighbouring units (both ends
    included), and the sums of both. Each variant's hash then takes a few additions, however long the line."""
    ring = lines.withColumn("ring", F.concat(F.array(F.lit("\n")), F.col("units"), F.array(F.lit("\n"))))
    pairs = F.zip_with("ring", F.slice("ring", 2, F.size("units") + 2), lambda x, y: _added(x, y))
    hashed = ring.withColumns({
        "placed": F.transform("units", lambda w, i: _added(w, i)),
        "links": F.slice(pairs, 1, F.size("units") + 1),
        "bridges": F.slice(F.zip_with("ring", F.slice("ring", 3, F.size("units") + 2), lambda x, y: _added(x, y)), 1, F.size("units")),
    })
    return hashed.drop("ring").withColumns({"placed_sum": _total(F.col("placed")), "links_sum": _total(F.col("links"))})


def _replaced() -> Column:
    """A key for each place: the line with that place's unit deleted, the place, and the length."""
    return F.transform("placed", lambda x, i: F.xxhash64("kind", F.lit(2), F.size("units"), i, F.col("placed_sum") - x))


def _whole() -> Column:
    return F.xxhash64("kind", F.lit(3), F.size("units"), F.col("links_sum"))


def _shorter() -> Column:
    """A key for each place: the length and hash of the line that deleting its unit leaves."""
    gone = F.zip_with("links", F.slice("links", 2, F.size("units")), lambda x, y: x + y)
    kept = F.zip_with(F.slice(gone, 1, F.size("units")), "bridges", lambda x, y: F.col("links_sum") - x + y)
    return F.array_distinct(F.transform(kept, lambda x: F.xxhash64("kind", F.lit(3), F.size("units") - 1, x)))


def _within_one(a: Column, b: Column) -> Column:
    """Whether two sequences are within one edit, compared unit by unit."""
    long, short = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    same = F.zip_with(short, F.slice(long, 1, F.greatest(F.size(short), F.lit(1))), lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(same, F.lit(False))
    alike = F.when(at == 0, F.size(short)).otherwise(at - 1).cast("int")
    rest = lambda x, skip: F.slice(x, alike + 1 + skip, F.size(x) + 1)
    return F.when(F.size(a) == F.size(b), rest(a, 1) == rest(b, 1)).when(F.size(long) == F.size(short) + 1, rest(long, 1) == rest(short, 0)).otherwise(False)


def dedup_lines(docs: DataFrame, units: int = 10) -> DataFrame:
    """``docs`` with later copies and near-copies of lines cut from ``text``, and the columns lines and kept_lines.

    Rows are numbered and written first. Equal lines are counted once, under a digest of their words combined before
    the shuffle, so a line in a third of all documents is one row. Only lines that share an end with another go on to
    the deletion neighbourhood; the keys of a place's variants put all lines that differ there into one group, and each
    is linked with the group's earliest alone: those differ from it in that place at most. Links join units with units
    for the exact check. Joins are sort-merge at every size, so that the shuffle stays in proportion to the input.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    row, added, kept = free("_row", docs), free("lines", docs), free("kept_lines", docs)
    numbered = scratch.keep(docs.withColumn(row, F.monotonically_increasing_id()))
    line, place = F.col("line"), F.struct("doc_id", "row", "pos")
    each = numbered.select("doc_id", F.col(row).alias("row"), F.posexplode(_split(F.col("text"))).alias("pos", "line")).filter(~_blank(line))
    worded = each.select(place.alias("place"), _words(line).alias("words"))
    halves = F.array_distinct(F.flatten(F.transform(_forms(F.col("words"), units), _halves)))
    keyed = worded.select("place", F.unhex(F.md5(F.array_join("words", " "))).alias("key"), halves.alias("halves"))
    firsts = scratch.keep(keyed.groupBy("key").agg(F.min("place").alias("place"), F.first("halves").alias("halves")).select("place", "halves"))

    ends = firsts.select("place", F.explode("halves").alias("half"))
    shared = scratch.keep(ends.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half"))
    some = scratch.keep(ends.join(shared.hint("merge"), "half").select("place.row", "place.pos").distinct())
    lines = each.join(some.hint("merge"), ["row", "pos"]).select(place.alias("place"), F.explode(_forms(_words(line), units)).alias("form")).select("place", "form.*")
    lines = scratch.keep(_hashed(lines))
    scratch.drop(shared, some)

    replaced = scratch.keep(lines.filter("not short").select("place", "kind", F.explode(_replaced()).alias("key")))
    first = scratch.keep(replaced.groupBy("key").agg(F.min("place").alias("early"), F.count("*").alias("n")).filter("n > 1").select("key", "early"))
    pairs = replaced.join(first.hint("merge"), "key").select("kind", F.col("place").alias("late"), "early").filter("late != early").distinct()
    whole = lines.select(F.col("place").alias("whole"), _whole().alias("key"))
    cut = lines.filter("not short").select("kind", F.col("place").alias("cut"), F.explode(_shorter()).alias("key"))
    pairs = pairs.union(whole.hint("merge").join(cut, "key").select("kind", F.greatest("whole", "cut"), F.least("whole", "cut")).distinct())
    pairs = scratch.keep(pairs)
    other = lambda name, as_: lines.select("kind", F.col("place").alias(name), F.col("units").alias(as_)).hint("merge")
    near = pairs.join(other("late", "a"), ["kind", "late"]).join(other("early", "b"), ["kind", "early"]).filter(_within_one(F.col("a"), F.col("b")))
    near = scratch.keep(near.select(F.col("late").alias("place")).distinct())
    scratch.drop(replaced, first, lines, pairs)

    stay = scratch.keep(firsts.join(near.hint("merge"), "place", "left_anti").groupBy(F.col("place.row").alias("row")).agg(F.collect_list("place.pos").alias("stay")))
    scratch.drop(firsts, near)
    given = numbered.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given"), F.col("text").alias("text"), F.col(row).alias("row"))
    whole = given.join(stay.hint("merge"), "row", "left").withColumn("every", _split(F.col("text")))
    blank = F.filter(F.sequence(F.lit(0), F.size("every") - 1), lambda i: _blank(F.get("every", i)))
    whole = whole.withColumns({"blank": blank, "stay": F.coalesce("stay", F.array().cast("array<int>"))})
    text = F.when(F.col("text").isNotNull(), F.array_join(F.transform(F.array_sort(F.concat("blank", "stay")), lambda i: F.get("every", i)), "\n"))
    columns = [text.alias(c) if c == "text" else F.col(f"given.`{c}`") for c in docs.columns]
    return whole.select(*columns, F.coalesce(F.size("every") - F.size("blank"), F.lit(0)).alias(added), F.size("stay").alias(kept))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(documents(spark, sf_dir))
    return found.select("doc_id", "lines", "kept_lines", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


OP10_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, string_split(text, chr(10)) AS alls FROM documents WHERE text IS NOT NULL),
w AS (
  SELECT doc_id, pos, alls[pos + 1] AS line,
         list_filter(regexp_split_to_array(alls[pos + 1], '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM l),
f AS (
  SELECT ws, min({'d': doc_id, 'p': pos}) AS place FROM w WHERE len(ws) > 0 GROUP BY ws),
u AS (
  SELECT place, 'word' AS kind, ws AS us FROM f WHERE len(ws) >= 9
  UNION ALL
  SELECT place, 'letter', list_transform(range(1, length(t) + 1), lambda i: substring(t, i, 1))
  FROM (SELECT place, array_to_string(ws, ' ') AS t FROM f WHERE len(ws) < 10) WHERE length(t) >= 9),
v AS (
  SELECT place, kind, n, i, list_concat(us[1:i - 1], us[i + 1:]) AS cut
  FROM (SELECT *, len(us) AS n, unnest(range(1, len(us) + 1)) AS i FROM u WHERE len(us) >= 10)),
r AS (
  SELECT place FROM (SELECT place, min(place) OVER (PARTITION BY kind, n, i, cut) AS early FROM v) WHERE early < place),
s AS (
  SELECT CASE WHEN u.place < v.place THEN v.place ELSE u.place END AS place FROM v JOIN u ON u.us = v.cut AND u.kind = v.kind),
stay AS (
  SELECT place FROM f WHERE place NOT IN (SELECT place FROM r UNION SELECT place FROM s)),
k AS (
  SELECT w.doc_id, w.pos, w.line, len(w.ws) > 0 AS filled, stay.place IS NOT NULL AS stays
  FROM w LEFT JOIN stay ON stay.place = {'d': w.doc_id, 'p': w.pos})
SELECT d.doc_id,
       coalesce(count(*) FILTER (WHERE filled), 0)::INTEGER AS lines,
       coalesce(count(*) FILTER (WHERE stays), 0)::INTEGER AS kept_lines,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays OR NOT filled), '')) AS text_sha256
FROM documents d LEFT JOIN k ON k.doc_id = d.doc_id
GROUP BY d.doc_id
"""
