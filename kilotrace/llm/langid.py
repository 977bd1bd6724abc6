"""Language identification with a string kernel.

The blended-spectrum kernel counts the n-grams (of 1 to 3 bytes of lower-cased UTF-8) that two texts both hold,
divided by the root of the product of how many each holds. Kernel values against Nyström landmarks feed one-versus-rest
kernel ridge regression. A text is scored by one product of its n-gram presence with the fitted matrix.

Null texts, and texts without a letter, are ``und`` with score 0. Without usable training rows every text is ``und``.
Rows with a null language are predicted but teach nothing. Repeated rows get equal results; an empty table gives an
empty result; other columns are kept by ``identify``, whose own have an underscore after them where a name is taken.
Equal regression values go to the language that is first in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from kilotrace.llm.common import documents, free

ORDERS = 3
UNKNOWN = "und"


def codes(raw: bytes) -> np.ndarray:
    """The distinct n-grams of a text as numbers: bytes in base 256, with the length above them."""
    b = np.frombuffer(raw.lower(), np.uint8).astype(np.uint32)
    out, grams = [], np.zeros(len(b), np.uint32)
    for n in range(1, ORDERS + 1):
        if len(b) < n:
            break
        grams = (grams[: len(b) - n + 1] << 8) | b[n - 1 :]
        out.append(np.unique(grams) | np.uint32(n << 24))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # the landmarks' n-grams, sorted
    weights: np.ndarray  # one row per n-gram, one column per language

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        """Regression values of texts given by their n-grams: presence times weights, by the root of their sizes."""
        presence = np.zeros((len(found), len(self.grams)), np.float32)
        for row, grams in zip(presence, found, strict=True):
            at = np.searchsorted(self.grams, grams)
            at[at == len(self.grams)] = 0
            row[at[self.grams[at] == grams]] = 1
        sizes = np.array([max(len(g), 1) for g in found], np.float64)
        return (presence @ self.weights) / np.sqrt(sizes)[:, None]


def fit(rows: list[tuple[str, np.ndarray]], landmarks: int = 160, ridge: float = 1e-2) -> Model | None:
    """Kernel ridge regression on (language, n-grams of a text) rows over ``landmarks`` of them."""
    rows = [r for r in rows if len(r[1])]
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    by = {lang: [g for own, g in rows if own == lang] for lang in languages}
    chosen = [g for lang in languages for g in by[lang][: max(1, landmarks // len(languages))]]
    grams = np.unique(np.concatenate(chosen))
    spread = lambda found: np.stack([np.isin(grams, g, assume_unique=True) for g in found]).astype(np.float32)
    marks = spread(chosen) / np.sqrt([[len(g)] for g in chosen])
    inside = (marks @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(inside)
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    gram, right = np.zeros((good.sum(), good.sum())), np.zeros((good.sum(), len(languages)))
    count = {lang: len(g) for lang, g in by.items()}
    for at in range(0, len(rows), 256):
        part = rows[at : at + 256]
        mapped = (spread([g for _, g in part]) / np.sqrt([[len(g)] for _, g in part])) @ marks.T @ root
        target = np.array([[lang == own for own in languages] for lang, _ in part], float)
        weight = np.array([[len(rows) / (len(languages) * count[lang])] for lang, _ in part])  # languages weigh alike
        gram += (mapped * weight).T @ mapped
        right += (mapped * weight).T @ target
    solved = np.linalg.solve(gram + ridge * len(rows) / 100 * np.eye(len(gram)), right)
    return Model(languages, grams, (marks.T @ (root @ solved)).astype(np.float32))


def training_rows(labelled: DataFrame, per_language: int, languages: int | None) -> list[tuple[str, np.ndarray]]:
    """A sample of ``labelled`` (text, lang): the ``per_language`` distinct texts of least hash of each language, so
    that copies count once, each language has rows and a rerun takes the same. A text teaches as a whole: its distinct
    n-grams are found in the tasks, and those alone come to the driver. ``languages`` can bound the languages to those
    of the most rows."""
    usable = labelled.filter(F.col("lang").isNotNull() & _has_letter(F.col("text")))
    if languages is not None:
        usable = usable.join(F.broadcast(usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang")), "lang", "left_semi")
    hashed = usable.select("lang", "text", F.xxhash64(F.lit(8), "text").alias("h"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    least = hashed.select("lang", "h").distinct().withColumn("r", rank).filter(F.col("r") <= per_language)
    least = least.groupBy("lang").agg(F.max("h").alias("last"))  # as many rows as languages
    chosen = hashed.join(F.broadcast(least), "lang").filter("h <= last").dropDuplicates(["lang", "h"]).select("lang", "h", "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [codes(t.as_py().encode()).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["lang", "h", "grams"])

    taken = sorted(chosen.mapInArrow(grams, "lang string, h long, grams binary").collect(), key=lambda r: (r["h"], r["lang"]))
    return [(r["lang"], np.frombuffer(r["grams"], np.uint32)) for r in taken]


def _has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, labelled: DataFrame, per_language: int = 300, languages: int | None = None) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1: the language's share of the positive regression values), which come
    last, whatever their names (see above)."""
    model = fit(training_rows(labelled, per_language, languages))
    held = docs.sparkSession.sparkContext.broadcast(model)
    names, added = docs.columns, [free("lang_pred", docs), free("score", docs)]
    schema = StructType([*docs.schema.fields, StructField(added[0], StringType()), StructField(added[1], DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                predicted, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                letters, texts = part.column(len(names)), part.column(names.index("text"))
                rows = [i for i in range(part.num_rows) if letters[i].as_py() and model]
                if rows:
                    values = np.clip(model.scores([codes(texts[i].as_py().encode()) for i in rows]), 0, None) + 1e-9
                    best = values.argmax(axis=1)
                    score[rows] = values[np.arange(len(rows)), best] / values.sum(axis=1)
                    for i, k in zip(rows, best, strict=True):
                        predicted[i] = model.languages[k]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(predicted, pa.string()), pa.array(score)], names=[*names, *added])

    return docs.select("*", _has_letter(F.col("text")).alias(free("letter", docs))).mapInArrow(run, schema)


def remainder(doc_id: Column, of: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)))
    labelled = docs.filter(remainder(F.col("doc_id"), 4) != 2).select("text", "lang")
    return identify(docs.select("doc_id", "text", "held_out"), labelled).select("doc_id", "held_out", "lang_pred", "score")
