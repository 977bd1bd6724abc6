"""License scans: winnowed fingerprints pick candidates, and alignment reports coverage and spans.

Texts and templates are sequences of words, lower-cased (A-Z) and without punctuation at their ends. Fingerprints are
hashes of word runs, of which each window of neighbours gives its smallest. A template's run of
``window + run - 1`` words or more in a text always shares one, whatever stands around it.

Null and blank texts hold no license. Repeated rows, and rows with a null doc_id, are reported alike. An empty table
gives an empty result; other columns are left aside. A place where several templates fit (one that begins another) is
reported for each. Templates of one name are one license with several texts; rows with a null in them are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilotrace.llm.common import chunks, documents
from kilotrace.llm.templates import usual_templates

EDGES = ".,;:!?()[]{}<>\"'*#/-_|"
PRIME = np.uint64(0x9E3779B185EBCA87)
#: Bytes of text taken at once (a longer text is taken alone).
CHUNK = 4 << 20


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts, each one's bounds, and each word's place among its text's space-separated words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    coded = words.dictionary_encode()
    known = coded.dictionary.to_pylist()
    trimmed = [w.strip(EDGES) for w in known]
    keep = np.array([bool(w) for w in trimmed] or [False])[coded.indices.to_numpy()] if len(words) else np.zeros(0, bool)
    real = np.array([bool(w) for w in known] or [False])[coded.indices.to_numpy()] if len(words) else np.zeros(0, bool)
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in trimmed] or [0], np.uint64)
    first = np.concatenate([[0], np.cumsum(real)])
    place = first[:-1] - np.repeat(first[ends[:-1]], np.diff(ends))
    values = hashes[coded.indices.to_numpy()[keep]] if len(words) else np.zeros(0, np.uint64)
    return values, np.concatenate([[0], np.cumsum(keep)])[ends], place[keep]


def fingerprints(words: np.ndarray, run: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the winnowed word runs of one or many texts one after the other."""
    n = len(words) - run + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = np.zeros(n, np.uint64)
    for i in range(run):
        grams = grams * PRIME + words[i : i + n]
        grams ^= grams >> np.uint64(29)
    if n < window:
        chosen = np.array([int(grams.argmin())])
    else:
        views = np.lib.stride_tricks.sliding_window_view(grams, window)
        chosen = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    return grams[chosen], chosen


class Template:
    """A template's words as bits, for alignments of whole rows at a time."""

    def __init__(self, words: np.ndarray, coverage: float):
        self.words, self.n, self.full = words, len(words), (1 << len(words)) - 1
        self.need = max(1, int(np.ceil(coverage * self.n - 1e-9)))
        #: Words that a text may have more than the template, and fewer.
        self.more, self.less = 1 + self.n // 2, self.n - self.need
        self.forward: dict[int, int] = {}
        self.backward: dict[int, int] = {}
        for j, w in enumerate(words.tolist()):
            self.forward[w] = self.forward.get(w, 0) | 1 << j
            self.backward[w] = self.backward.get(w, 0) | 1 << (self.n - 1 - j)

    def _lengths(self, masks: list[int]) -> tuple[int, int]:
        """(longest common subsequence with the words of ``masks``, how many of them it takes at the least).

        A row of the table of common subsequences is a number: its bit j is 0 where the row rises after template word
        j. A word changes it by an addition, so a step takes all of the template at once; no band is left out.
        """
        row, full, best, at = self.full, self.full, 0, 0
        for i, mask in enumerate(masks, 1):
            if mask:
                up = row & mask
                row = ((row + up) | (row - up)) & full
                if (length := self.n - row.bit_count()) > best:
                    best, at = length, i
        return best, at

    def align(self, text: list[int]) -> tuple[int, int, int]:
        """(words matched, first, end) of the best alignment with a stretch of text: of those that match most the one
        that ends first, and of those the one that begins last."""
        matched, end = self._lengths([self.forward.get(w, 0) for w in text])
        _, back = self._lengths([self.backward.get(w, 0) for w in text[:end][::-1]])
        return matched, end - back, end


def scan(docs: DataFrame, templates: DataFrame | None = None, coverage: float = 0.8, run: int = 3, window: int = 2, index_bytes: int = 64 << 20) -> DataFrame:
    """(doc_id, license, start_word, end_word, matched, template_words, coverage), a row for each place in a text.

    ``templates`` (license, text) is a table; without one, the usual licenses. Words are numbered from 0 among the
    text's space-separated words; the end is exclusive. The inverted index of the templates' fingerprints goes to
    every task, so templates of more than ``index_bytes`` are refused; a text takes one pass.

    A place holds ``coverage`` of the template's words in order, in a stretch with at most half as many words more as
    the template has, wherever they stand: so a paragraph in its middle parts nothing. Every shared fingerprint is a
    candidate; the stretch around it is aligned in full, if it has enough of the template's words at all. Places of a
    template do not overlap: the next begins after the end of the one before. A template must have ``run + window - 1``
    words at least, so that every text that holds it unparted shares a fingerprint.
    """
    templates = usual_templates(docs.sparkSession) if templates is None else templates
    templates = templates.select("license", "text").dropna().distinct()
    size = templates.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > index_bytes:
        raise ValueError(f"templates of {size} bytes: the index is for {index_bytes} at most")
    rows = sorted((r["license"], r["text"]) for r in templates.collect())
    names, bodies = [n for n, _ in rows], [Template(hashed_words(pa.array([text]))[0], coverage) for _, text in rows]
    if short := [n for n, body in zip(names, bodies, strict=True) if body.n < run + window - 1]:
        raise ValueError(f"templates of fewer than {run + window - 1} words: {short}")
    index: dict[int, list[tuple[int, int]]] = {}
    for t, body in enumerate(bodies):
        for h, at in zip(*fingerprints(body.words, run, window), strict=True):
            index.setdefault(int(h), []).append((t, int(at)))
    keys = np.array(sorted(index), np.uint64)

    def of_text(words: np.ndarray, anchors: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        shifts: dict[int, list[tuple[int, int]]] = {}
        for key, at in anchors:
            for t, place in index[key]:
                shifts.setdefault(t, []).append((at, at - place))
        found = []
        for t, every in shifts.items():
            body, done, seen = bodies[t], 0, None
            has = np.concatenate([[0], np.cumsum(np.isin(words, body.words))])
            for at, shift in every:
                if at < done:
                    continue
                low = max(done, shift - body.more, 0)
                if low == seen:
                    continue
                seen, high = low, min(len(words), max(low, shift) + body.n + body.more)
                if has[high] - has[low] < body.need:
                    continue
                m, a, b = body.align(words[low:high].tolist())
                if m >= body.need and b - a <= body.n + body.more:
                    found.append((t, low + a, low + b, m))
                    done, seen = low + b, None
        return sorted(found)

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in chunks(whole, 1, CHUNK)):
            words, ends, place = hashed_words(batch.column(1))
            grams, at = fingerprints(words, run, window)
            hit = keys[np.minimum(np.searchsorted(keys, grams), len(keys) - 1)] == grams if len(keys) else np.zeros(len(grams), bool)
            grams, at = grams[hit], at[hit]
            owner = np.searchsorted(ends, at, "right") - 1  # rises with the place
            cuts = np.flatnonzero(np.diff(owner, prepend=-1))
            rows = []
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(owner)], strict=False):
                doc = int(owner[lo])
                first, last = ends[doc], ends[doc + 1]
                own = list(zip(grams[lo:hi].tolist(), (at[lo:hi] - first).tolist(), strict=True))
                for t, a, b, m in of_text(words[first:last], own):
                    rows.append((batch.column(0)[doc].as_py(), names[t], int(place[first + a]), int(place[first + b - 1]) + 1, m, bodies[t].n, m / bodies[t].n))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "license", "start_word", "end_word", "matched", "template_words", "coverage"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")))
    return rows.mapInArrow(scan_batches, "doc_id long, license string, start_word long, end_word long, matched long, template_words long, coverage double")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
