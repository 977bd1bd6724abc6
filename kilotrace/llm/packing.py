"""Best-fit-decreasing packing of tokenised documents into sequences.

Null texts count as empty: one closing token. Repeated rows, and rows with a null doc_id, are packed each on its own.
Other columns of the input are left aside. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kilotrace.llm.common import Scratch, chunks, documents, gathered

#: The token that closes a document.
END = b"\0\0\0\0"
#: Entries a worker's cache of encoded stretches may hold before it starts anew; it bounds memory, not results.
CACHE = 800_000
#: Bytes of text encoded at once (a longer text is taken alone).
CHUNK = 6 << 20
#: White space, Unicode's included, next to other white space or at an end: such texts are split with more care.
BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNEVEN = f"^{BLANK}|{BLANK}$|{BLANK}{BLANK}"
#: A stretch without white space but for the line break before it; so many of them are encoded as one text.
PLAIN = re.compile(r"\n?\S+\Z")
GROUP = 1000
#: How the vocabulary writes a space and a line break. Fixed values.
SPACE_BREAK = "ĠĊ"
BOUNDARY = re.compile(r"(?<=\S)(?=[ \n]\S)")


class Encoder:
    """Token ids of whole texts, many at a time.

    The tokenizer always starts a token at a lone space or line break between two visible characters, so a text's
    stretches between those are encoded once per worker and then looked up. A stretch that follows a space is known
    by its text alone, one that follows a line break by the break and its text, a text's first between two spaces.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        #: Whether a token starts with a space or a line break, so that it starts a stretch.
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token[0] in SPACE_BREAK

    @staticmethod
    def spelt(key: str) -> str:
        return key[1:-1] if key[0] == " " else key if key[0] == "\n" else f" {key}"

    def _learn(self, keys: list[str]) -> None:
        """Encodes stretches that are new. Those without inner white space are encoded GROUP at a time, in one text."""
        plain, others = [], []
        for k in keys:
            (plain if PLAIN.match(k) else others).append(k)
        groups = [plain[at : at + GROUP] for at in range(0, len(plain), GROUP)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(["".join(map(self.spelt, g)) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            raw, at = ids.tobytes(), (4 * np.flatnonzero(self.opens[ids])).tolist()
            self.known.update(zip(group, (raw[a:b] for a, b in zip(at, [*at[1:], len(raw)], strict=True)), strict=True))
        ids = self.tokenizer.encode_batch_fast([self.spelt(k) for k in others], add_special_tokens=False)
        self.known.update((k, np.array(e.ids, "<u4").tobytes()) for k, e in zip(others, ids, strict=True))

    def _found(self, keys: list[str]) -> list[bytes]:
        if len(self.known) > CACHE:
            self.known.clear()
        look = self.known.get
        out = [look(k) for k in keys]
        new = [i for i, x in enumerate(out) if x is None]
        self._learn([keys[i] for i in new])
        for i in new:
            out[i] = self.known[keys[i]]
        return out

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; the end of each text's among them)."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        uneven = pc.match_substring_regex(texts, UNEVEN)
        lists = pc.split_pattern(pc.replace_substring(pc.if_else(uneven, "", texts), "\n", " \n"), " ")
        units, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = units.dictionary_encode()
        codes, keys = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        keys = [k or "  " for k in keys]  # an empty stretch is an empty text's
        place: dict[str, int] = {}
        firsts = [place.setdefault(f" {u} ", len(place)) for u in units.take(pa.array(ends[:-1])).to_pylist()]
        codes[ends[:-1]] = np.array(firsts, np.int64) + len(keys)
        odd = np.flatnonzero(uneven.to_numpy(zero_copy_only=False))
        parts, at = [], 0
        for i in odd.tolist():  # each such text has one empty stretch so far
            found = BOUNDARY.split(texts[i].as_py())
            found = [f" {found[0]} ", *(w[1:] if w[0] == " " else w for w in found[1:])]
            own = np.array([place.setdefault(w, len(place)) for w in found], np.int64) + len(keys)
            parts += [codes[at : ends[i]], own]
            at = ends[i] + 1
        if parts:
            sizes = np.diff(ends)
            sizes[odd] = [len(own) for own in parts[1::2]]
            codes, ends = np.concatenate([*parts, codes[at:]]), np.concatenate([[0], np.cumsum(sizes)])
        raw = self._found([*keys, *place])
        lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        each = lengths[codes]
        ids = gathered((np.cumsum(lengths) - lengths)[codes], each, np.frombuffer(b"".join(raw), "<u4"))
        return ids, np.concatenate([[0], np.cumsum(each)])[ends[1:]]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path)


def pieces(docs: DataFrame, vocabulary: str, size: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, rank) of every document, cut where it is longer than ``size``
    tokens; rank numbers the pieces of a length within the part, the task that wrote them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part_id, seen, crc32 = encoder(vocabulary), TaskContext.get().partitionId(), Counter(), zlib.crc32
        for batch in batches:
            for part in chunks(batch, 1, CHUNK):
                ids, ends = own.batch(part.column(1))
                at, rows, ids = 0, [], memoryview(ids).cast("B")
                for doc, end in zip(part.column(0).to_pylist(), ends.tolist(), strict=True):
                    n = end - at + 1  # with the closing token
                    cuts = [0, *range(n % size or size, n + 1, size)]
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        crc = crc32(ids[4 * (at + a) : 4 * min(at + b, end)])
                        rows.append((doc, i, a, b - a, crc if b < n else crc32(END, crc), seen[b - a]))
                        seen[b - a] += 1
                    at = end
                doc, piece, start, length, crc, rank = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part_id] * len(doc), pa.int32()), pa.array(rank, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long")


class Capacities:
    """A segment tree over remaining capacities: finds the least open capacity of at least n in logarithmic time."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, capacity: int, bins: int) -> None:
        i = capacity + self.leaves
        while i:
            self.open[i] += bins
            i //= 2

    def tightest(self, least: int) -> int | None:
        i = least + self.leaves
        if self.open[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


def best_fit(counts: list[tuple[int, int]], size: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing for ``counts`` of (length, documents): rows (length, from, documents, bin, offset).

    The documents of a length numbered from ``from`` go one each into the bins from ``bin``, at ``offset``. Bins of
    one history are interchangeable, so that a step moves a whole run of them: the result is that of packing one
    document at a time, and work and rows depend on ``size`` (at most size² runs), not on the number of documents.
    """
    tree, runs, used, out = Capacities(size), {}, 0, []
    for length, left in sorted(counts, reverse=True):
        rank = 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                start, n, capacity = used, left, size
                used += n
            else:
                start, there = runs[capacity].pop()
                n = min(left, there)
                if there > n:
                    runs[capacity].append((start + n, there - n))
                tree.add(capacity, -n)
            out.append((length, rank, n, start, size - capacity))
            if rest := capacity - length:
                # neighbours of the same history join into one run
                own = runs.setdefault(rest, [])
                if own and own[-1][0] + own[-1][1] == start:
                    own[-1] = (own[-1][0], own[-1][1] + n)
                else:
                    own.append((start, n))
                tree.add(rest, n)
            rank, left = rank + n, left - n
    return out


def pack(docs: DataFrame, vocabulary: str, size: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece.

    Only the histogram of lengths, at most ``size`` rows, reaches the driver, where best-fit decreasing packs it with
    multiplicities. Its runs come back as one array per length (a broadcast that ``size`` bounds, whatever the number
    of documents). Each piece then finds its bin by its number among the pieces of its length. Numbers are dealt per
    task and written with the pieces, so that every later plan reads the same ones, then shifted by the counts of the
    parts before, so that no length is gathered in a task.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.keep(pieces(docs, vocabulary, size))
    counts = scratch.keep(cut.groupBy("length", "part").agg(F.count("*").alias("n")))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = scratch.keep(counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("shift")))
    histogram = [tuple(r) for r in counts.groupBy("length").agg(F.sum("n")).collect()]
    runs: dict[int, list] = {}
    for length, rank, n, start, offset in best_fit(histogram, size):
        runs.setdefault(length, []).append((rank, start, offset))
    plan = spark.sparkContext.broadcast({k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in runs.items()})

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(6).to_numpy() + batch.column(7).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                ranks, starts, offsets = plan.value[int(length[rows[0]])]
                i = np.searchsorted(ranks, rank[rows], "right") - 1
                sequence[rows], offset[rows] = starts[i] + rank[rows] - ranks[i], offsets[i]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=names)

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return cut.join(shifts.hint("merge"), ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", "part", "rank", "shift").mapInArrow(seat, f"{kinds}, sequence_id long, offset long")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
