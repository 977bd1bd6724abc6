"""Language-model scores from a log-frequency Bloom filter of word pairs.

Words are lower-cased (A-Z); each document ends with one closing token. The base is an additive unigram model from
exact counts. The model interpolates word-pair counts with it: P(w | u) = (q(u, w) + m P(w)) / (c(u) + e + m). Pair
counts are quantised to powers of two: a pair seen c times is in the filter at levels 1 to 1 + floor(log2 c), a lookup
probes level after level until one is missing, and q is 2^(level - 1), so at most c but where the filter errs. e is what
its errors add to a context's counts on the average, so that the probabilities of all words after u sum to 1 at most.

Null texts count as empty, so they hold the closing token alone. Repeated rows are scored like any other; so are rows
with a null doc_id, which teach too. Without training
documents N is 0 and every token has the base's uniform probability. An empty table gives an empty result; other
columns are left aside.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilotrace.llm.common import Scratch, documents, mixed, packed, unpacked
from kilotrace.llm.langid import remainder

#: Stands for the closing token; no word holds a space.
END = b" "
#: The hash of the context before a document's first word.
START = np.uint64(0x9E3779B97F4A7C15)
#: Sets a pair's first word apart from its second. Odd.
FACTOR = np.uint64(0xC4CEB9FE1A85EC53)


def _pairs(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * FACTOR + word)


class Filter:
    """The filter's bits in slices, each of its own size. A key's probes come from two hashes of the key and level."""

    def __init__(self, sizes: list[int], bits: np.ndarray, probes: int):
        self.sizes, self.bits, self.probes = np.array(sizes, np.uint64), bits, probes
        self.starts = np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def size(items: int, bits_per_item: int) -> int:
        """Bits of a slice: whole bytes, never none."""
        return 8 * (items * bits_per_item // 8 + 8)

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, bits_per_item: int, probes: int) -> tuple[int, bytes]:
        """The size and bits of one slice that holds ``keys`` at their levels."""
        top = np.frexp(counts.astype(np.float64))[1]  # 1 + floor(log2)
        size = cls.size(int(top.sum()), bits_per_item)
        own, flags = cls([size], np.zeros(0, np.uint8), probes), np.zeros(size, bool)
        for level in range(1, int(top.max(initial=0)) + 1):
            for at in own._places(keys[top >= level], 0, level):
                flags[at] = True
        return size, np.packbits(flags, bitorder="little").tobytes()

    def _places(self, keys: np.ndarray, part: np.ndarray | int, level: int) -> Iterator[np.ndarray]:
        first = mixed(keys + np.uint64(level * int(START) % 2**64))
        step, sizes, starts = mixed(first) | np.uint64(1), self.sizes[part], self.starts[part]
        for i in range(self.probes):
            yield starts + (first + np.uint64(i) * step) % sizes

    def count(self, keys: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """The least count of each key's highest level in its slice; 0 where level 1 is missing."""
        out, left, level = np.zeros(len(keys)), np.arange(len(keys)), 1
        while len(left):
            there = np.ones(len(left), bool)
            for at in self._places(keys[left], parts[left], level):
                there &= ((self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
            left = left[there]
            out[left] = 2 ** (level - 1)
            level += 1
        return out


BLOCK = "block long, ids array<long>, held binary, lengths binary, tokens binary, words array<binary>, learnt array<long>"
#: Bits of a pair's key within its slice. Slices have bounded numbers of keys, so at any size few keys meet by chance.
KEY = np.uint64((1 << 40) - 1)


#: Above every count of a word.
COUNT = 1 << 42
#: Tokens scored at once.
CHUNK = 1 << 19


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks of documents, dictionary-coded: each distinct word once, and the texts as compressed word numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)) // block_bytes
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1), batch.num_rows]
            for at, to in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(at, to - at)
                lists = pc.ascii_split_whitespace(pc.ascii_lower(part.column(1)))
                words, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
                filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # ends of a text give empty words
                before = np.concatenate([[0], np.cumsum(filled)])[ends - ends[0]]
                coded = words.filter(pa.array(filled)).dictionary_encode()
                indices = coded.indices.to_numpy()
                order = np.argsort(-np.bincount(indices, minlength=len(coded.dictionary)), kind="stable")  # frequent words first
                rank = np.empty(len(order), np.int32)
                rank[order] = np.arange(1, len(order) + 1)
                known = [END, *(w.encode() for w in coded.dictionary.take(pa.array(order)).to_pylist())]
                lengths = np.diff(before) + 1
                closing = np.zeros(lengths.sum(), bool)
                closing[np.cumsum(lengths) - 1] = True
                tokens = np.zeros(len(closing), np.int32)
                tokens[~closing] = rank[indices]
                held = np.array(part.column(2).to_pylist(), bool)
                learnt = np.bincount(tokens[np.repeat(~held, lengths)], minlength=len(known))
                row = [TaskContext.get().partitionId() << 33 | made, part.column(0).to_pylist(), held.tobytes(), lengths.astype(np.int32).tobytes(), packed(tokens), known, learnt.tolist()]
                made += 1
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 3, pa.list_(pa.binary()), pa.list_(pa.int64())], strict=True)], names=["block", "ids", "held", "lengths", "tokens", "words", "learnt"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")), F.col("held_out")).mapInArrow(run, BLOCK)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one at a time: each is a block."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _read(row: dict) -> tuple[list[int | None], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, held, lengths, tokens and the hashes of the words of a block."""
    tokens = unpacked(row["tokens"])
    return row["ids"], np.frombuffer(row["held"], bool), np.frombuffer(row["lengths"], np.int32), tokens, np.array([xxhash.xxh64_intdigest(w) for w in row["words"]], np.uint64)


def _context(tokens: np.ndarray, lengths: np.ndarray, values: np.ndarray, start) -> np.ndarray:
    """The value of each token's predecessor; ``start`` before a document's first."""
    own = values[tokens]
    before = np.concatenate([own[:1], own[:-1]])
    before[np.cumsum(lengths) - lengths] = start
    return before


def _sliced(keys: np.ndarray, slices: int) -> tuple[np.ndarray, np.ndarray]:
    """The slice of each pair, and its key there."""
    return (keys % np.uint64(slices)).astype(np.int64), (keys >> np.uint64(20)) & KEY


def _group(hashes: np.ndarray, groups: int) -> np.ndarray:
    return (mixed(hashes) % np.uint64(groups)).astype(np.int64)


def errors(before: np.ndarray, vocabulary: int, bits_per_item: int, probes: int) -> np.ndarray:
    """What a filter's errors add to the counts of the words after one of count ``before``: each level is found by
    mistake at ``rate``, after level 0 of the words not seen there, after their own level of those seen."""
    rate = (1 - math.exp(-probes / bits_per_item)) ** probes
    return (vocabulary + before) * rate / (1 - 2 * rate)


def score(docs: DataFrame, prior: float = 500.0, bits_per_item: int = 12, probes: int = 7, filter_bytes: int = 256 << 20, block_bytes: int = 12 << 20) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of ``docs`` (doc_id, text, held_out).

    Documents with held_out false teach. Blocks of documents carry each of their words once: word counts come from an
    aggregate over those, and go back to the blocks by a join on the word, so no vocabulary is held whole anywhere.
    Pairs are counted by slices of their hash, which tasks turn into slices of the filter.

    The filter is broadcast. A pair of count c takes at most c items, so its size is at most ``bits_per_item`` bits a
    training token; where that could pass ``filter_bytes``, the pairs are put in groups by their second word, and the
    groups are broadcast one after the other: a token is scored in the pass of its own group, and passes are summed.
    Words beyond 64-bit hash collisions (pairs only; word counts are exact) are told apart.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    blocks = scratch.keep(_blocks(docs, block_bytes))
    counts = blocks.select(F.explode(F.arrays_zip("words", "learnt")).alias("x")).select("x.*").filter("learnt > 0").groupBy("words").agg(F.sum("learnt").alias("c"))
    counts = scratch.keep(counts)
    total, vocabulary, teachers = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.max(F.when(F.col("words") == F.lit(END), F.col("c"))), F.lit(0))).first()
    groups = max(1, math.ceil(total * bits_per_item / 8 / filter_bytes))
    slices = max(8, math.ceil(total / groups / 1_500_000))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for row in _rows(batch):
                _, held, lengths, tokens, hashes = _read(row)
                use = np.repeat(~held, lengths)
                part, keys = _sliced(_pairs(_context(tokens, lengths, hashes, START)[use], hashes[tokens[use]]), slices)
                of = _group(hashes, groups)[tokens[use]] * slices + part
                order = np.lexsort((keys, of))
                keys, of = keys[order], of[order]
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
                at = np.flatnonzero(new)
                if not len(at):
                    continue  # a block of held-out documents alone
                n, keys, of = np.diff(np.append(at, len(new))).astype(np.uint32), keys[at], of[at]
                cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])[: len(of)])
                spans = list(zip(cuts, [*cuts[1:], len(of)], strict=True))
                low, high = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), (keys >> np.uint64(32)).astype(np.uint8)
                columns = [[low[a:b].tobytes() for a, b in spans], [packer.compress(high[a:b].tobytes()) for a, b in spans], [packer.compress(n[a:b].tobytes()) for a, b in spans]]
                yield pa.RecordBatch.from_arrays([pa.array([int(of[a]) for a, _ in spans], pa.int64()), *[pa.array(c, pa.binary()) for c in columns]], names=["slice", "low", "high", "n"])

    def build(key, table):
        flat = lambda name, kind: np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind) for x in table[name]])
        keys = np.concatenate([np.frombuffer(x, np.uint32) for x in table["low"]]).astype(np.uint64) | flat("high", np.uint8).astype(np.uint64) << np.uint64(32)
        n = flat("n", np.uint32)
        keys, back = np.unique(keys, return_inverse=True)
        size, bits = Filter.of(keys, np.bincount(back, n), bits_per_item, probes)
        return pd.DataFrame({"slice": [key[0]], "size": [size], "bits": [bits]})

    read = blocks.select("ids", "held", "lengths", "tokens", "words")
    made = read.mapInArrow(pairs, "slice long, low binary, high binary, n binary").groupBy("slice").applyInPandas(build, "slice long, size long, bits binary")
    made = scratch.keep(made)
    words = blocks.select("block", F.posexplode("words").alias("at", "words")).join(counts, "words", "left")
    # a word's place in its block and its count share a long
    known = words.filter("c is not null").groupBy("block").agg(F.collect_list(F.col("at").cast("long") * COUNT + F.col("c")).alias("c"))
    ready = blocks.select("block", "ids", "held", "lengths", "tokens", "words").join(known, "block", "left")
    ready = scratch.keep(ready) if groups > 1 else ready
    floor = total + 0.1 * (vocabulary + 1)

    def passed(group: int) -> DataFrame:
        sizes, parts = [Filter.size(0, bits_per_item)] * slices, {}
        for r in made.filter(F.expr(f"slice div {slices}") == group).toLocalIterator():
            sizes[r["slice"] % slices], parts[r["slice"] % slices] = r["size"], r["bits"]
        bits = np.frombuffer(b"".join(parts.get(i) or bytes(sizes[i] // 8) for i in range(slices)), np.uint8)
        held_filter = spark.sparkContext.broadcast((sizes, bits))
        del bits, parts

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sizes, bits = held_filter.value
            own = Filter(sizes, bits, probes)
            for batch in batches:
                for row in _rows(batch):
                    ids, held, lengths, tokens, hashes = _read(row)
                    c, found = np.zeros(len(hashes)), np.array(row["c"] or [], np.int64)
                    c[found // COUNT] = found % COUNT
                    base = (c + 0.1) / floor
                    logs, ends, a = np.log10(base), np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), 0
                    while a < len(ids):
                        b = max(a + 1, int(np.searchsorted(ends, ends[a] + CHUNK, "right")) - 1)
                        part, sizes_ = tokens[ends[a] : ends[b]], lengths[a:b]
                        here = _group(hashes, groups)[part] == group
                        before = _context(part, sizes_, c, teachers)
                        slice_, keys = _sliced(_pairs(_context(part, sizes_, hashes, START)[here], hashes[part[here]]), slices)
                        pair = np.zeros(len(part))
                        pair[here] = np.minimum(own.count(keys, slice_), np.minimum(before, c[part])[here])
                        model = np.where(here, np.log10((pair + prior * base[part]) / (before + errors(before, vocabulary, bits_per_item, probes) + prior)), 0)
                        starts, n = ends[a:b] - ends[a], b - a
                        sums = [np.add.reduceat(x, starts) for x in (logs[part], model, (c > 0)[part].astype(np.int64))]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row["block"])), pa.array(np.arange(a, b)), pa.array(ids[a:b], pa.int64()), pa.array(held[a:b]), pa.array(sizes_.astype(np.int64)), pa.array(sums[2]), pa.array(sums[0]), pa.array(sums[1])], names=["block", "place", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
                        a = b

        return ready.mapInArrow(run, "block long, place long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")

    if groups == 1:
        out = passed(0)
    else:
        first = [F.first(x).alias(x) for x in ("doc_id", "held_out", "n_tokens", "n_known", "base_score")]
        every = None
        for group in range(groups):
            part = scratch.keep(passed(group))
            every = part if every is None else every.union(part)
        out = every.groupBy("block", "place").agg(*first, F.sum("score").alias("score"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(remainder(F.col("doc_id"), 10) == 0, F.lit(False))
    return score(documents(spark, sf_dir).select("doc_id", "text", held.alias("held_out")))
