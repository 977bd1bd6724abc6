"""SentencePiece encoding and decoding over a relational lattice.

Distinct words' substrings of bounded length are joined with the piece table; the matches are the word's lattice. A
fold over its edges in Spark's higher-order aggregate gives the segmentation, and documents look their words up.

The given model is of the byte-pair kind, whose scores are merge ranks. The largest sum of scores (Viterbi) is not what
such a model encodes, so here the fold applies the lattice's edges as merges, best score first and leftmost among
equals; its result is the library's. The state is a bit mask of the word's piece boundaries.

Null and empty texts have no ids. Characters in no piece become byte pieces. Decoding gives the text back (a lower
one eighth block, which marks spaces, as a space). Rows with a null doc_id and repeated rows are encoded like any
other; an empty table gives an empty result; ``decode`` keeps other columns, and adds its own under a free name.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from kilotrace.llm.common import Scratch, chunks, documents, free, gathered, packed, unpacked

SPACE = "▁"
#: A boundary mask is one long, so words beyond this many characters are merged in Python, with a heap.
LONGEST = 62


@dataclass
class Pieces:
    """A model's piece table."""

    ranks: dict[str, int]  # by score, best first; equal scores share a rank
    ids: dict[str, int]
    late: set[str]
    byte_ids: list[int]
    spelling: list[bytes]
    longest: int
    words: re.Pattern

    def merged(self, word: str) -> list[int]:
        """The ids of one word of any length: merges from a heap, best first and leftmost among equals."""
        n = len(word)
        ends, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(a: int) -> None:
            b = ends[a]
            if b < n and (rank := self.ranks.get(word[a : ends[b]])) is not None and ends[b] - a > 1:
                heapq.heappush(heap, (rank, a, ends[b]))

        for a in range(n):
            offer(a)
        while heap:
            _, a, end = heapq.heappop(heap)
            if not alive[a] or ends[a] >= end or ends[ends[a]] != end:
                continue
            alive[ends[a]], ends[a] = False, end
            if end < n:
                before[end] = a
                offer(a)
            if before[a] >= 0:
                offer(before[a])
        out, a = [], 0
        while a < n:
            out += self.spelt(word[a : ends[a]])
            a = ends[a]
        return out

    def spelt(self, piece: str) -> list[int]:
        return [self.ids[piece]] if piece in self.ids else [self.byte_ids[b] for b in piece.encode()]


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    """Reads a byte-pair model with byte pieces, an identity normaliser and a space before each text."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    byte_ids, ids, scores, spelling = [0] * 256, {}, {}, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            spelling.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            spelling.append(b"")
        else:
            ids[piece], scores[piece] = i, model.get_score(i)
            spelling.append(piece.replace(SPACE, " ").encode())
    order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
    ranks = {p: order[s] for p, s in scores.items()}
    several = {c for p in ids if len(p) > 1 for c in p}
    if any(c not in ids for c in several) or any(not re.fullmatch(f"{SPACE}*[^{SPACE}]*", p) for p in ids):
        raise ValueError("pieces with inner spaces, or of characters that are no pieces, are not provided for")
    part = lambda x: len(x) == 1 or x in ranks
    rank = lambda x: ranks[x] if len(x) > 1 else -1
    late = {p for p in ids if any(part(p[:i]) and part(p[i:]) and max(rank(p[:i]), rank(p[i:])) >= ranks[p] for i in range(1, len(p)))}
    letters = "".join(re.escape(c) for c in sorted(several - {SPACE}))
    words = re.compile(f"{SPACE}*[{letters}]+|{SPACE}+|[^{SPACE}{letters}]", re.DOTALL)
    return Pieces(ranks, ids, late, byte_ids, spelling, max(map(len, ids)), words)


def units_of(texts: pa.Array, words: re.Pattern) -> tuple[pa.Array, np.ndarray]:
    """(units of all texts, one after the other; the end of each text's among them): stretches no piece crosses.

    A stretch after a space is known by its text alone, one after a line break by the break and its text; texts with
    white space beside white space are split by the model's words, which are known by a space and their text.
    """
    texts = pc.fill_null(texts, "")
    spaced = pc.replace_substring(texts, "\n", " \n")
    uneven = pc.match_substring_regex(spaced, f"^ |  | $|{SPACE}") if not words.fullmatch("\n\n") else pa.array([True] * len(texts))
    lists = pc.split_pattern(pc.if_else(uneven, "", spaced), " ")
    units, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy())
    sizes[pc.equal(texts, "").to_numpy(zero_copy_only=False)] = 0
    odd = np.flatnonzero(uneven.to_numpy(zero_copy_only=False))
    own = [[f" {w}" for w in words.findall(SPACE + t.as_py().replace(" ", SPACE))] for t in texts.take(pa.array(odd))]
    sizes[odd] = 0
    keep = pc.not_equal(units, "")  # what is left of empty and of uneven texts
    units = units.filter(keep)
    if own:
        ends = np.cumsum(sizes)
        parts, at = [], 0
        for i, found in zip(odd.tolist(), own, strict=True):
            parts += [units.slice(at, ends[i] - at), pa.array(found, units.type)]
            at = int(ends[i])
        units = pa.concat_arrays([*parts, units.slice(at)])
        sizes[odd] = [len(found) for found in own]
    return units, np.cumsum(sizes)


def spelt_out(unit: str) -> str:
    """The characters of a unit as the model has them."""
    return unit[1:] if unit[0] == " " else unit if unit[0] == "\n" else SPACE + unit


def _list(words: list[bytes]) -> bytes:
    """Words as one compressed value: how many, how long they are (byte plane by byte plane), and the bytes."""
    sizes = np.fromiter(map(len, words), "<u4", len(words))
    return zstandard.ZstdCompressor(level=3).compress(np.uint32(len(words)).tobytes() + sizes.view(np.uint8).reshape(-1, 4).T.tobytes() + b"".join(words))


def _listed(raw: bytes) -> pa.Array:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(raw[:4], "<u4")[0])
    sizes = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, 4).reshape(4, -1).T).view("<u4").ravel()
    return _strings(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), raw[4 + 4 * n :])


def _strings(offsets: np.ndarray, raw: bytes | np.ndarray) -> pa.Array:
    """The strings between offsets of ``raw``, which is not copied."""
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])


def _united(lists: list[pa.Array]) -> pa.Array:
    """The distinct units of several lists, in order."""
    every = pc.unique(pa.concat_arrays(lists))
    return every.take(pc.sort_indices(every))


def _blocks(docs: DataFrame, model: str, block_bytes: int, slices: int) -> DataFrame:
    """Blocks of documents: their texts as compressed numbers of units, the frequent ones first, and the units as
    compressed lists, one for each slice of their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer, made = load(model).words, zstandard.ZstdCompressor(level=3), 0
        for batch in batches:
            for part in chunks(batch, 1, block_bytes):
                units, ends = units_of(part.column(1), words)
                coded = units.dictionary_encode()
                indices, known = coded.indices.to_numpy(), coded.dictionary
                order = np.argsort(-np.bincount(indices, minlength=len(known)), kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                names = [w.encode() for w in known.take(pa.array(order)).to_pylist()]
                slice_ = np.fromiter((xxhash.xxh3_64_intdigest(w) % slices for w in names), np.uint16, len(names))
                lists = [_list([names[i] for i in np.flatnonzero(slice_ == s)]) for s in range(slices)]
                cells = [TaskContext.get().partitionId() << 33 | made, part.column(0).to_pylist(), packed(np.diff(ends, prepend=0)), packed(rank[indices]), packer.compress(slice_.tobytes()), lists]
                made += 1
                del part, units, coded, indices, known, order, rank, names
                pa.default_memory_pool().release_unused()
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 3, pa.list_(pa.binary())], strict=True)], names=["block", "ids", "lengths", "tokens", "slices", "words"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "block long, ids array<long>, lengths binary, tokens binary, slices binary, words array<binary>")


#: Words that travel in one row on their way to the lattice, and rows to a task: an exploded word is a thousand bytes.
ROW, ROWS = 1024, 48
#: Words whose edges Spark collects in a hash table before it sorts all edges instead (by default 128). A task has few.
HASHED = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


def _distinct(table: pd.DataFrame) -> pd.DataFrame:
    """The distinct units of a slice, in order, ROW to a row."""
    every = _united([_listed(raw) for raw in table["words"]]).to_pylist()
    at = range(0, len(every), ROW)
    lists = pd.Series([[spelt_out(w) for w in every[i : i + ROW]] for i in at], dtype=object)
    return pd.DataFrame({"slice": np.full(len(at), table["slice"].iloc[0]), "row": np.arange(len(at)), "words": lists})


#: A lattice edge is one long: rank, start, end and whether it is late, from the highest bits down.
RANK, START, END = 1 << 20, 1 << 10, 1 << 2


def _folded(edges: Column, length: Column) -> Column:
    """The mask of a word's boundaries (bit i: before character i) after all merges of its lattice.

    ``edges`` are sorted by rank, then start. An edge merges two pieces if both its ends are boundaries and one boundary
    lies between. One pass over the edges is exact as long as no edge comes to fit after its turn; only late edges can,
    whose piece can also be made of pieces that come after it. The pass marks, in the sign bit, a word where one does;
    there each merge looks anew for the best edge.
    """
    one = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.cast("int"))
    start, end = lambda x: F.shiftright(x, 10).bitwiseAND(F.lit(1023)), lambda x: F.shiftright(x, 2).bitwiseAND(F.lit(255))
    shape = lambda x: F.struct(x.alias("edge"), (one(start(x)) + one(end(x))).alias("ends"), (one(end(x)) - one(start(x) + 1)).alias("inner"))
    masks, late = F.transform(edges, shape), F.transform(F.filter(edges, lambda x: x % 2 == 1), shape)
    fits = lambda b, e: (b.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(b.bitwiseAND(e["inner"])) == 1)
    merge = lambda b, e: b.bitwiseAND(F.bitwise_not(e["inner"]))
    mark = lambda b, e: F.when(F.exists(late, lambda x: (x["edge"] < e["edge"]) & fits(b, x)), b.bitwiseOR(F.lit(-(2**63)))).otherwise(b)
    every = one(length + 1) - 1
    once = F.aggregate(masks, every, lambda b, e: F.when((b >= 0) & fits(b, e), mark(merge(b, e), e)).otherwise(b))
    anew = F.aggregate(F.sequence(F.lit(1), length), every, lambda b, _: F.coalesce(merge(b, F.get(F.filter(masks, lambda e: fits(b, e)), F.lit(0))), b))
    return F.aggregate(F.array(once), F.lit(0).cast("long"), lambda _, b: F.when(b < 0, anew).otherwise(b))


def word_masks(rows: DataFrame, model: str) -> DataFrame:
    """(slice, at, cuts) of the words of ``rows`` (slice, row, words) of up to LONGEST characters: the word's place in
    its slice, and the mask of its piece boundaries. Words that no merge applies to are left out.

    The piece table has as many rows as the vocabulary and is broadcast. Rows of words are spread by hash once;
    exploding, joining and grouping stay within that partitioning.
    """
    pieces = load(model)
    table = [(p, pieces.ranks[p] * RANK + (p in pieces.late)) for p in pieces.ids if len(p) > 1]
    table = F.broadcast(rows.sparkSession.createDataFrame(table, "piece string, rank long"))
    tasks = max(1, -(-rows.count() // ROWS))  # a number, so that small compressed inputs are not put together again
    each = rows.repartition(tasks, "slice", "row").select("slice", "row", F.posexplode("words").alias("i", "word")).withColumn("n", F.length("word")).filter(F.col("n").between(2, LONGEST))
    starts = each.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 2)).alias("s"))
    spans = starts.select("*", F.explode(F.sequence(F.col("s") + 2, F.least(F.col("n"), F.col("s") + pieces.longest))).alias("e"))
    lattice = spans.withColumn("piece", F.substring("word", F.col("s") + 1, F.col("e") - F.col("s"))).join(table, "piece")
    edge = F.col("rank") + F.col("s") * START + F.col("e") * END
    grouped = lattice.groupBy("slice", "row", "i", "n").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    return grouped.select("slice", (F.col("row") * ROW + F.col("i")).alias("at"), _folded(F.col("edges"), F.col("n")).alias("cuts"))


def _spelt(units: pa.Array, masks: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, sizes, flat): where each unit's ids stand in ``flat``, given the masks of the units' boundaries (0: no
    merge applies, or the unit is too long for a mask). All units are cut and looked up together."""
    if not len(units):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    bare = pc.if_else(pc.starts_with(units, "\n"), units, pc.binary_join_element_wise(SPACE, units, ""))
    words = pc.if_else(pc.starts_with(units, " "), pc.utf8_slice_codeunits(units, 1), bare)  # as spelt_out
    bounds = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset)
    raw = np.frombuffer(words.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    n = pc.utf8_length(words).to_numpy().astype(np.int64)
    letters, of = np.flatnonzero((raw & 0xC0) != 0x80), np.repeat(np.arange(len(n)), n)
    within = np.minimum(np.arange(len(of)) - (np.cumsum(n) - n)[of], LONGEST)
    opens = np.flatnonzero(np.where(masks == 0, -1, masks)[of] >> within & 1)
    offsets = np.append(letters[opens], len(raw))
    at = pc.index_in(_strings(offsets, raw), value_set=pa.array(pieces.ids.keys(), pa.string())).fill_null(-1).to_numpy()
    known = at >= 0
    counts = np.where(known, 1, np.diff(offsets))  # a piece that is none is spelt in bytes
    flat, whole = np.empty(counts.sum(), np.int32), np.repeat(known, counts)
    flat[whole] = np.fromiter(pieces.ids.values(), np.int32, len(pieces.ids))[at[known]]
    flat[~whole] = np.array(pieces.byte_ids, np.int32)[gathered(offsets[:-1][~known], counts[~known], raw)]
    sizes = np.bincount(of[opens], counts, len(n)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    more, total = [flat], len(flat)
    for i in np.flatnonzero(n > LONGEST).tolist():
        more.append(np.array(pieces.merged(words[i].as_py()), np.int32))
        starts[i], sizes[i], total = total, len(more[-1]), total + len(more[-1])
    return starts, sizes, np.concatenate(more)


def encode(docs: DataFrame, model: str, block_bytes: int = 6 << 20, slice_bytes: int = 32 << 20, then=None) -> DataFrame:
    """(doc_id, ids array<int>) of ``docs`` (doc_id, text), as the library encodes.

    One pass makes blocks of documents, of bounded size: the texts as numbers of distinct words, and the words in
    slices of their hash, about one for ``slice_bytes`` of text. A slice's distinct words, of all blocks, are segmented
    once, each one's mask goes back to the blocks that hold it, and those spell their texts. The blocks are written in
    buckets, so that the texts are never shuffled; words travel as compressed lists. ``then``: a (function of record
    batches, schema) that the last tasks apply to the result.
    """
    scratch = Scratch(docs.sparkSession, "pieces")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = min(8 + size // slice_bytes, 1 << 16)
    blocks = scratch.keep_bucketed(_blocks(docs, model, block_bytes, slices), "block")
    lists = blocks.select("block", F.posexplode("words").alias("slice", "words"))
    rows = scratch.keep(lists.groupBy("slice").applyInPandas(_distinct, "slice int, row int, words array<string>"))
    before = docs.sparkSession.conf.get(HASHED)
    docs.sparkSession.conf.set(HASHED, ROW * ROWS)
    try:
        cuts = scratch.keep(word_masks(rows, model))
    finally:
        docs.sparkSession.conf.set(HASHED, before)
    scratch.drop(rows)

    def back(own: pd.DataFrame, cuts: pd.DataFrame) -> pd.DataFrame:
        known = [_listed(raw) for raw in own["words"]]
        every = _united(known)
        masks = np.zeros(len(every), "<i8")
        masks[cuts["at"].to_numpy()] = cuts["cuts"].to_numpy()
        planes = [np.ascontiguousarray(masks[pc.index_in(words, value_set=every).to_numpy()].view(np.uint8).reshape(-1, 8).T).tobytes() for words in known]
        return pd.DataFrame({"block": own["block"], "slice": own["slice"], "masks": [zstandard.ZstdCompressor(level=3).compress(x) for x in planes]})

    found = lists.groupBy("slice").cogroup(cuts.groupBy("slice")).applyInPandas(back, "block long, slice int, masks binary")
    found = found.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("slice", "masks"))).alias("found"))
    ready = blocks.join(found.hint("merge"), "block", "left")
    after, kinds = then or (lambda x: x, "doc_id long, ids array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, lengths, tokens = batch.column(0)[i].values, unpacked(batch.column(1)[i].as_py()), unpacked(batch.column(2)[i].as_py())
                of = np.argsort(np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column(3)[i].as_py()), np.uint16), kind="stable")
                masks = {x["slice"]: np.frombuffer(zstandard.ZstdDecompressor().decompress(x["masks"]), np.uint8).reshape(8, -1) for x in batch.column(5)[i].as_py() or []}
                units = [_listed(raw.as_py()) for raw in batch.column(4)[i].values]
                own = [np.ascontiguousarray(masks[k].T).view("<i8").ravel() if k in masks else np.zeros(len(x), np.int64) for k, x in enumerate(units)]
                first, n, flat = _spelt(pa.concat_arrays(units), np.concatenate(own), pieces)
                sizes, starts = np.empty_like(n), np.empty_like(n)
                sizes[of], starts[of] = n, first
                ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
                for a in range(0, len(ids), 500):  # so many documents at a time
                    b = min(a + 500, len(ids))
                    own = tokens[ends[a] : ends[b]]
                    total = np.concatenate([[0], np.cumsum(sizes[own])])
                    out = gathered(starts[own], sizes[own], flat)
                    offsets = total[ends[a : b + 1] - ends[a]]
                    yield after(pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out, pa.int32()))], names=["doc_id", "ids"]))

    return ready.select("ids", "lengths", "tokens", "slices", "words", "found").mapInArrow(run, kinds)


def spelling(ids: pa.Array, pieces: Pieces) -> list[bytes | None]:
    """The UTF-8 bytes that lists of ids spell, without the space that encoding puts first."""
    flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.fromiter(map(len, pieces.spelling), np.int64, len(pieces.spelling))
    raw = gathered((np.cumsum(sizes) - sizes)[flat], sizes[flat], np.frombuffer(b"".join(pieces.spelling), np.uint8)).tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes[flat])])
    counts = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
    places = ends[counts].tolist()
    return [raw[a + (raw[a : a + 1] == b" ") : b] if ok else None for a, b, ok in zip(places, places[1:], ids.is_valid().to_pylist(), strict=False)]


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the UTF-8 bytes that the ids spell (null ids: null). Where that name is taken, the
    added column has an underscore after it."""
    names, at, added = encoded.columns, encoded.columns.index(ids), free("decoded", encoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spelling(batch.column(at), load(model)), pa.binary())], names=[*names, added])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(added, BinaryType())]))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids' number and CRC-32 (as little-endian unsigned 32-bit), and the decoded text's SHA-256."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(1)
        sums = [zlib.crc32(x.values.to_numpy().astype("<u4")) for x in ids]
        back = [hashlib.sha256(x).hexdigest() for x in spelling(ids, load(model))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(sums, pa.int64()), pa.array(back)], names=["doc_id", "n_ids", "ids_crc32", "decoded_sha256"])

    return encode(documents(spark, sf_dir), model, then=(digest, "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string"))
