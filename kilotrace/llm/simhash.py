"""SimHash near-duplicates: fingerprints of word shingles, linked by a self-join of a binary trie.

Null and blank texts have the fingerprint zero, and link like any other. Rows repeated whole are copies of one
another. An empty table gives an empty result; other columns of the input are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilotrace.llm.common import Scratch, connected, documents, mixed, seeded

BITS = 64
#: Hashes turned into bit counts at once; a very long text needs no more memory than its words and this.
BLOCK = 1 << 16
#: Bits by which a level of the trie walk goes down.
STEP = 5


def _counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit, the highest first."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprint(raw: bytes | None, shingle: int, words: int = 1) -> list[int]:
    """SimHash of one text: a bit is 1 if over half the shingle hashes have it. Each of ``words`` has 64 bits; those
    after the first take the hashes mixed with a seed."""
    found = (raw or b"").lower().split()
    if not found:
        return [0] * words
    joined, lengths = b" ".join(found), np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(found) - shingle + 1)
    starts, ends = starts[:n], ends[min(shingle, len(found)) - 1 :]
    ones, digest = np.zeros((words, BITS), np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist(), strict=True)], np.uint64)
        for w in range(words):
            ones[w] += _counts(mixed(hashes + seeded(w)) if w else hashes)
    return [int.from_bytes(np.packbits(2 * own > n).tobytes(), "big") for own in ones]


def fingerprints(docs: DataFrame, shingle: int = 5, words: int = 1) -> DataFrame:
    """(doc_id, fp array<long>): the fingerprint's words of 64 bits, as signed longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle, words) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(fps), pa.list_(pa.int64()))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, fp array<long>")


def levels(budget: int) -> tuple[list[int], list[int]]:
    """Where the trie walks start, and the depths (in bits) at which a walk may have 0, 1, ... ``budget`` errors.

    Of ``budget + 1`` blocks in a ring, one start always exists from which the first j blocks hold at most
    j * budget / (budget + 1) of the errors (the pigeonring principle), that is fewer than j.
    """
    m = budget + 1
    cuts = [-(-BITS * j // m) for j in range(m + 1)]
    sizes = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
    depths = [min(sum(sizes[(s + i) % m] for i in range(j)) for s in range(m)) for j in range(1, m + 1)]
    return cuts[:m], depths


def _apart(x: Column, y: Column) -> Column:
    """The differing bits of two fingerprints."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, n: a + n)


def trie_links(leaves: DataFrame, budget: int, scratch: Scratch, words: int = 1, total: int | None = None) -> DataFrame:
    """(a, b) of ``leaves`` (fp, node), a < b, each once, whose fingerprints differ in ``total`` bits at most (of one
    word: ``budget``) and in one word at least by ``budget`` at most.

    Each word is walked from ``budget + 1`` starting bits, as a binary trie joined with itself. A walk's frontier is a
    table of (node, node, errors). It begins with the nodes of the first level, each paired with itself; a level takes
    every pair to the pairs of its nodes' children, adds their differing bits and drops what exceeds the level's
    budget, so a pair of subtrees is dropped once, and written, each level is one step to recover. A node's children
    are a bit mask. The walk stops where nodes hold hardly more than one leaf, so its depth grows with the data, and
    the pairs that are left meet leaf by leaf.
    """
    if budget == 0:
        same = leaves.select("node", F.posexplode("fp").alias("word", "bits")).alias("l")
        pairs = same.join(same.alias("r"), ["word", "bits"]).select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).filter("a < b").distinct()
    else:
        pairs = _walked(leaves, budget, scratch)
    if words > 1:
        sides = [leaves.select(F.col("node").alias(k), F.col("fp").alias(f"f{k}")).hint("merge") for k in "ab"]
        pairs = pairs.join(sides[0], "a").join(sides[1], "b").filter(_apart(F.col("fa"), F.col("fb")) <= (budget if total is None else total)).select("a", "b")
    return pairs


def _walked(leaves: DataFrame, budget: int, scratch: Scratch) -> DataFrame:
    starts, depths = levels(budget)

    def turned(bits: Column, s: int) -> Column:
        return bits if s == 0 else F.shiftleft(bits, s).bitwiseOR(F.shiftrightunsigned(bits, BITS - s))

    turns = F.transform("fp", lambda bits, w: F.array(*[F.struct((w * len(starts) + i).alias("walk"), turned(bits, s).alias("path")) for i, s in enumerate(starts)]))
    walks = leaves.select("node", F.explode(F.flatten(turns)).alias("w")).select("node", "w.*")
    prefix = lambda path, depth: path if depth == BITS else F.shiftrightunsigned(path, BITS - depth)
    allowed = lambda depth: next(k for k, d in enumerate(depths) if depth <= d)
    deepest = int(np.log2(max(2, leaves.count()))) + 3  # of eight nodes there, about one holds a leaf
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)

    depth, before = depths[0], []
    now = walks.groupBy("walk", prefix(F.col("path"), depth).alias("u")).agg(F.count("*").alias("n")).filter("n > 1").select("walk", "u", F.col("u").alias("v"), F.lit(0).alias("e"))
    while depth < min(deepest, depths[-1]):
        step = min(STEP, BITS - depth)
        kid = prefix(F.col("path"), depth + step).bitwiseAND(F.lit((1 << step) - 1)).cast("int")
        nodes = walks.groupBy("walk", prefix(F.col("path"), depth).alias("p")).agg(F.bit_or(one(kid)).alias("kids"))
        side = lambda k: nodes.select("walk", F.col("p").alias(k), F.col("kids").alias(f"kids_{k}")).hint("merge")
        has = lambda mask, i: F.call_function("shiftrightunsigned", mask, i).bitwiseAND(F.lit(1)) == 1
        room, most = F.lit(allowed(depth + step)) - F.col("e"), allowed(depth + step)
        flips = lambda k: F.array(*[F.lit(x) for x in range(1 << step) if x.bit_count() <= k])
        chosen = flips(most)
        for k in range(most - 1, -1, -1):
            chosen = F.when(room <= k, flips(k)).otherwise(chosen)
        both = now.join(side("u"), ["walk", "u"]).join(side("v"), ["walk", "v"]).withColumn("flips", chosen)
        left = both.withColumn("i", F.explode(F.array(*[F.lit(i) for i in range(1 << step)]))).filter(has(F.col("kids_u"), F.col("i")))
        right = left.withColumn("x", F.explode("flips")).withColumn("j", F.col("i").bitwiseXOR(F.col("x")))
        right = right.filter(has(F.col("kids_v"), F.col("j")) & ((F.col("u") != F.col("v")) | (F.col("i") <= F.col("j"))))
        down = lambda k, i: F.shiftleft(F.col(k), step).bitwiseOR(F.col(i)).alias(k)
        after = scratch.keep(right.select("walk", down("u", "i"), down("v", "j"), (F.col("e") + F.bit_count("x")).alias("e")))
        scratch.drop(*before)
        now, before, depth = after, [after], depth + step

    side = lambda k, name, path: walks.select("walk", prefix(F.col("path"), depth).alias(k), F.col("node").alias(name), F.col("path").alias(path)).hint("merge")
    errors = lambda depth: F.bit_count(prefix(F.col("p").bitwiseXOR(F.col("q")), depth))
    within = F.col("a") != F.col("b")
    for k, d in enumerate(depths):
        within = within & (errors(d) <= k) if d > depth else within
    met = now.select("walk", "u", "v").join(side("u", "a", "p"), ["walk", "u"]).join(side("v", "b", "q"), ["walk", "v"])
    met = met.filter(within & (errors(BITS) <= budget)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return scratch.keep(met)


def near_duplicates(docs: DataFrame, shingle: int = 5, budget: int = 4, words: int = 1, total: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id, copies): the class of every row of ``docs``.

    Rows of one fingerprint are a numbered leaf of the trie, so a group of copies of any size takes part once, and rows
    with a null or repeated doc_id link like any other. component_id is the smallest doc_id that links reach (null, if
    no row there has one). ``copies`` counts the leaf's rows.

    With one word, links are exactly the pairs of at most ``budget`` differing bits. With several, a pair is linked if
    one word at least is within ``budget`` and all differ in ``total`` bits at most: more words find more of the less
    similar pairs, at the cost of as many more walks.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    fps = scratch.keep(fingerprints(docs, shingle, words))
    leaves = fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    leaves = scratch.keep(leaves.withColumn("node", F.monotonically_increasing_id()))
    labels = connected(trie_links(leaves.select("fp", "node"), budget, scratch, words, total), scratch)
    classes = scratch.keep(leaves.join(labels.hint("merge"), "node", "left").select("fp", F.coalesce("label", "node").alias("class"), "least", "copies"))
    least = scratch.keep(classes.groupBy("class").agg(F.min("least").alias("component_id")))
    named = scratch.keep(classes.join(least.hint("merge"), "class").select("fp", "component_id", "copies"))
    scratch.drop(leaves, classes, least)
    return fps.join(named.hint("merge"), "fp").select("doc_id", "fp", "component_id", "copies")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir), shingle=4, budget=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.get("fp", F.lit(0))), 16, "0")).alias("fingerprint"), "component_id")
