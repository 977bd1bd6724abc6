"""The trie of conversation prefixes, from padded matrices of turn numbers.

A turn is known by the MD5 of its role and text, so texts are read once and not moved. Conversations are dealt to range
shards by their sequence of turns (and by conv_id among equals, so that copies of one conversation fill many shards).
A shard numbers its turns, puts the numbers into padded matrices, sorts those by numpy's lexsort, and marks where the
columns change, a change holding for all columns after it: so nodes begin. Every depth is then aggregated by reduceat.
The nodes that hold a shard's first or last conversation may go on in a neighbour; they leave the shard as parts, are
put together by their prefix, and give what hangs below them on to their parents.

Rows with a null conv_id belong to no conversation and are left out. Turns of equal number are ordered by that MD5.
Turns that repeat in a conversation stay. A conversation whose first-of-hundred is missing keeps what follows its own
first h turns; one left without turns is a member of the root alone. An empty table gives an empty result, without a
root. Other columns of the input are left aside. A conversation's numbers, 20 bytes a turn, are one row; the digest of
the conversations that end in a node reads their ids in order, whatever their number, a few thousand bytes at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilotrace.llm.common import Scratch

#: Columns of a padded matrix; rows that are still equal and go on are sorted by the next ones.
WIDTH = 16
#: Bytes of turn digests in a shard.
SHARD_BYTES = 48 << 20
#: Bytes of a piece of the ids that end in a node.
PIECE = 4096
#: Nodes between shards, up to which they go to all tasks (under 6 MB); beyond, they are joined by shuffle.
BROADCAST_ROWS = 100_000
EMPTY = hashlib.sha256(b"").hexdigest()

#: What a shard gives. kind 0: a node; 1: a node whose parent is cut; 2: part of a cut node; 3: ids that end in one.
SHARD = "kind int, shard long, piece long, key binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, length long, ends binary"
_KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.binary()]
_NAMES = [x.split(" ")[0] for x in SHARD.split(", ")]


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, lengths): each rebuilt conversation's turns, 16 bytes each, and their texts' code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), digest.alias("digest"), F.length(text).alias("length"))
    own = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    # one shuffle: by the hundred, in which both a conversation and the one it takes its first turns from are whole
    own = own.withColumn("root", F.col("conv_id") - F.col("conv_id") % 100).repartition("root")
    own = own.groupBy("root", "conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    heads = own.filter("conv_id = root").select("root", F.slice("turns", 1, 5).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    after = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    turns = F.concat(F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0)), after)  # a missing head is an empty one
    out = own.join(heads.hint("merge"), "root", "left").select("conv_id", turns.alias("turns"))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    return out.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["length"]).alias("lengths"))


def ordered(turns: np.ndarray, starts: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows in the order of their sequences, given order among equals; turns that each shares with the one before it).

    ``turns`` has the rows' turn numbers (from 1) one after the other. Matrices are WIDTH columns wide, 0 where a row
    has ended, so that what is a prefix comes first. Rows that differ from both neighbours leave after a matrix.
    """
    order, shared = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    first = np.zeros(len(starts), np.int64)  # where each place's run of equal rows begins
    at, column = np.arange(len(starts)), 0
    while len(at):
        rows = order[at]
        place = column + np.arange(WIDTH)
        inside = place[None, :] < depth[rows][:, None]
        matrix = np.where(inside, turns[np.where(inside, starts[rows][:, None] + place[None, :], 0)], 0) if len(turns) else np.zeros(inside.shape, np.int64)
        run = first[at]
        by = np.lexsort((*matrix.T[::-1], run))
        order[at], matrix = rows[by], matrix[by]
        change = np.zeros(matrix.shape, bool)
        change[1:] = matrix[1:] != matrix[:-1]
        change = np.logical_or.accumulate(change, axis=1)
        new = np.ones(len(at), bool)
        new[1:] = run[1:] != run[:-1]
        shared[at[~new]] = column + (~change[~new]).sum(axis=1)
        begins = new | change[:, -1]
        first[at] = at[np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))]
        sizes = np.bincount(np.cumsum(begins) - 1)
        goes_on = np.maximum.reduceat(depth[order[at]], np.flatnonzero(begins)) > column + WIDTH
        at, column = at[np.repeat((sizes > 1) & goes_on, sizes)], column + WIDTH
    d = depth[order]
    shared[1:] = np.minimum(shared[1:], np.minimum(d[1:], d[:-1]))
    return order, shared


def _prefix_keys(path: bytes) -> list[bytes]:
    """A key for each prefix of a sequence of turns, the empty one first."""
    h = hashlib.md5()
    out = [h.digest()]
    for i in range(0, len(path), 16):
        h.update(path[i : i + 16])
        out.append(h.digest())
    return out


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def shard_nodes(number: int, ids: np.ndarray, paths: pa.Array, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard's conversations, depth by depth from the deepest. ``lengths``: of all turns, in a row."""
    offsets = np.frombuffer(paths.buffers()[1], np.int64)[paths.offset : paths.offset + len(paths) + 1]
    depth, starts = np.diff(offsets) // 16, (offsets[:-1] - offsets[0]) // 16
    raw = np.frombuffer(paths.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    digests = np.ascontiguousarray(raw).view([("a", ">u8"), ("b", ">u8")])
    known, turns = np.unique(digests, return_inverse=True)  # numbers rise with the digests, as the shards do
    given = np.argsort(ids, kind="stable")
    order, shared = ordered(turns.ravel() + 1, starts[given], depth[given])
    order = given[order]
    ids, depth, starts = ids[order], depth[order], starts[order]
    n = len(ids)
    first_keys, last_keys = (_prefix_keys(paths[int(order[i])].as_py()) for i in (0, n - 1))
    leaf, saved, child = (np.zeros(n, np.int64) for _ in range(3))
    falling = np.argsort(-depth, kind="stable")
    upto, active, below = 0, np.zeros(0, np.int64), None

    def batch(kind: int, size: int, **columns) -> pa.RecordBatch:
        columns |= {"kind": [kind] * size, "shard": [number] * size}
        return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * size), k) for c, k in zip(_NAMES, _KINDS, strict=True)], names=_NAMES)

    for d in range(int(depth.max()), -1, -1):
        to = int(np.searchsorted(-depth[falling], -d, "right"))
        active, upto = np.sort(np.concatenate([active, falling[upto:to]])), to
        at = np.flatnonzero(shared[active] < d) if d else np.zeros(1, np.int64)
        begin = active[at]
        members, least = np.diff(np.append(at, len(active))), np.minimum.reduceat(ids[active], at)
        children = np.add.reduceat(child[active], at)
        length = lengths[starts[begin] + d - 1] if d else np.zeros(1, np.int64)
        ends = np.add.reduceat((depth[active] == d).astype(np.int64), at)
        # a node that holds the shard's first or last row is cut: the others are whole
        cut = np.zeros(len(at), bool)
        cut[0] |= active[0] == 0
        cut[-1] |= active[-1] == n - 1
        own = (members - 1) * length
        whole = begin[~cut]
        leaf[whole] += children[~cut] == 0
        saved[whole] += own[~cut]
        leaves, sums = np.add.reduceat(leaf[active], at), np.add.reduceat(saved[active], at)
        keys = [(first_keys if active[0] == 0 and i == 0 else last_keys)[d] if c else None for i, c in enumerate(cut.tolist())]
        if below is not None:
            # now that their parents are known, the nodes one deeper leave
            b_begin, columns = below
            parent = np.searchsorted(begin, b_begin, "right") - 1
            for kind in (0, 1):
                some = np.flatnonzero(cut[parent] == bool(kind))
                if len(some):
                    extra = {"parent": [keys[p] for p in parent[some].tolist()]} if kind else {"parent_conv_id": least[parent[some]]}
                    yield batch(kind, len(some), **{k: (v[some] if isinstance(v, np.ndarray) else [v[i] for i in some.tolist()]) for k, v in columns.items()}, **extra)
        child[:] = 0
        child[whole] = 1
        digest = [hashlib.sha256(_joined(ids[active[a : a + e]])).digest() if e else None for a, e in zip(at[~cut].tolist(), ends[~cut].tolist(), strict=True)]
        below = (whole, {"depth": np.full(len(whole), d), "conv_id": least[~cut], "n_convs": members[~cut], "n_children": children[~cut], "n_leaves": leaves[~cut], "saved_tokens": sums[~cut], "ends": digest})
        for i in np.flatnonzero(cut).tolist():
            up = (first_keys if active[0] == 0 and i == 0 else last_keys)[d - 1] if d else None
            yield batch(2, 1, key=[keys[i]], parent=[up], depth=[d], conv_id=[int(least[i])], n_convs=[int(members[i])], n_children=[int(children[i])], n_leaves=[int(leaves[i])], saved_tokens=[int(sums[i])], length=[int(length[i])])
            inside = active[at[i] : at[i] + members[i]]
            leaf[inside] = saved[inside] = 0  # counted here; what is above adds this node's sum up
            text = _joined(ids[inside[: ends[i]]])
            for a in range(0, len(text), 64 * PIECE):
                places = range(a, min(a + 64 * PIECE, len(text)), PIECE)
                yield batch(3, len(places), key=[keys[i]] * len(places), piece=list(places), ends=[text[b : b + PIECE] for b in places])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [b for b in batches if b.num_rows]
    if parts:
        table = pa.Table.from_batches(parts).combine_chunks()
        lengths = table.column("lengths").chunk(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ids, paths = table.column("conv_id").to_numpy().astype(np.int64), table.column("path").chunk(0).cast(pa.large_binary())
        yield from shard_nodes(TaskContext.get().partitionId(), ids, paths, lengths)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come one after the other: a comma stands between two shards'."""
    key, shard, h = None, None, None
    give = lambda: pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])], names=["key", "ends_sha256"])
    for batch in batches:
        for k, s, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
            if k != key:
                if h is not None:
                    yield give()
                key, shard, h = k, s, hashlib.sha256()
            if s != shard:
                h.update(b",")
                shard = s
            h.update(text)
    if h is not None:
        yield give()


def _put_together(table: pd.DataFrame) -> pd.DataFrame:
    """The cut nodes: parts summed by key, then each node's sums given on to its parent, from the deepest up."""
    nodes = table.groupby("key", sort=False).agg(parent=("parent", "first"), depth=("depth", "first"), conv_id=("conv_id", "min"), n_convs=("n_convs", "sum"), n_children=("n_children", "sum"), n_leaves=("n_leaves", "sum"), saved_tokens=("saved_tokens", "sum"), length=("length", "first"))
    nodes = nodes.sort_values("depth", ascending=False, kind="stable").reset_index()
    at = {k: i for i, k in enumerate(nodes["key"])}
    children, leaves, saved = (nodes[c].tolist() for c in ("n_children", "n_leaves", "saved_tokens"))
    members, length, least = nodes["n_convs"].tolist(), nodes["length"].tolist(), nodes["conv_id"].tolist()
    up = [at[p] if d else -1 for p, d in zip(nodes["parent"], nodes["depth"], strict=True)]
    for i, p in enumerate(up):
        leaves[i] += not children[i]
        saved[i] += (members[i] - 1) * length[i]
        if p >= 0:
            children[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    above = pd.array([least[p] if p >= 0 else None for p in up], dtype="Int64")
    return pd.DataFrame({"key": nodes["key"], "depth": nodes["depth"], "conv_id": least, "parent_conv_id": above, "n_convs": members, "n_children": children, "n_leaves": leaves, "saved_tokens": saved})


def prefix_trie(conversations: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node of the
    rebuilt ``conversations`` (conv_id, turn, role, text).

    Parts of cut nodes, two a shard and depth, meet in one task: as many as shards have depths, not conversations.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark, "prefixes")
    rows = scratch.keep(rebuilt(conversations))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("path") + 64), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    found = scratch.keep(rows.repartitionByRange(shards, "path", "conv_id").select("conv_id", "path", "lengths").mapInArrow(_shards, SHARD))
    scratch.drop(rows)
    parts = found.filter("kind = 2").select("key", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "length", F.lit(0).alias("every"))
    put = parts.groupBy("every").applyInPandas(_put_together, "key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    put = scratch.keep(put)
    pieces = found.filter("kind = 3").select("key", "shard", "piece", "ends").repartition("key").sortWithinPartitions("key", "shard", "piece")
    digests = pieces.mapInArrow(_digests, "key binary, ends_sha256 string")
    numbers = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    whole = F.coalesce(F.lower(F.hex("ends")), F.lit(EMPTY)).alias("ends_sha256")
    inner = found.filter("kind = 0").select("conv_id", "depth", "parent_conv_id", *numbers, whole)
    between = put.join(digests, "key", "left").select("conv_id", "depth", "parent_conv_id", *numbers, F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    # a node under a cut one takes the parent's smallest member from the parts put together
    hung = found.filter("kind = 1").drop("key", "parent_conv_id").withColumnRenamed("parent", "key")
    least = put.select("key", F.col("conv_id").alias("parent_conv_id"))
    if put.count() <= BROADCAST_ROWS:
        hung = hung.join(F.broadcast(least), "key")
    else:  # by shard too, since many nodes hang below the root
        hung = hung.join(found.filter("kind = 2").select("shard", "key").distinct().join(least, "key"), ["shard", "key"])
    hung = hung.select("conv_id", "depth", "parent_conv_id", *numbers, whole)
    return inner.union(hung).union(between)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: The CRC-32 of the decimal c, bit by bit: each byte comes in with the first of its eight steps. Fixed value: the polynomial.
_CRC = """xor(list_reduce([4294967295::BIGINT] || flatten([[ord(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0] for x in string_split(c::VARCHAR, '')]),
  lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)), 4294967295::BIGINT)"""

OP13_SQL = f"""WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m, turn FROM conversations WHERE conv_id IS NOT NULL),
  k AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, m) AS k FROM t),
  cs AS (SELECT c, {_CRC} % 6 AS h FROM (SELECT DISTINCT c FROM t)),
  r AS (SELECT cs.c, 0 AS part, k, text, m FROM cs JOIN k ON k.c = cs.c - cs.c % 100 AND k.k <= h UNION ALL SELECT cs.c, 1, k, text, m FROM cs JOIN k ON k.c = cs.c AND k.k > h),
  p AS (SELECT c, string_agg(m, '') OVER w AS prefix, row_number() OVER w AS d, length(text) AS n FROM r WINDOW w AS (PARTITION BY c ORDER BY part, k ROWS UNBOUNDED PRECEDING)),
  m AS (SELECT c, prefix, d, n FROM p UNION ALL SELECT c, '', 0, 0 FROM cs),
  last AS (SELECT c, arg_max(prefix, d) AS prefix FROM m GROUP BY c),
  ends AS (SELECT prefix, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS s FROM last GROUP BY prefix),
  nodes AS (SELECT prefix, d AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n FROM m GROUP BY prefix, d),
  kids AS (SELECT left(prefix, 32 * (depth - 1)::INT) AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
  every AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (prefix)),
  sums AS (SELECT a.prefix, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.n)::BIGINT AS saved_tokens FROM every a JOIN every b ON starts_with(b.prefix, a.prefix) GROUP BY a.prefix)
  SELECT e.conv_id, e.depth, u.conv_id AS parent_conv_id, e.n_convs, e.n_children, sums.n_leaves, sums.saved_tokens, coalesce(ends.s, '{EMPTY}') AS ends_sha256
  FROM every e JOIN sums USING (prefix) LEFT JOIN ends USING (prefix) LEFT JOIN nodes u ON e.depth > 0 AND u.prefix = left(e.prefix, 32 * (e.depth - 1)::INT)"""
