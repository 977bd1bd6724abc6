"""Token counts, whitening and the prefix trie against plain versions, with the awkward cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest


def ids(spark, texts):
    return spark.createDataFrame([(None if i == 3 else i, t, "x", 7) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string, kind int")


def test_token_counts(spark, monkeypatch):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from kilotrace.llm import tokens as T

    path, r = P.path("byte_bpe_50k.json"), random.Random(1)
    library = Tokenizer.from_file(path)
    alphabet = [*" \n\t  '''srtmdvel abcXYZ019.,!-é漢字  \u0085\x1c\x0b😀ñßअं٣½Ⅷ_<|>", "<|endoftext|>", "<|endof", "'re", "'ve", "'ll", "'s", " '"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(1500)]
    texts += ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0xA0, 0x3000), r.randrange(0x10000, 0x1FFFF)])) for _ in range(200)) for _ in range(60)]
    texts += ["<|endoftext|>" * 3, "", "a<|endoftext|>", "x" * 3000, "ab" * 2000, "-" * 999, " " * 500 + "a", "\n" * 300, None, "same", "same", "it's we're you'll o'clock"]
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    got = T.count_tokens(ids(spark, texts), path).collect()
    assert [r.n_tokens for r in got] == want and [r.n_bytes for r in got] == [len((t or "").encode()) for t in texts]
    assert [r.over_limit for r in got] == [n > 512 for n in want] and [r.doc_id for r in got][:5] == [0, 1, 2, None, 4]
    assert T.count_tokens(ids(spark, []), path).collect() == []
    own = T.Counter(path)
    monkeypatch.setattr(T, "PIECE", 200)
    monkeypatch.setattr(T, "STATES", 300)  # long texts in pieces, and states given up again and again
    import pyarrow as pa

    for t, n in zip(texts, want, strict=True):
        if len((t or "").encode()) > 200:
            assert own.batch(pa.array([t]))[0] == n


def test_chunk_maps_compose():
    from kilotrace.llm import tokens as T

    r = np.random.default_rng(2)
    classes = r.integers(0, 11, 5000).astype(np.uint8)
    state, begins = T.FRESH, np.zeros(len(classes), bool)
    for i, c in enumerate(classes.tolist()):
        state, here, before = T._step(state, c)
        begins[i] |= here
        if before:
            begins[i - 1] = True
    assert (T.marked(classes) == begins).all()


def test_secular_updates():
    from kilotrace.llm.whitening import Spectrum

    r = np.random.default_rng(3)
    tables = [np.floor(64 * r.normal(size=(400, 24)) * 0.15), np.ones((50, 8)), np.repeat(np.eye(8), 20, 0), r.normal(size=(300, 6)) @ np.diag([1, 1e-3, 1e3, 1, 1, 0]), r.normal(size=(3, 12))]
    for x in tables:
        v = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
        for block in (1, 7, 1000):
            s = Spectrum(x.shape[1])
            for at in range(0, len(x), block):
                s.rows(x[at : at + block])
            size = max(1e-300, s.values[0])
            assert np.abs(s.vectors.T @ s.vectors - np.eye(len(v))).max() < 1e-12 and s.n == len(x)
            assert np.abs(s.vectors * s.values @ s.vectors.T - v).max() <= 1e-12 * size and (np.diff(s.values) <= 1e-12 * size).all()


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n long, z string")


def test_whitening(spark):
    from kilotrace.llm.whitening import whiten

    r = np.random.default_rng(4)
    x = (r.normal(size=(700, 40)) @ np.diag(np.linspace(0.05, 1, 40))).astype(np.float32)
    x[5] = x[6]
    rows = [(i if i != 9 else None, v.tolist(), 1, 2, "z") for i, v in enumerate(x)]
    rows += [(800, None, 1, 2, "z"), (801, [None] + [0.0] * 39, 1, 2, "z"), (802, [float("nan")] * 40, 1, 2, "z"), (803, [float("inf")] * 40, 1, 2, "z")]
    df = embeddings(spark, rows).repartition(11)
    got = whiten(df, block=50).collect()
    whole = np.floor(64 * x.astype(float)).astype(np.int64) + 1000000
    n, s = len(whole), whole.sum(axis=0)
    c = (whole * n - s) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    assert len(got) == 700 * 32
    by = defaultdict(dict)
    for g in got:
        by[g.vec_id][g.component] = g
        assert g.n == n and g.identity_error < 1e-9 and abs(g.explained - e[g.component - 1] / e.sum()) < 1e-12
    assert set(by) == {None, *range(700)} - {9} and all(set(b) == set(range(1, 33)) for b in by.values())
    want, sign = c @ q[:, :32] / np.sqrt(e[:32]), None
    have = np.array([[by[i][k + 1].whitened for k in range(32)] for i in range(700) if i != 9])
    want = np.delete(want, 9, axis=0)
    sign = np.sign((have * want).sum(axis=0))
    assert np.abs(have - want * sign).max() < 1e-8
    for i in (0, 5, 699):
        assert by[i][1].deviation == by[i][7].deviation == sum(int(v) ** 2 for v in (whole[i] * n - s)) == int(by[i][1].deviation_38)
    with pytest.raises(Exception, match="entries"):
        whiten(embeddings(spark, [(1, [0.0, 1.0], 1, 2, ""), (2, [0.0], 1, 2, "")])).collect()


def test_whitening_of_little(spark):
    from kilotrace.llm.whitening import whiten

    for rows in ([], [(1, None, 1, 2, "")], [(1, [0.5, 2.0], 1, 2, "")], [(i, [0.5, 2.0], 1, 2, "") for i in range(5)]):
        assert whiten(embeddings(spark, rows)).collect() == []
    line = whiten(embeddings(spark, [(i, [float(i), 2.0 * i, 0.0], 1, 2, "") for i in range(6)])).collect()
    assert {r.component for r in line} == {1} and len(line) == 6 and all(r.identity_error < 1e-9 and abs(r.explained - 1) < 1e-9 for r in line)
    far = whiten(embeddings(spark, [(i, [1e9 * (i % 2), 0.0], 1, 2, "") for i in range(4)])).collect()
    assert {r.deviation for r in far} == {None} and {int(r.deviation_38) for r in far} == {(64 * 10**9 * 2) ** 2}


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        root = c - c % 100 if c >= 0 else c + (-c) % 100
        built[c] = tuple(turns.get(root, [])[:h] + turns[c][h:])
    nodes = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    kids = defaultdict(set)
    for p in nodes:
        if p:
            kids[p[:-1]].add(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(nodes[p]) - 1) * len(p[-1][1]) if p else 0)
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def test_prefix_trie(spark):
    from kilotrace.llm import prefixes as T

    r = random.Random(6)
    rows = []
    for c in [*range(0, 130), *range(205, 260), -7, -100, -130, 10**12]:
        hot = r.random() < 0.4
        n = 6 if hot else r.randrange(1, 6)
        for k in range(n):
            rows.append((c, k, "user" if k % 2 == 0 else "bot", f"h{k}" if hot else r.choice("ab") * r.randrange(1, 3), "x", 1))
    rows += [(300, k, "user", f"t{k % 3}", "x", 1) for k in range(90)] + [(301, k, "user", f"t{k % 3}", "x", 1) for k in range(70)]
    rows += [(100, None, None, None, "x", 1), (102, None, None, "é😀", "x", 1), (103, 1, "user", "twice", "x", 1), (103, 1, "user", "twice", "x", 1), (103, 1, "user", "other", "x", 1), (None, 1, "user", "lost", "x", 1)]
    schema = "conv_id long, turn long, role string, text string, key string, kind int"
    df, want = spark.createDataFrame(rows, schema), plain_trie(rows)
    for size in (1 << 40, 1000, 200):
        got = T.prefix_trie(df, shard_bytes=size)
        assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert T.prefix_trie(spark.createDataFrame([], schema)).collect() == []
    lone = [(5, 0, "user", "gone", "x", 1)]  # the first-of-hundred is missing, and h turns are more than its own
    assert sorted(map(tuple, T.prefix_trie(spark.createDataFrame(lone, schema)).collect()), key=str) == plain_trie(lone)


def test_cut_nodes_beyond_the_broadcast(spark, monkeypatch):
    from kilotrace.llm import prefixes as T

    monkeypatch.setattr(T, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(T, "PIECE", 7)  # ids in many pieces
    rows = [(c, k, "user", f"{k}" if c % 3 else f"{c}-{k}") for c in range(100, 190) for k in range(4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, T.prefix_trie(df, shard_bytes=300).collect()), key=str) == plain_trie(rows)


def test_lexsort_of_padded_matrices():
    from kilotrace.llm.prefixes import ordered

    r = random.Random(8)
    seqs = [tuple(r.choice((1, 2)) for _ in range(r.randrange(0, 40))) for _ in range(300)] + [(1,) * 60, (1,) * 60, (1,) * 59, ()]
    depth = np.array([len(s) for s in seqs])
    order, shared = ordered(np.array([x for s in seqs for x in s]), np.cumsum(depth) - depth, depth)
    assert [seqs[i] for i in order] == sorted(seqs)
    for i in range(1, len(order)):
        a, b = seqs[order[i - 1]], seqs[order[i]]
        assert shared[i] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert a != b or order[i - 1] < order[i]
