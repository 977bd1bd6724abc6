"""The ten operators against plain versions on small tables, with the awkward cases: nulls, blanks, repeats, none."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}" for a in ("al", "be", "co", "du", "en", "fi", "go", "hu") for b in ("ra", "ti", "mo", "ne", "su", "va", "lo", "pi", "x", "th")]


def prose(r, n):
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    out = [prose(r, r.randrange(5, 150)) for _ in range(60)]
    passage = prose(r, 70)
    for i in range(6):
        out.append(prose(r, 40) + " " + passage + "\n" + prose(r, 30))
    near = out[3].split()
    if len(near) > 3:
        near[2] = "changed"
    out += [out[1], out[1], "\n".join([prose(r, 15), out[2]]), " ".join(near), None, "", "   \n ", "word", "É à ß", out[5].upper(), prose(r, 3000)]
    out += [passage.replace(passage.split()[30], "other"), "12 34 !!", out[7] + " ", out[7].replace(" ", "\n")]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en" if i % 2 else "fr", "s", 0) for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact(spark, docs, texts, none):
    from kilotrace.llm.exact import exact_groups

    plain = [re.sub(r"[\x20\x09-\x0D]+", "", t or "") for t in texts]
    groups = {}
    for i, p in enumerate(plain):
        groups.setdefault(p, []).append(i)
    got = {r.doc_id: r for r in exact_groups(docs, first=4, growth=4).collect()}
    assert len(got) == len(texts)
    for p, ids in groups.items():
        keep = min(ids, key=lambda i: (-len(texts[i] or ""), i))
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (keep, len(ids), i == keep)
            assert got[i].text_sha256 == hashlib.sha256(p.encode()).hexdigest()
    assert exact_groups(none).count() == 0
    twice = exact_groups(docs.unionByName(docs)).filter("kept").count()
    assert twice == len(groups)


def slow_fingerprint(text, shingle):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, texts, none):
    from kilotrace.llm.simhash import levels, near_duplicates

    fps = [slow_fingerprint(t, 4) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r.doc_id: r for r in near_duplicates(docs, 4, 4).collect()}
    for i in range(len(texts)):
        assert got[i].fp[0] % 2**64 == fps[i] and got[i].component_id == root(i)
    assert near_duplicates(none).count() == 0
    assert levels(4)[1] == [12, 25, 38, 51, 64]


def test_trie_finds_every_link(spark):
    from kilotrace.llm.common import Scratch
    from kilotrace.llm.simhash import trie_links

    r = random.Random(1)
    fps = [r.getrandbits(64) for _ in range(60)]
    for f in list(fps):
        for k in (1, 2, 3, 4, 5):
            g = f
            for b in r.sample(range(64), k):
                g ^= 1 << b
            fps.append(g)
    fps = list(dict.fromkeys(fps))
    own = lambda *x: [f - 2**64 if f >= 2**63 else f for f in x]
    rows = [(own(f), i) for i, f in enumerate(fps)]
    for budget in (0, 1, 4, 7):
        got = [(x.a, x.b) for x in trie_links(spark.createDataFrame(rows, "fp array<long>, node long"), budget, Scratch(spark, "test")).collect()]
        assert len(got) == len(set(got)) and set(got) == {(i, j) for j in range(len(fps)) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= budget}
    two = [(f, fps[(i + i % 3) % len(fps)]) for i, f in enumerate(fps)]
    rows = [(own(*f), i) for i, f in enumerate(two)]
    got = {(x.a, x.b) for x in trie_links(spark.createDataFrame(rows, "fp array<long>, node long"), 4, Scratch(spark, "test"), 2, 12).collect()}
    apart = lambda x, y: [(a ^ b).bit_count() for a, b in zip(x, y, strict=True)]
    assert got == {(i, j) for j in range(len(two)) for i in range(j) if min(apart(two[i], two[j])) <= 4 and sum(apart(two[i], two[j])) <= 12}


def test_connected(spark):
    from kilotrace.llm.common import Scratch, connected

    edges = [(i + 1, i) for i in range(40)] + [(100, 200), (200, 300), (5, 5)] + [(1000, k) for k in range(1001, 1030)]
    got = {r.node: r.label for r in connected(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and got[300] == 100 and got[1029] == 1000
    assert connected(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def near_lines(a, b):
    if max(len(a), len(b)) >= 10:
        return within_one(a, b)
    a, b = " ".join(a), " ".join(b)
    return max(len(a), len(b)) >= 10 and within_one(list(a), list(b))


def test_lines(spark, none):
    from kilotrace.llm.lines import dedup_lines

    r = random.Random(9)
    base = [prose(r, r.randrange(9, 14)) for _ in range(8)] + ["Short.", "", "  ", prose(r, 40), "a line of few words", "tiny one", "ten letter"]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(r.randrange(1, 6)):
            w = r.choice(base).split(" ")
            for _ in range(r.choice((0, 0, 1, 1, 2))):
                k = r.randrange(max(1, len(w)))
                w = r.choice((w[:k] + w[k + 1 :], w[:k] + ["new"] + w[k:], w[:k] + ["other"] + w[k + 1 :]))
            line = " ".join(w)
            if line and r.random() < 0.4:  # letters change too
                k = r.randrange(len(line))
                line = r.choice((line[:k] + line[k + 1 :], line[:k] + "x" + line[k:], line[:k] + "é" + line[k + 1 :]))
            lines.append(line)
        rows.append((i, "\n".join(lines), None, None, None))
    rows += [(120, None, None, None, None), (121, "", None, None, None)]
    seen, want = [], {}
    for i, t, *_ in rows:
        keep = []
        for line in (t or "").split("\n"):
            w = line.split()
            if not w or not any(w == s or near_lines(w, s) for s in seen):
                keep.append(line)
            if w:
                seen.append(w)
        want[i] = None if t is None else "\n".join(keep)
    got = {x.doc_id: x.text for x in dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want
    assert dedup_lines(none).count() == 0


def test_packing(spark, docs, texts, none):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from kilotrace.llm.packing import best_fit, pack

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = pack(docs, P.path("byte_bpe_50k.json"), 256).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for n, r in enumerate(sorted(by[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at) and (n == 0 or r.length == 256)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        end = 0
        for offset, length in sorted(b):
            assert offset == end
            end += length
        assert end <= 256
    lengths = sorted((r.length for r in rows), reverse=True)
    free = []  # best-fit decreasing, one at a time
    for n in lengths:
        fits = [c for c in free if c >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(256 - n)
    assert len(bins) == len(free)
    assert pack(none, P.path("byte_bpe_50k.json")).count() == 0
    assert best_fit([], 10) == []


def test_encoder_is_the_tokenizer():
    import public_tokenizers as P
    import pyarrow as pa
    from tokenizers import Tokenizer

    from kilotrace.llm.packing import Encoder, chunks

    e, t, r = Encoder(P.path("byte_bpe_50k.json")), Tokenizer.from_file(P.path("byte_bpe_50k.json")), random.Random(2)
    odd = [None, "", " ", "\n", "a \nb", "a\n\nb", "\ta b", "<|endoftext|> hi", "x y z", "a\u3000 b", "x\u00a0\n y", "word " * 5000]
    odd += ["".join(r.choice("ab 1.\n\t é'sl日\u00a0") for _ in range(r.randrange(40))) for _ in range(800)] + [prose(r, 30) for _ in range(40)]
    for _ in range(2):  # new stretches, then known ones
        ids, ends = e.batch(pa.array(odd, pa.string()))
        own = [x.tolist() for x in np.split(ids, ends[:-1])]
        assert own == [t.encode(x or "", add_special_tokens=False).ids for x in odd]
    batch = pa.RecordBatch.from_arrays([pa.array(odd, pa.string())], names=["text"])
    assert [x for c in chunks(batch, 0, 1000) for x in c.column(0).to_pylist()] == odd


def test_packing_of_special_tokens(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from kilotrace.llm.packing import pieces

    t, r = Tokenizer.from_file(P.path("byte_bpe_50k.json")), random.Random(3)
    odd = ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b c", " <|endoftext|>\n<|endoftext|>", "x <|endoftext|>. y"]
    odd += ["".join(r.choice(["<|endoftext|>", "a", " ", "\n", "<|", "b."]) for _ in range(20)) for _ in range(60)]
    df = spark.createDataFrame([(i, x, None, None, None) for i, x in enumerate(odd * 4)], SCHEMA).repartition(3)
    got = pieces(df, P.path("byte_bpe_50k.json"), 2048).collect()
    for x in got:
        ids = [*t.encode(odd[x.doc_id % len(odd)], add_special_tokens=False).ids, 0]
        assert (x.length, x.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    # numbers of a length are dealt without a gap, and written
    dealt = {}
    for x in got:
        dealt.setdefault((x.length, x.part), []).append(x.rank)
    assert len({p for _, p in dealt}) > 1 and all(sorted(v) == list(range(len(v))) for v in dealt.values())


def recall_of(got, vectors, every=20):
    """The share of the 20 true nearest that ``got`` holds; ranks, ids and scores are checked on the way."""
    ids, m = np.array(list(vectors)), np.stack(list(vectors.values()))
    by, hits = {}, 0
    for g in got:
        by.setdefault(g.query_id, []).append((g.rank, g.vec_id, g.score))
    assert set(by) == {i for i in vectors if i % every == 0}
    for q, found in by.items():
        s = m @ vectors[q]
        order = [int(i) for i in ids[np.lexsort((ids, -s))] if i != q][:20]
        hits += len(set(order) & {v for _, v, _ in found})
        assert [x[0] for x in sorted(found)] == list(range(1, len(order) + 1)) and len({v for _, v, _ in found}) == len(order)
        assert [v for _, v, _ in sorted(found)] == [v for _, v, _ in sorted(found, key=lambda x: (-x[2], x[1]))]
        assert all(v != q and math.isclose(sc, float(vectors[v] @ vectors[q]), rel_tol=1e-9, abs_tol=1e-9) for _, v, sc in found)
    return hits / (len(by) * min(20, len(vectors) - 1))


VECTORS = "vec_id long, embedding array<float>"


def test_neighbours(spark):
    from kilotrace.llm.ann import search

    r = np.random.default_rng(3)
    x = r.standard_normal((3000, 16)).astype(np.float32) + 2 * r.standard_normal((12, 16))[r.integers(0, 12, 3000)]
    rows = [(i, [float(v) for v in x[i].astype(np.float32)]) for i in range(3000)]
    rows += [(3000 + i, rows[40][1]) for i in range(60)]  # copies tie
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    rows += [(4000, None), (4001, [0.0] * 16), (4002, [float("nan")] * 16), (4003, [1.0]), (None, rows[0][1]), *rows[:200], (20, [9.0] * 16)]  # repeats; of one id the least vector
    good[20] = min(good[20], np.full(16, 9.0), key=lambda v: v.tolist())
    got = search(spark.createDataFrame(rows, VECTORS), parts=32, block=100).collect()
    assert recall_of(got, good) >= 0.9
    assert search(spark.createDataFrame([], VECTORS)).count() == 0
    few = {i: np.array([1.0, i]) for i in range(9)}
    assert recall_of(search(spark.createDataFrame([(i, v.tolist()) for i, v in few.items()], VECTORS)).collect(), few) == 1
    wide = spark.createDataFrame([(i, v.tolist(), 1, 2, 3) for i, v in few.items()], VECTORS + ", v int, part int, rank int")
    assert len(search(wide).collect()) == 8


def test_neighbours_probe_some_parts_alone():
    from kilotrace.llm.ann import probes_for, train

    r = np.random.default_rng(4)
    x = r.standard_normal((2000, 24)) * 0.5 + 2 * r.standard_normal((20, 24))[r.integers(0, 20, 2000)]
    router = train(x[300:], 4)
    assert probes_for(router, x[300:], x[:300], 20, 0.92) <= 8  # of 16, where there are clusters


@pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="no tables")
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_on_the_tables(spark, sf):
    from kilotrace.llm.ann import op7_nearest_neighbours

    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    good = {r.vec_id: np.array(r.embedding, float) for r in rows if r.embedding and all(v is not None and math.isfinite(v) for v in r.embedding) and any(r.embedding)}
    assert recall_of(op7_nearest_neighbours(spark, f"/root/testdata/{sf}").collect(), good) >= 0.9


def test_language(spark, none):
    from kilotrace.llm.langid import identify

    r, rows = random.Random(4), []
    kinds = {"en": ["the", "of", "and", "thing", "ing", "there"], "fr": ["le", "de", "eux", "tion", "eau", "être"], "de": ["der", "und", "ung", "schen", "ich", "zu"]}
    for i in range(300):
        lang = ("en", "fr", "de")[i % 3]
        rows.append((i, " ".join(r.choice(kinds[lang]) + r.choice(kinds[lang]) for _ in range(r.randrange(3, 60))), lang, None, None))
    rows += [(900, None, "en", None, None), (901, "123 !", "en", None, None), (902, "", None, None, None), (903, "the thing of " * 20000, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {x.doc_id: x for x in identify(df, df.filter("doc_id % 2 = 0").select("text", "lang"), per_language=40).collect()}
    assert np.mean([got[i].lang_pred == rows[i][2] for i in range(1, 300, 2)]) > 0.97
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902)) and got[903].lang_pred == "en"
    assert all(0 <= x.score <= 1 for x in got.values())
    assert identify(none, none.select("text", "lang")).count() == 0
    assert identify(df, none.select("text", "lang")).filter("lang_pred <> 'und'").count() == 0


def test_language_of_skewed_texts(spark):
    from kilotrace.llm.langid import codes, training_rows

    rows = [(f"eins zwei {i * 7919}", "de") for i in range(50)] + [("kopie", "de")] * 5000
    rows += [("1" * 30000 + "très long " * 3000, "fr")] + [(f"word {i}", f"x{i}") for i in range(130)]
    got = training_rows(spark.createDataFrame(rows, "text string, lang string"), 40, None)
    assert len({g.tobytes() for lang, g in got if lang == "de"}) == 40 and len(got) == 40 + 1 + 130
    long = codes(("1" * 30000 + "très long " * 3000).encode())  # all of it, the end included
    assert [g.tolist() for lang, g in got if lang == "fr"] == [long.tolist()]


def base_of(rows, held):
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), " "] for i, t in rows}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in tokens.items()}


@pytest.mark.parametrize("filter_bytes", [1 << 28, 1 << 11])
def test_scoring(spark, docs, texts, none, filter_bytes):
    from kilotrace.llm.lm import score

    held = {i: i % 10 == 0 for i in range(len(texts))}
    want = base_of(list(enumerate(texts)), held)
    df = docs.select("doc_id", "text", (F.col("doc_id") % 10 == 0).alias("held_out"))
    got = {r.doc_id: r for r in score(df, filter_bytes=filter_bytes, block_bytes=4000).collect()}
    assert len(got) == len(texts)
    for i, (n, known, total, base) in want.items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens, got[i].held_out) == (n, known, total, held[i])
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9)
        assert got[i].score <= 0 and (held[i] or got[i].score > base)
    assert score(none.select("doc_id", "text", F.lit(False).alias("held_out"))).count() == 0


def test_filter_counts():
    from kilotrace.llm.lm import Filter

    r = np.random.default_rng(1)
    keys, counts = np.unique(r.integers(0, 2**40, 5000, dtype=np.uint64)), None
    counts = r.integers(1, 40, len(keys))
    size, bits = Filter.of(keys, counts, 12, 6)
    f = Filter([size], np.frombuffer(bits, np.uint8), 6)
    found = f.count(keys, np.zeros(len(keys), np.int64))
    assert (found >= np.where(counts == 1, 1, 2 ** np.floor(np.log2(counts)))).all()
    assert f.count(r.integers(2**41, 2**42, 20000, dtype=np.uint64), np.zeros(20000, np.int64)).astype(bool).mean() < 0.02


def test_passages(spark, none):
    from kilotrace.llm.passages import compact_windows, cut_passages, repeated_passages

    r = random.Random(8)
    passage, odd = prose(r, 60), prose(r, 120).split()
    changed = [*odd]
    changed[70] = "changed"
    rows = [(0, prose(r, 50) + " " + passage + " " + prose(r, 200)), (1, prose(r, 300)), (2, passage + "\n" + prose(r, 20)), (3, prose(r, 30) + "  " + passage), (4, " ".join(odd)), (5, prose(r, 90) + " " + " ".join(changed)),
            (6, None), (7, ""), (8, prose(r, 49)), (9, prose(r, 20) + " " + " ".join(passage.split()[:30]))]
    df = spark.createDataFrame([(*x, None, None, None) for x in rows], SCHEMA)
    found = repeated_passages(df).collect()
    assert {(x.doc_id, x.of_doc_id) for x in found} == {(2, 0), (3, 0), (5, 4)}
    for x in found:
        if x.doc_id in (2, 3):
            assert (rows[x.doc_id][1].split()[x.start : x.end] == passage.split()) and (x.of_start, x.of_end) == (50, 110)
        assert x.similarity >= 0.8 and x.end - x.start >= 50
    cut = {x.doc_id: x.text for x in cut_passages(df).collect()}
    assert cut[2].split() == rows[2][1].split()[60:] and cut[3].split() == rows[3][1].split()[:30]
    assert all(cut[i] == rows[i][1] for i in (0, 1, 4, 6, 7, 8, 9))
    assert repeated_passages(none).count() == 0 and cut_passages(none).count() == 0
    v = np.random.default_rng(2).integers(0, 2**63, 200, dtype=np.uint64)
    wins = {(int(a), int(c), int(b)) for a, c, b in zip(*compact_windows(v, np.array([0]), np.array([200]), 20), strict=True)}
    slow = set()
    for c in range(200):
        a, b = c, c + 1
        while a and v[a - 1] > v[c]:
            a -= 1
        while b < 200 and v[b] > v[c]:
            b += 1
        if b - a >= 20:
            slow.add((a, c, b))
    assert wins == slow


def test_passages_behind_a_rejected_first(spark):
    from kilotrace.llm.passages import repeated_passages

    r = random.Random(21)
    rows, want = [], {}
    for t in range(12):
        a = prose(r, 56).split()
        b = [*a]
        b[20], b[40] = "new", "other"  # unlike enough to be rejected, alike enough to share keys
        c = [*b]
        c[3] = "third"  # repeats b, not a
        for i, part in enumerate((a, b, b, b, c)):
            rows.append((10 * t + i, prose(r, 30) + " " + " ".join(part) + " " + prose(r, 30), None, None, None))
        want[10 * t + 2] = want[10 * t + 3] = b
    got = {x.doc_id: x for x in repeated_passages(spark.createDataFrame(rows, SCHEMA)).filter("similarity = 1").collect()}
    assert all(i in got and got[i].of_doc_id % 10 in (1, 2) and rows[i // 10 * 5 + i % 10][1].split()[got[i].start : got[i].end] == b for i, b in want.items())


def test_passages_behind_decoys(spark):
    """Early documents that hold one shingle of the passage each are the first of all its keys."""
    from kilotrace.llm.passages import repeated_passages

    r = random.Random(23)
    passage, rows = prose(r, 60).split(), []
    for i in range(1120):
        k = i % 56
        rows.append((i, prose(r, 26) + " " + " ".join(passage[k : k + 5]) + " " + prose(r, 26), None, None, None))
    rows += [(5000 + i, prose(r, 40) + " " + " ".join(passage) + " " + prose(r, 40), None, None, None) for i in range(4)]
    got = [x for x in repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert {x.doc_id for x in got} == {5001, 5002, 5003} and all(5000 <= x.of_doc_id < x.doc_id for x in got)
    assert all((x.start, x.end) == (40, 100) for x in got)


def test_passages_behind_many_decoys(spark):
    """Every stretch of 40 words of the passage stands in many earlier documents, in unlike surroundings: whatever
    windows and contexts the passage's documents share, several of those documents have them first."""
    from kilotrace.llm.passages import repeated_passages

    r = random.Random(25)
    passage, rows = prose(r, 60).split(), []
    for i in range(16 * 21):
        rows.append((i, prose(r, 40) + " " + " ".join(passage[i % 21 : i % 21 + 40]) + " " + prose(r, 40), None, None, None))
    rows += [(5000 + i, prose(r, 40) + " " + " ".join(passage) + " " + prose(r, 40), None, None, None) for i in range(3)]
    got = [x for x in repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect() if x.doc_id >= 5000 and (x.start, x.end) == (40, 100)]
    assert {x.doc_id for x in got} == {5001, 5002} and all(5000 <= x.of_doc_id < x.doc_id for x in got)


def test_contexts_of_passages():
    """Wherever a centre stands in the run of words that begins a passage, one of its contexts lies in that run."""
    from kilotrace.llm.passages import contexts

    for shingle, least, similarity, whole in ((5, 50, 0.8, 21), (5, 50, 0.9, 41), (3, 50, 0.8, 11), (5, 50, 0.5, 9), (5, 50, 1.0, 50), (5, 12, 0.8, 12)):
        found = contexts(shingle, least, similarity)
        for c in range(whole - shingle + 1):
            assert any(c + steps[0] >= 0 and c + steps[-1] + shingle <= whole for steps in found)
        assert all({w + i for w in steps for i in range(shingle)} == set(range(steps[0], steps[-1] + shingle)) for steps in found)


def test_passages_against_every_pair(spark):
    """Texts of shared and edited paragraphs against a comparison of all pairs, word by word."""
    from kilotrace.llm.passages import alike_spans, repeated_passages

    r = random.Random(24)
    paragraphs = [prose(r, r.randrange(40, 90)).split() for _ in range(30)]
    rows = []
    for i in range(90):
        words = []
        for _ in range(r.randrange(1, 4)):
            part = [*r.choice(paragraphs)]
            for _ in range(r.choice((0, 0, 1, 2))):
                part[r.randrange(len(part))] = "edited" + str(r.randrange(99))
            words += prose(r, r.randrange(5, 40)).split() + part
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, rows[3][1]), (202, rows[3][1]), (None, rows[4][1])]  # repeated rows
    want = {}
    texts = [(i, t.encode().split()) for i, t in rows[:90] + [(202, rows[3][1])]]
    for n, (i, x) in enumerate(texts):
        for _, y in texts[:n]:
            for a, b, *_ in alike_spans(x, y, 5, 50, 0.8):
                want.setdefault(i, set()).update(range(a, b))
    got, true = {}, dict(texts)
    for x in repeated_passages(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)).collect():
        assert x.of_doc_id < x.doc_id and x.end - x.start >= 50
        one, two = ({tuple(w[i : i + 5]) for i in range(a, b - 4)} for w, a, b in ((true[x.doc_id], x.start, x.end), (true[x.of_doc_id], x.of_start, x.of_end)))
        assert math.isclose(len(one & two) / len(one | two), x.similarity) and x.similarity >= 0.8
        got.setdefault(x.doc_id, set()).update(range(x.start, x.end))
    total = sum(map(len, want.values()))
    assert sum(len(got.get(i, set()) & w) for i, w in want.items()) >= 0.97 * total
    assert sum(len(w - want.get(i, set())) for i, w in got.items()) <= 0.02 * total


def test_passages_leave_no_shuffle_files(spark, docs):
    """Each step's shuffle files go as its table is written, and the session's setting is as it was."""
    from kilotrace.llm.common import TIDY
    from kilotrace.llm.passages import repeated_passages

    shuffles = lambda: {p for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString() for p in Path(d).rglob("shuffle_*.data")}
    before, was = shuffles(), spark.conf.get(TIDY)
    repeated_passages(docs)
    assert not shuffles() - before and spark.conf.get(TIDY) == was


def test_passages_split_where_a_run_fails():
    from kilotrace.llm.passages import alike_spans

    r = random.Random(22)
    own = lambda n: prose(r, n).encode().split()
    found = lambda x, y: sorted(s[:4] for s in alike_spans(x, y, 5, 50, 0.8))
    a, b, c = own(54), own(54), own(54)
    assert found([*a, *own(6), *b, *own(6), *c], [*a, *own(6), *b, *own(6), *c]) == [(i, i + 54, i, i + 54) for i in (0, 60, 120)]
    exact, edits = own(100), [own(25) for _ in range(6)]
    x, y = ([*exact, *(w for e in edits for w in [*own(1), *e])] for _ in range(2))
    assert (0, 100, 0, 100) in found(x, y)
    x, y = [*exact, *own(30), *a], [*exact, *own(200), *a]  # the second run stands behind the first one's best end
    assert found(x, y) == [(0, 100, 0, 100), (130, 184, 300, 354)]
    x, y = [*a, *b], [*b, *own(300), *a]  # hits alone, from places far apart
    assert {(0, 54, 354, 408), (54, 108, 0, 54)} <= set(found(x, y))


def test_licenses(spark, none):
    from kilotrace.llm.licenses import scan
    from kilotrace.llm.templates import TEMPLATES

    r = random.Random(6)
    mit = TEMPLATES["MIT-text"].split()
    rows = [(0, prose(r, 30) + "\nReleased under the MIT License.\n" + prose(r, 9)), (1, prose(r, 40)), (2, " ".join(mit[:40] + ["extra"] + mit[40:])), (3, "the license is under review"), (4, None), (5, " ".join(mit[:20])), (6, "licensed UNDER cc by-nc 4.0"),
            (7, "Released under the MIT License. x y z " * 2), (None, "licensed under CC BY-NC 4.0"), (6, "licensed UNDER cc by-nc 4.0"), (8, prose(r, 40000) + " Released under the MIT License.")]
    got = [(-1 if x.doc_id is None else x.doc_id, x.license, x.start_word, x.end_word, x.matched) for x in scan(spark.createDataFrame([(*x, None, None, None) for x in rows], SCHEMA)).collect()]
    assert sorted(got) == [(-1, "CC-BY-NC-4.0", 0, 5, 5), (0, "MIT", 30, 35, 5), (2, "MIT-text", 0, len(mit) + 1, len(mit)), (6, "CC-BY-NC-4.0", 0, 5, 5), (6, "CC-BY-NC-4.0", 0, 5, 5), (7, "MIT", 0, 5, 5), (7, "MIT", 8, 13, 5), (8, "MIT", 40000, 40005, 5)]
    assert scan(none).count() == 0
    own = lambda *x: spark.createDataFrame(x, "license string, text string")
    with pytest.raises(ValueError):
        scan(none, own(("x", "too short")))
    with pytest.raises(ValueError):
        scan(none, own(("x", "long enough for an index")), index_bytes=10)
    clashing = spark.createDataFrame([(1, "please keep all of these words", "x", 1)], "doc_id long, text string, license string, coverage int")
    assert [tuple(x)[:4] for x in scan(clashing, own(("mine", "keep all of these words"), ("mine", None))).collect()] == [(1, "mine", 1, 6)]


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_licenses_against_full_alignment(spark):
    """Which templates a text holds, by the longest common subsequence with every stretch of the text that a place may
    take; edits are scattered, in one paragraph, or both."""
    from kilotrace.llm.licenses import EDGES, scan
    from kilotrace.llm.templates import TEMPLATES

    plain = lambda t: [w for x in t.lower().split() if (w := x.strip(EDGES))]
    r, rows, want = random.Random(61), [], set()
    names = ["MIT", "BSD", "GPL-3.0-header", "Zlib-text", "MIT-text-full", "Apache-2.0-header-full"]
    for i in range(90):
        words = TEMPLATES[r.choice(names)].split()
        for _ in range(r.choice((0, r.randrange(len(words) // 6 + 1)))):  # edits, from none to too many
            k = r.randrange(len(words))
            words[k : k + 1] = r.choice(([], ["other"], [words[k], "more"]))
        k = r.randrange(len(words))
        words[k:k] = prose(r, r.choice((0, 6, 12, 30, 70, 200))).split()
        rows.append((i, prose(r, r.randrange(30)) + " " + " ".join(words) + " " + prose(r, r.randrange(30)), None, None, None))
    some = [(n, TEMPLATES[n]) for n in names]
    for i, text, *_ in rows:
        have = plain(text)
        for name, template in some:
            body = plain(template)
            reach = len(body) + 1 + len(body) // 2
            if any(longest_common(have[a : a + reach], body) >= 0.8 * len(body) for a in range(0, max(1, len(have) - len(body) // 2), 2)):
                want.add((i, name))
    found = scan(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(some, "license string, text string")).collect()
    got = {(x.doc_id, x.license) for x in found}
    assert got <= want and len(got) >= 0.97 * len(want) > 40
    for x in found:
        body, part = plain(TEMPLATES[x.license]), plain(" ".join(rows[x.doc_id][1].split()[x.start_word : x.end_word]))
        assert x.template_words == len(body) and 0.8 <= x.coverage == x.matched / len(body) and x.matched == longest_common(body, part)
        assert len(part) <= len(body) + 1 + len(body) // 2


def test_license_with_a_paragraph_inside(spark):
    from kilotrace.llm.licenses import scan
    from kilotrace.llm.templates import TEMPLATES

    r, mit = random.Random(62), TEMPLATES["MIT-text"].split()
    inside = lambda n: " ".join([*mit[: len(mit) // 2], *prose(r, n).split(), *mit[len(mit) // 2 :]])
    rows = [(n, prose(r, 20) + " " + inside(n) + " " + prose(r, 20)) for n in (0, 6, 12, len(mit) // 2)] + [(999, inside(5 * len(mit)))]
    rows += [(1000, " ".join([*mit, *mit, *mit]))]
    got = [(x.doc_id, x.start_word, x.end_word, x.matched) for x in scan(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("m", TEMPLATES["MIT-text"])], "license string, text string")).collect()]
    n = len(mit)
    assert sorted(got) == [(k, 20, 20 + n + k, n) for k in (0, 6, 12, n // 2)] + [(1000, i * n, (i + 1) * n, n) for i in range(3)]


def test_licenses_in_stretches_of_a_batch(spark, monkeypatch):
    """Texts of all scripts, many to a batch, which is taken in stretches of few."""
    from pyspark import cloudpickle

    from kilotrace.llm import licenses as T
    from kilotrace.llm.templates import TEMPLATES

    r, letters = random.Random(63), "abc äöéß漢字 привет\u0085\u00a0😀\n"
    rows = [(i, "".join(r.choice(letters) for _ in range(r.randrange(400))) + (" " + TEMPLATES["MIT-text"] if i % 9 == 0 else "")) for i in range(900)]
    monkeypatch.setattr(T, "CHUNK", 3000)
    cloudpickle.register_pickle_by_value(T)  # the tasks see the smaller stretches too
    try:
        got = T.scan(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), spark.createDataFrame([("m", TEMPLATES["MIT-text"])], "license string, text string")).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(T)
    assert sorted(x.doc_id for x in got) == list(range(0, 900, 9))


def test_many_copies_of_a_license_take_little(spark):
    """Two thousand copies in one text, and as many halves that come to nothing."""
    import time

    from kilotrace.llm.licenses import scan
    from kilotrace.llm.templates import TEMPLATES

    mit = TEMPLATES["MIT-text"].split()
    rows = [(1, " ".join(mit * 2000)), (2, " ".join((mit[: len(mit) // 2] + ["word"] * len(mit)) * 2000))]
    began = time.time()
    got = scan(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("m", TEMPLATES["MIT-text"])], "license string, text string")).collect()
    assert [x.doc_id for x in got] == [1] * 2000 and time.time() - began < 60


def test_sentencepiece(spark, docs, texts, none):
    import public_tokenizers as P
    from sentencepiece import SentencePieceProcessor

    from kilotrace.llm.sentencepiece import decode, encode

    path, r = P.path("piece_bpe_32k.model"), random.Random(3)
    model = SentencePieceProcessor(model_file=path)
    odd = [*texts, "  a", "a\nb", "\n\n", "日本語テスト", "a" * 300, "😀 hi😀", "a\tb    c      d"] + ["".join(r.choice("abthe \n\t.é日😀X") for _ in range(r.randrange(60))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(odd)], SCHEMA)
    got = {x.doc_id: x for x in decode(encode(df, path, block_bytes=20_000), path).collect()}
    for i, t in enumerate(odd):
        assert got[i].ids == (model.encode(t) if t else []), repr(t)
        assert bytes(got[i].decoded).decode() == (t or "")
    assert encode(none, path).count() == 0


def test_units_spelt_together():
    """All units of a block are cut and looked up at once; the ids are those of each unit's pieces."""
    import public_tokenizers as P
    import pyarrow as pa

    from kilotrace.llm import sentencepiece as S

    pieces, r = S.load(P.path("piece_bpe_32k.model")), random.Random(5)
    units = ["the", "\nand", " x", "\n", "\u6f22\u5b57", "\U0001f600a", "e\u0301", "a" * 62, "b" * 61, "word" * 40, *{"".join(r.choices("abet\u00e9\u6f22\U0001f600", k=r.randint(1, 12))) for _ in range(300)}]
    masks, want = [], []
    for u in units:
        w = S.spelt_out(u)
        cut = [0, *sorted(r.sample(range(1, len(w)), r.randint(0, len(w) - 1))), len(w)]
        masks.append(0 if len(w) > S.LONGEST or r.random() < 0.2 else sum(1 << i for i in cut))
        parts = [w[a:b] for a, b in zip(cut, cut[1:], strict=False)] if masks[-1] else list(w)
        want.append(pieces.merged(w) if len(w) > S.LONGEST else [i for p in parts for i in pieces.spelt(p)])
    starts, sizes, flat = S._spelt(pa.array(units), np.array(masks, np.int64), pieces)
    assert [flat[a : a + n].tolist() for a, n in zip(starts, sizes, strict=True)] == want
    assert len(S._spelt(pa.array([], pa.string()), np.zeros(0, np.int64), pieces)[0]) == 0


def test_pipeline(spark, docs, texts, tmp_path):
    import corpus_pipeline

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "passage_dedup", "packing"]
    now, counts = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        counts.append(now.count())
    assert counts == sorted(counts, reverse=True) and counts[0] < len(texts)
    left = {x.doc_id for x in now.collect()}
    assert 0 in left and not left & {i for i, t in enumerate(texts) if not t or not t.strip()}
    packed = {x.doc_id for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert packed == left


def test_pipeline_leaves_no_copies_of_texts(spark, docs, tmp_path):
    """Near-copies of rows with ids of their own write no texts; a stage's own tables go once its result is written."""
    import corpus_pipeline
    from kilotrace.sources.lake import shared_dir

    folders = lambda: set(Path(shared_dir(spark).removeprefix("file://")).glob("*-*"))
    before = folders()
    left = corpus_pipeline.near_copies(spark, docs, "")
    tables = {x.parent for d in folders() - before for x in d.rglob("*.parquet")}
    assert tables and not any("text" in spark.read.parquet(str(t)).columns for t in tables)
    twice = corpus_pipeline.near_copies(spark, docs.union(docs.filter("doc_id = 0")), "")  # numbered and written
    assert sorted(map(str, left.collect())) == sorted(map(str, twice.collect())) and left.count() < docs.count()
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    before = folders()
    assert corpus_pipeline.run(spark, str(tmp_path)).count()
    assert {x.name.split("-")[0] for x in folders() - before if any(x.rglob("*.parquet"))} == {"pipeline", "packing"}


def test_near_copies_keep_one_row(spark, docs):
    import corpus_pipeline

    r = random.Random(31)
    one, two, three = prose(r, 80), prose(r, 80), prose(r, 80)
    rows = [(1, one, "en", "s", 0)] * 3 + [(None, two, "en", "s", 0), (None, three, "en", "s", 0), (5, three, "en", "s", 0), (2, one, "en", "s", 0)]
    got = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert got.columns == docs.columns
    assert sorted((x.doc_id or 0, x.text) for x in got.collect()) == sorted([(1, one), (0, two), (5, three)])
