"""Awkward rows for the operators and the pipeline, the registered queries themselves, and models against dense ones."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

WORDS = [f"{a}{b}" for a in ("al", "be", "co", "du", "en", "fi", "go", "hu") for b in ("ra", "ti", "mo", "ne", "su", "va", "lo", "pi", "x", "th")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use or add themselves.
CLASHING = ("score", "lang_pred", "lines", "kept_lines", "cut_words", "_row", "row", "spans", "given", "doc", "every", "blank", "stay", "letter", "decoded", "words", "part", "key", "node", "fp", "component_id")


def prose(r, n):
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


def texts():
    r = random.Random(41)
    out = [prose(r, r.randrange(20, 120)) for _ in range(30)]
    passage = prose(r, 70)
    out += [prose(r, 30) + " " + passage + "\n" + prose(r, 20) for _ in range(3)]
    out += [out[1], out[2], out[3] + "\n" + out[4], None, "", "  \n", "12 34", prose(r, 12000), out[5].replace(" ", "  ")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en" if i % 2 else "fr", "s", 0) for i, t in enumerate(texts())], SCHEMA)


def widened(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])


def test_names_that_clash(docs):
    from kilotrace.llm.langid import identify
    from kilotrace.llm.lines import dedup_lines
    from kilotrace.llm.passages import cut_passages
    from kilotrace.llm.sentencepiece import decode

    wide = widened(docs)
    plain = {"identify": identify(docs, docs.select("text", "lang")), "lines": dedup_lines(docs), "passages": cut_passages(docs)}
    for name, found in {"identify": identify(wide, wide.select("text", "lang")), "lines": dedup_lines(wide), "passages": cut_passages(wide)}.items():
        assert found.columns[: len(wide.columns)] == wide.columns and len(set(found.columns)) == len(found.columns)
        added = len(found.columns) - len(wide.columns)
        rows, want = found.collect(), {r.doc_id: (r.text, *tuple(r)[-added:]) for r in plain[name].collect()}
        assert len(rows) == docs.count()
        for r in rows:
            assert all(r[c] == f"{c}:{r.doc_id}" for c in CLASHING)
            assert (r.text, *tuple(r)[-added:]) == want[r.doc_id]
    import public_tokenizers as P
    from pyspark.sql import functions as F

    ids = wide.limit(3).withColumn("ids", F.array(F.lit(300)))
    assert decode(ids, P.path("piece_bpe_32k.model")).columns == [*ids.columns, "decoded_"]


def test_stages_keep_columns_and_rows_without_ids(spark, docs):
    import corpus_pipeline

    wide = widened(docs)
    now, left = wide, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "")
        assert now.columns == wide.columns, name
        rows = now.collect()
        assert all(r[c] == f"{c}:{r.doc_id}" for r in rows for c in CLASHING), name
        now = spark.createDataFrame(rows, wide.schema)
        left = {r.doc_id for r in rows}
    assert {0, 1, 2} <= left and not left & {33, 34}  # of copies the first stays
    r = random.Random(42)
    lone = spark.createDataFrame([(None, prose(r, 60), "en", "s", 0), (None, prose(r, 60), "en", "s", 0), (7, prose(r, 60), "en", "s", 0)], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, lone, "").count() == 3, name
    assert corpus_pipeline.STAGES[-1][1](spark, lone, "").count() == 3


def test_empty_and_repeated_tables(spark, docs, tmp_path):
    import corpus_pipeline

    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    docs.write.parquet(f"{tmp_path}/once/documents.parquet")
    docs.unionByName(docs).write.parquet(f"{tmp_path}/twice/documents.parquet")
    ids = lambda d: sorted(r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/{d}").collect())
    assert sorted(set(ids("twice"))) == sorted(set(ids("once")))


def test_pipeline_against_plain_stages(spark, docs):
    """Line dedup and near-copies by plain rules over what the stage before kept, and what packing gets."""
    import corpus_pipeline
    from kilotrace.llm.simhash import fingerprint

    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, "")
    rows = {r.doc_id: r for r in kept.collect()}
    source = {i: t for i, t in enumerate(texts())}
    assert all(rows[i].text == source[i] for i in rows) and set(rows) == {i for i, t in source.items() if t and re.search(r"[^\W\d_]", t)}
    near = {r.doc_id for r in stages["near_dedup"](spark, kept, "").collect()}
    fps, parent = {i: fingerprint(r.text.encode(), 5, 4) for i, r in rows.items()}, {i: i for i in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in rows:
        for j in rows:
            apart = [(a ^ b).bit_count() for a, b in zip(fps[i], fps[j], strict=True)]
            if min(apart) <= corpus_pipeline.NEAR["budget"] and sum(apart) <= corpus_pipeline.NEAR["total"]:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert near == {i for i in rows if root(i) == i}


def test_registered_queries(spark, docs, tmp_path):
    """Every opN_ query over a written table: its rows, and what its contract says of each."""
    from kilotrace.llm.queries import QUERIES

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    r = np.random.default_rng(1)
    vectors = r.standard_normal((60, 8))
    spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {n: q(spark, str(tmp_path)).collect() for n, q in QUERIES.items()}
    source = {i: t or "" for i, t in enumerate(texts())}
    crc = {i: zlib.crc32(str(i).encode()) for i in source}
    for n in ("op1_sentencepiece", "op2_simhash", "op5_exact_dedup", "op8_language_id", "op9_lm_scoring", "op10_line_dedup"):
        assert sorted(x.doc_id for x in got[n]) == sorted(source), n
    assert all(x.decoded_sha256 == hashlib.sha256(source[x.doc_id].encode()).hexdigest() for x in got["op1_sentencepiece"])
    prints = {x.doc_id: x.fingerprint for x in got["op2_simhash"]}
    assert all(re.fullmatch("[0-9a-f]{16}", f) for f in prints.values()) and prints[36] == prints[37] == "0" * 16 and prints[1] == prints[33]
    assert {x.doc_id: x.component_id for x in got["op2_simhash"]}[33] == 1
    assert all(x.held_out == (crc[x.doc_id] % 4 == 2) and 0 <= x.score <= 1 for x in got["op8_language_id"])
    assert all(x.lang_pred == "und" for x in got["op8_language_id"] if not re.search(r"[^\W\d_]", source[x.doc_id]))
    assert all(x.held_out == (crc[x.doc_id] % 10 == 0) and x.n_tokens == len(source[x.doc_id].split()) + 1 for x in got["op9_lm_scoring"])
    assert {x.doc_id for x in got["op3_repeated_passages"]} >= {31, 32, 34}
    ends = Counter()
    for x in got["op6_best_fit_packing"]:
        ends[x.sequence_id] += x.length
    assert max(ends.values()) <= 2048 and {x.doc_id for x in got["op6_best_fit_packing"]} == set(source)
    assert {(x.query_id, x.rank) for x in got["op7_nearest_neighbours"]} == {(q, k) for q in (0, 20, 40) for k in range(1, 21)}


def test_language_against_a_dense_kernel():
    """With every row a landmark, the fitted values are those of weighted kernel ridge regression on the whole kernel."""
    from kilotrace.llm.langid import codes, fit

    r = random.Random(43)
    kinds = {"en": ["the", "of", "and", "thing"], "fr": ["le", "eux", "tion", "eau"], "de": ["der", "ung", "schen", "ich"]}
    make = lambda lang: " ".join(r.choice(kinds[lang]) + r.choice(kinds[lang]) for _ in range(r.randrange(2, 9))).encode()
    rows = [(lang, make(lang)) for lang in kinds for _ in range(12)]
    model = fit([(lang, codes(raw)) for lang, raw in rows], landmarks=10_000, ridge=1e-2)
    grams = [set(codes(raw).tolist()) for _, raw in rows]
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    k = np.array([[kernel(a, b) for b in grams] for a in grams])
    y = np.array([[lang == own for own in sorted(kinds)] for lang, _ in rows], float)
    weight = np.array([len(rows) / (3 * 12)] * len(rows))
    alpha = np.linalg.solve(k + 1e-2 * len(rows) / 100 * np.diag(1 / weight), y)
    asked = [codes(make(lang)) for lang in kinds for _ in range(20)]
    dense = np.array([[kernel(set(a.tolist()), b) for b in grams] for a in asked]) @ alpha
    assert model.languages == sorted(kinds) and np.abs(model.scores(asked) - dense).max() < 2e-3


def test_language_ties_go_by_order():
    from kilotrace.llm.langid import codes, fit

    model = fit([("b", codes(b"same text")), ("a", codes(b"same text"))])
    assert model.languages[int(model.scores([codes(b"same text")]).round(6).argmax())] == "a"


def test_scores_against_exact_counts(spark, docs):
    """The model's probabilities from exact counts of pairs, each at its power of two."""
    from pyspark.sql import functions as F

    from kilotrace.llm.lm import errors, score

    held = {i: i % 5 == 0 for i in range(len(texts()))}
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), " "] for i, t in enumerate(texts())}
    one, two = Counter(), Counter()
    for i, ws in words.items():
        if not held[i]:
            one.update(ws)
            two.update(zip([" ", *ws], ws, strict=False))
    floor = sum(one.values()) + 0.1 * (len(one) + 1)

    def logs(ws):
        total = 0.0
        for u, w in zip([" ", *ws], ws, strict=False):
            base, n = (one[w] + 0.1) / floor, two[u, w]
            n = min(2 ** (n.bit_length() - 1) if n else 0, one[u], one[w])
            total += math.log10((n + 500 * base) / (one[u] + errors(one[u], len(one), 60, 12) + 500))
        return total

    df = docs.select("doc_id", "text", (F.col("doc_id") % 5 == 0).alias("held_out"))
    for x in score(df, bits_per_item=60, probes=12).collect():
        assert math.isclose(x.score, logs(words[x.doc_id]), rel_tol=1e-9)


def test_rows_without_ids_are_scored_and_encoded(spark):
    import public_tokenizers as P
    from pyspark.sql import functions as F

    from kilotrace.llm.exact import exact_groups
    from kilotrace.llm.licenses import scan
    from kilotrace.llm.lm import score
    from kilotrace.llm.sentencepiece import encode

    rows = spark.createDataFrame([(None, "one text", None, None, None), (None, None, None, None, None), (3, "one text", None, None, None)], SCHEMA)
    assert sorted(str(x.doc_id) for x in score(rows.select("doc_id", "text", F.lit(False).alias("held_out"))).collect()) == ["3", "None", "None"]
    assert sorted((str(x.doc_id), len(x.ids)) for x in encode(rows, P.path("piece_bpe_32k.model")).collect())[1:] == [("None", 0), ("None", 2)]
    assert exact_groups(rows).count() == 3 and scan(rows).count() == 0


def test_shared_folder(spark):
    from kilotrace.llm.common import Scratch
    from kilotrace.sources import lake

    assert lake.shared_dir(spark) == lake.shared_dir(spark) and Scratch(spark, "x").root.startswith(lake.shared_dir(spark))

    class Elsewhere:
        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})

        conf = spark.conf

    try:
        spark.conf.get("spark.checkpoint.dir")
    except Exception:
        with pytest.raises(ValueError):
            lake.shared_dir(Elsewhere)


def test_blocks_without_training_documents(spark):
    """Held-out documents alone: in one block, in one of two files, as the whole table."""
    from kilotrace.llm.lm import score

    kinds = "doc_id long, text string, held_out boolean"
    one = spark.createDataFrame([(1, "a b c", True)], kinds)
    r = score(one).collect()
    assert [(x.doc_id, x.n_tokens, x.n_known, x.train_tokens) for x in r] == [(1, 4, 0, 0)] and math.isclose(r[0].score, 4 * math.log10(0.1 / 0.1), abs_tol=1e-9)
    teach = spark.createDataFrame([(i, "some words are here", False) for i in range(20)], kinds).coalesce(1)
    both = score(teach.union(one.coalesce(1))).collect()
    assert len(both) == 21 and {x.train_tokens for x in both} == {100}
    assert len(score(spark.createDataFrame([(i, "held out", True) for i in range(30)], kinds).repartition(7)).collect()) == 30
    long = score(teach.union(spark.createDataFrame([(99, "word " * 5000, True)], kinds)), block_bytes=1000).collect()
    assert len(long) == 21


@pytest.mark.parametrize("bits, probes", [(12, 7), (10, 5)])
def test_probabilities_sum_to_one_at_most(spark, bits, probes):
    """Over the disjoint texts of a hot table, over all texts of two words, and over all words after one of a filter
    with as many errors as its size has."""
    from kilotrace.llm.lm import Filter, errors, score

    r, kinds = random.Random(12), "doc_id long, text string, held_out boolean"
    hot = [(8 * c + i, f"a{i} b{i}", False) for i in range(8) for c in range(2049)]
    scores = {x.doc_id: x.score for x in score(spark.createDataFrame(hot, kinds).coalesce(1), bits_per_item=bits, probes=probes).collect()}
    assert 0.5 < sum(10 ** scores[i] for i in range(8)) <= 1
    rows = [(i, " ".join(r.choices("abcdefghijkl", weights=range(1, 13), k=r.choice((1, 2)))), False) for i in range(3000)]
    asked = [(10_000 + i, t, True) for i, t in enumerate(["", *"abcdefghijkl", *(f"{u} {w}" for u in "abcdefghijkl" for w in "abcdefghijkl")])]
    got = score(spark.createDataFrame(rows + asked, kinds).coalesce(1), bits_per_item=bits, probes=probes)
    assert 0.3 < sum(10**x.score for x in got.collect() if x.held_out) <= 1
    g = np.random.default_rng(4)
    keys = np.unique(g.integers(0, 2**40, 60_000, dtype=np.uint64))
    counts = np.minimum(g.zipf(1.5, 2000), 1000)
    size, raw = Filter.of(keys[:2000], counts, bits, probes)
    found = Filter([size], np.frombuffer(raw, np.uint8), probes).count(keys, np.zeros(len(keys), np.int64))
    extra = errors(np.array([counts.sum()]), len(keys), bits, probes)[0]
    assert found[:2000].sum() <= counts.sum() * 1.05 and found[2000:].sum() > 0
    assert found.sum() <= counts.sum() + 1.2 * extra


def test_links_of_rows_without_ids(spark):
    """A row with a null doc_id is a bridge like any other; repeated ids do not join what no link joins."""
    from kilotrace.llm.simhash import fingerprint, near_duplicates

    r = random.Random(3)
    base = [r.choice(WORDS) + str(r.randrange(50)) for _ in range(400)]
    apart = lambda a, b: bin(a ^ b).count("1")
    of = lambda ws: fingerprint(" ".join(ws).encode(), 4)[0]
    chain, now = [base], base
    while len(chain) < 3:  # a chain whose ends are not linked themselves
        later = [*now]
        later[r.randrange(400)] = f"x{r.randrange(10**6)}"
        if apart(of(now), of(later)) and apart(of(chain[-1]), of(later)) <= 4 and (len(chain) < 2 or apart(of(chain[0]), of(later)) > 4):
            chain.append(later)
        now = later if apart(of(chain[-1]), of(later)) <= 4 else chain[-1]
    texts_ = [" ".join(w) for w in chain]
    schema = "doc_id long, text string"
    got = near_duplicates(spark.createDataFrame([(1, texts_[0]), (None, texts_[1]), (3, texts_[2])], schema), 4, 4).collect()
    assert {x.component_id for x in got} == {1} and len(got) == 3
    alone = near_duplicates(spark.createDataFrame([(None, texts_[0]), (None, prose(r, 50)), (5, prose(r, 60)), (5, prose(r, 70)), (9, prose(r, 70))], schema), 4, 4).collect()
    assert sorted(str(x.component_id) for x in alone) == ["5", "5", "9", "None", "None"]


def test_lines_of_many_letters(spark):
    """Two near-copies of one line without spaces, and characters beyond 16 bits, which are one letter each."""
    from kilotrace.llm.lines import dedup_lines

    r = random.Random(9)
    line = "".join(r.choice("abcdefgh") for _ in range(100_000))
    other = line[:70_000] + "z" + line[70_001:]
    smile = "😀é" * 6
    rows = [(1, line), (2, other), (3, line[:50_000] + line[50_001:]), (4, line[::-1]), (5, smile), (6, smile[:5] + "x" + smile[6:]), (7, smile[:4] + "xy" + smile[6:])]
    got = {x.doc_id: x.kept_lines for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 1, 5: 1, 6: 0, 7: 1}
