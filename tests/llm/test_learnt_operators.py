"""Learnt operators: brute force for their recursions, held-out accuracy, defined cases."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from tidelake.llm import fst, op2_neighbours, op5_toxicity, op6_language, op9_quality
from tidelake.llm.graph_partition import balanced_parts, neighbours

SF = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, score double"


# --- neighbours ---------------------------------------------------------------------------------

def brute(rows, is_query, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, float)
    out = {}
    for q in ok:
        if is_query(q):
            near = sorted((-float(ok[q] @ ok[c]), c) for c in ok if c != q)[:k]
            out[q] = [(c, -s) for s, c in near]
    return out


def result(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def same(a, b):
    return a.keys() == b.keys() and all(
        [c for c, _ in a[q]] == [c for c, _ in b[q]] and np.allclose([s for _, s in a[q]], [s for _, s in b[q]]) for q in a)


def test_small_table_is_exact(spark):
    r = random.Random(1)
    rows = [(i, [r.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(150)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(150, 200)]  # a group of copies, larger than any result
    rows += [(500, None), (501, []), (502, [0.0] * 4), (503, [float("nan"), 1.0, 1.0, 1.0]), (504, [None, 1.0, 1.0, 1.0]),
             (505, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0]), rows[7], rows[7]]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    got = result(op2_neighbours.nearest(df, F.col("vec_id") % 5 == 0, k=7))
    assert same(got, brute(rows, lambda i: i % 5 == 0, 7))


def test_blocks_and_parts_do_not_lose_pairs(spark, monkeypatch):
    monkeypatch.setattr(op2_neighbours, "BLOCK_ROWS", 16)
    monkeypatch.setattr(op2_neighbours, "BLOCK_QUERIES", 4)
    monkeypatch.setattr(op2_neighbours, "RECALL", 1.1)  # all parts are searched
    g = np.random.default_rng(2)
    rows = [(i, g.normal(size=6).round(2).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = result(op2_neighbours.nearest(df, F.col("vec_id") % 10 == 0, k=5, sample=200, part_rows=100))
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    assert same(got, brute(rows, lambda i: i % 10 == 0, 5))


def test_a_block_gives_a_row_per_query_and_the_recall_stays():
    assert op2_neighbours.RECALL >= 0.985
    g = np.random.default_rng(5)
    x = g.normal(size=(50, 4))
    block = pa.table({"cid": np.arange(50), "vec": pa.array(x.tolist())})
    got = op2_neighbours.best_in_block(6)(block, block.slice(0, 9))
    assert got["query"].to_pylist() == list(range(9))
    for i, best in enumerate(got["best"].to_pylist()):
        assert [b["cid"] for b in best] == np.argsort(-(x @ x[i]), kind="stable")[:6].tolist()


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert op2_neighbours.nearest(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    got = result(op2_neighbours.nearest(spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], schema), F.lit(True)))
    assert got == {1: [(2, 0.0)], 2: [(1, 0.0)]}


def test_recall_on_the_given_vectors(spark):
    sf = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = result(op2_neighbours.nearest(df, F.col("vec_id") % 20 == 0))
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 20 == 0, 20)
    hits = sum(len({c for c, _ in got[q]} & {c for c, _ in want[q]}) for q in want)
    assert got.keys() == want.keys()
    assert hits >= 0.9 * sum(map(len, want.values()))


def found_share(got, want):
    return sum(len({c for c, _ in got[q]} & {c for c, _ in want[q]}) for q in want) / sum(map(len, want.values()))


def test_recall_through_many_parts_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = result(op2_neighbours.nearest(df, F.col("vec_id") % 20 == 0, sample=640, part_rows=100))
    assert found_share(got, brute([(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 20 == 0, 20)) >= 0.95


def test_probes_are_measured_on_rows_that_trained_nothing(spark):
    g = np.random.default_rng(6)  # no structure to learn: a small sample flatters itself
    rows = [(i, v.tolist()) for i, v in enumerate(g.normal(size=(4000, 8)).astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = result(op2_neighbours.nearest(df, F.col("vec_id") % 10 == 0, sample=1024, part_rows=125))
    assert found_share(got, brute(rows, lambda i: i % 10 == 0, 20)) >= 0.965


def test_parts_are_balanced_and_follow_the_graph():
    g = np.random.default_rng(0)
    centres = g.normal(size=(4, 8)) * 4
    x = np.concatenate([c + g.normal(size=(50, 8)) * 0.2 for c in centres])
    part = balanced_parts(x, neighbours(x, 5), 4)
    assert np.bincount(part, minlength=4).max() <= 55
    assert sum(len(set(part[i * 50:(i + 1) * 50].tolist())) for i in range(4)) <= 6


# --- language -----------------------------------------------------------------------------------

def test_forward_sums_all_segmentations():
    pieces = ("▁a", "a", "b", "ab", "ba", "▁ab", "bab")
    lattice = op6_language.Lattice(pieces)
    prob = np.random.default_rng(0).random((len(pieces), 2))
    weight = op6_language.scaled(prob, np.array([len(p) for p in pieces]))

    def ways(w, k):
        if not w:
            return 1.0
        return sum((prob[pieces.index(w[:n]), k] if w[:n] in pieces else (op6_language.UNKNOWN if n == 1 else 0)) * ways(w[n:], k)
                   for n in range(1, min(3, len(w)) + 1))

    words = ["▁ab", "▁abab", "▁c", "▁bba", "▁aabbab"]
    sizes, ends = lattice.find(words)
    last = op6_language.forward(sizes, ends, weight)[sizes, np.arange(len(words))] / (op6_language.SCALE ** sizes)[:, None]
    for i, k in itertools.product(range(len(words)), (0, 1)):
        assert last[i, k] == pytest.approx(ways(words[i], k))
    # expected counts: uses of pieces and unknown letters add up to the letters of all words
    counts = np.ones((len(words), 2))
    use = op6_language.expected(sizes, ends, weight, counts)
    known = (use * np.array([len(p) for p in pieces])[:, None]).sum(axis=0)
    assert (known <= sum(map(len, words)) + 1e-9).all() and (known > 0).all()


def test_long_words_and_pieces_are_whole(spark):
    pieces = op6_language.vocabulary(PIECES)
    assert max(len(p.lstrip("▁")) for p in pieces) > 12
    rng = np.random.default_rng(1)
    prob = rng.random((len(pieces), 2)) * 1e-3
    lattice = op6_language.Lattice(pieces)
    weight = op6_language.scaled(prob, np.array([len(p) for p in pieces]))
    at = {p: i for i, p in enumerate(pieces)}
    word = "▁" + "".join(rng.choice([p.lstrip("▁") for p in pieces], 60)) + "ж" * 40 + "donaudampfschiff" * 5

    alpha = [np.zeros(2)]  # plain recursion over all pieces, in logarithms
    for t in range(1, len(word) + 1):
        ways = [alpha[t - n] + np.log(prob[at[word[t - n:t]]] if word[t - n:t] in at else op6_language.UNKNOWN)
                for n in range(1, min(t, 17) + 1) if word[t - n:t] in at or n == 1]
        alpha.append(np.logaddexp.reduce(ways))
    for stretch in (7, 50, 4096):
        assert op6_language.forward_long(word, lattice, weight, stretch) == pytest.approx(alpha[-1], rel=1e-9)
    short = word[:40]
    sizes, ends = lattice.find([short])
    batch = np.log(op6_language.forward(sizes, ends, weight)[sizes, [0]][0]) - sizes[0] * np.log(op6_language.SCALE)
    assert op6_language.forward_long(short, lattice, weight) == pytest.approx(batch)


def test_language_accuracy_and_edges(spark):
    out = op6_language.op6_language(spark, SF)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = out.where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count()
    assert out.where("score < 0 or score > 1 or score is null").count() == 0


def test_language_defined_cases(spark):
    rows = [(1, "the cat and the dog", "en", 1.0), (2, "le chat et le chien", "fr", 1.0), (3, None, "en", 1.0), (4, "", None, 1.0),
            (5, "123 ² ½ !?", "fr", 1.0), (None, "the the the", None, 1.0), (1, "the cat and the dog", "en", 1.0),
            (6, "le " * 4000 + "x" * 500, None, 1.0)]
    docs = spark.createDataFrame(rows, DOCS)
    model = op6_language.fit(docs, PIECES)
    got = op6_language.label(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    by = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert got.count() == len(rows)
    assert by[3] == by[4] == by[5] == ("und", 0.0)
    assert (by[1][0], by[2][0], by[None][0], by[6][0]) == ("en", "fr", "en", "fr")
    empty = spark.createDataFrame([], DOCS)
    assert op6_language.label(empty, op6_language.fit(empty, PIECES)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in op6_language.label(docs, op6_language.fit(unlabelled, PIECES)).collect()} == {"und"}


# --- toxicity -----------------------------------------------------------------------------------

def test_transducers():
    chain = op5_toxicity.grammar()

    def run(symbols):
        state, out = chain.start, ""
        for s in symbols:
            state, o = chain.step(state, s)
            out += o
        return out

    assert run("OIO") == "OIO"
    assert run("YOI") == "YOe"
    assert run("NOI") == "NOa"
    assert run("NOOOI") == "NOOOI"
    assert run("ROIT") == "ROcd"
    assert run("RNI") == "RNa"
    assert run("YOT") == "YOf"
    reach = fst.within("N", 1, {"I": "a"})
    assert reach.step(1, "I") == (0, "a") and reach.step(0, "I") == (0, "I")


def test_toxicity_scores_clauses():
    s = op5_toxicity.Scorer({"idiot": 1.0, "lowei*": 0.5})
    f = lambda t: dict(zip(op5_toxicity.PATTERNS, s.features(t)))
    assert f("You are an idiot. Fine")["insult_target"] == 1.0
    assert f("He is not an idiot.")["insult_negated"] == 1.0
    assert f("She said idiot")["insult_reported"] == 1.0
    assert f("not. an Idiot")["insult"] == 1.0
    assert f("an idiotic view")["insult"] == 0.0
    assert f("loweix")["insult"] == 0.5
    assert sum(f("").values()) == 0


def plain_marks(s):
    """Marks of a clause by their definition, word by word."""
    out = list(s)
    for i, x in enumerate(s):
        if x in "IT":
            negated = "N" in s[max(0, i - 3):i]
            out[i] = ("ab" if negated else "cd" if "R" in s else "ef" if "Y" in s else "IT")[x == "T"]
    return "".join(out)


def test_composed_transducers_equal_definition():
    passes = op5_toxicity.passes()
    for n in range(6):
        for symbols in itertools.product("ITYNRO", repeat=n):
            assert fst.rewrite(passes, "".join(symbols)) == plain_marks("".join(symbols)), symbols


def test_toxicity_context_on_both_sides():
    s = op5_toxicity.Scorer({"idiot": 1.0, "idiots": 1.0})
    f = lambda t: dict(zip(op5_toxicity.PATTERNS, s.features(t)))
    assert f("idiots like you")["insult_target"] == 1.0
    assert f("'idiot', he said")["insult_reported"] == 1.0
    assert f("idiot and idiots")["insult"] == 2.0
    assert s.score(s.features("you idiot")) > s.score(s.features("an idiot")) > s.score(s.features("he said idiot"))
    assert s.score(s.features("he said idiot")) > s.score(s.features(""))


def test_toxicity_long_texts_and_clashing_columns(spark):
    rows = [(1, "word " * 300_000 + "you idiot", 0.5, "x"), (2, "fine", 0.5, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, toxic string")
    got = {r.doc_id: r for r in op5_toxicity.score_toxicity(docs, op5_toxicity.Scorer({"idiot": 1.0})).collect()}
    assert got[1].insult_target == 1.0 and got[1].score > got[2].score


def test_toxicity_held_out(spark):
    out = op5_toxicity.op5_toxicity(spark, "/root/testdata/sf0.1").select("doc_id", "held_out", "score", "predicted")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = out.where("held_out").join(labels, "doc_id")
    assert held.where("predicted = toxic").count() >= 0.95 * held.count()
    assert out.where("score is null or score < 0 or score > 1").count() == 0


def test_toxicity_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, "en", 1.0), (2, "", None, 1.0), (None, "x", None, 1.0), (2, "", None, 1.0)], DOCS)
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    got = op5_toxicity.score_toxicity(docs, op5_toxicity.fit(docs, labels)).collect()
    assert len(got) == 4 and len({r.score for r in got}) == 1 and got[0].score < 0.5
    empty = spark.createDataFrame([], DOCS)
    assert op5_toxicity.score_toxicity(empty, op5_toxicity.fit(empty, labels)).count() == 0


# --- quality ------------------------------------------------------------------------------------

def test_thresholds_stay_ordered_and_gradients_fit():
    r = np.random.default_rng(1)
    n = 400
    x = r.normal(size=n)
    grade = np.digitize(x + 0.1 * r.normal(size=n), [-0.5, 0.7])
    bounds = np.arange(n + 1)
    w, tau = op9_quality.fit_ordinal(np.zeros(n, np.int64), x, bounds, grade, 3, steps=400, rate=0.1)
    assert tau[0] < tau[1]
    cum = op9_quality.cumulative(x * w[0], tau)
    assert (np.diff(cum, axis=1).argmax(axis=1) == grade).mean() > 0.85


def test_quality_held_out_and_edges(spark):
    out = op9_quality.op9_quality(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = out.where("held_out").join(labels, "doc_id")
    assert held.where("selected = (quality = 1)").count() >= 0.95 * held.count()
    assert out.where("p_tail < 0 or p_tail > 1 or expected_grade < 0 or expected_grade > 2").count() == 0


def test_quality_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, "en", 1.0), (2, "", None, 1.0), (None, "a b", None, 1.0), (3, "w " * 20_000, None, 1.0)], DOCS)
    none = spark.createDataFrame([(1, None)], "doc_id long, grade int")
    got = op9_quality.score_quality(docs, *op9_quality.fit(docs, none), tail=1).collect()
    assert [(r.expected_grade, r.p_tail) for r in got] == [(0.0, 0.0)] * 4
    one = spark.createDataFrame([(1, 2), (3, 2)], "doc_id long, grade int")
    got = op9_quality.score_quality(docs, *op9_quality.fit(docs, one), tail=1).collect()
    assert [(r.expected_grade, r.p_tail) for r in got] == [(2.0, 1.0)] * 4
    two = spark.createDataFrame([(1, 0), (2, 0), (3, 5), (3, 5)], "doc_id long, grade int")
    got = op9_quality.score_quality(docs, *op9_quality.fit(docs, two), tail=5).collect()
    assert len(got) == 4 and all(0 <= r.p_tail <= 1 for r in got)
    empty = spark.createDataFrame([], DOCS)
    assert op9_quality.score_quality(empty, *op9_quality.fit(empty, two), tail=5).count() == 0
