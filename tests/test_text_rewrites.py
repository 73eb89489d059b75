"""Token cleaning, windows, n-grams, rewrites, neighbours."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from clickfeat.functions.text import clean_tokens, ngrams, query_key, token_windows
from clickfeat.operators.neighbours import top_k_cosine
from clickfeat.operators.rewrites import rewrite_lines, rewrite_rows


def one(spark, expr, value, t="string"):
    return spark.createDataFrame([(value,)], f"x {t}").select(expr.alias("y")).first().y


def test_clean_tokens(spark):
    assert one(spark, clean_tokens(F.lower("x")), "Nike 42 a running") == "nike running"
    assert one(spark, clean_tokens("x"), "x 12 ab") == "ab"


def test_query_key(spark):
    assert one(spark, query_key("x"), "running shoes") == "running_shoes"


def test_windows_and_ngrams(spark):
    assert one(spark, token_windows(F.col("x"), 2), ["a", "b", "c"], "array<string>") == [["a", "b"], ["b", "c"]]
    assert one(spark, token_windows(F.col("x"), 3), ["a", "b"], "array<string>") == []
    assert one(spark, ngrams(F.col("x"), 2), ["a", "b", "c"], "array<string>") == ["a", "b", "c", "a b", "b c"]


def test_rewrite_order_and_fallback(spark):
    q = spark.createDataFrame([("a b",)], "query string")
    syn = spark.createDataFrame([("a", ["x", "a"])], "word string, synonyms array<string>")
    r = rewrite_lines(rewrite_rows(q, syn)).first()
    assert r.query_key == "a_b" and r.rewrites == ["x_b", "a_b"]


def test_rewrite_product_dedupes_in_order(spark):
    q = spark.createDataFrame([("a b",)], "query string")
    syn = spark.createDataFrame([("a", ["x", "x", "a"]), ("b", ["y", "b"])], "word string, synonyms array<string>")
    assert rewrite_lines(rewrite_rows(q, syn)).first().rewrites == ["x_y", "x_b", "a_y", "a_b"]


def brute_top_k(ids, vecs, k):
    m = np.array(vecs, dtype=np.float64)
    n = np.linalg.norm(m, axis=1)
    s = (m @ m.T) / np.outer(n, n)
    out = {}
    for i, qid in enumerate(ids):
        cand = sorted(((-s[i, j], ids[j]) for j in range(len(ids)) if ids[j] != qid))[:k]
        out[qid] = [c for _, c in cand]
    return out


def test_top_k_cosine_matches_brute_force_across_blocks(spark):
    rng = np.random.default_rng(7)
    ids = list(range(60))
    vecs = rng.integers(-2, 3, size=(60, 4)).astype(float).tolist()   # small ints -> many exact ties
    vecs = [[float(x) for x in v] if any(v) else [1.0, 0.0, 0.0, 0.0] for v in vecs]
    df = spark.createDataFrame(list(zip(ids, vecs)), "vec_id bigint, embedding array<double>")
    expect = brute_top_k(ids, vecs, 5)
    for block in (7, 16384):
        got = {}
        for r in top_k_cosine(df, "vec_id", "embedding", 5, block_rows=block).collect():
            got.setdefault(r.vec_id, []).append((r.rank, r.other_id))
        got = {k: [o for _, o in sorted(v)] for k, v in got.items()}
        assert got == expect


def product_rows(queries, syn):
    """(query_key, idx, rewrite) by nested loops; of queries with one key the smallest."""
    by_key = {}
    for q in sorted(set(queries), reverse=True):
        by_key[q.replace(" ", "_")] = q
    out = []
    for key, q in by_key.items():
        options = [syn.get(t, [t]) for t in q.split(" ")]
        seen = dict.fromkeys("_".join(x) for x in itertools.product(*options))
        out += [(key, i, s) for i, s in enumerate(seen)]
    return sorted(out)


def test_rewrites_equal_nested_loops(spark, monkeypatch):
    from clickfeat.operators import rewrites as rw
    queries = ["a b c", "b", "c a", "a a", "", "a b", "a_b", "a  c"]
    syn = {"a": ["x", "y", "a"], "c": ["b", "c"], "b": ["b"], "a_b": ["z", "a_b"], "": ["e", ""]}
    qdf = spark.createDataFrame([(q,) for q in [*queries, *queries, None]], "query string")
    sdf = spark.createDataFrame(list(syn.items()), "word string, synonyms array<string>")
    for width in (1, 2, 1024):
        monkeypatch.setattr(rw, "RANGE_ROWS", width)
        assert sorted(map(tuple, rewrite_rows(qdf, sdf).collect())) == product_rows(queries, syn)
    assert rewrite_rows(qdf.limit(0), sdf).count() == 0
    assert rewrite_rows(qdf.where("query = 'a b'"), sdf.limit(0)).first().rewrite == "a_b"


def test_twelve_terms_are_dealt_over_tasks_and_lines(spark):
    words = [f"w{i}" for i in range(12)]
    syn = {w: [f"{w}x", f"{w}y", w] if i % 2 else [f"{w}x", w] for i, w in enumerate(words)}
    qdf = spark.createDataFrame([(" ".join(words),), ("w0",)], "query string")
    rows = rewrite_rows(qdf, spark.createDataFrame(list(syn.items()), "word string, synonyms array<string>"))
    want = product_rows([" ".join(words), "w0"], syn)
    assert sorted(map(tuple, rows.collect())) == want and len(want) == 6 ** 6 + 2
    lines = sorted((r.query_key, r.chunk, r.rewrites) for r in rewrite_lines(rows, 10000).collect())
    assert max(len(x[2]) for x in lines) == 10000
    assert [s for k, _, x in lines if k != "w0" for s in x] == [s for k, _, s in want if k != "w0"]


def test_block_task_sub_chunks_agree():
    import pandas as pd
    from clickfeat.operators.neighbours import _block_topk
    rng = np.random.default_rng(3)
    q = pd.DataFrame({"qid": np.arange(20), "qvec": list(rng.normal(size=(20, 6)))})
    c = pd.DataFrame({"cid": np.arange(10, 40), "cvec": list(rng.normal(size=(30, 6)))})
    a = _block_topk(5, sub_rows=3)(q, c).sort_values(["qid", "cid"]).reset_index(drop=True)
    b = _block_topk(5, sub_rows=1024)(q, c).sort_values(["qid", "cid"]).reset_index(drop=True)
    assert a.equals(b) and len(a) >= 20 * 5


def test_clean_tokens_follows_python_isdigit(spark):
    text = "x² ² ³4 ①② ٣٤ ab 1a a"
    want = " ".join(t for t in text.split(" ") if not t.isdigit() and len(t) > 1)
    assert one(spark, clean_tokens("x"), text) == want == "x² ab 1a"


def _plan(spark, df):
    return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_the_product_is_not_shuffled(spark):
    from clickfeat.operators.rewrites import rewrite_rows
    q = spark.createDataFrame([("a b c",), ("d a",)], "query string")
    syn = spark.createDataFrame([("a", ["x", "y", "x", "a"]), ("b", ["b1", "b"])], "word string, synonyms array<string>")
    rows = rewrite_rows(q, syn)
    plan = _plan(spark, rows)
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan
    got = sorted((r.query_key, r.idx, r.rewrite) for r in rows.collect())
    assert got == sorted([("a_b_c", i, w) for i, w in enumerate(["x_b1_c", "x_b_c", "y_b1_c", "y_b_c", "a_b1_c", "a_b_c"])]
                         + [("d_a", i, w) for i, w in enumerate(["d_x", "d_y", "d_a"])])


def test_alternatives_that_hold_the_separator_are_told_apart(spark):
    from clickfeat.operators.rewrites import rewrite_rows
    q = spark.createDataFrame([("a b",), ("c d",)], "query string")
    syn = spark.createDataFrame([("a", ["x", "x_y", "a"]), ("b", ["y_z", "z", "b"])], "word string, synonyms array<string>")
    got = sorted((r.query_key, r.idx, r.rewrite) for r in rewrite_rows(q, syn).collect())
    want, seen = [], set()
    for one in ("x", "x_y", "a"):
        for two in ("y_z", "z", "b"):
            if (w := f"{one}_{two}") not in seen:
                seen.add(w)
                want.append(("a_b", len(want), w))
    assert got == sorted([*want, ("c_d", 0, "c_d")]) and len(want) == 8


def test_an_oversized_query_does_not_stop_the_others(spark):
    from clickfeat.operators.rewrites import oversized_queries, rewrite_rows
    q = spark.createDataFrame([(" ".join(["t"] * 25),), ("x y",)], "query string")
    syn = spark.createDataFrame([("t", [f"s{i}" for i in range(5)] + ["t"])], "word string, synonyms array<string>")
    assert [(r.query_key, r.idx, r.rewrite) for r in rewrite_rows(q, syn).collect()] == [("x_y", 0, "x_y")]
    big = oversized_queries(q, syn).collect()
    assert len(big) == 1 and abs(big[0].n_rewrites / 6.0 ** 25 - 1) < 1e-9
