"""Randomised cases: column expressions vs plain Python models of the semantics."""

import itertools
import random

from pyspark.sql import functions as F

from clickfeat.functions.text import clean_tokens, ngrams
from clickfeat.operators import catalogue as cat
from clickfeat.operators.rewrites import rewrite_rows

WORDS = ["a", "b", "ab", "Nike", "nike", "42", "x²", "²", "", "shoes", "run"]


def rnd_text(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def test_relevance_random(spark):
    r = random.Random(5)
    cases = []
    for i in range(300):
        q = rnd_text(r, r.randint(1, 5))
        kw = [r.choice(WORDS) for _ in range(r.randint(0, 4))]
        cases.append((i, q, kw))
    df = spark.createDataFrame(cases, "i int, query string, keywords array<string>")
    got = {row.i: row.rel for row in df.select("i", cat.relevance_expr().alias("rel")).collect()}
    for i, q, kw in cases:
        ks = set(kw)
        want = (sum(t in ks for t in q.split(" ")) / len(ks)) if ks else None
        assert got[i] == want, (q, kw)


def test_cleaner_and_ngrams_random(spark):
    r = random.Random(6)
    cases = [(i, rnd_text(r, r.randint(0, 8))) for i in range(300)]
    df = spark.createDataFrame(cases, "i int, t string")
    rows = df.select("i", clean_tokens("t").alias("c"),
                     ngrams(F.filter(F.split("t", " ", -1), lambda x: x != ""), 3).alias("g")).collect()
    got = {row.i: (row.c, row.g) for row in rows}
    for i, t in cases:
        toks = t.split(" ")
        clean = " ".join(x for x in toks if not x.isdigit() and len(x) > 1)
        w = [x for x in toks if x != ""]
        grams = [" ".join(w[j:j + n]) for n in (1, 2, 3) for j in range(len(w) - n + 1)]
        assert got[i] == (clean, grams), t


def test_rewrite_product_random(spark):
    r = random.Random(7)
    vocab = ["a", "b", "c", "d"]
    syn = {w: [r.choice(vocab) for _ in range(r.randint(0, 3))] + [w] for w in vocab[:3]}
    queries = sorted({" ".join(r.choice(vocab + ["e"]) for _ in range(r.randint(1, 4))) for _ in range(60)})
    qdf = spark.createDataFrame([(q,) for q in queries], "query string")
    sdf = spark.createDataFrame(list(syn.items()), "word string, synonyms array<string>")
    got = {}
    for row in rewrite_rows(qdf, sdf).collect():
        got.setdefault(row.query_key, []).append((row.idx, row.rewrite))
    for q in queries:
        alts = [syn.get(t, [t]) for t in q.split(" ")]
        seen, want = set(), []
        for combo in itertools.product(*alts):
            s = "_".join(combo)
            if s not in seen:
                seen.add(s)
                want.append(s)
        assert [s for _, s in sorted(got["_".join(q.split(" "))])] == want, q
