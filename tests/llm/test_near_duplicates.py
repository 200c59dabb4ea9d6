import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import hexloom.llm.near_duplicates as nd
from hexloom.operators.components import components
from hexloom.llm.near_duplicates import least_link, matched, near_duplicates, one_of_each_class, prefix_length, shortened, signature, shingles


def brute(rows, threshold=0.8):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i, least[root(k)], links[k]) for k, (i, _) in enumerate(rows))


def corpus():
    r = random.Random(7)
    words = [f"w{k}" for k in range(400)]
    text = lambda n: [r.choice(words) for _ in range(n)]
    rows = []
    shared = text(60)
    for k in range(40):  # near copies of one text, some a link apart, some not
        base = text(r.choice([8, 30, 120]))
        for c in range(r.randint(1, 5)):
            t = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                t[r.randrange(len(t))] = r.choice(words)
            rows.append(" ".join(t))
    hot = text(200)
    for c in range(120):
        t = list(hot)
        t[r.randrange(200)] = r.choice(words)
        rows.append(" ".join(t))
    rows += [" ".join(hot)] * 50 + [" ".join(shared + text(40)) for _ in range(30)] + [None, "", " \n", "two words", "Two  WORDS", "two words more", "a b c d e", "a b c d e f g h i", "a b c d e f g h i j"]
    return list(enumerate(rows))


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 16)  # the hot cluster is cut into blocks
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).repartition(5)
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in near_duplicates(df).collect())
    assert got == brute(rows)


def test_edges(spark):
    df = spark.createDataFrame([(5, "x y z"), (5, "x y z"), (5, "an other text with the same id and more words"), (None, "x y z"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 5, 2), (5, 5, 2), (None, 5, 2), (5, 5, 0), (None, None, 0)], key=str)
    assert near_duplicates(df.where(F.lit(False))).count() == 0


def test_null_keys_link_and_stay_apart(spark):
    base = " ".join(f"w{k}" for k in range(60))
    near = base + " extra"
    df = spark.createDataFrame([(None, base), (3, near), (None, near + " more"), (None, "quite an other text of some words"), (2**60 + 1, "and one with a large key"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 3, 2), (3, 3, 2), (None, 3, 2), (None, None, 0), (2**60 + 1, 2**60 + 1, 0), (None, None, 0)], key=str)


def test_one_of_each_class(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(5, base, "b"), (5, base, "a"), (5, "a unique text under the same key of five", "c"), (7, base + " extra", "d"), (None, base, "e"), (None, "only a null key holds this text", "f"), (None, "only a null key holds this text", "f"), (8, None, "g"), (8, None, "g"), (9, " ", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, r1 string").repartition(4)
    got = sorted(tuple(r) for r in one_of_each_class(df).select("r1").collect())
    assert got == [("a",), ("c",), ("f",), ("g",), ("g",), ("h",)]
    assert one_of_each_class(df).columns == df.columns and one_of_each_class(df.where(F.lit(False))).count() == 0


def test_prefixes_are_shortened_by_what_a_set_can_be_linked_to(spark):
    assert [least_link(n) for n in (4, 6, 7, 8, 9, 1000)] == [0.8, 5 / 6, 6 / 7, 0.8, 0.8, 0.8]
    assert [shortened(n) for n in (4, 6, 7, 9, 500)] == [6, 7, 8, 6, 6]
    # Three nodes whose signatures agree in 6 hashes of one trie alone: the two that are shortened to 6 match past the one that is not.
    own = lambda k: np.arange(nd.TREES * nd.DEPTH).astype(">u2") + k * 1000
    signs = []
    for k, length in ((1, 6), (2, 8), (3, 6)):
        x = own(k).copy()
        x[: nd.DEPTH] = [7] * 6 + [k, k]
        signs.append((k, x.astype(">u2").tobytes(), length))
    df = spark.createDataFrame(signs, "u long, sign binary, length int")
    for parts in ("1", "8"):  # the matches across the borders of the order's parts too
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert [sorted(r) for r in matched(df, 6).distinct().collect()] == [[1, 3]]
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_prefixes_and_signatures():
    k = prefix_length()
    assert 1 - (1 - 0.8**k) ** nd.TREES >= nd.TARGET
    r = np.random.default_rng(3)
    found = 0
    for _ in range(200):
        a = r.integers(0, 1 << 63, 90).astype(np.uint64)
        b = np.r_[a[:80], r.integers(0, 1 << 63, 10).astype(np.uint64)]
        x, y = (np.frombuffer(signature(np.sort(s)), ">u2") for s in (a, b))
        found += abs((x == y).mean() - 0.8) < 0.15
    assert found > 195
    assert [len(s) for s in shingles(["word " * 100_000, None, "", "a b", "a b c d e f", "A\u2003b"])] == [1, 0, 0, 1, 2, 1]


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components(spark, kind):
    r = random.Random(1)
    edges = {"chain": [(k, k + 1) for k in range(60)], "star": [(99, k) for k in range(60)], "random": [(r.randrange(300), r.randrange(300)) for _ in range(200)]}[kind]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    want = {x: root(x) for x in parent if root(x) != x}
    got = {u: v for u, v in components(spark.createDataFrame(edges + edges[:3], "u long, v long")).collect()}
    assert got == want
