import numpy as np
import pytest
from pyspark.sql import functions as F

from hexloom.llm import language_id as li
from hexloom.llm.lm import held_out


def slow_marginals(scores, firsts, transitions, start):
    """One text after the other, by sums over logarithms."""
    cuts = [*np.flatnonzero(firsts), len(scores)]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        s = scores[a:b]
        f, g = np.zeros_like(s), np.zeros_like(s)
        f[0] = s[0] + start
        for t in range(1, len(s)):
            f[t] = np.logaddexp.reduce(f[t - 1][:, None] + transitions, axis=0) + s[t]
        for t in range(len(s) - 2, -1, -1):
            g[t] = np.logaddexp.reduce(transitions + s[t + 1] + g[t + 1], axis=1)
        out.append(np.exp(f + g - np.logaddexp.reduce(f[-1])))
    return np.concatenate(out)


@pytest.mark.parametrize("k", [2, 4, 7])
def test_passes_against_one_text_at_a_time(k):
    r = np.random.default_rng(k)
    scores, transitions, start = r.normal(size=(1000, k)) * 3, r.normal(size=(k, k)) * 2, r.normal(size=k)
    firsts = r.random(1000) < 0.02
    firsts[0] = True
    firsts[300:305] = True
    np.testing.assert_allclose(li.marginals(scores, firsts, transitions, start), slow_marginals(scores, firsts, transitions, start), atol=1e-9)


def test_training_passes_agree():
    r = np.random.default_rng(1)
    scores, transitions, start = r.normal(size=(3, 9, 4)), r.normal(size=(4, 4)), r.normal(size=4)
    sizes = np.array([9, 1, 5])
    p, edges = li._passes(scores, sizes, transitions, start)
    for q, s, n in zip(p, scores, sizes):
        firsts = np.arange(n) == 0
        np.testing.assert_allclose(q[:n], slow_marginals(s[:n], firsts, transitions, start), atol=1e-9)
    assert edges.sum() == pytest.approx((sizes - 1).sum())


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", held_out(F.col("doc_id"), 3, 1))
    return docs, li.train(docs.where("not held_out"))


def test_held_out_accuracy(trained):
    docs, field = trained
    got = li.predict(docs.where("held_out"), field).toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_switches_inside_a_text(trained):
    _, field = trained
    english, german = "the thing that is there with the nation of reading", "und der die ist nicht aulich für sich einverlich geheit"
    words = li.words_of(f"{english} {german} {english}")
    labeller = li.Labeller(field)
    p = li.marginals(labeller.scores[labeller.places(words)] if labeller.places(words) else None, np.arange(len(words)) == 0, field.transitions, field.start)
    labels = [field.labels[k] for k in p.argmax(axis=1)]
    assert labels.count("de") >= 8 and set(labels[:8]) == {"en"} and set(labels[-8:]) == {"en"}


def test_edges(spark, trained):
    _, field = trained
    rows = [(1, None, 5), (2, "", 5), (3, "12 34 !? ½ ²", 5), (4, "漢字", 5), (5, "the " * 40_000, 5), (6, "und der", 5), (6, "und der", 5), (7, "x" * 100_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = {r.doc_id: r for r in li.predict(df, field).collect()}
    assert [(got[k].lang_pred, got[k].score) for k in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4].lang_pred in field.labels and got[7].lang_pred in field.labels
    assert (got[5].lang_pred, got[6].lang_pred) == ("en", "de")
    assert li.predict(df.where(F.lit(False)), field).count() == 0
    none = li.train(spark.createDataFrame([("a", None), (None, "en"), ("12", "en")], "text string, lang string"))
    assert none.labels == [] and {r.lang_pred for r in li.predict(df, none).collect()} == {"und"}
    one = li.train(spark.createDataFrame([("a b", "xx")] * 3, "text string, lang string"))
    assert {r.lang_pred for r in li.predict(df.where("doc_id > 3"), one).collect()} == {"xx"}


def test_sample_counts_copies_once(spark, monkeypatch):
    numbers = "12 34 " * 400
    one = spark.range(10_000).selectExpr("'ein text' as text", "'one' as lang")
    many = spark.range(5_000).selectExpr("'a copy' as text", "'many' as lang").unionByName(spark.range(100).selectExpr("concat('word', repeat('x', cast(id as int))) as text", "'many' as lang"))
    late = spark.createDataFrame([(numbers + "late words", "late")], "text string, lang string")
    large = spark.range(4_000).selectExpr("concat('w ', repeat('ab', cast(id % 50 as int)), ' ', repeat('cd', cast(id div 50 as int))) as text", "'large' as lang")
    docs = one.unionByName(many).unionByName(late).unionByName(large)
    monkeypatch.setattr(li, "fit", lambda rows: sorted(rows))
    got = li.train(docs)
    count = lambda g: sum(x == g for _, x in got)
    assert [count(g) for g in ("one", "many", "late")] == [1, 101, 1] and 300 < count("large") < 500
    assert ("late words", "late") in got and len(set(got)) == len(got)
    assert li.train(docs.unionByName(docs)) == got
