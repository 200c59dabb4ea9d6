import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hexloom.llm.lm import BEGIN, END, discounts, score, train, words_of
import hexloom.llm.lm as lm


class Brute:
    """The same model with dictionaries of strings."""

    def __init__(self, texts):
        self.bigrams = Counter()
        for t in texts:
            run = ["<s>", *words_of(t), "</s>"]
            self.bigrams.update(zip(run, run[1:]))
        self.count, self.ends, self.total = Counter(), Counter(), Counter()
        for (u, w), c in self.bigrams.items():
            self.count[w] += c
            self.ends[w] += 1
            self.total[u] += c
        kinds = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        self.high, self.low = discounts(*kinds(self.bigrams.values())), discounts(*kinds(self.ends.values()))

    def d(self, table, c):
        return table[min(c, 3) - 1] if c else 0

    def word(self, w):
        n = len(self.bigrams)
        left = sum(self.d(self.low, c) for c in self.ends.values()) / n
        return max(self.ends[w] - self.d(self.low, self.ends[w]), 0) / n + left / (len(self.count) + 1)

    def p(self, u, w):
        if not self.total[u]:
            return self.word(w)
        left = sum(self.d(self.high, c) for (x, _), c in self.bigrams.items() if x == u) / self.total[u]
        c = self.bigrams[u, w]
        return max(c - self.d(self.high, c), 0) / self.total[u] + left * self.word(w)

    def score(self, text):
        run = ["<s>", *words_of(text), "</s>"]
        n, v = sum(self.count.values()), len(self.count)
        base = sum(math.log10((self.count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in run[1:])
        return len(run) - 1, sum(self.count[w] > 0 for w in run[1:]), n, base, sum(math.log10(self.p(u, w)) for u, w in zip(run, run[1:]))


def corpus(n=120):
    r = random.Random(2)
    words = [f"w{k}" for k in range(60)] + ["É", "The", "the"]
    return [" ".join(r.choice(words[: r.choice([5, 20, 63])]) for _ in range(r.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("fanout", [1024, 3])
def test_against_brute_force(spark, monkeypatch, fanout):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 40)
    monkeypatch.setattr(lm, "FANOUT", fanout)  # with 3 the counts take two steps to their shards
    monkeypatch.setattr(lm, "WORD_SHARDS", 7)
    monkeypatch.setattr(lm, "PART_BYTES", 1000)
    texts = [*corpus(), "hot pair " * 700]
    test = [*texts[:10], "unseen words only here", "w1 unseen w2", None, "", "The\x0bTHE x É", "w1 " * 30_000]
    brute = Brute(texts)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    model = train(docs)
    got = score(spark.createDataFrame([(k, t, "clash") for k, t in enumerate(test)], "doc_id long, text string, score string"), model).collect()
    assert len(got) == len(test)
    for r in got:
        n, known, total, base, want = brute.score(test[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(want, rel=1e-9)


def test_probabilities_sum_to_one():
    brute = Brute(corpus())
    for u in ("w1", "<s>", "never"):
        assert sum(brute.p(u, w) for w in [*brute.count, "unknown"]) == pytest.approx(1)


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    model = train(docs.where(F.lit(False)))
    assert {r.score for r in score(docs, model).collect() if r.text is None} == {0.0}
    assert score(docs.where(F.lit(False)), train(docs)).count() == 0
    assert train(docs).tokens == 7
    assert BEGIN != END


def test_files_that_cannot_be_mapped(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 40)
    model = train(spark.createDataFrame([(t,) for t in corpus()], "text string"))
    mapped, read = lm.Scorer(model), lm.Scorer(model)
    read.local = False
    monkeypatch.setattr(lm, "KEPT_BYTES", 3000)
    a, b = (s.score(corpus()[:20]) for s in (mapped, read))
    assert all((a[k] == b[k]).all() for k in a) and len(read.open) < len(mapped.open)
