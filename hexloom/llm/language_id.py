"""Language of texts by a linear-chain conditional random field over words.

Every word of a text gets a label, one of the languages. A word's own score for
each label is the sum of the weights of its features: its prefixes and suffixes,
its letter n-grams, and a lexicon feature that says which languages' training texts
hold the word and how exclusively. A transition weight for each pair of labels ties
neighbours together, so that a word that fits several languages follows the words
around it, and a text may change its language. Forward and backward passes
give each word's probability of each label; a text's language is the label with the
largest mean probability, which is the score.

Training. Weights are learned by stochastic gradient steps on the log likelihood
of label sequences. The sequences are texts of the labelled rows; as labels are
given for whole texts, some sequences are spliced from two texts of different
languages, so that the transitions see what a change of language looks like. The
labelled rows are runs of ``SAMPLE_WORDS`` words that every training text is cut into from its begin to its
end, and a bounded sample of them is taken: of each language about ``SAMPLE_ROWS`` different runs with the
smallest hash, all where there are fewer, and ``MOST_ROWS`` in all. These bounds
concern fitting alone; every text is labelled whole.

The passes over a batch of texts run together: the words of all texts are cut into
runs of equal length, the product of a run's matrices carries the passes from one
run to the next, and all runs advance at once.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import small_batches

#: Labelled rows of each language that the field is fitted on, the most of all languages, and the words of such a row, which is a run of a text.
SAMPLE_ROWS, MOST_ROWS, SAMPLE_WORDS = 400, 40_000, 60
#: Letters that a run is taken to have where runs are counted for the share of the sample.
RUN_LETTERS = 360
#: Buckets of hashed features.
BUCKETS = 1 << 16
#: Passes over the sequences, sequences of a gradient step, its first length, and the weight of the penalty.
EPOCHS, STEP_ROWS, STEP, PENALTY = 6, 32, 0.5, 1e-5
#: Words of a run in the passes over a batch.
RUN = 64
#: Words times labels that the passes take at once, unless one text has more.
CELLS = 1 << 20
#: Words whose scores a task remembers.
REMEMBERED = 400_000
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case, with apostrophes between letters."""
    return _WORD.findall(text.lower()) if text else []


def _bucket(codes: list[np.ndarray], kind: int) -> np.ndarray:
    """The bucket of each tuple of character codes, apart for each kind of feature."""
    h = np.full(len(codes[0]), kind + 1, np.uint64)
    with np.errstate(over="ignore"):
        for c in codes:
            h = (h ^ c) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
    return (h % np.uint64(BUCKETS)).astype(np.int64)


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, one word after the other, and how many each word has.

    Letter n-grams of one to three characters with the word's borders, prefixes and
    suffixes of one to three letters, and the lexicon's class. A word over 40
    letters is described by its first and last twenty.
    """
    bordered = [f"^{w}$" if len(w) <= 40 else f"^{w[:20]}{w[-20:]}$" for w in words]
    size = np.array([len(w) for w in bordered])
    code = np.frombuffer("".join(bordered).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    end = np.cumsum(size)
    start, word = end - size, np.repeat(np.arange(len(words)), size)
    ids, owner = [], []
    for n in (1, 2, 3):
        at = np.flatnonzero(np.arange(len(code)) + n <= end[word])
        ids.append(_bucket([code[at + k] for k in range(n)], n))
        owner.append(word[at])
    for n in (2, 3, 4):
        own = np.flatnonzero(size >= n)
        ids += [_bucket([code[start[own] + k] for k in range(n)], 10 + n), _bucket([code[end[own] - n + k] for k in range(n)], 20 + n)]
        owner += [own, own]
    ids.append(_bucket([np.array([lexicon.get(w, -1) + 1 for w in words], np.uint64)], 30))
    owner.append(np.arange(len(words)))
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


@dataclass
class Field:
    """The learned field: labels, weights of hashed features, transitions, first-word weights, and the lexicon."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    lexicon: dict[str, int]

    def word_scores(self, words: list[str]) -> np.ndarray:
        ids, count = features(words, self.lexicon)
        return np.add.reduceat(self.weights[ids], np.r_[0, np.cumsum(count)[:-1]])


def _passes(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each word, and expected transitions, of padded sequences: scores (sequence, word, label)."""
    m, n, k = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    move, begin = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    inside = np.arange(n)[None, :] < sizes[:, None]
    a, b = np.empty((n, m, k)), np.ones((n, m, k))
    a[0] = begin * e[:, 0]
    a[0] /= a[0].sum(axis=1, keepdims=True)
    for t in range(1, n):
        a[t] = (a[t - 1] @ move) * e[:, t]
        a[t] /= a[t].sum(axis=1, keepdims=True)
    for t in range(n - 2, -1, -1):
        x = (e[:, t + 1] * b[t + 1]) @ move.T
        b[t] = np.where(inside[:, t + 1, None], x / x.sum(axis=1, keepdims=True), 1.0)
    p = a * b
    p /= p.sum(axis=2, keepdims=True)
    edges = a[:-1, :, :, None] * move * (e.transpose(1, 0, 2)[1:] * b[1:])[:, :, None, :]
    edges /= edges.sum(axis=(2, 3), keepdims=True)
    return p.transpose(1, 0, 2), edges[inside.T[1:]].sum(axis=0)


def lexicon_of(texts: list[list[str]], labels: list[int], n_labels: int) -> dict[str, int]:
    """For each word of the training texts a class: its commonest language and whether it is exclusive, usual or shared there."""
    counts: dict[str, Counter] = {}
    totals = np.zeros(n_labels)
    for words, label in zip(texts, labels):
        totals[label] += len(words)
        for w in words:
            counts.setdefault(w, Counter())[label] += 1
    out = {}
    for w, c in counts.items():
        if sum(c.values()) > 1:
            rates = np.array([c[k] / max(totals[k], 1) for k in range(n_labels)])
            top = int(rates.argmax())
            share = rates[top] / rates.sum()
            out[w] = top * 3 + (2 if share > 0.98 else 1 if share > 0.7 else 0)
    return out


def fit(rows: list[tuple[str, str]], seed: int = 1) -> Field:
    """A field from (text, language) rows; the same for the same rows in any order."""
    rows = sorted((t, g) for t, g in rows if words_of(t))
    labels = sorted({g for _, g in rows})
    texts = [words_of(t) for t, _ in rows]
    own = [labels.index(g) for _, g in rows]
    k = len(labels)
    random = np.random.default_rng(seed)
    # Half of the rows make the lexicon that the other half is fitted with, and the other way round, so that a
    # word that only one training text holds says no more there than it will in a new text.
    half = random.integers(0, 2, len(rows))
    lexicons = [lexicon_of([t for t, h in zip(texts, half) if h != side], [g for g, h in zip(own, half) if h != side], k) for side in (0, 1)]
    cache: list[dict[str, np.ndarray]] = [{}, {}]

    def rows_of(side: int, words: list[str]) -> list[np.ndarray]:
        known = cache[side]
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            ids, count = features(new, lexicons[side])
            known |= zip(new, np.split(ids, np.cumsum(count)[:-1]))
        return [known[w] for w in words]

    sequences = []
    for i, (words, label) in enumerate(zip(texts, own)):
        found, gold = rows_of(half[i], words), [label] * len(words)
        if i % 3 == 0 and len(rows) > 1:  # splice in a run of another text
            j = int(random.integers(len(rows)))
            cut, take = int(random.integers(len(words) + 1)), int(random.integers(1, len(texts[j]) + 1))
            found = found[:cut] + rows_of(half[j], texts[j][:take]) + found[cut:]
            gold = gold[:cut] + [own[j]] * take + gold[cut:]
        sequences.append((found, np.array(gold)))
    weights, transitions, start = np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k)
    squares, t_squares, s_squares = np.full((BUCKETS, k), 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)
    for _ in range(EPOCHS if k > 1 else 0):
        order = random.permutation(len(sequences))
        for at in range(0, len(order), STEP_ROWS):
            some = [sequences[i] for i in order[at : at + STEP_ROWS]]
            sizes = np.array([len(gold) for _, gold in some])
            ids = [f for found, _ in some for f in found]
            lengths = np.array([len(f) for f in ids])
            summed = np.add.reduceat(weights[np.concatenate(ids)], np.r_[0, np.cumsum(lengths)[:-1]])
            inside = np.arange(sizes.max())[None, :] < sizes[:, None]
            scores = np.zeros((len(some), sizes.max(), k))
            scores[inside] = summed
            p, gt = _passes(scores, sizes, transitions, start)
            gold = np.concatenate([gold for _, gold in some])
            own_p, words = p[inside], len(gold)
            own_p[np.arange(words), gold] -= 1
            pairs = [(g[:-1], g[1:]) for _, g in some]
            np.add.at(gt, (np.concatenate([x for x, _ in pairs]), np.concatenate([y for _, y in pairs])), -1)
            gs = own_p[np.r_[0, np.cumsum(sizes)[:-1]]].sum(axis=0)
            flat, grad = np.concatenate(ids), np.repeat(own_p, lengths, axis=0) / words
            used, at_used = np.unique(flat, return_inverse=True)
            g = np.zeros((len(used), k))
            np.add.at(g, at_used, grad)
            g += PENALTY * weights[used]
            for value, gradient, square in ((transitions, gt / words, t_squares), (start, gs / words, s_squares)):
                square += gradient**2
                value -= STEP * gradient / np.sqrt(square)
            squares[used] += g**2
            weights[used] -= STEP * g / np.sqrt(squares[used])
    return Field(labels, weights.astype(np.float32), transitions, start, lexicon_of(texts, own, k))


def marginals(scores: np.ndarray, firsts: np.ndarray, transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Label probabilities of each word of many texts laid end to end; ``firsts`` marks each text's first word.

    A first word has a matrix whose rows are all alike, so nothing passes from one text to the next.
    """
    n, k = scores.shape
    runs = -(-n // RUN)
    e = np.ones((runs * RUN, k))
    e[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    first = np.zeros(runs * RUN, bool)
    first[:n], first[n:] = firsts, True
    e, first = e.reshape(runs, RUN, k), first.reshape(runs, RUN)
    move, begin = np.exp(transitions - transitions.max()), np.exp(start - start.max())[None, :]

    def norm(x: np.ndarray) -> np.ndarray:
        return x / x.sum(axis=-1, keepdims=True)

    # A run as a matrix: from the label before it to the label of its last word.
    product = np.broadcast_to(np.eye(k), (runs, k, k)).copy()
    for t in range(RUN):
        f = first[:, t, None, None]
        moved = (product.reshape(-1, k) @ move).reshape(runs, k, k)
        into = np.where(f, product.sum(axis=2, keepdims=True) * begin[:, None, :], moved)
        product = into * e[:, t, None, :]
        product /= product.sum(axis=(1, 2), keepdims=True)
    # What enters each run from the left.
    enter = np.empty((runs, k))
    state = np.full(k, 1 / k)
    for r in range(runs):
        enter[r] = state
        state = norm(state @ product[r])
    forward = np.empty((runs, RUN, k))
    state = enter
    for t in range(RUN):
        state = norm(np.where(first[:, t, None], begin, state @ move) * e[:, t])
        forward[:, t] = state
    # What enters each run from the right, for the word before it.
    leave = np.empty((runs, k))
    state = np.full(k, 1 / k)
    for r in range(runs - 1, -1, -1):
        leave[r] = state
        state = norm(product[r] @ state)
    # `leave` and the state inside a run are, for a word, how likely what follows it is by its label.
    state = leave
    for t in range(RUN - 1, -1, -1):
        forward[:, t] = norm(forward[:, t] * state)
        state = np.where(first[:, t, None], 1.0 / k, (e[:, t] * state) @ move.T)
        state = norm(state)
    return forward.reshape(-1, k)[:n]


class Labeller:
    """A field with the scores of the words it has met."""

    def __init__(self, field: Field):
        self.field = field
        self.known: dict[str, int] = {}
        self.used = 0
        self.scores = np.zeros((1024, max(len(field.labels), 1)))

    def places(self, words: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[w] for w in words]
        except KeyError:
            pass
        new = [w for w in dict.fromkeys(words) if w not in known]
        known |= {w: -1 for w in new if not any(map(str.isalpha, w))}  # other numerals than digits
        if new := [w for w in new if w not in known]:
            while self.used + len(new) > len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.scores[self.used : self.used + len(new)] = self.field.word_scores(new)
            known |= {w: self.used + k for k, w in enumerate(new)}
            self.used += len(new)
        return [known[w] for w in words]

    def label(self, texts) -> tuple[list[str], list[float]]:
        """The language and score of each text."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.used = 0
        names: list[str] = []
        scores: list[float] = []
        run: list[list[str]] = []
        held, most = 0, CELLS // max(len(self.field.labels), 1)
        for text in texts:
            run.append(words_of(text))
            held += len(run[-1])
            if held > most:
                self._label(run, names, scores)
                run, held = [], 0
        self._label(run, names, scores)
        return names, scores

    def _label(self, run: list[list[str]], names: list[str], scores: list[float]) -> None:
        if not self.field.labels:
            names += [UNKNOWN] * len(run)
            scores += [0.0] * len(run)
            return
        size = np.array([len(r) for r in run], np.int64)
        places = np.array(self.places([w for r in run for w in r]), np.int64)
        if len(places) and places.min() < 0:
            size = np.bincount(np.repeat(np.arange(len(size)), size)[places >= 0], minlength=len(size))
            places = places[places >= 0]
        has = np.flatnonzero(size)
        found, sure = [UNKNOWN] * len(size), [0.0] * len(size)
        if len(has):
            at = np.r_[0, np.cumsum(size[has])[:-1]]
            firsts = np.zeros(int(size.sum()), bool)
            firsts[at] = True
            p = marginals(self.scores[places], firsts, self.field.transitions, self.field.start)
            mean = np.add.reduceat(p, at) / size[has][:, None]
            for i, row in zip(has, mean):
                found[i] = self.field.labels[int(row.argmax())]
                sure[i] = float(min(max(row.max(), 0.0), 1.0))
        names += found
        scores += sure


def runs_below(text: str, share: float) -> list[str]:
    """The runs of ``SAMPLE_WORDS`` words of a whole text, the last as long as it is, whose hash is below a share of all hashes."""
    words = words_of(text)
    runs = {" ".join(words[k : k + SAMPLE_WORDS]) for k in range(0, len(words), SAMPLE_WORDS)}
    return [r for r in runs if int.from_bytes(hashlib.blake2b(r.encode("utf-8", "replace"), digest_size=8).digest()) < share * 2**64]


def train(docs: DataFrame, text: str = "text", label: str = "lang", rows: int = SAMPLE_ROWS) -> Field:
    """Fit a field on about ``rows`` different runs of each label of ``docs``, those with the smallest hash; all where there are no more.

    The labelled rows are the runs of ``SAMPLE_WORDS`` words that every text, whatever its length, is cut into from its begin to its end; with many labels
    there are ``MOST_ROWS`` in all. Copies of a text count once, so the field does not depend on how many there are. Rows with a null label or text
    take no part. Every label is learned. Without rows the field has no labels, and every text is ``und``.
    """
    small_batches(docs.sparkSession)
    given = docs.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    given = given.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text"), F.xxhash64(text, label).alias("h"))
    counts = given.select("label", "h", F.ceil(F.length("text") / RUN_LETTERS).alias("runs")).distinct().groupBy("label").agg(F.sum("runs").alias("runs"))
    counts = counts.collect()  # a row for each label
    each = min(rows, max(1, MOST_ROWS // max(1, len(counts))))
    # Hashes are even: of n different runs, those below a share of each / n of all hashes are about so many.
    shares = {r["label"]: each / r["runs"] for r in counts}

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            picked = [(run, g) for t, g in zip(b["text"], b["label"]) for run in runs_below(t, shares[g])]
            yield pd.DataFrame(picked, columns=["text", "label"])

    picked = given.select("text", "label").mapInPandas(pick, "text string, label string").distinct()
    return fit([(r["text"], r["label"]) for r in picked.orderBy("label", F.xxhash64("text"), "text").collect()])


def predict(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with lang_pred and score (0 to 1).

    A null text and a text without a letter get ``und`` and a score of 0. Texts are
    labelled whole. Columns of ``docs`` with these names are replaced; repeated rows
    each get a result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(field)  # its size is bounded by BUCKETS, the labels and the sample
    own = [f for f in docs.schema.fields if f.name not in {"lang_pred", "score"}]
    schema = StructType([*own, *StructType.fromDDL("lang_pred string, score double").fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(shared.value)  # for this task, so that its memory goes with it
        for batch in batches:
            names, scores = labeller.label(batch["\0text"])
            yield batch.drop(columns="\0text").assign(lang_pred=names, score=scores)

    return docs.select(*[f.name for f in own], docs[text].alias("\0text")).mapInPandas(run, schema)
