"""Interpolated modified Kneser-Ney bigram model, counted in Spark, kept as sorted hash arrays.

Counting. Map tasks turn texts into word hashes and count bigrams per batch of
texts; the counts travel as packed arrays, one for each shard of the 64-bit
bigram hash, so that no word is a row and no key, however frequent, is more
than one entry for each task. A reduce task merges the arrays of one shard, writes
them sorted, and passes on, for each word, how many bigrams it starts (by the
counts 1, 2, 3 and more that fix its discounts) and how many it ends, again as
packed arrays for each shard of the word hash. A second set of tasks adds these up
into the word table. The number of shards grows with the corpus.

Storage. A shard of bigrams is a file of sorted 64-bit hashes followed by their
counts; the word table is the same with six numbers for each word. The files are in
the shared folder, under names of their own, written under an attempt's name and
renamed. Workers map them into memory and find hashes by binary search, in sorted
order, so that only pages that a batch touches are read.

Probabilities. With discounts D1, D2, D3+ of each order from its counts of counts,

    p(w | u) = max(c(u w) - D(c), 0) / c(u .) + g(u) p(w)
    p(w)     = max(N(. w) - D(N), 0) / N(. .) + g() / (V + 1)

where c are bigram counts, N(. w) counts the different words before w, and g hands
the discounted mass on. V counts the different tokens; the one more is for words
never seen. A history that was never seen leaves p(w).

Hashes are 64 bits; two different words or bigrams share one with a probability of
about n squared over 2^65, below 3 in 100 for 10^9 entries.
"""

from __future__ import annotations

import functools
import posixpath
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import fresh_dir, small_batches
from .warc import filesystem

#: Bigram tokens that one shard is meant for.
SHARD_TOKENS = 4_000_000
#: Tokens after which a map task passes its counts on.
FLUSH_TOKENS = 2_000_000
#: Shards that counts are cut into at once, shards of the word table at most, and bytes of text whose counts are one part of a range of shards.
FANOUT, WORD_SHARDS, PART_BYTES = 1024, 4096, 256 << 20
#: Files that a worker maps at once, and bytes of files that it keeps where they cannot be mapped.
MAPPED, KEPT_BYTES = 4096, 256 << 20
#: Hashes of what is no word: the begin and the end of a text. No word holds a blank.
BEGIN, END = (xxhash.xxh64_intdigest(s) for s in (b" begin", b" end"))
_WORD_FIELDS = ("count", "ends", "once", "twice", "more", "all")
_WORD_KINDS = (np.int64, np.uint32, np.uint32, np.uint32, np.uint32, np.int64)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, A-Z in lower case."""
    return (text or "").encode().lower().split()


def bigram_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two word hashes, in order."""
    with np.errstate(over="ignore"):
        x = left * np.uint64(0x9E3779B97F4A7C15) ^ (right + np.uint64(0x7F4A7C159E3779B9)) * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def token_ids(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts as one run of places in a table of word hashes, each text between BEGIN and END; the table; tokens of each text."""
    ids: dict[bytes, int] = {}
    table = [BEGIN, END]
    run, sizes = [], []
    place = ids.setdefault
    for text in texts:
        words = words_of(text)
        run.append(0)
        run += [place(w, len(ids) + 2) for w in words]
        run.append(1)
        sizes.append(len(words) + 1)
    table += [xxhash.xxh64_intdigest(w) for w in ids]
    return np.array(run, np.int64), np.array(table, np.uint64), np.array(sizes, np.int64)


def _merge(keys: list[np.ndarray], columns: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, and the sums of each column."""
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], [np.add.reduceat(np.concatenate(c)[order], first) if len(key) else np.zeros(0, np.int64) for c in columns]


def _packed(x: np.ndarray) -> bytes:
    """Counts in as few bytes each as they need."""
    return x.astype(np.uint32 if not len(x) or x.max() < 1 << 32 else np.uint64).tobytes()


def _unpacked(x: bytes, n: int) -> np.ndarray:
    return np.frombuffer(x, np.uint32 if len(x) == 4 * n else np.uint64).astype(np.int64)


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for the whole corpus."""

    path: str
    shards: int
    word_shards: int
    tokens: int  # N: all training tokens
    types: int  # V: different training tokens
    ends: int  # N(. .): different bigrams
    bigram_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    word_left: float  # g(): the mass that words leave for the uniform distribution


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the counts of counts; where they are undefined or out of range, a half."""
    if n1 == 0 or n2 == 0 or n3 == 0:
        return (0.5, 0.5, 0.5)
    y = n1 / (n1 + 2 * n2)
    found = [k - (k + 1) * y * b / a for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
    return tuple(d if 0 < d <= k else 0.5 for k, d in enumerate(found, 1))


def _write(path: str, name: str, arrays: list[np.ndarray], large: int = 0) -> None:
    """Arrays end to end, preceded by the number of entries and of large counts; whole or not at all."""
    fs, base = filesystem(path)
    fs.create_dir(base, recursive=True)
    draft = posixpath.join(base, f".{name}.{TaskContext.get().taskAttemptId()}")
    with fs.open_output_stream(draft, compression=None) as out:
        out.write(np.array([len(arrays[0]), large], np.int64).tobytes())
        for a in arrays:
            out.write(np.ascontiguousarray(a).data)
    fs.move(draft, posixpath.join(base, name))


@dataclass
class Counts:
    """Bigrams in order of their hashes: hash, left and right word, count."""

    key: np.ndarray
    left: np.ndarray
    right: np.ndarray
    n: np.ndarray

    @staticmethod
    def of(left: list[np.ndarray], right: list[np.ndarray], n: list[np.ndarray]) -> Counts:
        """Counts of equal bigrams added up."""
        left, right, n = (np.concatenate(x) for x in (left, right, n))
        key = bigram_hash(left, right)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        return Counts(key[first], left[order][first], right[order][first], np.add.reduceat(n[order], first))

    def packed(self, cut: np.ndarray) -> pd.DataFrame:
        """A row for each run of one number in ``cut``: the number, and the bigrams as arrays, a left word once for all bigrams that it starts."""
        rows = []
        first = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]])
        for a, b in zip(first, np.r_[first[1:], len(cut)]):
            by = np.argsort(self.left[a:b], kind="stable")
            words, begins = np.unique(self.left[a:b][by], return_index=True)
            runs, n = np.diff(np.r_[begins, b - a]).astype(np.uint32), self.n[a:b][by]
            rows.append((int(cut[a]), words.tobytes(), runs.tobytes(), self.right[a:b][by].tobytes(), np.minimum(n, 255).astype(np.uint8).tobytes(), n[n >= 255].astype(np.int64).tobytes()))
        return pd.DataFrame(rows, columns=["shard", "words", "runs", "right", "n", "large"])

    @staticmethod
    def unpacked(pdf: pd.DataFrame) -> Counts:
        lefts, rights, ns = [], [], []
        for r in pdf.itertuples(index=False):
            lefts.append(np.repeat(np.frombuffer(r.words, np.uint64), np.frombuffer(r.runs, np.uint32)))
            rights.append(np.frombuffer(r.right, np.uint64))
            n = np.frombuffer(r.n, np.uint8).astype(np.int64)
            n[n == 255] = np.frombuffer(r.large, np.int64)
            ns.append(n)
        return Counts.of(lefts, rights, ns)


_PACKED = "shard int, words binary, runs binary, right binary, n binary, large binary"


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count the model over all rows of ``docs``. A null text is an empty one, which still has its end.

    An empty table gives a model that finds every token equally likely.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = fresh_dir(spark, "lm")
    # Characters over six is about the number of words; it only sets the number of shards.
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(4, -(-size // (6 * SHARD_TOKENS)))
    word_shards, fanout = min(shards, WORD_SHARDS), FANOUT
    width = -(-shards // fanout)  # shards of a range

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list = []
        have = 0

        def flush() -> pd.DataFrame:
            counts = Counts.of(*zip(*held))
            held.clear()
            return counts.packed(_shard(counts.key, shards) // np.uint64(width))

        for batch in batches:
            run, table, sizes = token_ids(batch["text"])
            pair = run[:-1] * len(table) + run[1:]
            pair = pair[run[:-1] != 1]  # not from one text's end to the next text's begin
            pair, n = np.unique(pair, return_counts=True)
            held.append((table[pair // len(table)], table[pair % len(table)], n.astype(np.int64)))
            have += int(sizes.sum())
            if have >= FLUSH_TOKENS:
                yield flush()
                have = 0
        if held:
            yield flush()

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = Counts.unpacked(pdf)
        return counts.packed(_shard(counts.key, shards))

    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = Counts.unpacked(pdf)
        n, large = counts.n, np.flatnonzero(counts.n >= 255)
        _write(path, f"bigrams-{int(pdf['shard'].iloc[0]):08d}", [counts.key, large, n[large], np.minimum(n, 255).astype(np.uint8)], len(large))
        # For each word: as a right word its count and the bigrams it ends, as a left word the bigrams it starts and their tokens.
        ones = np.ones(len(n), np.int64)
        zero = np.zeros(len(n), np.int64)
        word, sums = _merge(
            [counts.right, counts.left],
            [[n, zero], [ones, zero], [zero, (n == 1).astype(np.int64)], [zero, (n == 2).astype(np.int64)], [zero, (n >= 3).astype(np.int64)], [zero, n]],
        )
        kinds = [int((n == k).sum()) for k in (1, 2, 3, 4)] + [len(n)]
        cuts = np.searchsorted(_shard(word, word_shards), np.arange(word_shards + 1))
        rows = []
        for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                rows.append((s, word[a:b].tobytes(), *[_packed(x[a:b]) for x in sums], kinds if not rows else [0] * 5))
        return pd.DataFrame(rows, columns=["shard", "words", *_WORD_FIELDS, "kinds"])

    packed = docs.select(F.col(text).alias("text")).mapInPandas(count, _PACKED)
    if width > 1:
        parts = max(1, -(-size // (fanout * PART_BYTES)))
        packed = packed.withColumn("part", F.pmod(F.xxhash64("words", "right"), F.lit(parts))).groupBy("shard", "part").applyInPandas(split, _PACKED)
    fields = ", ".join(f"{c} binary" for c in _WORD_FIELDS)
    parts = packed.groupBy("shard").applyInPandas(reduce, f"shard int, words binary, {fields}, kinds array<bigint>")

    def store(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(w, np.uint64) for w in pdf["words"]]
        columns = [[_unpacked(x, len(k)) for x, k in zip(pdf[c], keys)] for c in _WORD_FIELDS]
        key, sums = _merge(keys, columns)
        _write(path, f"words-{int(pdf['shard'].iloc[0]):08d}", [key, *[x.astype(kind) for x, kind in zip(sums, _WORD_KINDS)]])
        n, ends = sums[:2]
        kinds = np.sum([list(k) for k in pdf["kinds"]], axis=0)
        return pd.DataFrame([[int(n.sum()), int((n > 0).sum()), *[int((ends == k).sum()) for k in (1, 2, 3, 4)], int((ends >= 3).sum()), *map(int, kinds)]], columns=totals)

    totals = ["tokens", "types", *[f"e{k}" for k in range(5)], *[f"k{k}" for k in range(5)]]
    words = parts.groupBy("shard").applyInPandas(store, ", ".join(f"{c} bigint" for c in totals))
    t = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals]).first()
    high, low = discounts(*(t[f"k{k}"] for k in range(4))), discounts(*(t[f"e{k}"] for k in range(4)))
    left = low[0] * t["e0"] + low[1] * t["e1"] + low[2] * t["e4"]
    return Model(path, shards, word_shards, t["tokens"], t["types"], t["k4"], high, low, left / t["k4"] if t["k4"] else 1.0)


def _shard(key: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a bigram hash: equal ranges of its upper half, in order."""
    return ((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


class Arrays:
    """One file of sorted hashes and numbers, as bytes that are mapped or read."""

    def __init__(self, data: np.ndarray, kinds: list):
        n, m = data[:16].view(np.int64)
        self.bytes, at = len(data), 16
        self.columns = []
        for kind, size in ((np.uint64, n), *((np.int64, m) for _ in range(2 if m else 0)), *((k, n) for k in kinds)):
            end = at + int(size) * np.dtype(kind).itemsize
            self.columns.append(data[at:end].view(kind))
            at = end
        self.places, self.large = self.columns[1:3] if m else (np.zeros(0, np.int64),) * 2
        self.columns = [self.columns[0], *self.columns[3 if m else 1 :]]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted keys: which are there, and the places of those."""
        own = self.columns[0]
        if not len(own) or not len(keys):
            return np.zeros(len(keys), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        hit = own[at] == keys
        return hit, at[hit]


class Scorer:
    """A model's files as a worker sees them."""

    def __init__(self, model: Model):
        self.model = model
        self.fs, self.base = filesystem(model.path)
        self.local = self.fs.type_name == "local"
        self.open: OrderedDict[str, Arrays | None] = OrderedDict()

    def arrays(self, name: str, kinds: list) -> Arrays | None:
        """A file of the model, None if there is none; those used last stay open."""
        if name in self.open:
            self.open.move_to_end(name)
            return self.open[name]
        path = posixpath.join(self.base, name)
        try:
            if self.local:
                found = Arrays(np.memmap(path, np.uint8, "r"), kinds)
            else:
                with self.fs.open_input_file(path) as source:
                    found = Arrays(np.frombuffer(source.read(), np.uint8), kinds)
        except FileNotFoundError:
            found = None
        self.open[name] = found
        kept = lambda: sum(a.bytes for a in self.open.values() if a)
        while len(self.open) > 1 and (len(self.open) > MAPPED or not self.local and kept() > KEPT_BYTES):
            self.open.popitem(last=False)
        return found

    def shards_of(self, keys: np.ndarray, kind: str, shards: int, kinds: list) -> Iterator[tuple[slice, Arrays]]:
        """For sorted keys the runs that are in one shard, and its file."""
        at = _shard(keys, shards)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else []
        for a, b in zip(first, np.r_[first[1:], len(at)].astype(int)):
            found = self.arrays(f"{kind}-{int(at[a]):08d}", kinds)
            if found:
                yield slice(a, b), found

    def word_numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The six numbers of each word, zero for words never seen."""
        order = np.argsort(hashes)
        keys = hashes[order]
        out = np.zeros((len(hashes), len(_WORD_FIELDS)), np.int64)
        for run, words in self.shards_of(keys, "words", self.model.word_shards, list(_WORD_KINDS)):
            hit, at = words.find(keys[run])
            for k in range(len(_WORD_FIELDS)):
                out[order[run][hit], k] = words.columns[k + 1][at]
        return out

    def bigram_counts(self, keys: np.ndarray) -> np.ndarray:
        """The counts of bigram hashes in ascending order."""
        out = np.zeros(len(keys), np.int64)
        for run, bigrams in self.shards_of(keys, "bigrams", self.model.shards, [np.uint8]):
            hit, at = bigrams.find(keys[run])
            n = bigrams.columns[1][at].astype(np.int64)
            n[n == 255] = bigrams.large[np.searchsorted(bigrams.places, at[n == 255])]
            out[run][hit] = n
        return out

    def score(self, texts) -> dict[str, np.ndarray]:
        """For each text: tokens, known tokens, the smoothed unigram score and the model's score, as log10."""
        m = self.model
        run, table, sizes = token_ids(texts)
        numbers = self.word_numbers(table)
        count, ends, once, twice, more, total = numbers.T
        pick = lambda d, n: np.where(n == 0, 0.0, np.where(n == 1, d[0], np.where(n == 2, d[1], d[2])))
        word = (np.maximum(ends - pick(m.word_discounts, ends), 0) / max(m.ends, 1)) + m.word_left / (m.types + 1)
        base = np.log10((count + 0.1) / (m.tokens + 0.1 * (m.types + 1)))
        left = np.where(total > 0, (m.bigram_discounts[0] * once + m.bigram_discounts[1] * twice + m.bigram_discounts[2] * more) / np.maximum(total, 1), 1.0)
        begin = run[:-1] != 1
        pair, at = np.unique(run[:-1][begin] * len(table) + run[1:][begin], return_inverse=True)
        u, w = pair // len(table), pair % len(table)
        key = bigram_hash(table[u], table[w])
        order = np.argsort(key)
        c = np.empty(len(key), np.int64)
        c[order] = self.bigram_counts(key[order])
        p = np.maximum(c - pick(m.bigram_discounts, c), 0) / np.maximum(total[u], 1) + left[u] * word[w]
        token, first = run[1:][begin], np.r_[0, np.cumsum(sizes)[:-1]]
        return {
            "n_tokens": sizes,
            "n_known": np.add.reduceat((count[token] > 0).astype(np.int64), first),
            "base_score": np.add.reduceat(base[token], first),
            "score": np.add.reduceat(np.log10(p)[at], first),
        }


@functools.lru_cache(2)
def scorer(path: str, packed: tuple) -> Scorer:
    """A worker maps a model's files once."""
    return Scorer(Model(path, *packed))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with n_tokens, n_known, train_tokens, base_score, score and perplexity under ``model``.

    Scores are log10 probabilities of the whole text with its end; perplexity is
    10 to the minus score over tokens. A null text is an empty one: its end alone.
    ``base_score`` is the unigram score with 0.1 added to each count. Columns of
    ``docs`` with these names are replaced; repeated rows each get a result.
    """
    small_batches(docs.sparkSession)
    made = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double"
    names = [x.split()[0] for x in made.split(", ")]
    own = [f for f in docs.schema.fields if f.name not in names]
    packed = (model.shards, model.word_shards, model.tokens, model.types, model.ends, model.bigram_discounts, model.word_discounts, model.word_left)
    path = model.path

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                got = scorer(path, packed).score(batch["\0text"])
                got |= {"train_tokens": packed[2], "perplexity": 10 ** np.minimum(-got["score"] / got["n_tokens"], 300)}
                yield batch.drop(columns="\0text").assign(**{n: got[n] for n in names})

    schema = StructType([*own, *StructType.fromDDL(made).fields])
    return docs.select(*[f.name for f in own], docs[text].alias("\0text")).mapInPandas(run, schema)


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether a row is in the part of the rows that crc32 of its key as text sets apart; a null key is read as an empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part

