"""Spelling variants: words one edit apart, found by scans of a sorted vocabulary.

The vocabulary is sorted and a word is matched against a stretch of it with the rows of
a banded edit matrix. Two neighbours in the list share a prefix, and the rows of that prefix are
kept; where a row has no entry of one or less, all words with that prefix are skipped at once.

Two words one edit apart have half of the shorter one in common, as a prefix or as a suffix.
So the scan is done twice, on the words and on the words reversed, and each time only through the words that share the first half.

The list is cut into ranges of a bounded number of words. A range goes to one task, and a word is sent to
the ranges alone that can hold a word one edit away: mostly the one or two that its half lies in;
where that half spans several, those of its possible edits. Of what it finds there only counts and the best word come back, so no pair becomes a row.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

#: Words: runs of these letters, of so many code points and occurrences at least.
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: One run in so many loses a letter.
SPOILED = 199
#: How many times more often a word's form must be there.
RATIO = 5
#: Words of a range on average, the most ranges, and words of the sample for each range that the ranges are cut by.
RANGE_WORDS, MOST_RANGES, SAMPLED = 4096, 8192, 32
#: Letters that an edit can put in: those that a word can have.
ALPHABET = [c for c in map(chr, [*range(0x61, 0x7B), *range(0xC0, 0x100)])]
_LAST = "\U0010ffff"
_LOWER = {k: k + 32 for k in range(65, 91)}


def words_of(doc_id, text: str | None) -> Counter[str]:
    """The words of a text that are long enough, as often as they occur; a null doc_id is read as an empty one."""
    found: Counter[str] = Counter()
    for run, times in Counter(LETTERS.findall(text or "")).items():
        if len(run) < LEAST_LENGTH:
            continue
        word = run.translate(_LOWER)
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
        if h % SPOILED == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < LEAST_LENGTH:
                continue
        found[word] += times
    return found


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of at least LEAST_LENGTH code points with their number of occurrences, those with LEAST_COUNT or more."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[str] = Counter()
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update(words_of(doc_id, body))
            yield pa.RecordBatch.from_pydict({"word": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

    counted = docs.select(F.col(key), F.col(text)).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def half(length: int) -> int:
    """Letters that a word of this length has in common with any word one edit away, at its begin or at its end."""
    return (max(length - 1, LEAST_LENGTH)) // 2


def visited(word: str, bounds: list[str]) -> set[int]:
    """The ranges that can hold a word one edit away that shares the first half; range r holds what has r bounds at or below it."""
    found: set[int] = set()
    i = half(len(word))
    while True:
        first, last = bisect_right(bounds, word[:i]), bisect_right(bounds, word[:i] + _LAST)
        if first == last or i >= len(word):
            return found | set(range(first, last + 1))
        begin, rest, after = word[:i], word[i:], word[i + 1 :]
        found.add(bisect_right(bounds, begin + after))
        for c in ALPHABET:
            found.add(bisect_right(bounds, begin + c + after))
            found.add(bisect_right(bounds, begin + c + rest))
        i += 1


class SortedWords:
    """A sorted list of words with the length of the prefix that each shares with the one before."""

    def __init__(self, words: list[str]):
        self.words = words
        self.shared = [0] * len(words)
        for k in range(1, len(words)):
            a, b = words[k - 1], words[k]
            n = min(len(a), len(b))
            i = 0
            while i < n and a[i] == b[i]:
                i += 1
            self.shared[k] = i

    def one_edit(self, word: str) -> Iterator[int]:
        """The places of words that differ from ``word`` by exactly one inserted, deleted or replaced letter and share its first half.

        A row of the edit matrix stands for a prefix of d letters in the list; of it only the entries d - 1, d
        and d + 1 can be one or less. Entries are held up to two.
        """
        words, shared, length = self.words, self.shared, len(word)
        k = half(length)
        padded = word + "\0\0\0"
        place, end = bisect_left(words, word[:k]), bisect_right(words, word[:k] + _LAST)
        rows = [(2, 0, 1)] * k + [(1, 0, 1)]
        kept = k
        while place < end:
            target = words[place]
            n = len(target)
            d = kept
            low, mid, high = rows[d]
            dead = False
            while d < n and not dead:
                c = target[d]
                # Entries d, d + 1 and d + 2 of the next row, from d - 1, d and d + 1 of this one.
                new_low = low if d and c == padded[d - 1] else low + 1
                if mid + 1 < new_low:
                    new_low = mid + 1
                new_mid = mid if c == padded[d] else mid + 1
                if high + 1 < new_mid:
                    new_mid = high + 1
                if new_low + 1 < new_mid:
                    new_mid = new_low + 1
                new_high = high if c == padded[d + 1] else high + 1
                if new_mid + 1 < new_high:
                    new_high = new_mid + 1
                low, mid, high = new_low, new_mid, new_high
                d += 1
                if len(rows) > d:
                    rows[d] = (low, mid, high)
                else:
                    rows.append((low, mid, high))
                dead = low > 1 and mid > 1 and high > 1
            if not dead:
                gap = length - n
                if -1 <= gap <= 1 and (low, mid, high)[gap + 1] == 1:
                    yield place
                place += 1
            else:  # all that share these letters are further away
                place = bisect_right(words, target[:d] + _LAST, place + 1, end)
            if place < end:
                kept = min(d, shared[place])


def _bounds(vocab: DataFrame, ranges: int) -> tuple[list[str], list[str]]:
    """Where the sorted words, and the reversed ones, are cut: quantiles of a sample by hash, MOST_RANGES * SAMPLED words or so at most."""
    share = max(1, RANGE_WORDS // SAMPLED) if ranges < MOST_RANGES else max(1, vocab.count() // (MOST_RANGES * SAMPLED))
    sample = [r["word"] for r in vocab.where(F.pmod(F.xxhash64("word"), F.lit(share)) == 0).select("word").collect()]
    cuts = lambda s: [s[k * len(s) // ranges] for k in range(1, ranges)] if s else []
    return cuts(sorted(sample)), cuts(sorted(w[::-1] for w in sample))


def near_words(vocab: DataFrame) -> DataFrame:
    """For each word that has near words: their number (n_near) and the most frequent of them (form) with its count (form_n), ties to the smaller word.

    ``vocab`` has word and n, each word once. Words are near if they differ by exactly one inserted, deleted or replaced code point.
    """
    spark = vocab.sparkSession
    ranges = min(MOST_RANGES, -(-vocab.count() // RANGE_WORDS) or 1)
    cut = spark.sparkContext.broadcast(_bounds(vocab, ranges))  # MOST_RANGES words each at most

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for way, bounds in enumerate(cut.value):
                    turned = word[::-1] if way else word
                    own = bisect_right(bounds, turned)
                    out.append((2 * own + way, 0, turned, n))
                    out += [(2 * r + way, 1, turned, 0) for r in visited(turned, bounds)]
            cells, roles, turned, counts = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_pydict({"cell": pa.array(cells, pa.int32()), "role": pa.array(roles, pa.int8()), "turned": pa.array(turned, pa.string()), "n": pa.array(counts, pa.int64())})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, words, counts, listed = None, [], [], None
        for batch in batches:
            found = []
            for cell, role, turned, n in zip(*(c.to_pylist() for c in batch.columns)):
                if cell != at:
                    at, words, counts, listed = cell, [], [], None
                if role == 0:
                    words.append(turned)
                    counts.append(n)
                    continue
                listed = listed or SortedWords(words)
                way, k = cell % 2, half(len(turned))
                near = [p for p in listed.one_edit(turned) if not way or words[p][::-1][:k] != turned[::-1][:k]]  # the others were met the other way
                if near:
                    best = min((-counts[p], words[p][::-1] if way else words[p]) for p in near)
                    found.append((turned[::-1] if way else turned, len(near), -best[0], best[1]))
            columns = zip(*found) if found else ((),) * 4
            yield pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, t), v in zip((("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())), columns)})

    dealt = vocab.select("word", "n").mapInArrow(deal, "cell int, role tinyint, turned string, n bigint")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ranges // 4)
    met = dealt.repartition(parts, "cell").sortWithinPartitions("cell", "role", "turned").mapInArrow(search, "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("o"), "form"))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.form").alias("form"), (-F.col("b.o")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """The last word of each chain of ``word`` to ``form``: word and root. Chains double their reach each round, which is written; there are no rings."""
    found = written(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = written(found.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        found = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return found


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The words of ``docs``: word, form, root, n, n_near and form_n.

    Words are the maximal runs of LETTERS with A-Z in lower case, of LEAST_LENGTH code points and LEAST_COUNT occurrences at least.
    One run in SPOILED, by the checksum of key and run, has lost a letter. form is the near word of largest n, ties to the smaller word in code-point order, if that
    is RATIO times the word's n or more, else null; form_n is its n. root is where the chain of forms from the word ends, the word itself if it has no form; n_near is the number of near words.

    A null text has no words; a null key is read as empty. Repeated rows count as often as they are there. An empty table gives no rows.
    """
    vocab = written(vocabulary(docs, key, text), "spelling-words")
    is_form = F.col("form_n") >= RATIO * F.col("n")
    joined = vocab.join(near_words(vocab), "word", "left")
    forms = written(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")),
        "spelling-forms",
    )
    ends = roots(forms.where("form is not null"))
    return forms.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
