"""Benchmark decontamination by template canonicalisation.

A text is read as words. Numbers, units and names become the placeholders NUM, UNIT
and NAME, other words stay, in lower case and without punctuation at their ends; that is
its template. A window is a number of template words in a row, or of the words themselves:
capitals make names of words, so a copy in other case has another template but the same words.
Windows of the benchmark are joined by their hash to windows of the documents, plain ones to plain
ones; hits of one item in one document on one diagonal (document place less item place) are an
alignment. On an alignment
the placeholders must be filled consistently: a slot value of the item must always be
the same value in the document, and the other way round, for each kind of slot.
So a question whose numbers, names or units were exchanged is found, and a text that
only happens to share the template is not.

Scale. A bit array of fixed size, made from the hashes of the benchmark's windows,
goes to the workers; a document row leaves its task only for windows whose bits are
set. The join that follows is exact, so the bit array drops nothing; where the benchmark is so
large that most bits are set, more windows travel and the result is the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_keys, small_batches, written
from .wordhash import Chunk, chunks, hash_of, range_hashes, shingle_hashes

#: Words of a window, and the least number of words in it; in a window of a template that many are no placeholders.
WINDOW, LEAST_WORDS = 8, 4
#: An alignment covers this part of an item's words, or so many of them; this part of its slots must be consistent.
COVERED, COVERED_WORDS, CONSISTENT = 0.5, 13, 0.8
#: Bits of the array of window hashes.
BITS = 1 << 24

#: Units and currencies.
UNITS = set(
    "mm cm dm m km inch inches in. ft foot feet yard yards mile miles mg g kg t ton tons tonne tonnes oz ounce ounces lb lbs pound pounds ml cl dl l litre litres liter liters gallon gallons "
    "s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years ms percent % ° °c °f degrees "
    "m2 km2 m3 cm2 cm3 ha acre acres hectare hectares kmh km/h mph m/s hz khz mhz ghz w kw mw j kj cal kcal v a pa bar n k kb mb gb tb "
    "$ € £ ¥ usd eur gbp dollar dollars cent cents euro euros pence yen rupee rupees franc francs".split()
)
NUMBER_WORDS = set("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half dozen".split())

_NUMBER = re.compile(r"[$€£¥]?[+-]?(?:\d+(?:[.,:/]\d+)*|\d+)(?:st|nd|rd|th)?(%|°[cf]?|[a-z]{1,3}[23]?)?$")
#: Punctuation at the ends of words, and the ends of words after which a sentence begins.
_ENDS, _STOPS = "\"'()[]{}<>.,;:!?-*#_~`|", ".!?:\"*#|>"

LITERAL, NUM, UNIT, NAME = 0, 1, 2, 3
_SLOT = {k: np.uint64(xxhash.xxh64_intdigest(s)) for k, s in ((NUM, " NUM"), (UNIT, " UNIT"), (NAME, " NAME"))}


def _set(words: set[str]) -> np.ndarray:
    return np.sort(np.array([hash_of(w) for w in words], np.uint64))


_UNITS, _NUMBER_WORDS = _set(UNITS), _set(NUMBER_WORDS)
_STRIPPED, _STOPPED, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_STRIPPED[list(_ENDS.encode())] = True
_STOPPED[list(_STOPS.encode())] = True
_DIGIT[48:58] = True


def _in(sorted_set: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def _capitals(chunk: Chunk, at: np.ndarray) -> np.ndarray:
    """Whether the character at each word's first place that is no punctuation is a capital."""
    before = "\n".join([*chunk.texts, ""]).encode()
    if len(before) == len(chunk.data):  # lower case has the same bytes but for the letters
        given = np.frombuffer(before, np.uint8)
        last = len(given) - 1
        two = chunk.data[at] >= 0xC0
        nxt = np.minimum(at + 1, last)
        return (given[at] != chunk.data[at]) | (two & (given[nxt] != chunk.data[nxt]))
    return np.array([w.lstrip(_ENDS)[:1].isupper() for t in chunk.texts for w in t.split()], bool)


def template(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template hashes of a chunk's words, kinds, and hashes of the words without punctuation at their ends.

    A name is a word with a capital that does not begin a sentence or the text; a unit follows a number.
    """
    data, starts, ends = chunk.data, chunk.starts, chunk.ends
    core = np.flatnonzero(~_STRIPPED[data])
    first, last = np.searchsorted(core, starts), np.searchsorted(core, ends) - 1
    bare = first <= last  # some word is left
    pick = lambda at, other: np.where(bare, core[np.clip(at, 0, len(core) - 1)], other) if len(core) else other
    low, high = pick(first, starts), pick(last, ends - 1) + 1
    value = range_hashes(data, low, high)
    kind = np.zeros(len(value), np.uint8)
    digits = np.r_[0, np.cumsum(_DIGIT[data])]
    for k in np.flatnonzero(digits[high] > digits[low]):
        kind[k] = NUM if _NUMBER.match(data[low[k] : high[k]].tobytes().decode("utf-8", "replace")) else LITERAL
    kind[_in(_NUMBER_WORDS, value)] = NUM
    after_number = np.r_[False, kind[:-1] == NUM]
    begins = np.zeros(len(value) + 1, bool)
    begins[chunk.places[:-1]] = True
    begins = begins[:-1]
    kind[(kind == LITERAL) & after_number & ~begins & _in(_UNITS, value)] = UNIT
    inside = ~begins & ~np.r_[True, _STOPPED[data[ends[:-1] - 1]]]
    kind[(kind == LITERAL) & inside & bare & _capitals(chunk, low)] = NAME
    out = value.copy()
    for k, h in _SLOT.items():
        out[kind == k] = h
    return out, kind, value


def windows(texts, bits: np.ndarray | None = None, sizes: list[int] | None = None) -> Iterator[tuple[int, int, int, int, bytes, bytes]]:
    """For each window of each text: the text's number, its number of words, place and hash of the window, kinds and word hashes in it.

    Windows have each of ``sizes``; without, a text shorter than a window is one window. Windows of fewer than ``LEAST_WORDS`` words are whole
    texts, as they are. A window of the
    template has ``LEAST_WORDS`` words that are no placeholders; where a window has a placeholder, the window of the words as
    they are follows, whatever they are. With ``bits`` windows whose bits are not set are left out.
    """
    for chunk in chunks(t and t.replace("ß", "ss").replace("ẞ", "SS") for t in texts):  # in capitals ß is SS
        if not len(chunk.starts):
            continue
        t, kind, value = template(chunk)
        counts = np.diff(chunk.places)
        if sizes is None:
            groups = [(WINDOW, counts >= WINDOW)]
            groups += [(int(n), counts == n) for n in np.unique(counts[counts < WINDOW]) if n]
        else:
            groups = [(n, counts >= n if n >= LEAST_WORDS else counts == n) for n in sizes]
        literal = np.r_[0, np.cumsum(kind == LITERAL)]
        owner = np.repeat(np.arange(len(counts)), counts)
        for size, allowed in groups:
            if not allowed.any() or len(t) < size:
                continue
            n = len(t) - size + 1
            whole = allowed[owner[:n]] & (np.arange(n) + size <= chunk.places[owner[:n] + 1])
            literals = literal[size:] - literal[:-size]
            for words, fine in ((t, whole & (literals >= LEAST_WORDS)), (value, whole & ((literals < size) | (size < LEAST_WORDS)))):
                at = np.flatnonzero(fine)
                h = shingle_hashes(words, size)[at]
                if bits is not None:
                    fits = maybe(bits, h)
                    at, h = at[fits], h[fits]
                for a, x in zip(at.tolist(), h.view(np.int64).tolist()):
                    k = int(owner[a])
                    yield chunk.first + k, int(counts[k]), a - int(chunk.places[k]), x, kind[a : a + size].tobytes(), value[a : a + size].tobytes()


def bit_array(hashes: np.ndarray) -> np.ndarray:
    """Two bits of an array of fixed size for each hash."""
    bits = np.zeros(BITS, bool)
    for h in _places(hashes):
        bits[h] = True
    return np.packbits(bits)


def _places(hashes: np.ndarray) -> list[np.ndarray]:
    return [(hashes % np.uint64(BITS)).astype(np.int64), (hashes >> np.uint64(40)).astype(np.int64) % BITS]


def maybe(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set."""
    a, b = _places(hashes)
    return ((bits[a >> 3] >> (7 - (a & 7)).astype(np.uint8)) & (bits[b >> 3] >> (7 - (b & 7)).astype(np.uint8)) & 1).astype(bool)


_WINDOWS = "at int, hash bigint, kinds binary, hashes binary"


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows of ``docs`` that hold a passage of a benchmark item, as it is or with other numbers, names or units.

    Returns one row for each pair of ``key`` and ``item``: covered (the part of the item's words in
    the best alignment), slots (of the item in it), exchanged (slots with another value in the document) and
    kind: ``verbatim`` or ``reparameterised``. An alignment counts if it covers ``COVERED`` of the
    item or ``COVERED_WORDS`` words of it, and ``CONSISTENT`` of its slots are filled consistently.
    Windows that hold the item's very words count also without the others on their diagonal.

    Null and blank texts match nothing. An item of fewer than ``LEAST_WORDS`` words is found where a document is
    that item and nothing else: inside a text so few words say nothing. An item of fewer words that are no placeholders is found as it is only, in any case of letters. Rows with a null
    key in either table are left out. An item shorter than a window is found whole, wherever in a document it is. Repeated rows of either table give one row
    for each pair. Other columns of either table are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).where("doc is not null")
    items = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null").distinct()
    doc_type, item_type = rows.schema["doc"].dataType.simpleString(), items.schema["item"].dataType.simpleString()

    def read_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            item, text = b["item"].tolist(), b["text"].tolist()
            out = [(item[k], xxhash.xxh64_intdigest(text[k]) >> 1, n, *w) for k, n, *w in windows(text)]
            yield pd.DataFrame(out, columns=["item", "version", "words", "item_at", "hash", "item_kinds", "item_hashes"])

    kept = written(
        items.mapInPandas(read_items, f"item {item_type}, version bigint, words int, item_at int, hash bigint, item_kinds binary, item_hashes binary"), "leak-items"
    )

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(BITS // 8, np.uint8)
        for b in batches:
            bits |= bit_array(b["hash"].to_numpy().view(np.uint64))
        yield pd.DataFrame({"bits": [bits.tobytes()]})

    # One array for each of a few parts of the benchmark: BITS / 8 bytes each.
    parts = kept.select("hash").distinct().coalesce(8).mapInPandas(mark, "bits binary").collect()
    bits = np.zeros(BITS // 8, np.uint8)
    for p in parts:
        bits |= np.frombuffer(p["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(bits)
    sizes = sorted(r["size"] for r in kept.select((F.length("item_hashes") / 8).cast("int").alias("size")).distinct().collect())  # 1 to WINDOW

    def read_docs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            doc = b["doc"].tolist()
            out = [(doc[k], *w) for k, _, *w in windows(b["text"], shared.value, sizes)]
            yield pd.DataFrame(out, columns=["doc", "at", "hash", "kinds", "hashes"])

    hits = rows.mapInPandas(read_docs, f"doc {doc_type}, {_WINDOWS}").distinct()
    # The hit windows of one document on one diagonal; a diagonal of one item has as many rows as the item has words at most.
    joined = hits.join(kept, "hash").select("doc", "item", "version", "words", (F.col("at") - F.col("item_at")).alias("diagonal"), "item_at", "item_kinds", "item_hashes", "kinds", "hashes")

    def score(rows: list[tuple], words: int) -> tuple | None:
        """Part of the item's words, less the exchanged slots, and slots, if the rows make an alignment that counts."""
        pairs = {at + k: pair for at, kinds, own, other in rows for k, pair in enumerate(zip(kinds, own, other))}
        slots = [(kind, a, b) for kind, a, b in pairs.values() if kind != LITERAL]
        there: dict = {}
        back: dict = {}
        for kind, a, b in slots:
            there.setdefault((kind, a), set()).add(b)
            back.setdefault((kind, b), set()).add(a)
        fine = sum(len(there[kind, a]) == 1 and len(back[kind, b]) == 1 for kind, a, b in slots)
        covered = len(pairs) / words
        if (covered >= COVERED or len(pairs) >= COVERED_WORDS) and fine >= CONSISTENT * len(slots):
            return covered, -sum(a != b for _, a, b in slots), len(slots)
        return None

    def align(pdf: pd.DataFrame) -> pd.DataFrame:
        best: dict = {}
        for (doc, item, _, _), g in pdf.groupby(["doc", "item", "version", "diagonal"], sort=False):
            rows = [(r.item_at, r.item_kinds, np.frombuffer(r.item_hashes, np.uint64), np.frombuffer(r.hashes, np.uint64)) for r in g.itertuples(index=False)]
            words = int(g["words"].iloc[0])
            found = score(rows, words)
            if found is None:  # what is as it is and what has the item's template may still count, each without the other
                same, alike = (g["item_hashes"] == g["hashes"]).tolist(), (g["item_kinds"] == g["kinds"]).tolist()
                alike = [x and r[1].count(LITERAL) >= LEAST_WORDS for x, r in zip(alike, rows)]
                found = max((f for some in (same, alike) if not all(some) and (f := score([r for r, x in zip(rows, some) if x], words))), default=None)
            if found:
                best[doc, item] = max(best.get((doc, item), (0.0,)), found)
        return pd.DataFrame([(d, i, c, n, -x, "reparameterised" if x else "verbatim") for (d, i), (c, x, n) in best.items()], columns=["doc", "item", "covered", "slots", "exchanged", "kind"])

    schema = f"doc {doc_type}, item {item_type}, covered double, slots int, exchanged int, kind string"
    found = joined.groupBy("doc", F.pmod(F.xxhash64("item"), F.lit(16)).alias("part")).applyInPandas(align, schema)
    return found.select(F.col("doc").alias(key), F.col("item").alias(item), "covered", "slots", "exchanged", "kind")


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no passage of a benchmark item, as ``contaminated`` finds them.

    Rows are told apart by key and text, so of two texts under one key, or of rows with a null key, those that
    hold a passage go and the others stay. Rows with a null or blank text stay.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.withColumn("\0row", F.concat_ws(":", *row_keys(key, text)))
    leaks = contaminated(rows, benchmark, "\0row", text, item, item_text).select("\0row").distinct()
    return rows.join(leaks, "\0row", "left_anti").select(*names)
