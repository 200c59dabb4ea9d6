"""Secrets in texts: keyword automaton, regular expressions anchored at its hits, checksums.

One pass of an Aho-Corasick automaton over a text finds the places where a secret
may begin. Only there a regular expression is tried, anchored at the hit, so
no expression ever runs over a whole text. Kinds that carry a checksum of their own are kept if it holds.

A run of hexadecimal digits has no keyword. Its keywords are all strings of four such digits: a run
of 24 holds 21 of them, and the run around the first of these is taken whole.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import small_batches

# Keywords, patterns, least lengths and digit alphabets of the public formats.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
HEX_DIGITS, HEX_KEYWORD = "0123456789abcdef", 4
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_GENERATORS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def _number(digits: str, alphabet: str) -> int:
    out = 0
    for c in digits:
        out = out * len(alphabet) + alphabet.index(c)
    return out


def crc_token(token: str) -> bool:
    """Thirty characters after the prefix, then their CRC-32 as six digits of base 62."""
    body = token.partition("_")[2]
    return _number(body[-6:], BASE62) == zlib.crc32(body[:-6].encode())


def base58_key(key: str) -> bool:
    """Base 58 of 78 bytes and the first four bytes of their double SHA-256."""
    value = _number(key, BASE58)
    if value >> 8 * 82:
        return False
    data = value.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


def bech32_key(key: str) -> bool:
    """A prefix, ``1``, and data whose last six characters make the polynomial remainder one."""
    prefix, _, data = key.lower().rpartition("1")
    values = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix] + [BECH32.index(c) for c in data]
    rest = 1
    for v in values:
        top, rest = rest >> 25, (rest & 0x1FFFFFF) << 5 ^ v
        for k, g in enumerate(BECH32_GENERATORS):
            if top >> k & 1:
                rest ^= g
    return rest == 1


class Kind(NamedTuple):
    """A format: its keywords in lower case, the expression at a hit, and whether the match is kept; base kinds need no checksum."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    holds: Callable[[re.Match], bool]
    base: bool = False


def _checked(name: str, keywords: tuple[str, ...], pattern: str, check: Callable[[str], bool]) -> Kind:
    """A kind that is kept where its checksum holds; it begins and ends at no letter, digit or underscore."""
    return Kind(name, keywords, re.compile(rf"(?<![A-Za-z0-9_])(?:{pattern})(?![A-Za-z0-9_])"), lambda m: check(m[0]))


#: All kinds in the order in which spans with one start are listed; the first three are the base.
KINDS = (
    Kind("assign", ASSIGN_WORDS, ASSIGN, lambda m: len(m[2]) >= LEAST_VALUE, True),
    Kind("access", ("akia",), ACCESS, lambda m: len(m[0]) >= LEAST_ACCESS, True),
    Kind("hex", tuple(map("".join, itertools.product(HEX_DIGITS, repeat=HEX_KEYWORD))), HEX, lambda m: len(m[0]) >= LEAST_HEX, True),
    _checked("github", tuple(f"gh{c}_" for c in "pousr"), r"gh[pousr]_[A-Za-z0-9]{36}", crc_token),
    _checked("npm", ("npm_",), r"npm_[A-Za-z0-9]{36}", crc_token),
    _checked("xprv", ("xprv",), rf"xprv[{BASE58}]{{107}}", base58_key),
    _checked("age", ("age-secret-key-1",), rf"AGE-SECRET-KEY-1[{BECH32.upper()}]{{58}}", bech32_key),
    _checked("nsec", ("nsec1",), rf"nsec1[{BECH32}]{{58}}", bech32_key),
)
BASE_KINDS = tuple(k.name for k in KINDS if k.base)
SPANS = "array<struct<kind: string, start: int, end: int>>"
_HEX_KIND = next(i for i, k in enumerate(KINDS) if k.name == "hex")


@lru_cache(1)
def automaton():
    """The automaton of all keywords: keyword to its length and the numbers of its kinds; a worker builds it once."""
    import ahocorasick

    kinds: dict[str, list[int]] = {}
    for i, kind in enumerate(KINDS):
        for word in kind.keywords:
            kinds.setdefault(word, []).append(i)
    found = ahocorasick.Automaton()
    for word, numbers in kinds.items():
        found.add_word(word, (len(word), numbers))
    found.make_automaton()
    return found


def find(text: str | None) -> list[tuple[str, int, int]]:
    """The secrets of a text: kind, start and end in code points, by start and then in the order of ``KINDS``.

    Per kind they are leftmost and don't overlap: a match that is dropped for its length or checksum uses up its place all the same.
    """
    if not text:
        return []
    # Lower case of the same length: this letter alone becomes two.
    low = text.lower() if text.isascii() else text.replace("İ", " ").lower()
    starts: list[set[int]] = [set() for _ in KINDS]
    run_end = -1
    for last, (length, numbers) in automaton().iter(low):
        at = last - length + 1
        for i in numbers:
            if i != _HEX_KIND:
                starts[i].add(at)
            elif at >= run_end:
                run = HEX.match(text, at)  # digits of the text itself, in lower case
                if run:
                    run_end = run.end()
                    while at and text[at - 1] in HEX_DIGITS:
                        at -= 1
                    starts[i].add(at)
    out = []
    for i, kind in enumerate(KINDS):
        free = 0
        for at in sorted(starts[i]):
            if at >= free and (m := kind.pattern.match(text, at)):
                free = m.end()
                if kind.holds(m):
                    out.append((at, i, free))
    return [(KINDS[i].name, at, end) for at, i, end in sorted(out)]


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each stretch that spans cover replaced by the kind of the first of them, in brackets."""
    if text is None:
        return None
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scan(docs: DataFrame, text: str = "text", redact: bool = False) -> DataFrame:
    """Every row of ``docs`` with its secrets: ``spans``, an array of kind, start and end, and with ``redact`` also ``redacted``, the text without them.

    Starts and ends count code points, the end is exclusive; spans are listed by start, then in the
    order of ``KINDS``, and may overlap where their kinds differ. Columns of ``docs`` with the added names are replaced.

    A null or empty text has no spans (a null one is redacted to null). Texts are scanned whole, in one
    pass. Repeated rows each get a result; an empty table gives none.
    """
    small_batches(docs.sparkSession)
    added = StructType.fromDDL(f"spans {SPANS}" + ", redacted string" * redact)
    own = [f for f in docs.schema.fields if f.name not in added.names]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(own)).to_pylist()
            found = [find(t) for t in texts]
            made = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in spans] for spans in found], span)]
            if redact:
                made.append(pa.array([redacted(t, s) for t, s in zip(texts, found)], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], *made], names=[*[f.name for f in own], *added.names])

    return docs.select(*[docs[f.name] for f in own], docs[text].alias("\0text")).mapInArrow(run, StructType([*own, *added.fields]))


def _is(kind: str):
    return lambda s: s["kind"] == kind


def joined(spans: str = "spans", kinds: tuple[str, ...] | None = None):
    """Spans as text, ``kind:start:end`` joined by commas; those of ``kinds`` alone if given."""
    kept = F.col(spans) if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def summary(scanned: DataFrame) -> DataFrame:
    """Number of spans of each base kind, the digest of the base spans and all spans as text, in place of ``spans``."""
    counts = [F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    names = {f"n_{k}" for k in BASE_KINDS} | {"base_sha256", "spans"}
    return scanned.select(
        *[c for c in scanned.columns if c not in names], *counts,
        F.sha2(joined(kinds=BASE_KINDS).cast("binary"), 256).alias("base_sha256"), joined().alias("spans"),
    )
