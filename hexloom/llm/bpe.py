"""Byte-level BPE by backtracking over longest matches, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary's byte strings finds, in one pass
over a piece of text, the longest token that starts at each byte. The encoder
takes the longest match wherever the pair it forms with the token before is one
that the merge rules would keep apart, tries the next shorter prefix otherwise,
and steps back when no prefix is left. A bit for each byte position keeps it from
trying a position twice, so the work is linear in the piece. The result is what
applying the merge rules in order would give.

Two neighbouring tokens are compatible if merging never happens across their
border: this is found by undoing the merges of both tokens in the order opposite
to their ranks, and looking for a merge across the border that would have come
first. Answers are kept in a table.

Decoding puts the bytes of all tokens end to end; a table of offsets gives each
token's place, so that a list of ids becomes bytes by one gather.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .common import small_batches

#: Fixed value: the pre-tokenisation pattern of byte-level BPE vocabularies of this family.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces whose ids (and pairs whose answer) a worker remembers, and the longest piece it remembers.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64


def byte_of_char() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file, inverted.

    Visible Latin-1 characters stand for themselves; the other bytes take code points from 256 on, in order.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """One vocabulary file: its automaton, its merges and its offset table."""

    def __init__(self, vocabulary: dict):
        import ahocorasick

        model, to_byte = vocabulary["model"], byte_of_char()
        raw = {i: bytes(to_byte[c] for c in token) for token, i in model["vocab"].items()}
        ids = {token: i for i, token in raw.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}  # a pair's rank and what it becomes
        self.split: dict[int, tuple[int, int]] = {}  # the pair a token was first made of
        self.rank: dict[int, int] = {}
        for r, (a, b) in enumerate(pairs):
            x, y, made = (model["vocab"][t] for t in (a, b, a + b))
            self.merge[x, y] = (r, made)
            if made not in self.split:
                self.split[made], self.rank[made] = (x, y), r
        self.length = {i: len(token) for i, token in raw.items()}
        self.single = {token[0]: i for i, token in raw.items() if len(token) == 1}
        self.compatible: dict[tuple[int, int], bool] = {}
        # A token that its own merges don't rebuild never appears in an encoding.
        reached = {token: i for token, i in ids.items() if self._by_merges(token) == [i]}
        self.automaton = ahocorasick.Automaton()
        for token, i in reached.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), i))
        self.automaton.make_automaton()
        self.shorter = {}  # the longest proper prefix of a token that is a token
        for token, i in reached.items():
            self.shorter[i] = next((reached[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in reached), None)
        added = vocabulary.get("added_tokens") or []
        self.special = {t["content"]: t["id"] for t in added}
        self.special_text = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if added else None
        self.pieces = regex.compile(PIECES)
        self.known: dict[str, list[int]] = {}
        # The offset table: token i is at places[i] up to places[i + 1].
        raw |= {i: t.encode() for t, i in self.special.items()}
        sizes = np.zeros(max(raw) + 1, np.int64)
        for i, token in raw.items():
            sizes[i] = len(token)
        self.places = np.concatenate([[0], np.cumsum(sizes)])
        self.bytes = np.frombuffer(b"".join(raw.get(i, b"") for i in range(len(sizes))), np.uint8)

    def _by_merges(self, token: bytes) -> list[int]:
        """A token's own bytes under the merge rules, lowest rank first."""
        parts = [self.single[b] for b in token]
        while len(parts) > 1:
            rank, k = min((self.merge.get((a, b), (1 << 60, 0))[0], k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[k : k + 2] = [self.merge[parts[k], parts[k + 1]][1]]
        return parts

    def _together(self, left: int, right: int) -> bool:
        """Whether the merge rules leave these two neighbours apart."""
        found = self.compatible.get((left, right))
        if found is None:
            if len(self.compatible) >= REMEMBERED:
                self.compatible.clear()
            found = self.compatible[left, right] = self._apart(left, right)
        return found

    def _apart(self, left: int, right: int) -> bool:
        # A merge across the border happens if its rank is below those of the merges that used up its two sides.
        limit = 1 << 60
        while True:
            crossing = self.merge.get((left, right))
            if crossing is not None and crossing[0] < limit:
                return False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:  # undo the later merge; of equal merges the left one came first
                limit, left = a, self.split[left][1]
            else:
                limit, right = b + 1, self.split[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece of text."""
        n = len(piece)
        longest: list[int | None] = [None] * n
        size = [0] * n
        for end, (length, token) in self.automaton.iter(piece.decode("latin-1")):
            start = end - length + 1
            if length > size[start]:
                size[start], longest[start] = length, token
        dead = bytearray(n + 1)  # positions that no encoding goes through
        out: list[int] = []
        at, token = 0, longest[0] if n else None
        while at < n:
            before = out[-1] if out else None
            while token is not None:
                end = at + self.length[token]
                if not dead[end] and (before is None or self._together(before, token)):
                    break
                token = self.shorter[token]
            if token is None:  # nothing fits here: give up the token before
                dead[at] = 1
                token = out.pop()
                at -= self.length[token]
                token = self.shorter[token]
            else:
                out.append(token)
                at = end
                token = longest[at] if at < n else None
        return out

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text; strings of added tokens in it become those tokens."""
        ids: list[int] = []
        at = 0
        for hit in self.special_text.finditer(text) if self.special_text else ():
            self._encode_into(ids, text[at : hit.start()])
            ids.append(self.special[hit[0]])
            at = hit.end()
        self._encode_into(ids, text[at:] if at else text)
        return np.array(ids, "<u4")

    def _encode_into(self, ids: list[int], text: str) -> None:
        known = self.known
        for piece in self.pieces.findall(text):
            found = known.get(piece)
            if found is None:
                found = self.encode_piece(piece.encode())
                if len(piece) <= REMEMBERED_CHARS:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = found
            ids += found

    def decode(self, ids: np.ndarray) -> str:
        """The text of a list of ids; bytes that are no UTF-8 become U+FFFD."""
        if not len(ids):
            return ""
        start, size = self.places[ids], self.places[ids.astype(np.int64) + 1] - self.places[ids]
        ends = np.cumsum(size)
        take = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
        return self.bytes[take].tobytes().decode("utf-8", "replace")


@functools.lru_cache(1)
def encoder(vocabulary: str) -> Encoder:
    """The encoder of a vocabulary given as JSON text; a worker builds it once."""
    return Encoder(json.loads(vocabulary))


def encode_and_decode(docs: DataFrame, vocabulary_path: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Every row of ``docs`` with its tokens and the digests of ids and of the decoded text.

    ``vocabulary_path`` is a JSON file of a byte-level BPE vocabulary that the driver
    can read (about 2 MB; its size is fixed by the vocabulary, not by the data) and
    is sent to the workers. Adds n_tokens, ids_sha256 (of the ids as little-endian
    unsigned 32-bit integers), decoded_sha256 (of the decoded text in UTF-8) and,
    with ``keep_ids``, ids (array of int) and decoded; columns of ``docs`` with
    these names are replaced.

    A null text is encoded as an empty one: no tokens, and the digests of no bytes.
    Texts are encoded whole, whatever their length. Repeated rows each get a result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    added = ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"] + ["ids array<int>", "decoded string"] * keep_ids
    names = [a.split()[0] for a in added]
    own = [f for f in docs.schema.fields if f.name not in names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = encoder(shared.value)
        for batch in batches:
            rows = []
            for value in batch["\0text"]:
                ids = coder.encode(value or "")
                decoded = coder.decode(ids)
                row = [len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()]
                rows.append(row + [ids.astype(np.int32), decoded] * keep_ids)
            made = pd.DataFrame(rows, columns=names, index=batch.index)
            yield pd.concat([batch.drop(columns="\0text"), made], axis=1)

    schema = StructType([*own, *StructType.fromDDL(", ".join(added)).fields])
    return docs.select(*[f.name for f in own], docs[text].alias("\0text")).mapInPandas(run, schema)
