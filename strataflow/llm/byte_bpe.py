"""Byte-level BPE: exact encoding in linear time, and decoding.

A sequence of vocabulary entries is the BPE result of its bytes exactly if each pair of neighbours is: no merge that the
rules would have made first crosses the border between them.  So a piece is encoded from left to right.  At every position
the longest entry is tried first, then its shorter prefixes; an entry is taken if it is compatible with the one before it
and the position after it has not failed already.  If none fits, the last entry is taken back and its position is marked as
failed.  Every position fails once at most, hence linear time.  Longest entries come from an Aho-Corasick automaton over
bytes written as Latin-1 text; compatibility of neighbours is remembered.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_row, small_batches, stored

#: Pieces longer than this many characters are encoded afresh each time.
LONGEST_KEPT = 48
#: Entries each of the two memories (pieces, neighbours) may hold before it is emptied.
MOST_KEPT = 400_000
#: Letters and numbers that the ``regex`` package knows from Unicode versions after 16.0, the version the rank
#: files' own library splits by (first and last code point, hexadecimal).
LATER_LETTERS = (
    "558 558 58b 58c 88f 88f c5c c5c cdc cdc 208f 208f 209d 209f a7ce a7cf a7d2 a7d2 a7d4 a7d4 a7dd a7dd a7e2 a7e2 a7f1 a7f1 "
    "ab6c ab6d 107bb 107bf 10940 10959 10ec5 10ec7 10ed9 10eee 11b0a 11b0a 11db0 11ddb 11df1 11df1 16ea0 16eb8 16ebb 16ed3 "
    "16ff2 16ff3 187f8 187ff 18cd6 18cda 18d09 18d20 18d80 18df2 18e00 19191 191a0 191d2 1b123 1b128 1b168 1b168 1d6a6 1d6a6 "
    "1df1f 1df24 1df2b 1df81 1df90 1df96 1dfcd 1dfff 1e6c0 1e6de 1e6e0 1e6e2 1e6e4 1e6e5 1e6e7 1e6ed 1e6f0 1e6f4 1e6fe 1e6ff "
    "2b73a 2b73f 2b81e 2b81e 2cea2 2cead 323b0 33479 3d000 3fc3f")
LATER_NUMBERS = "11de0 11de9 1246f 1246f 12475 1247f 12550 12686 16ff4 16ff6"


def read_ranks(path: str) -> list[bytes]:
    """Entries of a rank file (base64 and rank per line), by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    entries = [b""] * len(pairs)
    for entry, rank in pairs:
        entries[int(rank)] = base64.b64decode(entry)
    return entries


def _ranges(listed: str) -> str:
    ends = [chr(int(x, 16)) for x in listed.split()]
    return "".join(f"{first}-{last}" for first, last in zip(ends[::2], ends[1::2]))


def piece_splitter(pattern: str) -> Callable[[str], list[str]]:
    """Matches of the pattern, with letters and numbers as of Unicode 16."""
    plain = regex.compile(pattern)
    later = re.compile(f"[{_ranges(LATER_LETTERS)}{_ranges(LATER_NUMBERS)}]")
    exact = regex.compile(pattern.replace(r"\p{L}", rf"[\p{{L}}--[{_ranges(LATER_LETTERS)}]]")
                          .replace(r"\p{N}", rf"[\p{{N}}--[{_ranges(LATER_NUMBERS)}]]"), regex.V1)
    return lambda text: (exact if later.search(text) else plain).findall(text)


class ByteBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, entries: list[bytes], pattern: str):
        self.entries = entries
        self.split = piece_splitter(pattern)
        self._rank = {entry: rank for rank, entry in enumerate(entries)}
        self._compatible: dict[tuple[int, int], bool] = {}
        self._halves = [self._halve(rank) for rank in range(len(entries))]
        self._automaton = ahocorasick.Automaton()
        for rank, entry in enumerate(entries):
            if len(entry) == 1 or self._halves[rank]:
                self._automaton.add_word(entry.decode("latin-1"), rank)
        self._automaton.make_automaton()
        self._shorter = [self._prefix(entry) for entry in entries]
        self._pieces: dict[str, bytes] = {}

    def _halve(self, rank: int) -> tuple[int, int] | None:
        """The two entries whose merge makes this one; None for single bytes and entries merges never make."""
        entry = self.entries[rank]
        parts = [self._rank[entry[i:i + 1]] for i in range(len(entry))]
        while len(parts) > 2:
            merged = [self._rank.get(self.entries[a] + self.entries[b], rank) for a, b in zip(parts, parts[1:])]
            best = min(merged)
            if best >= rank:
                return None
            at = merged.index(best)
            parts[at:at + 2] = [best]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _prefix(self, entry: bytes) -> int:
        """The longest reachable entry that is a shorter prefix; -1 if there is none."""
        for end in range(len(entry) - 1, 0, -1):
            rank = self._rank.get(entry[:end])
            if rank is not None and (end == 1 or self._halves[rank]):
                return rank
        return -1

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of ``left + right`` end with just these two entries."""
        key = (left, right)
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) >= MOST_KEPT:
                self._compatible.clear()
            known = self._compatible[key] = self._check(left, right)
        return known

    def _check(self, left: int, right: int) -> bool:
        # Undo the merges of both sides, latest first.  What stands at the border before merge m is the pair of parts
        # made by merges before m; if the pair's own merge comes before both parts are merged on, it crosses the border.
        entries, rank, halves = self.entries, self._rank, self._halves
        until = len(entries)
        while True:
            crossing = rank.get(entries[left] + entries[right], until)
            if crossing < until and halves[crossing]:
                return False
            a = left if halves[left] else -1
            b = right if halves[right] else -1
            if a < 0 and b < 0:
                return True
            # Equal merges happen from left to right: the left part of the text is merged before the crossing pair.
            if a > b:
                until, left = left, halves[left][1]
            else:
                until, right = right + 1, halves[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ranks of one match of the pattern."""
        whole = self._rank.get(piece)
        if whole is not None:
            return [whole]
        text = piece.decode("latin-1")
        longest = [rank for _, rank in self._automaton.iter_long(text)]
        if all(map(self.compatible, longest, longest[1:])):
            return longest
        size, entries, shorter = len(text), self.entries, self._shorter
        failed = bytearray(size + 1)
        out: list[int] = []
        at, candidate = 0, longest[0]
        while at < size:
            while candidate >= 0:
                end = at + len(entries[candidate])
                if not failed[end] and (not out or self.compatible(out[-1], candidate)):
                    break
                candidate = shorter[candidate]
            if candidate >= 0:
                out.append(candidate)
                at = end
                if at < size:
                    candidate = next(self._automaton.iter_long(text, at))[1]
            else:
                failed[at] = 1
                candidate = out.pop()
                at -= len(entries[candidate])
        return out

    def _packed(self, piece: str) -> bytes:
        kept = self._pieces.get(piece)
        if kept is None:
            kept = array("I", self.encode_piece(piece.encode("utf-8", "replace"))).tobytes()
            if len(piece) <= LONGEST_KEPT:
                if len(self._pieces) >= MOST_KEPT:
                    self._pieces.clear()
                self._pieces[piece] = kept
        return kept

    def encode(self, text: str | None) -> array:
        """Ranks of a text; none for null."""
        ids = array("I")
        known = self._pieces.get
        ids.frombytes(b"".join([known(p) or self._packed(p) for p in self.split(text or "")]))
        return ids

    def decode(self, ids) -> bytes:
        """Bytes of a sequence of ranks."""
        return b"".join(map(self.entries.__getitem__, ids))


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def load(path: str, pattern: str) -> ByteBpe:
    """The encoder of a rank file, built once per Python process."""
    key = (path, pattern)
    if key not in _LOADED:
        _LOADED[key] = ByteBpe(read_ranks(path), pattern)
    return _LOADED[key]


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (array of int), the encoding of ``text``; a null text is encoded as an empty one.

    The text column is the only one that goes through Python together with the columns to keep; use a narrow frame.
    Clashing columns ``ids`` are replaced.  An empty table gives an empty table.
    """
    kept = [c for c in docs.columns if c != "ids"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema.fields)

    def make():
        bpe, at = load(path, pattern), kept.index(text)
        return lambda *row: (*row, bpe.encode(row[at]))

    return per_row(docs.select(*kept), f"{fields}, ids array<int>", make)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every whole text and decode it again: one row per document with digests of both.

    Columns: doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256, intact (decoded
    bytes equal the text's).  Null texts count as empty; other columns are ignored; repeated rows give repeated rows.
    """
    def make():
        bpe = load(path, pattern)

        def work(doc_id, text):
            ids = bpe.encode(text)
            decoded = bpe.decode(ids)
            return (doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest(),
                    decoded == (text or "").encode())
        return work

    return per_row(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
                   "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, intact boolean", make)


def encoded_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, intact (decoding gives the text back) of every row; null texts count as empty.

    The result is stored, so that few whole texts are handed to a worker at a time.
    """
    def make():
        bpe = load(path, pattern)

        def work(doc_id, lang, source, text):
            ids = bpe.encode(text)
            return doc_id, lang, source, len(ids), ids, bpe.decode(ids) == (text or "").encode()
        return work

    columns = [F.col("doc_id").cast("long"), *[F.col(c).cast("string") for c in ("lang", "source", "text")]]
    rows = per_row(docs.select(*columns), "doc_id long, lang string, source string, n_tokens long, ids array<int>, intact boolean", make, rows=64)
    with small_batches(docs.sparkSession):
        return stored(rows, "encoded")
