"""Language identification by cross-parsing.

For each language a suffix automaton is built from a bounded sample of labelled text.  A document is cut greedily into the
longest phrases the automaton knows; the more alike the languages, the longer the phrases.  The language with the fewest
phrases wins, each phrase weighted by the cost of pointing into its reference text and the sum divided by the length.

Documents are parsed in equal pieces, many at once: one numpy step moves every piece of a batch by one character.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prediction for texts without letters.
UNKNOWN = "und"
#: Length of the pieces that are parsed side by side; a phrase ends where a piece does.
PIECE = 512
#: Characters per numpy batch.
BATCH = 2_000_000


@dataclass(frozen=True)
class Sampling:
    """Bounds of the labelled sample: documents per language (expected), characters per document, characters per language,
    letters told apart."""

    documents: int = 160
    per_document: int = 2_000
    per_language: int = 40_000
    letters: int = 120


def held_out(doc_id: Column, modulus: int = 3, rest: int = 1) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text; ids that are null count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == rest


def sample_texts(docs: DataFrame, sampling: Sampling = Sampling()) -> dict[str, str]:
    """Reference text per language: a piece of each of a bounded number of labelled documents, chosen by a hash of the id."""
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    draw = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(1_000_000_007)) / 1_000_000_007
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sampling.documents / n))) for k, n in sizes.items()])
    # From the middle of the text: beginnings are often boilerplate.
    start = F.greatest(F.lit(1), F.floor((F.length("text") - sampling.per_document) / 2).cast("int"))
    rows = (labelled.where(draw < share).select("lang", "doc_id", F.col("text").substr(start, F.lit(sampling.per_document)).alias("part"))
            .collect())
    parts: dict[str, list[tuple]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], str(r["doc_id"]), r["part"])):
        parts.setdefault(row["lang"], []).append(row["part"])
    return {k: shared_out(v, sampling.per_language) for k, v in parts.items()}


def shared_out(parts: list[str], size: int) -> str:
    """The parts joined by spaces, cut to ``size`` characters in all: each is cut at one length, so that all drawn documents teach."""
    room, left = size + 1, len(parts)
    limit = 0
    for length in sorted(len(p) + 1 for p in parts):
        # Short parts leave their rest to the longer ones.
        limit = room // left
        if length > limit:
            break
        room, left, limit = room - length, left - 1, length
    return " ".join(p[:max(0, limit - 1)] for p in parts)[:size]


class Alphabet:
    """Characters as small numbers: 0 other letter, 1 anything between words, 2... the known letters, whatever their case."""

    def __init__(self, texts: list[str], letters: int):
        counts = Counter(c for t in texts for c in t.lower() if c.isalpha())
        self.known = sorted(c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:letters])
        self.size = len(self.known) + 2
        self._codes = _letters().astype(np.uint8) ^ 1
        for i, c in enumerate(self.known):
            for form in {c, c.upper()}:
                if len(form) == 1:
                    self._codes[ord(form)] = i + 2

    def encode(self, text: str) -> np.ndarray:
        """Codes of a text; a run of non-letters is one code."""
        codes = self._codes[np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")]
        if len(codes) < 2:
            return codes
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 1) | (codes[:-1] != 1)
        return codes[keep]


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def suffix_automaton(codes: np.ndarray, size: int) -> np.ndarray:
    """Transitions (state, code) -> state of the automaton of all substrings; 0 is the start, and stands for no transition."""
    nexts: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes.tolist():
        new = len(nexts)
        nexts.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    table = np.zeros((len(nexts), size), np.int32)
    for state, row in enumerate(nexts):
        for c, to in row.items():
            table[state, c] = to
    return table


class CrossParser:
    """Automata of all languages over one alphabet."""

    def __init__(self, texts: dict[str, str], letters: int):
        self.languages = sorted(texts)
        self.alphabet = Alphabet([texts[k] for k in self.languages], letters)
        coded = [self.alphabet.encode(texts[k]) for k in self.languages]
        self._tables = [suffix_automaton(c, self.alphabet.size).ravel() for c in coded]
        self._bits = np.array([np.log2(len(c) + 2) for c in coded])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases (text, language)."""
        out = np.zeros((len(texts), len(self.languages)))
        sizes = np.array([len(t) for t in texts], np.int64)
        whole = np.concatenate([*texts, np.zeros(PIECE, np.uint8)]) if texts else np.zeros(PIECE, np.uint8)
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = begins[owner] + nth * PIECE
        left = np.minimum(PIECE, begins[owner] + sizes[owner] - start)
        order = np.argsort(-left, kind="stable")
        owner, start, left = owner[order], start[order], left[order]
        size = self.alphabet.size
        states = [np.zeros(len(owner), np.int64) for _ in self._tables]
        counts = [np.ones(len(owner), np.int64) for _ in self._tables]
        for i in range(int(left[0]) if len(left) else 0):
            n = int(np.searchsorted(-left, -i, side="left"))  # pieces longer than i come first
            codes = whole[start[:n] + i]
            for table, state, count in zip(self._tables, states, counts):
                to = table[state[:n] * size + codes]
                ended = to == 0
                count[:n] += ended
                state[:n] = np.where(ended, table[codes], to)
        for j, count in enumerate(counts):
            np.add.at(out[:, j], owner, count)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score (0 to 1: by how much the second best language needs more) of each text."""
        answers: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        if not self.languages:
            return answers
        todo: list[tuple[int, np.ndarray]] = []
        held = 0

        def flush() -> None:
            if todo:
                cost = self.phrases([c for _, c in todo]) * self._bits
                for (i, codes), row in zip(todo, cost / np.array([[max(1, len(c))] for _, c in todo])):
                    order = np.argsort(row, kind="stable")
                    best, second = row[order[0]], row[order[1]] if len(row) > 1 else np.inf
                    answers[i] = (self.languages[order[0]], float(1 - best / second))
            todo.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            codes = self.alphabet.encode(text)
            if (codes != 1).any():
                todo.append((i, codes))
                held += len(codes)
                if held >= BATCH:
                    flush()
                    held = 0
        flush()
        return answers


_BUILT: dict[tuple, CrossParser] = {}


def _parser(texts: dict[str, str], letters: int) -> CrossParser:
    key = (letters, *sorted(texts.items()))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = CrossParser(texts, letters)
    return _BUILT[key]


def identify(docs: DataFrame, sampling: Sampling = Sampling()) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang).

    Learned from labelled rows that are not held out.  A text that is null or has no letter gets ``und``, as does every text
    when there is nothing to learn from.  Other columns are ignored; repeated rows stay repeated.
    """
    samples = sample_texts(docs.select("doc_id", "text", "lang"), sampling)
    letters = sampling.letters
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(samples, letters)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                answers = parser.predict(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([a for a, _ in answers], pa.string()),
                     pa.array([s for _, s in answers], pa.float64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")
