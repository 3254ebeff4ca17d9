"""Token counts of a piece model without token ids of any text.

Merges never make a piece that the vocabulary lacks.  So no token crosses a place where the two neighbouring characters never
stand side by side inside a piece: before white space, and between characters of different alphabets.  The parts between
such places are the pre-tokens.  The pieces of every distinct pre-token are counted once; a document's count is the sum over
its pre-token frequencies.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .term_sums import count_terms, store_values, sum_by_document

#: The white-space mark inside pieces.
MARK = "▁"
#: Alphabets of at least this many characters get a class of their own; the rest share one.
LEAST_ALPHABET = 8


class PieceModel:
    """A sentencepiece BPE model: pre-tokens of a text, and piece counts of pre-tokens."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as protocol

        model = protocol.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, training = model.normalizer_spec, model.trainer_spec
        texts = [p.piece for p in model.pieces if p.type == 1]
        if (training.model_type != 2 or rules.precompiled_charsmap or rules.remove_extra_whitespaces or training.treat_whitespace_as_suffix
                or any(p.type == 4 for p in model.pieces) or any(MARK in t.lstrip(MARK) for t in texts)):
            raise ValueError("needs a BPE model without text normalisation, with white space only in front of pieces")
        self._prefix = MARK if rules.add_dummy_prefix else ""
        rules.add_dummy_prefix = False
        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self._split = re.compile(self._pattern(texts)).findall

    @staticmethod
    def _pattern(pieces: list[str]) -> str:
        above: dict[str, str] = {}

        def top(c: str) -> str:
            while above.setdefault(c, c) != c:
                above[c] = above[above[c]]
                c = above[c]
            return c

        for piece in pieces:
            body = piece.lstrip(MARK)
            for a, b in zip(body, body[1:]):
                above[top(a)] = top(b)
        alphabets: dict[str, list[str]] = defaultdict(list)
        for c in sorted(above):
            alphabets[top(c)].append(c)
        listed = ["".join(map(re.escape, a)) for a in alphabets.values() if len(a) >= LEAST_ALPHABET]
        runs = "|".join([f"[{a}]+" for a in listed] + [f"[^{MARK}{''.join(listed)}]+"])
        return f"{MARK}*(?:{runs})|{MARK}+"

    def terms(self, text: str) -> list[bytes]:
        """Pre-tokens of a whole text, white space as marks."""
        return [t.encode() for t in self._split(self._prefix + text.replace(" ", MARK))] if text else []

    def sizes(self, terms: list[bytes]) -> list[int]:
        """Piece counts of pre-tokens."""
        return [len(ids) for ids in self._pieces.encode([t.decode() for t in terms], num_threads=1)]


_LOADED: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    """A model, read once per Python process."""
    if path not in _LOADED:
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


def token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row of ``docs``.

    Null texts count as empty and have no tokens.  Rows with the same id are counted apart.  Other columns are ignored.
    """
    def split() -> Callable[[str], list[bytes]]:
        return load(path).terms

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            sizes = pa.array(model.sizes(batch.column(0).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes], names=["term", "occurrences", "pieces"])

    seen = count_terms(docs.select(F.col("text").cast("string")), split)
    values = store_values(seen.mapInArrow(measure, "term binary, occurrences long, pieces long"), "pieces")
    sums = sum_by_document(docs.select("doc_id", "text"), values, ["pieces"], split)
    n = F.col("pieces").cast("long")
    return sums.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
