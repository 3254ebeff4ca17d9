"""Byte-level BPE and piece counts against their libraries."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken

from strataflow.llm import byte_bpe, term_sums, token_counts

RANKS = P.path("byte_bpe_50k.tiktoken")
PIECES = P.path("piece_bpe_32k.model")
LETTERS = "abc ABCet  aon\n\t\r\x1c\x85\xa0 éüñ0123456789.,;'sll漢字कि😀́​▁﻿"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts(small_docs):
    draw = random.Random(4)
    made = ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 50))) for _ in range(1500)]
    wide = ["".join(chr(draw.choice([draw.randint(1, 0xD7FF), draw.randint(0xE000, 0x1FFFF), 32])) for _ in range(40)) for _ in range(600)]
    return made + wide + ["a" * 20_000, "ab" * 5_000, " " * 3_000, "<|endoftext|> <s>"] + [t or "" for _, t, _ in small_docs]


def test_bpe_as_the_library(library, texts):
    bpe = byte_bpe.load(RANKS, P.PATTERN)
    for text in texts:
        ids = bpe.encode(text)
        assert list(ids) == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_bpe_small_memory(library, texts, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOST_KEPT", 50)
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS), P.PATTERN)
    assert all(list(bpe.encode(t)) == library.encode_ordinary(t) for t in texts[:300])


def test_round_trip_rows(odd_docs, clashing, no_docs, library):
    for docs in (odd_docs, clashing):
        got = byte_bpe.round_trip(docs, RANKS, P.PATTERN).collect()
        assert len(got) == docs.count() and all(r.intact for r in got)
        want = {r.doc_id: r.text or "" for r in docs.collect()}
        for r in got:
            ids = library.encode_ordinary(want[r.doc_id])
            assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest())
            assert r.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
    assert byte_bpe.round_trip(no_docs, RANKS, P.PATTERN).count() == 0
    kept = byte_bpe.encode_texts(clashing, RANKS, P.PATTERN)
    assert kept.columns == [c for c in clashing.columns if c != "ids"] + ["ids"] and kept.count() == clashing.count()


def test_pieces_as_the_library(texts):
    model, library = token_counts.load(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert [sum(model.sizes(model.terms(t))) for t in texts] == [len(ids) for ids in library.encode(texts, num_threads=1)]


@pytest.mark.parametrize("frequent", [200_000, 3])
def test_piece_counts_rows(odd_docs, clashing, no_docs, monkeypatch, frequent):
    monkeypatch.setattr(term_sums, "MOST_FREQUENT", frequent)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for docs in (odd_docs, clashing):
        got = token_counts.token_counts(docs, PIECES, limit=1000).collect()
        want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in docs.collect())
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 1000) for r in got)
    assert token_counts.token_counts(no_docs, PIECES).count() == 0
