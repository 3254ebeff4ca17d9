"""Language identification, language-model scores, and transcripts: brute force, exact sums, held-out accuracy."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from strataflow.llm import attention_lm as A
from strataflow.llm import language_id as L
from strataflow.llm import transcripts as T

RANKS = P.path("byte_bpe_50k.tiktoken")


def test_cross_parsing_by_brute_force():
    refs = {"x": "abracadabra abba cab" * 3, "y": "zebra bez zab ezra" * 3}
    parser, draw = L.CrossParser(refs, 50), random.Random(3)

    def phrases(codes, reference):
        n = 0
        for begin in range(0, len(codes), L.PIECE):
            n, now = n + 1, b""
            for c in codes[begin:begin + L.PIECE].tolist():
                longer = now + bytes([c])
                if longer not in reference:
                    n, longer = n + 1, bytes([c]) if bytes([c]) in reference else b""
                now = longer
        return n

    coded = [parser.alphabet.encode("".join(draw.choice("abrcdzeq ") for _ in range(draw.randint(1, 1500)))) for _ in range(60)]
    got = parser.phrases(coded)
    want = [[phrases(c, bytes(parser.alphabet.encode(refs[k]))) for k in parser.languages] for c in coded]
    assert got.tolist() == want


def test_language_held_out_accuracy(spark, small, small_docs):
    got = L.identify(spark.read.parquet(f"{small}/documents.parquet")).collect()
    lang = {i: k for i, _, k in small_docs}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)


def test_language_edges(odd_docs, clashing, no_docs):
    assert L.identify(no_docs).count() == 0
    for docs in (odd_docs, clashing):
        got = L.identify(docs).collect()
        assert len(got) == 12 and {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 7)} == {"und"}
    unlabelled = odd_docs.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in L.identify(unlabelled).collect()} == {("und", 0.0)}


SHAPE = A.Shape(own=20, shared=8, group=4, inputs=60, width=8, hidden=12, window=8, step=5, keep_one_in=1, shard=200, rounds=1, steps=5)


@pytest.fixture(scope="module")
def model():
    coder, draw = A.load(RANKS, P.PATTERN), random.Random(2)
    texts = [" ".join(draw.choice(["the", "cat", "sat", "upon", "a", "mat", "quietly"]) for _ in range(draw.randint(0, 30))) for _ in range(80)]
    ids = [coder.encode(t) for t in texts]
    counts = np.bincount(np.concatenate(ids), minlength=coder.size)
    return A.Attention(A.Classes(counts, coder.places, SHAPE), SHAPE), ids


def test_gradient(model):
    m, ids = model
    rows, target = m.classes.row[ids[0][:8]][None, :-1], m.classes.of[ids[0][1:8]][None]
    real = np.ones_like(target, bool)
    _, grad = m.gradient(rows, target, real)
    for i in np.argsort(-np.abs(grad))[:200:20]:
        kept = m.flat[i]
        ends = []
        for d in (1e-2, -1e-2):
            m.flat[i] = kept + d
            ends.append(m.gradient(rows, target, real)[0])
        m.flat[i] = kept
        assert abs((ends[0] - ends[1]) / 2e-2 - grad[i]) < 0.02 * max(0.05, abs(grad[i])) + 1e-3


def test_every_token_once_and_whole_distribution(model):
    m, ids = model
    assert [i for b, f, e in A.windows(23, SHAPE) for i in range(f, e)] == list(range(23))
    def brute(text):
        total = 0.0
        for begin, first, end in A.windows(len(text), SHAPE):
            feed = m.inputs(text)[begin:end]
            for q in range(first, end):
                out = m.forward(feed[None, :q - begin + 1])["out"][-1:]
                every = np.exp(m.log_probs(out.repeat(28, 0), np.arange(28)))
                assert abs(every.sum() - 1) < 1e-4
                total += math.log(every[m.classes.of[text[q]]]) + m.classes.log_share[text[q]]
        return total / A.LOG10
    some = [t for t in ids if len(t) > 12][:3] + [ids[5][-1:]]
    assert np.allclose(m.score(some), [brute(t) for t in some], atol=1e-3)
    shares = np.bincount(m.classes.of, np.exp(m.classes.log_share), 28)
    assert np.allclose(shares, 1, atol=1e-4)


def test_training_learns(model):
    m, ids = model
    fresh = A.Attention(m.classes, A.Shape(**{**SHAPE.__dict__, "steps": 120, "passes": 50}))
    before = fresh.score(ids).sum()
    fresh.train([np.concatenate([[m.classes.end], t]).astype(np.int32)[:9] for t in ids], 1)
    assert fresh.score(ids).sum() > before + 20


def test_scores(odd_docs, clashing, no_docs):
    for docs in (odd_docs, clashing):
        rows = docs.collect()
        c = Counter(w for r in rows if zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 10 for w in A.split_words(r.text or ""))
        n, v = sum(c.values()), len(c)
        want = sorted((r.doc_id or -1, len(A.split_words(r.text or "")), sum(c[w] > 0 for w in A.split_words(r.text or "")), n,
                       round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in A.split_words(r.text or "")), 4)) for r in rows)
        got = A.score_texts(docs, RANKS, P.PATTERN, SHAPE).collect()
        assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
        assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert A.score_texts(no_docs, RANKS, P.PATTERN, SHAPE).count() == 0


def test_windows_overlap_by_half():
    shape = A.Shape()
    cut = A.windows(500, shape)
    assert [i for _, f, e in cut for i in range(f, e)] == list(range(500))
    assert all(f - b >= shape.window / 2 for b, f, _ in cut[1:])


def test_windows_of_several_sequences_at_once():
    for shape in (A.Shape(), SHAPE, A.Shape(window=7, step=7)):
        sizes = np.array([0, 1, *range(2, 80), 500])
        want = [(i, *w) for i, n in enumerate(sizes.tolist()) for w in A.windows(n, shape)]
        assert [tuple(r) for r in A.all_windows(sizes, shape).tolist()] == want
    assert A.all_windows(np.array([], int), SHAPE).shape == (0, 4)


def test_groups_by_brute_force(model):
    m, ids = model
    target = m.classes.of[np.concatenate(ids)]
    order, groups = m._by_group(target)
    assert order.tolist() == sorted(range(len(target)), key=lambda i: target[i] // SHAPE.group)
    for g, begin, end in groups:
        assert begin < end and set((target[order[begin:end]] // SHAPE.group).tolist()) == {g}
    assert sum(end - begin for _, begin, end in groups) == len(target)


def test_weights_learn_from_every_training_text(spark):
    # The registered setting; of a few texts, or of texts with one id, a draw by id may take none.
    texts = [f"text number {i} tells of the cat that sat upon the mat " * (i % 4 + 1) for i in range(12)]
    for rows in ([(i, t) for i, t in enumerate(texts)], [(None, t) for t in texts]):
        training = spark.createDataFrame(rows, "doc_id long, text string")
        coder, got = A.load(RANKS, P.PATTERN), A.training_windows(training, RANKS, P.PATTERN)
        want = [np.concatenate([[coder.end], coder.encode(t)]).astype("<u2") for t in texts]
        size = A.Shape().window
        assert sorted(bytes(r.window) for r in got.collect()) == sorted(w[k:k + size + 1].tobytes() for w in want for k in range(0, len(w) - 1, size))
        none = A.Shape(**{**SHAPE.__dict__, "keep_one_in": 1_000_000_007})
        assert A.fit(training, A.base_values(training)[0], RANKS, P.PATTERN, none)[1] is not None


def test_padded_windows_by_brute_force(model):
    m, ids = model
    sequences = [w for t in ids for k in (0, 3) if len(w := np.concatenate([[m.classes.end], t]).astype(np.int32)[k:k + 9]) > 1]
    rows, target, sizes = m._padded(sequences)
    for ids, r, t, n in zip(sequences, rows, target, sizes):
        feed = [m.classes.start if k == 0 and x == m.classes.end else m.classes.row[x] for k, x in enumerate(ids[:-1])]
        assert n == len(ids) - 1 and r.tolist() == feed + [0] * (8 - n) and t.tolist() == [*m.classes.of[ids[1:]], *[0] * (8 - n)]
    assert [a.size for a in m._padded([])] == [0, 0, 0]


def test_windows_are_dealt_once_for_all_rounds(spark, monkeypatch):
    # Every round trains the stored shards, whole ones; the weights are their averages, by windows.
    draw = random.Random(3)
    texts = [" ".join(draw.choice(["the", "cat", "sat", "upon", "a", "mat"]) for _ in range(draw.randint(0, 60))) for _ in range(60)]
    training = spark.createDataFrame([(i % 50 or None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    words, shape, tables = A.base_values(training)[0], A.Shape(**{**SHAPE.__dict__, "shard": 80, "rounds": 3}), {}
    real = A.stored
    monkeypatch.setattr(A, "stored", lambda df, label: tables.setdefault(label, []).append(real(df, label)) or tables[label][-1])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    counts, flat = A.fit(training, words, RANKS, P.PATTERN, shape)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert {label: len(t) for label, t in tables.items()} == {"windows": 1, "shards": 1}
    windows, shards = (tables[label][0].collect() for label in ("windows", "shards"))
    shards = [[bytes(w) for w in r.windows] for r in shards]
    assert len(shards) == -(-len(windows) // 80) > 2 and sorted(w for s in shards for w in s) == sorted(bytes(r.window) for r in windows)
    classes = A.Classes(counts, A.load(RANKS, P.PATTERN).places, shape)
    want = A.Attention(classes, shape).flat
    for turn in range(3):
        models = [A.Attention(classes, shape, want) for _ in shards]
        for m, s in zip(models, shards):
            m.train([np.frombuffer(w, "<u2").astype(np.int32) for w in s], seed=turn)
        want = sum(m.flat.astype(float) * len(s) for m, s in zip(models, shards)).astype(float) / len(windows)
        want = want.astype(np.float32)
    assert np.allclose(flat, want, atol=1e-5)


CHATS = "conv_id long, turn long, role string, text string"


def brute_path(model, rows):
    steps = [s for r in rows for s in model.row_steps(r[3] or "")]
    best, at = -math.inf, None
    for path in itertools.product(range(len(model.roles)), repeat=len(steps)):
        score = model.first[path[0]] + steps[0][1][path[0]]
        for k in range(1, len(steps)):
            score += model.turn(steps[k][0])[path[k - 1], path[k]] + steps[k][1][path[k]]
        if score > best:
            best, at = score, path
    return at


def test_transcripts_by_brute_force(spark, monkeypatch):
    draw, rows = random.Random(5), []
    for conv in range(12):
        role = "user"
        for turn in range(draw.choice([1, 3, 8])):
            rows.append((conv, turn, role, ("short?" if role == "user" else "a long answer. " * 9) + ("\nmore" if draw.random() < 0.2 else "")))
            role = "assistant" if role == "user" else "user"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "17")  # conversations cross the borders of partitions
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        chats = spark.createDataFrame(rows, CHATS).repartition(3)
        ordered = T._ordered(chats)
        assert ordered.select("part").distinct().count() > 10
        model = T.learn(ordered)
        got = sorted(T.format_chats(chats).collect(), key=lambda r: (r.conv_id, r.turn, r.piece))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(got) == len(rows) and all(r.role == r.role_pred for r in got)
    for conv in range(12):
        own = [r for r in rows if r[0] == conv]
        path, k = brute_path(model, own) if sum(len(r[3].split("\n")) for r in own) < 11 else None, 0
        for r, source in zip([g for g in got if g.conv_id == conv], own):
            if path:
                assert r.role_pred == model.roles[path[k]]
                k += len(source[3].split("\n"))
            assert r.rendered == ("<|%s|>\n" % r.role_pred if r.opens else "") + source[3]


def test_markers_change_roles(spark):
    known = [(i, t, r, "x" * (9 if r == "user" else 90)) for i in range(9) for t, r in enumerate(["user", "assistant"] * 2)]
    raw = [(99, 0, None, "User: hello there\nAssistant: good day to you\nand more of it\nUser: bye")]
    got = [r for r in T.format_chats(spark.createDataFrame(known + raw, CHATS)).collect() if r.conv_id == 99]
    assert [(r.piece, r.role_pred, r.rendered) for r in sorted(got, key=lambda r: r.piece)] == [
        (0, "user", "<|user|>\nhello there"), (1, "assistant", "<|assistant|>\ngood day to you\nand more of it"), (2, "user", "<|user|>\nbye")]


def test_transcript_edges(spark):
    assert T.format_chats(spark.createDataFrame([], CHATS)).count() == 0
    rows = [(None, 0, "user", "a"), (1, None, None, None), (1, 2, "user", ""), (1, 2, "user", ""), (1, 2, "assistant", "tie"), (2, 5, None, "y " * 50_000)]
    extra = spark.createDataFrame([(*r, 1, 2) for r in rows], CHATS + ", part int, opens int")
    got = T.format_chats(extra).collect()
    assert len(got) == 6 and {r.role_pred for r in got} <= {"user", "assistant", "system"}


def test_every_copy_of_a_turn_has_its_result(spark, monkeypatch):
    monkeypatch.setattr(T, "COPIES", 3)
    rows = [(None, 1, "user", "User: hi")] * 8 + [(None, 1, "user", "User: hi there")] * 3 + [(4, 1, None, "Assistant: x\ny")] * 7
    got = Counter((r.conv_id, r.piece, r.rendered.split("\n")[-1]) for r in T.format_chats(spark.createDataFrame(rows, CHATS)).collect())
    assert got == {(None, 0, "hi"): 8, (None, 0, "hi there"): 3, (4, 0, "y"): 7}


def test_all_drawn_parts_teach():
    parts = ["a" * 10, "b" * 100, "c" * 2000, "d" * 2000]
    assert [L.shared_out(parts, 1000).count(c) for c in "abcd"] == [10, 100, 443, 443]
    assert L.shared_out(parts, 5000) == " ".join(parts) and len(L.shared_out(parts, 7)) <= 7 and L.shared_out([], 10) == ""
