"""Text quality by a generalised additive model with pairwise interactions.

The score is a sum of lookups: one table per feature and one per pair of features that matters, indexed by the bins of the values.
Tables are learned by cyclic boosting: feature after feature, round after round, a shallow tree over the bins fits the gradient of the
log loss, and a small part of it is added to the feature's table.  Then the pairs with the largest remaining gain get tables of their
own in the same way.  A model can be read as its tables, and models are averaged by averaging tables.

Features of a text are computed once, for all documents.  Bin borders are quantiles over all labelled rows.  Several models are fitted in
tasks of their own, each on a bounded draw of the labelled rows (:class:`Learning`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

FEATURES = ("log_words", "word_length", "long_words", "short_words", "distinct_words", "top_word", "repeated_next", "upper", "shouted",
            "digits", "symbols", "bars", "marks", "exclaimed", "other_ascii", "beyond_ascii", "letter_entropy", "log_lines", "words_per_line",
            "distinct_lines", "short_lines", "sentence_length")
#: Occurrences of a byte class are counted through these tables.
_UPPER, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_SYMBOL, _MARK = b"#*$%&<>=_~^@", b".,;:!?"
_SPACE = b" \t\n\v\f\r"


@dataclass(frozen=True)
class Learning:
    """Bounds and settings.  ``models`` of at most ``rows`` labelled rows each (the smallest hashes of their ids); ``bins`` per feature and
    ``pair_bins`` per side of a pair; ``pairs`` kept; at most ``rounds`` over all tables at ``rate``, ended when the rows left out
    for it (a fifth) have not improved for ``patience`` rounds; leaves of at least ``leaf`` rows."""

    models: int = 8
    rows: int = 4_000
    bins: int = 32
    pair_bins: int = 8
    pairs: int = 10
    rounds: int = 150
    patience: int = 15
    rate: float = 0.1
    leaf: int = 5
    seed: int = 11


def _share(a: float, b: float) -> float:
    return a / b if b else 0.0


def features(text: str | None) -> list[float]:
    """Values of :data:`FEATURES` of a whole text; all 0 for null and empty texts."""
    body = (text or "").encode("utf-8", "replace")
    words = body.split()
    if not words:
        return [0.0] * len(FEATURES)
    lines = [line for line in body.split(b"\n") if line.strip(_SPACE)]
    seen = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    count = lambda chars: int(seen[list(chars)].sum())
    n, chars = len(words), len(body) - count(_SPACE)
    sizes = np.fromiter(map(len, words), np.int64, n)
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    lower = seen[97:123] + seen[65:91]
    letters = lower[lower > 0] / max(1, lower.sum())
    return [
        np.log1p(n), sizes.mean(), (sizes > 15).mean(), (sizes < 3).mean(), len(tally) / n, max(tally.values()) / n,
        _share(sum(map(bytes.__eq__, words, words[1:])), n - 1), _share(count(_UPPER), chars), sum(w.isupper() and len(w) > 1 for w in words) / n,
        _share(count(_DIGIT), chars), _share(count(_SYMBOL), chars), _share(int(seen[124]), n), _share(count(_MARK), n), _share(int(seen[33]), n),
        _share(int(seen[33:127].sum()) - count(_UPPER + _DIGIT + _SYMBOL + _MARK) - int(seen[97:123].sum()), chars),
        _share(int(seen[128:].sum()), chars), float(-(letters * np.log2(letters)).sum()), np.log1p(len(lines)), n / len(lines),
        len(set(lines)) / len(lines), sum(len(line.split()) < 4 for line in lines) / len(lines),
        n / (1 + int(seen[list(b".!?")].sum()))]


def with_features(docs: DataFrame) -> DataFrame:
    """(doc_id, values) of every row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [features(t.as_py()) for t in batch.column(1)]
            flat = pa.array(np.array(values, np.float64).reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(FEATURES)), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "values"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, values array<double>")


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def tree_1d(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaf: int, depth: int = 2) -> np.ndarray:
    """Newton steps of a tree over ordered bins, from sums of gradient and curvature and row counts per bin."""
    out = np.full(len(g), g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 2:
        return out
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    gain[(nl < leaf) | (n.sum() - nl < leaf)] = -1
    at = int(gain.argmax()) + 1
    if gain[at - 1] <= 1e-9:
        return out
    out[:at] = tree_1d(g[:at], h[:at], n[:at], leaf, depth - 1)
    out[at:] = tree_1d(g[at:], h[at:], n[at:], leaf, depth - 1)
    return out


def tree_2d(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaf: int) -> tuple[np.ndarray, float]:
    """Newton steps and gain of the best tree over two ordered axes that cuts one axis, then each side along the other."""
    best, best_gain = np.zeros_like(g), 0.0
    for axis in (0, 1):
        # Sums of (gradient, curvature, rows) on either side of each cut: (kind, side, cut, place on the other axis).
        sums = np.stack((g, h, n) if axis == 0 else (g.T, h.T, n.T))
        upper = sums.cumsum(axis=1)[:, :-1]
        sides = np.stack([upper, sums.sum(axis=1, keepdims=True) - upper], axis=1)
        left = sides.cumsum(axis=3)
        whole = left[..., -1:]
        right = whole - left
        gain = _gain(left[0], left[1]) + _gain(right[0], right[1])
        # The last place is no cut.
        gain[..., :-1][(left[2] < leaf)[..., :-1] | (right[2] < leaf)[..., :-1]] = -1
        at = gain.argmax(axis=2)
        total = np.take_along_axis(gain, at[..., None], 2)[..., 0].sum(axis=0) - _gain(g.sum(), h.sum())
        total[(whole[2, ..., 0] < leaf).any(axis=0)] = -1
        cut = int(total.argmax())
        if total[cut] > best_gain + 1e-12:
            best_gain, step = float(total[cut]), np.empty_like(sums[0])
            for side, rows in enumerate((slice(0, cut + 1), slice(cut + 1, None))):
                k = at[side, cut]
                for part, columns in ((left, slice(0, k + 1)), (right, slice(k + 1, None))):
                    step[rows, columns] = part[0, side, cut, k] / (part[1, side, cut, k] + 1.0)
            best = step if axis == 0 else step.T
    return best, best_gain


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _loss(y: np.ndarray, x: np.ndarray) -> float:
    p = np.clip(_sigmoid(x), 1e-9, 1 - 1e-9)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


@dataclass
class Model:
    """Borders per feature, intercept, a table per feature, and pairs with their borders and tables."""

    borders: list[np.ndarray]
    coarse: list[np.ndarray]
    intercept: float
    tables: np.ndarray
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Probability of label 1 of rows of feature values."""
        fine, rough = binned(values, self.borders), binned(values, self.coarse)
        x = np.full(len(values), self.intercept)
        for f, table in enumerate(self.tables):
            x += table[fine[:, f]]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            x += table[rough[:, i], rough[:, j]]
        return _sigmoid(x)


def binned(values: np.ndarray, borders: list[np.ndarray]) -> np.ndarray:
    """Bin of every value: the number of borders below it."""
    out = np.zeros(values.shape, np.int64)
    for f, edge in enumerate(borders):
        out[:, f] = np.searchsorted(edge, values[:, f], side="left")
    return out


def fit_tables(fine: np.ndarray, rough: np.ndarray, y: np.ndarray, held: np.ndarray, how: Learning):
    """Intercept, feature tables, and {pair: table}: boosted on the rows not ``held``, ended by those that are."""
    width = fine.shape[1]
    fit = ~held
    prior = (y[fit].sum() + 1) / (fit.sum() + 2)
    intercept = float(np.log(prior / (1 - prior)))
    score = np.full(len(y), intercept)

    def boost(codes: list[np.ndarray], shape: tuple[int, ...], grow) -> list[np.ndarray]:
        nonlocal score
        size = int(np.prod(shape))
        tables = [np.zeros(shape) for _ in codes]
        counts = [np.bincount(c[fit], minlength=size).reshape(shape).astype(float) for c in codes]
        best, best_loss, waited = [t.copy() for t in tables], _loss(y[held], score[held]) if held.any() else np.inf, 0
        best_score = score.copy()
        for _ in range(how.rounds):
            for k, code in enumerate(codes):
                p = _sigmoid(score[fit])
                g = np.bincount(code[fit], y[fit] - p, size).reshape(shape)
                h = np.bincount(code[fit], p * (1 - p), size).reshape(shape)
                step = how.rate * grow(g, h, counts[k])
                tables[k] += step
                score = score + step.reshape(-1)[code]
            loss = _loss(y[held], score[held]) if held.any() else _loss(y[fit], score[fit])
            if loss < best_loss - 1e-6:
                best, best_loss, best_score, waited = [t.copy() for t in tables], loss, score.copy(), 0
            else:
                waited += 1
                if waited >= how.patience:
                    break
        score = best_score
        return best

    mains = boost([fine[:, f] for f in range(width)], (how.bins,), lambda g, h, n: tree_1d(g, h, n, how.leaf))
    # Pairs by the gain of a first step on what the features leave over.
    side, p = how.pair_bins, _sigmoid(score[fit])
    gains = []
    for i, j in combinations(range(width), 2):
        code = (rough[:, i] * side + rough[:, j])[fit]
        g, h, n = (np.bincount(code, w, side * side).reshape(side, side) for w in (y[fit] - p, p * (1 - p), None))
        gains.append((tree_2d(g, h, n.astype(float), how.leaf)[1], i, j))
    chosen = [(i, j) for _, i, j in sorted(gains, key=lambda x: (-x[0], x[1], x[2]))[:how.pairs]]
    boosted = boost([rough[:, i] * side + rough[:, j] for i, j in chosen], (side, side), lambda g, h, n: tree_2d(g, h, n, how.leaf)[0])
    return intercept, np.array(mains), dict(zip(chosen, boosted))


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """(id, y): ids with one label of 0 or 1; null ids, other values and ids labelled both ways teach nothing."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("id"))
            .agg(F.min(label).alias("y"), F.max(label).alias("__high")).where(F.col("y") == F.col("__high"))
            .select("id", F.col("y").cast("double").alias("y")))


def held_out(doc_id: Column, modulus: int = 5) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == 0


def learn(rows: DataFrame, labels: DataFrame, label: str = "quality", how: Learning = Learning()) -> Model | None:
    """The averaged model, from (doc_id, values) and (doc_id, label); None without labelled rows of both kinds.

    Of rows with one id one teaches.  Borders come from all labelled rows; the tables of ``how.models`` models, a few thousand numbers each,
    from one task per model.
    """
    known = known_labels(labels, label)
    one = rows.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("values").alias("values"))
    taught = stored(one.join(known, F.col("doc_id") == F.col("id")).select("doc_id", "values", "y"), "taught")
    kinds = taught.agg(F.min("y").alias("low"), F.max("y").alias("high"), F.count(F.lit(1)).alias("n")).first()
    if not kinds.n or kinds.low == kinds.high:
        return None
    width = len(FEATURES)
    edges = lambda bins: [(k + 1) / bins for k in range(bins - 1)]
    cut = taught.agg(*[F.percentile_approx(F.col("values")[f], edges(b)).alias(f"{b}_{f}") for f in range(width) for b in (how.bins, how.pair_bins)]).first()
    borders, coarse = ([np.unique(cut[f"{b}_{f}"]) for f in range(width)] for b in (how.bins, how.pair_bins))

    def fit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        values = np.array(part["values"].tolist(), np.float64)
        y = part["y"].to_numpy(np.float64)
        held = np.random.default_rng(how.seed + int(key[0])).random(len(y)) < 0.2
        if len(set(y[~held])) < 2:
            held[:] = False
        intercept, mains, pairs = fit_tables(binned(values, borders), binned(values, coarse), y, held, how)
        return pd.DataFrame({"intercept": [intercept], "mains": [mains.reshape(-1).tolist()], "pairs": [[list(p) for p in pairs]],
                             "tables": [[t.reshape(-1).tolist() for t in pairs.values()]]})

    # Every labelled row has a hash; each model takes the rows with the smallest hashes from its own draw, few of the same when there are many.
    draw = lambda m: F.xxhash64(F.lit(how.seed), F.lit(m), F.col("doc_id"))
    share = min(1.0, 2.0 * how.rows / kinds.n)
    limit = int((share - 0.5) * (2 ** 64 - 1))
    drawn = None
    for m in range(how.models):
        part = taught.where(draw(m) <= min(limit, 2 ** 63 - 1)).orderBy(draw(m)).limit(how.rows).select(F.lit(m).alias("model"), "values", "y")
        drawn = part if drawn is None else drawn.union(part)
    schema = "intercept double, mains array<double>, pairs array<array<int>>, tables array<array<double>>"
    fitted = drawn.repartition(how.models, "model").groupBy("model").applyInPandas(fit, schema).collect()
    side, total = how.pair_bins, {}
    for row in fitted:
        for p, t in zip(row.pairs, row.tables):
            total[tuple(p)] = total.get(tuple(p), 0) + np.array(t).reshape(side, side) / len(fitted)
    return Model(borders, coarse, float(np.mean([r.intercept for r in fitted])), np.mean([np.array(r.mains).reshape(width, how.bins) for r in fitted], axis=0),
                 sorted(total), np.array([total[p] for p in sorted(total)]).reshape(-1, side, side))


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", how: Learning = Learning(), least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``least`` on) of every row of ``docs`` (doc_id, text); ``labels``: doc_id and ``label``.

    Null and empty texts have features of 0 and are scored by them.  Repeated rows are scored alike, and teach once.  Without labelled rows of
    both kinds every score is the share of label 1 among what is known, or 0.5.  Other columns are ignored, whatever their names.
    """
    rows = stored(with_features(docs.select("doc_id", "text")), "features")
    model = learn(rows, labels, label, how)
    if model is None:
        seen = known_labels(labels, label).where(~held_out(F.col("id"))).agg(F.avg("y").alias("y")).first().y
        score = F.lit(0.5 if seen is None else float(seen))
        return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= least).cast("int").alias("predicted"))
    handed = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(handed.value.scores(values))],
                                             names=["doc_id", "held_out", "score"])

    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "values").mapInArrow(
        run, "doc_id long, held_out boolean, score double")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"))
