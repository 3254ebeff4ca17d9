"""Mixing sources to target weights.

A source with the token share p gets the weight p**a / sum of all p**a.  The exponent a is found by bisection: as close to 0
(equal weights) as a limit on repetitions allows, or just low enough for a wanted entropy.  The budget is the smallest one
that uses every source at least once, so nothing is lost and small sources are repeated.  Documents of a source are dealt to
blocks; an epoch takes the blocks in a permutation of its own, and the last one stops where the source's budget is used up.
Which rows an epoch takes follows from the row and a small plan per source and epoch: documents are not shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored

#: Blocks per source.
BLOCKS = 256


def n_words(text: Column) -> Column:
    """Tokens of a text in the sense of the weights: its words."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _digest(*parts) -> Column:
    return F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]))


def _modulo(digest: Column, n: int) -> Column:
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def entropy(shares: list[float]) -> float:
    return -sum(s * math.log(s) for s in shares if s > 0)


def weights(tokens: list[int], exponent: float) -> list[float]:
    """Normalised weights of sources with so many tokens."""
    whole = sum(tokens)
    powers = [(t / whole) ** exponent if t else 0.0 for t in tokens]
    return [p / sum(powers) for p in powers] if whole else powers


def repetitions(tokens: list[int], exponent: float) -> list[float]:
    """Passes over each source at the smallest budget that uses every source once; 1 for empty ones."""
    most = max(tokens, default=0)
    return [(most / t) ** (1 - exponent) if t else 1.0 for t in tokens]


def find_exponent(tokens: list[int], most_passes: float | None = None, least_entropy: float | None = None) -> float:
    """The lowest exponent in [0, 1] that keeps to ``most_passes``, or the highest one that reaches ``least_entropy``.

    ``least_entropy`` is a share of the highest possible one, log of the number of sources.  If both are given the limit
    on passes wins.
    """
    filled = [t for t in tokens if t]
    if len(filled) < 2:
        return 1.0
    low, high = 0.0, 1.0
    wanted = None if least_entropy is None else least_entropy * math.log(len(filled))

    def too_flat(a: float) -> bool:
        if most_passes is not None and max(repetitions(filled, a)) > most_passes:
            return True
        return wanted is not None and entropy(weights(filled, a)) > wanted

    if not too_flat(low):
        return low
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high


def plan(sized: DataFrame, most_passes: float | None, least_entropy: float | None, seed: int) -> DataFrame:
    """(source, epoch, weight, ranks, whole, cut): per source and epoch the rank of every block, the number of blocks taken
    whole, and the last document key taken from the next block (null: none).

    ``sized``: source, block, key, tokens of every row.
    """
    spark = sized.sparkSession
    blocks = stored(sized.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")), "blocks")
    # One row per source: what the weights depend on.
    sources = blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")).orderBy("source").collect()
    tokens = [r.tokens for r in sources]
    exponent = find_exponent(tokens, most_passes, least_entropy)
    passes = [max(1.0, p) for p in repetitions(tokens, exponent)]
    budgets = spark.createDataFrame(
        [(r.source, t, round(t * p), w) for r, t, p, w in zip(sources, tokens, passes, weights(tokens, exponent))],
        "source string, tokens long, budget long, weight double")
    epochs = (budgets.withColumn("full", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1))
              .withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("full") * F.col("tokens")).otherwise(0))
              .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("full") + (F.col("rest") > 0).cast("long"))).alias("epoch")))
    order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), lambda b: F.struct(
        _digest(seed, F.coalesce("source", F.lit("")), F.col("epoch").cast("string"), b.cast("string")).alias("d"), b.alias("b"))))
    # The ranks of blocks 0, 1, 2, ...: positions in the permutation, sorted back by block.
    ranks = F.transform(F.array_sort(F.transform(order, lambda x, k: F.struct(x["b"].alias("b"), k.alias("k")))), lambda x: x["k"])
    epochs = epochs.select("source", "epoch", "weight", "full", "rest", ranks.alias("ranks"))
    last = epochs.where(F.col("epoch") > F.col("full")).alias("e")
    same = F.col("e.source").eqNullSafe(F.col("b.source"))
    in_order = last.join(blocks.alias("b"), same).select(
        "e.source", "e.rest", "b.block", "b.tokens", F.col("e.ranks")[F.col("b.block")].alias("rank"))
    so_far = F.sum("tokens").over(Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1))
    started = in_order.withColumn("before", F.coalesce(so_far, F.lit(0))).where(F.col("before") < F.col("rest"))
    # The last block begun is the one that may be taken in part only.
    ends = started.groupBy("source").agg(F.max_by(F.struct("block", "rank", (F.col("rest") - F.col("before")).alias("left")), "rank").alias("at"))
    docs = (sized.alias("d").join(ends.alias("x"), F.col("d.source").eqNullSafe(F.col("x.source")) & (F.col("d.block") == F.col("x.at.block")))
            .groupBy("x.source", "d.key", "x.at").agg(F.sum("d.tokens").alias("tokens")))
    taken = docs.withColumn("before", F.coalesce(F.sum("tokens").over(
        Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    cuts = (taken.where(F.col("before") < F.col("at.left")).groupBy("source")
            .agg(F.max("key").alias("cut"), F.first("at.rank").alias("whole")))
    ready = epochs.alias("e").join(cuts.alias("c"), F.col("e.source").eqNullSafe(F.col("c.source")) & (F.col("e.epoch") > F.col("e.full")), "left")
    return stored(ready.select("e.source", "e.epoch", "e.weight", "e.ranks", F.coalesce("c.whole", F.lit(BLOCKS)).alias("whole"), "c.cut"), "mix")


def mix(docs: DataFrame, most_passes: float | None = 2.0, least_entropy: float | None = None, seed: int = 17,
        tokens: Column | None = None) -> DataFrame:
    """Every row of ``docs`` once per epoch that takes it, with ``epoch``, ``block_rank`` and ``weight`` (of its source) added.

    Needs doc_id, source, text.  Null sources form a source of their own, null ids count as one id, rows with the same id go
    together.  The last epoch of a source goes past its budget by less than one document.  Columns named like the added ones
    are replaced.  Ordered by (epoch, block_rank) a source is in its permuted order.
    """
    kept = [F.col(f"d.`{c}`") for c in docs.columns if c not in ("epoch", "block_rank", "weight")]
    key = _digest(seed, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = stored(docs.select(F.col("source").cast("string").alias("source"), _modulo(key, BLOCKS).alias("block"), key.alias("key"),
                               (n_words(F.col("text")) if tokens is None else tokens).alias("tokens")), "sized")
    table = plan(sized, most_passes, least_entropy, seed)
    rows = docs.withColumns({"__key": key, "__block": _modulo(key, BLOCKS)}).alias("d")
    joined = rows.join(table.alias("p"), F.col("d.source").cast("string").eqNullSafe(F.col("p.source")))
    rank = F.col("p.ranks")[F.col("d.__block")]
    return joined.where((rank < F.col("p.whole")) | ((rank == F.col("p.whole")) & (F.col("d.__key") <= F.col("p.cut")))).select(
        *kept, F.col("p.epoch"), rank.alias("block_rank"), F.col("p.weight"))


def mix_documents(docs: DataFrame, most_passes: float = 2.0, seed: int = 17) -> DataFrame:
    """The mix as documents: rows repeated as the weights ask, columns as they are."""
    return mix(docs, most_passes, seed=seed).select(*[F.col(f"`{c}`") for c in docs.columns])
