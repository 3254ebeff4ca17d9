"""Near-duplicate embeddings: a subspace pigeonhole join.

Unit vectors with a cosine of at least c are at most 2 - 2c apart (squared).  Rotated by a fixed random matrix and split into
blocks of few dimensions, two such vectors are within the proportional part of that distance in at least one block.  So each
block is a range join under its budget, and the union of its candidates is verified exactly.

The range join of a block cuts its first coordinate into cells as wide as the budget reaches; a pair within it lies in one
cell or in two neighbouring ones.  Cells with many vectors are cut into chunks, and each pair of chunks is a task group of
bounded size.  A pair is taken up in the first block that admits it and nowhere else, so nothing has to be deduplicated, and
a group gives back one count and one tree edge per vector at most: copies are never spelled out as pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components

#: Dimensions per block.
BLOCK = 8
#: Vectors per chunk of a cell.
CHUNK = 1_500
#: Added to squared-distance budgets for rounding.
SLACK = 1e-9


def rotation(size: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def block_bounds(size: int) -> list[tuple[int, int]]:
    return [(a, min(size, a + BLOCK)) for a in range(0, size, BLOCK)]


def _valid(vectors: DataFrame) -> DataFrame:
    """Rows that can link: label and vector given, all components finite, not all zero."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull())
            .select("row", "vec_id", "label", v.alias("v")).where((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))
            .withColumn("size", F.size("v")))


def _cells(vectors: DataFrame, least: float) -> DataFrame:
    """One row per vector and block: (row, label, size, block, cell, x), x the vector as doubles.

    The cell is that of the block's first coordinate after rotation of the unit vector.
    """
    def run(batches):
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            out = []
            for row, label, size, v in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.array(v)
                if size not in turns:
                    turns[size] = rotation(size)
                # Scaled first, so that squares neither overflow nor vanish.
                unit = x / np.abs(x).max()
                z = (unit / np.linalg.norm(unit)) @ turns[size]
                for block, (a, b) in enumerate(block_bounds(size)):
                    reach = math.sqrt((2 - 2 * least) * (b - a) / size + SLACK)
                    out.append((row, label, size, block, int(math.floor(z[a] / reach)), x.tobytes()))
            names = ["row", "label", "size", "block", "cell", "x"]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, kinds)], names=names)

    return vectors.select("row", "label", "size", "v").mapInArrow(
        run, "row long, label string, size int, block int, cell long, x binary")


def _linked(group: pa.Table, least: float) -> pa.Table:
    """Links of one pair of chunks: per vector their number, and the root of its tree inside the group."""
    row = group.column("row").to_numpy()
    order = np.argsort(row, kind="stable")
    row, side = row[order], group.column("side").to_numpy()[order]
    size, block = group.column("size")[0].as_py(), group.column("block")[0].as_py()
    x = np.frombuffer(b"".join(group.column("x")[int(i)].as_py() for i in order)).reshape(len(row), size)
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    norm = np.linalg.norm(unit, axis=1, keepdims=True)
    z = (unit / norm) @ rotation(size)
    within = group.column("within")[0].as_py()
    bounds = block_bounds(size)
    budget = [(2 - 2 * least) * (b - a) / size + SLACK for a, b in bounds]
    a, b = bounds[block]
    left = np.arange(len(row)) if within else np.flatnonzero(side == 0)
    right = left if within else np.flatnonzero(side == 1)
    links, label = np.zeros(len(row), np.int64), np.arange(len(row))
    zr = z[right, a:b]
    square = (zr * zr).sum(axis=1)
    for start in range(0, len(left), 256):
        part = left[start:start + 256]
        zl = z[part, a:b]
        near = (zl * zl).sum(axis=1)[:, None] + square - 2 * zl @ zr.T <= budget[block] + SLACK
        i, j = np.nonzero(near)
        i, j = part[i], right[j]
        if within:
            i, j = i[i < j], j[i < j]
        for first in range(0, len(i), 100_000):
            p, q = i[first:first + 100_000], j[first:first + 100_000]
            # Exactly by cosine, and only where no earlier block has admitted the pair.
            cosine = np.einsum("ij,ij->i", unit[p], unit[q]) / (norm[p, 0] * norm[q, 0])
            keep = cosine >= least
            p, q = p[keep], q[keep]
            for (c, d), limit in zip(bounds[:block], budget):
                fresh = ((z[p, c:d] - z[q, c:d]) ** 2).sum(axis=1) > limit + SLACK
                p, q = p[fresh], q[fresh]
            links += np.bincount(p, minlength=len(row)) + np.bincount(q, minlength=len(row))
            # Trees: smaller labels win until nothing changes.
            while True:
                least_of = np.minimum(label[p], label[q])
                before = label.copy()
                np.minimum.at(label, p, least_of)
                np.minimum.at(label, q, least_of)
                label = label[label]
                if (label == before).all():
                    break
    hit = np.flatnonzero(links)
    return pa.table({"row": row[hit], "links": links[hit], "root": row[label[hit]]})


def near_vectors(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding, label).

    Rows with equal labels link at a cosine of at least ``least``; null labels or vectors, zero vectors and those with a
    null or non-finite component link with nothing, nor do vectors of different lengths.  Labels of any type are compared as
    text.  Repeated rows are vectors of their own (an id linked with itself counts).  A row's component is the smallest id
    reachable, null if all ids there are null; a row with a null id is linked like others and never ``kept``.  Other columns
    are ignored.
    """
    # Rows are told apart by a number of their own.
    numbered = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label"))
                      .withColumn("row", F.monotonically_increasing_id()), "vectors")
    cells = stored(_cells(_valid(numbered), least), "cells")
    counts = cells.groupBy("label", "size", "block", "cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    counts = stored(counts, "cell_counts")
    # What a cell is joined with: itself, and the next one if there is one.
    key = ["label", "size", "block"]
    after = counts.select(*key, (F.col("cell") - 1).alias("cell"), F.col("chunks").alias("next"))
    before = counts.select(*key, (F.col("cell") + 1).alias("cell"), F.col("chunks").alias("previous"))
    around = stored(counts.join(after, [*key, "cell"], "left").join(before, [*key, "cell"], "left"), "cells_around")
    dealt = cells.join(around, [*key, "cell"]).withColumn("part", F.pmod(F.xxhash64("row"), "chunks").cast("int"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    part, cell = F.col("part"), F.col("cell")
    goal = lambda lower, left, right, side, within: F.struct(
        lower.alias("lower"), left.alias("left"), right.alias("right"), side.alias("side"), within.alias("within"))
    none = F.array().cast("array<struct<lower:bigint,left:int,right:int,side:int,within:int>>")
    # within: 1 inside a chunk, 2 two chunks of a cell, 0 two neighbouring cells.
    inside = F.transform(upto(F.col("chunks")), lambda o: goal(
        cell, F.least(part, o), F.greatest(part, o), F.when(part <= o, F.lit(0)).otherwise(F.lit(1)),
        F.when(part == o, F.lit(1)).otherwise(F.lit(2))))
    up = F.when(F.col("next").isNotNull(), F.transform(upto(F.col("next")), lambda o: goal(cell, part, o, F.lit(0), F.lit(0)))).otherwise(none)
    down = F.when(F.col("previous").isNotNull(), F.transform(upto(F.col("previous")), lambda o: goal(
        cell - 1, o, part, F.lit(1), F.lit(0)))).otherwise(none)
    sent = dealt.select("row", *key, "x", F.explode(F.concat(inside, up, down)).alias("g"))
    sent = sent.select("row", *key, "x", "g.lower", "g.left", "g.right", "g.side", "g.within")

    def work(group: pa.Table) -> pa.Table:
        return _linked(group.set_column(group.schema.get_field_index("within"), "within", pa.array(
            [w == 1 for w in group.column("within").to_pylist()], pa.bool_())), least)

    found = stored(sent.groupBy(*key, "lower", "left", "right", "within").applyInArrow(lambda t: work(t), "row long, links long, root long"),
                   "links")
    links = found.groupBy("row").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("row").alias("a"), F.col("root").alias("b")))
    tree = stored(numbered.select("row", "vec_id").join(links, "row", "left").join(roots.select(F.col("node").alias("row"), "root"), "row", "left")
                  .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "row").alias("root")), "tree")
    least_id = stored(tree.groupBy("root").agg(F.min("vec_id").alias("component_id")), "least")
    return tree.join(least_id, "root").select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
