"""Sums over the terms of each document, of values that depend on the term alone.

The values live in a table with one row per distinct term.  The most frequent terms, a bounded number of bounded length, are
handed to every task and added up at once; all other (document, term, frequency) rows meet the table in a shuffle join, where
no term is frequent enough to be a hot key.  The result is the same as from one join of everything.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Most terms handed to every task, and the longest of them in bytes.
MOST_FREQUENT = 200_000
LONGEST_FREQUENT = 64
#: Distinct terms counted in a task before they are passed on.
FLUSH = 200_000

#: ``split()`` gives, once per task, a function from a text to its terms.
Split = Callable[[], Callable[[str], list[bytes]]]


def count_terms(texts: DataFrame, split: Split) -> DataFrame:
    """(term, occurrences) over the single text column; terms are counted in every task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of, seen = split(), Counter()

        def out():
            part = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                              names=["term", "n"])
            seen.clear()
            return part

        for batch in batches:
            for value in batch.column(0):
                seen.update(terms_of(value.as_py() or ""))
                if len(seen) >= FLUSH:
                    yield out()
        yield out()

    return texts.mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("occurrences"))


def frequent_terms(values: DataFrame, columns: list[str]) -> dict[bytes, tuple]:
    """The most frequent terms with their values: all with at least as many occurrences as lets the bound hold."""
    short = values.where(F.octet_length("term") <= LONGEST_FREQUENT)
    steps = (short.groupBy(F.floor(F.log2("occurrences") * 16).alias("step")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("step")).collect())
    total, least = 0, None
    for row in steps:
        total += row.n
        if total > MOST_FREQUENT:
            break
        least = row.step
    if least is None:
        return {}
    rows = short.where(F.floor(F.log2("occurrences") * 16) >= least).select("term", *columns).collect()
    return {bytes(r[0]): tuple(r[1:]) for r in rows}


def sum_by_document(docs: DataFrame, values: DataFrame, columns: list[str], split: Split,
                    missing: tuple | None = None, more: tuple[list[str], Callable] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_terms, one double sum per value column) for every row of ``docs`` (doc_id long, text string).

    ``values``: stored table of term, occurrences and the value columns; ``missing``: values of a term it lacks (0 each).
    ``more``: names of further double columns, and a function that gives, once per task, a function from texts to rows of
    them.  Null texts count as empty.  Rows with the same id stay apart.
    """
    names, make = more or ([], None)
    missing = tuple(map(float, missing or [0.0] * len(columns)))
    frequent = frequent_terms(values, columns)
    known = docs.sparkSession.sparkContext.broadcast({k: tuple(map(float, v)) for k, v in frequent.items()})
    width = len(columns)
    sums = [*[f"s{i}" for i in range(width)], *names]
    schema = ("doc_id long, row long, n_bytes long, n_terms long, " + "".join(f"{s} double, " for s in sums)
              + "rest array<struct<term: binary, n: long>>")
    target = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_bytes", pa.int64()), ("n_terms", pa.int64()),
                        *[(s, pa.float64()) for s in sums],
                        ("rest", pa.list_(pa.struct([("term", pa.binary()), ("n", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of, table, further = split(), known.value, make and make()
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                out = []
                ids, texts = (c.to_pylist() for c in batch.slice(start, 256).columns)
                added = further(texts) if further else [()] * len(ids)
                for doc_id, text, extra in zip(ids, texts, added):
                    terms = terms_of(text or "")
                    total, rest = [0.0] * width, []
                    for term, n in Counter(terms).items():
                        value = table.get(term)
                        if value is None:
                            rest.append({"term": term, "n": n})
                        else:
                            for i in range(width):
                                total[i] += n * value[i]
                    out.append((doc_id, at, len((text or "").encode()), len(terms), *total, *extra, rest))
                    at += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), target)], schema=target)

    parts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
    # One row per document with what is known, and one per remaining term.  The first has a join key of its own that no term
    # has (terms are not empty), spread over all partitions.
    own = F.struct(F.lit(None).cast("binary").alias("term"), F.lit(0).cast("long").alias("n"))
    long = parts.select("doc_id", "row", "n_bytes", "n_terms", *sums, F.explode(F.concat(F.array(own), "rest")).alias("t"))
    first = F.col("t.term").isNull()
    keyed = long.select("doc_id", "row", *[F.when(first, F.col(c)).alias(c) for c in ("n_bytes", "n_terms", *sums)],
                        F.col("t.n").alias("n"), first.alias("own"),
                        F.coalesce("t.term", F.concat(F.lit(b"\x00row"), F.col("row").cast("string").cast("binary"))).alias("term"))
    table = values.select(F.col("term").alias("__term"), *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    joined = keyed.join(table, F.col("term") == F.col("__term"), "left")
    part = lambda i: F.when(F.col("own"), F.col(f"s{i}")).otherwise(
        F.col("n") * F.coalesce(F.col(f"v{i}"), F.lit(missing[i])))
    return (joined.groupBy("doc_id", "row").agg(F.max("n_bytes").alias("n_bytes"), F.max("n_terms").alias("n_terms"),
                                                *[F.sum(part(i)).alias(columns[i]) for i in range(width)],
                                                *[F.max(c).alias(c) for c in names]).drop("row"))


def store_values(values: DataFrame, label: str) -> DataFrame:
    """The table of values, written once: it is read for the frequent terms and by the join."""
    return stored(values, label)
