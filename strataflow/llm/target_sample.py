"""Importance resampling towards a target collection, with every distinct line worked on once.

Texts are compared by hashed word n-grams (runs of 1 to 3 words).  A line break separates words, so a text is its lines, and its
n-grams are those inside its lines and those that cross from one line into the next.

1. Lines are reduced to their words and counted; lines of the same words are one *segment*.  The buckets of a segment's n-grams
   are computed once, whatever its number of occurrences, and stored.
2. Bucket counts of a collection: those of each segment times its occurrences, plus the crossing n-grams, which tasks count into
   vectors of fixed length.
3. Two collections give a gain per bucket.  A segment's weight is the sum of its gains, again computed once; a document's weight is
   the sum over its segments plus its crossing n-grams.
4. A Gumbel draw: weight plus noise from a hash of the id; the highest scores are drawn, so the sample needs no second pass.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .term_sums import sum_by_document

#: Segments of at most this many bytes are their own name; longer ones are named by a digest.
LONGEST_NAME = 40
#: Segments, and bytes of them, counted in a task before they are passed on.
FLUSH, FLUSH_BYTES = 200_000, 32_000_000
#: Words that segments handed on together have at most, longer segments apart.
WORDS_AT_ONCE = 200_000

#: Letters, digits and everything beyond ASCII make words; A-Z become a-z; all else separates, line breaks stay.
_KEPT = bytes(c + 32 if 65 <= c <= 90 else c if c == 10 or 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Rule:
    """Buckets of n-grams, words of the texts that may be drawn, percent drawn, seed of the noise."""

    buckets: int = 10_000
    least_words: int = 20
    percent: int = 5
    seed: int = 42


def segments(text: str | None) -> list[list[bytes]]:
    """The words of every line that has any."""
    lines = (line.split() for line in (text or "").encode("utf-8", "replace").translate(_KEPT).split(b"\n"))
    return [line for line in lines if line]


def name_of(body: bytes) -> bytes:
    """Name of a segment with its words joined by spaces."""
    return body if len(body) <= LONGEST_NAME else b"\x00" + hashlib.sha256(body).digest()


def buckets_inside(words: list[bytes], buckets: int) -> list[int]:
    """Buckets of all runs of 1 to 3 words; a run's checksum goes on from that of the run without its last word."""
    one = [crc32(w) for w in words]
    tails = [b" " + w for w in words[1:]]
    two = list(map(crc32, tails, one))
    return [c % buckets for c in (*one, *two, *map(crc32, tails[1:], two))]


def buckets_across(lines: list[list[bytes]], buckets: int) -> list[int]:
    """Buckets of the runs of 2 or 3 words that begin in one line and end in a later one."""
    found = []
    for k in range(1, len(lines)):
        before, line = lines[k - 1], lines[k]
        # The run that began one line earlier: its middle word is a line of its own.
        if len(before) == 1 and k > 1:
            found.append(crc32(b" ".join((lines[k - 2][-1], before[0], line[0]))))
        elif len(before) > 1:
            found.append(crc32(b" ".join((before[-2], before[-1], line[0]))))
        pair = crc32(b" " + line[0], crc32(before[-1]))
        found.append(pair)
        if len(line) > 1:
            found.append(crc32(b" " + line[1], pair))
    return [c % buckets for c in found]


def _vector_rows(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])


def count_segments(texts: DataFrame) -> DataFrame:
    """(term, body, occurrences) of the distinct segments of the single text column; tasks count first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size = Counter(), 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(map(name_of, seen)), pa.binary()), pa.array(list(seen), pa.binary()),
                                               pa.array(list(seen.values()), pa.int64())], names=["term", "body", "n"])

        for batch in batches:
            for value in batch.column(0):
                for line in segments(value.as_py()):
                    body = b" ".join(line)
                    if body not in seen:
                        size += len(body)
                    seen[body] += 1
                    if len(seen) >= FLUSH or size >= FLUSH_BYTES:
                        yield out()
                        seen, size = Counter(), 0
        yield out()

    # The body follows from the name, so grouping by both makes the same groups and keeps partial sums.
    return texts.mapInArrow(run, "term binary, body binary, n long").groupBy("term", "body").agg(F.sum("n").alias("occurrences"))


def segment_buckets(texts: DataFrame, rule: Rule) -> DataFrame:
    """Stored table (term, occurrences, buckets) of the distinct segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())

        def out(terms, counts, found):
            return pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), pa.array(counts, pa.int64()), pa.array(found, kind)],
                                              names=["term", "occurrences", "buckets"])

        for batch in batches:
            terms, counts, found, words = [], [], [], 0
            for term, body, n in zip(*batch.columns):
                line = body.as_py().split(b" ")
                terms.append(term.as_py())
                counts.append(n.as_py())
                found.append(np.array(buckets_inside(line, rule.buckets), np.int32))
                words += len(line)
                if words >= WORDS_AT_ONCE:
                    yield out(terms, counts, found)
                    terms, counts, found, words = [], [], [], 0
            yield out(terms, counts, found)

    return stored(count_segments(texts).select("term", "body", "occurrences")
                  .mapInArrow(run, "term binary, occurrences long, buckets array<int>"), "segments")


def bucket_counts(texts: DataFrame, known: DataFrame, rule: Rule) -> np.ndarray:
    """N-grams per bucket of a collection, from its texts and their segments; at most ``rule.buckets`` numbers reach the driver."""
    size = rule.buckets

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            lists = batch.column(1)
            times = np.repeat(batch.column(0).to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False))
            np.add.at(total, lists.flatten().to_numpy(), times)
        yield _vector_rows(total)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            found: list[int] = []
            for value in batch.column(0):
                found += buckets_across(segments(value.as_py()), size)
                if len(found) >= WORDS_AT_ONCE:
                    total += np.bincount(found, minlength=size)
                    found = []
            if found:
                total += np.bincount(found, minlength=size)
        yield _vector_rows(total)

    rows = known.select("occurrences", "buckets").mapInArrow(inside, "bucket long, n long").union(
        texts.mapInArrow(across, "bucket long, n long"))
    counts = np.zeros(size, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of every bucket: thousandths of the log ratio of smoothed shares, rounded down."""
    size, all_s, all_t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1.0) * (all_s + size)) / ((s + 1.0) * (all_t + size))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, known: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, weight) of every row of ``docs`` (doc_id, text)."""
    size = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            total = np.concatenate([[0], np.cumsum(gains[lists.flatten().to_numpy()])])
            value = total[ends] - np.concatenate([[0], total[ends[:-1]]]) if len(ends) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value.astype(np.int64))],
                                             names=["term", "occurrences", "weight"])

    values = stored(known.select("term", "occurrences", "buckets").mapInArrow(weigh, "term binary, occurrences long, weight long"), "weights")

    def split() -> Callable[[str], list[bytes]]:
        return lambda text: [name_of(b" ".join(line)) for line in segments(text)]

    def further() -> Callable[[list], list[tuple]]:
        def measure(texts: list) -> list[tuple]:
            out = []
            for text in texts:
                lines = segments(text)
                out.append((float(sum(map(len, lines))), float(gains[buckets_across(lines, size)].sum() if len(lines) > 1 else 0)))
            return out
        return measure

    sums = sum_by_document(docs.select("doc_id", "text"), values, ["weight"], split, more=(["n_words", "crossing"], further))
    # Sums of whole numbers far below 2 ** 53 are exact in doubles.
    return sums.select("doc_id", F.col("n_words").cast("long").alias("n_words"),
                       (F.col("weight") + F.col("crossing")).cast("long").alias("weight"))


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from 32 bits of a digest of seed and id; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Rows numbered from 1 in a total order, without one task for all: ranges are sorted and numbered, then moved by what is before them."""
    schema = rows.schema

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 1
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(at, at + batch.num_rows))],
                                             names=[*batch.schema.names, "__local"])
            at += batch.num_rows

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    local = stored(ordered.mapInArrow(number, f"{fields}, __part int, __local long"), "ranges")
    sizes = {r["__part"]: r["n"] for r in local.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(sizes):
        before[part], total = total, total + sizes[part]
    if not before:
        return local.select(*schema.names, F.lit(None).cast("long").alias(name))
    moved = F.broadcast(rows.sparkSession.createDataFrame(list(before.items()), "__of int, __before long"))  # a row per partition
    return local.join(moved, F.col("__part") == F.col("__of")).select(
        *[F.col(f"`{c}`") for c in schema.names], (F.col("__local") + F.col("__before")).alias(name))


def resample(docs: DataFrame, target: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null where not drawn) of every row of ``docs`` (doc_id, text), towards ``target`` (text).

    Null and empty texts have no features and weight 0; they are never drawn.  Repeated rows are rows of their own and all may be
    drawn; ties go to the smaller id, a null id last.  An empty target, or empty documents, only leave the smoothing in the gains.
    Other columns are ignored.
    """
    texts = docs.select(F.col("text").cast("string").alias("text"))
    goals = target.select(F.col("text").cast("string").alias("text"))
    known = segment_buckets(texts, rule)
    gains = bucket_gains(bucket_counts(texts, known, rule), bucket_counts(goals, segment_buckets(goals, rule), rule))
    n = F.col("n_words")
    scored = stored(weights(docs, known, gains).select(
        "doc_id", "n_words", (n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))).alias("n_features"), "weight",
        (F.col("weight") + noise(F.col("doc_id"), rule.seed)).alias("score")), "scored")
    fit = scored.where(n >= rule.least_words)
    drawn = rule.percent * fit.count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    # The last column only tells equal rows apart.
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("same")]
    first = ranked(fit.select(*columns, F.monotonically_increasing_id().alias("same")), order)
    rest = scored.where(n < rule.least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return first.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).union(rest)


def drawn_texts(docs: DataFrame, target: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns, by id; ids must be unique and not null."""
    chosen = resample(docs, target, rule).where("rank IS NOT NULL").select(F.col("doc_id").alias("__drawn"))
    return docs.join(chosen, F.col("doc_id") == F.col("__drawn"), "left_semi")
