"""Grouped prefix join: documents whose sets of word n-grams have a Jaccard similarity of at least a threshold.

Two sets with a similarity of 0.9 share one of the first tenth of their tokens, in any order common to all (prefix filter).  The order
used puts tokens that many documents share last, so that shared passages do not make candidates.

1. Prefix tokens that no other document has in its prefix are left out by a bounded bitmap, before anything of the sets is
   shuffled.  Equal sets are collapsed, then sets with the same prefix and size form one group.
2. Groups that share a prefix token meet in a bucket; buckets with one set only are dropped at once, and of buckets with the
   same groups one is kept.
3. The groups of a bucket are expanded to their sets.  Pairs are filtered by size, by position, and by the parity bits of the
   sets: the number of different bits bounds the symmetric difference from below.  No similar pair is lost.
4. What is wanted are connected documents, so a bucket first hands on one candidate pair for each of its sets.  Those are
   verified against the whole sets.  Then it hands on a spanning forest of the candidate pairs that verified links have not
   connected, and at last every candidate pair that is still not connected.  So a bucket of n copies costs about n
   verifications, not n * n.  Sketches of the sets, two parity bits a token, are compared first; whole sets travel for what
   these leave.

Buckets of tokens above a size are cut into chunks, and every pair of chunks is a bucket of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored
from .components import components

#: Tokens told apart as common, most of them; their number bounds what tasks are handed.
COMMON = 100_000
#: Tokens a task counts at once, and the least count it passes on.
COUNTED, LEAST = 4_000_000, 2
#: Bits of the marks of shared prefix tokens (at least 32 a part), and parts they are made in.  More tokens than this bitmap
#: can tell apart cost rows of a shuffle, not results.
MARKS, PARTS = 1 << 27, 256
#: Sets per chunk of a bucket, and tokens of all of them.
CHUNK = 2_048
CHUNK_TOKENS = 2_000_000
#: Parity bits per set.
BITS = 512
#: Most set ids handed to all tasks to pick documents by; with more, the tables are joined by a shuffle.
MOST_PICKED = 500_000

@dataclass(frozen=True)
class Rule:
    """Words per shingle, and the least similarity as a fraction."""

    words: int = 3
    above: int = 9
    below: int = 10

    def prefix_length(self, n: int) -> int:
        """Tokens of which two similar sets must share one."""
        return n - -(-self.above * n // self.below) + 1

    def enough(self, shared, sizes):
        """Whether sets of so many tokens together that share so many are similar (numbers or arrays)."""
        return (self.above + self.below) * shared >= self.above * sizes


_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit tokens of a text: its word n-grams, or its whole sequence if it has fewer words."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < size:
        return np.array([xxhash.xxh3_64_intdigest(b"\x00".join([b"short", *found]))], np.uint64)
    # Hashing a word again is cheaper than looking it up in a table larger than the processor's cache.
    w = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, found)), np.uint64)
    tokens = w[:len(w) - size + 1]
    for k in range(1, size):
        tokens = _mix(tokens * _M1 + w[k:len(w) - size + 1 + k])
    tokens.sort()
    keep = np.ones(len(tokens), bool)
    np.not_equal(tokens[1:], tokens[:-1], out=keep[1:])
    return tokens[keep]


def common_tokens(docs: DataFrame, rule: Rule) -> np.ndarray:
    """The most common tokens, rarest first, by counts over all documents (a task passes on what it has seen at least twice)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, int))
            tokens, counts = tokens[counts >= LEAST], counts[counts >= LEAST]
            return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts.astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for value in batch.column(0):
                tokens = shingles(value.as_py(), rule.words)
                held.append(tokens)
                size += len(tokens)
                if size >= COUNTED:
                    yield out()
                    held, size = [], 0
        yield out()

    counts = stored(docs.select(F.col("text").cast("string")).mapInArrow(run, "token long, n long")
                    .groupBy("token").agg(F.sum("n").alias("n")), "token_counts")
    step = F.floor(F.log2("n") * 16)
    total, least = 0, None
    for row in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("step")).collect():
        total += row.k
        if total > COMMON:
            break
        least = row.step
    if least is None:
        return np.zeros(0, np.uint64)
    rows = counts.where(step >= least).select("token", "n").collect()
    rows.sort(key=lambda r: (r.n, r.token))
    return np.array([r.token for r in rows], np.int64).view(np.uint64)


def signatures(docs: DataFrame, common: np.ndarray, rule: Rule) -> DataFrame:
    """doc_id, key, n (size of the set), print (128-bit digest of the set, null if empty), prefix (ordered tokens), bits of every row."""
    spark = docs.sparkSession
    order = np.argsort(common, kind="stable")
    handed = spark.sparkContext.broadcast((common[order], (order + 1).astype(np.int64)))
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("print", pa.binary()), ("prefix", pa.list_(pa.int64())), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, ranks = handed.value
        for batch in batches:
            out = []
            for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                tokens = shingles(text.as_py(), rule.words)
                if not len(tokens):
                    out.append((doc_id, key, 0, None, None, None))
                    continue
                rank = np.zeros(len(tokens), np.int64)
                if len(values):
                    at = np.minimum(np.searchsorted(values, tokens), len(values) - 1)
                    rank = np.where(values[at] == tokens, ranks[at], 0)
                first = tokens[np.argsort(rank, kind="stable")[:rule.prefix_length(len(tokens))]]
                odd = np.bincount((tokens >> np.uint64(40)).astype(np.int64) % BITS, minlength=BITS) & 1
                out.append((doc_id, key, len(tokens), hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(),
                            first.view(np.int64).tolist(), np.packbits(odd.astype(np.uint8)).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else
                                             [pa.array([], f.type) for f in schema], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), _text_key().alias("key"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, key binary, n long, print binary, prefix array<long>, bits binary")


def _slots(tokens: np.ndarray) -> np.ndarray:
    """32 bits of each token.  Prefix tokens are the smallest of their sets, so that they are mixed again."""
    return (_mix(tokens.view(np.uint64) * _M1) >> np.uint64(32)).astype(np.uint32)


def shared_marks(signed: DataFrame) -> np.ndarray:
    """Bitmap of the slots of prefix tokens that at least two rows of ``signed`` have; a few others are marked, too.

    Slots travel packed, a task's slots of a part in one row, each slot twice at most; every part of the bitmap is made by one
    task, and only the bitmap comes to the driver.
    """
    bits, parts = MARKS, PARTS
    fold = np.uint32(32 - (bits - 1).bit_length())
    step = (1 << 32) // parts  # slots of a part

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            slots = np.sort(np.concatenate([np.zeros(0, np.uint32), *held]))
            more = np.ones(len(slots), bool)
            more[2:] = slots[2:] != slots[:-2]
            slots = slots[more]
            ends = [0, *np.searchsorted(slots, np.arange(1, parts, dtype=np.uint64) * np.uint64(step)).tolist(), len(slots)]
            some = [k for k in range(parts) if ends[k] < ends[k + 1]]
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([slots[ends[k]:ends[k + 1]].tobytes() for k in some], pa.binary())],
                                              names=["part", "slots"])

        for batch in batches:
            held.append(_slots(batch.column(0).flatten().to_numpy()))
            size += len(held[-1])
            if size >= COUNTED:
                yield out()
                held, size = [], 0
        yield out()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def out() -> pa.RecordBatch:
            slots = np.sort(np.concatenate(held))
            twice = slots[1:][slots[1:] == slots[:-1]] - np.uint32(at * step)
            marked = np.zeros(bits // parts, np.uint8)
            marked[twice >> fold] = 1
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(marked).tobytes()], pa.binary())],
                                              names=["part", "marks"])

        for batch in batches:
            for part, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != at:
                    if held:
                        yield out()
                    at, held = part, []
                held.append(np.frombuffer(body.as_py(), np.uint32))
        if held:
            yield out()

    sent = signed.where("n > 0").select("prefix").mapInArrow(send, "part int, slots binary")
    made = sent.repartition("part").sortWithinPartitions("part").mapInArrow(mark, "part int, marks binary")
    marks = np.zeros((parts, bits // parts // 8), np.uint8)
    for row in made.collect():
        marks[row.part] = np.frombuffer(row.marks, np.uint8)
    return marks.ravel()


def with_shared(signed: DataFrame, marks: np.ndarray) -> DataFrame:
    """The rows of ``signed`` that have a set, with the shared tokens of their prefixes (arrays pos and token) and their groups.

    A group are the sets with the same prefix and size, named by a digest of both.  Sets that share no prefix token have no
    partner, so that nothing but their size is kept.
    """
    handed = signed.sparkSession.sparkContext.broadcast(marks)
    fold = np.uint32(32 - (8 * len(marks) - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = handed.value
        for batch in batches:
            prefix, n = batch.column(4), batch.column(2).to_pylist()
            tokens, ends = prefix.flatten().to_numpy(), np.concatenate([[0], np.cumsum(prefix.value_lengths().to_numpy())])
            bit = _slots(tokens) >> fold
            shared = (known[bit >> np.uint32(3)] >> (np.uint32(7) - (bit & np.uint32(7))) & 1).astype(bool)
            many = np.concatenate([[0], np.cumsum(shared)])[ends]
            pos = np.arange(len(tokens)) - np.repeat(ends[:-1], np.diff(ends))
            some = np.diff(many) > 0
            groups = [hashlib.blake2b(tokens[ends[k]:ends[k + 1]].tobytes(), digest_size=16, salt=n[k].to_bytes(8, "little")).digest() if some[k] else None
                      for k in range(len(n))]
            bits = pa.compute.if_else(pa.array(some), batch.column(5), pa.scalar(None, pa.binary()))
            lists = (pa.ListArray.from_arrays(pa.array(many, pa.int32()), pa.array(v[shared], t)) for v, t in ((pos, pa.int32()), (tokens, pa.int64())))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(groups, pa.binary()), *lists, bits],
                                             names=["doc_id", "key", "n", "print", "group", "pos", "token", "bits"])

    return signed.where("n > 0").select("doc_id", "key", "n", "print", "prefix", "bits").mapInArrow(
        run, "doc_id long, key binary, n long, print binary, group binary, pos array<int>, token array<long>, bits binary")


def _text_key() -> Column:
    """Digest of a text.  With the id, which may be null or repeat, it tells rows apart but for those equal in both."""
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def _first_row() -> Column:
    """The (doc_id, key) with the smallest id; a null id only where there is no other."""
    row = F.struct("doc_id", "key")
    return F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), row)), F.min(row))


def _same_row(id_: str, key: str) -> Column:
    return F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col("key") == F.col(key))


def _buckets(groups: DataFrame, rule: Rule) -> DataFrame:
    """(token, group, pos): the groups that share a prefix token, once for tokens with the same groups, and groups with several sets."""
    rows = groups.select("group", "sets", "n", F.inline(F.arrays_zip("pos", "token")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(several, _runs(batches, 1))

    def several(part: pa.RecordBatch) -> pa.RecordBatch:
        tokens, n = part.column(0).to_numpy(), part.column(4).to_numpy()
        # Rows of a token come by size: a group without a neighbour of fitting size has no partner here.
        near = (tokens[1:] == tokens[:-1]) & (rule.below * n[:-1] >= rule.above * n[1:])
        keep = (part.column(3).to_numpy() > 1) & (part.column(2).to_numpy() == 0)
        keep[1:] |= near
        keep[:-1] |= near
        part = part.filter(pa.array(keep))
        tokens = tokens[keep]
        begins = np.ones(len(tokens), bool)
        begins[1:] = tokens[1:] != tokens[:-1]
        start = np.flatnonzero(begins)
        run = np.cumsum(begins) - 1
        # A bucket is named by a sum over its groups, so that tokens with the same groups make one bucket.
        if not len(tokens):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), part.column(1), part.column(2)], names=["token", "group", "pos"])
        halves = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint64).reshape(-1, 2)
        name = np.add.reduceat(_mix(halves[:, 0] * _M1 + halves[:, 1]), start)[run]
        return pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), part.column(1), part.column(2)], names=["token", "group", "pos"])

    shared = (rows.select("token", "group", "pos", "sets", "n").repartition("token").sortWithinPartitions("token", "n")
              .mapInArrow(run, "token long, group binary, pos int"))
    # The earliest place counts: it bounds what two groups may share from there on.
    return shared.groupBy("token", "group").agg(F.min("pos").alias("pos"))


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Parts of sorted input that hold whole runs of equal first ``keys`` columns (whole numbers)."""
    last: pa.RecordBatch | None = None
    for batch in batches:
        whole = batch if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
        if not whole.num_rows:
            continue
        same = np.ones(whole.num_rows, bool)
        for k in range(keys):
            column = whole.column(k).to_numpy()
            same &= column == column[-1]
        end = whole.num_rows - int(same[::-1].argmin()) if not same.all() else 0
        last = whole.slice(end)
        if end:
            yield whole.slice(0, end)
    if last is not None and last.num_rows:
        yield last


def _spanning(i: np.ndarray, j: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Places of pairs that connect all that the pairs (i, j) connect, without a circle.  ``labels``: the part each row is
    in, named by numbers below its length; parts that become one get one label."""
    chosen, left = [], np.flatnonzero(labels[i] != labels[j])
    while len(left):
        # The first pair of each part; then what is still apart.
        tried = left[np.unique(labels[i[left]], return_index=True)[1]]
        above = np.arange(len(labels))
        for at, x, y in zip(tried.tolist(), labels[i[tried]].tolist(), labels[j[tried]].tolist()):
            while above[x] != x:
                above[x] = x = above[above[x]]
            while above[y] != y:
                above[y] = y = above[above[y]]
            if x != y:
                above[max(x, y)] = min(x, y)
                chosen.append(at)
        while (above[above] != above).any():
            above = above[above]
        labels[:] = above[labels]
        left = left[labels[i[left]] != labels[j[left]]]
    return np.array(sorted(chosen), np.int64)


def _pairs_of(part: pa.RecordBatch, pick: str, rule: Rule) -> pa.RecordBatch:
    """Candidate pairs of whole buckets (token, left, right, part, n, pos, print, root, bits; sorted by print in a bucket).

    ``pick``: "first", each set with the one before it that fits best (buckets with the same sets choose alike); "tree", pairs
    that connect all roots that candidate pairs connect, without a circle, those that fit best first; "all".  The first two
    are a linear number.  ``far``: different bits in a thousand tokens of both sets.
    """
    token, left, right, chunk, n, pos = (part.column(k).to_numpy() for k in range(6))
    prints = part.column(6)
    roots = np.frombuffer(b"".join(part.column(7).to_pylist()), np.uint64).reshape(len(n), 2)
    bits = np.frombuffer(b"".join(part.column(8).to_pylist()), np.uint64).reshape(len(n), -1)
    begins = np.ones(len(n), bool)
    begins[1:] = (token[1:] != token[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    start = np.maximum.accumulate(np.where(begins, np.arange(len(n)), 0))
    before = np.arange(len(n)) - start  # sets of the bucket that come before
    labels = np.unique(np.column_stack([start.astype(np.uint64), roots]), axis=0, return_inverse=True)[1].ravel() if pick == "tree" else None
    many = np.cumsum(before)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(n):
        # As many sets at a time as have about a million pairs.
        end = max(at + 1, int(np.searchsorted(many, (many[at - 1] if at else 0) + 1_000_000, side="right")))
        i = np.repeat(np.arange(at, end), before[at:end])
        j = start[i] + np.arange(len(i)) - np.repeat(np.cumsum(before[at:end]) - before[at:end], before[at:end])
        at = end
        keep = (rule.below * np.minimum(n[i], n[j]) >= rule.above * np.maximum(n[i], n[j])) & (roots[i] != roots[j]).any(axis=1)
        keep &= rule.enough(np.minimum(n[i] - pos[i], n[j] - pos[j]), n[i] + n[j])
        keep &= (left[i] == right[i]) | (chunk[i] != chunk[j])
        i, j = i[keep], j[keep]
        apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
        keep = rule.enough((n[i] + n[j] - apart) / 2, n[i] + n[j])
        i, j, far = i[keep], j[keep], (1000 * apart[keep] // (n[i[keep]] + n[j[keep]])).astype(np.int32)
        if pick != "all":
            order = np.lexsort((j, i, far))
            i, j, far = i[order], j[order], far[order]
            some = np.unique(i, return_index=True)[1] if pick == "first" else _spanning(i, j, labels)
            i, j, far = i[some], j[some], far[some]
        found.append((i, j, far))
    one, two, far = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int32) for k in (1, 0, 2))
    places = [part.column(k).take(pa.array(one)) for k in range(3)]
    return pa.RecordBatch.from_arrays([prints.take(pa.array(one)), prints.take(pa.array(two)), *places, pa.array(far, pa.int32())],
                                      names=["a", "b", "token", "left", "right", "far"])


def _candidates(members: DataFrame, roots: DataFrame | None, pick: str, rule: Rule) -> DataFrame:
    """Candidate pairs (a, b) of the sets of all buckets, and the bucket and chunks (token, left, right) where they meet: one for
    each set ("first"), or of those not connected yet all, each once ("all"), or a spanning forest in each bucket ("tree")."""
    # Chunks are bounded in sets and in tokens, as whole sets meet in them later.
    size = [F.ceil(F.greatest(F.count(F.lit(1)) / CHUNK, F.sum("n") / CHUNK_TOKENS)).cast("int").alias("chunks")]
    if roots is None:
        rows = members.withColumn("root", F.col("print"))
        large = stored(rows.groupBy("token").agg(*size).where(F.col("chunks") > 1), "large")
        # Most often no bucket is large, and there is nothing to join.
        dealt = rows.withColumn("chunks", F.lit(1)) if large.isEmpty() else rows.join(large, "token", "left")
    else:
        rows = members.join(roots.select(F.col("node").alias("print"), "root"), "print", "left").withColumn("root", F.coalesce("root", "print"))
        open_ = rows.groupBy("token").agg(*size, F.min("root").alias("least"), F.max("root").alias("most"))
        dealt = rows.join(open_.where("least < most").select("token", "chunks"), "token")
    dealt = dealt.withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("print"), "chunks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.select("*", other.alias("other")).withColumns({"left": F.least("part", "other"), "right": F.greatest("part", "other")})
    columns = ["token", "left", "right", "part", "n", "pos", "print", "root", "bits"]
    sorted_ = dealt.select(*columns).repartition("token", "left", "right").sortWithinPartitions("token", "left", "right", "print")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _runs(batches, 3):
            yield _pairs_of(part, pick, rule)

    found = sorted_.mapInArrow(run, "a binary, b binary, token long, left int, right int, far int")
    found = found.select("a", "b", F.struct("token", "left", "right").alias("place"), "far")
    # At first, the best partner for each set from all its buckets.
    if pick == "first":
        return found.groupBy("b").agg(F.min(F.struct("far", "a", "place")).alias("m")).select("m.a", "b", "m.place.*")
    found = found.select("a", "b", "place.*")
    return found if pick == "tree" else _once(found)


def _once(pairs: DataFrame) -> DataFrame:
    """Every pair once, in the least of its buckets."""
    return pairs.groupBy("a", "b").agg(F.min(F.struct("token", "left", "right")).alias("place")).select("a", "b", "place.*")


def _sketch(tokens: np.ndarray) -> bytes:
    """The size of a set and its parity bits, at least two for each token; a longer sketch folds to a shorter one."""
    many = max(BITS, 1 << (2 * len(tokens) - 1).bit_length())
    odd = np.bincount(((tokens >> np.uint64(8)) & np.uint64(many - 1)).astype(np.int64), minlength=many) & 1
    return np.uint64(len(tokens)).tobytes() + np.packbits(odd.astype(np.uint8)).tobytes()


def _may_be_similar(one: bytes, two: bytes, rule: Rule) -> bool:
    """False only for sets that are not similar: different parity bits bound the symmetric difference from below."""
    (n, s), (m, t) = ((int.from_bytes(x[:8], "little"), np.frombuffer(x, np.uint8, offset=8)) for x in (one, two))
    while len(s) != len(t):
        if len(s) < len(t):
            s, t = t, s
        s = s[:len(s) // 2] ^ s[len(s) // 2:]
    return bool(rule.enough((n + m - int(np.bitwise_count(s ^ t).sum(dtype=np.int64))) / 2, n + m))


def _similar(one: bytes, two: bytes, rule: Rule) -> bool:
    s, t = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
    return bool(rule.enough(_shared(s, t), len(s) + len(t)))


def _verified(pairs: DataFrame, forest: bool, docs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) of similar whole sets that connect all that the similar ones among ``pairs`` connect.

    Sketches of the sets leave few false pairs.  Of the rest, one pair for each set is compared by the whole sets; then
    every pair that these do not connect (with ``forest`` there is one only).  So whole sets travel about as often as there
    are sets, not pairs.
    """
    left = _decided(pairs, docs, sets, rule, True)
    if forest:
        return _decided(left, docs, sets, rule, False).select("a", "b")
    if left.isEmpty():
        return left.select("a", "b")
    some = left.groupBy("b").agg(F.min(F.struct("a", "token", "left", "right")).alias("m")).select("m.a", "b", "m.token", "m.left", "m.right")
    links = _decided(some, docs, sets, rule, False).select("a", "b")
    roots = components(links)
    of = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
    apart = ~F.coalesce("root_a", "a").eqNullSafe(F.coalesce("root_b", "b"))
    rest = stored(left.join(some.select("a", "b"), ["a", "b"], "left_anti").join(of("a"), "a", "left").join(of("b"), "b", "left")
                  .where(apart).select("a", "b", "token", "left", "right"), "rest")
    return links if rest.isEmpty() else links.union(_decided(rest, docs, sets, rule, False).select("a", "b"))


def _decided(pairs: DataFrame, docs: DataFrame, sets: DataFrame, rule: Rule, sketched: bool) -> DataFrame:
    """The pairs (a, b, token, left, right) whose whole sets are similar; with ``sketched``, whose sketches do not exclude it.

    Sets are made again from the texts of the documents concerned.  Each is sent once to every bucket chunk where it has pairs,
    whatever their number, and the pairs of the chunk follow it there.
    """
    pairs, place = stored(pairs, "pairs"), ["token", "left", "right"]
    roles = pairs.select(F.explode(F.array("a", "b")).alias("print"), *place).distinct()
    wanted = stored(roles.join(sets.select("print", "doc_id", "key"), "print"), "wanted")
    few = wanted.count() <= MOST_PICKED
    picks, roles = wanted.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct(), wanted.drop("doc_id", "key")
    if few:
        picks, roles = F.broadcast(picks), F.broadcast(roles)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()  # rows equal in id and text give their set once a task
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                fresh = []
                for key, text in zip(batch.column(0).slice(start, 64).to_pylist(), batch.column(1).slice(start, 64)):
                    if key not in done:
                        done.add(key)
                        fresh.append(text)
                found = [shingles(t.as_py(), rule.words) for t in fresh]
                prints = [hashlib.blake2b(t.tobytes(), digest_size=16).digest() for t in found]
                bodies = [_sketch(t) if sketched else t.tobytes() for t in found]
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(bodies, pa.binary())], names=["print", "body"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, fits = None, {}, _may_be_similar if sketched else _similar
        for batch in batches:
            keep = []
            for token, left, right, turn, a, body in zip(*batch.columns):
                key = (token.as_py(), left.as_py(), right.as_py())
                if key != at:
                    at, held = key, {}
                first = turn.as_py() == 0
                if first:
                    held[a.as_py()] = body.as_py()
                keep.append(not first and fits(held[a.as_py()], held[body.as_py()], rule))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(k) for k in (4, 5, 0, 1, 2)], names=["a", "b", *place])

    keyed = docs.withColumn("key", _text_key())
    picked = keyed.join(picks, _same_row("__id", "__key"), "left_semi").select("key", F.col("text").cast("string")).mapInArrow(load, "print binary, body binary")
    bodies = picked.join(roles, "print").select(*place, F.lit(0).alias("turn"), F.col("print").alias("a"), "body")
    sent = bodies.union(pairs.select(*place, F.lit(1), "a", F.col("b"))).repartition(*place).sortWithinPartitions(*place, "turn")
    return stored(sent.mapInArrow(check, "a binary, b binary, token long, left int, right int"), "likely" if sketched else "links")


def _shared(s: np.ndarray, t: np.ndarray) -> int:
    """Tokens two sorted sets have in common."""
    small, large = (s, t) if len(s) <= len(t) else (t, s)
    if not len(small):
        return 0
    return int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())


def similar_documents(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    The component is the smallest id reachable by links.  Null and empty texts have no shingles and are linked with nothing.
    Rows with equal sets are linked.  Ids may be null and rows may repeat: a null id never names a component unless no row of
    it has another.  Other columns are ignored.
    """
    signed, names = _grouped(docs, rule)
    return signed.select("doc_id", F.col("n").alias("n_shingles"), "print").join(names.drop("first"), "print", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _grouped(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and (print, component_id, first) of all sets, ``first`` the row that stands for the component."""
    with small_batches(docs.sparkSession):
        return _joined(docs, rule)


def _joined(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    common = common_tokens(rows, rule)
    signed = stored(signatures(rows, common, rule), "signatures")
    sets = stored(with_shared(signed, shared_marks(signed)).groupBy("print").agg(
        _first_row().alias("row"), *(F.first(c).alias(c) for c in ("n", "group", "pos", "token", "bits")))
        .select("print", "row.*", "n", "group", "pos", "token", "bits"), "sets_of")
    keyed = sets.where(F.col("group").isNotNull())
    grouped = keyed.groupBy("group").agg(F.count(F.lit(1)).alias("sets"), *(F.first(c).alias(c) for c in ("pos", "token", "n")))
    buckets = stored(_buckets(grouped, rule), "buckets")
    members = stored(buckets.join(keyed.select("group", "print", "n", "bits"), "group").drop("group"), "members")
    links = _verified(_candidates(members, None, "first", rule), True, rows, sets, rule)
    # A large group of near copies is connected by a forest; what is left after it are few pairs, in buckets where it had any.
    tree = stored(_candidates(members, components(links), "tree", rule), "tree")
    if not tree.isEmpty():
        links = links.union(_verified(_once(tree), False, rows, sets, rule))
        open_ = members.join(tree.select("token").distinct(), "token", "left_semi")
        rest = _candidates(open_, components(links), "all", rule).join(tree.select("a", "b").distinct(), ["a", "b"], "left_anti")
        links = links.union(_verified(rest, False, rows, sets, rule))
    return signed, _names(sets, links)


def _names(sets: DataFrame, links: DataFrame) -> DataFrame:
    roots = components(links)
    rooted = sets.select("print", "doc_id", "key").join(roots.select(F.col("node").alias("print"), "root"), "print", "left")
    rooted = stored(rooted.select("print", "doc_id", "key", F.coalesce("root", "print").alias("root")), "rooted")
    least = stored(rooted.groupBy("root").agg(_first_row().alias("first")), "least")
    return stored(rooted.select("print", "root").join(least, "root").select(
        "print", F.col("first.doc_id").alias("component_id"), "first"), "names")


def one_of_each(docs: DataFrame, rule: Rule = Rule(5, 4, 5)) -> DataFrame:
    """The documents without near duplicates: of each component one row with the smallest id stays; columns as they are.

    This is decided for rows, not ids: a null id is larger than all others, and rows that share an id are judged by their
    texts.  Of rows equal in id and text one stays.  Rows without words all stay.
    """
    columns = docs.columns
    signed, names = _grouped(docs, rule)
    found = stored(signed.where("n > 0").select("doc_id", "key", "print").join(names.select("print", "first"), "print").select(
        "doc_id", "key", _same_row("first.doc_id", "first.key").alias("stays")), "similar")
    gone = found.where("not stays").select(F.col("doc_id").alias("__id"), F.col("key").alias("__gone")).distinct()
    gone = F.broadcast(gone) if gone.count() <= MOST_PICKED else gone
    same = lambda key: F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col(key))
    rest = docs.withColumn("__key", _text_key()).join(gone, same("__gone"), "left_anti")
    again = found.where("stays").groupBy("doc_id", "key").count().where("count > 1").select(
        F.col("doc_id").alias("__id"), F.col("key").alias("__again"))
    back = [F.col(f"`{c}`") for c in columns]
    if again.isEmpty():
        return rest.select(*back)
    twice = rest.join(again, same("__again"), "left_semi").dropDuplicates(["doc_id", "__key"])
    return rest.join(again, same("__again"), "left_anti").select(*back).union(twice.select(*back))
