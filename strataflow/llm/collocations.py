"""Phrase collocations from Rabin-Karp fingerprints of word n-grams.

Prefix polynomials over the words of a batch give the fingerprint of every n-gram in a few numpy operations.  Fingerprints are
counted in the task, and the shuffle adds counts and keeps pointers to an occurrence, never text.

1. Texts are stored once as pieces of words under row numbers, so that a pointer (row, place) holds for all later passes.
2. Lengths are counted one after the other, by numbers from polynomials over short codes of the words, which stand beside the
   text: a number and a count are all that is shuffled.  An n-gram can be frequent only if both its parts of one word less are, so a task passes on those whose parts are in
   a bitmap of the frequent numbers of the length before.  Numbers and bitmaps are shared by several n-grams: that costs rows,
   never results.
3. One more pass counts the n-grams in the bitmaps by whole fingerprints, with a pointer each.  What is frequent now, and nothing
   else, is read from the text at its pointer.
4. A second polynomial with other word hashes tells collisions: where a fingerprint has two of them, its phrases are counted
   again by their text.
5. Scores follow from the counts of the parts by joins, in decimals.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Language of texts that name none.
UNKNOWN = "und"
#: Between pieces: no word is this upper-case letter, as texts are lower-cased.
BREAK = "A"
_BREAK = BREAK.encode()
_NO_CODE = bytes(4)
#: Words whose n-grams a task counts at once.
WORDS_AT_ONCE = 200_000
#: Bits of the numbers by which n-grams are counted before pointers are kept.
NUMBER_BITS = 36
#: Upper-case letters become small, the separators of pieces the break.
_TABLE = bytes(ord("A") if c in b".,;:!?\n\v\f\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Slots of the bitmap per frequent fingerprint, and most of them (8 MB).
SLOTS_EACH, MOST_SLOTS = 32, 1 << 26
#: Word hashes a task remembers.
REMEMBERED = 100_000
_BASE, _CHECK_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


@dataclass(frozen=True)
class Rule:
    """Longest phrases in words, least occurrences, phrases returned per language, bits of the fingerprints."""

    longest: int = 5
    least: int = 100
    first: int = 2_000
    bits: int = 64


class _Words(dict):
    """Two hashes of each word, as 16 bytes; emptied when it has grown too large."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_128_digest(word)
        return value


class _Codes(dict):
    """32 bits of a hash of each word, as bytes, never the code of a break."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        code = xxhash.xxh3_64_digest(word)[:4]
        value = self[word] = _NO_CODE if word == _BREAK else b"\x01\x00\x00\x00" if code == _NO_CODE else code
        return value


def _powers(base: int, count: int) -> np.ndarray:
    """1, base, base ** 2, ... modulo 2 ** 64."""
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Polynomial:
    """Prefix polynomial modulo 2 ** 64 over a run of words of one language: values of all n-grams at once."""

    def __init__(self, lang: str, values: np.ndarray, base: int):
        self._seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        # Sum of word * base ** -place up to each place; times base ** place of the end it is the polynomial of the words.
        down = np.cumsum(values * _powers(pow(base, -1, 1 << 64), len(values)))
        self._down, self._up = np.concatenate([np.zeros(1, np.uint64), down]), _powers(base, len(values))

    def of(self, at: np.ndarray, n: int) -> np.ndarray:
        """Mixed values of the n-grams that begin at some places."""
        if not len(at):
            return np.zeros(0, np.uint64)
        x = (self._down[at + n] - self._down[at]) * self._up[at + n - 1]
        x = ((x ^ self._seed) ^ (x >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return x ^ (x >> np.uint64(29))


class Numbers:
    """Places and numbers of the n-grams of a run of word codes."""

    def __init__(self, lang: str, codes: np.ndarray):
        count = len(codes)
        ends = np.where(codes == 0, np.arange(count), count)
        # Words from each place to the end of its piece.
        self._left = (np.minimum.accumulate(ends[::-1])[::-1] if count else ends) - np.arange(count)
        spread = codes.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        self._values, self._size = Polynomial(lang, spread ^ (spread >> np.uint64(31)), _BASE), count

    def of(self, n: int, shorter: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams whose parts of one word less are in a bitmap, all without one."""
        at = np.flatnonzero(self._left >= n)
        if shorter is not None:
            places = np.flatnonzero(self._left >= n - 1)
            fits = np.zeros(self._size + 1, bool)
            fits[places] = _bit_of(shorter, self._values.of(places, n - 1) >> np.uint64(64 - NUMBER_BITS))
            at = at[fits[at] & fits[at + 1]]
        return at, self._values.of(at, n) >> np.uint64(64 - NUMBER_BITS)


def pieces(docs: DataFrame) -> DataFrame:
    """Stored table (row, lang, words, codes): the text with its words joined by spaces and pieces separated by :data:`BREAK`, and
    32 bits of a hash of each word, 0 for breaks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Codes()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = [_squeezed((t.as_py() or "").encode("utf-8", "replace").translate(_TABLE)) for t in part.column(2)]
                codes = [b"".join([known[w] for w in body.split(b" ")]) if body else b"" for body in found]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.binary()), pa.array(codes, pa.binary())],
                                                 names=["row", "lang", "words", "codes"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(run, "row long, lang string, words binary, codes binary").where(F.octet_length("words") > 0), "pieces", "zstd")


def _squeezed(body: bytes) -> bytes:
    """Words and breaks apart by one space each; only space and tab are between words."""
    return b" ".join(filter(None, body.replace(b"\t", b" ").replace(_BREAK, b" A ").split(b" ")))


def _runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[int], list[int], np.ndarray, list[bytes]]]:
    """Rows (lang, row, codes, and words if asked for) of one language at a time, of about ``size`` words: the rows, where they begin, their
    codes and words, a break after each.
    """
    held: dict[str, tuple[list, list, list, list]] = defaultdict(lambda: ([], [0], [], []))
    count = 0

    def out():
        for lang, (rows, starts, codes, words) in held.items():
            yield lang, rows, starts[:-1], np.frombuffer(b"".join(codes), np.uint32), words
        held.clear()

    for batch in batches:
        texts = batch.column(3) if batch.num_columns > 3 else [None] * batch.num_rows
        for lang, row, body, text in zip(batch.column(0), batch.column(1), batch.column(2), texts):
            rows, starts, codes, words = held[lang.as_py()]
            body = body.as_py()
            rows.append(row.as_py())
            starts.append(starts[-1] + len(body) // 4 + 1)
            codes += (body, _NO_CODE)
            if text is not None:
                words += text.as_py().split(b" ")
                words.append(_BREAK)
            count += len(body) // 4 + 1
            if count >= size:
                yield from out()
                count = 0
    yield from out()


def _bit_of(bitmap: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    slot = numbers & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def count_numbers(rows: DataFrame, n: int, shorter: np.ndarray | None) -> DataFrame:
    """(number, count): occurrences of the n-grams that may be frequent, by numbers made of the codes of their words."""
    handed = rows.sparkSession.sparkContext.broadcast(shorter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, _, codes, _ in _runs(batches, WORDS_AT_ONCE):
            found = np.sort(Numbers(lang, codes).of(n, handed.value)[1])
            first = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found[first].view(np.int64)), pa.array(np.diff(np.append(first, len(found))))],
                                             names=["number", "count"])

    return rows.select("lang", "row", "codes").mapInArrow(run, "number long, count long").groupBy("number").agg(F.sum("count").alias("count"))


def bitmap(numbers: DataFrame) -> np.ndarray:
    """Bits of the slots of a column ``number``; the slots are merged by tasks and bounded in number."""
    slots = 1 << 16
    while slots < min(MOST_SLOTS, SLOTS_EACH * numbers.count()):
        slots *= 2
    bits = numbers.groupBy(F.shiftright(F.col("number").bitwiseAND(F.lit(slots - 1)), 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(number & 63 AS int))")).alias("bits")).toArrow()
    out = np.zeros(slots // 64, np.uint64)
    out[bits.column("at").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return out


def count_prints(rows: DataFrame, bitmaps: list[np.ndarray], rule: Rule) -> DataFrame:
    """(lang, words, print, count, low, high, row, place): occurrences of every n-gram that may be frequent, its least and greatest
    check, and one of its places.  ``words`` 0 counts all words of a language.
    """
    handed = rows.sparkSession.sparkContext.broadcast(bitmaps)
    names = ["lang", "words", "print", "count", "row", "place", "check"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mask = _Words(), np.uint64((1 << rule.bits) - 1)
        for lang, numbers, starts, codes, words in _runs(batches, WORDS_AT_ONCE):
            numbers, starts = np.asarray(numbers, np.int64), np.asarray(starts, np.int64)
            fits, pair = Numbers(lang, codes), np.frombuffer(b"".join([known[w] for w in words]), np.uint64).reshape(-1, 2)
            prints, checks = Polynomial(lang, pair[:, 0], _BASE), Polynomial(lang, pair[:, 1], _CHECK_BASE)
            for n, own in enumerate(handed.value, 1):
                at, number = fits.of(n, handed.value[n - 2] if n > 1 else None)
                total = len(at)
                at = at[_bit_of(own, number)]
                code, check = prints.of(at, n) & mask, checks.of(at, n)
                order = np.argsort(code)
                at, code, check = at[order], code[order], check[order]
                new = np.ones(len(at), bool)
                new[1:] = (code[1:] != code[:-1]) | (check[1:] != check[:-1])
                first = np.flatnonzero(new)
                doc = np.searchsorted(starts, at[first], side="right") - 1
                columns = [np.full(len(first), n), code[first].view(np.int64), np.diff(np.append(first, len(at))), numbers[doc],
                           at[first] - starts[doc], check[first].view(np.int64)]
                if n == 1:
                    columns = [np.append(c, v) for c, v in zip(columns, (0, 0, total, 0, 0, 0))]
                yield pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(columns[0]), np.int64))), *map(pa.array, columns)], names=names)

    found = rows.select("lang", "row", "codes", "words").mapInArrow(
        run, "lang string, words long, print long, count long, row long, place long, check long")
    return found.groupBy("lang", "words", "print").agg(
        F.sum("count").alias("count"), F.min("check").alias("low"), F.max("check").alias("high"),
        # Any occurrence will do; all places of a fingerprint in one row come from one task.
        F.min("row").alias("row"), F.min_by("place", "row").alias("place"))


def phrases_at(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """(lang, phrase, words, count) of fingerprints with one phrase each, the phrase read from the text at the pointer.

    A text is cut into words once for all pointers to it; they are no more than its n-grams.
    """
    at = frequent.groupBy(F.col("row").alias("__row")).agg(F.collect_list(F.struct("place", "words", "count")).alias("pointers"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, body, pointers in zip(*batch.columns):
                words, pointers = body.as_py().split(b" "), pointers.as_py()
                for start in range(0, len(pointers), 10_000):
                    part = pointers[start:start + 10_000]
                    found = [b" ".join(words[p["place"]:p["place"] + p["words"]]).decode("utf-8", "replace") for p in part]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang.as_py()] * len(part)), pa.array(found), pa.array([p["words"] for p in part], pa.int64()),
                        pa.array([p["count"] for p in part], pa.int64())], names=["lang", "phrase", "words", "count"])

    found = rows.join(at, F.col("row") == F.col("__row")).select("lang", F.col("words"), "pointers")
    return found.mapInArrow(read, "lang string, phrase string, words long, count long")


def recount(rows: DataFrame, collided: DataFrame, rule: Rule) -> DataFrame:
    """(lang, phrase, words, count) of all phrases of fingerprints that several phrases share, counted by their text."""
    bits = [bitmap(collided.where(F.col("words") == n).select(F.col("print").alias("number"))) for n in range(1, rule.longest + 1)]
    handed = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mask = _Words(), np.uint64((1 << rule.bits) - 1)
        for lang, _, _, codes, words in _runs(batches, WORDS_AT_ONCE):
            fits = Numbers(lang, codes)
            prints = Polynomial(lang, np.frombuffer(b"".join([known[w] for w in words]), np.uint64)[::2], _BASE)
            for n, own in enumerate(handed.value, 1):
                at = fits.of(n, None)[0]
                code = prints.of(at, n) & mask
                keep = _bit_of(own, code)
                seen = Counter((c, b" ".join(words[i:i + n])) for i, c in zip(at[keep].tolist(), code[keep].view(np.int64).tolist()))
                for start in range(0, len(seen), 10_000):
                    part = list(seen.items())[start:start + 10_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(part)), pa.array([n] * len(part), pa.int64()), pa.array([k[0] for k, _ in part], pa.int64()),
                        pa.array([k[1].decode("utf-8", "replace") for k, _ in part]), pa.array([v for _, v in part], pa.int64())],
                        names=["lang", "words", "print", "phrase", "count"])

    counts = (rows.select("lang", "row", "codes", "words").mapInArrow(run, "lang string, words long, print long, phrase string, count long")
              .groupBy("lang", "words", "print", "phrase").agg(F.sum("count").alias("count")).where(F.col("count") >= rule.least))
    # A bitmap lets others through, too.
    keys = collided.select(F.col("lang").alias("__lang"), F.col("words").alias("__words"), F.col("print").alias("__print"))
    same = (F.col("lang") == F.col("__lang")) & (F.col("words") == F.col("__words")) & (F.col("print") == F.col("__print"))
    return counts.join(keys, same, "left_semi").select("lang", "phrase", "words", "count")


def frequent_phrases(docs: DataFrame, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, count) of all phrases of up to ``rule.longest`` words with at least ``rule.least`` occurrences,
    and (lang, n) with the number of words of each language.
    """
    rows, bitmaps = pieces(docs), []
    for n in range(1, rule.longest + 1):
        numbers = count_numbers(rows, n, bitmaps[-1] if bitmaps else None).where(F.col("count") >= rule.least)
        bitmaps.append(bitmap(stored(numbers.select("number"), "numbers")))
    counts = stored(count_prints(rows, bitmaps, rule).where((F.col("count") >= rule.least) | (F.col("words") == 0)), "prints")
    totals = counts.where("words = 0").select("lang", F.col("count").alias("n"))
    frequent = counts.where("words > 0")
    single, collided = phrases_at(rows, frequent.where("low = high")), frequent.where("low <> high")
    return stored(single if collided.isEmpty() else single.union(recount(rows, collided, rule)), "phrases"), totals


def _part(phrase: Column, start: int | Column, size: int | Column) -> Column:
    whole = lambda x: x.cast("int") if isinstance(x, Column) else F.lit(x)
    return F.array_join(F.slice(F.split(phrase, " "), whole(start), whole(size)), " ")


def score_phrases(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of the phrases of two and more words, by their lowest-scoring cut."""
    long = counts.where("words > 1")
    cuts = long.select("lang", "phrase", "words", F.col("count").alias("a"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("words") - 1)).alias("k"))
    side = cuts.select("*", F.explode(F.array(F.lit(True), F.lit(False))).alias("left"))
    part = side.withColumn("part", F.when(F.col("left"), _part(F.col("phrase"), F.lit(1), F.col("k"))).otherwise(
        _part(F.col("phrase"), F.col("k") + 1, F.col("words") - F.col("k"))))
    known = counts.select(F.col("lang").alias("__lang"), F.col("phrase").alias("__part"), F.col("count").alias("f"))
    both = part.join(known, (F.col("lang") == F.col("__lang")) & (F.col("part") == F.col("__part"))).groupBy(
        "lang", "phrase", "words", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    rated = both.join(totals.select(F.col("lang").alias("__lang"), "n"), F.col("lang") == F.col("__lang")).drop("__lang").withColumns(
        {"up": (whole("a") * whole("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"), "down": whole("l") * whole("r")})
    # The whole part of a quotient of decimals, exact.
    rated = rated.withColumn("score", F.expr("up div down"))
    return rated.groupBy("lang", "phrase", "words", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def contained(counts: DataFrame) -> DataFrame:
    """(lang, phrase, most): the most occurrences of a phrase one word longer that contains the phrase.

    A phrase inside a longer one of as many occurrences is inside one that is longer by one word and has as many.
    """
    longer = counts.where("words > 2").select("lang", "count", F.explode(F.array_distinct(F.array(
        _part(F.col("phrase"), F.lit(1), F.col("words") - 1), _part(F.col("phrase"), F.lit(2), F.col("words") - 1)))).alias("phrase"))
    return longer.groupBy("lang", "phrase").agg(F.max("count").alias("most"))


def collocations(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``rule.first`` phrases of each language of ``docs`` (text, lang).

    Null and empty texts have no words; a null language is ``und``.  Repeated rows count as often as they stand there.  Equal scores
    are ordered by occurrences, then by the bytes of the phrase.  An empty table gives no rows; other columns are ignored.
    """
    counts, totals = frequent_phrases(docs, rule)
    rated = score_phrases(counts, totals)
    inside = contained(counts).select(F.col("lang").alias("__lang"), F.col("phrase").alias("__phrase"), "most")
    same = (F.col("lang") == F.col("__lang")) & (F.col("phrase") == F.col("__phrase"))
    kept = rated.join(inside.where("most IS NOT NULL"), same, "left").where(F.col("most").isNull() | (F.col("most") < F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rule.first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
