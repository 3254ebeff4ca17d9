"""Quality rules as a learned decision list.  DataFrame and SQL functions only.

Every document gets a row of statistics.  From labelled ones, sequential covering learns rules that reject: a rule is grown
by the threshold condition with the highest information gain on one part of the labels, cut back to the prefix that is most
precise on the other part, and kept if precise enough; the rows it covers are set aside and the next rule is learned from the
rest.  The list is an ordered CASE expression.  Learning needs counts per (statistic, threshold step, label, part) only:
one aggregation per condition, a few hundred numbers to the driver, whatever the number of documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, stored, words

#: Length of the windows whose repetition counts.
WINDOW = 8
#: Ratios the rules may test, from the counts of :func:`with_statistics`.
RATIOS = ("word_length", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "upper_ratio", "mark_ratio", "digit_ratio",
          "distinct_ratio", "words_per_line")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _removed(text: Column, others: str) -> Column:
    """Number of characters outside the class ``others``."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def repeated_words(w: Column) -> Column:
    """Words standing in 8-word windows that occur twice or more in the array ``w``, every occurrence counted."""
    starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
    prints = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    # Different windows may share a print, so those of a text with a repeated print are compared as strings.
    windows = F.sort_array(F.transform(starts, lambda i: F.struct(F.array_join(F.slice(w, i, WINDOW), " ").alias("t"),
                                                                   i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["t"] == x["t"], F.lit(False))
        return F.sort_array(F.array_compact(F.transform(
            s, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))))

    covered = F.aggregate(
        _let(windows, repeated), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")))["n"]
    return (F.when(F.size(w) <= WINDOW, F.lit(0).cast("long"))
            .when(_let(prints, lambda p: F.size(p) == F.size(F.array_distinct(p))), F.lit(0).cast("long"))
            .otherwise(covered))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``stats``, a struct of counts and ratios of the whole text (null counts as empty).  A clashing column is replaced."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "stats"]
    base = docs.select(*kept, words(body).alias("__w"),
                       F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD)).alias("__l"),
                       _removed(body, r"[^#*$%&|<>]+").alias("__symbols"), _removed(body, r"[^A-Z]+").alias("__upper"),
                       _removed(body, r"[^.,;:!?]+").alias("__marks"), _removed(body, r"[^0-9]+").alias("__digits"))
    w, lines = F.col("__w"), F.col("__l")
    counted = base.select(
        *kept, F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.col("__symbols").alias("n_symbols"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"), F.size(lines).cast("long").alias("n_lines"),
        F.col("__upper"), F.col("__marks"), F.col("__digits"), F.size(F.array_distinct(w)).alias("__distinct")
    ) if not set(docs.columns) & {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"} else None
    if counted is None:
        # Columns of the input that clash with the counts are carried along inside a struct.
        packed = docs.select(F.struct(*kept).alias("row"), F.col(text).alias("text"))
        return with_statistics(packed).select("row.*", "stats")
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return counted.select(*kept, F.struct(
        *[F.col(c) for c in counts], ratio("word_chars", "n_words").alias("word_length"),
        ratio("n_symbols", "word_chars").alias("symbol_ratio"), ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_ratio"), ratio("__upper", "word_chars").alias("upper_ratio"),
        ratio("__marks", "n_words").alias("mark_ratio"), ratio("__digits", "word_chars").alias("digit_ratio"),
        ratio("__distinct", "n_words").alias("distinct_ratio"), ratio("n_words", "n_lines").alias("words_per_line"),
    ).alias("stats"))


@dataclass(frozen=True)
class Condition:
    """``stats.name <= threshold`` or ``> threshold``."""

    name: str
    above: bool
    threshold: float

    def column(self, stats: str = "stats") -> Column:
        value = F.col(f"{stats}.{self.name}")
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class Learning:
    """Settings of :func:`learn`.  ``steps``: thresholds per statistic and label; ``precision``: a rule's least on the pruning part."""

    steps: int = 24
    most_rules: int = 12
    most_conditions: int = 3
    least_covered: int = 3
    precision: float = 0.9


def base_failed(stats: str = "stats") -> Column:
    n, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < 20) | (100 * repeated > 30 * n)


def learn(rows: DataFrame, labels: DataFrame, label: str = "quality", settings: Learning = Learning()) -> list[list[Condition]]:
    """Rules that reject, from rows (doc_id, stats) and labels (doc_id, 1 good or 0 bad).

    Null ids, null labels and ids labelled both ways teach nothing; repeated rows of a document count once.  All labelled rows
    take part.  Without rows of both kinds the list is empty.
    """
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id")
             .agg(F.min(label).alias("low"), F.max(label).alias("high")).where("low = high")
             .select(F.col("doc_id").alias("id"), (F.col("low") == 0).alias("bad")))
    one = rows.where(F.col("doc_id").isNotNull() & ~base_failed()).groupBy("doc_id").agg(F.min("stats").alias("stats"))
    known = stored(one.join(marks, one.doc_id == marks.id).select("stats", "bad", (F.pmod(F.xxhash64("id"), F.lit(3)) == 0).alias("prune")),
                   "labelled")
    points = [(i + 0.5) / settings.steps for i in range(settings.steps)]
    steps = known.groupBy("bad").agg(*[F.percentile_approx(f"stats.{r}", points).alias(r) for r in RATIOS]).collect()
    if len(steps) < 2:
        return []
    thresholds = {r: sorted({v for row in steps for v in row[r]}) for r in RATIOS}
    # A row's step in a statistic is the number of thresholds below its value: value <= thresholds[k] if and only if step <= k.
    def step(r: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, thresholds[r])), lambda t: t < F.col(f"stats.{r}")))

    coded = stored(known.select("bad", "prune", F.array(*map(step, RATIOS)).alias("at")), "coded")

    def counts(part: DataFrame) -> dict[tuple[bool, bool], list[list[int]]]:
        table = {(bad, prune): [[0] * (len(thresholds[r]) + 1) for r in RATIOS] for bad in (True, False) for prune in (True, False)}
        seen = (part.select("bad", "prune", F.posexplode("at").alias("r", "k")).groupBy("bad", "prune", "r", "k")
                .agg(F.count(F.lit(1)).alias("n")))
        for row in seen.toLocalIterator():
            table[row.bad, row.prune][row.r][row.k] = row.n
        return table

    def info(p: int, n: int) -> float:
        return math.log2(p / (p + n)) if p else -math.inf

    rules: list[list[Condition]] = []
    rest = coded
    for _ in range(settings.most_rules):
        part, grown, tests = rest, [], []
        while len(grown) < settings.most_conditions:
            table = counts(part)
            p0, n0 = (sum(table[bad, False][0]) for bad in (True, False))
            if p0 < settings.least_covered or n0 == 0:
                break
            best = None
            for r, name in enumerate(RATIOS):
                for k in range(len(thresholds[name])):
                    for above in (False, True):
                        cut = slice(k + 1, None) if above else slice(0, k + 1)
                        p, n, pp, pn = (sum(table[key][r][cut]) for key in ((True, False), (False, False), (True, True), (False, True)))
                        if p >= settings.least_covered:
                            gain = p * (info(p, n) - info(p0, n0))
                            if best is None or gain > best[0] + 1e-9:
                                best = (gain, r, k, above, pp, pn)
            if best is None or best[0] <= 1e-9:
                break
            _, r, k, above, pp, pn = best
            grown.append((Condition(RATIOS[r], above, float(thresholds[RATIOS[r]][k])), pp, pn))
            tests.append(F.col("at")[r] > k if above else F.col("at")[r] <= k)
            part = part.where(tests[-1])
        if not grown:
            break
        # Pruning: the prefix that is most precise on rows it was not grown from; the shorter one of equals.
        value = [(p + 1) / (p + n + 2) for _, p, n in grown]
        length = value.index(max(value)) + 1
        _, p, n = grown[length - 1]
        if p == 0 or p / (p + n) < settings.precision:
            break
        rules.append([c for c, _, _ in grown[:length]])
        rule = tests[0]
        for test in tests[1:length]:
            rule = rule & test
        rest = rest.where(~rule)
    return rules


def verdict(rules: list[list[Condition]], stats: str = "stats") -> Column:
    """The decision list: false by the first rule that holds, else true."""
    chain = None
    for rule in rules:
        test = rule[0].column(stats)
        for condition in rule[1:]:
            test = test & condition.column(stats)
        chain = F.when(test, F.lit(False)) if chain is None else chain.when(test, F.lit(False))
    return F.lit(True) if chain is None else chain.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """Columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every document row.

    Null and empty texts have no words and fail.  Repeated rows stay repeated; other columns are ignored.
    """
    rows = stored(with_statistics(docs.select(F.col("doc_id"), F.col(text).alias("text"))).select("doc_id", "stats"), "stats")
    rules = learn(rows, labels)
    return rows.select("doc_id", *[f"stats.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                       base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that pass, with all their columns and no others."""
    # The text is carried once, beside the other columns.
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rated = stored(with_statistics(docs.select(others.alias("row"), "doc_id", "text")).select("row", "doc_id", "text", "stats"), "rated")
    rules = learn(rated.select("doc_id", "stats"), labels)
    return rated.where(~base_failed() & verdict(rules)).select(
        *[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
