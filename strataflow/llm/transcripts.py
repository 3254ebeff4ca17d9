"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

States are roles.  A line shows a speaker marker ("User:", "### Assistant", ...), its length, its place in its row and its last
character; the odds of each feature in each role are learned from labelled rows.  Roles may change where a row begins or a
line carries a marker, with learned odds; other lines go on with their role.

The most likely roles are found for conversations of any length.  Rows are range-partitioned in order; each partition sums
up its first and last conversation by the best score for each pair of end states (a product of small matrices in the
max-plus sense).  From one such summary per partition the states at the borders follow, and every partition then finds its
own path between them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .language_id import held_out

#: Words that mark a speaker, by the role they hint at.
SPEAKERS = {
    "user": "user human customer client question prompt q me you",
    "assistant": "assistant ai bot chatbot model answer response agent a",
    "system": "system instruction instructions context",
    "tool": "tool function observation",
}
_HINT = {word: role for role, listed in SPEAKERS.items() for word in listed.split()}
_MARKER = re.compile(r"[ \t]*(?:(?:#+|>+|[*\-]+)[ \t]*)?(?:\*\*|\[|\(|<\|?|\|)?[ \t]*([A-Za-z]{1,12})[ \t]*"
                     r"(?:\*\*)?(?:\|?>|\]|\)|\|)?(?:[ \t]*:(?:\*\*)?|(?<=[>\]|]))[ \t]*")
#: Weight of a marker's own hint next to the learned counts.
HINT_WEIGHT = 20.0
#: Equal turns that one row stands for when results are given to each of them.
COPIES = 1_000
DEFAULT_ROLES = ["assistant", "system", "user"]


def marker(line: str) -> tuple[str, int]:
    """The role a line's speaker marker hints at ("" for none) and the length of the marker."""
    found = _MARKER.match(line)
    hint = _HINT.get(found[1].lower()) if found else None
    return (hint, found.end()) if hint else ("", 0)


def line_features(lines: list[str]) -> list[tuple[tuple[str, str], ...]]:
    """Feature values of the lines of a row."""
    return [(("marker", marker(x)[0]), ("length", str(len(x).bit_length())), ("place", str(min(i, 3))),
             ("end", x[-1:] if x[-1:] in ".?!:;," else "other"), ("rows", str(min(len(lines), 9)) if i == 0 else ""))
            for i, x in enumerate(lines)]


class Model:
    """Log odds of first roles, role changes and feature values."""

    def __init__(self, roles: list[str], counts: dict[tuple[str, str, str], int]):
        """``counts``: (kind, role, value); kinds are "first", "next" (value: the following role) and the features."""
        self.roles = roles or DEFAULT_ROLES
        size = len(self.roles)

        def table(kind: str, values: list[str], prior: float) -> np.ndarray:
            n = np.array([[counts.get((kind, r, v), 0) + prior for v in values] for r in self.roles], float)
            if kind == "marker":
                n += [[HINT_WEIGHT * (r == v) for v in values] for r in self.roles]
            return np.log(n / n.sum(axis=1, keepdims=True))

        first = np.array([counts.get(("first", r, ""), 0) + 0.5 for r in self.roles])
        self.first = np.log(first / first.sum())
        self.next = table("next", self.roles, 0.5)
        self.stay = np.where(np.eye(size, dtype=bool), 0.0, -np.inf)
        self.features: dict[tuple[str, str], np.ndarray] = {}
        for kind in ("marker", "length", "place", "end", "rows"):
            values = sorted({v for k, _, v in counts if k == kind} | ({"", *SPEAKERS} if kind == "marker" else set()))
            for j, v in enumerate(values):
                self.features[kind, v] = table(kind, values, 0.5)[:, j]
        self._none = np.zeros(size)

    def row_steps(self, text: str) -> list[tuple[bool, np.ndarray, str]]:
        """(change allowed, log likelihoods, line) of the lines of a row."""
        lines = text.split("\n")
        steps = []
        for i, (line, features) in enumerate(zip(lines, line_features(lines))):
            odds = self._none
            for f in features:
                odds = odds + self.features.get(f, self._none)
            steps.append((i == 0 or features[0][1] != "", odds, line))
        return steps

    def turn(self, change: bool) -> np.ndarray:
        return self.next if change else self.stay


def _ordered(chats: DataFrame) -> DataFrame:
    """Distinct rows with their number of ``copies`` in conversation order, cut into partitions; stored, with the number of the partition."""
    rows = chats.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
                        (~held_out(F.col("conv_id"))).alias("teaches"))
    key = ["conv_id", "turn", F.xxhash64("text", "role"), "text", "role"]
    counted = rows.groupBy("conv_id", "turn", "role", "text", "teaches").agg(F.count(F.lit(1)).alias("copies"))
    spread = counted.repartitionByRange(*key).sortWithinPartitions(*key)
    return stored(spread.withColumn("part", F.spark_partition_id()), "ordered")


def _parts(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on the whole partitions of :func:`_ordered`, rows in order."""
    key = ["conv_id", "turn", F.xxhash64("text", "role"), "text", "role"]
    return rows.repartition("part").sortWithinPartitions("part", *key).mapInArrow(work, schema)


def _runs(batches: Iterator[pa.RecordBatch]):
    """(part, rows) of consecutive rows with the same part."""
    part, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                if rows:
                    yield part, rows
                part, rows = row["part"], []
            rows.append(row)
    if rows:
        yield part, rows


def learn(rows: DataFrame) -> Model:
    """The model from labelled rows whose conversation is not held out."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for part, run in _runs(batches):
            before = None
            for row in run:
                same = before is not None and before["conv_id"] == row["conv_id"]
                if row["teaches"] and row["role"] is not None:
                    seen["role", row["role"], ""] += row["copies"]
                    for features in line_features((row["text"] or "").split("\n")):
                        for kind, value in features:
                            seen[kind, row["role"], value] += row["copies"]
                    if same and before["role"] is not None:
                        seen["next", before["role"], row["role"]] += 1
                    if not same and before is not None:
                        seen["first", row["role"], ""] += 1
                before = row
            # What crosses a border is counted from the ends of the partitions.
            for name, row in (("begin", run[0]), ("finish", run[-1])):
                if row["teaches"] and row["role"] is not None:
                    seen[f"{name} {part} {row['conv_id']}", row["role"], ""] += 1
        keys = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.string()) for i in range(3)] +
                                         [pa.array([seen[k] for k in keys], pa.int64())], names=["kind", "role", "value", "n"])

    found = _parts(rows, count, "kind string, role string, value string, n long").groupBy("kind", "role", "value").agg(F.sum("n").alias("n")).collect()
    counts: Counter = Counter({(r.kind, r.role, r.value): r.n for r in found if " " not in r.kind})
    ends: dict[tuple[str, int], tuple[str, str]] = {}
    for r in found:
        if " " in r.kind:
            name, part, conv = r.kind.split(" ")
            ends[name, int(part)] = (conv, r.role)
    filled = sorted(part for name, part in ends if name == "begin")
    for part in filled:
        conv, role = ends["begin", part]
        before = ends.get(("finish", part - 1))
        if before and before[0] == conv:
            counts["next", before[1], role] += 1
        else:
            counts["first", role, ""] += 1
    return Model(sorted({r for k, r, _ in counts if k == "role"}), counts)


def _forward(model: Model, steps, start: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Best scores over the steps from rows of start scores (one row per way to start), and where they come from."""
    score, back = start, []
    for change, odds, _ in steps:
        ways = score[:, :, None] + model.turn(change)[None]
        back.append(ways.argmax(axis=1))
        score = ways.max(axis=1) + odds
    return score, back


def _segments(run: list[dict]) -> list[list[dict]]:
    out: list[list[dict]] = []
    for row in run:
        if out and out[-1][-1]["conv_id"] == row["conv_id"]:
            out[-1].append(row)
        else:
            out.append([row])
    return out


def _steps(model: Model, segment: list[dict]):
    return [(s, row) for row in segment for s in model.row_steps(row["text"] or "")]


def _path(model: Model, steps, start: np.ndarray | None, end: int | None) -> list[int]:
    """Best states of the steps; ``start``: scores of the state before (None: a conversation begins), ``end``: the last state."""
    (change, odds, _), rest = steps[0], steps[1:]
    if start is None:
        score, back = (model.first + odds)[None], [np.zeros((1, len(odds)), int)]
    else:
        score, back = _forward(model, steps[:1], start[None])
    score, more = _forward(model, rest, score)
    back += more
    state = int(score[0].argmax()) if end is None else end
    states = [state]
    for b in reversed(back[1:]):
        state = int(b[0][state])
        states.append(state)
    return states[::-1]


def borders(summaries: dict[int, dict], size: int) -> dict[int, tuple[int | None, int | None]]:
    """(state before the first row, state of the last row) for every partition, None where a conversation begins or ends there.

    A summary has first and last conversation, whether they are one, ``open`` (best score by state before and last state, over
    the first conversation) and ``fresh`` (scores by last state of the last conversation, if it begins here).
    """
    order = sorted(summaries)
    joins = {p: q for p, q in zip(order, order[1:]) if summaries[p]["last"] == summaries[q]["first"]}
    score: dict[int, np.ndarray] = {}
    for p in order:
        s, before = summaries[p], [q for q in joins if joins[q] == p]
        score[p] = s["fresh"] if not (s["one"] and before) else (score[before[0]][:, None] + s["open"]).max(axis=0)
    out: dict[int, list] = {p: [None, None] for p in order}
    for p in reversed(order):
        follows = joins.get(p)
        if follows is None:
            continue
        # The next partition's state before its first row is this one's last state.
        n = summaries[follows]
        if n["one"] and out[follows][1] is not None:
            gain = score[p] + n["open"][:, out[follows][1]]
        else:
            gain = score[p] + n["open"].max(axis=1)
        state = int(gain.argmax())
        out[p][1], out[follows][0] = state, state
    return {p: (a, b) for p, (a, b) in out.items()}


def format_chats(chats: DataFrame) -> DataFrame:
    """conv_id, turn, piece, role, role_pred, opens, rendered for every piece of a row of ``chats`` that has one role.

    ``chats``: conv_id, turn, role (null: unknown), text.  Rows equal in all four columns are one turn of the conversation, and each
    of them gets its results; rows of a conversation come by turn (nulls first), ties by a hash of text and role.  Null texts are empty lines; a null conversation id is a
    conversation of its own.  ``rendered`` is the text without its speaker marker, after a ``<|role|>`` line where the role
    changes (``opens``).  Given roles only teach; predictions do not look at them.  Other columns are ignored.
    """
    spark = chats.sparkSession
    rows = _ordered(chats)
    model = learn(rows)
    size = len(model.roles)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for part, run in _runs(batches):
            segments = _segments(run)
            first, last = ([s for s, _ in _steps(model, x)] for x in (segments[0], segments[-1]))
            start = np.where(np.eye(size, dtype=bool), 0.0, -np.inf)
            fresh, _ = _forward(model, last[1:], (model.first + last[0][1])[None])
            out.append((part, segments[0][0]["conv_id"], segments[-1][0]["conv_id"], len(segments) == 1,
                        _forward(model, first, start)[0].ravel().tolist(), fresh[0].tolist()))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, kinds)],
                                         names=["part", "first", "last", "one", "open", "fresh"])

    found = _parts(rows, summarise, "part int, first long, last long, one boolean, open array<double>, fresh array<double>").collect()
    fixed = borders({r["part"]: {"first": r["first"], "last": r["last"], "one": r["one"], "fresh": np.array(r["fresh"]),
                                 "open": np.array(r["open"]).reshape(size, size)} for r in found}, size)
    handed = spark.sparkContext.broadcast(fixed)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, run in _runs(batches):
            before, after = handed.value[part]
            segments, out = _segments(run), []
            for i, segment in enumerate(segments):
                steps = _steps(model, segment)
                start = None
                if i == 0 and before is not None:
                    start = np.where(np.arange(size) == before, 0.0, -np.inf)
                states = _path(model, [s for s, _ in steps], start, after if i == len(segments) - 1 else None)
                role, row, piece = before if i == 0 else None, None, 0
                for ((_, _, line), source), state in zip(steps, states):
                    text = line[marker(line)[1]:]
                    if source is row and state == role:
                        out[-1][-1].append(text)
                        continue
                    piece = piece + 1 if source is row else 0
                    name = model.roles[state]
                    opens = state != role
                    out.append([source["conv_id"], source["turn"], piece, source["role"], name, opens, source["copies"],
                                [f"<|{name}|>"] * opens + [text]])
                    role, row = state, source
            for begin in range(0, len(out), 1024):
                part_of = out[begin:begin + 1024]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[k] for x in part_of], t) for k, t in enumerate(kinds)] +
                    [pa.array(["\n".join(x[7]) for x in part_of], pa.string())],
                    names=["conv_id", "turn", "piece", "role", "role_pred", "opens", "copies", "rendered"])

    return _each_copy(stored(_parts(rows, render, "conv_id long, turn long, piece int, role string, role_pred string, opens boolean, "
                                                  "copies long, rendered string"), "rendered"))


def _each_copy(found: DataFrame) -> DataFrame:
    """Every row as often as ``copies`` says.  Rows with many copies are dealt to tasks in blocks of them."""
    columns = [c for c in found.columns if c != "copies"]
    times = lambda n: F.explode(F.sequence(F.lit(1), n)).alias("copy")
    few = found.where(F.col("copies") <= COPIES).select(*columns, times(F.col("copies")))
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES))).alias("block")
    many = found.where(F.col("copies") > COPIES).select("*", blocks).repartition("conv_id", "turn", "piece", "block")
    many = many.select(*columns, times(F.least(F.lit(COPIES), F.col("copies") - F.col("block") * COPIES)))
    return few.union(many).select(*columns)
