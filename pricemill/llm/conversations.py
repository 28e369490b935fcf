"""Repair of conversations by the cheapest edits, found by iterative-deepening A*.

Every row is kept, given another role or deleted, and empty rows may be inserted, so that the role initials read
``(s?(ua)+)?``.  The search tries edits in ASCII order (D, I, K, R) depth first under a cost bound that grows to the least
cost seen beyond it; a table of failed states holds the budget with which a state was left without success.  So the first path
that is accepted has the least cost and, of those, the ASCII-least initials.

Conversations are sorted over the whole cluster by (conversation, turn, role, text) and cut into pieces of at most
``PIECE`` rows, so no task gathers a conversation.  One of a single piece is searched from start to end.  For the pieces of
longer ones, searches give the least cost from every state to every state; one pass backward joins these costs to
the least cost behind each piece, and each piece is searched again with that cost as the end of its bound.  A last pass
walks the pieces in order, follows the states and hashes the repaired text row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from pricemill.llm.common import keep

PIECE = 64
RENAME, DELETE, INSERT, CUT = 1, 2, 5, 5  # costs; CUT is added for a truncated row that stays
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
NEVER = 1 << 60

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
AFTER_INSERT = (USER, USER, ASSISTANT, USER)  # also after a new role
CLOSING = (0, 2 * INSERT, INSERT, 0)  # cost of the inserts that end a conversation in this state
KEPT = {("s", START): SYSTEM, **{("u", state): USER for state in (START, SYSTEM, ASSISTANT)}, ("a", USER): ASSISTANT}

# A row's code: the role's initial if it is s, u or a, else ".", in upper case if the row is truncated; "x" has to go.
MUST_GO = "x"


def damage(turns: DataFrame) -> DataFrame:
    """Rows of ``turns(conv_id, turn, role, text)`` after damage, each with the number ``n`` of its copies.

    The CRC-32 of ``conv_id:turn``, modulo 20, drops a row (0), empties its text (1), removes its ``.!?`` (2), repeats it (3) or
    gives it the role user (4).  A null counts as one space in the key and as a role or text of one space.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault, role, text = F.crc32(key) % 20, F.coalesce("role", space), F.coalesce("text", space)
    return turns.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies ``n``, their fault and the code that the search reads.

    Equal rows of a turn are one row here, whatever their number; the first one's fault is ``fault``, the others are duplicates (or
    blank as well).  The first turn of a text that a conversation repeats is found from hashes, pre-aggregated.
    """
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").cast("long").alias("n"))
    ended = F.rtrim("text", F.lit(SPACES))
    rows = rows.withColumns({"blank": ended == "", "cut": ~F.substring(ended, -1, 1).isin(".", "!", "?")})
    # nulls first, as turns are ordered
    at = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    rows = rows.withColumn("said", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))
    repeats = (
        rows.where(~F.col("blank")).groupBy("conv_id", "said").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("turns"))
        .where("turns > 1").select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), "first")
    )
    rows = rows.join(repeats, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said")), "left")
    repeated = F.coalesce(F.col("first") < at, F.lit(False))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(".")
    return rows.select(
        "conv_id", "turn", "role", "text", "n",
        F.when(F.col("blank"), "blank").when(repeated, "duplicate").when(F.col("cut"), "truncated").alias("fault"),
        F.when(F.col("blank") | repeated, MUST_GO).when(F.col("cut"), F.upper(letter)).otherwise(letter).alias("code"),
    )


def search(codes: str, entry: int, closing: tuple[int, ...]) -> tuple[int, str, int]:
    """Least cost from ``entry`` through all rows, with the cost of the state behind them; its edits and that state."""
    n = len(codes)
    best_end = min(closing)
    least = [best_end]  # no edits of the rest cost less
    for code in reversed(codes):
        least.append(least[-1] + (DELETE if code == MUST_GO or code.isupper() else 0))
    least.reverse()
    bound = least[0]
    while bound < NEVER:
        beyond = NEVER
        failed: dict[tuple[int, int], int] = {}
        path: list[str] = []
        # frames: row, state, cost so far, edits left to try
        frames = [(0, entry, 0, iter(_edits(codes, 0, entry)))]
        while frames:
            i, state, cost, edits = frames[-1]
            if i == n:
                total = cost + closing[state]
                if total <= bound:
                    return total, "".join(path), state
                beyond = min(beyond, total)
                frames.pop()
                if path:
                    path.pop()
                continue
            for initial, step, j, after in edits:
                spent = cost + step
                if spent + least[j] > bound:
                    beyond = min(beyond, spent + least[j])
                elif failed.get((j, after), -1) < bound - spent:
                    path.append(initial)
                    frames.append((j, after, spent, iter(_edits(codes, j, after))))
                    break
            else:
                failed[i, state] = max(bound - cost, failed.get((i, state), -1))
                frames.pop()
                if path:
                    path.pop()
        bound = beyond
    return NEVER, "", entry


@lru_cache(maxsize=4096)
def _edits_of(code: str, state: int) -> tuple[tuple[str, int, int, int], ...]:
    """Edits before or of a row in ASCII order: initial, cost, rows consumed, next state."""
    out = [("D", DELETE, 1, state), ("I", INSERT, 0, AFTER_INSERT[state])]
    if code != MUST_GO:
        extra = CUT if code.isupper() else 0
        kept = KEPT.get((code.lower(), state))
        if kept is not None:
            out.append(("K", extra, 1, kept))
        out.append(("R", RENAME + extra, 1, AFTER_INSERT[state]))
    return tuple(out)


def _edits(codes: str, i: int, state: int) -> list[tuple[str, int, int, int]]:
    if i == len(codes):
        return []
    return [(initial, cost, i + rows, after) for initial, cost, rows, after in _edits_of(codes[i], state)]


@lru_cache(maxsize=1 << 16)
def whole(codes: str) -> tuple[int, str]:
    """Cost and edits of a conversation of these rows."""
    cost, edits, state = search(codes, START, CLOSING)
    return cost, edits + "I" * (CLOSING[state] // INSERT)


def costs_between(codes: str) -> list[int]:
    """The least cost from every state to every state, row by row of the 4 x 4 matrix.

    No edit leads back to the first two states, so only deletions stay in one, and one kept row leads from the first to the
    second; what ends after user or assistant is searched.
    """
    deleted = DELETE * len(codes)
    kept = min((CUT * code.isupper() for code in codes if code in "sS"), default=NEVER) - DELETE
    ends = {leave: tuple(0 if state == leave else NEVER for state in STATES) for leave in (USER, ASSISTANT)}
    out = []
    for entry in STATES:
        out.append(deleted if entry == START else NEVER)
        out.append(deleted if entry == SYSTEM else min(NEVER, deleted + kept) if entry == START else NEVER)
        out += [search(codes, entry, ends[leave])[0] for leave in (USER, ASSISTANT)]
    return out


def behind(costs: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    """The least cost from every state before a piece, given that from every state behind it."""
    return tuple(min(NEVER, min(costs[4 * a + b] + after[b] for b in STATES)) for a in STATES)


def _strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())


PIECE_SCHEMA = (
    "part int, piece long, codes string, faults string, roles array<string>, texts array<string>, turns array<long>"
)


def pieces(rows: DataFrame) -> DataFrame:
    """Runs of at most ``PIECE`` rows of a conversation in order of (turn, role, text), each with its place.

    The sort is over ranges, so that a conversation with a large share of all rows is spread over many tasks.  Copies of
    a row beyond the first have code x and carry no text, in runs that the faults string counts.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        group, open_conv, first = [], None, True

        def closed() -> pa.RecordBatch:
            codes, faults, roles, texts, turns = zip(*group, strict=True)
            return pa.RecordBatch.from_arrays([
                conv_type([open_conv]), pa.array([part], pa.int32()), pa.array([number], pa.int64()), _strings(["".join(codes)]),
                _strings(["".join(faults)]), pa.array([list(roles)], pa.list_(pa.string())),
                pa.array([list(texts)], pa.list_(pa.string())), pa.array([list(turns)], pa.list_(pa.int64())),
            ], names=["conv_id", "part", "piece", "codes", "faults", "roles", "texts", "turns"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            kind = batch.schema.field(0).type

            def conv_type(values: list, kind=kind) -> pa.Array:
                return pa.array(values, kind)

            for conv, turn, role, text, n, fault, code in zip(*columns, strict=True):
                if not first and conv != open_conv and group:
                    yield closed()
                    group, number = [], number + 1
                open_conv, first = conv, False
                mark = {"blank": "b", "duplicate": "d", "truncated": "t", None: "-"}[fault]
                for copy in range(n):
                    if copy:
                        code, mark, text = MUST_GO, "b" if mark == "b" else "d", ""
                    group.append((code, mark, role, text, turn))
                    if len(group) == PIECE:
                        yield closed()
                        group, number = [], number + 1
        if group:
            yield closed()

    ordered = rows.repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    conv = rows.schema["conv_id"].dataType.simpleString()
    return ordered.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "n", "fault", "code").mapInArrow(
        cut, f"conv_id {conv}, {PIECE_SCHEMA}")


def _per_row(of, names: dict[str, pa.DataType]):
    """A function of one row's values as a function of batches; all but the named columns go through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [of(*values) for values in zip(*[c.to_pylist() for c in batch.columns[3:]], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *[pa.array([m[i] for m in made], t) for i, t in enumerate(names.values())]],
                names=[*batch.schema.names[:3], *names])

    return run


def plans(cut: DataFrame) -> DataFrame:
    """For the pieces of conversations of several pieces: from every state before, cost, edits and state behind."""
    conv = cut.schema["conv_id"].dataType.simpleString()
    place = f"conv_id {conv}, part int, piece long"
    many = cut.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_pieces")).where("_pieces > 1").select(F.col("conv_id").alias("_conv"))
    of_many = cut.select("conv_id", "part", "piece", "codes").join(many, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    costs = of_many.mapInArrow(
        _per_row(lambda codes: (codes, costs_between(codes)), {"codes": pa.string(), "costs": pa.list_(pa.int64())}),
        f"{place}, codes string, costs array<long>")

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, after, first = None, CLOSING, True
        for batch in batches:
            ends = []
            for conv_id, costs_of in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if first or conv_id != last:
                    last, after, first = conv_id, CLOSING, False
                ends.append(list(after))
                after = behind(costs_of, after)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(ends, pa.list_(pa.int64()))],
                                             names=["conv_id", "part", "piece", "codes", "ends"])

    ends = costs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("piece")).mapInArrow(
        backward, f"{place}, codes string, ends array<long>")

    def planned(codes: str, ends_of: list[int]):
        found = [search(codes, entry, tuple(ends_of)) for entry in STATES]
        return [f[1] for f in found], [f[2] for f in found]

    return ends.mapInArrow(
        _per_row(planned, {"edits": pa.list_(pa.string()), "leave": pa.list_(pa.int32())}),
        f"{place}, edits array<string>, leave array<int>")


class Repaired:
    """One conversation as its pieces go by: counts, edits and the hash of the repaired text."""

    def __init__(self, conv_id):
        self.conv_id, self.state = conv_id, START
        self.low = self.high = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.last, self.audit, self.hash, self.any = None, [], hashlib.sha256(), False

    def say(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True

    def insert(self) -> None:
        self.state = AFTER_INSERT[self.state]
        self.cost += INSERT
        self.say("user" if self.state == USER else "assistant", "")

    def add(self, codes: str, faults: str, roles: list[str], texts: list[str], turns: list, edits: str, leave: int) -> None:
        for turn in turns:
            if turn is not None and turn != self.turn:
                self.low = turn if self.low is None else self.low
                self.turn = self.high = turn
                self.turns += 1
        self.blank += faults.count("b")
        self.duplicate += faults.count("d")
        self.truncated += faults.count("t")
        for role in roles:
            self.illegal += self.last is not None and self.last + role[:1] not in ("su", "ua", "au")
            self.last = role[:1]
        i = 0
        for edit in edits:
            if edit == "I":
                self.insert()
                continue
            if edit == "D":
                self.cost += DELETE
            else:
                self.cost += CUT * codes[i].isupper()
                if edit == "R":
                    self.state = AFTER_INSERT[self.state]
                    self.cost += RENAME
                    self.say("user" if self.state == USER else "assistant", texts[i])
                else:
                    self.state = KEPT[codes[i].lower(), self.state]
                    self.say(roles[i], texts[i])
            i += 1
        self.audit.append(edits)
        if self.state != leave:
            raise ValueError("the edits lead to another state than planned")

    def row(self) -> tuple:
        while CLOSING[self.state]:
            self.audit.append("I")
            self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit),
                self.hash.hexdigest())


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (as ``with_faults`` gives them): counts, cost, edits and the repaired text's hash."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    cut = keep(pieces(rows))
    planned = plans(cut)
    place = ["part", "piece"]
    joined = cut.join(planned.drop("conv_id"), place, "left")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def made() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * (len(COUNTS) + 3)
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:-2]], _strings(columns[-2]), _strings(columns[-1])],
                names=["conv_id", *COUNTS, "audit", "repaired_sha256"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv_id, codes, faults, roles, texts, turns, edits, leave in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = Repaired(conv_id)
                if edits is None:
                    _, path, state = search(codes, START, CLOSING)
                else:
                    path, state = edits[now.state], leave[now.state]
                now.add(codes, faults, roles, texts, turns, path, state)
            if done:
                yield made()
                done.clear()
        if now is not None:
            done.append(now.row())
            yield made()

    ordered = joined.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return ordered.select("conv_id", "codes", "faults", "roles", "texts", "turns", "edits", "leave").mapInArrow(
        walk, f"conv_id {conv}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


def _or(name: str, value: Column) -> Column:
    return F.coalesce(F.col(name), value).alias(name)


def repair_damaged(turns: DataFrame) -> DataFrame:
    """Damage of ``turns(conv_id, turn, role, text)`` and its cheapest repair, a row per conversation.

    Rows of a conversation are ordered by turn (nulls first), rows of one turn by role, then text.  The null conv_id is a
    conversation of its own; a null role or text is one space, so such a text is blank and such a role cannot stay.  Repeated
    rows are duplicates.  A conversation without rows after damage has zeros, no edits and the hash of the empty string.  An
    empty table gives an empty result; further columns are ignored.  The hash reads a conversation's pieces in order, one
    at a time: it takes one task per conversation, but not its memory.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    repaired = repair(with_faults(damage(turns))).withColumnRenamed("conv_id", "_conv")
    every = turns.select("conv_id").distinct()
    return every.join(repaired, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *[_or(c, F.lit(0).cast("long")) for c in COUNTS],
        _or("audit", F.lit("")), _or("repaired_sha256", F.lit(hashlib.sha256().hexdigest())),
    )
