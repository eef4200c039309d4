"""Repair of damaged conversations at least cost, by a run-length dynamic program.

A conversation is a sequence of symbols: initial of the role and fault of the row.  Equal consecutive symbols are one run.  What a
row of a symbol costs between two states of the grammar ``(s?(ua)+)?`` is a min-plus matrix; a run of n rows multiplies the vector
of remaining costs by the cached powers of two of that matrix.  Then the choices are unrolled, run by run, by halving.

Faults, the first that holds: blank (no character but white space), duplicate (role and text seen earlier), truncated (does not
end with ``.``, ``!`` or ``?``).  Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (the only edit of blank and duplicate
rows), Insert an empty user or assistant row 5; a truncated row that is not deleted adds 5.  Of the cheapest edits those whose
initials are least in ASCII order are taken.

Null roles and texts count as one space; rows without a conversation id form one conversation; null turns come first.  Rows of
equal turn are ordered by role and then by digest of role and text, so repeated rows are neighbours and all but one are
duplicates.  A conversation without rows (all marked as gone) has zeros and no edits; an empty table gives no rows.  Extra columns are
ignored.

Texts are dealt by conversation once, in order, and are read as a stream: what a task keeps of a conversation is one byte for each
row, as long as the result's own ``audit``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
RESULTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]
#: Initial of the role ("" for any other), and OK, TRUNCATED or GOES.
Symbol = tuple[str, int]
OK, TRUNCATED, GOES = range(3)
#: States: nothing yet, after a system row, after a user row, after an assistant row.
STATES, BEGIN, USER = range(4), 0, 2
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The only state that a new or renamed row can lead to, and the final states.
GIVEN, FINAL = (2, 2, 3, 2), (0, 3)
RENAME, DELETE, INSERT, MEND = 1, 2, 5, 5
FAR = 1 << 60


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def before(a: Matrix, v: Vector) -> Vector:
    """Remaining costs before a stretch with matrix ``a``, from those after it."""
    return tuple(min(x + y for x, y in zip(row, v)) for row in a)


def _inserts() -> Matrix:
    one = tuple(tuple(0 if i == j else INSERT if GIVEN[i] == j else FAR for j in STATES) for i in STATES)
    return times(times(one, one), times(one, one))


INSERTS = _inserts()
END: Vector = before(INSERTS, tuple(0 if i in FINAL else FAR for i in STATES))


def _row(symbol: Symbol) -> Matrix:
    """Costs of one row of this symbol, inserts before it included."""
    role, fault = symbol
    step = [[DELETE if i == j else FAR for j in STATES] for i in STATES]
    if fault != GOES:
        more = MEND if fault == TRUNCATED else 0
        for i in STATES:
            step[i][GIVEN[i]] = min(step[i][GIVEN[i]], RENAME + more)
            if (i, role) in NEXT:
                step[i][NEXT[i, role]] = min(step[i][NEXT[i, role]], more)
    return times(INSERTS, tuple(map(tuple, step)))


@lru_cache(maxsize=None)
def power(symbol: Symbol, k: int) -> Matrix:
    """The matrix of 2^k rows of one symbol; there are twelve symbols and at most 60 powers of each."""
    if k == 0:
        return _row(symbol)
    half = power(symbol, k - 1)
    return times(half, half)


def _after_each(symbol: Symbol, n: int, end: Vector) -> Iterator[Vector]:
    """Remaining costs after the first, second, … row of a run, by halving; no more than log2(n) vectors are held."""
    if n == 1:
        yield end
        return
    k = (n - 1).bit_length() - 1
    yield from _after_each(symbol, n - (1 << k), before(power(symbol, k), end))
    yield from _after_each(symbol, 1 << k, end)


def _unroll(runs: list[tuple[Symbol, int]], ends: list[Vector]) -> Iterator[str]:
    state = BEGIN
    for (symbol, n), end in zip(runs, ends):
        role, fault = symbol
        more = MEND if fault == TRUNCATED else 0
        for after in _after_each(symbol, n, end):
            now = before(power(symbol, 0), after)
            while True:
                # Tried in ASCII order; each edit leads to one state, so the first that is cheapest is right.
                if DELETE + after[state] == now[state]:
                    yield "D"
                    break
                if INSERT + now[GIVEN[state]] == now[state]:
                    yield "I"
                    state = GIVEN[state]
                    continue
                to = NEXT.get((state, role))
                if to is not None and more + after[to] == now[state]:
                    yield "K"
                else:
                    yield "R"
                    to = GIVEN[state]
                state = to
                break
    while state not in FINAL:
        yield "I"
        state = GIVEN[state]


def _plan(runs: Iterable[tuple[Symbol, int]]) -> tuple[int, str]:
    runs = list(runs)
    ends, left = [], END
    for symbol, n in reversed(runs):
        ends.append(left)
        for k in range(n.bit_length()):
            if n >> k & 1:
                left = before(power(symbol, k), left)
    return left[BEGIN], "".join(_unroll(runs, ends[::-1]))


_short_plan = lru_cache(maxsize=1 << 16)(_plan)


def plan(runs: list[tuple[Symbol, int]]) -> tuple[int, str]:
    """(least cost, initials of the edits) for the runs of a conversation."""
    return _short_plan(tuple(runs)) if len(runs) <= 32 else _plan(runs)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone): ``rows`` with faults planted by crc32(``conv:turn``) modulo 20; nulls count as one space.

    0: the row is gone; 1: its text is empty; 2: its text has no ``.``, ``!`` or ``?``; 3: it comes twice; 4: its role is user.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)])
    kind = F.crc32(key.cast("binary")) % 20
    said = F.coalesce(F.col(text), F.lit(" "))
    return rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _digest() -> Column:
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


def _symbols(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, gone, blank, open, late) in order of conversation; late: role and text are in a row of an earlier turn."""
    end = F.rtrim("text", F.lit(WHITE))
    small = rows.select(
        "conv", "turn", "role", "gone", _digest().alias("digest"),
        (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("open"),
    )
    # Grouped below the shuffle; only what occurs in several turns is left, and the join deals both sides anew, so a hot row can be split.
    again = small.filter("not gone").groupBy(F.struct("conv").alias("_conv"), F.col("digest").alias("_digest"))
    again = again.agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last")).filter("first < last")
    seen = small.join(again, (F.struct("conv") == F.col("_conv")) & (F.col("digest") == F.col("_digest")), "left")
    late = F.coalesce(F.struct("turn") > F.col("first"), F.lit(False))
    seen = seen.select("conv", "turn", "role", "digest", "gone", "blank", "open", late.alias("late"))
    return seen.repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest")


class _Conversation:
    """What is known of a conversation after its rows so far."""

    def __init__(self, conv) -> None:
        self.conv, self.runs, self.last, self.turns, self.low, self.high = conv, [], None, 0, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, digest: bytes, blank: bool, open_: bool, late: bool) -> None:
        if self.last is not None and self.last[1][:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        fault = OK
        if blank:
            self.blank, fault = self.blank + 1, GOES
        elif late or self.last == (turn, role, digest):
            self.duplicate, fault = self.duplicate + 1, GOES
        elif open_:
            self.truncated, fault = self.truncated + 1, TRUNCATED
        self.last = turn, role, digest
        symbol = role[:1] if role[:1] in ("s", "u", "a") else "", fault
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1] = symbol, self.runs[-1][1] + 1
        else:
            self.runs.append((symbol, 1))

    def result(self) -> tuple:
        cost, audit = plan(self.runs)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _batched(found: Iterator[tuple], schema: pa.Schema, rows: int = 4096, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Record batches of at most so many rows, and of about so many characters in their last column."""
    while True:
        part, taken = [], 0
        for row in islice(found, rows):
            part.append(row)
            taken += len(row[-1] or "")
            if taken > size:
                break
        if not part:
            return
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _mapped(rows: DataFrame, work: Callable[[Iterator[tuple]], Iterator[tuple]], columns: list[tuple[str, str]]) -> DataFrame:
    """Rows made from the rows of a partition, in order; the first column is the conversation."""
    arrow = {"long": pa.int64(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([("conv", first.schema.field(0).type), *((n, arrow[t]) for n, t in columns)])

        def everything() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        yield from _batched(work(_rows(everything())), schema)

    kind = rows.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"conv {kind}", *(f"{n} {t}" for n, t in columns)]))


def plans(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) from (conv, turn, role, text, gone); gone rows only keep their conversation."""

    def work(found: Iterator[tuple]) -> Iterator[tuple]:
        now = None
        for conv, turn, role, digest, gone, *faults in found:
            if now is None or now.conv != conv:
                if now is not None:
                    yield now.result()
                now = _Conversation(conv)
            if not gone:
                now.add(turn, role, digest, *faults)
        if now is not None:
            yield now.result()

    return _mapped(_symbols(rows), work, [(n, "long") for n in RESULTS] + [("audit", "string")])


def _replayed(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv, head, turn, role, digest, text, results): the rows of each conversation in order, after one with its plan as text."""
    none = [F.lit(None).cast("long").alias(n) for n in RESULTS]
    texts = rows.filter("not gone").select("conv", F.lit(1).alias("head"), "turn", "role", _digest().alias("digest"), "text", *none)
    empty = [F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in ("turn", "role", "digest")]
    heads = planned.select("conv", F.lit(0).alias("head"), *empty, F.col("audit").alias("text"), *RESULTS)
    return texts.unionByName(heads).repartition("conv").sortWithinPartitions("conv", "head", "turn", "role", "digest")


class _Replay:
    """Deals the edits of an audit to the rows of its conversation as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, BEGIN

    def _new(self, edit: str, text: str) -> tuple[str, str, str]:
        self.at, self.state = self.at + 1, GIVEN[self.state]
        return edit, "user" if self.state == USER else "assistant", text

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            yield self._new("I", "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the inserted rows before a row, and of the row itself."""
        yield from self.inserts()
        edit = self.audit[self.at]
        if edit == "R":
            yield self._new("R", text)
        else:
            self.at += 1
            if edit == "K":
                self.state = NEXT[self.state, role[:1]]
            yield edit, role, text


def edits(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """(conv, place, edit, role, text): each conversation after repair, with the deleted rows (edit D) in their places."""

    def work(found: Iterator[tuple]) -> Iterator[tuple]:
        replay, conv, place = None, None, 0

        def told(parts: Iterable[tuple[str, str, str]]) -> Iterator[tuple]:
            nonlocal place
            for part in parts:
                yield conv, place, *part
                place += 1

        for key, head, _, role, _, text, *_ in found:
            if head == 0:
                if replay is not None:
                    yield from told(replay.inserts())
                replay, conv, place = _Replay(text), key, 0
            else:
                yield from told(replay.row(role, text))
        if replay is not None:
            yield from told(replay.inserts())

    return _mapped(_replayed(rows, planned), work, [("place", "long"), ("edit", "string"), ("role", "string"), ("text", "string")])


def digests(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """The plans with repaired_sha256: of ``role:text`` of the rows that stay or are inserted, joined by line feeds."""

    def work(found: Iterator[tuple]) -> Iterator[tuple]:
        replay, plan_, sha, some = None, (), None, False

        def feed(parts: Iterable[tuple[str, str, str]]) -> None:
            nonlocal some
            for edit, role, text in parts:
                if edit != "D":
                    sha.update((("\n" if some else "") + f"{role}:{text}").encode())
                    some = True

        for key, head, _, role, _, text, *results in found:
            if head == 0:
                if replay is not None:
                    feed(replay.inserts())
                    yield *plan_, sha.hexdigest(), replay.audit
                replay, plan_, sha, some = _Replay(text), (key, *results), hashlib.sha256(), False
            else:
                feed(replay.row(role, text))
        if replay is not None:
            feed(replay.inserts())
            yield *plan_, sha.hexdigest(), replay.audit

    columns = [(n, "long") for n in RESULTS] + [("repaired_sha256", "string"), ("audit", "string")]
    return _mapped(_replayed(rows, planned), work, columns)
