"""Conversation structure repair by scalar big-integer weights.

The turns of a conversation, in order, are edited at least cost until the
initials of their roles read ``(s?(ua)+)?``: keep a turn (0, and 5 if its
text is truncated), give it the role user or assistant (1, and 5 if
truncated), delete it (2; blank and duplicate turns must go), insert an
empty user or assistant turn (5).  Of the cheapest edit lists the one whose
audit (initials of the edits in order) is least in ASCII order is taken.

Every path through the edit graph has one integer weight: high digits hold
the cost, below them stand ``width`` positions of ``DIGIT_BITS`` bits, one an
audit letter in order, zeros behind the last.  A plain integer minimum per
(turns read, state) therefore decides cost and ties at once.  It is exact:
letters fix which turns they read and what they cost, so two paths to one
node that cost the same can never have one audit that begins the other.

A conversation of any length is read in order and in bounded memory: every
``BLOCK`` turns the letters that the paths to all four states share are put
away and the weights start anew.

Plan: turns equal in all columns are collapsed to one row with a count
(partial aggregation, so a repeated row is never a hot key), the first
occurrence of each (role, text) comes from an aggregate and a join, then
rows are dealt by *range* of (conversation, turn, role, text): a
conversation with a third of all rows lies in many tasks.  A task repairs the
conversations inside it; of those at its edges, and of those larger than
``inline_bytes``, it gives the least weight from every entry state to every
exit state, and these tables are chained in order.  Only the SHA-256 of such
a conversation is read by one task, as a stream: it has no parallel form.

Defined cases: a NULL role or text is one space (so the turn is blank, or
has no legal initial); NULL turns come first; a NULL conversation id is a
conversation of its own; turns that tie are ordered by role, then text;
repeated rows are duplicate turns; an empty table gives no rows; other
columns never matter, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, drop_written, written

#: Audit letters in ASCII order; digit 0 is the padding behind the end.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = " DIKR"
DIGIT_BITS = 3
#: Turns after which shared letters are put away; bounds the integers.
BLOCK = 128
#: A conversation with more bytes is chained and hashed as a stream.
INLINE_BYTES = 16 << 20

RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: States: nothing yet, after ``s``, after ``u``, after ``ua``.
STATES = (0, 1, 2, 3)
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: States that an inserted (or renamed) turn leads to.
GIVEN = {q: tuple(NEXT[q, x] for x in "ua" if (q, x) in NEXT) for q in STATES}
LEGAL_PAIRS = ("su", "ua", "au")
WHITE = " \t\n\x0b\x0c\r"

Path = tuple[int, str]


class EditPaths:
    """Least weights from one entry state to all states, turn by turn."""

    def __init__(self, entry: int):
        self.done: list[str] = []
        self.tails: dict[int, Path] = {entry: (0, "")}
        self._open()

    def _open(self) -> None:
        # a block has at most BLOCK turns with two inserts before each, and the tails
        self.width = 3 * BLOCK + 4 + max(len(a) for _, a in self.tails.values())
        self.shift = DIGIT_BITS * self.width
        self.read = 0
        self.best = {}
        for q, (cost, audit) in self.tails.items():
            weight = cost << self.shift
            for at, letter in enumerate(audit):
                weight += self._step(0, letter, at)
            self.best[q] = (weight, len(audit))
        self._insert()

    def _step(self, cost: int, letter: str, at: int) -> int:
        return (cost << self.shift) + (DIGIT[letter] << DIGIT_BITS * (self.width - 1 - at))

    def _insert(self) -> None:
        # from any state at most two inserts lead to a new one
        for _ in range(2):
            for q, (weight, at) in list(self.best.items()):
                for to in GIVEN[q]:
                    path = (weight + self._step(INSERT, "I", at), at + 1)
                    if to not in self.best or path < self.best[to]:
                        self.best[to] = path

    def read_turn(self, initial: str, must_go: bool, truncated: bool) -> None:
        if self.read == BLOCK:
            self._close()
            self._open()
        self.read += 1
        after: dict[int, tuple[int, int]] = {}

        def offer(to: int, path: tuple[int, int]) -> None:
            if to not in after or path < after[to]:
                after[to] = path

        extra = TRUNCATED if truncated else 0
        for q, (weight, at) in self.best.items():
            offer(q, (weight + self._step(DELETE, "D", at), at + 1))
            if must_go:
                continue
            if (q, initial) in NEXT:
                offer(NEXT[q, initial], (weight + self._step(extra, "K", at), at + 1))
            for to in GIVEN[q]:
                offer(to, (weight + self._step(RENAME + extra, "R", at), at + 1))
        self.best = after
        self._insert()

    def _close(self) -> None:
        """Weights back to (cost, audit); shared first letters are put away."""
        mask = (1 << DIGIT_BITS) - 1
        tails = {}
        for q, (weight, length) in self.best.items():
            digits = (weight >> DIGIT_BITS * (self.width - 1 - at) & mask for at in range(length))
            tails[q] = (weight >> self.shift, "".join(LETTER[d] for d in digits))
        self.tails = put_away(self.done, tails)

    def exits(self) -> dict[int, Path]:
        """(cost, audit) of the least path to every state that can be reached."""
        self._close()
        start = "".join(self.done)
        out = {q: (c, start + a) for q, (c, a) in self.tails.items()}
        self._open()
        return out


def put_away(done: list[str], tails: dict[int, Path]) -> dict[int, Path]:
    """Move the letters with which all audits begin to ``done``."""
    shared = commonprefix([a for _, a in tails.values()])
    if shared:
        done.append(shared)
    return {q: (c, a[len(shared) :]) for q, (c, a) in tails.items()}


def best_end(exits: dict[int, Path]) -> Path:
    """The cheaper of the two states in which a conversation may end."""
    return min(exits[q] for q in (0, 3) if q in exits)


class Repaired:
    """Applies an audit to turns read in order: repaired (role, text) pairs.

    The number of turns that stay decides whether the first is ``s``; user and
    assistant alternate behind it."""

    def __init__(self, audit: str):
        self.letters = iter(audit)
        self.odd = sum(map(audit.count, "KRI")) % 2
        self.out = 0

    def _role(self) -> str:
        return "user" if (self.out - self.odd) % 2 == 0 else "assistant"

    def turn(self, role: str | None, text: str | None) -> Iterator[tuple[str, str]]:
        """What stands for the next turn; with ``None`` the inserts at the end."""
        for letter in self.letters:
            if letter == "D":
                return
            if letter == "K":
                yield role, text
            elif letter == "R":
                yield self._role(), text
            else:
                yield self._role(), ""
            self.out += 1
            if letter != "I":
                return


class Lines:
    """SHA-256 of ``role:text`` lines joined by newlines."""

    def __init__(self):
        self.hash = hashlib.sha256()
        self.first = True

    def add(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False


# --- rows ---------------------------------------------------------------


def turn_rows(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with the faults of their first copy, equal ones collapsed:
    ``conv, turn, role, text, copies, fault``."""
    space = F.lit(" ")
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("role"),
        F.coalesce(F.col(text).cast("string"), space).alias("text"),
    )
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("same", F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256))
    # NULL turns are first, and a struct of (is set, turn) has that order
    when = F.struct(F.col("turn").isNotNull().alias("is_set"), F.coalesce("turn", F.lit(0)).alias("at"))
    firsts = rows.groupBy(F.col("conv").alias("f_conv"), F.col("same").alias("f_same")).agg(F.min(when).alias("first"))
    rows = rows.join(firsts, F.col("conv").eqNullSafe(F.col("f_conv")) & (F.col("same") == F.col("f_same")))
    last = F.right(F.rtrim(F.col("text"), F.lit(WHITE)), F.lit(1))
    fault = (
        F.when(~F.col("text").rlike(WORD_PATTERN), F.lit("blank"))
        .when(when != F.col("first"), F.lit("duplicate"))
        .when(~last.isin(".", "!", "?"), F.lit("truncated"))
        .otherwise(F.lit(""))
    )
    return rows.select("conv", "turn", "role", "text", "copies", fault.alias("fault"))


def _sorted_by(*names: str) -> list[Column]:
    return [F.asc_nulls_first(n) for n in names]


_STATS = (
    "min_turn bigint, max_turn bigint, n_turns bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first_initial string, last_initial string"
)
_STAT_NAMES = [f.split()[0] for f in _STATS.split(", ")]


class Stats:
    """Counts over turns read in order; two adjacent runs can be joined."""

    def __init__(self):
        self.min_turn = self.max_turn = self.first_initial = self.last_initial = None
        self.n_turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def read_turn(self, turn: int | None, initial: str, fault: str) -> None:
        one = Stats()
        one.min_turn = one.max_turn = turn
        one.n_turns = int(turn is not None)
        one.first_initial = one.last_initial = initial
        if fault:
            setattr(one, fault, 1)
        self.join(one)

    def join(self, other: Stats) -> None:
        if self.first_initial is None:
            self.first_initial = other.first_initial
        elif self.last_initial + other.first_initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.n_turns += other.n_turns - int(other.min_turn is not None and other.min_turn == self.max_turn)
        if self.min_turn is None:
            self.min_turn = other.min_turn
        if other.max_turn is not None:
            self.max_turn = other.max_turn
        self.last_initial = other.last_initial
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(other, name))

    def row(self) -> dict:
        return {n: getattr(self, n) for n in _STAT_NAMES}

    @classmethod
    def of(cls, row: dict) -> Stats:
        out = cls()
        for n in _STAT_NAMES:
            setattr(out, n, row[n])
        return out


_TURN = "struct<role:string,text:string>"
_PATH = "struct<entry:int,exit:int,cost:bigint,audit:string>"


def _segment_schema(conv_type: str) -> str:
    return (
        f"conv {conv_type}, part int, whole boolean, {_STATS}, cost bigint, audit string, sha256 string, "
        f"repaired array<{_TURN}>, paths array<{_PATH}>"
    )


def _arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _batches(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _turns_of(batches: Iterator[pa.RecordBatch], step: int = 512) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield from batch.slice(at, step).to_pylist()


class _Open:
    """The conversation being read by a task."""

    def __init__(self, conv, part: int, maybe_continued: bool):
        self.conv, self.part, self.edge = conv, part, maybe_continued
        self.paths = {q: EditPaths(q) for q in (STATES if maybe_continued else (0,))}
        self.stats = Stats()
        self.turns: list[tuple[str, str, int]] = []
        self.bytes = 0

    def read(self, row: dict, inline_bytes: int) -> None:
        initial = row["role"][:1]
        fault = row["fault"]
        for copy in range(row["copies"]):
            if copy and fault != "blank":
                fault = "duplicate"
            self.stats.read_turn(row["turn"], initial, fault)
            for path in self.paths.values():
                path.read_turn(initial, fault in ("blank", "duplicate"), fault == "truncated")
        if self.edge:
            return
        self.turns.append((row["role"], row["text"], row["copies"]))
        self.bytes += len(row["role"]) + len(row["text"]) + row["copies"]
        if self.bytes > inline_bytes:
            self.edge, self.turns = True, []

    def row(self, edge: bool) -> dict:
        head = {"conv": self.conv, "part": self.part, "whole": not (edge or self.edge), **self.stats.row()}
        if not head["whole"]:
            paths = [
                {"entry": e, "exit": x, "cost": c, "audit": a}
                for e, p in self.paths.items()
                for x, (c, a) in p.exits().items()
            ]
            return head | {"cost": None, "audit": None, "sha256": None, "repaired": None, "paths": paths}
        cost, audit = best_end(self.paths[0].exits())
        edits, lines, repaired = Repaired(audit), Lines(), []
        for role, text, copies in self.turns:
            for _ in range(copies):
                repaired.extend(edits.turn(role, text))
        repaired.extend(edits.turn(None, None))
        for pair in repaired:
            lines.add(*pair)
        turns = [{"role": r, "text": t} for r, t in repaired]
        return head | {"cost": cost, "audit": audit, "sha256": lines.hash.hexdigest(), "repaired": turns, "paths": None}


def _segments(rows: DataFrame, conv_type: str, inline_bytes: int) -> DataFrame:
    """Whole conversations, repaired, and the least paths of pieces at the
    edges of tasks."""
    ddl = _segment_schema(conv_type)
    schema = _arrow_schema(rows.sparkSession, ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        now: _Open | None = None
        out, size = [], 0
        for row in _turns_of(batches):
            if now is None or row["conv"] != now.conv:
                if now is not None:
                    out.append(now.row(edge=False))
                    size += now.bytes
                    if len(out) >= 1000 or size > 4 << 20:
                        yield from _batches(out, schema)
                        out, size = [], 0
                now = _Open(row["conv"], part, maybe_continued=now is None)
            now.read(row, inline_bytes)
        if now is not None:
            out.append(now.row(edge=True))
        yield from _batches(out, schema)

    dealt = rows.repartitionByRange(*_sorted_by("conv", "turn", "role", "text"))
    return dealt.sortWithinPartitions(*_sorted_by("conv", "turn", "role", "text")).mapInArrow(work, ddl)


_SUMMARY = f"{_STATS}, cost bigint, audit string"


def _chained(segments: DataFrame, conv_type: str) -> DataFrame:
    """Pieces of one conversation, joined in order through their tables."""
    ddl = f"conv {conv_type}, {_SUMMARY}"
    schema = _arrow_schema(segments.sparkSession, ddl)

    def finish(conv, stats: Stats, done: list[str], tails: dict[int, Path]) -> dict:
        cost, tail = best_end(tails)
        return {"conv": conv, **stats.row(), "cost": cost, "audit": "".join(done) + tail}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, stats, done, tails = None, None, [], {}
        for row in _turns_of(batches, 1):
            if stats is None or row["conv"] != conv:
                if stats is not None:
                    yield from _batches([finish(conv, stats, done, tails)], schema)
                conv, stats, done, tails = row["conv"], Stats.of(row), [], {0: (0, "")}
            else:
                stats.join(Stats.of(row))
            after: dict[int, Path] = {}
            for p in row["paths"]:
                if p["entry"] in tails:
                    cost, audit = tails[p["entry"]]
                    path = (cost + p["cost"], audit + p["audit"])
                    if p["exit"] not in after or path < after[p["exit"]]:
                        after[p["exit"]] = path
            tails = put_away(done, after)
        if stats is not None:
            yield from _batches([finish(conv, stats, done, tails)], schema)

    dealt = segments.select("conv", "part", *_STAT_NAMES, "paths").repartition("conv")
    return dealt.sortWithinPartitions(*_sorted_by("conv", "part")).mapInArrow(work, ddl)


def _streamed(rows: DataFrame, audits: DataFrame, conv_type: str, inline_bytes: int) -> DataFrame:
    """Digest (and, up to ``inline_bytes``, the turns) of the conversations
    in ``audits``; reads each as a stream behind its audit."""
    ddl = f"conv {conv_type}, sha256 string, repaired array<{_TURN}>"
    schema = _arrow_schema(rows.sparkSession, ddl)
    ids = audits.select(F.col("conv").alias("c"))
    mine = rows.join(ids, F.col("conv").eqNullSafe(F.col("c")), "left_semi")
    heads = audits.select(
        "conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).alias("copies")
    )
    both = heads.withColumn("kind", F.lit(0)).unionByName(
        mine.select("conv", "turn", "role", "text", "copies").withColumn("kind", F.lit(1))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = edits = lines = turns = None
        size = 0

        def keep(pairs) -> None:
            nonlocal turns, size
            for role, text in pairs:
                lines.add(role, text)
                size += len(role) + len(text) + 1
                if turns is not None:
                    turns.append({"role": role, "text": text})
                if size > inline_bytes:
                    turns = None

        def finish() -> Iterator[pa.RecordBatch]:
            keep(edits.turn(None, None))
            yield from _batches([{"conv": conv, "sha256": lines.hash.hexdigest(), "repaired": turns}], schema)

        for row in _turns_of(batches):
            if row["kind"] == 0:
                if edits is not None:
                    yield from finish()
                conv, edits, lines, turns, size = row["conv"], Repaired(row["text"]), Lines(), [], 0
                continue
            for _ in range(row["copies"]):
                keep(edits.turn(row["role"], row["text"]))
        if edits is not None:
            yield from finish()

    order = _sorted_by("conv", "kind", "turn", "role", "text")
    return both.repartition("conv").sortWithinPartitions(*order).mapInArrow(work, ddl)


def repair_conversations(
    turns: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    inline_bytes: int = INLINE_BYTES,
) -> DataFrame:
    """One row a conversation: ``conv, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256`` and ``repaired``, the repaired
    turns in order (NULL where they hold more than ``inline_bytes``
    characters; their digest is always there).  ``gaps`` are the missing
    numbers between the least and the greatest turn.

    The result is a table in the shared folder."""
    conv_type = turns.schema[conv_col].dataType.simpleString()
    rows = written(turn_rows(turns, conv_col, turn_col, role_col, text_col), "turns")
    segments = written(_segments(rows, conv_type, inline_bytes), "segments")
    chained = written(_chained(segments.where("NOT whole"), conv_type), "chained")
    digests = _streamed(rows, chained, conv_type, inline_bytes).withColumnRenamed("conv", "c")
    large = chained.join(digests, F.col("conv").eqNullSafe(F.col("c")))
    columns = ["conv", *_STAT_NAMES, "cost", "audit", "sha256", "repaired"]
    both = segments.where("whole").select(*columns).unionByName(large.select(*columns))
    out = written(
        both.select(
            "conv",
            F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps"),
            *("blank", "duplicate", "truncated", "illegal", "cost", "audit"),
            F.col("sha256").alias("repaired_sha256"),
            "repaired",
        ),
        "repaired",
    )
    for inner in (rows, segments, chained):
        drop_written(inner)
    return out


# --- the damage of the registered query --------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by ``crc32("conv_id:turn") % 20``:
    0 drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it,
    4 makes it a user turn.  NULLs count as one space."""
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    ).where("fault != 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.lit(2)).otherwise(F.lit(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times))).drop(
        "col"
    )
