"""Conversation repair against exhaustive search over edit lists."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import conversation_repair as cr
from gaugeworks.llm import queries

from ..conftest import SF_SMALL

LEGAL = re.compile(r"(s?(ua)+)?")
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    """First fault of each (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        if not text.strip(WHITE):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        elif text.rstrip(WHITE)[-1] not in ".!?":
            out.append("truncated")
        else:
            out.append("")
        seen.add((role, text))
    return out


def exhaustive(rows):
    """(cost, audit, lines) by trying every list of edits with at most two
    inserts in a gap."""
    marks = faults(rows)
    best = None

    def go(i, cost, audit, roles, lines, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows):
            if LEGAL.fullmatch(roles):
                found = (cost, audit, lines)
                if best is None or found[:2] < best[:2]:
                    best = found
        else:
            _, role, text = rows[i]
            go(i + 1, cost + 2, audit + "D", roles, lines, 0)
            if marks[i] not in ("blank", "duplicate"):
                more = 5 if marks[i] == "truncated" else 0
                go(i + 1, cost + more, audit + "K", roles + (role[:1] or "?"), lines + [f"{role}:{text}"], 0)
                for r in ("user", "assistant"):
                    go(i + 1, cost + 1 + more, audit + "R", roles + r[0], lines + [f"{r}:{text}"], 0)
        if inserts < 2:
            for r in ("user", "assistant"):
                go(i, cost + 5, audit + "I", roles + r[0], lines + [f"{r}:"], inserts + 1)

    go(0, 0, "", "", [], 0)
    return best


def conversation(rnd, n):
    texts = ["a.", "b!", "c", "d?", "", " \n", "e. \t", "long one"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "Sys", "uma"]
    return [(i, rnd.choice(roles), rnd.choice(texts)) for i in range(n)]


def by_paths(rows):
    path = cr.EditPaths(0)
    for (_, role, _), fault in zip(rows, faults(rows)):
        path.read_turn(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
    cost, audit = cr.best_end(path.exits())
    edits, lines = cr.Repaired(audit), []
    for _, role, text in rows:
        lines += [f"{r}:{t}" for r, t in edits.turn(role, text)]
    return cost, audit, lines + [f"{r}:{t}" for r, t in edits.turn(None, None)]


def test_paths_equal_exhaustive_search():
    rnd = random.Random(11)
    for n in (0, 1, 2, 3, 4, 5, 6):
        for _ in range(60 if n < 6 else 15):
            rows = conversation(rnd, n)
            assert by_paths(rows) == exhaustive(rows), rows


def test_blocks_do_not_change_the_least_path(monkeypatch):
    rnd = random.Random(12)
    cases = [conversation(rnd, n) for n in (5, 40, 300) for _ in range(10)]
    whole = []
    monkeypatch.setattr(cr, "BLOCK", 1000)
    whole = [by_paths(rows) for rows in cases]
    for block in (1, 2, 7):
        monkeypatch.setattr(cr, "BLOCK", block)
        assert [by_paths(rows) for rows in cases] == whole


def expected(rows):
    """The contract's row of one conversation, turns in order."""
    marks = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, lines = exhaustive(rows) if len(rows) <= 6 else by_paths(rows)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *[marks.count(x) for x in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def check(found, conversations):
    got = {r["conv"]: r for r in found}
    assert set(got) == set(conversations)
    for conv, rows in conversations.items():
        assert tuple(got[conv][c] for c in COLUMNS) == expected(ordered(rows)), conv


@pytest.mark.parametrize("inline_bytes", [cr.INLINE_BYTES, 0])
def test_operator_over_odd_rows_and_many_partitions(spark, inline_bytes):
    rnd = random.Random(13)
    data = {}
    for conv in (None, *range(60)):
        rows = conversation(rnd, rnd.randint(1, 6))
        if conv is None or conv % 5 == 0:
            rows = [(rnd.choice([None, 0, 1, 9]), r, t) for _, r, t in rows]
        data[conv] = rows + rows[:1]
    data[7] = [(i // 2, "user" if i % 2 else "assistant", f"t{i % 50}.") for i in range(700)]  # a hot one
    table = [(c, *row, "x", 1) for c, rows in data.items() for row in rows]
    rnd.shuffle(table)
    frame = spark.createDataFrame(table, "conv_id long, turn long, role string, text string, conv string, copies int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = cr.repair_conversations(frame, inline_bytes=inline_bytes).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    check(found, data)
    for r in found:
        if inline_bytes:
            text = "\n".join(f"{t.role}:{t.text}" for t in r.repaired)
            assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256


def test_nulls_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame([(1, None, None, "x."), (1, None, None, None), (2, 3, "user", None)], schema)
    found = cr.repair_conversations(frame).collect()
    check(found, {1: [(None, " ", "x."), (None, " ", " ")], 2: [(3, "user", " ")]})
    assert cr.repair_conversations(spark.createDataFrame([], schema)).count() == 0


def damage(rows):
    """The damage of the query, by hand."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.op11_conversation_repair(spark, SF_SMALL).withColumnRenamed("conv_id", "conv")
    check(found.collect(), damage(rows))


def test_conversation_without_rows_after_damage(spark, tmpdir_new):
    gone = next(i for i in range(10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "x."), (None, None, "user", "y.")], "conv_id long, turn long, role string, text string")
    frame.write.parquet(f"{tmpdir_new}/conversations.parquet")
    found = {r.conv_id: r for r in queries.op11_conversation_repair(spark, tmpdir_new).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(found[gone][c] for c in COLUMNS) == (0, 0, 0, 0, 0, 0, "", empty)
    assert set(found) == {gone, None}


def test_one_row_repeated_many_times(spark):
    frame = spark.range(3000).select(F.lit(5).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("x.").alias("text"))
    (row,) = cr.repair_conversations(frame).collect()
    assert (row.duplicate, row.cost, row.audit) == (2999, 6000, "D" * 3000)
    assert row.repaired == []
