"""Searches equal dynamic programming over all edits; conversations in pieces equal whole ones; odd input."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from assay.llm import conversation_repair as repair
from assay.llm.conversation_repair import ASSISTANT, BY_INITIAL, LEGAL, START, STATES, Search, alternate


def cheapest(rows, start, end):
    """Least (cost, edits) by trying all edits of each row on all least prefixes."""

    def widened(best):
        for _ in range(3):
            for state, (cost, edits) in list(best.items()):
                new = (cost + 2, edits + "I")
                if new < best.get(alternate(state), (10**9, "")):
                    best[alternate(state)] = new
        return best

    best = {start: (0, "")}
    for initial, fault in rows:
        extra = int(fault == "truncated")
        new = {}
        for state, (cost, edits) in widened(dict(best)).items():
            ways = [(state, cost + 3, "D")]
            if fault not in ("blank", "duplicate"):
                if (state, BY_INITIAL.get(initial)) in LEGAL:
                    ways.append((BY_INITIAL[initial], cost + extra, "K"))
                ways.append((alternate(state), cost + 2 + extra, "R"))
            for to, price, edit in ways:
                new[to] = min(new.get(to, (10**9, "")), (price, edits + edit))
        best = new
    if end is None:
        best = {q: v for q, v in widened(best).items() if q in (START, ASSISTANT)}
        return min(best.values())
    return best.get(end)


def random_rows(rng, most):
    roles = rng.choice(["sua", "uuua", "ua", "uatx", "s", "u", "uuaa", "saus "])
    faults = rng.choice([[None], [None, None, "truncated"], [None, "blank", "duplicate", "truncated"], ["blank"]])
    return [(rng.choice(roles), rng.choice(faults)) for _ in range(rng.randint(0, most))]


def test_search_equals_dynamic_programming():
    rng = random.Random(3)
    for n in range(1500):
        rows = random_rows(rng, 7 if n % 10 else 64)
        assert Search(rows, START, None).run() == cheapest(rows, START, None), rows


def test_search_between_all_states():
    rng = random.Random(4)
    for _ in range(300):
        rows = random_rows(rng, 8)
        for start in STATES:
            for end in STATES:
                assert Search(rows, start, end).run() == cheapest(rows, start, end), (rows, start, end)


def test_bound_is_never_too_high():
    rng = random.Random(5)
    for _ in range(1000):
        rows = random_rows(rng, 8)
        for start in STATES:
            assert Search(rows, start, None).least(0, start) <= cheapest(rows, start, None)[0]


def sql_rows(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/conversations.parquet/*.parquet')")
    result = con.execute(repair.SQL["op13_conversation_repair"])
    names = [d[0] for d in result.description]
    return sorted((dict(zip(names, row)) for row in result.fetchall()), key=str)


def conversations(seed, sizes):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t", "Why?  ", "word " * 40 + ".", "\x0b.", "…", "a.b"]
    for conv_id, size in sizes:
        for turn in range(size):
            at = rng.choice([turn, turn, turn, turn + 1, 3, None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "unit", "system"])
            yield conv_id, at, role, rng.choice([*texts, None]) or rng.choice(texts) + str(turn), "x", "y", 1


SCHEMA = "conv_id long, turn long, role string, text string, cost string, part string, `a.b` int"


@pytest.mark.parametrize("piece_rows", [32, 3])
def test_query_equals_sql_on_odd_rows(spark, tmp_path, monkeypatch, piece_rows):
    """Nulls everywhere, ties, long conversations, other columns; searched whole or in small pieces."""
    monkeypatch.setattr(repair, "PIECE_ROWS", piece_rows)
    sizes = [(i, i % 9 + 1) for i in range(120)] + [(None, 9), (1000, 150)]
    rows = list(conversations(piece_rows, sizes))
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.repartition(5, "turn").write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted((r.asDict() for r in repair.op13_conversation_repair(spark, str(tmp_path)).collect()), key=str)
    assert [sorted(r.items()) for r in got] == [sorted(r.items()) for r in sql_rows(tmp_path)]


def test_repaired_turns_are_lawful(spark):
    rows = spark.createDataFrame(list(conversations(8, [(1, 5), (2, 200), (3, 30)])), SCHEMA)
    edits = repair.repaired_turns(repair.repair(rows)).orderBy("part", "piece", "step").collect()
    by = {}
    for row in edits:
        if row.edit != "D":
            by.setdefault(row.conv_id, []).append(row)
    for turns in by.values():
        state = START
        for row in turns:
            after = BY_INITIAL[row.role[0]]
            assert (state, after) in LEGAL
            state = after
            assert row.edit != "I" or (row.text == "" and row.turn is None)
        assert state == ASSISTANT
    kept = sum(row.edit != "I" for row in edits)
    assert kept == rows.count()


def test_only_dropped_rows_and_no_rows(spark):
    rows = spark.createDataFrame([(7, 0, "user", "Hi."), (8, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    told = repair.reports(repair.repair(rows, F.col("conv_id") == 8)).collect()
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert [tuple(r) for r in told if r.conv_id == 7] == [(7, 0, 0, 0, 0, 0, 0, "", empty)]
    assert [r.audit for r in told if r.conv_id == 8] == ["KI"]
    none = rows.limit(0)
    assert repair.reports(repair.repair(none)).collect() == []
    assert repair.repaired_turns(repair.repair(none)).collect() == []
