"""Rules out of the event log, and rules that meet values they cannot be computed for."""

import pytest

from assay.operators.rule_book import assess_registered, compile_rules, placed_rules
from assay.operators.rules import Rule, assessment_run, run_rules, sample_violations
from assay.operators.tolerant import tolerant
from tests.conftest import executed

EVENT = (
    "event_id long, ts timestamp_ntz, action string, config_key string, rule_id string, table_name string,"
    " column_name string, severity string, category string, description string, predicate string, on_null string,"
    " polarity string"
)


def event(i, action, key, column=None, predicate=None, on_null=None, polarity=None, table="people"):
    ts = f"2024-01-01 00:00:{i:02d}"
    rule = key and key.split("_")[0]
    return (i, ts, action, key, rule, table, column, "High", "cat", f"{rule} text", predicate, on_null, polarity)


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "17", 1.0, "2020-01-01"), (2, "x", None, "bad"), (3, None, 0.0, None), (4, "40", 4.0, "2021-01-01")]
    return spark.createDataFrame(rows, "id int, age string, pay double, `day of` string")


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        event(1, "save", "r1_a", "pay", "column_name > 0"),
        event(2, "save", "r1_a", "pay", "column_name > 0", "violation", "pass"),
        event(3, "save", "r2_a", "*", "column_name IS NULL"),
        event(4, "save", "r3_a", "*string", "length(column_name) > 3"),
        event(5, "save", "r4_a", "age", "column_name < 18"),
        event(6, "save", "r5_a", "gone", "column_name < 18"),
        event(7, "save", "r6_a", "pay", "  "),
        event(8, "save", "r7_a", "pay", "column_name < 1", "perhaps"),
        event(9, "save", "r8_a", "pay", "column_name < 1", None, "maybe"),
        event(10, "save", "r9_a", "pay", "column_name < 1"),
        event(11, "deactivate", "r9_a"),
        event(12, "save", "r10_a", "pay", "column_name < 1", table="other"),
        event(13, "save", "r11_a", "day of", "column_name ="),
    ]
    frame = spark.createDataFrame([(r[0], None, *r[2:]) for r in rows], EVENT)
    return frame.withColumn("ts", frame.event_id.cast("timestamp").cast("timestamp_ntz"))


def test_rules_are_placed_on_the_columns_they_name(events, people):
    compiled = compile_rules(events, "people", people)
    placed = {(r.rule_id, r.column_name) for r in compiled.rules}
    assert placed == {
        ("r1", "pay"), ("r4", "age"), ("r11", "day of"),
        *(("r2", c) for c in people.columns), ("r3", "age"), ("r3", "day of"),
    }
    assert {(r.rule_id, fault) for r, fault in compiled.faults} == {
        ("r5", "no such column: gone"),
        ("r6", "no predicate"),
        ("r7", "unknown on_null: perhaps"),
        ("r8", "unknown polarity: maybe"),
    }
    assert placed_rules(events.limit(0), {"people": people}).count() == 0


def test_assessment_by_the_event_log_alone(events, people):
    result = {(r.name, r.column_name): r for r in assess_registered(events, "people", people).where("section = 'rules'").collect()}
    assert len(result) == 13
    # Polarity pass: 0.0 fails, and so does the unknown outcome.
    assert result["r1", "pay"].value == 2 and result["r1", "pay"].success is False
    assert [result["r2", c].value for c in people.columns] == [0, 1, 1, 1]
    assert result["r3", "day of"].value == 2 and result["r3", "age"].success is True
    assert "cannot be computed for 1 rows" in result["r4", "age"].error and result["r4", "age"].value is None
    assert "no such column" in result["r5", "gone"].error and result["r5", "gone"].success is False
    assert result["r11", "day of"].error is not None
    only = assess_registered(events, "people", people, column="pay").where("section = 'rules'").collect()
    assert {r.name for r in only} == {"r1", "r2", "r6", "r7", "r8"}


def test_a_failing_rule_leaves_the_others_alone_in_one_scan(spark, people, tmp_path):
    people.write.parquet(f"{tmp_path}/people")
    stored = spark.read.parquet(f"{tmp_path}/people")
    sound = [Rule("low", "column_name < 1", "pay"), Rule("none", "column_name IS NULL", "age")]
    failing = [Rule("cast", "column_name > 18", "age"), Rule("div", "id / column_name > 1", "pay")]
    alone = {r.rule_id: tuple(r) for r in run_rules(stored, sound).collect()}
    both = run_rules(stored, [*failing, *sound])
    assert executed(both).count("FileScan") == 1
    rows = {r.rule_id: r for r in both.collect()}
    assert {k: tuple(rows[k]) for k in alone} == alone
    assert [rows[k].error for k in ("cast", "div")] == [
        "CAST_INVALID_INPUT: cannot be computed for 1 rows",
        "DIVIDE_BY_ZERO: cannot be computed for 1 rows",
    ]
    assert rows["cast"].violations is None and rows["cast"].total_records is None and rows["cast"].compliance_rate is None
    run = {r.name: r for r in assessment_run(stored, failing).where("section = 'rules'").collect()}
    assert run["cast"].success is False and run["cast"].value is None and run["cast"].error
    found = {(r.rule_id, r.key) for r in sample_violations(stored, failing, "id").collect()}
    assert found == {("cast", 4)}


GUARDED = {
    "b <> 0 AND a / b > 1": [False, False, None],
    "coalesce(try_cast(t AS int), 0) > 0": [True, False, False],
    "CASE WHEN b > 0 THEN a / b > 0 ELSE false END": [False, True, False],
    "coalesce(CAST(t AS int), 7) > 5": [False, True, True],
}
FAILING = ["t > 1", "a / nullif(b, 5) > 1", "t BETWEEN 1 AND 5", "arr[2] > 1", "element_at(arr, 3) > 1", "a % (b - 5) = 1",
           "a div (b - 5) > 1", "CAST(`s x` AS DATE) < DATE '2021-01-01'", "to_date(`s x`) < DATE '2021-01-01'",
           "to_timestamp(`s x`, 'yyyy-MM-dd') < now()", "datediff(`s x`, '2020-01-01') > 3", "t IN (1, 2)", "a * 2000000000 > 5"]


@pytest.fixture(scope="module")
def values(spark):
    rows = [("1", 2, 0, "2020-01-01", [1, 2, 3]), ("x", 3, 5, "bad", [1]), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "t string, a int, b int, `s x` string, arr array<int>")


@pytest.mark.parametrize("predicate", GUARDED)
def test_guards_keep_their_meaning(values, predicate):
    form = tolerant(values, predicate)
    rows = values.selectExpr(f"{form.value} AS v", f"{form.failed or 'false'} AS f").collect()
    assert [r.v for r in rows] == GUARDED[predicate] and not any(r.f for r in rows)


@pytest.mark.parametrize("predicate", FAILING)
def test_failing_values_are_told_from_unknown_ones(values, predicate):
    form = tolerant(values, predicate)
    rows = values.selectExpr(f"{form.value} AS v", f"{form.failed} AS f").collect()
    assert any(r.f and r.v is None for r in rows)
    assert rows[2].f is False


def test_sound_predicates_stay_as_they_are(values):
    for predicate in ("a > 1", "t LIKE '%x'", "length(t) > a", "CAST(a AS STRING) = t", "t IS NULL"):
        assert tolerant(values, predicate).failed is None
        assert tolerant(values, predicate).value == predicate
