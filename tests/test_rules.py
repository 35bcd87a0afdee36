"""Rule engine, rule pack, overlap rule, registry."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from assay.operators import registry as rg
from assay.operators import rules as ru
from assay.operators.rule_pack import OVERLAP, PACK, overlapping_owners, overlapping_rows
from assay.plans.lineage import fresh_dir
from assay.sources import rule_files as rf
from tests.conftest import executed, rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, 17, "a@b.cd"), (2, 18, None), (3, 100, "x"), (4, 101, "call 555-123-4567"), (5, None, "123-45-6789")],
        "id long, age int, txt string",
    )


def results(frame):
    return {(r["rule_id"], r["column_name"]): r for r in frame.collect()}


def test_rule_validation_and_null_policy(df):
    skip = ru.Rule("skip", "column_name NOT BETWEEN 18 AND 100", "age")
    strict = ru.Rule("strict", "column_name NOT BETWEEN 18 AND 100", "age", on_null="violation")
    got = results(ru.run_rules(df, [skip, strict]))
    assert got["skip", "age"]["violations"] == 2
    assert got["skip", "age"]["compliance_rate"] == 60.0
    assert got["strict", "age"]["violations"] == 3
    with pytest.raises(ValueError):
        ru.Rule("x", "true", on_null="maybe")


def test_column_names_are_quoted(spark):
    odd = spark.createDataFrame([(1,), (None,)], "`years of age.x` int")
    row = ru.run_rules(odd, [PACK["dq1"].on("years of age.x")]).first()
    assert (row["column_name"], row["violations"]) == ("years of age.x", 1)
    assert rows(ru.sample_violations(odd.withColumn("k", F.lit(1)), [PACK["dq1"].on("years of age.x")], "k").select("value")) == [(None,)]


def test_empty_table_complies(df):
    got = ru.run_rules(df.limit(0), [PACK["ppl_001"].on("age")]).first()
    assert (got["total_records"], got["violations"], got["compliance_rate"]) == (0, 0, 100.0)


def test_bad_rules_are_error_rows(df):
    bad = [
        ru.Rule("column", "nope > 1", "age"),
        ru.Rule("syntax", "age >", "age"),
        ru.Rule("number", "age + 1", "age"),
        ru.Rule("pattern", "txt RLIKE '('", "txt"),
    ]
    got = results(ru.run_rules(df, [*bad, PACK["ppl_001"].on("age")]))
    for rule in bad:
        assert got[rule.rule_id, rule.column_name]["error"]
        assert got[rule.rule_id, rule.column_name]["violations"] is None
    assert got["ppl_001", "age"]["violations"] == 2
    assert results(ru.run_rules(df, bad)).keys() == {(r.rule_id, r.column_name) for r in bad}


def test_run_time_errors_stay_with_their_rule(df):
    failing = ru.Rule("cast", "CAST(txt AS INT) > 1", "txt")
    got = results(ru.run_rules_isolated(df, [PACK["ppl_001"].on("age"), failing, PACK["dq1"].on("txt")]))
    assert "CAST_INVALID_INPUT" in got["cast", "txt"]["error"]
    assert got["ppl_001", "age"]["violations"] == 2
    assert got["dq1", "txt"]["violations"] == 1
    assert ru.run_rules_isolated(df, []).count() == 0


def test_many_rules_share_one_scan(spark, sf):
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    many = [ru.Rule(f"r{i}", f"column_name > {i}", "c_acctbal") for i in range(30)]
    plan = executed(ru.run_rules(customers, many))
    assert plan.count("FileScan") == 1
    assert "c_name" not in plan.split("ReadSchema")[1]


def test_violations_passed_and_skipped_add_up(df):
    for rule in (PACK["ppl_001"].on("age"), PACK["gdpr_001"].on("txt"), PACK["gdpr_006"].on("txt")):
        total = df.count()
        violated = df.where(rule.violation()).count()
        passed = df.where(~F.coalesce(F.expr(rule.sql), F.lit(True))).count()
        skipped = df.where(F.expr(rule.sql).isNull()).count()
        assert violated + passed + skipped == total


@pytest.mark.parametrize(
    ("rule_id", "violating", "fine"),
    [
        ("gdpr_001", ["write to a.b@c-d.org now"], ["a@b", None]),
        ("gdpr_002", ["555-123-4567", "tel 5551234567", "555.123.4567"], ["55-123-4567", "15551234567", None]),
        ("gdpr_003", ["id 123-45-6789"], ["123-456-789", "1123-45-67890", None]),
        ("gdpr_004", ["1234 5678 1234 5678", "1234567812345678"], ["1234 5678 1234 567", None]),
        ("gdpr_006", ["a@b", "a b@c.de"], ["a.b@c.de", None]),
        ("gdpr_007", ["2024-1-5", "2024-02-30", "x"], ["2024-01-05", None]),
        ("gdpr_008", ["none"], ["555-123-4567", None]),
        ("asg_002", ["P-12-24", "P-1234-24x"], ["P-1234-24", None]),
        ("addr_001", ["AB1 2CD", "1234"], ["12345", "12345-6789", None]),
        ("addr_002", ["gb", "", "GBR"], ["GB", None]),
        ("dq2", ["x", "2024-02-30", None], ["2024-1-5", "2024-01-05"]),
        ("dq1", [None], ["", "x"]),
        ("emp_002", [None], ["x"]),
    ],
)
def test_pack(spark, rule_id, violating, fine):
    rule = PACK[rule_id].on("c")
    for values, verdict in ((violating, True), (fine, False)):
        df = spark.createDataFrame([(x,) for x in values], "c string")
        assert [r[0] for r in df.select(rule.violation()).collect()] == [verdict] * len(values)


def test_numeric_rules(spark):
    df = spark.createDataFrame([(29999.0,), (30000.0,), (200000.0,), (200000.5,), (None,)], "salary double")
    assert [r[0] for r in df.select(PACK["emp_001"].on("salary").violation()).collect()] == [True, False, False, True, False]
    spans = spark.createDataFrame(
        [(date(2024, 1, 1), date(2024, 3, 31)), (date(2024, 1, 1), date(2024, 4, 1)), (date(2024, 1, 1), None)],
        "start_date date, end_date date",
    )
    assert [r[0] for r in spans.select(PACK["asg_001"].violation()).collect()] == [False, True, False]


def test_samples_are_the_first_by_key(df, spark, sf):
    got = rows(
        ru.sample_violations(df, [PACK["ppl_001"].on("age"), PACK["dq1"].on("age"), ru.Rule("bad", "nope", "age")], "id", 1)
        .select("rule_id", "key", "position", "value")
    )
    assert got == [("dq1", 5, 1, None), ("ppl_001", 1, 1, "17")]
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    plan = executed(ru.sample_violations(customers, [ru.Rule("r", "c_acctbal > 0", "c_acctbal")], "c_custkey"))
    assert plan.count("WindowGroupLimit") >= 2


def by_hand(intervals):
    return {
        a[1]
        for a in intervals
        for b in intervals
        if a[0] != b[0] and a[1] == b[1] and a[2] < b[3] and b[2] < a[3]
    }


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
def test_overlap_equals_all_pairs(spark, kind):
    rng = random.Random(11)
    origin, unit = (date(2024, 1, 1), timedelta(days=1)) if kind == "date" else (datetime(2024, 1, 1), timedelta(hours=5))
    data = []
    for i in range(240):
        start = origin + unit * rng.randrange(60)
        data.append((i, rng.randrange(60), start, start + unit * rng.choice([0, 0, 1, 2, 9])))
    df = spark.createDataFrame(data, f"id long, employee_id long, start_date {kind}, end_date {kind}")
    expected = by_hand(data)
    assert 0 < len(expected) < 60
    got = overlapping_owners(df, "employee_id", "start_date", "end_date")
    assert {r[0] for r in got.collect()} == expected
    for hot_rows in (2, 1000):
        ids = {r["id"] for r in overlapping_rows(df, hot_rows=hot_rows).collect()}
        assert ids == {r[0] for r in data if r[1] in expected}


def test_overlap_edge_cases(spark):
    d = lambda day: None if day is None else date(2024, 1, day)
    cases = {
        "touching": [(1, 5), (5, 9)],
        "nested": [(1, 9), (3, 4)],
        "equal": [(2, 4), (2, 4)],
        "points_equal": [(3, 3), (3, 3)],
        "point_inside": [(1, 9), (5, 5)],
        "point_at_start": [(5, 5), (5, 9)],
        "open": [(1, None), (2, 5)],
        "reversed": [(9, 1), (2, 5)],
        "far_reach": [(1, 20), (2, 2), (19, 21)],
    }
    data = [(i, name, d(s), d(e)) for i, (name, s, e) in enumerate((n, s, e) for n, xs in cases.items() for s, e in xs)]
    df = spark.createDataFrame(data, "id long, employee_id string, start_date date, end_date date")
    got = {r[0] for r in overlapping_owners(df, "employee_id", "start_date", "end_date").collect()}
    assert got == {"nested", "equal", "point_inside", "far_reach"}


def test_assessment(df, spark, sf):
    rules = [PACK["ppl_001"].on("age"), PACK["dq1"].on("txt"), ru.Rule("bad", "nope", "age")]
    table = {(r["section"], r["name"], r["column_name"]): r for r in ru.assessment_run(df, rules).collect()}
    assert table["basic_stats", "row_count", None]["value"] == 5
    assert table["basic_stats", "duplicates", None]["value"] == 0
    assert table["missing_values", "missing", "age"]["value"] == 1
    assert ("correlations", "age", "id") in table
    assert table["rules", "ppl_001", "age"]["success"] is False
    assert table["rules", "bad", "age"]["error"]
    column = {(r["section"], r["name"]): r for r in ru.assessment_run(df, rules, column="txt").collect()}
    assert set(column) == {
        ("basic_stats", "row_count"), ("checks", "missing_values"), ("checks", "empty_strings"),
        ("checks", "special_characters"), ("rules", "dq1"),
    }
    customers = spark.read.parquet(f"{sf}/customer.parquet")
    plan = executed(ru.assessment_run(customers, [PACK["dq1"].on("c_name")], column="c_name"))
    assert plan.count("FileScan") == 1


def test_one_scan_equals_one_by_one(df):
    rules = [PACK[r].on(c) for r, c in (("ppl_001", "age"), ("gdpr_001", "txt"), ("dq1", "txt"), ("dq2", "txt"))]
    together = {k: tuple(v) for k, v in results(ru.run_rules(df, rules)).items()}
    alone = {}
    for rule in rules:
        alone.update({k: tuple(v) for k, v in results(ru.run_rules(df, [rule])).items()})
    assert together == alone


def test_set_rule(spark):
    spans = spark.createDataFrame(
        [(1, 7, date(2024, 1, 1), date(2024, 1, 9)), (2, 7, date(2024, 1, 2), date(2024, 1, 3)), (3, 8, date(2024, 1, 1), None)],
        "id long, employee_id long, start_date date, end_date date",
    )
    row = ru.run_rules(spans, [], [OVERLAP]).first()
    assert (row["rule_id"], row["total_records"], row["violations"]) == ("asg_003", 3, 2)


# --- registry -------------------------------------------------------------------------------------

EVENT = "event_id long, ts timestamp_ntz, action string, config_key string, rule_id string, severity string, table_name string"


def at(hour):
    return datetime(2024, 1, 1, hour)


def registry(spark, events):
    data = [(i, at(i), a, k, k and k.upper(), s, "t") for i, (a, k, s) in enumerate(events)]
    frame = rg.current_rules(spark.createDataFrame(data, EVENT), ["rule_id", "severity", "table_name"])
    return {r["config_key"]: r for r in frame.collect()}


def test_save_deactivate_save(spark):
    got = registry(spark, [("save", "a", "High"), ("deactivate", "a", None), ("save", "a", "Low")])
    assert got["a"]["is_active"] and got["a"]["deactivated_at"] is None
    assert (got["a"]["severity"], got["a"]["activated_at"]) == ("Low", at(2))


def test_deactivate_keeps_attributes_and_unknown_keys_do_nothing(spark):
    got = registry(spark, [("deactivate", "b", None), ("save", "a", "High"), ("deactivate", "a", None), ("deactivate", "zz", None)])
    assert set(got) == {"a"}
    assert not got["a"]["is_active"]
    assert (got["a"]["severity"], got["a"]["last_updated"], got["a"]["deactivated_at"]) == ("High", at(1), at(2))


def test_deactivate_all_stamps_every_known_rule_again(spark):
    got = registry(
        spark,
        [("save", "a", "High"), ("save", "b", "Low"), ("deactivate", "a", None), ("deactivate_all", None, None), ("save", "c", "Low")],
    )
    assert [got[k]["is_active"] for k in "abc"] == [False, False, True]
    assert got["a"]["deactivated_at"] == got["b"]["deactivated_at"] == at(3)
    assert got["c"]["deactivated_at"] is None


def test_registry_statistics(spark):
    rules = spark.createDataFrame(
        [
            ("k1", "t1", "Critical", "g", True, at(1), at(1), None),
            ("k2", "t1", "High", "g", False, at(2), at(2), at(3)),
            ("k3", "t2", "High", "d", None, at(3), None, None),
        ],
        "config_key string, table_name string, severity string, category string, is_active boolean, "
        "last_updated timestamp_ntz, activated_at timestamp_ntz, deactivated_at timestamp_ntz",
    )
    assert tuple(rg.rule_counts(rules).first()) == (3, 1, 2, 1)
    assert rows(rg.active_rules(rules).select("config_key")) == [("k1",), ("k3",)]
    assert rows(rg.active_rules(rules, severity="High").select("config_key")) == [("k3",)]
    assert [tuple(r) for r in rg.rules_by(rules, "severity").collect()] == [("High", 2), ("Critical", 1)]
    assert rows(rg.rule_activity_timeline(rules)) == [(date(2024, 1, 1), "activated", 2), (date(2024, 1, 1), "deactivated", 1)]
    assert [r["config_key"] for r in rg.recent_rule_updates(rules, 2).collect()] == ["k3", "k2"]
    assert tuple(rg.rule_adoption(rules, rules).first()) == (3, 3, 1, pytest.approx(100 / 3))
    assert tuple(rg.rule_adoption(rules.limit(0), rules).first()) == (0, 3, 1, 0.0)


def test_execution_history(spark):
    runs = spark.createDataFrame(
        [("r", at(1), 90.0), ("r", at(3), 80.0), ("q", at(2), 50.0)], "rule_id string, run_ts timestamp_ntz, compliance_rate double"
    )
    got = rows(rg.rule_execution_history(runs).select("rule_id", "run_ts", "change", "last_validated"))
    assert got == [("q", at(2), None, at(2)), ("r", at(1), None, at(3)), ("r", at(3), -10.0, at(3))]


def test_event_log_is_appended(spark):
    path = fresh_dir(spark, "log")
    for i in range(2):
        rg.append_event(spark.createDataFrame([(i, "save")], "event_id int, action string"), path)
    assert spark.read.parquet(path).count() == 2


def test_rule_files(spark):
    folder = fresh_dir(spark, "files")
    templates = '{"flat": [{"id": "a", "severity": "High"}, {"id": "b"}], "deep": {"sub": [{"id": "c"}]}}'
    spark.createDataFrame([(templates,)], "value string").coalesce(1).write.text(f"{folder}/t")
    got = rows(rf.load_rule_templates(spark, f"{folder}/t").select("category", "subcategory", "id", "severity"))
    assert got == [("deep", "sub", "c", None), ("flat", None, "a", "High"), ("flat", None, "b", None)]
    configs = '{"rule_configs": {"a_t_c": {"rule_id": "a", "is_active": false}, "b_t_c": {"rule_id": "b"}}}'
    spark.createDataFrame([(configs,)], "value string").coalesce(1).write.text(f"{folder}/c")
    got = rows(rf.load_rule_configs(spark, f"{folder}/c").select("config_key", "rule_id", "is_active"))
    assert got == [("a_t_c", "a", False), ("b_t_c", "b", True)]


def test_instantiation(spark):
    templates = spark.createDataFrame(
        [("r1", "d", "High", "g", "column_name in table_name", "SELECT column_name FROM table_name"), ("r2", "d", "Low", "g", "x", "y")],
        "id string, description string, severity string, category string, validation_code string, validation_code_sql string",
    )
    got = rows(rg.instantiate_rules(templates, [("per", "age"), ("asg", "id")], severity="High").select("config_key", "python_code", "sql_code"))
    assert got == [("r1_asg_id", "id in asg", "SELECT id FROM asg"), ("r1_per_age", "age in per", "SELECT age FROM per")]


@pytest.mark.parametrize(
    "broken", ["max(column_name) > 5", "row_number() OVER (ORDER BY column_name) > 5", "explode(array(true))"]
)
def test_rules_that_only_fail_in_the_shared_scan_stay_alone(spark, broken):
    df = spark.createDataFrame([(1,), (7,)], "pay int")
    rules = [ru.Rule("bad", broken, "pay"), ru.Rule("good", "column_name > 5", "pay")]
    got = {r.rule_id: r for r in ru.run_rules(df, rules).collect()}
    assert got["bad"].error and got["good"].violations == 1
    assert ru.sample_violations(df, rules[:1], key="pay").count() == 0
