"""Readers of files."""

from pyspark.sql import types as T

from assay.sources.tables import csv_counts, scan_csv_checked, scan_csv_set
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])


def test_csv_is_split_unless_lines_may_break(spark, tmp_path):
    data = spark.range(20_000).selectExpr("id", "repeat('x', 20) AS note")
    data.coalesce(1).write.csv(f"{tmp_path}/x", header=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        plain = scan_csv_set(spark, {"x": f"{tmp_path}/x"}, {"x": SCHEMA})["x"]
        whole = scan_csv_set(spark, {"x": f"{tmp_path}/x"}, {"x": SCHEMA}, multi_line=True)["x"]
        assert plain.rdd.getNumPartitions() > 1
        assert whole.rdd.getNumPartitions() == 1
        assert plain.count() == whole.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_with_line_breaks(spark, tmp_path):
    (tmp_path / "y.csv").write_text('id,note\n1,"a\nb ""c"""\n2,\n')
    read = scan_csv_set(spark, {"y": f"{tmp_path}/y.csv"}, {"y": SCHEMA}, multi_line=True)["y"]
    assert rows(read) == [(1, 'a\nb "c"'), (2, None)]


def test_broken_csv_lines_go_to_quarantine(spark, tmp_path):
    schema = T.StructType.fromDDL("id bigint, day date, record string, x double")
    lines = ["1,2024-01-02,a,0.5", "2,soon,b,1", "3,2024-01-02", "4,2024-01-02,c,1,9", "", "5,,,", 'six,2024-01-02,"d, e",2']
    (tmp_path / "a.csv").write_text("id,day,record,x\n" + "\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text("id,day,record,x\n7,2024-01-03,f,1e3\n")
    good, bad = scan_csv_checked(spark, str(tmp_path), schema)
    assert good.columns == ["id", "day", "record", "x"]
    assert [r.id for r in good.orderBy("id").collect()] == [1, 5, 7]
    assert {r.record for r in bad.collect()} == {lines[1], lines[2], lines[3], lines[6]}
    assert {r.file.rsplit("/", 1)[1] for r in bad.select("file").collect()} == {"a.csv"}
    # What a query selects doesn't change which lines are good.
    assert good.select("id").count() == good.select("x").count() == good.count() == 3 and bad.count() == 4
    assert tuple(csv_counts(spark, str(tmp_path), schema).first()) == (7, 3, 4)


def test_csv_without_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n")
    good, bad = scan_csv_checked(spark, str(tmp_path), SCHEMA)
    assert good.count() == bad.count() == 0
    assert tuple(csv_counts(spark, str(tmp_path), SCHEMA).first()) == (0, 0, 0)
