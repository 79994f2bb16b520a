import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfledger.plans import scripts
from shelfledger.sources import export


@pytest.mark.parametrize("rows", [0, -1, 1_000_001])
def test_slice_length_is_checked(spark, rows):
    with pytest.raises(ValueError):
        export.with_file_version(spark.range(3), ["id"], rows)


def test_numbering_with_a_third_of_equal_rows(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("k"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), (F.col("id") % 17).cast("string"))).alias("v"))
    got = export.number_rows(df, ["k"]).orderBy("_row").collect()
    assert [r._row for r in got] == list(range(1, 3001))
    assert [r.k for r in got] == sorted(r.k for r in df.collect())
    assert sorted((r.k, r.v) for r in got) == sorted((r.k, r.v) for r in df.collect())


def test_slices_split_the_input_exactly(spark, tmp_path):
    df = spark.range(1050).select((F.col("id") * 7919 % 1050).alias("n"), F.lit('a "quoted", text').alias("t"))
    path = str(tmp_path / "out")
    export.write_slices(df, path, 100, ["n"])
    files = sorted(tmp_path.glob("out/file_ver=*/*.csv"))
    assert len(files) == 11
    for f in files:
        ver = int(f.parent.name.split("=")[1])
        lines = f.read_text().splitlines()
        assert lines[0] == "n,t"
        assert [int(x.split(",")[0]) for x in lines[1:]] == list(range((ver - 1) * 100, min(ver * 100, 1050)))
    export.write_slices(df.limit(5), path, 100, ["n"], suffix=".txt")
    assert len(list(tmp_path.glob("out/file_ver=*/*.txt"))) == 1 and not list(tmp_path.glob("out/*/*.csv"))


def test_versions_follow_the_order(spark):
    df = spark.range(500).select((F.col("id") * 31 % 500).alias("n"))
    a = {r.n: r.file_ver for r in export.with_file_version(df, ["n"], 60).collect()}
    assert a == {n: n // 60 + 1 for n in range(500)}


def test_exports_leave_no_scratch(spark, tmp_path):
    kept = spark.conf.get("spark.checkpoint.dir")
    before = {p for p in os.listdir(kept) if p.startswith("ordered")}
    export.write_slices(spark.range(50), str(tmp_path / "s"), 10, ["id"])
    export.write_fixed_width(spark.range(50), str(tmp_path / "f"), 10, ["id"])
    assert {p for p in os.listdir(kept) if p.startswith("ordered")} == before


def test_a_run_of_equal_rows_is_split_over_tasks(spark, tmp_path):
    kept = str(tmp_path / "kept")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plan = export.number_rows(spark.range(20_000).select(F.lit(1).alias("k")), ["k"], kept)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert plan.select(F.count_distinct("_row")).first()[0] == 20_000
    assert spark.read.parquet(kept).groupBy("_part").count().filter("count > 1000").count() >= 7


def test_one_slice_a_task(spark):
    """Partition numbers are the slices' own: as many partitions as slices, each of one slice."""
    for slices, rows in ((1, 50), (7, 100), (40, 10)):
        df = spark.range(slices * rows - 3).select("id", (F.col("id") + 1).alias("_row"), F.expr(f"cast(id div {rows} + 1 as int)").alias("file_ver"))
        dealt = export._one_slice_a_task(df, slices)
        parts = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("file_ver").alias("n"), F.min("file_ver").alias("v")).collect()
        assert sorted((r.p, r.n, r.v) for r in parts) == [(k, 1, k + 1) for k in range(slices)]
        assert "hashpartitioning" not in dealt._jdf.queryExecution().executedPlan().toString()


def test_empty_export(spark, tmp_path):
    export.write_slices(spark.range(0), str(tmp_path / "none"), 10, ["id"])
    assert not list(tmp_path.glob("none/file_ver=*"))


def test_fixed_width(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, 1), ("long text", None, 2), (None, 12.25, 3)], "name string, v double, n int")
    export.write_fixed_width(df, str(tmp_path / "fw"), 2, ["n"])
    read = lambda v: next(tmp_path.glob(f"fw/file_ver={v}/*.txt")).read_text().splitlines()
    assert read(1) == ["     name   v n", "        a 1.5 1", "long text NaN 2"]
    assert read(2) == ["name     v n", "None 12.25 3"]


def _load(spark, path):
    return sorted((str(r.location), str(r.date), r.v) for r in spark.read.parquet(path).collect())


def test_reload_twice_is_reload_once(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "location string, date date, v int"
    first = spark.createDataFrame([("a", date(2025, 1, 1), 1), ("a", date(2025, 1, 2), 2), ("b", date(2025, 1, 1), 3)], schema)
    again = spark.createDataFrame([("a", date(2025, 1, 2), 20), ("a", date(2025, 1, 2), 21)], schema)
    export.replace_partitions(first, path, ["location", "date"])
    for _ in range(2):
        export.replace_partitions(again, path, ["location", "date"])
        assert _load(spark, path) == [("a", "2025-01-01", 1), ("a", "2025-01-02", 20), ("a", "2025-01-02", 21), ("b", "2025-01-01", 3)]


def test_replace_whole_locations(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "location string, date date, v int"
    export.replace_partitions(spark.createDataFrame([("a", date(2025, 1, 1), 1), ("b", date(2025, 1, 1), 3)], schema), path, ["location"])
    export.replace_partitions(spark.createDataFrame([("a", date(2025, 1, 5), 9)], schema), path, ["location"])
    assert _load(spark, path) == [("a", "2025-01-05", 9), ("b", "2025-01-01", 3)]


def test_calendar_path(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([("10-Dry", 1), ("50-Care", 2)], "Dept string, v int")
    export.write_calendar_path(df, path, "2025-03-16")
    export.write_calendar_path(df.filter("v = 1").withColumn("v", F.lit(7)), path, "2025-03-16")
    got = spark.read.option("header", True).csv(path).collect()
    assert sorted((r.v, str(r.year), r.month, r.division) for r in got) == [
        ("2", "2025", "March", "5 - HEALTH & BEAUTY"), ("7", "2025", "March", "1 - GROCERY")]
    with pytest.raises(Exception, match="no export division"):
        export.write_calendar_path(spark.createDataFrame([("70-None", 3)], "Dept string, v int"), str(tmp_path / "d"), "2025-03-16")
    assert spark.range(1).select(export.month_folder("2025-03-16")).first()[0] == "202503 - March"


def test_scripts(spark, tmp_path):
    (tmp_path / "sql").mkdir()
    (tmp_path / "sql" / "upto.sql").write_text("SELECT id, date_add(:day, cast(id AS int)) AS d FROM range(:n)")
    reports = scripts.run_folder(spark, str(tmp_path / "sql"), n=7, day=date(2025, 1, 1))
    assert list(reports) == ["upto"] and reports["upto"].count() == 7
    scripts.export_reports(reports, str(tmp_path / "out"), {"upto": ["id"]}, rows=3)
    assert sorted(p.name for p in (tmp_path / "out" / "upto").glob("file_ver=*")) == ["file_ver=1", "file_ver=2", "file_ver=3"]
    assert scripts.run_script(spark, "SELECT 1 AS one").first().one == 1
