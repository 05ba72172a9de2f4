import os

import pytest
from pyspark.sql import functions as F

from rollcall import session
from rollcall.operators.counting import choice_frame
from rollcall.plans.spec import ReportSpec, Where, run_spec, with_folder
from rollcall.sinks import reports, runs


def test_groups_are_replaced_as_a_whole(spark, folder):
    path = f"{folder}/lists"
    rows = [("Süd", 1, "a"), ("Süd", 2, "=b"), ("Nord/West", 1, "c"), (None, 1, "d")]
    df = spark.createDataFrame(rows, "place string, nr bigint, name string")
    reports.write_groups(df, path, "place", "nr")
    got = {(r["folder"], r["nr"], r["name"]) for r in spark.read.parquet(path).collect()}
    assert got == {("Süd", 1, "a"), ("Süd", 2, "=b"), ("Nord+West", 1, "c")}
    reports.write_groups(df.where("place = 'Süd'"), path, "place", "nr", "csv")
    assert [f for f in os.listdir(path) if f.startswith("folder=")] == ["folder=Süd"]
    back = spark.read.option("header", True).csv(path)
    assert {r["name"] for r in back.collect()} == {"a", "'=b"}


def test_large_group_is_written_by_many_tasks(spark, folder):
    from rollcall.operators.numbering import number_rows

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        df = spark.range(20000).select("id", F.lit("hot").alias("place"))
        numbered = number_rows(df, ["id"], group=["place"])
        reports.write_groups(numbered, f"{folder}/hot", "place", "nr")
        files = [f for f in os.listdir(f"{folder}/hot/folder=hot") if f.endswith(".parquet")]
        assert len(files) > 1
        assert spark.read.parquet(f"{folder}/hot").where("nr = id + 1").count() == 20000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_manifest_lists_empty_groups_and_refuses_equal_paths(spark):
    counts = spark.createDataFrame([("a", 2)], "label string, rows bigint")
    entries = reports.manifest("r", "F", choice_frame(spark, ["a", "b:"]), counts)
    assert {tuple(r) for r in reports.check_manifest(entries).collect()} == {
        ("r", "a", "F/a", 2), ("r", "b:", "F/b", 0),
    }
    clash = reports.manifest("r", "", choice_frame(spark, ["b", "b:"]), counts)
    with pytest.raises(ValueError, match="share the path 'b'"):
        reports.check_manifest(clash)


def test_paths_that_climb_out(spark, folder):
    df = spark.createDataFrame([("a/b",), ("a/../b",)], "path string")
    assert reports.safe_paths(df.where("path = 'a/b'"), "path").first()[0] == "a/b"
    with pytest.raises(Exception, match="leaves its folder"):
        reports.safe_paths(df, "path").collect()
    with pytest.raises(ValueError):
        reports.write_report(df, f"{folder}/../x")


def test_report_is_replaced_and_appended(spark, folder):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "Nr int, v string")
    reports.write_report(df, f"{folder}/r")
    reports.write_report(df, f"{folder}/r", order="Nr")
    reports.append_rows(df.where("Nr = 1"), f"{folder}/r")
    assert spark.read.parquet(f"{folder}/r").count() == 3


def test_run_log(spark, folder):
    assert runs.last_run(spark, folder) is None
    runs.record_run(spark, folder, "1", "Europe/Berlin", runs.SUCCESS, None, 5, "x")
    runs.record_run(spark, folder, "2", "Europe/Berlin", runs.FAILED, "broken")
    assert runs.last_run(spark, folder)["run_id"] == "2"
    good = runs.last_run(spark, folder, runs.SUCCESS)
    assert (good["run_id"], good["checksum"], good["input_rows"]) == ("1", "x", 5)
    errors = spark.read.parquet(f"{folder}/_run_errors").collect()
    assert [(r["run_id"], r["error"]) for r in errors] == [("2", "broken")]


def test_spec_with_own_step(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, None, "y"), (3, "a", "x")], "i int, n string, k string")
    spec = ReportSpec(
        "r", "s", ("n", "twice", "none"), folder="F", where=(Where("k", "equals", "x"),),
        step=lambda d: d.withColumn("twice", F.col("i") * 2), order=("n",), ties=("i",),
    )
    got = with_folder(run_spec(spec, {"s": df}), spec)
    assert [tuple(r) for r in got.orderBy("Nr").collect()] == [(1, "a", 6, "F/r"), (2, "b", 2, "F/r")]
    with pytest.raises(ValueError, match="missing required"):
        run_spec(ReportSpec("r", "s", ("n",), where=(Where("zz", "given"),)), {"s": df})


def test_scratch_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_root(spark) == named.rstrip("/")
    assert session.scratch_path(spark, "x").startswith(f"{named}/rollcall/")
    df = session.pin(spark.range(10), "ten")
    assert df.count() == 10 and f"{named}/rollcall/" in df.inputFiles()[0]


def test_a_sorted_report_has_as_many_ranges_as_its_rows_need(spark, folder, monkeypatch):
    monkeypatch.setattr(reports, "RANGING", reports.RANGING.__class__(rows=50))
    reports.write_report(spark.range(1000).withColumnRenamed("id", "Nr"), f"{folder}/r", "csv", "Nr")
    # More than the four that the session shuffles to.
    assert len([f for f in os.listdir(f"{folder}/r") if f.startswith("part-")]) > 10
    assert [r["Nr"] for r in spark.read.option("header", True).csv(f"{folder}/r").collect()].count("7") == 1
