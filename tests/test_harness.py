"""What the queries exchange and land."""

import os
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from rollcall.harness import polling, reports
from rollcall.harness.registry import SQL as QUERY_SQL
from rollcall.plans import camp_h, camp_l, camp_t
from rollcall.streaming import polling as streaming


def test_the_clean_report_exchanges_no_answers(spark, monkeypatch):
    seen = []
    number_rows = reports.number_rows
    monkeypatch.setattr(reports, "number_rows", lambda df, *a, **k: seen.append(df.columns) or number_rows(df, *a, **k))
    reports.run(spark, "/root/testdata/sf0.001", camp_h.FAMILY, "Alles")
    assert len(seen) == 1 and "answers" not in seen[0] and "Adresse" in seen[0]


def _lines(spark, folder, n=6000):
    """Tables of lines, some of the same place, with keys that are null, found nowhere or come twice."""
    key = lambda k, m: f"case when {k} % 97 = 0 then null when {k} % 89 = 0 then 10000000 + {k} else {k} % {m} end"
    tables = {
        "lineitem": (n, f"{key('id', 1500)} as l_orderkey", "cast(id div 1500 as int) as l_linenumber", f"{key('id * 7', 200)} as l_partkey", "id % 9 as l_suppkey",
                     "cast(id % 50 as double) as l_quantity", "id * 1.5D as l_extendedprice", "0.05D as l_discount", "0.02D as l_tax",
                     "substr('ANR', cast(id % 3 as int) + 1, 1) as l_returnflag", "if(id % 2 = 0, 'O', 'F') as l_linestatus", "timestamp_ntz'1995-03-04 00:00:00' as l_shipdate"),
        "orders": (1500, f"{key('id', 1500)} as o_orderkey", f"{key('id * 3', 100)} as o_custkey", "substr('FOP', cast(id % 3 as int) + 1, 1) as o_orderstatus",
                   "id * 2.25D as o_totalprice", "timestamp_ntz'1995-01-05 10:00:00' as o_orderdate",
                   "element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'), cast(id % 5 as int) + 1) as o_orderpriority"),
        "customer": (100, "id as c_custkey", "concat('C', id) as c_name", "cast(id % 6 as int) as c_nationkey",
                     "element_at(array('BUILDING', 'MACHINERY', 'FURNITURE', 'AUTOMOBILE'), cast(id % 4 as int) + 1) as c_mktsegment", "0D as c_acctbal"),
        "nation": (5, "cast(id as int) as n_nationkey", "concat('N', id) as n_name", "cast(id % 4 as int) as n_regionkey"),
        "part": (200, "id as p_partkey", "concat('part ', id) as p_name", "if(id % 2 = 0, 'SMALL', 'LARGE') as p_type", "'B' as p_brand", "cast(id % 50 as int) as p_size", "1D as p_retailprice"),
    }
    for name, (rows, *columns) in tables.items():
        spark.range(rows).selectExpr(*columns).write.parquet(f"{folder}/{name}.parquet")
    again = spark.read.parquet(f"{folder}/lineitem.parquet").limit(300).collect()
    spark.createDataFrame(again, spark.read.parquet(f"{folder}/lineitem.parquet").schema).write.mode("append").parquet(f"{folder}/lineitem.parquet")


@pytest.mark.parametrize("family", [camp_h, camp_l, camp_t])
def test_the_clean_report_exchanges_lines_not_clean_rows(spark, folder, family):
    """One exchange deals the joined lines out; clean rows are made behind it, and their numbers are those of the SQL."""
    _lines(spark, folder)
    name = f"report_clean_{family.FAMILY.name}"
    found = reports.run(spark, folder, family.FAMILY, "Alles")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Window" in plan
    above, below = plan.split("RepartitionByExpression")
    assert "Vorname" in above and "Vorname" not in below.split("Aggregate")[0] and "answers" not in below

    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "nation", "part"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    wanted = con.execute(QUERY_SQL[name])
    columns = [c[0] for c in wanted.description]
    assert found.columns == columns
    rows = lambda all_rows: sorted(repr(tuple(r)) for r in all_rows)
    got = found.collect()
    assert len(got) > 3000 and [r["Nr"] for r in sorted(got, key=lambda r: r["Nr"])] == list(range(len(got)))
    assert rows(got) == rows(wanted.fetchall())


def test_pages_land_compressed_and_can_be_landed_again(spark, folder):
    pages = spark.range(20).select(F.concat(F.lit('{"page":'), "id", F.lit("}")).alias("value"))
    polling._land(spark, "/root/testdata/sf0.001", f"{folder}/s1", pages)
    files = [f for c in ("orders", "items", "questions") for f in os.listdir(f"{folder}/s1/{c}") if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    again = polling._landed_again(spark, f"{folder}/s1")
    assert sorted(again.collect()) == sorted(pages.collect())


def test_ticks_end_although_runs_take_longer_than_the_interval(spark, folder, monkeypatch):
    """The query never rests between two triggers; it is stopped after two of its runs, none of them cut off."""
    rows = spark.range(40).selectExpr(
        "id as o_orderkey", "id % 7 as o_custkey", "substr('FOP', cast(id % 3 as int) + 1, 1) as o_orderstatus", "cast(id as double) as o_totalprice",
        "timestamp_ntz'2025-01-05 10:00:00' as o_orderdate", "concat(id % 5 + 1, '-X') as o_orderpriority",
    )
    rows.write.parquet(f"{folder}/orders.parquet")
    spark.range(7).selectExpr("id as c_custkey", "concat('C', id) as c_name").write.parquet(f"{folder}/customer.parquet")
    spark.range(5).selectExpr("cast(id as int) as n_nationkey", "concat('NATION_', id) as n_name").write.parquet(f"{folder}/nation.parquet")
    begun, ended, run_event = [], [], streaming.run_event

    def slow(*args, **more):
        begun.append(time.monotonic())
        outcome = run_event(*args, **more)
        if len(begun) > 3:
            time.sleep(max(0.0, begun[-1] + 7 - time.monotonic()))
        ended.append(outcome)
        return outcome

    monkeypatch.setattr(streaming, "run_event", slow)
    monkeypatch.setattr(polling, "PATIENCE_SECONDS", 60)
    got = {tuple(r) for r in polling.poll_ticks(spark, folder).collect()}
    tickets = sum(i % 5 for i in range(40))
    assert got == {(1, "failed", None, False), (2, "success", tickets, False), (3, "unchanged", tickets, False), (4, "unchanged", tickets, True)}
    assert len(begun) == len(ended) <= 6
