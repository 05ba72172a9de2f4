"""Shaping, counting, ordering, changes and sinks over the benchmark tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions.values import has_text
from rollcall.harness.registry import query, table
from rollcall.operators import changes, counting, shaping
from rollcall.operators.collapsing import collapse, latest_per_key
from rollcall.operators.numbering import number_rows
from rollcall.plans.common import clear_unless
from rollcall.plans.spec import Ranked, ReportSpec, Where, run_spec, with_folder
from rollcall.session import scratch_path
from rollcall.sinks import reports, runs
from rollcall.streaming.polling import keep_history, latest_records
from rollcall.streaming.state import current_records, keep_state


@query("select o_custkey as o_orderkey, o_orderkey as o_custkey, o_orderstatus as status from orders")
def rename_swap(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    names = {"o_orderkey": "o_custkey", "o_custkey": "o_orderkey", "o_orderstatus": "status", "no": "x"}
    return shaping.rename(orders, names)


@query("select c_name, c_custkey, c_mktsegment from customer")
def tolerant_select(spark, sf):
    return shaping.select_known(
        table(spark, sf, "customer"), ["c_name", "c_phone", "c_custkey", "c_mktsegment"]
    )


@query("select c_custkey, c_nationkey, c_mktsegment, cast(null as varchar) as note from customer")
def redact_drop(spark, sf):
    known = shaping.add_missing(table(spark, sf, "customer"), ["note", "c_name"])
    return shaping.drop_columns(known, ["c_name", "c_acctbal"])


@query("select o_orderstatus, o_orderpriority from orders")
def text_columns_only(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(*shaping.text_columns(orders))


SEGMENTS_SQL = """
select c_mktsegment as label, row_number() over (order by c_mktsegment) as position
from (select distinct c_mktsegment from customer)
"""


def segments(spark, sf):
    found = counting.distinct_values(table(spark, sf, "customer"), "c_mktsegment")
    return number_rows(found, ["label"], into="position")


@query(f"""
with seg as ({SEGMENTS_SQL}),
edited as (select * from seg where label <> 'FURNITURE' union all select 'none', max(position) + 1 from seg),
c as (select case c_mktsegment when 'HOUSEHOLD' then null else c_mktsegment end as place from customer)
select 'GESAMT' as label, cast(0 as bigint) as position, count(*) as n from c
union all
select label, position, count(place) as n from edited left join c on place = label group by label, position
""")
def zero_fill_counts(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("place")
    )
    choices = counting.edit_choices(segments(spark, sf), "FURNITURE", "none")
    return counting.counts_per_choice(customers, "place", choices, {"n": None}, "GESAMT")


BRANDS_SQL = "select p_brand as label, row_number() over (order by p_brand) as position from (select distinct p_brand from part)"


@query(f"""
with b as ({BRANDS_SQL}),
r as (select p_brand, contains(p_type, 'ECO') as eco, contains(p_type, 'M') as m from part)
select 'GESAMT' as label, cast(0 as bigint) as position, count(*) filter (eco) as eco, count(*) filter (m) as m,
  count(*) as "all" from r
union all
select label, position, count(*) filter (eco), count(*) filter (m), count(p_brand)
from b left join r on p_brand = label group by label, position
""")
def class_counts(spark, sf):
    part = table(spark, sf, "part")
    brands = number_rows(counting.distinct_values(part, "p_brand"), ["label"], into="position")
    classes = {"eco": has_text("p_type", "ECO"), "m": has_text("p_type", "M"), "all": None}
    return counting.counts_per_choice(part, "p_brand", brands, classes, "GESAMT")


WORDS = ["red", "plate", "ring", "silver"]
_CELLS = "count(*) filter (contains(p_type, 'ECO')) as eco, count(*) as \"all\""


@query(
    " union all ".join(
        f"select '{w}' as label, cast({i} as bigint) as position, {_CELLS} from part where contains(p_name, '{w}')"
        for i, w in enumerate(WORDS, 1)
    )
    + f" union all select 'Gesamt', 5, {_CELLS} from part"
)
def theta_contains_counts(spark, sf):
    classes = {"eco": has_text("p_type", "ECO"), "all": None}
    return counting.counts_per_category(table(spark, sf, "part"), "p_name", WORDS, classes, "Gesamt")


@query("""
select distinct trim(p_type) as label from (select nullif(p_type, 'PROMO') as p_type from part) where p_type is not null
union select 'PROMO' union select 'HEAVY'
""")
def distinct_union(spark, sf):
    part = table(spark, sf, "part").select(F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    configured = counting.choice_frame(spark, ["PROMO", "HEAVY", "SMALL"])
    return counting.choices_and_observed(configured, part, "p_type")


@query("""
select label, row_number() over (order by label) as nr from (select distinct p_name as label from part)
""")
def sorted_distinct(spark, sf):
    return number_rows(counting.distinct_values(table(spark, sf, "part"), "p_name"), ["label"])


@query("""
with pos as (
  select l_orderkey, max(case when l_returnflag = 'R' then 1 else 0 end) as any_r from lineitem group by l_orderkey),
ship as (select l_orderkey, mode_flag from (select l_orderkey, l_returnflag as mode_flag, row_number() over
  (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_returnflag) as rn from lineitem where l_returnflag <> 'N') where rn = 1)
select row_number() over (order by case o_orderstatus when 'O' then 0 when 'F' then 1 end asc nulls last,
    o_orderdate asc nulls last, o_orderkey) as "Nr",
  o_orderkey, o_orderstatus, cast(o_orderdate as varchar) as ordered, mode_flag as first_flag,
  case when any_r = 1 then 'Ja' else 'Nein' end as returned
from orders join pos on pos.l_orderkey = o_orderkey left join ship on ship.l_orderkey = o_orderkey
""")
def orders_collapse(spark, sf):
    """Positions to one row per order: first given value, any-yes flag; sorted and numbered.

    The positions are collapsed before they meet their order, so that an order with
    very many of them is combined map-side and never joined row by row.
    """
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.nullif("l_returnflag", F.lit("N")).alias("first_flag"),
        F.when(F.col("l_returnflag") == "R", "Ja").otherwise("Nein").alias("returned"),
    )
    positions = collapse(
        lines, "l_orderkey", ["first_flag"], ["returned"], ["l_linenumber", "l_partkey", "l_suppkey", "first_flag"]
    )
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("string").alias("ordered")
    )
    rows = orders.join(positions, F.col("o_orderkey") == F.col("l_orderkey"))
    spec = ReportSpec(
        "orders", "rows", ("o_orderkey", "o_orderstatus", "ordered", "first_flag", "returned"),
        order=(Ranked("o_orderstatus", ("O", "F")), "ordered"), ties=("o_orderkey",), costly=True,
    )
    return run_spec(spec, {"rows": rows})


@query("""
select o_orderkey, priority, row_number() over (order by priority asc nulls last, o_orderdate, o_orderkey) as nr
from (select o_orderkey, o_orderdate, nullif(o_orderpriority, '3-MEDIUM') as priority from orders)
""")
def global_number(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("priority")
    )
    return number_rows(orders, ["priority", "o_orderdate", "o_orderkey"], drop=["o_orderdate"])


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, row_number() over (partition by l_returnflag
  order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) as nr from lineitem
""")
def group_number(spark, sf):
    """Numbers per group where a group is a third of the table."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem").select(*keys, "l_returnflag", "l_shipdate")
    return number_rows(lines, ["l_shipdate", *keys], group=["l_returnflag"], drop=["l_shipdate"])


@query("""
select event_id, row_number() over (order by ts, event_id) - 1 as ordinal from events
""")
def input_ordinal(spark, sf):
    """Dense 0-based position in input order."""
    events = table(spark, sf, "events").select("event_id", "ts")
    return number_rows(events, ["ts", "event_id"], into="ordinal", start=0, drop=["ts"])


EDITED = """
select o_orderkey, o_custkey, case when o_orderpriority = '1-URGENT' then 'X' else o_orderstatus end as status
from orders where o_orderpriority <> '5-LOW'
union all select o_orderkey, o_custkey, o_orderstatus from orders where o_orderpriority = '2-HIGH'
"""


def snapshots(spark, sf):
    orders = table(spark, sf, "orders")
    columns = ["o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status")]
    changed = F.when(F.col("o_orderpriority") == "1-URGENT", "X").otherwise(F.col("o_orderstatus"))
    edited = orders.where("o_orderpriority <> '5-LOW'").select(*columns[:2], changed.alias("status"))
    doubled = orders.where("o_orderpriority = '2-HIGH'").select(*columns)
    return orders.select(*columns), edited.unionByName(doubled)


@query(f"""
select o_orderkey, o_custkey, status, cast(sum(c) as bigint) as copies from (
  select o_orderkey, o_custkey, o_orderstatus as status, -1 as c from orders
  union all select *, 1 from ({EDITED})) group by 1, 2, 3 having sum(c) <> 0
""")
def snapshot_diff(spark, sf):
    return changes.row_changes(*snapshots(spark, sf))


@query("select count(*) as rows, true as same_in_other_order, true as differs_when_edited from orders")
def fingerprint(spark, sf):
    """Equal for the same rows in any order, different once rows were edited."""
    before, after = snapshots(spark, sf)
    prints = (
        changes.fingerprint(before).withColumn("version", F.lit("before"))
        .unionByName(changes.fingerprint(before.orderBy("o_custkey")).withColumn("version", F.lit("sorted")))
        .unionByName(changes.fingerprint(after).withColumn("version", F.lit("after")))
    )
    of = lambda v: F.max(F.when(F.col("version") == v, F.col("checksum")))
    return prints.agg(
        F.max(F.when(F.col("version") == "before", F.col("rows"))).alias("rows"),
        (of("before") == of("sorted")).alias("same_in_other_order"),
        (of("before") != of("after")).alias("differs_when_edited"),
    )


@query("""
select event_id, ts, user_id, event_type, value, props from (select *, row_number() over
  (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1
""")
def latest_per_user(spark, sf):
    return latest_per_key(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])


@query("""
select o_orderkey, o_orderstatus as status, case when o_orderstatus = 'P' then 's1' else 's2' end as snapshot from orders
""")
def incremental_batch(spark, sf):
    """Two landed snapshots, streamed into a history, the newest state per order."""
    landing, history = scratch_path(spark, "landing"), scratch_path(spark, "history")
    checkpoint = scratch_path(spark, "stream")
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    first = orders.withColumn("status", F.when(F.col("status") == "P", "P").otherwise("n"))
    first.withColumn("snapshot", F.lit("s1")).write.json(f"{landing}/s1")
    stream = spark.readStream.schema("o_orderkey bigint, status string, snapshot string").json(f"{landing}/*")
    keep_history(stream, history, checkpoint).awaitTermination()
    later = orders.where("status <> 'P'").withColumn("snapshot", F.lit("s2"))
    later.write.json(f"{landing}/s2")
    keep_history(stream, history, checkpoint).awaitTermination()
    return latest_records(spark, history, ["o_orderkey"], ["snapshot"])


@query("""
select event_id, ts, user_id, event_type, value, props from (select *, row_number() over
  (partition by user_id, event_type order by ts desc, event_id desc) as rn from events) where rn = 1
""")
def latest_state(spark, sf):
    """The newest record per user and type, kept as a state through four landings.

    Records are landed by the hour of the day they are of, so that each landing holds new
    keys, updates, and records older than what the state holds by then.
    """
    landing, state, checkpoint = (scratch_path(spark, n) for n in ("landing", "state", "stream"))
    events = table(spark, sf, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{landing}/*")
    quarter = F.hour("ts") % 4
    for part in (2, 0, 3, 1):
        events.where(quarter == part).write.parquet(f"{landing}/part-{part}")
        keep_state(stream, state, checkpoint, ["user_id", "event_type"], ["ts", "event_id"], buckets=16).awaitTermination()
    return current_records(spark, state)


_WIDTHS = {"doc_id": "cast(doc_id as varchar)", "text": "text", "lang": "lang", "source": "source"}


@query(
    " union all ".join(
        f"select '{c}' as \"column\", least(greatest({len(c)}, max(coalesce(length("
        f"case when substr(ltrim(v, ' '), 1, 1) in ('=', '+', '-', '@') then '''' || v else v end), 0))) + 2, 30) as width "
        f"from (select {e} as v from documents)"
        for c, e in _WIDTHS.items()
    )
    + " union all select 'Nr', max(length(cast(doc_id as varchar))) + 2 from documents"
)
def width_profile(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", F.col("doc_id").alias("Nr"))
    return reports.width_profile(docs, 30, uncapped=("Nr",))


@query("""
with labels as (select distinct c_mktsegment as label from customer union select 'A/B: empty?')
select 'lists' as report, label, 'Nach_Orten/' || translate(label, '/:?', '+') as path, count(c_custkey) as rows
from labels left join customer on c_mktsegment = label group by label
""")
def manifest_counts(spark, sf):
    customers = table(spark, sf, "customer")
    configured = counting.choice_frame(spark, ["A/B: empty?", "BUILDING"])
    labels = counting.choices_and_observed(configured, customers, "c_mktsegment")
    sizes = customers.groupBy(F.col("c_mktsegment").alias("label")).agg(F.count("*").alias("rows"))
    return reports.check_manifest(reports.manifest("lists", "Nach_Orten", labels, sizes))


@query("""
select c_custkey, c_name, c_mktsegment as folder,
  row_number() over (partition by c_mktsegment order by c_name, c_custkey) as nr from customer
""")
def fan_out(spark, sf):
    """One folder per group, written in one job and read back."""
    path = scratch_path(spark, "groups")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    numbered = number_rows(customers, ["c_name", "c_custkey"], group=["c_mktsegment"])
    reports.write_groups(numbered, path, "c_mktsegment", "nr")
    return spark.read.parquet(path).drop("c_mktsegment")


@query("""
select 'run-1' as run_id, 'Last updated:' || chr(10) || '01.07.2025 12:00' || chr(10) || chr(10) || 'ERROR occurred:' || chr(10) || 'odd'
  as updated, 'failed' as status, 'odd' as error, count(*) as input_rows, '0.1.0' as engine_version from orders
union all
select 'run-2', 'Last updated:' || chr(10) || '01.07.2025 12:00', 'success', null, count(*), '0.1.0' from orders
""")
def run_log_row(spark, sf):
    """Run records of a fixed time, appended one after the other and read back."""
    path = scratch_path(spark, "runs")
    seen = changes.fingerprint(table(spark, sf, "orders"))
    at = F.lit("2025-07-01T10:00:00Z").cast("timestamp")
    for run_id, status, error in (("run-1", "failed", "odd"), ("run-2", "success", None)):
        reports.append_rows(runs.run_rows(seen, run_id, at, "Europe/Berlin", status, error), path)
    log = spark.read.schema(runs.RUN_SCHEMA).parquet(path)
    return log.select("run_id", "updated", "status", "error", "input_rows", "engine_version")


@query("""
select row_number() over (order by n_name, c_name, c_custkey) as "Nr", n_name, c_name,
  case when c_mktsegment <> 'BUILDING' then c_acctbal end as c_acctbal, 'Finanzen/balances' as path
from customer join nation on c_nationkey = n_nationkey where c_mktsegment <> 'MACHINERY'
""")
def spec_run(spark, sf):
    """A report from a specification with a step of its own and its path."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumn(
        "given", F.nullif("c_mktsegment", F.lit("BUILDING"))
    )
    spec = ReportSpec(
        "balances", "rows", ("n_name", "c_name", "c_acctbal", "c_phone"), folder="Finanzen",
        where=(Where("c_mktsegment", "differs", "MACHINERY"),),
        step=clear_unless(["given"], ["c_acctbal"]), order=("n_name", "c_name"), ties=("c_custkey",),
    )
    return with_folder(run_spec(spec, {"rows": rows}), spec)


@query("select c_custkey, c_name from customer union all select c_custkey, c_name from customer where c_mktsegment = 'BUILDING'")
def report_roundtrip(spark, sf):
    """A report written, replaced, appended to and read back."""
    path = scratch_path(spark, "report")
    customers = table(spark, sf, "customer")
    reports.write_report(customers.select("c_custkey"), path)
    reports.write_report(customers.select("c_custkey", "c_name"), path, order="c_custkey")
    reports.append_rows(customers.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name"), path)
    return spark.read.parquet(path)


@query("select p_partkey, '''=' || p_name as p_name, cast(p_size as varchar) as p_size from part")
def csv_report(spark, sf):
    """CSV for exchange: header, formulas neutralised."""
    path = scratch_path(spark, "csv")
    part = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("="), "p_name").alias("p_name"), "p_size"
    )
    reports.write_report(part, path, "csv", order="p_partkey")
    return spark.read.option("header", True).schema("p_partkey bigint, p_name string, p_size string").csv(path)
