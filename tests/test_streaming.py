import glob
import os
import shutil
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rollcall.operators.collapsing import latest_per_key
from rollcall.plans import day_j
from rollcall.plans.event import Landing, current_report, run_event
from rollcall.plans.spec import EventConfig
from rollcall.sinks.runs import runs
from rollcall.streaming.polling import keep_history, latest_records, poll
from rollcall.streaming.state import apply_changes, current_records, vacuum, versions
from tests.landing import DEFAULT_CHOICES, event_of, order

ONCE = EventConfig(run_once=True)


def land(root, names):
    e = event_of(day_j, DEFAULT_CHOICES[day_j])
    place = day_j.FAMILY.place_question
    return e.land(root, [order(n, [e.ticket(i, n, n, {place: "Bonn"})]) for i, n in enumerate(names)])


def test_polling_runs_on_landed_snapshots(spark, folder):
    landing, out, checkpoint = f"{folder}/landing", f"{folder}/out", f"{folder}/checkpoint"

    def run(config=ONCE):
        poll(spark, day_j.FAMILY, landing, out, checkpoint, config).awaitTermination()
        return [r["status"] for r in runs(spark, out).orderBy("run_ts").collect()]

    land(f"{landing}/2025-01-01", ["a", "b", "c"])
    assert run() == ["success"]
    # Nothing landed, or the same rows again: a run record, no reports.
    assert run() == ["success", "unchanged"]
    land(f"{landing}/2025-01-02", ["c", "b", "a"][::-1])
    assert run() == ["success", "unchanged", "unchanged"]
    land(f"{landing}/2025-01-03", ["a", "b", "c", "d", "e"])
    assert run() == ["success", "unchanged", "unchanged", "success"]
    counts = current_report(spark, out, "Anmeldezahlen").orderBy("Nr").collect()
    assert [(r["Ortschaft"], r["Gesamt"]) for r in counts][:3] == [("GESAMT", 5), ("Aalen", 0), ("Bonn", 5)]


def test_late_page_of_an_old_snapshot_brings_nothing_back(spark, folder):
    landing, out, checkpoint = f"{folder}/landing", f"{folder}/out", f"{folder}/checkpoint"

    def run():
        poll(spark, day_j.FAMILY, landing, out, checkpoint, ONCE).awaitTermination()

    land(f"{landing}/s1", ["a", "b", "c"])
    run()
    land(f"{landing}/s2", ["a", "b", "c", "d", "e"])
    run()
    shutil.copy(f"{landing}/s1/orders/page-000001.json", f"{landing}/s1/orders/late-000001.json")
    run()
    log = runs(spark, out).orderBy("run_ts").collect()
    assert [r["status"] for r in log] == ["success", "success", "unchanged"]
    assert len({r["run_id"] for r in log}) == 3
    counts = current_report(spark, out, "Anmeldezahlen").orderBy("Nr").first()
    assert counts["Gesamt"] == 5


def test_page_landed_twice_or_missing_fails(spark, folder):
    whole = land(f"{folder}/whole", ["a", "b", "c"])
    for name, change in (
        ("twice", lambda s: shutil.copy(f"{s}/orders/page-000001.json", f"{s}/orders/again-000001.json")),
        ("items", lambda s: shutil.rmtree(f"{s}/items")),
        ("details", lambda s: shutil.rmtree(f"{s}/question_details")),
    ):
        shutil.copytree(whole, f"{folder}/{name}")
        change(f"{folder}/{name}")
        assert run_event(spark, day_j.FAMILY, Landing(f"{folder}/{name}"), f"{folder}/out-{name}") == "failed"
    assert run_event(spark, day_j.FAMILY, Landing(whole), f"{folder}/out-whole") == "success"


def test_half_landed_snapshot_is_taken_up_again(spark, folder):
    landing, out, checkpoint = f"{folder}/landing", f"{folder}/out", f"{folder}/checkpoint"
    whole = land(f"{folder}/whole", ["a", "b", "c"])
    shutil.copytree(whole, f"{landing}/s1", ignore=shutil.ignore_patterns("page-000002.json"))
    shutil.copytree(f"{whole}/questions", f"{landing}/s1/questions", dirs_exist_ok=True)
    poll(spark, day_j.FAMILY, landing, out, checkpoint, ONCE).awaitTermination()
    shutil.copy(f"{whole}/orders/page-000002.json", f"{landing}/s1/orders/page-000002.json")
    poll(spark, day_j.FAMILY, landing, out, checkpoint, ONCE).awaitTermination()
    assert [r["status"] for r in runs(spark, out).orderBy("run_ts").collect()] == ["failed", "success"]


def test_catalogue_that_lands_late_is_a_reason_to_run(spark, folder):
    landing, out, checkpoint = f"{folder}/landing", f"{folder}/out", f"{folder}/checkpoint"
    whole = land(f"{folder}/whole", ["a", "b", "c"])
    shutil.copytree(whole, f"{landing}/s1", ignore=shutil.ignore_patterns("items"))
    poll(spark, day_j.FAMILY, landing, out, checkpoint, ONCE).awaitTermination()
    shutil.copytree(f"{whole}/items", f"{landing}/s1/items")
    poll(spark, day_j.FAMILY, landing, out, checkpoint, ONCE).awaitTermination()
    assert [r["status"] for r in runs(spark, out).orderBy("run_ts").collect()] == ["failed", "success"]


def test_history_takes_each_file_once(spark, folder):
    landing, table, checkpoint = f"{folder}/in", f"{folder}/history", f"{folder}/checkpoint"

    def run():
        stream = spark.readStream.schema("k string, v int, at string").json(landing)
        keep_history(stream, table, checkpoint).awaitTermination()

    first = spark.createDataFrame([("a", 1, "s1"), ("b", 1, "s1")], "k string, v int, at string")
    first.write.json(landing, mode="append")
    run()
    run()
    spark.createDataFrame([("a", None, "s2")], "k string, v int, at string").write.json(landing, mode="append")
    run()
    assert spark.read.parquet(table).count() == 3
    latest = latest_records(spark, table, ["k"], ["at"])
    assert {tuple(r) for r in latest.collect()} == {("a", None, "s2"), ("b", 1, "s1")}
    assert latest_per_key(first, ["k"], ["at"]).count() == 2


def test_failed_run_is_tried_again_at_the_next_tick(spark, folder):
    """At intervals too: no file has landed since, and every tick leaves a record."""
    landing, out = f"{folder}/landing", f"{folder}/out"
    os.makedirs(landing)

    def statuses():
        return [r["status"] for r in runs(spark, out).orderBy("run_ts").collect()]

    def run(family, checkpoint, records):
        query = poll(spark, family, landing, out, f"{folder}/{checkpoint}", replace(ONCE, run_once=False, interval_minutes=0.02))
        until = time.time() + 120
        while len(statuses()) < records and query.exception() is None and time.time() < until:
            time.sleep(0.2)
        query.stop()
        return statuses()

    wrong = replace(day_j.FAMILY, place_question="no such question")
    assert set(run(wrong, "first", 2)) == {"failed"}
    assert "nothing has landed" in spark.read.parquet(f"{out}/_run_errors").first()["error"]
    land(f"{landing}/s1", ["a", "b", "c"])
    before = len(statuses())
    failed = run(wrong, "first", before + 2)
    assert set(failed) == {"failed"} and len(failed) >= before + 2
    good = run(day_j.FAMILY, "first", len(failed) + 3)[len(failed):]
    assert good[0] == "success" and set(good[1:]) == {"unchanged"}


def test_state_of_records(spark, folder):
    """Only touched buckets are rewritten; late older records and repeated batches change nothing."""
    table, schema = f"{folder}/state", "k int, g string, at int, v string"
    put = lambda version, *changes: apply_changes(table, spark.createDataFrame(changes, schema), ["k", "g"], ["at"], version, buckets=50)
    held = lambda: {(r.k, r.g): (r.at, r.v) for r in current_records(spark, table, schema).collect()}
    assert held() == {}
    with pytest.raises(ValueError):
        current_records(spark, table)
    first = [(i, "a", 5, f"first {i}") for i in range(200)] + [(None, None, 5, "no key"), (7, "a", 4, "older"), (8, "a", 6, "newer")]
    assert put(0, *first) > 40
    expected = {(i, "a"): (5, f"first {i}") for i in range(200)} | {(None, None): (5, "no key"), (8, "a"): (6, "newer")}
    assert held() == expected
    # An update, a late older record, a new key: three buckets at most, the other files stay.
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{table}/version=0/*/*.parquet")}
    change = [(3, "a", 9, "update"), (4, "a", 1, "late"), (500, "new", 1, "new"), (None, None, 6, None)]
    assert put(1, *change) <= 4
    expected |= {(3, "a"): (9, "update"), (500, "new"): (1, "new"), (None, None): (6, None)}
    assert held() == expected
    rewritten = versions(spark, table).where("version = 1").agg(F.sum("rows")).first()[0]
    assert rewritten < 40 and all(os.path.getmtime(f) == t for f, t in files.items())
    # The same batch again, as after a failure, and one without records.
    assert put(1, *change) <= 4 and held() == expected
    assert put(2) == 0 and held() == expected
    # A version whose files were written but never recorded does not count.
    shutil.copytree(f"{table}/version=1", f"{table}/version=9")
    assert held() == expected
    assert vacuum(spark, table) >= 1 and held() == expected
    with pytest.raises(ValueError):
        apply_changes(table, spark.createDataFrame(change, schema), ["k", "g"], ["at"], 3, buckets=51)


def test_triggers():
    from rollcall.streaming.polling import _trigger

    assert _trigger(ONCE) == {"availableNow": True}
    assert _trigger(replace(ONCE, run_once=False, interval_minutes=5)) == {"processingTime": "300 seconds"}
