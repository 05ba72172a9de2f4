import random
import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollcall.operators import changes, collapsing, counting, lookup, shaping
from rollcall.operators.numbering import RANGE, Ranging, ascending, number_rows, range_bounds, with_range
from rollcall.session import scratch
from rollcall.sinks.reports import escape_formulas, width_profile


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_rename_is_simultaneous(spark):
    df = spark.createDataFrame([("e", "w")], "E string, W string")
    renamed = shaping.rename(df, {"E": "EJN", "W": "E", "zz": "y"})
    assert renamed.columns == ["EJN", "E"] and rows(renamed) == [("e", "w")]
    back = shaping.rename(renamed, {"EJN": "E", "E": "W"})
    assert back.columns == df.columns and rows(back) == rows(df)
    with pytest.raises(ValueError):
        shaping.rename(df, {"E": "W"})


def test_projections(spark):
    df = spark.createDataFrame([(1, 2)], "b int, `a.x: (y)?` int")
    assert shaping.select_known(df, ["a.x: (y)?", "zz", "b"]).columns == ["a.x: (y)?", "b"]
    assert shaping.drop_columns(df, ["a.x: (y)?"]).columns == ["b"]
    with pytest.raises(ValueError):
        shaping.drop_columns(df, ["zz"])
    assert rows(shaping.add_missing(df, ["b", "n"])) == [(1, 2, None)]
    assert shaping.text_columns(shaping.add_missing(df, ["n"])) == ["n"]


def test_unique_name():
    assert shaping.unique_name("x", ["a"]) == "x"
    assert shaping.unique_name("x", ["x", "x (#2)"]) == "x (#3)"


def test_widen(spark):
    df = spark.createDataFrame(
        [(1, "m", {"q": "a", "email": "e"}), (2, "m", {"q": ""}), (3, "m", {})],
        "i int, email string, answers map<string,string>",
    )
    columns = {"q": "q", "email": "email", "n": "n (#2)"}
    wide = shaping.widen(df, "answers", columns, ["q", "email"])
    assert wide.columns == ["i", "email", "q", "n (#2)"]
    assert rows(wide, "i") == [(1, "e", "a", ""), (2, "m", "", ""), (3, "m", None, "")]
    with pytest.raises(ValueError):
        shaping.widen(df, "answers", columns, ["q", "email"], collisions="raise")


def test_pivot_last(spark):
    df = spark.createDataFrame(
        [("k", "a", 1, "x"), ("k", "a", 2, "y"), ("k", "b", 1, None), ("l", "b", 1, "z")],
        "k string, n string, o int, v string",
    )
    wide = shaping.pivot_last(df, ["k"], "n", "v", ["o"], ["a", "b", "c"])
    assert rows(wide, "k") == [("k", "y", None, None), ("l", None, "z", None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_numbers_equal_a_plain_window(spark, seed):
    """Also where one name is shared by most rows, and with nulls and blanks."""
    rng = random.Random(seed)
    names = ["hot"] * 6 + ["", None, "Bach", "adler", "Äcker", "Zorn"]
    data = [(i, rng.choice(names), rng.choice(names)) for i in range(2000)]
    df = spark.createDataFrame(data, "i int, n string, g string").repartition(7)
    order = ascending("n", "i")
    naive = df.withColumn("nr", F.row_number().over(W.orderBy(*order)).cast("bigint"))
    assert rows(number_rows(df, ["n", "i"]), "i") == rows(naive, "i")
    naive = df.withColumn(
        "nr", (F.row_number().over(W.partitionBy("g").orderBy(*order)) + 6).cast("bigint")
    )
    got = number_rows(df, ["n", "i"], group=["g"], start=7)
    assert rows(got.select(*naive.columns), "i") == rows(naive, "i")


FINE = Ranging(rows=50, least_rows=1, sampled=8)


def test_numbering_by_many_ranges(spark):
    """Bounds cut groups, ties of keys, nulls and equal rows anywhere; numbers are those of one window."""
    df = spark.range(3000).select(
        F.col("id").alias("i"),
        F.expr("case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else concat('n', id % 11) end").alias("n"),
        F.expr("case when id % 5 < 2 then 'big' when id % 5 = 2 then null else cast(id % 600 as string) end").alias("g"),
        F.expr("cast(id % 13 as decimal(5,1)) / 2").alias("d"),
        F.expr("timestamp '2025-01-01 00:00:00' + make_interval(0, 0, 0, id % 17)").alias("t"),
    )
    order = ["n", "d", "t", "i"]
    naive = df.withColumn("nr", F.row_number().over(W.orderBy(*ascending(*order))).cast("bigint"))
    numbered = number_rows(df, order, ranging=FINE)
    assert rows(numbered, "i") == rows(naive, "i")
    # In the order of its partitions: what is written is sorted.
    assert [r["nr"] for r in numbered.collect()] == list(range(1, 3001))
    naive = df.withColumn("nr", F.row_number().over(W.partitionBy("g").orderBy(*ascending(*order))).cast("bigint"))
    assert rows(number_rows(df, order, group=["g"], ranging=FINE), "i") == rows(naive, "i")
    twice = df.select("g").unionByName(df.select("g"))
    assert [r["nr"] for r in number_rows(twice, ["g"], ranging=FINE).collect()] == list(range(1, 6001))


def test_hot_key_is_spread_over_ranges(spark):
    df = spark.range(20000).select("id", F.lit("same").alias("n"))
    bounds = range_bounds(df, ["n", "id"], Ranging(rows=1000))
    sizes = [r["count"] for r in with_range(df, ["n", "id"], bounds).groupBy(RANGE).count().collect()]
    assert len(sizes) == bounds.ranges == 20 and max(sizes) < 2500


def test_numbering_writes_nothing_and_shuffles_rows_once(spark):
    with scratch(spark) as made:
        df = spark.range(9000).select("id", F.hash("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("wide"))
        numbered = number_rows(df, ["k", "id"], ranging=FINE)
        plan = numbered._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert made == []
    exchanges = [line for line in plan.splitlines() if re.search(r"[-+ ]Exchange ", line)]
    # The rows themselves, the counts per range, and these in order.
    assert sum("shufflepartitionidpassthrough" in line for line in exchanges) == 1 and len(exchanges) == 3


def test_numbering_an_empty_table(spark):
    df = spark.createDataFrame([], "i int, g string")
    assert rows(number_rows(df, ["i"], group=["g"])) == []


def test_sort_is_by_code_point_with_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, "b", None), (2, None, "q"), (3, "a", None), (4, "a", "z")], "i int, n string, v string"
    )
    numbered = number_rows(df, ["n", "v", "i"])
    assert [r["i"] for r in numbered.orderBy("nr").collect()] == [4, 3, 1, 2]
    words = spark.createDataFrame([("Zorn",), ("Äcker",), ("adler",), ("Bach",)], "n string")
    got = [r["n"] for r in number_rows(words, ["n"]).orderBy("nr").collect()]
    assert got == ["Bach", "Zorn", "adler", "Äcker"]


def test_collapse(spark):
    df = spark.createDataFrame(
        [(1, "B", None, "Nein"), (2, "A", None, None), (3, "A", "x", "Ja"), (4, None, "z", "Ja")],
        "o int, k string, v string, z string",
    )
    got = collapsing.collapse(df, "k", ["v"], ["z"], ["o"])
    assert rows(got, "k") == [("A", "x", "Ja"), ("B", None, "Nein")]


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, t int, v string")
    assert rows(collapsing.latest_per_key(df, ["k"], ["t"]), "k") == [("a", 2, None), ("b", 1, "y")]


def test_counts_per_choice(spark):
    df = spark.createDataFrame(
        [("a", "kid"), ("a", None), ("b", "kid"), (None, "staff"), ("other", "kid")], "p string, c string"
    )
    choices = counting.choice_frame(spark, ["a", "b", "none", "gone"])
    edited = counting.edit_choices(choices, "gone", "last")
    got = counting.counts_per_choice(
        df, "p", edited, {"kids": F.col("c").contains("kid"), "all": None}, "TOTAL"
    )
    assert rows(got, "position") == [
        ("TOTAL", 0, 3, 5), ("a", 1, 1, 2), ("b", 2, 1, 1), ("none", 3, 0, 0), ("last", 5, 0, 0),
    ]
    with pytest.raises(ValueError):
        counting.edit_choices(choices, "absent", "last")
    empty = counting.counts_per_choice(df.limit(0), "p", choices, {"all": None}, "TOTAL")
    assert {r[2] for r in rows(empty)} == {0}
    again = counting.edit_choices(choices, "gone", "a")
    assert rows(again, "position") == [("a", 1), ("b", 2), ("none", 3)]


def test_counts_per_category_overlap(spark):
    df = spark.createDataFrame(
        [("veg, pork", "kid"), ("veg", "staff"), (None, "kid"), ("x", None)], "d string, c string"
    )
    got = counting.counts_per_category(
        df, "d", ["veg", "pork", "fish"], {"kids": F.col("c") == "kid", "all": None}, "SUM"
    )
    assert rows(got, "position") == [("veg", 1, 1, 2), ("pork", 2, 1, 1), ("fish", 3, 0, 0), ("SUM", 4, 2, 4)]


def test_choices_and_observed(spark):
    df = spark.createDataFrame([(" b ",), ("c",), (None,), ("a",)], "p string")
    got = counting.choices_and_observed(counting.choice_frame(spark, ["a", "b"]), df, "p")
    assert rows(got, "label") == [("a",), ("b",), ("c",)]


def test_lookups(spark):
    df = spark.createDataFrame([(1, None), (9, None), (2, "own"), (None, None)], "k bigint, e string")
    names = spark.createDataFrame([(1, "one"), (2, "two")], "id bigint, text string")
    got = lookup.lookup_name(df, "k", names, "Item ", "name", embedded="e")
    assert sorted(r["name"] for r in got.collect()) == ["Item 9", "Item None", "one", "own"]
    texts = spark.createDataFrame([(1, " Ort? "), (2, "ort?"), (3, "x"), (4, None)], "id int, text string")
    assert rows(lookup.matching_text(texts, "text", "ORT? ").select("id"), "id") == [(1,), (2,)]
    for missing in ("nowhere", "  "):
        with pytest.raises(ValueError):
            lookup.matching_text(texts, "text", missing)
    other = spark.createDataFrame([("ORT?",), ("ort? ",)], "t string")
    assert rows(lookup.matching_rows(texts, "text", other, "t").select("id"), "id") == [(1,), (2,)]


def test_fingerprint(spark):
    schema = "a string, b string, m map<string,string>"
    base = [("a", None, {"x": "1", "y": "2"}), (None, "b", {}), ("d", "d", None), ("d", "d", None)]

    def checksum(data, **kw):
        return changes.fingerprint(spark.createDataFrame(data, schema).repartition(3), **kw).first()

    same = checksum(base)
    assert same["rows"] == 4
    assert checksum(base[::-1]) == same
    assert checksum([("a", None, {"y": "2", "x": "1"}), *base[1:]]) == same
    edits = [
        [(None, "a", base[0][2]), *base[1:]], [*base[:3]], [*base, base[3]],
        [("a", "", base[0][2]), *base[1:]], [("a", None, {"x": "1", "y": "3"}), *base[1:]],
        [*base[:2], ("e", "e", None), ("e", "e", None)],
    ]
    for edited in edits:
        assert checksum(edited)["checksum"] != same["checksum"]
    ignoring = checksum(base, ignore=["a", "b"])
    assert checksum([("z", "z", r[2]) for r in base], ignore=["a", "b"]) == ignoring


def test_row_changes(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), (None, 2)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 1), ("c", 3), ("c", 3), (None, 2)], "k string, v int")
    assert rows(changes.row_changes(old, new), "k") == [("b", 1, -1), ("c", 3, 2)]
    assert rows(changes.row_changes(old, old.repartition(2))) == []


def test_width_profile(spark):
    df = spark.createDataFrame(
        [(1, "=1", None), (100000, "x" * 50, "ab")], "Nr bigint, long string, `header is long` string"
    )
    got = dict(rows(width_profile(df, 30, ("Nr",))))
    assert got == {"Nr": 8, "long": 30, "header is long": 16}
    one = spark.createDataFrame([("=1234",)], "c string")
    assert rows(width_profile(one)) == [("c", 8)]
    assert rows(width_profile(one.limit(0))) == [("c", 3)]
    assert rows(escape_formulas(df).select("long").limit(1))[0][0] in ("'=1", "x" * 50)


def test_fingerprint_sees_a_value_moved_between_null_answers(spark):
    from rollcall.operators.changes import fingerprint

    def of(sql):
        return fingerprint(spark.sql(f"select {sql} as m")).first()["checksum"]

    assert of("map('x', null, 'y', 'z')") != of("map('x', 'y', 'z', null)")
    assert of("map('x', null, 'y', 'z')") == of("map('y', 'z', 'x', null)")


def test_answers_are_read_in_place_without_a_map(spark):
    schema = "n int, answers array<struct<id:bigint,answer:string>>"
    given = [(1, [(1, "a"), (2, None), (None, "x"), (1, "b")]), (2, []), (3, None), (4, [(2, "c"), (3, "d"), (2, "e"), (3, None)])]
    df = spark.createDataFrame(given, schema)
    wide = shaping.widen(df, "answers", {"A": "A", "B": "B", "C": "n"}, ["A", "B", "C"], ids={"A": [1], "B": [2], "C": [3]})
    found = sorted(map(tuple, wide.collect()), key=str)
    assert found == sorted([("1", "b", None), ("2", None, None), ("3", None, None), (None, None, "e")], key=str)
    assert "map_from_entries" not in wide._jdf.queryExecution().optimizedPlan().toString()


def test_a_range_is_small_enough_for_one_task():
    assert Ranging().rows <= 1 << 18
