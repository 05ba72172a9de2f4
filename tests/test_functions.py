import random

import pytest
from pyspark.sql import functions as F

from rollcall.functions import text, times, values
from rollcall.functions.nested import embedded, pick_label, union_id, variant_id


def one(spark, value, expr, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expr("x").alias("y")).first()["y"]


def column(spark, values_, expr, kind="string"):
    df = spark.createDataFrame(list(enumerate(values_)), f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr("x").alias("y")).orderBy("i").collect()]


def test_strip_takes_white_space_of_any_script(spark):
    raw = ["\ta  b\n", "  　x \x1c", " \n ", None, ""]
    assert column(spark, raw, text.strip) == ["a  b", "x", "", None, ""]
    assert column(spark, raw, text.blank_to_null) == ["a  b", "x", None, None, None]


def test_strip_equals_python_strip(spark):
    everything = [f"{chr(c)}a{chr(c)}" for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    assert column(spark, everything, text.strip) == [s.strip() for s in everything]
    collapsed = ["".join(" " if ch.isspace() else ch for ch in s) for s in everything]
    assert column(spark, everything, text.collapse_blanks) == collapsed


@pytest.mark.parametrize(
    "parts, tidy, plain",
    [
        ((None, "", " ", None, ""), ", ,", ",  , "),
        (("S 1 ", "7", "Ort", "DE", "Dorf"), "S 1, 7 Ort (Dorf), DE", "S 1, 7 Ort (Dorf), DE"),
        (("S", "7", "a  b", "DE", None), "S, 7 a b, DE", "S, 7 a  b, DE"),
    ],
)
def test_address(spark, parts, tidy, plain):
    df = spark.createDataFrame([parts], "a string, b string, c string, d string, e string")
    row = df.select(
        text.address("a", "b", "c", "d", district="e", tidy=True).alias("tidy"),
        text.address("a", "b", "c", "d", district="e").alias("plain"),
        text.strip(text.address("a", "b", "c", "d")).alias("town"),
    ).first()
    assert (row["tidy"], row["plain"]) == (tidy, plain)
    if parts[0] is None:
        assert row["town"] == ",  ,"


def test_payee(spark):
    rows = [("N", "C"), ("N", ""), ("", "C"), ("", ""), (None, " C "), ("N ", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, n string, c string")
    got = [r[0] for r in df.orderBy("i").select(text.payee("n", "c")).collect()]
    assert got == ["N (C)", "N", "C", "", "C", "N"]


def test_escape_formula(spark):
    raw = ["=1", "+49", "a-b", None, "  @x", "-", "", "'="]
    assert column(spark, raw, text.escape_formula) == [
        "'=1", "'+49", "a-b", None, "'  @x", "'-", "", "'=",
    ]


def test_file_name(spark):
    assert one(spark, 'a/b:c*"?<x>|\\\t%d', text.file_name) == "a+bc_x___ d"
    assert one(spark, " \n% a ", text.file_name) == "a"


def stable_path(path):
    """The path rules applied one at a time until nothing changes any more."""
    for old, new in zip('\n\r\t<>|', "   ___"):
        path = path.replace(old, new)
    path = "".join(c for c in path if c not in ':"?*%').strip()
    while path.endswith("."):
        path = path.rstrip(".").strip()
    pairs = [(f"{gone}{s}", s) for s in "/\\" for gone in (".", s, " ")]
    pairs += [(f"{s} ", s) for s in "/\\"]
    before = None
    while before != path:
        before = path
        for old, new in pairs:
            path = path.replace(old, new)
    return path


def test_folder_path_equals_the_rules_applied_until_stable(spark):
    rng = random.Random(3)
    raw = ["".join(rng.choices("ab./\\ .:\t ", k=rng.randint(0, 14))) for _ in range(3000)]
    raw += ["A/B/C", "a/../b", "../x", "x. . .", "...", "a / b"]
    assert column(spark, raw, text.folder_path) == [stable_path(p) for p in raw]


def test_ancestors(spark):
    raw = ["A/B/C", "/A/B/", "A//B", "", "A\\", "//A"]
    assert column(spark, raw, text.ancestors) == [
        ["A", "A/B", "A/B/C"], ["/A", "/A/B"], ["A", "A//B"], [], ["A"], ["//A"],
    ]


def test_path_parts(spark):
    raw = ["a/b/c.txt", "c.txt", "a//c", "a/"]
    assert column(spark, raw, text.parent_folder) == ["a/b", "", "a", "a"]
    assert column(spark, raw, text.base_name) == ["c.txt", "c.txt", "c", ""]
    add = lambda c: text.with_suffix(c, ".txt")
    assert column(spark, raw, add) == ["a/b/c.txt", "c.txt", "a//c.txt", "a/.txt"]
    ignoring = lambda c: text.with_suffix(c, ".txt", ignore_case=True)
    assert column(spark, ["X.TXT", "x"], ignoring) == ["X.TXT", "x.txt"]
    assert column(spark, ["a/../b", "a..b", "x/..", None], text.climbs_out) == [
        True, False, True, False,
    ]


def test_minutes_in_zone(spark):
    raw = [
        "2025-03-30T00:59:59.123456+00:00", "2025-03-30T01:00:00Z", "2025-07-01T10:00:00+02:00",
        "2025-01-05T10:00:00Z", None,
    ]
    show = lambda c: times.iso_minute_text(c, "Europe/Berlin")
    assert column(spark, raw, show) == [
        "2025-03-30 01:59", "2025-03-30 03:00", "2025-07-01 10:00", "2025-01-05 11:00", None,
    ]
    with pytest.raises(Exception):
        one(spark, "soon", show)


def test_null_rules_of_predicates(spark):
    raw = ["storniert", None, "e"]
    assert column(spark, raw, lambda c: values.differs(c, "storniert")) == [False, True, True]
    assert column(spark, raw, lambda c: values.equals(c, "e")) == [False, False, True]
    kinds = ["Jungscharler Kind", None, "Mitarbeiter"]
    assert column(spark, kinds, lambda c: values.has_text(c, "Jungscharler")) == [True, False, False]
    assert column(spark, ["n", " ", None, " "], values.not_blank) == [True, False, False, False]


def test_value_rules(spark):
    words = lambda c: values.map_values(c, {"a": "b", "b": "c"})
    assert column(spark, ["a", "b", "x", None], words) == ["b", "c", "x", None]
    mark = lambda c: values.mark_given(c, "up")
    assert column(spark, ["f.pdf", " ", "", None], mark) == ["up", " ", "", None]
    rank = lambda c: values.rank_of(c, ["n", "p"])
    assert column(spark, ["p", "n", "e", None], rank) == [1, 0, None, None]
    rows = [("A", "B", "C"), ("", "B", "C"), ("Sonstige", "", "C"), (None, None, ""), (" ", "B", "C")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string")
    got = df.orderBy("i").select(values.first_usable("a", "b", "c", "Sonstige")).collect()
    assert [r[0] for r in got] == ["A", "B", "C", "", " "]


def test_flags_and_labels(spark):
    df = spark.createDataFrame([("Ja", None), ("Nein", "x"), ("Ja", "Ja")], "a string, b string")
    got = df.select(text.join_flags({"V": "a", "L": "b"})).collect()
    assert [r[0] for r in got] == ["V", "", "V, L"]
    names = spark.createDataFrame([("x", 1), (None, 9), (None, None)], "n string, k bigint")
    got = names.select(text.label_or_default("n", "Item ", "k")).collect()
    assert [r[0] for r in got] == ["x", "Item 9", "Item None"]


def test_nested_values(spark):
    raw = ["7", '{"id":5,"name":{"de":"x"}}', None, "[1]"]
    assert column(spark, raw, union_id) == [7, 5, None, None]
    parsed = lambda c: variant_id(F.parse_json(c))
    assert column(spark, raw, parsed) == [7, 5, None, None]
    labels = ['{"de":"","en":"Yes"}', '{"fr":"F","en":"E"}', '{"en":"E","de":"D"}', "{}", None]
    pick = lambda c: pick_label(F.from_json(c, "map<string,string>"))
    assert column(spark, labels, pick) == ["", "F", "D", None, None]


def test_objects_are_told_from_bare_ids_before_they_are_parsed(spark):
    ids = [("7", 7), (" 8 ", 8), ('{"id":9}', 9), (' \n{"id": 10}', 10), ("x", None), ("", None), (None, None), ("[1]", None)]
    assert column(spark, [v for v, _ in ids], union_id) == [w for _, w in ids]
    # To the parser a bare id is a broken record, which is a struct of nulls.
    named = column(spark, ["7", "x", '\t{"id":1,"name":{"de":"a"}}'], embedded)
    assert [n if n is None else n["name"] for n in named] == [None, None, {"de": "a"}]


def test_blank_to_null_walks_no_text_that_only_spaces_surround(spark):
    values_ = ["  a b ", " a　", " ü ", "\t", "   ", "", None, "a\x7f", "\x85 x \x1f"]
    expected = [v and (v.strip() or None) or None for v in values_]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values_)], "i int, v string")
    shown = df.select("i", text.blank_to_null("v").alias("v"))
    assert [r["v"] for r in shown.orderBy("i").collect()] == expected
    plan = shown._jdf.queryExecution().optimizedPlan().toString()
    assert "trim(v" in plan.split(" AND ")[0]


def test_formulas_and_ids_by_their_first_character(spark):
    """Shortcuts for visible ASCII beginnings against the rules in Python."""
    from rollcall.functions.nested import union_id
    from rollcall.functions.text import BLANKS, FORMULA_SIGNS, escape_formula

    begins = [*map(chr, range(1, 128)), *BLANKS, "Ä", "数", "🎲", ""]
    texts = [None, *[a + b for a in begins for b in ("", "x", "=x", " @", "{}")]]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape_formula("t").alias("e")).collect()
    wanted = lambda t: t if t is None or not t.lstrip(BLANKS).startswith(FORMULA_SIGNS) else "'" + t
    assert len(found) == len(texts) and all(r.e == wanted(r.t) for r in found)
    ids = ["7", " 7", "-7", '{"id":7}', ' \t{"id":7}', "\r\n7", '{"id":"x"}', '"7"', "Ä", None]
    got = [r.i for r in spark.createDataFrame([(i, t) for i, t in enumerate(ids)], "n int, t string").orderBy("n").select(union_id("t").alias("i")).collect()]
    assert got == [7, 7, -7, 7, 7, 7, None, None, None, None]


def test_nested_values_are_written_out_once(spark):
    """The sums are those of the values themselves, and each is turned into JSON once."""
    from rollcall.operators.changes import hash_sums, hashable

    df = spark.createDataFrame([(1, [(1, "a"), (None, None)], {"k": None}), (2, None, {}), (3, [], None)], "i int, a array<struct<id:int,t:string>>, m map<string,string>")
    sums = lambda d: d.agg(*[s.alias(n) for n, s in zip("xy", hash_sums(d))])
    assert sums(hashable(df)).collect() == sums(df).collect()
    written = lambda d: sums(d)._jdf.queryExecution().optimizedPlan().toString().lower().count("structstojson")
    assert written(hashable(df.select("a"))) == 1 < written(df.select("a"))
