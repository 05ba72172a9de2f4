import pytest
from pyspark.sql import functions as F

from rollcall.operators.shaping import widen
from rollcall.plans.event import Landing, number_tickets, raw_report
from rollcall.session import configure
from rollcall.sources import catalogue, pages, registrations
from tests.landing import land_pages, order, position, write_json

QUESTIONS = [
    {"id": 1, "question": {"de": "Ort?"}},
    {"id": 2, "question": {"de": "", "en": "Yes"}},
    {"id": 3, "question": {"fr": "F", "en": "E"}},
    {"id": 4, "question": {"de": "Doppelt"}},
    {"id": 5, "question": {"de": "Doppelt"}},
    {"id": 6, "question": {"de": "Niemand"}},
    {"id": 7, "question": {"de": "email"}},
]
ITEMS = [{"id": 7, "name": {"de": "Kind"}}, {"id": 8, "name": {"de": "", "en": "Staff"}}]


@pytest.fixture
def landing(folder):
    def a(q, text):
        return {"question": q, "answer": text}

    orders = [
        [
            order("A", [
                position(10, item=7, answers=[a(1, "x"), a({"id": 4}, "first"), a(5, "last")]),
                position(11, item={"id": 9, "name": {"de": "Eingebettet"}}),
            ], invoice_address=None),
            order("B", []),
        ],
        [
            order("C", [position(12, item=99, answers=[a(77, "u"), a(2, "v")],
                                 attendee_name_parts=None)], status=None),
            order("D", [position(13, item=8, answers=[a(3, "w")])], status="e"),
        ],
    ]
    land_pages(folder, "orders", orders)
    land_pages(folder, "questions", [QUESTIONS[:4], QUESTIONS[4:]])
    land_pages(folder, "items", [ITEMS])
    return folder


def flat(spark, landing):
    return registrations.flat_positions(
        pages.read_pages(spark, f"{landing}/orders", pages.ORDER),
        catalogue.read_items(spark, f"{landing}/items"),
    )


def test_raw_table(spark, landing):
    configure(spark, case_sensitive=True)
    raw = number_tickets(flat(spark, landing))
    questions = catalogue.read_questions(spark, f"{landing}/questions")
    assert catalogue.question_texts(questions) == ["Ort?", "", "F", "Doppelt", "Niemand", "email"]
    wide = raw_report(raw, questions)
    assert wide.columns[1:24] == list(registrations.FIXED_COLUMNS)
    assert wide.columns[24:] == ["Ort?", "Doppelt", "question_77", "", "F", "Niemand", "email (#2)"]
    got = {r["position_id"]: r for r in wide.collect()}
    assert [got[i]["Nr"] for i in (10, 11, 12, 13)] == [0, 1, 2, 3]
    assert [got[i]["order_code"] for i in (10, 11, 12, 13)] == ["A", "A", "C", "D"]
    assert [got[i]["item_name"] for i in (10, 11, 12, 13)] == ["Kind", "Eingebettet", "Item 99", ""]
    assert [got[i]["item_id"] for i in (10, 11, 12, 13)] == [7, 9, 99, 8]
    assert [got[i]["invoice_city"] for i in (10, 12)] == ["", "Dorf"]
    assert [got[i]["attendee_lastname"] for i in (10, 12)] == ["L", ""]
    assert [got[i]["Doppelt"] for i in (10, 11)] == ["last", None]
    assert (got[12]["question_77"], got[12][""], got[13]["F"]) == ("u", "v", "w")
    assert {r["Niemand"] for r in got.values()} == {""} == {r["email (#2)"] for r in got.values()}
    assert got[12]["status"] is None and got[12]["email"] == "C@example.org"


def test_questions_of_equal_text_and_any_number(spark):
    """The last answer wins whichever question of the text it belongs to; no catalogue is too large."""
    questions = spark.range(6000).select(
        F.col("id"), F.when(F.col("id").isin(7, 5999), "Ort").otherwise(F.concat(F.lit("q"), "id")).alias("text"),
        F.lit(1).alias("page_no"), F.col("id").alias("record_pos"),
    )
    rows = [(1, [(7, "a"), (5999, "b"), (8, "x")]), (2, [(5999, "b"), (7, "a")]), (3, [(None, "n"), (6001, "u")]), (4, [])]
    df = spark.createDataFrame(rows, "i int, answers array<struct<id:bigint,answer:string>>")
    texts = ["Ort", "q8", "question_6001", "question_None", "question_8", "absent"]
    ids = catalogue.question_ids(questions, texts)
    assert ids == {"Ort": [7, 5999], "q8": [8], "question_6001": [6001], "question_None": [None]}
    wide = widen(df, "answers", {t: t for t in ids}, ids, ids=ids)
    assert [tuple(r) for r in wide.orderBy("i").collect()] == [
        (1, "b", "x", None, None), (2, "a", None, None, None), (3, None, None, "u", "n"), (4, None, None, None, None),
    ]
    assert len(catalogue.question_texts(questions)) == 5999
    used = catalogue.answered_questions(df, questions, ["i"])
    assert used == {"Ort": [7, 5999], "q8": [8], "question_None": [None], "question_6001": [6001]}


def test_answers_long_form(spark, landing):
    pages_read = pages.read_pages(spark, f"{landing}/orders", pages.ORDER)
    long = registrations.answer_rows(registrations.position_rows(registrations.order_rows(pages_read)))
    got = [(r["question_id"], r["answer"]) for r in long.orderBy(*registrations.ORDINAL, "answer_pos").collect()]
    assert got == [(1, "x"), (4, "first"), (5, "last"), (77, "u"), (2, "v"), (3, "w")]


def test_json_lines_landing(spark, landing, folder):
    one = spark.read.text(f"{landing}/orders", wholetext=True)
    named = one.select(
        F.expr("regexp_replace(value, '^\\\\{', concat('{\"page\": ', "
               "regexp_extract(_metadata.file_name, '([0-9]+)', 1)::int, ', '))").alias("value")
    )
    named.coalesce(1).write.text(f"{folder}/lines")
    lines = pages.read_pages(spark, f"{folder}/lines", pages.ORDER, lines=True)
    pages.check_complete(lines)
    files = pages.read_pages(spark, f"{landing}/orders", pages.ORDER)
    assert sorted(map(str, lines.collect())) == sorted(map(str, files.collect()))
    assert pages.records(lines).count() == 4


def test_incomplete_pages(spark, landing):
    def check():
        pages.check_complete(pages.read_pages(spark, f"{landing}/orders", pages.ORDER))

    check()
    write_json(f"{landing}/orders/page-000004.json", {"next": None, "results": []})
    with pytest.raises(ValueError):
        check()
    write_json(f"{landing}/orders/page-000003.json", {"next": "x", "results": []})
    with pytest.raises(ValueError):
        check()
    write_json(f"{landing}/orders/page-000002.json", {"next": "x", "results": []})
    check()
    write_json(f"{landing}/orders/page-000004.json", {"next": "x", "results": []})
    with pytest.raises(ValueError):
        check()


def test_no_tickets(spark, landing):
    land_pages(f"{landing}/none", "orders", [[], []])
    empty = registrations.flat_positions(
        pages.read_pages(spark, f"{landing}/none/orders", pages.ORDER),
        catalogue.read_items(spark, f"{landing}/items"),
    )
    with pytest.raises(ValueError, match="no registrations"):
        number_tickets(empty)


def test_answer_replaces_a_fixed_column_of_its_name(spark):
    df = spark.createDataFrame([("a", {"email": None}), ("b", {})], "email string, answers map<string,string>")
    wide = widen(df, "answers", {"email": "email"}, ["email"])
    assert [r["email"] for r in wide.collect()] == [None, "b"]


CHOICES = [
    ('{"id":1,"options":[{"answer":{"de":" Süd ","en":"South"}},{"answer":{"en":"N"}}]}', {"Süd", "N"}),
    ('{"id":1,"choices":["b"," ","a"],"options":"x"}', {"a", "b"}),
    ('{"id":1,"options":[],"choices":["b"]}', {"b"}),
    ('{"id":1,"options":[],"n":[1],"other":[{"id":3,"q":"txt"}],"more":["m"]}', {"txt"}),
    ('{"id":1,"options":[1,null,{"label":"","text":"t"},{"label":{"fr":"","it":"I"}},{"z":" "}]}', {"t", "I"}),
    ('{"id":1,"options":[{"label":{"de":5,"de-DE":"D"}},{"label":["l"],"title":"T"},{"zz":"Z","b":"B"}]}',
     {"D", "T", "Z"}),
    ('{"id":1,"options":["{\\"label\\":\\"x\\"}"]}', {'{"label":"x"}'}),
    ('{"id":1,"options":[{"name":"N","label":{"en-US":"US"}}]}', {"US"}),
    ('{"id":1,"question":{"de":"Q"}}', set()),
]


@pytest.mark.parametrize("document, expected", CHOICES)
def test_choices(spark, document, expected):
    df = spark.createDataFrame([(1, document)], "id bigint, document string")
    assert {r["label"] for r in catalogue.choice_texts(df).collect()} == expected


def test_choices_are_merged_and_sorted(spark):
    questions = spark.createDataFrame([(1, "Ort"), (2, " ORT"), (3, "x")], "id bigint, text string")
    details = spark.createDataFrame(
        [(1, '{"options":["b","a"]}'), (2, '{"options":["c","a"]}'), (3, '{"options":["z"]}')],
        "id bigint, document string",
    )
    got = catalogue.read_choices(questions, details, "ort").orderBy("position").collect()
    assert [tuple(r) for r in got] == [("a", 1), ("b", 2), ("c", 3)]
    with pytest.raises(ValueError):
        catalogue.read_choices(questions, details, "wo")


def test_landing_paths():
    assert Landing("/l/").path("orders") == "/l/orders"
