"""Ingestion: pages, positions, answers, lookups, choices."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions.nested import pick_label, variant_id
from rollcall.harness import documents
from rollcall.harness.documents import ANSWERS_SQL, ORDERS_SQL, POSITIONS_SQL
from rollcall.harness.registry import query, spread, table
from rollcall.operators.lookup import lookup_name, matching_rows
from rollcall.operators.numbering import number_rows
from rollcall.operators.shaping import pivot_last, widen
from rollcall.plans.event import number_tickets, raw_report
from rollcall.session import scratch_path
from rollcall.sources import registrations
from rollcall.sources.catalogue import answered_texts, choice_texts, question_ids, with_unique_texts
from rollcall.sources.pages import ORDER, check_complete, read_pages

ORDER_FIELDS = ["page_no", "order_pos", "order_code", "status", "email", "total", "date",
                "invoice_name", "invoice_city"]
POSITION_FIELDS = ["position_pos", "position_id", "item_id", "price", "attendee_firstname",
                   "attendee_lastname"]


@query(f"select {', '.join(ORDER_FIELDS)} from ({ORDERS_SQL})")
def paged_scan(spark, sf):
    """Pages landed as JSON lines, read back, checked for completeness."""
    landing = scratch_path(spark, "landing")
    documents.page_documents(spark, sf).write.text(landing)
    pages = read_pages(spark, landing, ORDER, lines=True)
    check_complete(pages)
    return registrations.order_rows(pages).select(*ORDER_FIELDS)


@query(f"select {', '.join(ORDER_FIELDS + POSITION_FIELDS)} from ({POSITIONS_SQL})")
def unnest_positions(spark, sf):
    rows = registrations.position_rows(registrations.order_rows(documents.pages(spark, sf)))
    return registrations.tickets(rows).select(*ORDER_FIELDS, *POSITION_FIELDS)


@query(f"select page_no, order_pos, position_pos, answer_pos, cast(q as bigint) as question_id, answer from ({ANSWERS_SQL})")
def unnest_answers(spark, sf):
    rows = registrations.position_rows(registrations.order_rows(documents.pages(spark, sf)))
    return registrations.answer_rows(rows)


NAMED_SQL = f"""
select p.*, case when k in (1, 2) then 'again' when k = 0 then o_orderpriority end as q1,
  case when k in (1, 2) then cast(o_custkey as varchar) end as q2, case when k = 2 then '' end as q77
from ({POSITIONS_SQL}) p
"""


ASKED = {"NATION_1": "q1", "NATION_2": "q2", "question_77": "q77"}


def _asked(rows, questions):
    """Columns for the texts asked for: ids looked up, answers read inside the row."""
    return widen(rows, "answers", ASKED, ASKED, ids=question_ids(questions, ASKED))


@query(f"select position_id, q1, q2, q77 from ({NAMED_SQL})")
def map_answers(spark, sf):
    """Answers by question text, read inside the row."""
    rows = registrations.position_rows(registrations.order_rows(documents.pages(spark, sf)))
    tickets = registrations.tickets(rows).select("position_id", "answers")
    return _asked(tickets, documents.questions(spark, sf))


@query(f"select position_id, q1, q2, q77 from ({NAMED_SQL})")
def map_answers_joined(spark, sf):
    """The same from the long form: exploded, joined with the catalogue, put back."""
    rows = registrations.position_rows(registrations.order_rows(documents.pages(spark, sf)))
    tickets = registrations.tickets(rows).select("position_id", "answers")
    long = registrations.named_answers(tickets, documents.questions(spark, sf), ["position_id"])
    wide = pivot_last(long, ["position_id"], "text", "answer", ["answer_pos"], list(ASKED))
    return tickets.select("position_id").join(wide, "position_id", "left").select(
        "position_id", *[F.col(t).alias(c) for t, c in ASKED.items()]
    )


FLAT_SQL = f"""
select p.*, case k when 1 then 'Own ' || cast(o_custkey as varchar)
  else coalesce(c_name, 'Item ' || cast(item_id as varchar)) end as item_name,
  row_number() over (order by page_no, order_pos, position_pos) - 1 as "Nr"
from ({NAMED_SQL}) p left join customer on c_custkey = item_id
"""


def flat(spark, sf):
    return registrations.flat_positions(documents.pages(spark, sf), documents.items(spark, sf))


@query(f"""
select page_no, order_pos, position_pos, "Nr", order_code, status, email, total, date, invoice_name, invoice_city, position_id, item_id,
  item_name, price, attendee_firstname, attendee_lastname, q1, q2, q77 from ({FLAT_SQL})
""")
def flat_positions(spark, sf):
    """The whole ingestion: unnest, look up, check pages, number from 0."""
    raw = number_tickets(flat(spark, sf))
    return _asked(raw, documents.questions(spark, sf)).select(
        "page_no", "order_pos", "position_pos", "Nr", "order_code", "status", "email", "total", "date", "invoice_name",
        "invoice_city", "position_id", "item_id", "item_name", "price", "attendee_firstname",
        "attendee_lastname", "q1", "q2", "q77",
    )


UNASKED = [0, *range(3, 25)]


@query(f"""
select "Nr", order_code, status, email, total, date, invoice_name,
  case when status = 'c' then '' end as invoice_company, case when status = 'c' then '' end as invoice_street,
  case when status = 'c' then '' end as invoice_zipcode, invoice_city,
  case when status = 'c' then '' end as invoice_country, case when status = 'c' then '' end as invoice_vat_id,
  position_id, item_id, item_name, price, attendee_firstname, attendee_lastname,
  cast(null as varchar) as attendee_email, cast(null as varchar) as attendee_street,
  cast(null as varchar) as attendee_zipcode, cast(null as varchar) as attendee_city,
  cast(null as varchar) as attendee_country,
  q1 as "NATION_1", q2 as "NATION_2", q77 as question_77,
  {', '.join(f"'' as " + chr(34) + f"NATION_{i}" + chr(34) for i in UNASKED)}
from ({FLAT_SQL})
""")
def report_raw(spark, sf):
    """The raw report: one column per question, unanswered ones empty."""
    raw = number_tickets(flat(spark, sf))
    return raw_report(raw, documents.questions(spark, sf))


LATEST_SQL = """
select user_id, event_type, value from (select *, row_number() over
  (partition by user_id, event_type order by ts desc, event_id desc) as rn from events) where rn = 1
"""
TYPES = ["click", "error", "purchase", "signup", "view"]


@query(f"""
select user_id, {', '.join(f"max(case when event_type = '{t}' then value end) as {t}" for t in [*TYPES, 'refund'])}
from ({LATEST_SQL}) group by user_id
""")
def pivot_answers(spark, sf):
    """Long to wide over declared names, the last value winning, one name never used."""
    return pivot_last(
        table(spark, sf, "events"), ["user_id"], "event_type", "value", ["ts", "event_id"],
        [*TYPES, "refund"],
    )


@query(f"""
select event_id, {', '.join(f"case when event_type = '{t}' then props end as {t}" for t in TYPES)}, '' as refund
from events
""")
def backfill_unanswered(spark, sf):
    """A declared name nobody used becomes a column of empty text, others hold nulls."""
    rows = table(spark, sf, "events").select(
        "event_id", F.create_map("event_type", "props").alias("answers")
    )
    declared = {t: t for t in [*TYPES, "refund"]}
    return widen(rows, "answers", declared, answered_texts(rows, ["event_id"]))


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as id from events")
def json_union_id(spark, sf):
    """An id that comes bare or inside an object."""
    bare = F.get_json_object("props", "$.k")
    wrapped = F.concat(F.lit('{"name": {}, "id": '), bare, F.lit("}"))
    value = F.when(F.col("event_type").isin("click", "view"), bare).otherwise(wrapped)
    return table(spark, sf, "events").select("event_id", variant_id(F.parse_json(value)).alias("id"))


@query("select doc_id, case when lang = 'de' then source else text end as label from documents")
def localised_pick(spark, sf):
    labels = F.expr(
        "case lang when 'de' then map('en', text, 'de', source) when 'es' then map('es', text, 'de', '') "
        "else map(lang, text) end"
    )
    return table(spark, sf, "documents").select("doc_id", pick_label(labels).alias("label"))


OPTIONS = """
case event_type
  when 'click' then concat('{"options":[{"answer":{"en":"x","de":" K', k, ' "}},{"label":"', user_id, '"},5]}')
  when 'view' then concat('{"x":["no"],"choices":["', k, '"," ","v"]}')
  when 'error' then concat('{"options":[],"n":[1],"other":[{"id":3,"q":"E', k, '"}]}')
  when 'signup' then concat('{"options_list":[{"name":{"fr":"S', k, '"}},{"title":"","display":"T"}]}')
  else concat('{"id":', user_id, '}') end
"""


@query("""
with e as (select event_type, cast(user_id as varchar) as u, json_extract_string(props, '$.k') as k from events)
select 'K' || k as label from e where event_type = 'click'
union select u from e where event_type = 'click'
union select k from e where event_type = 'view'
union select 'v' from e where event_type = 'view'
union select 'E' || k from e where event_type = 'error'
union select 'S' || k from e where event_type = 'signup'
union select 'T' from e where event_type = 'signup'
""")
def choice_extract(spark, sf):
    """Readable options out of free-form question documents."""
    events = spread(table(spark, sf, "events"), "event_id").withColumn("k", F.get_json_object("props", "$.k"))
    return choice_texts(events.select(F.expr(OPTIONS).alias("document")))


@query("""
select p_partkey, case when n = 1 then p_name else p_name || ' (#' || cast(n as varchar) || ')' end as name
from (select p_partkey, p_name, row_number() over (partition by p_name order by p_partkey) as n from part)
""")
def unique_names(spark, sf):
    """Equal texts told apart by a suffix, in the order of their ids."""
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("name"))
    return with_unique_texts(parts, "name", ["p_partkey"])


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(p_name, 'Item ' || cast(l_partkey * 2 as varchar)) as name
from lineitem left join part on p_partkey = l_partkey * 2
""")
def lookup_default(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_partkey") * 2).alias("id2")
    )
    names = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text"))
    return lookup_name(lines, "id2", names, "Item ", "name").drop("id2")


@query("""
select p_partkey, p_name from part
where lower(trim(p_name)) in (select lower(trim(' ' || upper(p_name))) from part where p_type = 'PROMO' and p_size > 45)
""")
def normalised_semi(spark, sf):
    part = table(spark, sf, "part")
    wanted = part.where("p_type = 'PROMO' and p_size > 45").select(
        F.concat(F.lit(" "), F.upper("p_name")).alias("wanted")
    )
    return matching_rows(part.select("p_partkey", "p_name"), "p_name", wanted, "wanted")
