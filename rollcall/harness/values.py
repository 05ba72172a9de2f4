"""Scalar rules and predicates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions import text, times, values
from rollcall.functions.text import BLANKS
from rollcall.harness.registry import query, table
from rollcall.operators.shaping import blanks_to_null

# White space as a character class for engines whose \s knows ASCII only.
CLASS = "[" + BLANKS + "]"

STATUS = "case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderstatus end"


def orders_with_nulls(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.expr(STATUS).alias("status"))


@query(f"select * from (select o_orderkey, {STATUS} as status from orders) where status is distinct from 'F'")
def filter_null_keep(spark, sf):
    return orders_with_nulls(spark, sf).where(values.differs("status", "F"))


@query(f"select * from (select o_orderkey, {STATUS} as status from orders) where status = 'F'")
def filter_eq(spark, sf):
    return orders_with_nulls(spark, sf).where(values.equals("status", "F"))


@query("""
select p_partkey, p_name, coalesce(contains(nullif(p_name, 'red plate'), 'plate'), false) as is_plate
from part where contains(p_name, 'red') or contains(p_name, 'plate')
""")
def filter_contains(spark, sf):
    part = table(spark, sf, "part")
    hit = values.has_text("p_name", "red") | values.has_text("p_name", "plate")
    return part.where(hit).select(
        "p_partkey", "p_name",
        values.has_text(F.nullif("p_name", F.lit("red plate")), "plate").alias("is_plate"),
    )


@query(f"select * from (select o_orderkey, {STATUS} as status from orders) where status is not null")
def filter_notnull(spark, sf):
    return orders_with_nulls(spark, sf).where(F.col("status").isNotNull())


NOTE_A = "case lang when 'de' then text when 'es' then ' ' || chr(160) when 'fr' then '' end"
NOTE_B = "case source when 'src0' then source when 'src1' then chr(9) end"


@query(f"""
select doc_id, a, b from (select doc_id, {NOTE_A} as a, {NOTE_B} as b from documents)
where coalesce(trim(a, '{BLANKS}') <> '', false) or coalesce(trim(b, '{BLANKS}') <> '', false)
""")
def filter_nonblank_or(spark, sf):
    notes = table(spark, sf, "documents").select(
        "doc_id", F.expr(NOTE_A).alias("a"), F.expr(NOTE_B).alias("b")
    )
    return notes.where(values.not_blank("a", "b"))


@query(f"""
select o_orderkey, case status when 'F' then 'bezahlt' when 'O' then 'unbezahlt' else status end as status
from (select o_orderkey, {STATUS} as status from orders)
""")
def value_map(spark, sf):
    words = {"F": "bezahlt", "O": "unbezahlt"}
    return orders_with_nulls(spark, sf).select(
        "o_orderkey", values.map_values("status", words).alias("status")
    )


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case l_returnflag when 'A' then 'Ja' when 'N' then 'Nein' else l_returnflag end as l_returnflag,
  case l_linestatus when 'A' then 'Ja' when 'N' then 'Nein' else l_linestatus end as l_linestatus
from lineitem
""")
def multi_map(spark, sf):
    words = {"A": "Ja", "N": "Nein"}
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return table(spark, sf, "lineitem").select(
        *keys, *[values.map_values(c, words).alias(c) for c in ("l_returnflag", "l_linestatus")]
    )


@query("""
select event_id, case flag when 'True' then 'Ja' when 'true' then 'Ja'
  when 'False' then 'Nein' when 'false' then 'Nein' else flag end as flag
from (select event_id, case event_type when 'click' then 'True' when 'view' then 'False'
  when 'error' then cast(value > 20 as string) else event_type end as flag from events)
""")
def mixed_bool_map(spark, sf):
    flag = F.expr(
        "case event_type when 'click' then 'True' when 'view' then 'False' "
        "when 'error' then cast(value > 20 as string) else event_type end"
    )
    words = {"True": "Ja", "true": "Ja", "False": "Nein", "false": "Nein"}
    return table(spark, sf, "events").select("event_id", values.map_values(flag, words).alias("flag"))


@query("""
select o_orderkey, case when o_orderpriority = '4-NOT SPECIFIED' then 'none' else o_orderpriority end as priority
from orders
""")
def replace_one(spark, sf):
    short = values.map_values("o_orderpriority", {"4-NOT SPECIFIED": "none"})
    return table(spark, sf, "orders").select("o_orderkey", short.alias("priority"))


@query(f"""
select doc_id, case when trim(a, '{BLANKS}') <> '' then 'uploaded' else a end as mark
from (select doc_id, {NOTE_A} as a from documents)
""")
def mark_nonblank(spark, sf):
    note = F.expr(NOTE_A)
    return table(spark, sf, "documents").select(
        "doc_id", values.mark_given(note, "uploaded").alias("mark")
    )


@query(f"""
select doc_id, case when given then lang end as lang, case when given then source end as source
from (select *, coalesce(trim(a, '{BLANKS}') <> '', false) as given
      from (select doc_id, lang, source, {NOTE_A} as a from documents))
""")
def null_out(spark, sf):
    given = values.not_blank(F.expr(NOTE_A))
    return table(spark, sf, "documents").select(
        "doc_id", *[values.keep_if(given, c).alias(c) for c in ("lang", "source")]
    )


@query("""
select o_orderkey, coalesce(case o_orderstatus when 'F' then o_orderpriority when 'O' then '' end,
  cast(o_custkey as string)) as phone from orders
""")
def coalesce_pair(spark, sf):
    first = F.expr("case o_orderstatus when 'F' then o_orderpriority when 'O' then '' end")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.coalesce(first, F.col("o_custkey").cast("string")).alias("phone")
    )


FIRST = "case c_mktsegment when 'BUILDING' then 'Other' when 'MACHINERY' then '' when 'FURNITURE' then null else c_name end"
SECOND = "case when n_regionkey = 0 then '' when n_regionkey = 1 then null else n_name end"


@query(f"""
select c_custkey, case when a is not null and a <> '' and a <> 'Other' then a
  when b is not null and b <> '' then b else c_mktsegment end as place
from (select c_custkey, c_mktsegment, {FIRST} as a, {SECOND} as b
      from customer join nation on c_nationkey = n_nationkey)
""")
def fallback_sentinel(spark, sf):
    return with_nation(spark, sf).select(
        "c_custkey",
        values.first_usable(F.expr(FIRST), F.expr(SECOND), "c_mktsegment", "Other").alias("place"),
    )


def with_nation(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey)


PERSON = "case c_mktsegment when 'BUILDING' then null when 'MACHINERY' then '  ' else ' ' || c_name end"
FIRM = "case when n_regionkey = 2 then n_name || ' ' when n_regionkey = 3 then '' end"


@query(f"""
select c_custkey, case when p <> '' and f <> '' then p || ' (' || f || ')' when p <> '' then p else f end as payee
from (select c_custkey, trim(coalesce({PERSON}, '')) as p, trim(coalesce({FIRM}, '')) as f
      from customer join nation on c_nationkey = n_nationkey)
""")
def payee(spark, sf):
    return with_nation(spark, sf).select(
        "c_custkey", text.payee(F.expr(PERSON), F.expr(FIRM)).alias("payee")
    )


@query(f"""
select o_orderkey, case status when 'O' then 0 when 'F' then 1 end as status_rank
from (select o_orderkey, {STATUS} as status from orders)
""")
def rank_map(spark, sf):
    return orders_with_nulls(spark, sf).select(
        "o_orderkey", values.rank_of("status", ["O", "F"]).alias("status_rank")
    )


PADDED = (
    "case when lang = 'es' then ' ' || chr(12288) || chr(9) "
    "else chr(160) || chr(10) || text || ' ' || chr(8195) || chr(13) end"
)


@query(f"""
select doc_id, nullif(trim(lang, '{BLANKS}'), '') as lang, nullif(trim(padded, '{BLANKS}'), '') as padded
from (select doc_id, lang, {PADDED} as padded from documents)
""")
def strip_blank(spark, sf):
    # Code points beyond Latin-1 are written as text; chr() stops there.
    padded = F.expr(PADDED.replace("chr(12288)", "'　'").replace("chr(8195)", "' '"))
    return blanks_to_null(table(spark, sf, "documents").select("doc_id", "lang", padded.alias("padded")))


@query(f"select doc_id, regexp_replace(text, '{CLASS}+', ' ', 'g') as text from documents")
def collapse_ws(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.collapse_blanks("text").alias("text"))


STREET = "case c_mktsegment when 'BUILDING' then null else ' ' || c_name || '  St ' end"
ZIP = "case c_mktsegment when 'MACHINERY' then '' else cast(c_nationkey + 70000 as string) end"
DISTRICT = "case when n_regionkey = 1 then n_name || ' ' when n_regionkey = 2 then ' ' end"
COUNTRY = "case when n_regionkey = 3 then null else 'DE' end"


@query(f"""
select c_custkey, s || ', ' || z || ' ' || n || ', ' || c as plain,
  trim(regexp_replace(s || ', ' || z || ' ' || n || case when d <> '' then ' (' || d || ')' else '' end
    || ', ' || c, '{CLASS}+', ' ', 'g')) as tidy
from (select c_custkey, n_name as n, trim(coalesce({STREET}, '')) as s, trim(coalesce({ZIP}, '')) as z,
        trim(coalesce({DISTRICT}, '')) as d, trim(coalesce({COUNTRY}, '')) as c
      from customer join nation on c_nationkey = n_nationkey)
""")
def address(spark, sf):
    parts = [F.expr(STREET), F.expr(ZIP), "n_name", F.expr(COUNTRY)]
    return with_nation(spark, sf).select(
        "c_custkey",
        text.address(*parts).alias("plain"),
        text.address(*parts, district=F.expr(DISTRICT), tidy=True).alias("tidy"),
    )


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, concat_ws(', ',
  case when l_returnflag = 'R' then 'returned' end, case when l_linestatus = 'F' then 'final' end) as flags
from lineitem
""")
def flag_join(spark, sf):
    flags = {
        "returned": F.when(F.col("l_returnflag") == "R", "Ja"),
        "final": F.when(F.col("l_linestatus") == "F", "Ja").otherwise("Nein"),
    }
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.join_flags(flags).alias("flags")
    )


RISKY = "case source when 'src0' then ' =' || text when 'src1' then '+' || text when 'src2' then chr(9) || '@' || text when 'src3' then '-' else text end"


@query(f"""
select doc_id, case when substr(ltrim(risky, '{BLANKS}'), 1, 1) in ('=', '+', '-', '@') then '''' || risky
  else risky end as risky
from (select doc_id, {RISKY} as risky from documents)
""")
def formula_escape(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.escape_formula(F.expr(RISKY)).alias("risky"))


@query("select doc_id, length(text) as shown, length(cast(n_chars as string)) as digits from documents")
def text_length(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.shown_length("text").alias("shown"), text.shown_length("n_chars").alias("digits")
    )


DIRTY = "url || case when contains(url, '#') then '/. /x?.. ' else ' // /a <b>|%. .' end"


@query(f"""
select page_id, regexp_replace(regexp_replace(regexp_replace(p, '[ .]+/', '/', 'g'), '/ +', '/', 'g'), '/+', '/', 'g') as path
from (select page_id, trim(regexp_replace(trim(translate({DIRTY}, '<>|:"?*%', '___')), '[.][. ]*$', '')) as p from pages)
""")
def path_sanitise(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.folder_path(F.expr(DIRTY)).alias("path"))


@query("""
select page_id, trim(translate(url || chr(9) || ' "x*', chr(9) || '<>/\\|:"?*%', ' __+__')) as file
from pages
""")
def file_names(spark, sf):
    dirty = F.expr("url || chr(9) || ' \"x*'")
    return table(spark, sf, "pages").select("page_id", text.file_name(dirty).alias("file"))


@query("""
select page_id, array_to_string(steps[1:depth], '/') as path
from (select page_id, steps, unnest(range(1, len(steps) + 1)) as depth
      from (select page_id, string_split(rtrim(url, '/'), '/') as steps from pages))
where array_to_string(steps[1:depth], '/') <> '' and steps[depth] <> ''
""")
def path_ancestors(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.explode(text.ancestors("url")).alias("path"))


@query("""
select page_id, regexp_replace(url, '/+[^/]*$', '') as parent, regexp_extract(url, '[^/]*$') as base,
  case when ends_with(url, 'top') then url else url || 'top' end as file
from pages
""")
def path_split_suffix(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.parent_folder("url").alias("parent"), text.base_name("url").alias("base"),
        text.with_suffix("url", "top").alias("file"),
    )


@query("""
select page_id, contains(p, '../') or contains(p, '/..') as climbs
from (select page_id, case when contains(url, '#') then '../' || url when contains(url, '?') then url || '/..'
  else url || '..' end as p from pages)
""")
def path_traversal(spark, sf):
    path = F.expr(
        "case when contains(url, '#') then '../' || url when contains(url, '?') then url || '/..' "
        "else url || '..' end"
    )
    return table(spark, sf, "pages").select("page_id", text.climbs_out(path).alias("climbs"))


ISO = "replace(cast(ts as string), ' ', 'T') || case event_type when 'click' then '+02:00' else 'Z' end"


@query("""
select event_id, strftime(wall, '%Y-%m-%d %H:%M') as minute, strftime(wall, '%d.%m.%Y %H:%M') as stamp
from (select event_id, ((ts - case event_type when 'click' then interval 2 hour else interval 0 hour end)
  at time zone 'UTC') at time zone 'Europe/Berlin' as wall from events)
""")
def zone_format(spark, sf):
    at = times.instant(F.expr(ISO))
    return table(spark, sf, "events").select(
        "event_id", times.iso_minute_text(F.expr(ISO), "Europe/Berlin").alias("minute"),
        times.minute_text(at, "Europe/Berlin", times.STAMP_FORMAT).alias("stamp"),
    )
