"""The reports of all families over tickets derived from the benchmark tables.

A line item is a ticket, its order the order, customer and nation give addresses and
places, the part gives names and kinds. Each question of a family is answered from
one of a few columns, so that the SQL below only has to name the column.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.text import BLANKS
from rollcall.harness.registry import query, spread, table
from rollcall.operators.counting import choice_frame
from rollcall.operators.numbering import deal, number_rows
from rollcall.operators.shaping import quoted
from rollcall.plans import camp_h, camp_l, camp_t, day_j
from rollcall.plans.common import Family
from rollcall.plans.event import build_reports, needed_reports, published
from rollcall.plans.spec import NUMBER, EventConfig, ReportSpec
from rollcall.session import pin
from rollcall.sources.registrations import FIXED_COLUMNS, ORDINAL

PLACE = {
    "page_no": "l_orderkey",
    "order_pos": "cast(l_linenumber as bigint)",
    # Everything else of a line: what still ties is the same row twice.
    "position_pos": " || '/' || ".join(
        f"cast({c} as string)"
        for c in (
            "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate",
            *(f"cast({n} as decimal(12,2))" for n in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
        )
    ),
}
FIXED = {
    "order_code": "'B' || cast(o_orderkey as string)",
    "status": "case when o_orderpriority = '4-NOT SPECIFIED' then null when o_orderpriority = '5-LOW' then 'e' "
    "when o_orderstatus = 'F' then 'p' when o_orderstatus = 'O' then 'n' else 'c' end",
    "email": "case when o_orderpriority <> '1-URGENT' then 'c' || cast(o_custkey as string) || '@example.org ' end",
    "total": "cast(cast(o_totalprice as decimal(12,2)) as string)",
    "date": "replace(cast(o_orderdate as string), ' ', 'T') || case when o_orderstatus = 'F' then '+02:00' else 'Z' end",
    "invoice_name": "case c_mktsegment when 'BUILDING' then null when 'MACHINERY' then '  ' else c_name end",
    "invoice_company": "case when n_regionkey = 2 then n_name || ' ' when n_regionkey = 3 then '' end",
    "invoice_street": "case c_mktsegment when 'BUILDING' then null else ' ' || c_name || '  St ' end",
    "invoice_zipcode": "case c_mktsegment when 'MACHINERY' then '' else cast(c_nationkey + 70000 as string) end",
    "invoice_city": "n_name",
    "invoice_country": "case when n_regionkey = 3 then null else 'DE' end",
    "invoice_vat_id": "cast(null as string)",
    "position_id": "l_partkey",
    "item_id": "l_suppkey",
    "item_name": "case p_type when 'PROMO' then 'Spende Zeltlagerarbeit' when 'ECONOMY' then 'Mitarbeiter' "
    "when 'SMALL' then null else 'Jungscharler ' || p_type end",
    "price": "cast(cast(l_extendedprice as decimal(12,2)) as string)",
    "attendee_firstname": "' ' || p_name",
    "attendee_lastname": "case when l_linestatus = 'O' and l_returnflag = 'N' then null else n_name end",
    "attendee_email": "cast(null as string)",
    "attendee_street": "case c_mktsegment when 'BUILDING' then null else ' ' || c_name || '  St ' end",
    "attendee_zipcode": "cast(c_nationkey + 70000 as string)",
    "attendee_city": "n_name",
    "attendee_country": "case when n_regionkey = 3 then null else 'DE' end",
}
ANSWERS = {
    "a_bool": "case l_returnflag when 'A' then 'True' when 'R' then 'False' end",
    "a_yes": "case l_returnflag when 'A' then 'Ja' when 'R' then 'Nein' end",
    "a_note": "case when l_linenumber = 1 then ' ' when l_linenumber in (2, 3) then p_name || ' ' end",
    "a_phone": "'+49 ' || cast(o_custkey as string)",
    "a_birth": "substr(cast(l_shipdate as string), 1, 10)",
    "a_own": "case c_mktsegment when 'BUILDING' then 'Sonstige' when 'MACHINERY' then '' "
    "when 'FURNITURE' then null else c_mktsegment end",
    "a_asked": "case n_regionkey when 0 then 'Keiner (ortsunabhängige Anmeldung)' when 1 then '' "
    "when 2 then null else 'Ort ' || cast(n_regionkey as string) end",
    "a_third": "p_brand",
    "a_insured": "case l_linenumber when 4 then 'Privat krankenversichert' "
    "when 5 then 'Gesetzlich krankenversichert (z.B. AOK)' when 6 then 'andere' end",
    "a_diet": "case when p_size < 10 then 'Vegetarisch' when p_size < 20 then 'Kein Schweinefleisch, Vegetarisch' "
    "when p_size < 30 then 'Keine Besonderheiten' end",
}
JOINED = """lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey"""

# Which column answers a question; the others get a note, a phone number or a date.
ANSWERED_BY = {
    camp_h.FAMILY.name: {
        **{q: "a_bool" for q, name in camp_h.RENAMES.items() if name in camp_h.YES_NO},
        "Ortsteil": "a_note",
        camp_h.PLACE: "a_own",
        "Mein Kind hat folgende Lebensmittelunverträglichkeiten/ Essgewohnheiten": "a_note",
    },
    camp_l.FAMILY.name: {
        **dict(zip(camp_l.PLACE_QUESTIONS, ("a_own", "a_asked", "a_third"))),
        "Krankenversicherung": "a_insured",
        "Einverständniserklärung": "a_note",
        "Welche Unverträglichkeiten?": "a_note",
        "Zuschuss beantragen": "a_yes",
    },
    camp_t.FAMILY.name: {
        **dict(zip(camp_t.PLACE_QUESTIONS, ("a_own", "a_asked", "a_third"))),
        "Ernährung: Vegetarisch": "a_bool",
        "Ernährung: Laktosefrei": "a_yes",
        "Ernährung: Glutenfrei": "a_note",
        "Worauf muss außerdem besonders geachtet werden?": "a_insured",
        "Krankenversicherung": "a_insured",
        "Einverständniserklärung": "a_note",
        "Essensunverträglichkeiten": "a_note",
        "Zuschuss beantragen": "a_yes",
    },
    day_j.FAMILY.name: {
        day_j.FAMILY.place_question: "a_own",
        "Ich biete eine Fahrgemeinschaft an": "a_note",
        "Ich stelle mich als Fahrer bereit": "a_yes",
        "Telefonnummer der Eltern": "a_note",
        "Telefonnummer": "a_phone",
        "Ernährung": "a_diet",
        "Welche Unverträglichkeiten?": "a_note",
    },
}
MODULES = {m.FAMILY.name: m for m in (camp_h, camp_l, camp_t, day_j)}
CHOICES = {
    camp_h.FAMILY.name: ["AUTOMOBILE", "HOUSEHOLD", "Leer", "Sonstige"],
    camp_l.FAMILY.name: ["AUTOMOBILE", "Leer", "Ort 3", camp_l.NO_PLACE],
    camp_t.FAMILY.name: ["AUTOMOBILE", "Leer", "Ort 3", camp_l.NO_PLACE],
    day_j.FAMILY.name: ["AUTOMOBILE", "Leer", "Sonstige"],
}


def answered_by(family: str) -> dict[str, str]:
    given, others = ANSWERED_BY[family], ("a_birth", "a_note", "a_phone")
    return {q: given.get(q, others[i % 3]) for i, q in enumerate(MODULES[family].QUESTIONS)}


def joined(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with what belongs to them, only columns that tickets are made from.

    Orders find their customers, and lines their parts, before these two meet: neither
    carries the columns of the other through an exchange.
    """
    lineitem, orders, customer, nation, part = (
        table(spark, sf, n) for n in ("lineitem", "orders", "customer", "nation", "part")
    )
    lines = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ).join(part.select("p_partkey", "p_name", "p_type", "p_brand", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    placed = (
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        .join(customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation.select("n_nationkey", "n_name", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    found = spread(lines, "l_orderkey").join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    return found.drop("p_partkey", "o_orderkey", "c_custkey", "n_nationkey")


def derived_columns(family: str) -> dict[str, str]:
    """What tickets of a family are made of, each as an expression over the tables."""
    return PLACE | FIXED | {a: ANSWERS[a] for a in answered_by(family).values()}


def columns_read(family: str) -> set[str]:
    """Columns of the tables that tickets of a family are made from."""
    return set(re.findall(r"\b[cnlop]_\w+", " ".join(derived_columns(family).values()))) - {"o_orderkey"} | {"l_orderkey"}


def tickets(rows: DataFrame, family: str, number: str | None = None) -> DataFrame:
    """Raw tickets: ordinal, fixed columns and the answers by question id; ``number`` is a column that has one."""
    rows = rows.withColumn("o_orderkey", F.col("l_orderkey"))
    given = F.lit(0).cast("bigint") if number is None else F.col(number)
    derived = rows.select(
        *[F.expr(e).alias(c) for c, e in derived_columns(family).items()], given.alias(NUMBER)
    )
    answers = F.array(
        *[
            F.struct(F.lit(i).cast("bigint").alias("id"), F.col(a).alias("answer"))
            for i, a in enumerate(answered_by(family).values())
        ]
    )
    return derived.select(*PLACE, NUMBER, *FIXED_COLUMNS, answers.alias("answers"))


def run(spark: SparkSession, sf: str, family: Family, name: str) -> DataFrame:
    """One report; only the reports it is made from are computed before."""
    known = {text: [i] for i, text in enumerate(answered_by(family.name))}
    clean_of = lambda raw: family.clean(raw, known, EventConfig())
    if name == "Alles":
        # A line with what belongs to it is a fraction of the clean row, which is made where its number is.
        rows = pin(joined(spark, sf).select(sorted(columns_read(family.name))), "joined")
        dealt = deal(rows, [F.expr(e) for e in PLACE.values()], into=NUMBER)
        clean = number_rows(clean_of(tickets(dealt.rows, family.name, NUMBER)), ORDINAL, into=NUMBER, start=0, dealt=dealt)
    else:
        clean = clean_of(tickets(joined(spark, sf), family.name))
    first = needed_reports(family, name)[0]
    if isinstance(first, ReportSpec) and first.order and first.ties == ORDINAL:
        # Numbering scans its input for the sort key, which is cheaper than to make it each time.
        clean = pin(clean.select([quoted(c) for c in clean.columns if c in first.read]), "clean")
    choices = family.edit_choices(choice_frame(spark, CHOICES[family.name]))
    return published(build_reports(family, clean, choices, only=name)[name][1])


# --- the same in SQL ---------------------------------------------------------------

TICKETS_SQL = f"""select {', '.join(f'{e} as {c}' for c, e in (PLACE | FIXED | ANSWERS).items())}
  from {JOINED}"""


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def trimmed(e: str) -> str:
    return f"trim(coalesce({e}, ''), '{BLANKS}')"


def cases(e: str, words: Mapping[str, str]) -> str:
    return f"case {e} " + " ".join(f"when '{a}' then '{b}'" for a, b in words.items()) + f" else {e} end"


MINUTE = """strftime((cast(substr(replace(date, 'T', ' '), 1, 19) as timestamp)
  - case when date like '%+02:00' then interval 2 hour else interval 0 hour end)
  at time zone 'UTC' at time zone 'Europe/Berlin', '%Y-%m-%d %H:%M')"""
STATUS = cases("status", {"c": "storniert", "n": "unbezahlt", "p": "bezahlt"})


def clean_columns(family: str) -> dict[str, str]:
    """SQL of every column of the clean table, before blanks become null."""
    m = MODULES[family]
    columns = {m.RENAMES.get(c, c): c for c in [*FIXED_COLUMNS, *m.QUESTIONS]}
    for question, answer in answered_by(family).items():
        columns[m.RENAMES.get(question, question)] = answer
    columns["Anmeldedatum"] = MINUTE
    if m is not day_j:
        columns["Bestellstatus"] = STATUS
    if m is camp_h:
        for c in m.YES_NO:
            columns[c] = cases(columns[c], {"True": "Ja", "False": "Nein"})
        s, z, o, d, land = (
            trimmed(columns[c]) for c in ("Straße", "PLZ", "Ort", "Ortsteil", "Land")
        )
        part = f"case when {d} <> '' then ' (' || {d} || ')' else '' end"
        columns["Adresse"] = (
            f"regexp_replace({s} || ', ' || {z} || ' ' || {o} || {part} || ', ' || {land}, '[{BLANKS}]+', ' ', 'g')"
        )
    if m in (camp_l, camp_t):
        name, firm = trimmed("invoice_name"), trimmed("invoice_company")
        columns["Rechnung - Empfänger"] = (
            f"case when {name} <> '' and {firm} <> '' then {name} || ' (' || {firm} || ')' "
            f"when {name} <> '' then {name} else {firm} end"
        )
        columns["Rechnung - Adresse"] = " || ".join(
            [trimmed("invoice_street"), "', '", trimmed("invoice_zipcode"), "' '", trimmed("invoice_city"),
             "', '", trimmed("invoice_country")]
        )
        columns["Krankenversicherung"] = cases(columns["Krankenversicherung"], camp_l.INSURANCE_WORDS)
        consent = columns["Einverständniserklärung"]
        columns["Einverständniserklärung"] = f"case when {trimmed(consent)} <> '' then 'hochgeladen' else {consent} end"
        columns["Ort"] = (
            "case coalesce(nullif(nullif(a_own, ''), 'Sonstige'), nullif(a_asked, ''), a_third) "
            f"when '{camp_l.NO_PLACE}' then '{camp_l.NO_PLACE_SHORT}' "
            "else coalesce(nullif(nullif(a_own, ''), 'Sonstige'), nullif(a_asked, ''), a_third) end"
        )
    if m is camp_t:
        for c in m.DIET_FLAGS:
            columns[c] = cases(columns[c], {"True": "Ja", "False": "Nein"})
        columns["Ernährung"] = "concat_ws(', ', " + ", ".join(
            f"case when {columns[c]} = 'Ja' then '{c}' end" for c in m.DIET_FLAGS
        ) + ")"
    if m is day_j:
        for c, (a, b) in m.EITHER.items():
            first, second = (f"case when {trimmed(columns[x])} <> '' then {columns[x]} end" for x in (a, b))
            columns[c] = f"coalesce({first}, {second})"
        note = columns["Essensunverträglichkeiten"]
        columns["Essensunverträglichkeiten"] = f"case when {trimmed(note)} <> '' then {note} end"
        columns["Ortschaft"] = f"nullif({trimmed(columns['Ortschaft'])}, '')"
    return columns


def clean_sql(family: str) -> str:
    m = MODULES[family]
    columns, keep = clean_columns(family), ", ".join(PLACE)
    if m is day_j:
        shown = ", ".join(f"{columns[c]} as {q(c)}" for c in m.SORTED)
        return f"with t as ({TICKETS_SQL}), clean as (select {keep}, {shown} from t where status is distinct from 'c')"
    shown = ", ".join(f"nullif(trim({columns[c]}, '{BLANKS}'), '') as {q(c)}" for c in m.CLEAN)
    return f"with t as ({TICKETS_SQL}), clean as (select {keep}, {shown} from t)"


BY_PLACE_IN_INPUT = ", ".join(PLACE)
STATUS_RANK = "case \"Bestellstatus\" when 'unbezahlt' then 0 when 'bezahlt' then 1 when 'storniert' then 2 end"


def ordered(*keys: str, ties: str = BY_PLACE_IN_INPUT) -> str:
    return ", ".join([f"{k if k.startswith('case') else q(k)} asc nulls last" for k in keys] + [ties])


def select(columns, source: str, order: str, where: str = "true", group: str | None = None, start: int = 1) -> str:
    partition = f"partition by {q(group)} " if group else ""
    return (
        f"select row_number() over ({partition}order by {order}) - 1 + {start} as \"Nr\", "
        f"{', '.join(c if c.startswith('case') else q(c) for c in columns)} from {source} where {where}"
    )


NOT_CANCELLED = "\"Bestellstatus\" is distinct from 'storniert'"
NO_DONATION = "\"Art\" is distinct from 'Spende Zeltlagerarbeit'"


def cleared(columns, notes, blanked) -> list[str]:
    given = " or ".join(f"{q(n)} is not null" for n in notes)
    return [f"case when {given} then {q(c)} end as {q(c)}" if c in blanked else c for c in columns]


def choice_counts(family: str, source: str, label: str, measures: Mapping[str, str], where: str) -> str:
    names = [c for c in CHOICES[family] if c != camp_l.NO_PLACE]
    if camp_l.NO_PLACE in CHOICES[family]:
        names = names + [camp_l.NO_PLACE_SHORT]
    # The position of a choice that was taken out stays unused.
    at = {n: i for i, n in enumerate(CHOICES[family], 1)} | {camp_l.NO_PLACE_SHORT: len(CHOICES[family]) + 1}
    counts = ", ".join(f"count(*) filter ({c}) as {q(m)}" for m, c in measures.items())
    lines = [f"select 0 as \"Nr\", 'GESAMT' as {q(label)}, {counts} from {source} where {where}"]
    lines += [
        f"select {at[n]}, '{n}', {counts} from {source} where {where} and {q(label)} = '{n}'" for n in names
    ]
    return f"select cast(\"Nr\" as bigint) as \"Nr\", * exclude (\"Nr\") from ({' union all '.join(lines)})"


def orders_sql(columns, flag: str) -> str:
    key = "Bestellnummer"
    first = ", ".join(
        f"first({q(c)} order by {BY_PLACE_IN_INPUT}) filter ({q(c)} is not null) as {q(c)}"
        for c in columns if c not in (key, flag)
    )
    collapsed = (
        f"(select {q(key)}, {first}, case when coalesce(bool_or({q(flag)} = 'Ja'), false) then 'Ja' else 'Nein' end "
        f"as {q(flag)} from clean where {q(key)} is not null group by {q(key)})"
    )
    return select(columns, collapsed, ordered(STATUS_RANK, "Anmeldedatum", ties=q(key)))


def sql_of(family: str, name: str) -> str:
    m = MODULES[family]
    by_name = ordered("Nachname", "Vorname")
    going = NOT_CANCELLED if m is camp_h else f"{NOT_CANCELLED} and {NO_DONATION}"
    if m is day_j:
        by_place = ("Ortschaft", "Art", "Nachname", "Vorname")
        classes = {
            "Jungscharler": "contains(coalesce(\"Art\", ''), 'Jungscharler')",
            "Mitarbeiter": "contains(coalesce(\"Art\", ''), 'Mitarbeiter')",
            "Gesamt": "true",
        }
        counts = ", ".join(f"count(*) filter ({c}) as {q(k)}" for k, c in classes.items())
        diets = [f"contains(coalesce(\"Ernährung\", ''), '{d}')" for d in m.DIETS] + ["true"]
        body = {
            "Alle": lambda: select(m.SORTED, "clean", ordered(*by_place)),
            "Nach_Orten": lambda: select(
                m.PER_PLACE, "clean", ordered(*by_place[1:]), '"Ortschaft" is not null', "Ortschaft"),
            "Anmeldezahlen": lambda: choice_counts(family, "clean", "Ortschaft", classes, "true"),
            "Küche_Gesamtzahlen": lambda: " union all ".join(
                f"select cast({i} as bigint) as \"Nr\", '{label}' as \"Ernährung\", {counts} from clean where {d}"
                for i, (label, d) in enumerate(zip([*m.DIETS, "Gesamt"], diets), 1)),
            "Küche_Unverträglichkeiten": lambda: select(
                m.INTOLERANCES, "clean", ordered("Nachname", "Vorname", "Ortschaft", "Art"),
                '"Essensunverträglichkeiten" is not null'),
        }[name]()
        return f"{clean_sql(family)} {body}"

    flag = "Zuschussantrag" if m is camp_h else "Zuschuss beantragt"
    place = camp_h.PLACE if m is camp_h else "Ort"
    listed = "true" if m is camp_h else going
    shared = m if m is camp_h else camp_l
    notes = {camp_h: ["Lebensmittelunverträglichkeiten"], camp_l: ["Essensunverträglichkeiten"]}.get(
        m, getattr(m, "NOTES", None)
    )
    medical = [c for c in m.MEDICAL if c != "Ortsteil"]
    body = {
        "Alles": lambda: select(m.CLEAN, "clean", BY_PLACE_IN_INPUT, start=0),
        "Teilnehmerdaten": lambda: select(m.ATTENDEES, "clean", by_name, going),
        "Nach_Orten": lambda: select(m.PER_PLACE, "clean", by_name, listed, place),
        "Zum_Teilen": lambda: select(
            [c for c in m.PER_PLACE if c != "Sonstiges"], "clean", by_name, listed, place),
        "Anmeldezahlen": lambda: choice_counts(family, "clean", place, {"Anmeldungen": "true"}, listed),
        "Bestellungen": lambda: orders_sql(shared.ORDERS, flag),
        "Spenden": lambda: select(
            camp_l.DONATIONS, "clean", ordered(STATUS_RANK, "Anmeldedatum"), "\"Art\" = 'Spende Zeltlagerarbeit'"),
        "Notfallkontakte": lambda: select(shared.CONTACTS, "clean", by_name, going),
        "Sani": lambda: select(medical, "clean", by_name, going),
        "Küche": lambda: select(cleared(m.DIET, notes, shared.CLEARED), "clean", by_name, going),
    }[name]()
    return f"{clean_sql(family)} {body}"


# Report names in the queries, by their names in the plans.
TITLES = {
    "Alles": "clean", "Alle": "sorted", "Teilnehmerdaten": "attendees", "Nach_Orten": "per_place",
    "Zum_Teilen": "shareable", "Anmeldezahlen": "counts", "Bestellungen": "orders", "Spenden": "donations",
    "Notfallkontakte": "contacts", "Sani": "medical", "Küche": "diet", "Küche_Gesamtzahlen": "diet_counts",
    "Küche_Unverträglichkeiten": "intolerances",
}


def _register(family: Family, name: str) -> None:
    title = f"report_{TITLES[name]}_{family.name}"
    query(sql_of(family.name, name), name=title)(lambda spark, sf: run(spark, sf, family, name))


for _module in MODULES.values():
    for _spec in _module.FAMILY.reports:
        _register(_module.FAMILY, _spec.name)
