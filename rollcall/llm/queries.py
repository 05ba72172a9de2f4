"""The operators applied to whole tables with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    chat, clustering, codes, compression, latent, line_field, lines, mixing, packing, secrets, simhash, substrings, url_cascade,
)
from rollcall.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[function.__name__] = function
    return function


@query
def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and compression verdict of every document."""
    return compression.quality(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op4_ball_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, three words a shingle, three bits apart."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), shingle=3, distance=3)


@query
def op2_doubling_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without windows of 20 words that also start earlier."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), length=20, with_text=False)


@query
def op7_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one made of marks, logged with drafts, streams, edits and regenerations, folded, rendered and read back."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    events = chat.log_of_turns(turns.unionByName(chat.hostile_turns(spark)))
    return chat.digests(chat.format_conversations(events))


@query
def op9_token_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of known form and random strings in every document."""
    return secrets.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op10_line_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from a field over its lines."""
    return line_field.quality(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality")
    )


URL_RULES = (
    url_cascade.Rule("allow", "org", "/"), url_cascade.Rule("block", "example.org", "/es/"),
    url_cascade.Rule("block", "example.org", "/en/1"), url_cascade.Rule("allow", "com", "/fr/"),
    url_cascade.Rule("block", "com", "/de/"),
)
LISTED = tuple(
    f"{name}.example.{top}" for name in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
)


@query
def op8_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for the url of every page."""
    return url_cascade.judge(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES, url_cascade.domain_table(spark, LISTED))


def _fits_sql(rule: url_cascade.Rule) -> str:
    return f"(host = '{rule.host}' or ends_with(host, '.{rule.host}')) and starts_with(path, '{rule.path}')"


_LONGEST_FIRST = sorted(URL_RULES, key=lambda r: -len(r.shown))
_LISTED_SQL = " or ".join(f"host = '{d}' or ends_with(host, '.{d}')" for d in LISTED)

SQL["op8_url_cascade"] = f"""
with cut as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut
), listed as (select *, ({_LISTED_SQL}) as listed from parts)
select page_id, host, path,
  case {' '.join(f"when {_fits_sql(r)} then '{r.shown}'" for r in _LONGEST_FIRST)} end as rule,
  case {' '.join(f"when {_fits_sql(r)} then '{r.verdict}'" for r in _LONGEST_FIRST)} when listed then 'block' else 'allow' end as verdict,
  listed
from listed
"""


@query
def op6_block_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mixture of all documents, weighted by source, takes from each."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mixing.taken(mixing.mix(docs.select("doc_id", "source", mixing.words_in(docs.text).alias("size"))))


@query
def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), packing.Settings(shards=40))


@query
def op5_latent_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, and the item."""
    return latent.leaks(
        table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    )


@query
def op11_shared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the lines that five or more documents share."""
    left = lines.drop_shared(table(spark, sf_dir, "documents", "doc_id", "text"), lines.Settings(shortest=40, documents=5))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _vectors(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings", "vec_id", "embedding", *columns).withColumnRenamed("embedding", "vector")


@query
def op12_rotated_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and distance of every vector after ten rounds of eight centroids."""
    return clustering.cluster(_vectors(spark, sf_dir), clustering.Settings(clusters=8, rounds=10, dims=64, scale=1024, seed=3))


@query
def op13_slice_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, eight parts by sixteen entries after six rounds."""
    return codes.compress(_vectors(spark, sf_dir, "label"), codes.Settings(parts=8, entries=16, rounds=6, dims=64, scale=4096))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL["op11_shared_lines"] = rf"""
with texts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
split as (
  select doc_id, unnest(lines) as line, unnest(range(len(lines))) as place from texts
), keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') as key from split
), shared as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), marked as (
  select k.doc_id, k.place, k.line, coalesce(k.doc_id <> s.keeper, false) as gone from keyed k left join shared s on k.key = s.key
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""


def _whole(scale: int) -> str:
    """Components of the kept vectors; counted from 0."""
    return f"""
with kept as (
  select vec_id, label, embedding from embeddings where len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), x as materialized (
  select vec_id, label, unnest(range(64)) as i, cast(floor({scale} * cast(unnest(embedding) as double)) as bigint) as x from kept
)"""


def _clustering_sql(clusters: int = 8, rounds: int = 10) -> str:
    steps = [_whole(1024), f"""first as (
  select vec_id, row_number() over (order by sha256('3:' || vec_id)) - 1 as c from kept
  qualify row_number() over (order by sha256('3:' || vec_id)) <= {clusters}
)""", "c0 as materialized (select c, i, x from first join x using (vec_id))"]
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (
  select vec_id, c, d from (
    select vec_id, c, cast(sum((x.x - k.x) * (x.x - k.x)) as bigint) as d from x join c{r} k using (i) group by vec_id, c
  ) qualify row_number() over (partition by vec_id order by d, c) = 1
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} as materialized (
  select k.c, k.i, coalesce(m.x, k.x) as x from c{r} k left join (
    select c, i, cast(floor(cast(sum(x.x) as double) / count(*)) as bigint) as x from a{r} join x using (vec_id) group by c, i
  ) m on k.c = m.c and k.i = m.i
)""")
    return ",\n".join(steps) + f"""
select vec_id, cast(a.c as integer) as cluster, d as distance, cast(sum(d) over (partition by a.c) as bigint) as cluster_inertia,
  cast(sum(d) over () as bigint) as inertia, centroid_sha256
from a{rounds} a join (select c, sha256(string_agg(cast(x as varchar), ',' order by i)) as centroid_sha256 from c{rounds} group by c) k on a.c = k.c
"""


SQL["op12_rotated_centroids"] = _clustering_sql()


def _codes_sql(entries: int = 16, rounds: int = 6) -> str:
    steps = [_whole(4096), "y as materialized (select vec_id, label, i // 8 as p, i % 8 as i, x from x)", f"""first as (
  select vec_id, row_number() over (order by vec_id) - 1 as e from kept qualify row_number() over (order by vec_id) <= {entries}
)""", "b0 as materialized (select p, e, i, x from first join y using (vec_id))"]
    for r in range(rounds + 1):
        steps.append(f"""a{r} as materialized (
  select vec_id, p, e, d from (
    select vec_id, p, e, cast(sum((y.x - b.x) * (y.x - b.x)) as bigint) as d from y join b{r} b using (p, i) group by vec_id, p, e
  ) qualify row_number() over (partition by vec_id, p order by d, e) = 1
)""")
        if r < rounds:
            steps.append(f"""b{r + 1} as materialized (
  select b.p, b.e, b.i, coalesce(m.x, b.x) as x from b{r} b left join (
    select p, e, i, cast(floor(cast(sum(y.x) as double) / count(*)) as bigint) as x from a{r} join y using (vec_id, p) group by p, e, i
  ) m on b.p = m.p and b.e = m.e and b.i = m.i
)""")
    return ",\n".join(steps) + f"""
, coded as (
  select vec_id, string_agg(format('{{:02x}}', e), '' order by p) as code, cast(sum(d) as bigint) as error from a{rounds} group by vec_id
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(cast(x as varchar), ',' order by p, e, i)) from b{rounds}) as codebooks_sha256
from coded join kept using (vec_id)
"""


SQL["op13_slice_codes"] = _codes_sql()
