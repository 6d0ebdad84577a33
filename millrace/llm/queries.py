"""The registered queries of the operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.conversations import damaged, repair_conversations
from millrace.llm.decontaminate import find_leaks
from millrace.llm.embedding_dedup import near_duplicate_vectors
from millrace.llm.language_model import language_scores
from millrace.llm.licenses import TEMPLATES, scan_licenses, words_of_template
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.minhash import near_duplicates
from millrace.llm.packing import pack
from millrace.llm.periodic import looped_tail, periodic_runs, run_digests
from millrace.llm.quality import quality_scores
from millrace.llm.substring_dedup import passage_digests
from millrace.llm.toxicity import toxicity_scores
from millrace.llm.url_filter import judge_urls

# The rules of the URL query (fixed values): verdict, host, path.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, threshold=0.85)


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(_table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(_table(spark, sf_dir, "conversations")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(_table(spark, sf_dir, "documents"), rewrite=looped_tail))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_digests(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_dedup, op2_line_dedup, op3_minhash_dedup, op4_language_model, op5_url_filter,
        op6_decontaminate, op7_toxicity, op8_quality, op9_licenses, op10_packing,
        op11_conversation_repair, op12_periodic_runs, op13_substring_dedup,
    )
}

_URL_SQL = """
with parts as (
  select page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
rules(verdict, rule_host, rule_path) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits as (
  select page_id, host, path, verdict, rule_host || rule_path as rule,
    row_number() over (partition by page_id order by length(rule_host || rule_path) desc) as n
  from parts join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from parts p left join fits f on p.page_id = f.page_id and f.n = 1"""

_EMBEDDING_SQL = """
with recursive unit as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double) / sqrt(list_sum(list_transform(embedding, lambda y: cast(y as double) * y)))) as v
  from embeddings),
links as (
  select a.vec_id as a, b.vec_id as b from unit a join unit b
  on a.vec_id != b.vec_id and list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) >= 0.95),
reach(id, other) as (
  select vec_id, vec_id from embeddings
  union
  select r.id, l.b from reach r join links l on r.other = l.a),
classes as (select id, min(other) as component_id from reach group by id),
counts as (select a, count(*) as n from links group by a)
select c.id as vec_id, cast(coalesce(n, 0) as bigint) as n_links, c.component_id, c.id = c.component_id as kept
from classes c left join counts on a = c.id"""

_LINE_SQL = r"""
with numbered as (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as line_no from documents),
lines as (
  select doc_id, line_no, line,
    list_filter(string_split(translate(lower(line), chr(9) || chr(13) || chr(12) || chr(11), '    '), ' '), lambda w: w != '') as words
  from numbered),
firsts as (
  select words, min((doc_id, line_no)) as place from lines where len(words) > 0 group by words),
cut as (
  select place, words, i, len(words) as n, list_concat(words[:i - 1], words[i + 1:]) as rest
  from (select place, words, unnest(range(1, len(words) + 1)) as i from firsts where len(words) >= 10)),
masked as (
  select place from (select place, min(place) over (partition by n, i, rest) as lead from cut) where lead < place),
longer as (
  select c.place as long_place, f.place as short_place from cut c join firsts f on f.words = c.rest where len(f.words) >= 10),
near as (
  select place from masked union select long_place from longer where short_place < long_place
  union select short_place from longer where long_place < short_place),
marked as (
  select l.doc_id, l.line_no, l.line, f.place is not null and (f.place != (l.doc_id, l.line_no) or near.place is not null) as dropped
  from lines l left join firsts f on f.words = l.words and len(l.words) > 0 left join near on near.place = f.place),
joined as (
  select doc_id, string_agg(line, chr(10) order by line_no) filter (not dropped) as text, count(*) as n_lines, count(*) filter (dropped) as n_dropped
  from marked group by doc_id)
select d.doc_id, case when d.text is null then null else coalesce(j.text, '') end as text,
  cast(case when d.text is null then 0 else n_lines end as integer) as n_lines, cast(coalesce(n_dropped, 0) as integer) as n_dropped
from documents d left join joined j using (doc_id)"""


def _license_sql() -> str:
    rows = ", ".join(
        f"({i}, '{name}', [{', '.join(repr(w) for w in words_of_template(text))}])" for i, (name, text) in enumerate(TEMPLATES)
    )
    grams = "list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: words[i:i + 4])"
    return f"""
with templates(template, license, words) as (values {rows}),
wanted as (select template, license, list_distinct({grams}) as whole from templates),
texts as (
  select doc_id, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') as words from documents where text is not null),
shingled as (select doc_id, {grams} as shingles from texts where words[1] != ''),
shares as (
  select doc_id, template, license, len(list_intersect(list_distinct(shingles), whole)) / len(whole) as share
  from shingled, wanted where list_has_any(shingles, whole))
select doc_id, license, max(share) as containment, count(distinct template) as n_matches
from shares where share >= 0.8 group by doc_id, license"""


ORACLES: dict[str, str] = {
    "op1_embedding_dedup": _EMBEDDING_SQL,
    "op2_line_dedup": _LINE_SQL,
    "op5_url_filter": _URL_SQL,
    "op9_licenses": _license_sql(),
}
