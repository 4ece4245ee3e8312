"""The numbered queries: each operator over its whole table, and the SQL of those
that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywind.llm import (
    bpe,
    conversations,
    html_text,
    merkle,
    mixing,
    neighbours,
    pii,
    quality,
    repetition,
    simhash,
    toxicity,
    url_filter,
    whitening,
)
from tallywind.llm.common import table
from tallywind.llm.conversation_sql import SQL as CONVERSATION_SQL

RANKS = "byte_bpe_multi_50k.tiktoken"


def ranks_path() -> str:
    """The public rank file, where it is installed."""
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = mixing.decide(table(spark, sf_dir, "documents"))
    return decided.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.extract(table(spark, sf_dir, "documents"))
    counts = [pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_filter.judge(pages, url_filter.tracked_urls(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = merkle.compare_with_edit(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.tokenize(table(spark, sf_dir, "documents"), ranks_path(), decode=True)
    return tokens.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = repetition.repetition(table(spark, sf_dir, "documents"))
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = table(spark, sf_dir, "conversations")
    return conversations.inspect_and_repair(original, conversations.damage(original))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_html_text": op2_html_text,
    "op3_simhash": op3_simhash,
    "op4_pii": op4_pii,
    "op5_url_filter": op5_url_filter,
    "op6_merkle": op6_merkle,
    "op7_bpe": op7_bpe,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_repetition": op10_repetition,
    "op11_whitening": op11_whitening,
    "op12_neighbours": op12_neighbours,
    "op13_conversations": op13_conversations,
}

ORACLES = {
    "op1_mixing": r"""
with sized as (
  select doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents
), per_source as (
  select source, sum(size)::bigint as source_size from sized group by source
), ranked as (
  select source, source_size,
         [3.0::double, 1.0::double, 2.0::double][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight,
         source_size * 2.0::double as lim,
         (sum(source_size) over ())::double * 1.5::double as budget
  from per_source
), filled as (
  select *,
         sum(lim) over (order by lim / weight, source nulls last rows unbounded preceding) - lim as before,
         sum(weight) over () - sum(weight) over (order by lim / weight, source nulls last rows unbounded preceding) + weight as remaining
  from ranked
), marked as (
  select *, lim * remaining <= weight * (budget - before) as stopped from filled
), targets as (
  select source, source_size,
         case when stopped then lim else weight * (
           (budget - sum(case when stopped then lim else 0.0::double end) over ())
           / sum(case when stopped then 0.0::double else weight end) over ()) end as target
  from marked
), rates as (
  select d.doc_id, d.size, t.source_size, t.target,
         case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as rate,
         ('0x' || substr(md5('mix|' || d.doc_id::varchar), 1, 13))::bigint::double / 4503599627370496.0::double as draw
  from sized d join targets t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
       (size * (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end))::bigint as taken
from rates
""",
    "op5_url_filter": r"""
with parts as (
  select page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1) as query
  from pages
), stripped as (
  select *, regexp_replace(regexp_replace(query, '(^|&)utm_[^&]*', '', 'g'), '^&', '') as kept_query
  from parts
), keyed as (
  select *, case when host <> '' then
           regexp_replace(host, '^www\.', '') || regexp_replace(path, '/$', '')
           || case when kept_query <> '' then '?' || kept_query else '' end end as key
  from stripped
), listed as (
  select distinct key from keyed where regexp_matches(query, '(^|&)utm_') and key is not null
), ruled as (
  select k.*, l.key is not null as is_listed,
         case when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
              when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
              when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
              when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
              when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/' end as rule
  from keyed k left join listed l on k.key = l.key
)
select page_id, host, path, rule,
       case when rule in ('com/', 'www.example.com/en/') then 'allow'
            when rule is not null or is_listed then 'block' else 'allow' end as verdict
from ruled
""",
    "op13_conversations": CONVERSATION_SQL,
}
