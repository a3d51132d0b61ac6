"""The registered queries in DuckDB SQL, written from the rules, not from the plans."""

from __future__ import annotations

_COMMON = r"""
with placed as (
  select *, 'https://news.example/' || case when doc_id % 20 = 0 then 'front'
         else substring(md5(text), 1, 8) end as url
  from documents
), articles as (
  select doc_id,
         case when doc_id % 25 = 3 then 'Title of ' || source || ' ' || doc_id end as title,
         'author' || (doc_id % 50) as author,
         text,
         case when doc_id % 33 = 0 then ''
              when doc_id % 25 = 4 then 'Summary  by' || chr(10) || source || ' of ' || doc_id
         end as summary,
         url,
         source,
         timestamp '2024-01-01 00:00:00' + to_minutes(doc_id % 525600) as published_at,
         timestamp '2024-01-01 00:05:00' + to_minutes(doc_id % 525600) as scraped_at,
         case when doc_id % 97 <> 0 then md5(url) end as url_hash,
         md5(text) as fingerprint
  from placed
), parsed as (
  select *, regexp_replace(trim(text, ' '), '\s+', ' ', 'g') as text_prepped from articles
), base as (
  select *, trim(regexp_replace(coalesce(summary, title, text_prepped), '\s+', ' ', 'g'), ' ')
         as text_for_inference
  from parsed
), scorable as (
  select * from base where url_hash is not null and text_for_inference is not null
), survivors as (
  select *, length(text_for_inference) as n,
         regexp_full_match(text_for_inference, '\s*') as blank
  from scorable
  qualify row_number() over (partition by url_hash, fingerprint
                             order by published_at, doc_id) = 1
), answered as (
  select *,
         case n % 3 when 0 then 'positive' when 1 then 'negative' else 'neutral' end as s_label,
         (n % 101) / 100.0::double as s_score,
         'topic' || (n % 5) as c_label,
         (n % 97) / 96.0::double as c_score,
         '2031-05-17T08:30:00Z' as stamp,
         case when blank then 'empty_text_for_inference' end as empty_error,
         case when blank then 'empty_text_for_inference'
              when n % 11 = 0 then 'missing sentiment result' end as s_error,
         case when blank then 'empty_text_for_inference'
              when n % 13 = 0 then 'missing classification result' end as c_error
  from survivors
)
"""

_ARTICLE = """doc_id, title, author, md5(text) as text_md5, summary, url, source,
       epoch(published_at)::bigint as published_at, epoch(scraped_at)::bigint as scraped_at,
       url_hash, fingerprint"""

_BASE = _ARTICLE + """,
       md5(text_prepped) as text_prepped_md5,
       md5(text_for_inference) as text_for_inference_md5"""


def _sentiment(error: str) -> str:
    return f"""case when {error} is null then s_label end as sentiment_label,
       case when {error} is null then s_score end as sentiment_score,
       stamp as sentiment_inferred_at, {error} as sentiment_error"""


def _category(error: str) -> str:
    return f"""case when {error} is null then c_label end as category_label,
       case when {error} is null then c_score end as category_score,
       stamp as category_inferred_at, {error} as category_error"""


_FULL = f"{_BASE}, {_sentiment('empty_error')}, {_category('empty_error')}"


def _match(prefix: str) -> str:
    key, missing = {
        "sentiment": ("s", "missing sentiment result"),
        "category": ("c", "missing classification result"),
    }[prefix]
    return f"""
       case when not a.blank then r.{key}_label end as {prefix}_label,
       case when not a.blank then r.{key}_score end as {prefix}_score,
       case when a.blank then 'empty_text_for_inference'
            when r.url_hash is null then '{missing}' end as {prefix}_error"""


def _told(batches: int) -> str:
    """Documents whose ``doc_id`` leaves the same remainder are a batch."""
    return f"""{_COMMON}, firsts as (
  select *, length(text_for_inference) as n, (doc_id % {batches})::int as batch_id,
         regexp_full_match(text_for_inference, '\\s*') as blank
  from scorable
  qualify row_number() over (partition by doc_id % {batches}, url_hash, fingerprint
                             order by published_at, doc_id) = 1
), told as (
  select *,
         case n % 3 when 0 then 'positive' when 1 then 'negative' else 'neutral' end as s_label,
         (n % 101) / 100.0::double as s_score, 'topic' || (n % 5) as c_label,
         (n % 97) / 96.0::double as c_score,
         case when blank then 'empty_text_for_inference'
              when n % 11 = 0 then 'missing sentiment result' end as s_error,
         case when blank then 'empty_text_for_inference'
              when n % 13 = 0 then 'missing classification result' end as c_error
  from firsts
)"""


_TIMELESS = f"""{_BASE.removeprefix("doc_id, ")},
       case when s_error is null then s_label end as sentiment_label,
       case when s_error is null then s_score end as sentiment_score,
       s_error as sentiment_error,
       case when c_error is null then c_label end as category_label,
       case when c_error is null then c_score end as category_score,
       c_error as category_error"""


def _batches(which: str, batches: int = 2) -> str:
    return f"{_told(batches)} select batch_id, {_TIMELESS} from told where {which}"


# Partitions by doc_id % 8; a request takes up to 10 rows and 16384 bytes of texts, blank
# rows counting as rows, and a larger text goes alone.
_REQUESTS = f"""{_COMMON.replace("with placed", "with recursive placed")}, dealt as (
  select doc_id, blank, doc_id % 8 as part,
         row_number() over (partition by doc_id % 8 order by doc_id) as i,
         case when blank then 0 else octet_length(encode(text_for_inference)) end as size
  from survivors
), packed as (
  select *, 1 as chunk, 1 as rows, size as bytes from dealt where i = 1
  union all
  select doc_id, blank, part, i, size, chunk + full_::int,
         case when full_ then 1 else rows + 1 end, case when full_ then size else bytes + size end
  from (
    select d.*, p.chunk, p.rows, p.bytes,
           p.rows = 10 or (p.bytes > 0 and d.size > 0 and p.bytes + d.size > 16384) as full_
    from packed p join dealt d on d.part = p.part and d.i = p.i + 1
  )
), chunks as (
  select part, chunk, count(*) filter (where not blank) as texts, sum(size) as bytes,
         count(*) filter (where blank) as blanks
  from packed group by all
), numbered as (
  select *, sum((texts > 0)::int) over upto as request,
         sum(blanks + (texts > 0)::int) over upto - blanks - (texts > 0)::int as asked
  from chunks
  window upto as (partition by part order by chunk)
), requests as (
  select p.doc_id, p.blank, n.*,
         row_number() over (partition by p.part, p.chunk, p.blank order by p.i) as turn
  from packed p join numbered n on n.part = p.part and n.chunk = p.chunk
)"""


ORACLES = {
    "parse_wire_json": f"{_COMMON} select {_ARTICLE} from articles",
    "normalize_text": f"""{_COMMON}
select doc_id, md5(text_prepped) as text_prepped_md5, length(text_prepped) as n from parsed""",
    "scoring_text": f"""{_COMMON}
select doc_id, md5(substring(text_for_inference, 1, 2000)) as text_for_inference_md5,
       length(substring(text_for_inference, 1, 2000)) as n
from base""",
    "prepare_articles": f"{_COMMON} select {_BASE} from base",
    "filter_scorable": f"{_COMMON} select doc_id, url_hash, fingerprint from scorable",
    "dedup_keys": f"{_COMMON} select distinct url_hash, fingerprint from scorable",
    "dedup_survivor": f"{_COMMON} select {_BASE} from survivors",
    "score_sentiment": f"{_COMMON} select doc_id, url_hash, {_sentiment('s_error')} from answered",
    "score_category": f"{_COMMON} select doc_id, url_hash, {_category('c_error')} from answered",
    "match_scores": f"""{_COMMON}, replies as (
  select * from answered where n % 11 <> 0
  qualify row_number() over (partition by url_hash order by doc_id desc) = 1
)
select a.doc_id, a.url_hash, {_match("sentiment")}, {_match("category")}
from answered a left join replies r on a.url_hash = r.url_hash""",
    "route_empty_text": f"""{_COMMON}
select doc_id, url_hash, blank, case when not blank then s_label end as sentiment_label,
       empty_error as sentiment_error
from answered""",
    "error_rows": f"""{_COMMON}
select s_error as sentiment_error, c_error as category_error, count(*) as rows
from answered where s_error is not null or c_error is not null group by all""",
    "join_identity": f"""{_COMMON}
select doc_id, url_hash, fingerprint, {_sentiment('s_error')}, {_category('c_error')}
from answered""",
    "join_sentiment": f"""{_COMMON}
select b.url_hash, count(*)::decimal(38,0) as rows, count(s.s_error)::decimal(38,0) as sentiment_errors
from answered b left join answered s on b.url_hash = s.url_hash group by b.url_hash""",
    "join_both": f"""{_COMMON}
select b.url_hash, count(*)::decimal(38,0) as rows, count(s.s_error)::decimal(38,0) as sentiment_errors,
       count(c.empty_error)::decimal(38,0) as category_errors
from answered b left join answered s on b.url_hash = s.url_hash
                left join answered c on b.url_hash = c.url_hash
group by b.url_hash""",
    "batch_stats": f"""{_COMMON}
select count(*) as total, count(s_error) as sentiment_errors, count(c_error) as category_errors
from answered""",
    "kafka_payload": f"""{_COMMON}
select json_merge_patch('{{}}', to_json({{
         title: title, author: author, text: text, summary: summary, url: url, source: source,
         published_at: strftime(published_at, '%Y-%m-%dT%H:%M:%S.%gZ'),
         scraped_at: strftime(scraped_at, '%Y-%m-%dT%H:%M:%S.%gZ'),
         url_hash: url_hash, fingerprint: fingerprint,
         sentiment_label: case when not blank then s_label end,
         sentiment_score: case when not blank then s_score end,
         sentiment_inferred_at: stamp, sentiment_error: empty_error,
         category_label: case when not blank then c_label end,
         category_score: case when not blank then c_score end,
         category_inferred_at: stamp, category_error: empty_error
       }}))::varchar as value
from answered""",
    "parquet_sink_roundtrip": f"""{_COMMON}
select {_FULL}, strftime(published_at, '%Y-%m-%d') as ingest_date from answered""",
    "console_projection": f"""{_COMMON}
select title,
       case when s_error is null then s_label end as sentiment_label,
       case when s_error is null then s_score end as sentiment_score,
       case when c_error is null then c_label end as category_label,
       case when c_error is null then c_score end as category_score,
       s_error as sentiment_error, c_error as category_error
from answered""",
    "enrich_articles": f"{_COMMON} select {_FULL} from answered",
    "stream_enrich": f"""{_COMMON}
select {_BASE}, {_sentiment('s_error')}, {_category('c_error')} from answered""",
    "failed_requests": f"""{_COMMON}, refused as (
  select *, case when not blank and n % 7 = 0 then 'refused a text of ' || n else s_error end
         as r_error
  from answered
)
select doc_id, url_hash, {_sentiment('r_error')} from refused""",
    "dedup_default": f"""{_COMMON}
select distinct url_hash, fingerprint, md5(text) as text_md5, md5(text_prepped) as text_prepped_md5,
       url
from scorable""",
    "stream_batches": _batches("true"),
    "stream_sink_failure": _batches("true"),
    "stream_skipped_batch": _batches("batch_id = 1"),
    "stream_bounded": _batches("true", 4),
    "stream_delivered_once": f"""{_told(2)}
select sink, {_TIMELESS} from told, (values (0), (1)) sinks(sink)""",
    "stream_empty_batch": f"""{_told(3)}
select batch_id, count(*) as rows, count(s_error) as sentiment_errors
from told where batch_id <> 1 group by batch_id
union all select 1, 0, 0""",
    "stream_replayed_batch": f"{_told(2)} select {_TIMELESS} from told",
    "score_requests": f"""{_REQUESTS}
select doc_id,
       case when not blank then 'request ' || request || ': ' || texts || ' texts' end
         as sentiment_label,
       case when not blank then bytes end::double as sentiment_score,
       (asked + case when blank then (texts > 0)::int + turn else 1 end)::varchar
         as sentiment_inferred_at,
       case when blank then 'empty_text_for_inference' end as sentiment_error
from requests""",
    "score_tally": f"""{_REQUESTS}
select count(distinct part) as scorers,
       count(distinct (part, chunk)) filter (where texts > 0) as requests,
       count(*) filter (where not blank) as answers
from requests""",
}
