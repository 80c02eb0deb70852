"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe, language, leaks, licences, packing, quality, resampling, rules, simhash, substrings, turns,
    urls, warc,
)
from .common import held_out, table

URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def op4_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    templates = licences.template_table(spark, licences.TEMPLATES | licences.RELATIVES)
    return licences.scan(docs, templates, licences.train(docs, templates))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.find_near(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("near_items")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.archive_pages(spark, table(spark, sf_dir, "pages"))
    return captures.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        "url_key", "captured", "merge_range", "merge_place",
    )


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents")))


def op12_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_simhash, op2_language, op3_urls, op4_rules, op5_licences, op6_quality, op7_substrings,
        op8_packing, op9_leaks, op9_near, op10_warc, op11_bpe, op12_turns, op13_resampling,
    )
}

OP4_SQL = r"""
with base as (
  select row_number() over () as row_id, doc_id, lang, source, coalesce(text, '') as text from documents
), word as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from base
), gram as (
  select row_id, k, count(*) over (partition by row_id, g) as n from (
    select row_id, k, array_to_string(w[k:k + 4], ' ') as g
    from (select row_id, w, unnest(generate_series(1, len(w) - 4)) as k from word where len(w) > 5))
), repeated as (
  select row_id, count(distinct k + d) as n_repeat_words
  from gram, (select unnest([0, 1, 2, 3, 4]) as d) where n > 1 group by row_id
), counted as (
  select row_id, doc_id, lang, source, len(w)::bigint as n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from word left join repeated using (row_id)
), rated as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    case when n_words > 0 then 1000 * n_symbols // n_words end as symbol_rate,
    case when n_lines > 0 then 1000 * n_dup_lines // n_lines end as line_rate,
    case when n_words > 0 then 1000 * n_repeat_words // n_words end as repeat_rate,
    case when n_words > 0 then 1000 * word_chars // n_words end as word_length
  from counted
), value as (
  select lang, source, rate, v, greatest(0, length(bin(v)) - 6) as s from (
    select lang, source, unnest(['symbol_rate', 'line_rate', 'repeat_rate', 'word_length']) as rate,
      unnest([symbol_rate, line_rate, repeat_rate, word_length]) as v
    from rated where n_words > 0)
), level as (
  select 0 as level, lang as lg, source as sc, rate, (v >> s) << s as bucket from value
  union all select 1, lang, null, rate, (v >> s) << s from value
  union all select 2, null, null, rate, (v >> s) << s from value
), quartile as (
  select level, lg, sc, rate, count(*) as n,
    quantile_disc(bucket, 0.25) as q1, quantile_disc(bucket, 0.75) as q3
  from level group by all
), fence as (
  select level, lg, sc, rate, n, q1 - 3 * greatest(q3 - q1, least) as low, q3 + 3 * greatest(q3 - q1, least) as high
  from quartile join (values ('symbol_rate', 50), ('line_rate', 100), ('repeat_rate', 100),
    ('word_length', 500)) as t(rate, least) using (rate)
), chosen as (
  select a.lg, a.sc, a.rate,
    case when a.n >= 100 then a.low when b.n >= 100 then b.low else c.low end as low,
    case when a.n >= 100 then a.high when b.n >= 100 then b.high else c.high end as high
  from fence a join fence b on b.level = 1 and a.rate = b.rate and a.lg is not distinct from b.lg
  join fence c on c.level = 2 and a.rate = c.rate
  where a.level = 0
), outlier as (
  select row_id, bool_or(v > high or r.rate = 'word_length' and v < low) as bad
  from (select row_id, lang, source,
      unnest(['symbol_rate', 'line_rate', 'repeat_rate', 'word_length']) as rate,
      unnest([symbol_rate, line_rate, repeat_rate, word_length]) as v from rated) r
  join chosen on chosen.rate = r.rate and lang is not distinct from lg and source is not distinct from sc
  group by row_id
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(bad, false) as kept, symbol_rate, line_rate, repeat_rate, word_length
from rated left join outlier using (row_id)
"""

OP7_SQL = r"""
with word as (
  select row_number() over () as row_id, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select row_id, doc_id, k, array_to_string(w[k:k + 12], ' ') as g
  from (select *, unnest(generate_series(1, len(w) - 12)) as k from word where len(w) > 12)
), hit as (
  select row_id, k from (select *, min(doc_id) over (partition by g) as first_id from windows) where doc_id > first_id
), gone as (
  select distinct row_id, k + d as p from hit, (select unnest(generate_series(0, 12)) as d)
), single as (
  select row_id, unnest(w) as x, unnest(generate_series(1, len(w))) as p from word where len(w) > 0
), kept as (
  select row_id, string_agg(x, ' ' order by p) as text, count(*) as n
  from single anti join gone using (row_id, p) group by row_id
)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
  sha256(coalesce(text, '')) as kept_sha256
from word left join kept using (row_id)
"""

OP9_SQL = r"""
with word as (
  select row_number() over () as row_id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), item as (
  select item_id::varchar as item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where item_id is not null
), phrase as (
  select distinct item, array_to_string(w[k:k + 9], ' ') as g, least(len(w), 10) as size
  from (select *, unnest(generate_series(1, greatest(len(w) - 9, 1))) as k from item where len(w) > 0)
), windows as (
  select row_id, k, size, array_to_string(w[k:k + size - 1], ' ') as g
  from (select row_id, w, size, unnest(generate_series(1, len(w) - size + 1)) as k
    from word, (select distinct size from phrase) where len(w) >= size)
), hit as (
  select row_id, k, size, item from windows join phrase using (g, size)
), place as (
  select row_id, count(distinct p) as n_hit
  from (select row_id, unnest(generate_series(k, k + size - 1)) as p from hit) group by row_id
), found as (
  select row_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct row_id, item from hit) group by row_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from word left join place using (row_id) left join found using (row_id)
"""

#: CRC-32 of a list of bytes, from the table of its 256 steps.
CRC_STEPS = """
crc_step as (
  select list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda r, x: case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end)) as step
)"""
CRC = """xor(4294967295, list_reduce(list_concat([4294967295], {bytes}),
    lambda c, b: xor(step[(xor(c, b) & 255) + 1], c >> 8)))"""

OP12_SQL = f"""
with {CRC_STEPS}, own as (
  select conv_id, turn, coalesce(text, '') as text,
    md5(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as id
  from conversations where conv_id is not null
), numbered as (
  select conv_id, id, strlen(text) as size, row_number() over (partition by conv_id order by turn nulls first, id) as k
  from own
), conv as (
  select conv_id, conv_id - conv_id % 5 as base,
    {CRC.format(bytes="list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)")} % 9 as h
  from (select distinct conv_id from own), crc_step
), turns as (
  select c.conv_id, 0 as part, k, id, size from conv c join numbered n on n.conv_id = c.base and k <= h
  union all
  select c.conv_id, 1, k, id, size from conv c join numbered n on n.conv_id = c.conv_id and k > h
), rebuilt as (
  select conv_id, coalesce(list(id order by part, k) filter (where id is not null), []) as ids,
    coalesce(list(size order by part, k) filter (where id is not null), []) as sizes
  from conv left join turns using (conv_id) group by conv_id
), prefix as (
  select conv_id, len(ids) as n, d as depth, ids[1:d] as p, coalesce(sizes[d], 0) as size
  from (select *, unnest(range(0, len(ids) + 1)) as d from rebuilt)
), node as (
  select p, depth, min(conv_id) as conv_id, count(*) as n_convs, max(size) as size,
    string_agg(conv_id::varchar, ',' order by conv_id) filter (where n = depth) as ends
  from prefix group by p, depth
), child as (
  select p[1:depth - 1] as p, depth - 1 as depth, count(*) as n_children from node where depth > 0 group by all
), valued as (
  select node.*, coalesce(n_children, 0) as n_children from node left join child using (p, depth)
), below as (
  select p[1:k] as p, k as depth, sum((n_children = 0)::int) as n_leaves, sum((n_convs - 1) * size) as saved
  from (select *, unnest(range(0, depth + 1)) as k from valued) group by all
)
select v.conv_id, v.depth::bigint as depth, parent.conv_id as parent_conv_id, v.n_convs, v.n_children,
  n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, sha256(coalesce(v.ends, '')) as ends_sha256
from valued v join below using (p, depth)
left join node parent on parent.depth = v.depth - 1 and parent.p = v.p[1:v.depth - 1]
"""

OP13_SQL = rf"""
with {CRC_STEPS}, word as (
  select row_number() over () as row_id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), aim as (
  select unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as x from benchmark
), feature as (
  select row_id, x, count(*) as n from (select row_id, unnest(w) as x from word) group by all
), coded as (
  select x, {CRC.format(bytes="list_transform(range(1, strlen(x) * 2, 2), lambda i: ('0x' || substr(hex(x), i, 2))::bigint)")} % 10000 as bucket
  from (select x from feature union select x from aim), crc_step
), source as (
  select bucket, sum(n)::double as s from feature join coded using (x) group by bucket
), target as (
  select bucket, count(*)::double as t from aim join coded using (x) group by bucket
), total as (
  select coalesce((select sum(s) from source), 0) as all_s, coalesce((select sum(t) from target), 0) as all_t
), gain as (
  select bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::bigint as gain
  from source left join target using (bucket), total
), weighed as (
  select row_id, sum(n * gain)::bigint as weight from feature join coded using (x) join gain using (bucket) group by row_id
), scored as (
  select doc_id, len(w)::bigint as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from word left join weighed using (row_id)
), placed as (
  select *, n_features >= 20 as able,
    row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last) as place from scored
)
select doc_id, n_features, weight, score,
  case when able and place <= (select count(*) * 10 // 100 from scored where n_features >= 20) then place end as rank
from placed
"""

ORACLES = {
    "op4_rules": OP4_SQL,
    "op7_substrings": OP7_SQL,
    "op9_leaks": OP9_SQL,
    "op12_turns": OP12_SQL,
    "op13_resampling": OP13_SQL,
}
