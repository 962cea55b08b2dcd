"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from profileloom.llm import collocations, golomb_dedup, imatch, length_buckets, pair_bpe, pieces, prefix_trie, pseudonyms, quality, secret_scan, simhash, token_files, tool_chat

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(query):
        QUERIES[query.__name__] = query
        if sql:
            ORACLES[query.__name__] = sql
        return query

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query()
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(_table(spark, sf_dir, "documents"))


@_query()
def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_with_edits(_table(spark, sf_dir, "documents"))


#: The key of the registered query alone; a real run passes a secret of its own.
DEMO_KEY = b"a key that is no secret"


@_query()
def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.hide_personal_data(_table(spark, sf_dir, "documents"), DEMO_KEY)


@_query()
def op4_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_buckets.pack(_table(spark, sf_dir, "documents"))


@_query("""
with normal as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from normal window w as (partition by t)
""")
def op5_golomb_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golomb_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


@_query()
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_and_decode(_table(spark, sf_dir, "documents"))


@_query()
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"))


@_query()
def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query()
def op9_tool_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has plain chats only, so each message becomes tool traffic first."""
    traffic = tool_chat.derived_calls(_table(spark, sf_dir, "conversations"))
    return tool_chat.link_tools(traffic, tool_chat.SCHEMAS)


@_query()
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query()
def op11_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_bpe.encode_and_decode(_table(spark, sf_dir, "documents"))


@_query("""
with own as (
  select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn nulls first) as turns
  from conversations group by conv_id),
bytes as (
  select conv_id, flatten(list_transform(range(1, length(conv_id::varchar) + 1), lambda i:
    [ascii(substr(conv_id::varchar, i, 1))::bigint] || list_transform(range(8), lambda bit: -1::bigint))) as steps from own),
hashed as (
  select conv_id, xor(list_reduce([4294967295::bigint] || steps, lambda crc, x: case
    when x >= 0 then xor(crc, x) when crc & 1 = 1 then xor(crc >> 1, 3988292384) else crc >> 1 end), 4294967295) % 6 as h
  from bytes),
rebuilt as (
  select own.conv_id, list_concat(coalesce(base.turns[1:h], []), own.turns[h + 1:]) as path
  from own join hashed using (conv_id) left join own base on base.conv_id = own.conv_id - own.conv_id % 100),
members as (select conv_id, path, unnest(range(0, len(path) + 1)) as depth from rebuilt),
nodes as (
  select path[1:depth] as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
    coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(members.path) = depth), '') as ends
  from members group by path[1:depth], depth),
valued as (
  select *, case when depth = 0 then 0 else (n_convs - 1) * length(path[depth].text) end as saved,
    path[1:depth - 1] as above from nodes),
children as (select above, count(*) as n_children from valued where depth > 0 group by above),
complete as (
  select v.*, coalesce(c.n_children, 0) as n_children from valued v left join children c on c.above = v.path),
spread as (select path, saved, n_children, unnest(range(0, depth + 1)) as over from complete),
sums as (
  select path[1:over] as path, sum(saved)::bigint as saved_tokens, count(*) filter (n_children = 0) as n_leaves
  from spread group by path[1:over])
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens,
  sha256(n.ends) as ends_sha256
from complete n join sums s on s.path = n.path left join complete p on n.depth > 0 and p.path = n.above
""")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


@_query("""
with pieces as (
  select coalesce(lang, 'und') as lang, row_number() over () as doc, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
numbered as (
  select lang, row_number() over () as p, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') as w from pieces),
tokens as (
  select lang, p, unnest(w) as w1, unnest(range(1, len(w) + 1)) as i, w from numbered),
grams as (
  select lang, w1, w[i + 1] as w2, w[i + 2] as w3 from tokens),
f as (
  select lang, w1 as phrase, 1 as size, count(*) as n, w1, null as w2, null as w3 from grams group by lang, w1
  union all
  select lang, w1 || ' ' || w2, 2, count(*), w1, w2, null from grams where w2 is not null group by lang, w1, w2
  union all
  select lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*), w1, w2, w3 from grams where w3 is not null group by lang, w1, w2, w3),
candidates as (select * from f where size > 1 and n >= 10),
cuts as (
  select lang, phrase, size, n, 1 as k, w1 as one, case when size = 2 then w2 else w2 || ' ' || w3 end as other from candidates
  union all
  select lang, phrase, size, n, 2, w1 || ' ' || w2, w3 from candidates where size = 3),
scored as (
  select c.lang, c.phrase, c.size, c.n as a, k, x.n as l, y.n as r,
    (1000000::hugeint * c.n * c.n) // (x.n::hugeint * y.n) as score
  from cuts c join f x on x.lang = c.lang and x.phrase = one join f y on y.lang = c.lang and y.phrase = other),
lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (
  select lang, phrase, max(n) as n from (
    select lang, w1 || ' ' || w2 as phrase, n from candidates where size = 3
    union all select lang, w2 || ' ' || w3, n from candidates where size = 3) group by lang, phrase),
kept as (
  select s.* from lowest s left join longer g on g.lang = s.lang and g.phrase = s.phrase
  where s.size = 3 or g.n is null or 100 * g.n < 50 * a),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept),
totals as (select lang, sum(n)::bigint as n from f where size = 1 group by lang)
select ranked.lang, rank, phrase, a, l, r, totals.n, score::bigint as score
from ranked join totals on totals.lang = ranked.lang where rank <= 2000
""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))
