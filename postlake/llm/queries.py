"""Registered queries of the operators: each reads its whole given table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, convrepair, hardneg, langid, licenses, linededup, packing, quality, sentencepieces, sharding, simhash, topk, toxicity
from .common import crc_fold, table


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_fold(F.col("doc_id"), 3) == 1
    model = langid.fit(docs, ~held_out)
    found = docs.select("doc_id", held_out.alias("held_out"), langid.identify(docs, model).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.rejected")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = quality.fit(docs)
    found = docs.select("doc_id", quality.judge(docs, scorer).alias("found"))
    votes = F.concat_ws("", F.transform("found.votes", lambda v: v.cast("string")))
    return found.select("doc_id", "found.quality_score", "found.keep", votes.alias("votes"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.toxicity(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, relabelled)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, copies = convrepair.damaged(table(spark, sf_dir, "conversations"))
    found = convrepair.repair(rows, "conv", copies=copies).digests()
    return found.withColumnsRenamed({"conv": "conv_id", "sha256": "repaired_sha256"})


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_packing": op2_packing,
    "op3_exact_topk": op3_exact_topk,
    "op4_toxicity": op4_toxicity,
    "op5_nearest": op5_nearest,
    "op6_language_id": op6_language_id,
    "op7_quality": op7_quality,
    "op8_licenses": op8_licenses,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_simhash": op10_simhash,
    "op11_line_dedup": op11_line_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_repair": op13_conversation_repair,
}

#: Brute force over all pairs of a query and a row, in integers.
OP3_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(cast(q.e as double[]), cast(c.e as double[])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0
)
select query_id, cast(rank as int) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
) where rank <= 5
"""

#: Every line grouped by its key; the lines that stay, put together again.
OP11_SQL = r"""
with d as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (select r, doc_id, unnest(lines) as line, unnest(range(len(lines))) as i from d),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
known as (select key, max(doc_id) as keeper from k where length(key) >= 40 group by key having count(distinct r) >= 5),
m as (select k.*, known.key is not null and k.doc_id is distinct from known.keeper as gone from k left join known on k.key = known.key)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from m group by r, doc_id
"""

#: Brute force over all pairs of an anchor and a row, in integers.
OP12_SQL = """
with v as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select a.r, a.vec_id as anchor_id, a.label, c.vec_id, c.label as other, cast(list_inner_product(cast(a.e as double[]), cast(c.e as double[])) as bigint) as score
  from v a join v c on a.vec_id <> c.vec_id and len(a.e) = len(c.e) where a.vec_id % 100 = 0
),
p as (select * from (select *, row_number() over (partition by r order by score desc, vec_id) as place from s where other = label) where place <= 5),
n as (
  select p.r, p.place, p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
    row_number() over (partition by p.r, p.place order by s.score desc, s.vec_id) as rank
  from p join s on p.r = s.r and s.other <> s.label and 80 * p.score <= 100 * s.score and s.score <= p.score
)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from n where rank <= 5
"""



def _op13_sql() -> str:
    """Damage, faults and the cheapest edits, row by row: a list of four strings, for
    each state ten digits of cost and the audit, so that the least string is the one wanted."""

    def add(s: str, cost: str, edit: str) -> str:
        return f"lpad(cast(cast({s}[1:10] as bigint) + {cost} as varchar), 10, '0') || {s}[11:] || '{edit}'"

    s0, s1, s2, s3 = (f"s[{i}]" for i in range(1, 5))
    inserts = f"""[{s0}, {s1}, least({s2}, {add(s0, '3', 'I')}, {add(s1, '3', 'I')}, {add(s3, '3', 'I')}),
      least({s3}, {add(s2, '3', 'I')}, {add(s0, '6', 'II')}, {add(s1, '6', 'II')})]"""
    late = "cast(x[3] as bigint)"
    to_s = f"case when x[2] = 's' then {add(s0, late, 'K')} end"
    to_u = ", ".join(f"case when x[2] = 'u' then {add(s, late, 'K')} else {add(s, '3 + ' + late, 'R')} end" for s in (s0, s1, s3))
    to_a = f"case when x[2] = 'a' then {add(s2, late, 'K')} else {add(s2, '3 + ' + late, 'R')} end"
    gone = [add(s, "4", "D") for s in (s0, s1, s2, s3)]
    row = f"[{gone[0]}, least({gone[1]}, {to_s}), least({gone[2]}, {to_u}), least({gone[3]}, {to_a})]"
    return f"""
with bytes as (
  select *, list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda c: cast(ascii(c) as bigint)) as b
  from conversations
),
crc as (
  select * exclude (b), xor(list_reduce(list_prepend(4294967295, b), lambda c, y: list_reduce(
    [xor(c, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda z, i: xor(z >> 1, 3988292384 * (z & 1)))), 4294967295) % 20 as h from bytes
),
made as (
  select conv_id, turn, case when h = 4 then 'user' else coalesce(role, ' ') end as role,
    case when h = 1 then '' when h = 2 then translate(coalesce(text, ' '), '.!?', '') else coalesce(text, ' ') end as text,
    unnest(range(case when h = 0 then 0 when h = 3 then 2 else 1 end)) as copy from crc
),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as again,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as said from made
),
marked as (
  select *, role[1:1] as initial, case when said = '' then 1 when again > 1 then 2 when right(said, 1) not in ('.', '!', '?') then 3 else 0 end as fault,
    lag(role[1:1]) over (partition by conv_id order by i) as before from placed
),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
    count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal,
    list(case when fault in (1, 2) then ['D', '', '0'] else ['E', initial, case when fault = 3 then '3' else '0' end] end order by i) as steps
  from marked group by conv_id
),
ends as (
  select *, list_reduce(list_prepend(['0000000000', null, null, null], list_concat(flatten(list_transform(steps, lambda e: [['I'], e])), [['I']])),
    lambda s, x: case x[1] when 'I' then {inserts} when 'D' then [{', '.join(gone)}] else {row} end) as s from counted
),
best as (select *, cast(least(s[1], s[4])[1:10] as bigint) as cost, least(s[1], s[4])[11:] as audit from ends),
letters as (
  select conv_id, unnest(string_split(audit, '')) as e, unnest(range(len(audit))) as pos from best where audit <> ''
),
edits as (select *, sum(case when e = 'I' then 0 else 1 end) over (partition by conv_id order by pos) as i from letters),
stay as (
  select edits.conv_id, pos, e, role, text, row_number() over (partition by edits.conv_id order by pos) - 1 as place,
    first_value(case when e = 'K' and role[1:1] = 's' then 1 else 0 end) over (partition by edits.conv_id order by pos) as lead
  from edits left join marked on edits.conv_id is not distinct from marked.conv_id and edits.i = marked.i and e <> 'I' where e <> 'D'
),
repaired as (
  select conv_id, string_agg(case when e = 'K' then role when (place - lead) % 2 = 0 then 'user' else 'assistant' end || ':' ||
    case when e = 'I' then '' else text end, chr(10) order by pos) as body from stay group by conv_id
)
select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit, sha256(coalesce(body, '')) as repaired_sha256
from (select distinct conv_id from conversations) a left join best on a.conv_id is not distinct from best.conv_id
  left join repaired on a.conv_id is not distinct from repaired.conv_id
"""


ORACLE: dict[str, str] = {
    "op3_exact_topk": OP3_SQL,
    "op8_licenses": licenses.oracle(),
    "op11_line_dedup": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_conversation_repair": _op13_sql(),
}
