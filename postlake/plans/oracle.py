"""DuckDB oracle SQL for the registered queries (same column names/values)."""

from __future__ import annotations

from ..functions.constants import PY_SPACE_CLASS
from .fixtures import LABELLED_SQL, RAW_POSTS_SQL, UNLABELLED_SQL

_TS = r"case when regexp_full_match(@X, '\d{2}-\d{2}-\d{4} \d{2}:\d{2}') then try_strptime(@X, '%d-%m-%Y %H:%M') end"
_TRIM_CAST = r"regexp_replace(@X, '^[\x00-\x20\x7F]+|[\x00-\x20\x7F]+$', '', 'g')"
_LONG = (
    r"case when regexp_full_match(@T, '[+-]?[0-9]+(\.[0-9]*)?') "
    r"then try_cast(regexp_extract(@T, '^([+-]?[0-9]+)', 1) as bigint) "
    r"when regexp_full_match(@T, '[+-]?\.[0-9]*') then cast(0 as bigint) end"
)
_BOOL = (
    "case when lower(@X) in ('true', 't', '1', 'yes', 'y') then true "
    "when lower(@X) in ('false', 'f', '0', 'no', 'n') then false end"
)
_URLS = r"regexp_replace(@X, 'https?://\S+|www\.\S+', ' ', 'g')"
_MENTIONS = r"regexp_replace(@X, '@\w+', ' ', 'g')"
_WS = r"lower(trim(regexp_replace(@X, '\s+', ' ', 'g')))"
_HSTR = r"regexp_replace(coalesce(@X, ''), '[\[\]'']', '', 'g')"
_HARR = r"list_filter(list_transform(regexp_split_to_array(@H, '\s*,\s*'), lambda x: lower(trim(x))), lambda x: x <> '')"
_BLANK = f"(@X is null or regexp_full_match(@X, '{PY_SPACE_CLASS}*'))"
_STRIP = f"regexp_replace(coalesce(@X, ''), '^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+$', '', 'g')"


def ts(x: str) -> str:
    return _TS.replace("@X", x)


def to_long(x: str) -> str:
    return _LONG.replace("@T", _TRIM_CAST.replace("@X", x))


def to_bool(x: str) -> str:
    return _BOOL.replace("@X", x)


def clean_text(x: str) -> str:
    return _WS.replace("@X", _MENTIONS.replace("@X", _URLS.replace("@X", x)))


def hashtags_arr(x: str) -> str:
    return _HARR.replace("@H", _HSTR.replace("@X", x))


def blank(x: str) -> str:
    return _BLANK.replace("@X", x)


def strip(x: str) -> str:
    return _STRIP.replace("@X", x)


def letter_logit(x: str, ch: str) -> str:
    return f"cast(40 as double) * (length({x}) - length(replace(lower({x}), '{ch}', ''))) / length({x})"


RAW = f"raw_posts as ({RAW_POSTS_SQL})"

TYPED = f"""typed as (
  select post_id, user_name, user_location,
    {_WS.replace('@X', 'user_location')} as user_location_clean,
    user_description,
    {ts('user_created')} as user_created_ts,
    {to_long('user_followers')} as user_followers,
    {to_long('user_friends')} as user_friends,
    {to_long('user_favourites')} as user_favourites,
    {to_bool('user_verified')} as user_verified,
    {ts('date')} as tweet_ts,
    cast({ts('date')} as date) as tweet_date,
    text as text_raw,
    {clean_text('text')} as text_clean,
    hashtags,
    {_HSTR.replace('@X', 'hashtags')} as hashtags_str,
    {hashtags_arr('hashtags')} as hashtags_arr,
    source,
    {to_bool('is_retweet')} as is_retweet
  from raw_posts)"""

VALID_WHERE = "tweet_ts is not null and length(text_clean) > 0"
COUNTS_WHERE = (
    "(user_followers is null or user_followers >= 0) and (user_friends is null or user_friends >= 0) "
    "and (user_favourites is null or user_favourites >= 0)"
)

CLEAN = f"""clean as (
  select * from typed where {VALID_WHERE} and {COUNTS_WHERE}
  qualify row_number() over (partition by user_name, tweet_ts, text_clean order by post_id) = 1)"""

CLEAN_SELECT = """user_name, user_location, user_location_clean, user_description, user_created_ts,
  user_followers, user_friends, user_favourites, user_verified, tweet_ts, tweet_date, text_raw, text_clean,
  hashtags, array_to_string(hashtags_arr, '|') as hashtags_arr, len(hashtags_arr) as n_hashtags_arr,
  source, is_retweet"""

RAW_SELECT = """cast(post_id as varchar) as post_id, user_name, user_location, user_description, user_created,
  user_followers, user_friends, user_favourites, user_verified, date, text, hashtags, source, is_retweet"""

LAB = f"lab as ({LABELLED_SQL})"
UNL = f"unl as ({UNLABELLED_SQL})"

# labelled rows with ids, per-class train quotas (largest remainder), split flag
SPLIT = f"""{LAB},
lab2 as (select *, case sentiment when 'negative' then 0 when 'neutral' then 1 when 'positive' then 2 end as label_id
         from lab),
labk as (select * from lab2 where label_id is not null),
cc as (select label_id, count(*) as n from labk group by label_id),
tot as (select sum(n) as total, sum(n) - cast(ceil(cast(0.2 as double) * sum(n)) as bigint) as n_train from cc),
q1 as (select cc.label_id, (cc.n * tot.n_train) // tot.total as fl, (cc.n * tot.n_train) % tot.total as rem, tot.n_train
       from cc join tot on true),
q2 as (select *, row_number() over (order by rem desc, label_id) as rr, n_train - sum(fl) over () as extra from q1),
quota as (select label_id, fl + case when rr <= extra then 1 else 0 end as qt from q2),
ranked as (select labk.*, row_number() over (partition by label_id
             order by md5(concat('42:', length(cast(doc_id as varchar)), ':', cast(doc_id as varchar))), doc_id) as rk from labk),
split as (select ranked.*, ranked.rk <= quota.qt as is_train from ranked join quota on ranked.label_id = quota.label_id)"""

UNL_READY = f"""{UNL},
unl_ready as (select * from unl where not {blank('text')})"""


def scored(src: str, text: str, name: str = "sc") -> str:
    """Test-scorer CTE chain over ``src`` (rows with ``text`` non-blank)."""
    return f"""{name}_l as (select *, {letter_logit(text, 'a')} as l0, {letter_logit(text, 'e')} as l1,
                  {letter_logit(text, 'o')} as l2 from {src}),
{name}_e as (select *, exp(l0 - greatest(l0, l1, l2)) as e0, exp(l1 - greatest(l0, l1, l2)) as e1,
                  exp(l2 - greatest(l0, l1, l2)) as e2 from {name}_l),
{name}_p as (select *, e0 / (e0 + e1 + e2) as p0, e1 / (e0 + e1 + e2) as p1, e2 / (e0 + e1 + e2) as p2 from {name}_e),
{name} as (select *, greatest(p0, p1, p2) as conf,
             case when p0 = greatest(p0, p1, p2) then 0 when p1 = greatest(p0, p1, p2) then 1 else 2 end as sid
           from {name}_p)"""


SENT = "case sid when 0 then 'negative' when 1 then 'neutral' when 2 then 'positive' end"

FILES = """files as (select url as path, split_part(url, '/', -1) as file_name, octet_length(encode(html)) as length from pages)"""

DOCS_OK = f"docs_ok as (select doc_id, text from documents where not {blank('text')})"

PSEUDO = f"""{UNL_READY},
unl_m as (select doc_id, text, {strip('text')} as m from unl_ready),
{scored('unl_m', 'm', 'ps')},
pseudo as (select doc_id, text, sid as label_id, conf from ps where conf >= cast(0.9 as double))"""

SCHED = """sched as (
  select 1 as step, cast(0.9 as double) as t
  union all select 2, least(cast(0.95 as double), cast(0.9 as double) + cast(0.02 as double))
  union all select 3, least(cast(0.95 as double), least(cast(0.95 as double), cast(0.9 as double) + cast(0.02 as double)) + cast(0.02 as double)))"""

VAL = f"""{SPLIT},
val_m as (select doc_id, label_id, {strip('text')} as m from split where not is_train),
{scored('val_m', 'm', 'vs')},
val_ce as (select doc_id, label_id, sid,
  greatest(l0, l1, l2) + ln(exp(l0 - greatest(l0, l1, l2)) + exp(l1 - greatest(l0, l1, l2)) + exp(l2 - greatest(l0, l1, l2)))
  - case label_id when 0 then l0 when 1 then l1 else l2 end as ce,
  md5(concat('42:', length(cast(doc_id as varchar)), ':', cast(doc_id as varchar))) as ord from vs)"""


ORACLE: dict[str, str] = {
    "clean_posts": f"with {RAW}, {TYPED}, {CLEAN} select {CLEAN_SELECT} from clean",
    "parse_timestamps": f"with {RAW}, {TYPED} select post_id, tweet_ts, user_created_ts from typed",
    "cast_counts": f"with {RAW}, {TYPED} select post_id, user_followers, user_friends, user_favourites from typed",
    "parse_booleans": f"with {RAW}, {TYPED} select post_id, user_verified, is_retweet from typed",
    "strip_urls": f"with {RAW} select post_id, {_URLS.replace('@X', 'text')} as text_no_urls from raw_posts",
    "strip_mentions": f"with {RAW} select post_id, {_MENTIONS.replace('@X', 'text')} as text_no_mentions from raw_posts",
    "clean_text": f"with {RAW}, {TYPED} select post_id, text_raw, text_clean from typed",
    "parse_hashtags": f"""with {RAW}, {TYPED} select post_id, hashtags_str,
        array_to_string(hashtags_arr, '|') as hashtags_arr, len(hashtags_arr) as n_hashtags_arr from typed""",
    "clean_location": f"with {RAW}, {TYPED} select post_id, user_location_clean from typed",
    "derive_date": f"with {RAW}, {TYPED} select post_id, tweet_date from typed",
    "valid_posts": f"with {RAW}, {TYPED} select post_id, tweet_ts, text_clean from typed where {VALID_WHERE}",
    "nonnegative_counts": f"""with {RAW}, {TYPED} select post_id, user_followers, user_friends, user_favourites
        from typed where {COUNTS_WHERE}""",
    "dedup_posts": f"with {RAW}, {TYPED}, {CLEAN} select post_id, user_name, tweet_ts, text_clean from clean",
    "csv_scan_multiline": f"with {RAW} select {RAW_SELECT} from raw_posts",
    "csv_scan_na_tokens": f"with {LAB} select doc_id, text, sentiment from lab",
    "land_raw_rows": f"""with {RAW}, ragged as (select cast(post_id as varchar) as id, source, post_id % 3 as kind,
          case post_id % 3 when 0 then concat_ws(',', post_id, source, user_name, 'more') when 1 then cast(post_id as varchar) end as record
        from raw_posts)
        select {RAW_SELECT}, cast(null as varchar) as raw_record, true as has_file_size from raw_posts
        union all select id, null, null, null, null, null, null, null, null, null, null, null,
          case when kind <> 1 then source end, null, record, true from ragged""",
    "whole_text_read": """select lang, cast(sum(length(text) + 1) as bigint) as n_chars from documents group by lang""",
    "ingest_manifest": f"""with {FILES} select 'raw-zone/raw/' || file_name as location, 'test_local' as source, file_name,
        replace(file_name, '.csv', '') as dataset, round(length / 1048576.0, 6) as file_size_mb, cast(null as varchar) as source_uri from files""",
    "pick_csv_file": f"""with {FILES}
        select * from (select 'named' as pick, * from files order by file_name <> '960', path, length limit 1)
        union all select * from (select 'first' as pick, * from files order by path, length limit 1)""",
    "enveloped_records": """with k as (select case when conv_id % 7 <> 0 then conv_id end as batch, * from conversations)
        select batch, conv_id, turn, length(text) as n_chars, 'conversations' as source,
          count(*) over (partition by batch) as record_count, 'chats' as dataset from k""",
    "write_partitioned_roundtrip": f"with {RAW}, {TYPED}, {CLEAN} select {CLEAN_SELECT} from clean",
    "partition_pruned_read": f"""with {RAW}, {TYPED}, {CLEAN} select {CLEAN_SELECT} from clean
        where tweet_date between date '2021-03-01' and date '2021-06-30'""",
    "write_scored_roundtrip": f"""with {DOCS_OK}, {scored('docs_ok', 'text')}
        select doc_id, {SENT} as sentiment, sid as sentiment_id, round(conf, 6) as confidence,
        round(p0, 6) as negative_prob, round(p1, 6) as neutral_prob, round(p2, 6) as positive_prob from sc""",
    "record_envelope": """select conv_id, 'conversations' as source, count(*) as record_count,
        sum(length(text)) as total_chars from conversations group by conv_id""",
    "split_s3_uri": """with s as (select page_id, url, regexp_replace(url, '^https?://', '') as rest from pages)
        select page_id,
          case when strpos(rest, '/') > 0 then substr(rest, 1, strpos(rest, '/') - 1) else rest end as bucket,
          case when strpos(rest, '/') > 0 then substr(rest, strpos(rest, '/') + 1) else '' end as key,
          not starts_with(url, 's3://') as rejected
        from s""",
    "run_key_format": f"""with {RAW}, {TYPED} select post_id,
        'covid_data/' || strftime(tweet_ts, '%Y%m%d%H%M%S') || '/data.json' as run_key from typed
        where tweet_ts is not null""",
    "map_labels": f"""with {LAB} select * from (select doc_id, sentiment,
        case sentiment when 'negative' then 0 when 'neutral' then 1 when 'positive' then 2 end as label_id from lab)
        where label_id is not null""",
    "model_text": f"select doc_id, {strip('text')} as model_text from documents",
    "truncate_tokens": r"""select doc_id,
        array_to_string(regexp_split_to_array(text, '\s+')[1:512], ' ') as model_input from documents""",
    "nonblank_text": f"select doc_id, n_chars from documents where not {blank('text')}",
    "sample_exact": """select doc_id, lang, source from documents
        order by md5(concat('42:', length(cast(doc_id as varchar)), ':', cast(doc_id as varchar))), doc_id limit 500""",
    "stratified_split": f"""with {SPLIT}
        select doc_id, sentiment, case when is_train then 'train' else 'val' end as split from split""",
    "stage_counts": f"""select count(*) as total, count(*) filter (where not {blank('d.text')}) as valid_text,
        count(l.doc_id) as labelled, count(*) filter (where l.doc_id is null) as unlabelled,
        count(*) filter (where l.doc_id is null and not {blank('d.text')}) as unlabelled_valid
        from documents d left join labels l on d.doc_id = l.doc_id""",
    "score_posts": f"""with {DOCS_OK}, {scored('docs_ok', 'text')}
        select doc_id, {SENT} as sentiment, sid as sentiment_id, round(conf, 6) as confidence,
        round(p0, 6) as negative_prob, round(p1, 6) as neutral_prob, round(p2, 6) as positive_prob from sc""",
    "score_posts_truncated": f"""with {DOCS_OK},
        clipped as (select doc_id, array_to_string(regexp_split_to_array(text, '\\s+')[1:512], ' ') as text from docs_ok
          where len(regexp_split_to_array(text, '\\s+')) > 512),
        {scored('clipped', 'text')}
        select doc_id, {SENT} as sentiment, sid as sentiment_id, round(conf, 6) as confidence,
        round(p0, 6) as negative_prob, round(p1, 6) as neutral_prob, round(p2, 6) as positive_prob from sc""",
    "score_batches": f"""with {DOCS_OK}, {scored('docs_ok', 'text')}
        select doc_id, round(l0, 6) as l0, round(l1, 6) as l1, round(l2, 6) as l2 from sc""",
    "softmax_probs": """with e as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as l from embeddings),
        x as (select vec_id, list_transform(l, lambda v: exp(v - list_max(l))) as ex from e),
        p as (select vec_id, list_transform(ex, lambda v: v / list_sum(ex)) as p from x)
        select vec_id, cast(list_position(p, list_max(p)) - 1 as integer) as argmax,
          round(list_max(p), 6) as confidence, round(list_sum(p), 6) as prob_sum from p""",
    "label_distribution": f"""with {DOCS_OK}, {scored('docs_ok', 'text')},
        d as (select {SENT} as sentiment, count(*) as count from sc group by 1)
        select sentiment, count, round(count * 100.0 / sum(count) over (), 6) as percent from d""",
    "sentiment_report": f"""with smp as (select doc_id, text from documents
          order by md5(concat('42:', length(cast(doc_id as varchar)), ':', cast(doc_id as varchar))), doc_id limit 500),
        ok as (select * from smp where not {blank('text')}),
        {scored('ok', 'text')},
        d as (select {SENT} as sentiment, count(*) as count from sc group by 1)
        select sentiment, count, round(count * 100.0 / sum(count) over (), 6) as percent from d""",
    "pseudo_label_filter": f"with {PSEUDO} select doc_id, label_id, round(conf, 6) as confidence from pseudo",
    "pseudo_acceptance": f"""with {UNL_READY},
        unl_m as (select doc_id, {strip('text')} as m from unl_ready),
        {scored('unl_m', 'm', 'ps')}, {SCHED},
        tot as (select count(*) as total from ps)
        select s.step, round(s.t, 6) as threshold, (select count(*) from ps where ps.conf >= s.t) as accepted,
          tot.total, round(case when tot.total = 0 then 0.0 else
            (select count(*) from ps where ps.conf >= s.t) * 100.0 / tot.total end, 6) as percent
        from sched s join tot on true""",
    "combine_train": f"""with {SPLIT}, {PSEUDO}
        select doc_id, label_id, 'train' as origin from split where is_train
        union all select doc_id, label_id, 'pseudo' as origin from pseudo""",
    "eval_accuracy": f"""with {VAL}
        select count(*) as n, round(avg(case when sid = label_id then 1 else 0 end), 6) as accuracy from val_ce""",
    "eval_cross_entropy": f"""with {VAL},
        r as (select ce, row_number() over (order by ord) as rn from val_ce),
        b as (select (rn - 1) // 4 as bno, avg(ce) as bl from r group by 1)
        select (select count(*) from val_ce) as n, round((select avg(ce) from val_ce), 6) as loss,
          round((select avg(bl) from b), 6) as loss_batch_mean""",
    "self_train_round": f"""with {SPLIT}, {PSEUDO},
        c as (select (select count(*) from unl_ready) as unlabelled, (select count(*) from pseudo) as pseudo,
          (select count(*) from split where is_train) as train, (select count(*) from split where not is_train) as validation)
        select 1 as step, cast(0.9 as double) as threshold, unlabelled, pseudo,
          round(case when unlabelled = 0 then 0.0 else pseudo * 100.0 / unlabelled end, 6) as pseudo_percent,
          train, train + pseudo as combined, validation from c""",
    # losses and chances of a trained model are beyond SQL; what they must satisfy is not
    "train_predict": f"""with {SPLIT} select doc_id, label_id, true as has_label, 1.0 as chances, true as evaluated_alike from split where not is_train""",
    "self_train_best": f"""with {SPLIT}, {PSEUDO}, r as (select * from (values (1, cast(0.9 as double)), (2, cast(0.92 as double))) r(round, threshold), (values (1), (2), (3)) s(step))
        select round, step, threshold, (select count(*) from unl_ready) as unlabelled,
          case when round = 1 then (select count(*) from pseudo) end as pseudo_of_teacher,
          (select count(*) from split where is_train) as train, (select count(*) from split where not is_train) as validation,
          true as combined_adds_up, true as finite_metrics, round = 1 and step = 1 as starts_untrained, 1 as best_of_round, true as best_is_least,
          true as same_after_load, true as kept_is_least from r""",
    "exclude_labelled": """with d as (select case when doc_id % 11 <> 0 then doc_id end as id, lang, n_chars from documents),
        k as (select case when l.doc_id % 11 <> 0 then l.doc_id end as id, d.lang from labels l join documents d on l.doc_id = d.doc_id
          where l.doc_id % 11 <> 0 or d.lang <> 'de')
        select * from d where not exists (select 1 from k where k.id is not distinct from d.id and k.lang is not distinct from d.lang)""",
    "acceptance_above_cap": f"""with {UNL_READY},
        unl_m as (select doc_id, {strip('text')} as m from unl_ready),
        {scored('unl_m', 'm', 'ps')}
        select step, t as threshold, count(*) filter (conf >= t) as accepted, count(*) as total, round(count(*) filter (conf >= t) * 100.0 / count(*), 6) as percent
        from ps, (values (1, cast(0.98 as double)), (2, cast(0.95 as double)), (3, cast(0.95 as double))) s(step, t) group by step, t""",
    # the ids of a raw CSV are texts, and so is their order
    "clean_job_table": f"with {RAW}, {TYPED}, {CLEAN.replace('order by post_id', 'order by cast(post_id as varchar)')} select {CLEAN_SELECT} from clean",
    "clean_job_counts": f"""with {RAW}, {TYPED}, {CLEAN} select (select count(*) from raw_posts) as total,
        (select count(*) from typed where {VALID_WHERE} and {COUNTS_WHERE}) as valid, (select count(*) from clean) as written""",
    "sentiment_job_counts": f"""select count(*) as total, count(*) filter (where not {blank('text')}) as valid_text,
        count(*) filter (where not {blank('text')}) as labelled from documents""",
    "self_train_job": f"""with {SPLIT}, {PSEUDO} select (select count(*) from lab) as labelled_total, (select count(*) from labk) as labelled_valid,
        (select count(*) from split) as labelled, (select count(*) from unl) as unlabelled_total, (select count(*) from unl_ready) as unlabelled_valid,
        (select count(*) from unl_ready) as unlabelled, (select count(*) from pseudo) as accepted_1""",
    "ingest_event": """select doc_id, source, lang, 'test_local' as tag, lang || '.csv' as file_name, lang as dataset,
        count(*) over (partition by lang) as record_count, true as has_size from documents""",
    "clean_posts_narrow": f"""with {RAW}, {TYPED}, narrow as (select * from typed
          where {VALID_WHERE} and (user_followers is null or user_followers >= 0) and (user_favourites is null or user_favourites >= 0)
          qualify row_number() over (partition by tweet_ts, text_clean order by post_id) = 1)
        select user_description, user_created_ts, user_followers, user_favourites, tweet_ts, tweet_date, text_raw, text_clean, source, is_retweet from narrow""",
    "dedup_single_key": f"with {RAW}, {TYPED} select tweet_ts, user_created_ts, source from typed where tweet_ts is not null and {COUNTS_WHERE}",
}
