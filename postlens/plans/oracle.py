"""Oracle SQL (DuckDB dialect) for every registered query.

The driver registers only the base tables, so each statement starts with
the adapter views as CTEs.  Window bounds are rebuilt with
``time_bucket`` (origin 1970-01-01) and then filtered to windows that
contain the row, which is Spark's sliding-window rule.
"""

from __future__ import annotations

from ..functions.text import STOP_WORDS, STREAM_STOP_WORDS, TOPIC_A, TOPIC_B, word_pattern
from ..sources.tables import MEDIA_KEY_POOL
from .catalog import FILTER_USERNAME, INTERVAL_SECONDS, LITERAL_COLUMN


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(words) -> str:
    return ", ".join(_lit(w) for w in words)


STOP_SQL = _in_list(STOP_WORDS)
STREAM_STOP_SQL = _in_list(dict.fromkeys(STREAM_STOP_WORDS))

ADAPTER = f"""
posts as (
  select cast(e.event_id as varchar) as tweet_id, e.ts as created_at, d.text as text,
         try_cast(floor(e.value) as int) as retweet_count, cast(e.event_id % 7 as int) as reply_count,
         try_cast(e.props->>'$.k' as int) as like_count, cast(e.event_id % 3 as int) as quote_count,
         'u' || cast(e.user_id as varchar) as author_id,
         case e.event_type
           when 'signup' then null
           when 'error' then []::varchar[]
           when 'view' then ['m' || cast(e.event_id % {MEDIA_KEY_POOL} as varchar)]
           when 'click' then ['m' || cast(e.event_id % {MEDIA_KEY_POOL} as varchar),
                              'm' || cast((e.event_id * 7 + 3) % {MEDIA_KEY_POOL} as varchar)]
           else ['x' || cast(e.event_id as varchar)] end as data_media_keys
  from events e left join documents d on d.doc_id = e.event_id),
users as (
  select 'u' || cast(c_custkey as varchar) as users_id, c_name as username,
         c_mktsegment as description, upper(c_name) as name
  from customer),
media as (
  select 'm' || cast(p_partkey as varchar) as media_key,
         case p_size % 4 when 0 then 'photo' when 1 then 'video' when 2 then 'animated_gif' else 'other' end as media_type
  from part),
pe as (
  select * exclude (data_media_keys, k), k as media_key
  from (select *, unnest(data_media_keys) as k from posts where len(data_media_keys) > 0)),
peo as (
  select * from pe
  union all by name
  select * exclude (data_media_keys), null::varchar as media_key
  from posts where data_media_keys is null or len(data_media_keys) = 0),
media_messages as (
  select x.media_key, m.media_type,
         x.created_at - to_seconds(45 * (cast(x.tweet_id as bigint) % 3)) as media_ts
  from pe x join media m on m.media_key = x.media_key
  union all
  select null, 'photo', created_at - interval 20 second from posts where data_media_keys is null),
user_messages as (
  select u.users_id, u.username, u.description, u.name, p.first_ts - interval 10 second as user_ts
  from users u join (select author_id, min(created_at) as first_ts from posts group by author_id) p
    on p.author_id = u.users_id),
clean_words as (
  select tweet_id, created_at, word from (
    select tweet_id, created_at, lower(translate(w, '.:()@', '')) as word
    from (select tweet_id, created_at, unnest(string_split(text, ' ')) as w from posts))
  where lower(word) not in ({STOP_SQL})),
raw_words as (
  select tweet_id, created_at, w as word
  from (select tweet_id, created_at, unnest(string_split(text, ' ')) as w from posts)
  where lower(w) not in ({STREAM_STOP_SQL}))
"""


def _sliding(src: str, cols: str, time_col: str, length_s: int, slide_s: int) -> str:
    n = -(-length_s // slide_s)
    return f"""(select {cols}, {time_col},
        time_bucket(to_seconds({slide_s}), {time_col}, timestamp '1970-01-01') - to_seconds({slide_s} * i) as window_start
      from {src}, range(0, {n}) r(i)
      where {time_col} is not null)
      where {time_col} >= window_start and {time_col} < window_start + to_seconds({length_s})"""


def _interval_cond(b="b", c="c", bkey="media_key", ckey="media_key", null_safe=False,
                   btime="created_at", ctime="media_ts", upper=INTERVAL_SECONDS) -> str:
    eq = "is not distinct from" if null_safe else "="
    return (f"{b}.{bkey} {eq} {c}.{ckey} and {b}.{btime} >= {c}.{ctime} "
            f"and {b}.{btime} <= {c}.{ctime} + to_seconds({upper})")


_COUNTS = ("count(*) filter (where media_type = 'photo') as photo_count, "
           "count(*) filter (where media_type = 'video') as video_count, "
           "count(*) filter (where media_type = 'animated_gif') as gif_count")

_INTERVAL_COLS = ("b.tweet_id, b.author_id, b.media_key, c.media_key as c_media_key, c.media_type, "
                  "b.created_at, c.media_ts")
_INTERVAL_LEFT_COLS = "b.tweet_id, b.author_id, b.text, b.media_key, c.media_type, b.created_at, c.media_ts"

_PM_FULL = ("(select coalesce(pe.media_key, m.media_key) as media_key, pe.* exclude (media_key), m.media_type "
            "from pe full join media m on pe.media_key = m.media_key)")

#: Users sent 10 s before each of their posts, and the posts that met media and users.
_SENT = f"""
, um as (select u.users_id, u.username, p.created_at - interval 10 second as user_ts
         from users u join posts p on p.author_id = u.users_id),
bc as (select b.tweet_id, b.author_id, b.created_at, b.media_key, c.media_type
       from peo b left join media_messages c on {_interval_cond()}),
bca as (select bc.*, a.username from bc left join um a
        on {_interval_cond('bc', 'a', 'author_id', 'users_id', ctime='user_ts')})"""

_RIGHT_X2 = f"""
, ab as (select b.tweet_id, b.author_id, b.created_at, b.media_key, a.username
         from peo b left join user_messages a
           on {_interval_cond('b', 'a', 'author_id', 'users_id', ctime='user_ts')})
select ab.username, ab.tweet_id, ab.created_at, c.media_key as c_media_key, c.media_type, c.media_ts
from ab right join media_messages c on {_interval_cond('ab', 'c')}"""

BODIES: dict[str, str] = {
    "envelope_scan": """
, d as (select floor(cast(tweet_id as bigint) / 100) as env, min(tweet_id) as first_post_id, count(*) as n_posts
        from posts group by 1),
u as (select env, count(*) as n_users from (
        select distinct floor(cast(p.tweet_id as bigint) / 100) as env, u.username, u.description, u.users_id, u.name
        from posts p join users u on p.author_id = u.users_id) group by env),
m as (select floor(cast(substr(media_key, 2) as bigint) / 100) as env, min(media_key) as first_media_key,
             count(*) as n_media from media group by 1)
select d.first_post_id, m.first_media_key, coalesce(d.n_posts, 0) as n_posts, coalesce(m.n_media, 0) as n_media,
       coalesce(u.n_users, 0) as n_users
from d left join u on d.env = u.env full join m on d.env = m.env""",
    "kafka_decode": """
select tweet_id as key, created_at as record_ts, tweet_id as value_id, author_id as value_author_id from posts""",
    "table_profile": """
select 'posts' as table_name, count(*) as n_rows, 9::bigint as n_columns from posts
union all select 'users', count(*), 4::bigint from users
union all select 'media', count(*), 2::bigint from media
union all select 'media_messages', count(*), 3::bigint from media_messages
union all select 'user_messages', count(*), 5::bigint from user_messages""",
    "kafka_encode_posts": """
select tweet_id as key, tweet_id, created_at, text, retweet_count, reply_count, like_count, quote_count, author_id,
       array_to_string(data_media_keys, ',') as media_keys from posts""",
    "kafka_encode_users": "select users_id as key, users_id, username, description, name from users",
    "kafka_encode_media": "select media_key, media_type from media",
    "kafka_encode_word_counts": "select word, count(*) as count from clean_words group by word",
    "flatten_posts": """
select tweet_id, created_at, text, retweet_count, reply_count, like_count, quote_count, author_id,
       array_to_string(data_media_keys, ',') as media_keys from posts""",
    "flatten_media": "select media_key, media_type from media",
    "flatten_users": """
select distinct u.username, u.description, u.users_id, u.name from users u join posts p on p.author_id = u.users_id""",
    "parse_posts_json": """
select tweet_id, created_at, text, retweet_count, reply_count, like_count, quote_count, author_id,
       array_to_string(data_media_keys, ',') as media_keys, created_at as dataTimestamp from posts""",
    "parse_posts_json_times": """
select tweet_id, case when cast(tweet_id as bigint) % 7 = 4 then date_trunc('day', created_at)
                      when cast(tweet_id as bigint) % 7 in (1, 2, 3) then date_trunc('second', created_at)
                      else created_at end::timestamp as created_at from posts""",
    "parse_users_json": """
select username, description, users_id, name, user_ts as userTimestamp from user_messages""",
    "parse_media_json": "select media_key, media_type, media_ts as mediaTimestamp from media_messages",
    "explode_media_inner": "select tweet_id, media_key from pe",
    "explode_media_outer": "select tweet_id, media_key from peo",
    "cast_posts": "select tweet_id, created_at, retweet_count, like_count, null::int as bad_int from posts",
    "all_columns": f"""
select pm.tweet_id, pm.created_at, u.username, pm.text, pm.retweet_count, pm.reply_count, pm.like_count,
       pm.quote_count, pm.media_key, pm.media_type, pm.author_id, u.name, u.description
from {_PM_FULL} pm full join users u on pm.author_id = u.users_id""",
    "literal_column": f"""
select text, like_count, author_id, {_lit(LITERAL_COLUMN[1])} as {LITERAL_COLUMN[0]} from posts""",
    "posts_with_date": "select tweet_id, created_at, cast(created_at as date) as created_date from posts",
    "topic_mentions_a": f"""
select u.username, count(*) as count from posts p left join users u on p.author_id = u.users_id
where regexp_matches(p.text, {_lit(TOPIC_A)}) group by u.username""",
    "topic_mentions_b": f"""
select u.username, count(*) as count from posts p left join users u on p.author_id = u.users_id
where regexp_matches(p.text, {_lit(TOPIC_B)}) group by u.username""",
    "topic_mentions_word_bounded": f"""
select u.username, count(*) as count from posts p left join users u on p.author_id = u.users_id
where regexp_matches(p.text, {_lit(word_pattern('the'))}) group by u.username""",
    "stopword_filter": f"""
select tweet_id, count(*) as n_words,
       count(*) filter (where not (lower(w) in ({STOP_SQL}))) as n_kept,
       count(*) filter (where lower(w) in ({STOP_SQL})) as n_stop
from (select tweet_id, unnest(string_split(text, ' ')) as w from posts) group by tweet_id""",
    "filter_equals": f"""
select p.tweet_id, p.author_id, u.users_id, u.username, p.like_count
from posts p full join users u on p.author_id = u.users_id where u.username = {_lit(FILTER_USERNAME)}""",
    "null_key_split": """
select b.tweet_id, b.media_key, m.media_type from peo b left join media m on b.media_key = m.media_key""",
    "join_null_safe": f"""
select {_INTERVAL_COLS} from peo b join media_messages c on {_interval_cond(null_safe=True)}""",
    "join_media_full_outer": """
select coalesce(pe.media_key, m.media_key) as media_key, pe.tweet_id, m.media_type
from pe full join media m on pe.media_key = m.media_key""",
    "join_users_full_outer": """
select p.tweet_id, p.created_at, p.author_id, u.users_id, u.username, u.name, p.like_count
from posts p full join users u on p.author_id = u.users_id""",
    "join_three_way_full_outer": f"""
select pm.tweet_id, pm.media_key, pm.media_type, pm.author_id, u.users_id, u.username
from {_PM_FULL} pm full join users u on pm.author_id = u.users_id""",
    "join_media_left_outer": """
select b.tweet_id, b.created_at, b.media_key, m.media_type from peo b left join media m on b.media_key = m.media_key""",
    "interval_join_inner": f"""
select b.tweet_id, b.author_id, u.username, b.media_key, c.media_type, b.created_at, c.media_ts
from peo b join users u on b.author_id = u.users_id join media_messages c on {_interval_cond()}""",
    "interval_join_left": f"""
select {_INTERVAL_LEFT_COLS} from peo b left join media_messages c on {_interval_cond()}""",
    "interval_join_left_nullsafe": f"""
select {_INTERVAL_LEFT_COLS} from peo b left join media_messages c on {_interval_cond(null_safe=True)}""",
    "interval_join_right_outer": f"""
select {_INTERVAL_COLS} from peo b right join media_messages c on {_interval_cond()}""",
    "interval_join_full_outer": f"""
select {_INTERVAL_COLS} from peo b full join media_messages c on {_interval_cond()}""",
    "interval_join_right_x2": _RIGHT_X2,
    "interval_join_window_count": f"""
, r as (select b.text, b.created_at from peo b left join media_messages c on {_interval_cond(null_safe=True)})
select text, count(*) as count, window_start, window_start + to_seconds(20) as window_end
from {_sliding('r', 'text', 'created_at', 20, 5)}
group by text, window_start""",
    "media_counts_by_post": f"""
select pe.tweet_id, {_COUNTS} from pe full join media m on pe.media_key = m.media_key group by pe.tweet_id""",
    "media_counts_by_post_user": f"""
select pe.tweet_id, u.username, pe.text, {_COUNTS}
from pe full join media m on pe.media_key = m.media_key full join users u on pe.author_id = u.users_id
group by pe.tweet_id, u.username, pe.text""",
    "media_counts_by_user": f"""
select u.username, {_COUNTS}
from pe full join media m on pe.media_key = m.media_key full join users u on pe.author_id = u.users_id
group by u.username""",
    "media_counts_windowed": f"""
, mc as (select media_key, media_type, count(*) as n from media_messages where media_key is not null group by all),
bk as (select b.created_at, b.author_id, mc.media_type, coalesce(mc.n, 1) as n
       from peo b left join mc on b.media_key = mc.media_key),
bku as (select bk.created_at, bk.media_type, bk.n, u.username from bk left join users u on bk.author_id = u.users_id)
select username, coalesce(sum(n) filter (where media_type = 'photo'), 0)::bigint as photo_count,
       coalesce(sum(n) filter (where media_type = 'video'), 0)::bigint as video_count,
       coalesce(sum(n) filter (where media_type = 'animated_gif'), 0)::bigint as gif_count,
       window_start, window_start + to_seconds(300) as window_end
from {_sliding('bku', 'username, media_type, n', 'created_at', 300, 120)}
group by username, window_start""",
    "media_counts_windowed_bounded": f"""
, bc as (select b.created_at, b.author_id, c.media_type from peo b left join media_messages c on {_interval_cond()}),
bcu as (select bc.created_at, bc.media_type, u.username from bc left join users u on bc.author_id = u.users_id)
select username, {_COUNTS}, window_start, window_start + to_seconds(300) as window_end
from {_sliding('bcu', 'username, media_type', 'created_at', 300, 120)}
group by username, window_start""",
    "interaction_totals": """
select p.author_id, u.username, sum(p.retweet_count)::bigint as sum_retweet_count,
       sum(p.reply_count)::bigint as sum_reply_count, sum(p.like_count)::bigint as sum_like_count,
       sum(p.quote_count)::bigint as sum_quote_count
from posts p full join users u on p.author_id = u.users_id group by p.author_id, u.username""",
    "likes_by_author": """
select author_id, sum(like_count)::bigint as sum_like_count, round(avg(like_count), 6) as avg_like_count
from posts group by author_id""",
    "likes_total": "select sum(like_count)::bigint as sum_like_count from posts",
    "posts_by_time": """
select row_number() over (order by p.created_at nulls first, p.tweet_id nulls first, u.users_id nulls first,
                          u.description nulls first) as position,
       p.tweet_id, p.created_at, u.username, p.text, p.retweet_count, p.reply_count, p.like_count, p.quote_count
from posts p full join users u on p.author_id = u.users_id""",
    "posts_per_day": "select cast(created_at as date) as day, count(*) as n_posts from posts group by 1",
    "top_words": """
select word, count(*) as count from clean_words group by word order by count desc, word asc limit 10""",
    "word_tokens_clean": "select tweet_id, count(*) as n_words from clean_words group by tweet_id",
    "word_tokens_raw": "select tweet_id, count(*) as n_words from raw_words group by tweet_id",
    "word_frequency": "select word, count(*) as count from clean_words group by word",
    "word_count_per_media_rows": f"""
select w as word, count(*) as count from (select unnest(string_split(text, ' ')) as w from peo)
where lower(w) not in ({STREAM_STOP_SQL}) group by w""",
    "word_count_sliding": f"""
select word, count(*) as count, window_start, window_start + to_seconds(25) as window_end
from {_sliding('raw_words', 'word', 'created_at', 25, 5)} group by word, window_start""",
    "word_count_sliding_clean": f"""
select word, count(*) as count, window_start, window_start + to_seconds(25) as window_end
from {_sliding('clean_words', 'word', 'created_at', 25, 5)} group by word, window_start""",
    "word_count_two_level": f"""
, lvl1 as (select word, count(*) as cnt, window_start + to_seconds(25) - interval 1 microsecond as wt
            from {_sliding('clean_words', 'word', 'created_at', 25, 5)} group by word, window_start)
select word, sum(cnt)::bigint as count, window_start, window_start + to_seconds(60) as window_end
from {_sliding('lvl1', 'word, cnt', 'wt', 60, 30)} group by word, window_start""",
    # streams: the batch meaning of each streaming job
    "stream_ingest_posts": """
select tweet_id, created_at, text, like_count, author_id, media_key, created_at as dataTimestamp from peo""",
    "stream_ingest_media": "select media_key, media_type, media_ts as mediaTimestamp from media_messages",
    "stream_distinct_users": """
select distinct u.username, u.description, u.users_id, u.name from users u join posts p on p.author_id = u.users_id""",
    "stream_join_users": """
select distinct u.username, p.text, p.retweet_count, p.reply_count, p.like_count, p.quote_count, p.created_at
from posts p join user_messages u on p.author_id = u.users_id""",
    "stream_distinct_users_files": """
select distinct u.username, u.description, u.users_id, u.name from users u join posts p on p.author_id = u.users_id""",
    "stream_join_users_salted": """
select distinct u.username, p.text, p.retweet_count, p.reply_count, p.like_count, p.quote_count, p.created_at
from posts p join user_messages u on p.author_id = u.users_id""",
    "stream_join_users_media": f"""
select distinct b.text, u.username, c.media_key
from peo b join user_messages u on b.author_id = u.users_id
left join media_messages c on {_interval_cond(null_safe=True)}""",
    "stream_full_outer": f"""{_SENT}
select tweet_id, created_at, media_key, media_type, username from bca
union all
select null, null, c.media_key, c.media_type, null from media_messages c
where not exists (select 1 from pe b where {_interval_cond()})
union all
select null, null, null, null, a.username from um a
where not exists (select 1 from posts b where {_interval_cond('b', 'a', 'author_id', 'users_id', ctime='user_ts')})""",
    "stream_media_counts_full_outer": f"""{_SENT}
select username, {_COUNTS}, window_start, window_start + to_seconds(300) as window_end
from {_sliding('bca', 'username, media_type', 'created_at', 300, 120)}
group by username, window_start""",
    "stream_right_outer_x2": _RIGHT_X2,
    "stream_word_count_sliding_clean": f"""
select word, count(*) as count, window_start, window_start + to_seconds(25) as window_end
from {_sliding('clean_words', 'word', 'created_at', 25, 5)} group by word, window_start""",
    "stream_word_count_sliding": f"""
select word, count(*) as count, window_start, window_start + to_seconds(25) as window_end
from {_sliding('raw_words', 'word', 'created_at', 25, 5)} group by word, window_start""",
}


def oracle_sql() -> dict[str, str]:
    """Query name -> full DuckDB statement (adapter CTEs + body)."""
    head = "with " + ADAPTER.strip() + "\n"
    return {name: head + body.strip() for name, body in BODIES.items()}
