"""For each query of the catalogue, the same result in plain SQL (DuckDB)."""

from __future__ import annotations

HOUR, DAY, WEEK = 3600, 86_400, 604_800
AS_OF = 1_706_659_200

EV = """ev AS (
  SELECT event_id, event_type AS event_name, CAST(user_id AS VARCHAR) AS user_id,
         CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 20 AS VARCHAR) AS creator_id,
         regexp_extract(props, '([0-9]+)', 1) AS media_id,
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS event_ts, value, event_type || ' ' || props AS line
  FROM events)"""


def _words(table: str, column: str, extra: str = "") -> str:
    return f"SELECT {extra}unnest(regexp_split_to_array(lower({column}), '\\W+')) AS word FROM {table}"


def _windows(keys: str, size: int, source: str = "ev", name: str = "w") -> str:
    return f"""{name} AS (
  SELECT {keys}, event_ts // {size} * {size} AS window_start, event_ts // {size} * {size} + {size} AS window_end,
         count(*) AS n, min(event_ts) AS event_ts
  FROM {source} GROUP BY {keys}, event_ts // {size} * {size})"""


def _word_windows(size: int) -> str:
    return f"""w AS (
  SELECT word, event_ts // {size} * {size} AS window_start, event_ts // {size} * {size} + {size} AS window_end,
         count(*) AS n
  FROM ({_words('ev', 'line', 'event_ts, ')}) WHERE word <> '' GROUP BY word, event_ts // {size} * {size})"""


def _intervals(ds: list[int]) -> str:
    return f"(SELECT CAST(unnest({ds}) AS BIGINT) AS d)"


def _final(keys: str, ds: list[int], source: str, amount: str = "n", name: str = "c") -> str:
    on = " AND ".join(f"s.{k.strip()} = m.{k.strip()}" for k in keys.split(","))
    out = ", ".join(f"s.{k.strip()}" for k in keys.split(","))
    return f"""{name} AS (
  SELECT {out}, d AS decay_interval, m.t AS last_update,
         sum(s.{amount} * exp(-CAST(m.t - s.event_ts AS DOUBLE) / d)) AS value
  FROM {source} s JOIN (SELECT {keys}, max(event_ts) AS t FROM {source} GROUP BY {keys}) m ON {on},
       {_intervals(ds)}
  GROUP BY {out}, d, m.t)"""


def _running(key: str, ds: list[int], source: str = "w", life: str = "") -> str:
    """One row per window close: a sum over all earlier windows of the key."""
    same = f" AND a.{life} = b.{life}" if life else ""
    part = f", {life}" if life else ""
    return f"""SELECT a.event_name, a.{key}, a.window_start, a.window_end, d AS decay_interval,
       max(a.t) AS last_update, round(sum(b.n * exp(-CAST(a.t - b.event_ts AS DOUBLE) / d)), 6) AS value
FROM (SELECT *, max(event_ts) OVER (PARTITION BY event_name, {key}{part} ORDER BY window_start) AS t FROM {source}) a
JOIN {source} b ON a.event_name = b.event_name AND a.{key} = b.{key} AND b.window_start <= a.window_start{same},
     {_intervals(ds)}
GROUP BY a.event_name, a.{key}, a.window_start, a.window_end, d"""


def _lives(ttl: int) -> str:
    return f"""l AS (
  SELECT *, sum(CASE WHEN window_end - prev >= {ttl} THEN 1 ELSE 0 END)
              OVER (PARTITION BY event_name, user_id ORDER BY window_start) AS life
  FROM (SELECT *, lag(window_end) OVER (PARTITION BY event_name, user_id ORDER BY window_start) AS prev FROM w))"""


LATE = "late AS (SELECT * REPLACE (event_ts - CAST(floor(value * 100) AS BIGINT) AS event_ts), event_ts AS arrived FROM ev)"
LATE_WINDOWS = """w AS (
  SELECT event_name, media_id, arrived // 3600 * 3600 AS window_start, arrived // 3600 * 3600 + 3600 AS window_end,
         count(*) AS n, min(event_ts) AS event_ts
  FROM late GROUP BY event_name, media_id, arrived // 3600 * 3600)"""

WRITTEN = f"""r AS (
  SELECT window_start // 86400 * 86400 AS batch, user_id AS key, event_name AS feature_name, window_end,
         CAST(sum(n) OVER (PARTITION BY event_name, user_id ORDER BY window_start) AS BIGINT) AS total
  FROM w)"""

MEDIA_FINAL = f"WITH {EV}, {_windows('event_name, media_id', 5)}, {_final('event_name, media_id', [HOUR, DAY, WEEK], 'w')}"
SCORES = f"{MEDIA_FINAL}, s AS (SELECT media_id, value AS score, last_update FROM c WHERE event_name = 'view' AND decay_interval = {DAY})"
RANKED = f"""{SCORES}
SELECT 'TopViews' AS name, CAST(row_number() OVER (ORDER BY score DESC, media_id) AS INTEGER) AS rank, media_id,
       round(score, 6) AS score
FROM s ORDER BY rank LIMIT 20"""


def _faded(interval: int, name: str) -> str:
    return f"""SELECT '{name}' AS name, CAST(row_number() OVER (ORDER BY v DESC, media_id) AS INTEGER) AS rank,
       media_id, round(ln(v), 6) AS log_score
FROM (SELECT media_id, value * exp(-CAST({AS_OF} - last_update AS DOUBLE) / {interval}) AS v
      FROM c WHERE event_name = 'view' AND decay_interval = {interval})
ORDER BY rank LIMIT 20"""


def _counts_of(name: str) -> str:
    return f"count(*) FILTER (event_name = '{name}')"


def _missing(keys: str, within: int, closed: str = "") -> str:
    on = " AND ".join(f"p.{k.strip()} = v.{k.strip()}" for k in keys.split(","))
    return f"""WITH {EV}
SELECT {keys}, event_ts AS second, count(*) AS n FROM ev v
WHERE event_name = 'view' {closed} AND NOT EXISTS (
  SELECT 1 FROM ev p WHERE p.event_name = 'purchase' AND {on}
    AND p.event_ts BETWEEN v.event_ts AND v.event_ts + {within})
GROUP BY {keys}, event_ts"""


def _matrix() -> str:
    columns = []
    for name in ("view", "purchase"):
        columns.append(f"{_counts_of(name)} AS {name}_total")
        columns.append(f"count(DISTINCT user_id) FILTER (event_name = '{name}') AS {name}_users")
        for d in (DAY, WEEK):
            columns.append(
                f"round(coalesce(sum(exp(-CAST({AS_OF} - event_ts AS DOUBLE) / {d})) FILTER (event_name = '{name}'), 0.0), 6)"
                f" AS {name}_{d}s"
            )
    body = ", ".join(columns)
    parts = [
        f"SELECT '{f}' AS family, {c} AS key, {body} FROM ev WHERE event_name IN ('view', 'purchase') GROUP BY {c}"
        for f, c in (("user", "user_id"), ("media", "media_id"))
    ]
    return f"WITH {EV} " + " UNION ALL ".join(parts)


def _families() -> str:
    keys = {
        "user": "user_id",
        "media": "media_id",
        "creator": "creator_id",
        "user_media": "user_id || '|' || media_id",
        "user_creator": "user_id || '|' || creator_id",
    }
    return f"WITH {EV} " + " UNION ALL ".join(
        f"SELECT '{f}' AS family, {k} AS key, event_name, count(*) AS n, max(event_ts) AS last_ts FROM ev GROUP BY {k}, event_name"
        for f, k in keys.items()
    )


def _family_counters() -> str:
    fanned = "f AS (SELECT 'user' AS family, user_id AS key, event_name, event_ts, 1 AS n FROM ev UNION ALL SELECT 'creator', creator_id, event_name, event_ts, 1 FROM ev)"
    keys = "family, key, event_name"
    return f"WITH {EV}, {fanned}, {_final(keys, [HOUR, DAY, WEEK], 'f')} SELECT {keys}, decay_interval, last_update, round(value, 6) AS value FROM c"


def _feature_counters() -> str:
    parts = " UNION ALL ".join(
        f"SELECT event_name || '/{f}' AS feature_name, {k} AS key, event_ts, 1 AS n FROM ev"
        for f, k in (("media", "media_id"), ("user_creator", "user_id || '|' || creator_id"))
    )
    keys = "feature_name, key"
    final = _final(keys, [HOUR, DAY, WEEK], "f")
    return f"WITH {EV}, f AS ({parts}), {final} SELECT {keys}, decay_interval, last_update, round(value, 6) AS value FROM c"


MARKED = """clocked AS (
  SELECT *, max(event_ts) OVER (ORDER BY arrived, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock FROM late),
marked AS (
  SELECT delay, event_id, event_name, event_ts, event_ts // 3600 * 3600 AS window_start,
         coalesce(event_ts // 3600 * 3600 + 3600 <= clock - delay, false) AS is_late
  FROM clocked, (SELECT unnest([0, 3600]) AS delay))"""
LATE_COUNTED = """SELECT delay, event_name, window_start, count(*) FILTER (NOT is_late) AS n, count(*) FILTER (is_late) AS n_late
FROM marked GROUP BY delay, event_name, window_start"""

SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
DROP_EMPTY = f"SELECT word, count(*) AS n FROM ({_words('documents', 'text')}) WHERE word <> '' GROUP BY word"
LIFETIME = """SELECT {keys}, window_start, window_end, n,
       CAST(sum(n) OVER (PARTITION BY {keys} ORDER BY window_start) AS BIGINT) AS total FROM w"""
EV1 = "e AS (SELECT *, 1 AS n FROM ev)"
MEDIA_EACH = f"WITH {EV}, {EV1}, {_final('event_name, media_id', [HOUR, DAY, WEEK], 'e')}"

def _creator_affinity(posts: str) -> str:
    return f"""WITH {EV},
{posts},
likes AS (SELECT user_id, creator_id, count(*) AS affinity FROM ev GROUP BY user_id, creator_id),
t AS (
  SELECT l.user_id, p.media_id, l.creator_id, l.affinity, p.views, row_number() OVER (
           PARTITION BY l.user_id
           ORDER BY l.affinity DESC, p.views DESC, md5(p.media_id)[1:3], p.media_id) AS rank
  FROM likes l JOIN posts p USING (creator_id)
  WHERE NOT EXISTS (SELECT 1 FROM ev s WHERE s.user_id = l.user_id AND s.media_id = p.media_id))
SELECT user_id, CAST(rank AS INTEGER) AS rank, media_id, creator_id, affinity, views FROM t WHERE rank <= 5"""


SEEN_POSTS = f"posts AS (SELECT creator_id, media_id, {_counts_of('view')} AS views FROM ev GROUP BY creator_id, media_id)"
ALL_POSTS = f"""viewed AS (SELECT media_id, {_counts_of('view')} AS views FROM ev GROUP BY media_id),
posts AS (
  SELECT CAST(vec_id % 20 AS VARCHAR) AS creator_id, CAST(vec_id AS VARCHAR) AS media_id, coalesce(views, 0) AS views
  FROM embeddings LEFT JOIN viewed ON viewed.media_id = CAST(vec_id AS VARCHAR))"""

KNN = f"""WITH {EV},
u AS (
  SELECT user_id, i, sum(x) / count(*) AS x
  FROM (SELECT ev.user_id, unnest(range(1, 65)) AS i, CAST(unnest(e.embedding) AS DOUBLE) AS x
        FROM ev JOIN embeddings e ON CAST(e.vec_id AS VARCHAR) = ev.media_id WHERE event_name = 'view')
  GROUP BY user_id, i),
q AS (SELECT user_id, list(x ORDER BY i) AS v FROM u GROUP BY user_id),
s AS (SELECT user_id, CAST(vec_id AS VARCHAR) AS media_id,
             list_cosine_similarity(v, CAST(embedding AS DOUBLE[])) AS score FROM q, embeddings),
t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(score, 12) DESC, media_id) AS rank FROM s)
SELECT user_id, CAST(rank AS INTEGER) AS rank, media_id, round(score, 6) AS score FROM t WHERE rank <= 5"""

BEST_RATIOS = f"""WITH {EV}, x AS (
  SELECT media_id, {_counts_of('purchase')} AS part, {_counts_of('view')} AS whole FROM ev GROUP BY media_id)
SELECT media_id, part, whole, round(part / whole, 6) AS ratio FROM x WHERE whole >= 15
ORDER BY part / whole DESC, media_id LIMIT 20"""

STREAM_LIST = f"""WITH {EV}, {_windows('event_name, media_id', HOUR)}, {_final('event_name, media_id', [DAY], 'w')}
SELECT 'TopViews' AS name, CAST(row_number() OVER (ORDER BY value DESC, media_id) AS INTEGER) AS rank, media_id,
       round(value, 6) AS score
FROM c WHERE event_name = 'view' ORDER BY rank LIMIT 20"""

FEW_VIEWS = f"""WITH {EV},
v AS (SELECT media_id, count(*) FILTER (event_name = 'view') AS n FROM ev GROUP BY media_id),
p AS (SELECT DISTINCT CAST(vec_id AS VARCHAR) AS media_id FROM embeddings)
SELECT media_id, CAST(coalesce(n, 0) AS BIGINT) AS views FROM p LEFT JOIN v USING (media_id)
WHERE coalesce(n, 0) < 10 ORDER BY md5(media_id || '0'), media_id LIMIT 20"""

TEN_DAYS = f"event_ts >= {AS_OF - 15 * DAY} AND event_ts < {AS_OF - 5 * DAY}"
UNIQUE_USERS = f"""WITH {EV} SELECT event_name, media_id, count(DISTINCT user_id) AS users
FROM ev WHERE {TEN_DAYS} GROUP BY event_name, media_id"""


def _sweep() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS family, {c} AS key, event_name, event_ts FROM ev" for f, c in (("creator", "creator_id"), ("media", "media_id"))
    )
    return f"""WITH {EV}, f AS ({parts}),
p AS (SELECT kind, unnest(range(14400, 14400 * 126, 14400)) AS s FROM (SELECT unnest(['count', 'faded']) AS kind))
SELECT family, key, event_name || '_' || kind || '_' || s AS counter,
       round(sum(CASE WHEN kind = 'faded' THEN exp(-CAST({AS_OF} - event_ts AS DOUBLE) / s) ELSE 1.0 END), 6) AS value
FROM f, p WHERE event_name IN ('view', 'click', 'purchase', 'signup') AND event_ts <= {AS_OF}
  AND (kind = 'faded' OR {AS_OF} - event_ts < s)
GROUP BY family, key, event_name, kind, s"""


SQL: dict[str, str] = {
    "tokens_keep_empty": f"SELECT word, count(*) AS n FROM ({_words('documents', 'text')}) GROUP BY word",
    "tokens_drop_empty": DROP_EMPTY,
    "tokens_whitespace": f"""SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '{SPACES}')) AS word FROM documents) WHERE word <> '' GROUP BY word""",
    "conversation_words": f"""SELECT role, word, count(*) AS n
FROM ({_words('conversations', 'text', 'role, ')}) WHERE word <> '' GROUP BY role, word""",
    "word_window_count": f"WITH {EV}, {_word_windows(HOUR)} SELECT * FROM w",
    "word_lifetime_count": f"WITH {EV}, {_word_windows(5)} {LIFETIME.format(keys='word')}",
    "word_record_totals": f"""WITH {EV},
t AS (SELECT event_id, event_ts, regexp_split_to_array(lower(line), '\\W+') AS a FROM ev),
x AS (SELECT event_id, event_ts, unnest(list_filter(a, lambda z: z <> '')) AS word,
             unnest(range(len(list_filter(a, lambda z: z <> '')))) AS position FROM t)
SELECT word, event_id, CAST(position AS INTEGER) AS position,
       CAST(count(*) OVER (PARTITION BY word ORDER BY event_ts, event_id, position) AS BIGINT) AS total FROM x""",
    "word_store_items": DROP_EMPTY,
    "event_decode_filter": f"""WITH {EV} SELECT event_id, event_name, user_id, creator_id, media_id, event_ts,
       CAST(1 AS BIGINT) AS event_count FROM ev WHERE event_name IN ('view', 'purchase')""",
    "event_base64_decode": f"WITH {EV} SELECT event_id, event_name, user_id, media_id, event_ts FROM ev",
    "bad_record_drop": f"WITH {EV} SELECT event_name, count(*) AS n, max(event_ts) AS last_ts FROM ev GROUP BY event_name",
    "bad_record_quarantine": "SELECT text AS raw, count(*) AS n FROM conversations GROUP BY text",
    "window_count_5s": f"WITH {EV}, {_windows('event_name, user_id', 5)} SELECT * FROM w",
    "window_count_1h": f"WITH {EV}, {_windows('event_name, user_id', HOUR)} SELECT * FROM w",
    "window_count_media_1h": f"WITH {EV}, {_windows('event_name, media_id', HOUR)} SELECT * FROM w",
    "window_count_arrival": f"""WITH {EV}, {LATE}
SELECT event_name, media_id, arrived // 86400 * 86400 AS window_start, arrived // 86400 * 86400 + 86400 AS window_end,
       count(*) AS n, arg_min(event_ts, event_id) AS event_ts
FROM late GROUP BY event_name, media_id, arrived // 86400 * 86400""",
    "late_dropped": f"WITH {EV}, {LATE}, {MARKED} SELECT delay, event_id, event_ts FROM marked WHERE is_late",
    "late_counted": f"WITH {EV}, {LATE}, {MARKED} {LATE_COUNTED}",
    "stream_late_rows": f"""WITH {EV}, {LATE}, {MARKED}
SELECT event_id, event_ts, window_start FROM marked WHERE is_late AND delay = 3600""",
    "stream_late_counts": f"""WITH {EV}, {LATE}, {MARKED}
SELECT event_name, window_start, count(*) AS n FROM marked WHERE NOT is_late AND delay = 0 GROUP BY event_name, window_start""",
    "sliding_count": f"""WITH {EV},
x AS (SELECT event_name, event_ts // 300 * 300 - unnest(range(0, 3600, 300)) AS window_start FROM ev)
SELECT event_name, window_start, window_start + 3600 AS window_end, count(*) AS n FROM x GROUP BY event_name, window_start""",
    "lifetime_count": f"WITH {EV}, {_windows('event_name, user_id', 5)} {LIFETIME.format(keys='event_name, user_id')}",
    "few_views_of_catalogue": FEW_VIEWS,
    "lifetime_null_keys": f"""WITH {EV},
nulled AS (SELECT * REPLACE (nullif(CASE WHEN CAST(user_id AS BIGINT) % 7 = 0 THEN '' ELSE user_id END, '') AS user_id) FROM ev),
{_windows('event_name, user_id', 5, 'nulled')} {LIFETIME.format(keys='event_name, user_id')}""",
    "upsert_restart": f"WITH {EV} SELECT event_name, CAST(2 * count(*) AS BIGINT) AS n FROM ev GROUP BY event_name",
    "topk_falling_scores": f"""WITH {EV},
p AS (SELECT media_id, CAST(floor(({AS_OF} - event_ts) / {10 * DAY}) AS BIGINT) AS period, count(*) AS n
      FROM ev WHERE event_name = 'view' GROUP BY ALL),
l AS (SELECT media_id, CAST(arg_min(n, period) AS DOUBLE) AS score FROM p GROUP BY media_id)
SELECT 'TopViews' AS name, CAST(row_number() OVER (ORDER BY score DESC, media_id) AS INTEGER) AS rank, media_id, score
FROM l ORDER BY rank LIMIT 3""",
    "state_ttl_lifetime": f"""WITH {EV}, {_windows('event_name, user_id', 5)}, {_lives(2 * DAY)}
SELECT event_name, user_id, CAST(life AS BIGINT) AS life, window_start, window_end, n,
       CAST(sum(n) OVER (PARTITION BY event_name, user_id, life ORDER BY window_start) AS BIGINT) AS total FROM l""",
    "state_ttl_as_of": f"""WITH {EV}, {_windows('event_name, user_id', 5)}, {_lives(2 * DAY)},
h AS (SELECT event_name, user_id, life, CAST(sum(n) AS BIGINT) AS total, max(window_end) AS written,
             max(life) OVER (PARTITION BY event_name, user_id) AS newest FROM l GROUP BY event_name, user_id, life)
SELECT event_name, user_id, total, written FROM h WHERE life = newest AND written + {2 * DAY} > {AS_OF}""",
    "decay_final": f"""WITH {EV}, {_windows('event_name, user_id', 5)}, {_final('event_name, user_id', [5, 10, 15], 'w')}
SELECT event_name, user_id, decay_interval, last_update, round(value, 6) AS value FROM c""",
    "decay_final_long": f"{MEDIA_EACH} SELECT event_name, media_id, decay_interval, last_update, round(value, 6) AS value FROM c",
    "decay_as_of": f"""WITH {EV} SELECT event_name, media_id, d AS decay_interval, CAST({AS_OF} AS BIGINT) AS last_update,
       round(sum(exp(-CAST({AS_OF} - event_ts AS DOUBLE) / d)), 6) AS value
FROM ev, {_intervals([HOUR, DAY, WEEK])} GROUP BY event_name, media_id, d""",
    "decay_running": f"WITH {EV}, {_windows('event_name, user_id', 5)} {_running('user_id', [HOUR, DAY, WEEK])}",
    "decay_running_short": f"WITH {EV}, {_windows('event_name, media_id', HOUR)} {_running('media_id', [5, 600, HOUR])}",
    "decay_running_late": f"WITH {EV}, {LATE}, {LATE_WINDOWS} {_running('media_id', [HOUR, DAY, WEEK])}",
    "decay_merge_two_sides": f"{MEDIA_EACH} SELECT event_name, media_id, decay_interval, last_update, round(value, 6) AS value FROM c",
    "counter_store_items": f"{MEDIA_FINAL} SELECT media_id AS key, event_name AS feature_name, decay_interval, last_update, round(value, 6) AS value FROM c",
    "item_dedup_composite": f"""WITH {EV}, {_windows('event_name, user_id', HOUR)}, {WRITTEN}
SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY batch, key, feature_name ORDER BY window_end DESC) = 1""",
    "item_dedup_partition_key": f"""WITH {EV}, {_windows('event_name, user_id', HOUR)}, {WRITTEN}
SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY batch, key ORDER BY window_end DESC, feature_name DESC) = 1""",
    "upsert_replay": f"""WITH {EV}, {_windows('event_name, user_id', HOUR)}, {WRITTEN}
SELECT key, feature_name, window_end, total FROM r
QUALIFY row_number() OVER (PARTITION BY key, feature_name ORDER BY window_end DESC) = 1""",
    "topk_candidates": f"{SCORES} SELECT media_id, round(score, 6) AS score, last_update FROM s ORDER BY s.score DESC, media_id LIMIT 20",
    "topk_ranked_list": RANKED,
    "topk_store_items": RANKED,
    "topk_as_of": f"""{MEDIA_FINAL}, f AS (
  SELECT media_id, value * exp(-CAST({AS_OF} - last_update AS DOUBLE) / {DAY}) AS v, last_update
  FROM c WHERE event_name = 'view' AND decay_interval = {DAY})
SELECT media_id, round(v, 6) AS score, last_update FROM f ORDER BY v DESC, media_id LIMIT 20""",
    "topk_fresh_and_overall": f"{MEDIA_FINAL} (({_faded(HOUR, 'fresh')}) UNION ALL ({_faded(WEEK, 'overall')}))",
    "ratio_topk_min_views": BEST_RATIOS,
    "min_views_candidates": f"""WITH {EV}, x AS (SELECT media_id, {_counts_of('view')} AS views FROM ev GROUP BY media_id)
SELECT media_id, views FROM x WHERE views < 100 ORDER BY md5(media_id || '0'), media_id LIMIT 20""",
    "creator_affinity": _creator_affinity(SEEN_POSTS),
    "knn_candidates": KNN,
    "knn_indexed": KNN,
    "key_families": _families(),
    "family_counters": _family_counters(),
    "feature_matrix": _matrix(),
    "ctr_ratio": f"""WITH {EV}, x AS (
  SELECT media_id, {_counts_of('click')} AS part, {_counts_of('view')} AS whole
  FROM ev WHERE event_name IN ('click', 'view') GROUP BY media_id)
SELECT media_id, part, whole, round(part / nullif(whole, 0), 6) AS ratio FROM x""",
    "counter_ratio": f"""{MEDIA_FINAL}, f AS (
  SELECT media_id AS key, event_name, value * exp(-CAST({AS_OF} - last_update AS DOUBLE) / {WEEK}) AS v
  FROM c WHERE decay_interval = {WEEK})
SELECT key, round(sum(v) FILTER (event_name = 'click') / nullif(sum(v) FILTER (event_name = 'view'), 0), 6) AS ratio
FROM f GROUP BY key""",
    "unique_users": f"WITH {EV} SELECT media_id, event_name, count(DISTINCT user_id) AS users FROM ev GROUP BY media_id, event_name",
    "unique_users_merged": UNIQUE_USERS,
    "stream_unique_users": UNIQUE_USERS,
    "users_of_both": f"""WITH {EV}, x AS (
  SELECT media_id, user_id, {_counts_of('view')} > 0 AND {_counts_of('purchase')} > 0 AS did_both
  FROM ev WHERE event_name IN ('view', 'purchase') AND {TEN_DAYS} GROUP BY media_id, user_id)
SELECT media_id, count(*) FILTER (did_both) AS users FROM x GROUP BY media_id""",
    "feature_sweep": _sweep(),
    "item_expiry": f"""WITH {EV}, {_windows('event_name, user_id', DAY)},
t AS ({LIFETIME.format(keys='event_name, user_id')})
SELECT user_id AS word, window_end + {WEEK} AS expires, total FROM t
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY window_end DESC, event_name DESC) = 1""",
    "window_count_fixed_unit": f"""WITH {EV}
SELECT event_name, event_ts // 86400 * 86400 AS window_start, event_ts // 86400 * 86400 + 86400 AS window_end,
       2 * count(*) AS n, max(event_ts) AS event_ts FROM ev GROUP BY event_name, event_ts // 86400""",
    "category_families": f"""WITH {EV},
c AS (SELECT ev.*, coalesce(p_brand, '') AS category FROM ev LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = media_id)
SELECT 'category' AS family, category AS key, event_name, count(*) AS n, max(event_ts) AS last_ts FROM c GROUP BY category, event_name
UNION ALL
SELECT 'user_category', user_id || '|' || category, event_name, count(*), max(event_ts) FROM c GROUP BY user_id, category, event_name""",
    "stream_delayed_windows": f"""WITH {EV}, {LATE}, {_windows('event_name', HOUR, 'late')} SELECT * FROM w""",
    "stream_restarted": f"""WITH {EV}, {_windows('event_name, user_id', HOUR)}
SELECT * FROM ({LIFETIME.format(keys='event_name, user_id')}) WHERE window_end <= (SELECT max(event_ts) FROM ev)""",
    "stream_improvements": f"""WITH {EV},
x AS (SELECT media_id, count(*) + (CAST(media_id AS BIGINT) + 1) / 1e6 AS score FROM ev WHERE event_name = 'view' GROUP BY media_id)
SELECT 'TopViews' AS name, CAST(row_number() OVER (ORDER BY score DESC) AS INTEGER) AS rank, media_id, round(score, 6) AS score
FROM x ORDER BY rank LIMIT 20""",
    "stream_few_views": FEW_VIEWS,
    "stream_creator_affinity": _creator_affinity(ALL_POSTS),
    "upsert_lookup": f"""WITH {EV}, {_windows('event_name, user_id', HOUR)}, {WRITTEN}
SELECT key, feature_name, window_end, total FROM r WHERE key IN ('0', '10', '20', '30', '40', '50')
QUALIFY row_number() OVER (PARTITION BY key, feature_name ORDER BY window_end DESC) = 1""",
    "period_counts": f"""WITH {EV} SELECT event_name, media_id,
       count(*) FILTER (event_ts > {AS_OF - DAY}) AS last_day, count(*) FILTER (event_ts > {AS_OF - WEEK}) AS last_week,
       count(*) AS last_month
FROM ev WHERE event_ts > {AS_OF - 30 * DAY} AND event_ts <= {AS_OF} GROUP BY event_name, media_id""",
    "amount_sums": f"WITH {EV} SELECT user_id, event_name, round(sum(value), 6) AS total, count(*) AS n FROM ev GROUP BY user_id, event_name",
    "viewed_not_purchased": _missing("user_id, media_id", 5 * DAY),
    "viewed_not_purchased_user": _missing("user_id", HOUR),
    "stream_word_windows": f"WITH {EV}, {_word_windows(HOUR)} SELECT * FROM w",
    "stream_word_totals": f"WITH {EV} SELECT word, count(*) AS n FROM ({_words('ev', 'line')}) WHERE word <> '' GROUP BY word",
    "stream_lifetime": f"""WITH {EV}, {_windows('event_name, user_id', HOUR)}
SELECT * FROM ({LIFETIME.format(keys='event_name, user_id')})""",
    "stream_counters": f"""WITH {EV}, {_windows('event_name, media_id', HOUR)}
SELECT event_name AS feature_name, media_id AS key, * EXCLUDE (event_name, media_id)
FROM ({_running('media_id', [HOUR, DAY, WEEK])})""",
    "stream_counters_handover": f"""WITH {EV}, {_windows('event_name, media_id', HOUR)}
SELECT event_name AS feature_name, media_id AS key, * EXCLUDE (event_name, media_id)
FROM ({_running('media_id', [HOUR, DAY, WEEK])})""",
    "stream_lifetime_handover": f"""WITH {EV}, {_windows('event_name, user_id', HOUR)}
SELECT * FROM ({LIFETIME.format(keys='event_name, user_id')}) WHERE window_start >= {AS_OF - 15 * DAY}""",
    "stream_counter_slices": f"""{MEDIA_EACH}
SELECT event_name AS feature_name, media_id AS key, decay_interval, last_update, round(value, 6) AS value FROM c""",
    "stream_sliding": f"""WITH {EV},
x AS (SELECT event_name, event_ts // 1200 * 1200 - unnest(range(0, 3600, 1200)) AS window_start FROM ev)
SELECT event_name, window_start, count(*) AS n FROM x GROUP BY event_name, window_start""",
    "stream_candidates": STREAM_LIST,
    "stream_candidates_of_counters": STREAM_LIST,
    "stream_counters_and_list": STREAM_LIST,
    "stream_family_counters": _feature_counters(),
    "stream_ratio_topk": BEST_RATIOS,
    "stream_viewed_not_purchased": _missing("user_id", HOUR),
    "stream_missing_reactions_joined": _missing("user_id", HOUR),
    "stream_ttl_lifetime": f"""WITH {EV}, {_windows('event_name, user_id', 5)}, {_lives(2 * DAY)}
SELECT event_name, user_id, window_start, window_end, n,
       CAST(sum(n) OVER (PARTITION BY event_name, user_id, life ORDER BY window_start) AS BIGINT) AS total FROM l""",
    "stream_ttl_counters": f"""WITH {EV}, {_windows('event_name, user_id', HOUR)}, {_lives(DAY)}
SELECT event_name AS feature_name, user_id AS key, * EXCLUDE (event_name, user_id)
FROM ({_running('user_id', [HOUR, DAY, WEEK], 'l', 'life')})""",
    "stream_replayed_lines": f"""WITH {EV} SELECT event_name, media_id, count(*) AS n FROM ev
WHERE event_name IN ('view', 'purchase') GROUP BY event_name, media_id""",
}
