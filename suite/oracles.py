"""What the queries compute, as SQL over the same tables."""

from __future__ import annotations

from suite import stem_sql
from suite.inputs import CONCEPTS, NEWS_REGIONS, PHRASES, STOPWORDS, TOPICS

from termtide.functions.contractions import CONTRACTIONS
from termtide.functions.tokens import EMOJI, EMOJI_OR_WORD, POST_TOKEN, SPANISH_TOKEN
from termtide.operators.lemmas import DETACHMENT, IRREGULAR


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strings(values) -> str:
    return ", ".join(q(v) for v in values)


# --- expressions ------------------------------------------------------------


def clean(c: str) -> str:
    return f"replace(replace({c}, '# ', '#'), chr(10), ' ')"


def punct(c: str) -> str:
    return rf"regexp_replace({c}, '(https?://\S*|[@#])|[\p{{P}}\p{{S}}]', '\1', 'g')"


def punct_all(c: str) -> str:
    return rf"regexp_replace({c}, '([@#''])|[\p{{P}}\p{{S}}]', '\1', 'g')"


def post_tokens(c: str) -> str:
    return f"regexp_extract_all(lower({c}), {q(POST_TOKEN)})"


def spanish_tokens(c: str) -> str:
    return f"regexp_extract_all({c}, {q(SPANISH_TOKEN)})"


def without(c: str, words=STOPWORDS) -> str:
    return (
        f"list_filter({c}, lambda t: t NOT IN ('', '''', ':') AND t NOT IN ({strings(words)}))"
    )


def shown(c: str) -> str:
    return f"array_to_string({c}, ' ') AS tokens, CAST(len({c}) AS INTEGER) AS n_tokens"


def sql_map(mapping: dict[str, str]) -> str:
    return f"MAP {{{', '.join(f'{q(k)}: {q(v)}' for k, v in mapping.items())}}}"


def phrases(c: str, mapping: dict[str, str], keys: list[str]) -> str:
    """Cut at the matches, look each match up, sew together."""
    pattern = q(r"\b(?:" + "|".join(keys) + r")\b")
    return (
        f"array_to_string(list_transform(list_zip(regexp_split_to_array({c}, {pattern}), "
        f"regexp_extract_all({c}, {pattern})), "
        f"lambda p: p[1] || coalesce({sql_map(mapping)}[p[2]], '')), '')"
    )


def expand(c: str) -> str:
    return phrases(c, CONTRACTIONS, list(CONTRACTIONS))


def synonyms(c: str) -> str:
    r"""RE2 takes ``\b`` for ASCII only, so other letters are fenced with word characters meanwhile."""
    fenced = rf"regexp_replace({c}, '([^\x00-\x7F])', '_\1_', 'g')"
    done = phrases(fenced, PHRASES, sorted(PHRASES, key=len, reverse=True))
    return rf"regexp_replace({done}, '_([^\x00-\x7F])_', '\1', 'g')"


MOMENT = (
    "(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST({0} % 60 AS INTEGER)) "
    "+ to_hours(CAST({0} % 24 AS INTEGER)))"
)
DOC_MOMENT = MOMENT.format("doc_id")
DOC_DAY = "(DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER))"

PLAIN_TEXT = punct(clean("lower(full_text)"))
JOB_TEXT = punct(expand(clean("lower(full_text)")))
JOB_TOKENS = without(post_tokens(JOB_TEXT))


# --- inputs -----------------------------------------------------------------

POSTS = f"""posts AS (
  SELECT CAST(doc_id AS VARCHAR) AS id_str, text AS full_text, {DOC_DAY} AS date,
         {DOC_MOMENT} AS timestamp, lang, source AS handle
  FROM documents)"""

TWEETS = f"""tweets AS (
  SELECT doc_id AS id,
         CASE WHEN doc_id % 3 <> 0 THEN 't' || doc_id END AS id_str,
         CASE WHEN doc_id % 4 = 0 THEN text END AS full_text,
         CASE WHEN doc_id % 4 = 1 THEN text END AS text,
         CASE WHEN doc_id % 4 = 2 THEN text END AS tweet,
         CASE WHEN doc_id % 4 <> 2 THEN 'body of ' || text END AS body,
         CASE WHEN doc_id % 5 = 0 THEN 'junk'
              WHEN doc_id % 2 = 0 THEN strftime({DOC_MOMENT}, '%Y-%m-%d %H:%M:%S UTC')
              ELSE strftime({DOC_MOMENT}, '%a %b %d %H:%M:%S +0000 %Y') END AS created_at,
         CASE WHEN doc_id % 7 = 0
              THEN strftime({DOC_MOMENT}, '%Y-%m-%dT%H:%M:%S.000Z') END AS postedTime,
         CASE WHEN doc_id % 3 = 0 THEN lang END AS lang,
         CASE WHEN doc_id % 3 = 1 THEN lang END AS language,
         CASE WHEN doc_id % 2 = 0 THEN 'x-' || lang END AS twitter_lang,
         CASE WHEN doc_id % 4 = 0 THEN source END AS screen_name,
         CASE WHEN doc_id % 4 = 1 THEN upper(source) END AS name,
         CASE WHEN doc_id % 4 = 2 THEN source END AS preferred,
         'u_' || source AS username
  FROM documents),
created AS (
  SELECT *,
         coalesce(try_strptime(created_at, '%Y-%m-%d %H:%M:%S UTC'),
                  try_strptime(created_at, '%a %b %d %H:%M:%S +0000 %Y')) AS ts,
         try_strptime(postedTime, '%Y-%m-%dT%H:%M:%S.000Z') AS posted
  FROM tweets)"""

REPLIES = """replies AS (
  SELECT conv_id || '-' || turn AS id_str, text AS full_text,
         CASE WHEN role = 'assistant' THEN CAST(conv_id AS VARCHAR) END AS retweeted,
         CASE WHEN role <> 'system' THEN turn > 2 END AS is_quote_status
  FROM conversations)"""

ARTICLES = f"""articles AS (
  SELECT 'art-' || doc_id AS uri, text AS body, {DOC_DAY} AS date, source,
         [lang, source] AS concepts
  FROM documents),
metadata AS (
  SELECT 'src' || n_nationkey AS source, r_name AS region,
         'division ' || r_regionkey AS division, n_name AS state
  FROM nation JOIN region ON n_regionkey = r_regionkey),
sourced AS (
  SELECT uri, region, division, state FROM articles LEFT JOIN metadata USING (source))"""

BROADCASTS = f"""broadcasts AS (
  SELECT conv_id || '-' || turn AS guid, text AS body,
         CAST({MOMENT.format('conv_id')} AS DATE) AS date, role AS outlet
  FROM conversations)"""

BENCH_WORDS = f"bench_words AS (SELECT DISTINCT unnest({post_tokens('text')}) AS word FROM benchmark)"

STEMS = "stems AS (SELECT word AS synonym, substring(word, 1, 4) AS head FROM bench_words)"

EVENTS = """series AS (
  SELECT event_type AS topic, CAST(ts AS DATE) AS "Date", count(*) AS "count"
  FROM events GROUP BY 1, 2)"""

ORDERS = """series AS (
  SELECT o_orderpriority AS topic, CAST(o_orderdate AS DATE) AS "Date", count(*) AS "count"
  FROM orders GROUP BY 1, 2)"""

POST_COLUMNS = (
    "id_str, CAST(length(full_text) AS INTEGER) AS n_chars, md5(full_text) AS text_md5, "
    "CAST(date AS VARCHAR) AS date, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS moment, lang, handle"
)

DECORATED = "full_text"
for _mark, _other in (
    ("%%%", " 😀"),
    ("###", " #tag"),
    ("&&&", " http://a.b/c"),
    ("$$$", "👍🏽"),
    (",", " :"),
):
    DECORATED = f"replace({DECORATED}, {q(_mark)}, {q(_other)})"

CONTRACTED = "lower(full_text)"
for _long, _short in ((" is ", "'s "), (" was ", " wasn't "), (" in ", " can't've ")):
    CONTRACTED = f"replace({CONTRACTED}, {q(_long)}, {q(_short)})"


def topic_values() -> str:
    seen: dict[str, str] = {}
    for topic in TOPICS:
        for word in topic["words"]:
            seen.setdefault(word.lower(), topic["topic"])
    rows = ", ".join(f"({q(t)}, {q(w)}, {i})" for i, (w, t) in enumerate(seen.items()))
    return f"tw(topic, word, idx) AS (VALUES {rows})"


def counts(
    tokens: str,
    label: str = "date",
    name: str = "date",
    count_filter: int = 25,
    topics: str | None = None,
) -> str:
    """Co-occurrence by joining each post's matched topic words with its tokens."""
    return f"""{topics or topic_values()},
tokenized AS (SELECT id_str AS post, {label} AS label, unnest({tokens}) AS token FROM posts),
tf AS (SELECT post, label, token, count(*) AS tf FROM tokenized GROUP BY ALL),
matched AS (SELECT tf.post, tw.topic, tw.idx FROM tf JOIN tw ON tf.token = tw.word),
counted AS (
  SELECT x.label AS "{name}", m.topic, x.token AS word, CAST(sum(x.tf) AS BIGINT) AS "count"
  FROM matched m JOIN tf x ON x.post = m.post LEFT JOIN tw j ON j.word = x.token
  WHERE (j.idx IS NULL OR j.idx > m.idx) AND length(x.token) > 2
  GROUP BY 1, 2, 3 HAVING sum(x.tf) > {count_filter})"""


LABELS = {
    "daily": "date",
    "weekly": "CAST(weekofyear(date) AS INTEGER)",
    "monthly": "CAST(month(date) AS INTEGER)",
    "yearly": "CAST(year(date) AS INTEGER)",
    "overall": "'OVERALL'",
}


def by_interval(interval: str, count_filter: int = 25) -> str:
    body = counts(JOB_TOKENS, LABELS[interval], "interval", count_filter)
    return f"WITH {POSTS}, {body} SELECT * FROM counted"


BENCH_TOPICS = f"""mentions AS (
  SELECT 'item ' || item_id AS topic, item_id, unnest(toks) AS word,
         generate_subscripts(toks, 1) AS pos
  FROM (SELECT item_id, {post_tokens(punct(clean('text')))} AS toks FROM benchmark)),
tw AS (
  SELECT arg_min(topic, item_id * 1048576 + pos) AS topic, word,
         min(item_id * 1048576 + pos) AS idx
  FROM mentions GROUP BY word)"""

ORACLES: dict[str, str] = {
    # --- sources
    "src_parquet": "SELECT CAST(doc_id AS VARCHAR) AS id_str, CAST(length(text) AS INTEGER) AS n_chars, "
    "lang, source FROM documents",
    "src_csv": f"WITH {POSTS} SELECT id_str, md5(full_text) AS text_md5, lang FROM posts",
    "src_json": f"WITH {REPLIES} SELECT id_str, md5(full_text) AS text_md5, retweeted, "
    "CAST(is_quote_status AS VARCHAR) AS is_quote_status FROM replies",
    "src_text": "SELECT DATE '2020-06-01' AS date, count(*) AS n_lines, "
    "CAST(sum(length(text)) AS BIGINT) AS n_chars FROM conversations WHERE text <> ''",
    "src_text_period": f"""WITH {POSTS} SELECT CAST(date AS VARCHAR) AS date, count(*) AS n_lines,
  CAST(sum(length(full_text)) AS BIGINT) AS n_chars
FROM posts WHERE full_text <> '' AND date BETWEEN DATE '2024-01-20' AND DATE '2024-02-03' GROUP BY date""",
    "src_unreadable": f"""WITH {POSTS}, read AS (
  SELECT count(*) AS n_posts, CAST(sum(length(full_text)) AS BIGINT) AS n_chars FROM posts)
SELECT kind, n_posts, n_chars, 'broken.' || ending AS unreadable, CAST(1 AS BIGINT) AS n_unreadable
FROM (VALUES ('parquet', 'parquet'), ('json', 'json.gz')) k(kind, ending), read""",
    "map_file_rows": """WITH lines AS (
  SELECT p_partkey, string_split(p_brand || ',' || replace(p_name, ' ', ',,'), ',') AS parts FROM part),
rows_ AS (SELECT p_partkey, parts[1] AS head, unnest(parts[2:]) AS synonym FROM lines)
SELECT synonym, arg_max(head, p_partkey) AS head FROM rows_ WHERE synonym <> '' GROUP BY synonym""",
    "topic_table": r"""WITH words AS (
  SELECT item_id, string_split(regexp_replace(text, '[\s.,]+', ' ', 'g'), ' ') AS ws FROM benchmark),
mentions AS (
  SELECT item_id, lower(unnest(ws)) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM words)
SELECT 'item ' || arg_min(item_id, (item_id, pos)) AS topic, word,
       CAST(min(CAST(item_id AS HUGEINT) * 100000000000000000000 + pos) AS VARCHAR) AS idx
FROM mentions GROUP BY word""",
    # --- adapters
    "norm_twitter_text": f"WITH {TWEETS} SELECT id, "
    "md5(coalesce(full_text, text, tweet, body)) AS text_md5 FROM tweets",
    "norm_created_at": f"WITH {TWEETS} SELECT id, created_at, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, "
    "strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment FROM created",
    "norm_posted_time": f'WITH {TWEETS} SELECT id, postedTime AS "postedTime", '
    "CAST(CAST(coalesce(posted, ts) AS DATE) AS VARCHAR) AS date, "
    "strftime(coalesce(posted, ts), '%Y-%m-%d %H:%M:%S') AS moment FROM created",
    "norm_id": f"WITH {TWEETS} SELECT id, coalesce(id_str, CAST(id AS VARCHAR)) AS id_str FROM tweets",
    "norm_lang": f"WITH {TWEETS} SELECT id, coalesce(lang, language, twitter_lang) AS lang FROM tweets",
    "norm_handle": f"WITH {TWEETS} SELECT id, "
    "coalesce(screen_name, name, preferred, username) AS handle FROM tweets",
    "norm_twitter": f"""WITH {TWEETS}, posts AS (
  SELECT coalesce(id_str, CAST(id AS VARCHAR)) AS id_str,
         coalesce(full_text, text, tweet, body) AS full_text,
         CAST(coalesce(posted, ts) AS DATE) AS date, coalesce(posted, ts) AS timestamp,
         coalesce(lang, language, twitter_lang) AS lang,
         coalesce(screen_name, name, preferred, username) AS handle
  FROM created)
SELECT {POST_COLUMNS} FROM posts""",
    "norm_radio": f"SELECT CASE WHEN doc_id % 9 = 0 THEN 'undated' "
    f"ELSE strftime({DOC_DAY}, '%Y-%-m-%-d') END || '_n' || doc_id || '.txt' AS id_str, "
    f"CASE WHEN doc_id % 9 <> 0 THEN CAST({DOC_DAY} AS VARCHAR) END AS date, md5(text) AS text_md5 FROM documents",
    "norm_cnn": f"SELECT CAST(doc_id AS VARCHAR) AS id_str, "
    f"CASE WHEN doc_id % 9 <> 0 THEN CAST({DOC_DAY} AS VARCHAR) END AS date FROM documents",
    "norm_gallup": "SELECT CAST(o_orderkey AS VARCHAR) AS id_str, CAST(o_orderdate AS DATE) AS date "
    "FROM orders",
    "norm_news": f"WITH {ARTICLES} SELECT uri AS id_str, date, md5(body) AS text_md5 FROM articles",
    "norm_reddit": f"SELECT 'c' || doc_id AS id_str, {DOC_DAY} AS date, md5(text) AS text_md5 "
    "FROM documents",
    "norm_tv": f"WITH {BROADCASTS} SELECT guid AS id_str, date, md5(body) AS text_md5 FROM broadcasts",
    # --- filters
    "join_source_meta": f"WITH {ARTICLES} SELECT * FROM sourced",
    "join_source_meta_salted": f"WITH {ARTICLES} SELECT * FROM sourced",
    "filter_region": f"WITH {ARTICLES} SELECT uri, region FROM sourced "
    f"WHERE region IN ({strings(NEWS_REGIONS)})",
    "filter_division": f"WITH {ARTICLES} SELECT uri, division FROM sourced "
    "WHERE division IN ('division 1', 'division 3')",
    "filter_states": f"WITH {ARTICLES} SELECT uri, state FROM sourced "
    "WHERE state IN ('NATION_4', 'NATION_7')",
    "filter_concepts": f"WITH {ARTICLES} SELECT uri, array_to_string(concepts, '|') AS concepts "
    f"FROM articles WHERE list_has_any(concepts, [{strings(CONCEPTS)}])",
    "filter_outlet": f"WITH {BROADCASTS} SELECT guid, outlet FROM broadcasts "
    "WHERE outlet IN ('user', 'system')",
    "filter_tweet_types": f"""WITH {REPLIES}
SELECT 'tweet' AS kind, id_str FROM replies WHERE retweeted IS NULL AND NOT is_quote_status
UNION ALL
SELECT 'retweet', id_str FROM replies
WHERE NOT is_quote_status AND (retweeted IS NOT NULL OR is_quote_status)
UNION ALL
SELECT 'quote', id_str FROM replies
WHERE retweeted IS NULL AND (retweeted IS NOT NULL OR is_quote_status)""",
    "filter_lang": f"WITH {POSTS} SELECT id_str, lang FROM posts WHERE lang = 'fr'",
    "filter_date_range": f"WITH {POSTS} SELECT id_str, date FROM posts "
    "WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-02-05'",
    "filter_ts_range": f"WITH {POSTS} SELECT id_str, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS moment "
    "FROM posts WHERE timestamp BETWEEN TIMESTAMP '2024-01-10 06:00:00' "
    "AND TIMESTAMP '2024-02-05 18:00:00'",
    "dedupe_by_id": f"""WITH {POSTS}, numbered AS (
  SELECT md5(full_text) AS id_str, full_text, date, timestamp, lang, handle,
         row_number() OVER (PARTITION BY md5(full_text)
                            ORDER BY timestamp, full_text, date, lang, handle) AS n
  FROM posts)
SELECT {POST_COLUMNS} FROM numbered WHERE n = 1""",
    # --- text
    "text_clean": f"WITH {POSTS} SELECT id_str, lower({clean('full_text')}) AS text FROM posts",
    "text_punct": f"SELECT page_id, {punct('url || chr(32) || html')} AS text FROM pages",
    "text_punct_all": f"SELECT page_id, {punct_all('url || chr(32) || html')} AS text FROM pages",
    "expand_contractions": f"""WITH {POSTS}, short AS (
  SELECT id_str, {CONTRACTED} AS full_text FROM posts),
long AS (SELECT id_str, {expand('full_text')} AS text FROM short)
SELECT id_str, text, replace(text, '''s', '') AS text_dropped FROM long""",
    "replace_phrases": f"WITH {POSTS} SELECT id_str, {synonyms('lower(full_text)')} AS text FROM posts",
    "url_decode": f"WITH {POSTS} SELECT id_str, replace(full_text, '.', '++') AS text FROM posts",
    # --- tokens
    "tokens_tweet": f"SELECT page_id, {shown(post_tokens('url || chr(32) || html'))} FROM pages",
    "tokens_long": f"""WITH t AS (SELECT doc_id, regexp_replace(text, '\\s+',
    CASE WHEN doc_id % 2 = 0 THEN '-' ELSE ',' END, 'g') AS text FROM documents),
k AS (SELECT doc_id, {post_tokens('text')} AS toks FROM t)
SELECT doc_id, {shown('toks')} FROM k""",
    "stopwords_large": f"""WITH {POSTS},
words AS (SELECT DISTINCT unnest({post_tokens('url || chr(32) || html')}) AS word FROM pages),
listed AS (SELECT id_str, {post_tokens('full_text')} AS toks FROM posts),
rows_ AS (SELECT id_str, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM listed),
kept AS (SELECT * FROM rows_
  WHERE token NOT IN ('', '\'\'', ':') AND token NOT IN (SELECT word FROM words))
SELECT id_str, coalesce(string_agg(token, ' ' ORDER BY pos), '') AS tokens,
       CAST(count(token) AS INTEGER) AS n_tokens
FROM posts LEFT JOIN kept USING (id_str) GROUP BY id_str""",
    "tokens_multilang": f"""WITH {POSTS}, t AS (
  SELECT id_str, CASE WHEN lang = 'es' THEN {spanish_tokens('full_text')}
                      ELSE {post_tokens('full_text')} END AS toks FROM posts)
SELECT id_str, {shown('toks')} FROM t""",
    "tokens_composite": f"""WITH {POSTS}, t AS (
  SELECT id_str, list_filter({post_tokens(JOB_TEXT)},
                             lambda t: t NOT IN ('', '''', ':')) AS toks FROM posts)
SELECT id_str, {shown('toks')} FROM t""",
    "tokens_emoji_split": f"""WITH {POSTS}, t AS (
  SELECT id_str, regexp_extract_all({DECORATED}, {q(EMOJI_OR_WORD)}) AS toks FROM posts)
SELECT id_str, {shown('toks')} FROM t""",
    "token_filter": f"""WITH {POSTS}, t AS (
  SELECT id_str, list_filter(string_split({DECORATED}, ' '),
    lambda t: t NOT IN ('', '''', ':') AND NOT starts_with(t, 'http') AND NOT starts_with(t, '#')
      AND regexp_replace(t, {q(EMOJI)}, '', 'g') <> '') AS toks FROM posts)
SELECT id_str, {shown('toks')} FROM t""",
    "stopword_filter": f"""WITH {POSTS}, t AS (
  SELECT id_str, {without(post_tokens('full_text'))} AS toks FROM posts)
SELECT id_str, {shown('toks')} FROM t""",
    "preprocess_default": f"WITH {POSTS} SELECT id_str, array_to_string({JOB_TOKENS}, ' ') "
    "AS preprocessed_text FROM posts",
    "preprocess_synonyms": f"""WITH {POSTS}, t AS (
  SELECT id_str, {post_tokens(punct(synonyms(expand(clean('lower(full_text)')))))} AS toks FROM posts)
SELECT id_str, array_to_string(toks, ' ') AS preprocessed_text FROM t""",
    "preprocessed_output": f"WITH {POSTS} SELECT id_str, md5(trim(full_text, ' ')) AS text_md5, "
    f"trim(array_to_string({JOB_TOKENS}, ' '), ' ') AS preprocessed_text FROM posts",
    # --- co-occurrence
    "cooccurrence": f"WITH {POSTS}, {counts(post_tokens(PLAIN_TEXT))} SELECT * FROM counted",
    "cooccurrence_many_topics": f"WITH {POSTS}, "
    + counts(JOB_TOKENS, "'OVERALL'", "interval", 100, BENCH_TOPICS)
    + " SELECT * FROM counted",
    "cooccur_week_starts": f"WITH {POSTS}, "
    + counts(JOB_TOKENS, "CAST(date_trunc('week', date) AS DATE)", "interval")
    + " SELECT * FROM counted",
    **{f"cooccur_{i}": by_interval(i) for i in LABELS},
    "cooccur_sorted": by_interval("weekly"),
    "cooccur_csv": by_interval("weekly"),
    "saturating_words": f"WITH {POSTS}, {counts(JOB_TOKENS, LABELS['overall'], 'interval')}, "
    'top AS (SELECT floor(CAST(0.10 AS DOUBLE) * max("count")) AS cutoff FROM counted) '
    'SELECT word FROM counted, top WHERE "count" > cutoff GROUP BY word '
    f"HAVING count(DISTINCT topic) >= 0.5 * {len(TOPICS)}",
    "job_counts": by_interval("weekly"),
    "job_outputs": f"WITH {POSTS} SELECT 'c' || id_str AS id_str, md5(trim(full_text, ' ')) AS text_md5, "
    f"trim(array_to_string({JOB_TOKENS}, ' '), ' ') AS preprocessed_text, "
    "(SELECT count(*) FROM posts) AS n_posts, "
    "'reddit_comments_CoOccurrence_weekly.csv' AS counts_name FROM posts",
    "run_summary": f"WITH {POSTS} SELECT count(*) AS record_count, min(date) AS first_date, "
    "max(date) AS last_date FROM posts",
    # --- series
    "series_pivot": f"""WITH {EVENTS}
SELECT "Date", {', '.join(f'''CAST(coalesce(sum("count") FILTER (topic = '{t}'), 0) AS BIGINT) AS "{t}"'''
                          for t in ('click', 'error', 'purchase', 'signup', 'view'))}
FROM series GROUP BY 1""",
    "series_unpivot": f"""WITH {EVENTS}, days AS (SELECT DISTINCT "Date" FROM series),
topics AS (SELECT DISTINCT topic FROM series)
SELECT "Date", topic, coalesce("count", 0) AS "count"
FROM days CROSS JOIN topics LEFT JOIN series USING ("Date", topic)""",
    "series_gapfill": f"""WITH {ORDERS}, days AS (
  SELECT CAST(unnest(generate_series(min("Date"), max("Date"), INTERVAL 1 DAY)) AS DATE) AS "Date"
  FROM series),
topics AS (SELECT DISTINCT topic FROM series)
SELECT topic, "Date", coalesce("count", 0) AS "count"
FROM days CROSS JOIN topics LEFT JOIN series USING ("Date", topic)""",
    "series_gapfill_null": f"""WITH {ORDERS}, s AS (
  SELECT CASE WHEN topic <> '5-LOW' THEN topic END AS topic, "Date", "count" FROM series), days AS (
  SELECT CAST(unnest(generate_series(min("Date"), max("Date"), INTERVAL 1 DAY)) AS DATE) AS "Date"
  FROM s),
topics AS (SELECT DISTINCT topic FROM s)
SELECT t.topic, d."Date", coalesce("count", 0) AS "count"
FROM days d CROSS JOIN topics t
LEFT JOIN s ON s."Date" = d."Date" AND s.topic IS NOT DISTINCT FROM t.topic""",
    "series_rollup_null": f"""WITH {ORDERS}
SELECT "Date", CASE WHEN topic IN ('1-URGENT', '2-HIGH') THEN 'soon'
                    WHEN topic = '3-MEDIUM' THEN 'later' END AS category,
       CAST(sum("count") AS BIGINT) AS "count"
FROM series GROUP BY 1, 2""",
    "series_diff_null": f"""WITH {ORDERS}
SELECT "Date", topic, "count" AS left_count, CAST(NULL AS BIGINT) AS right_count
FROM series WHERE topic = '1-URGENT'""",
    "series_gapfill_wide": f"""WITH {ORDERS}, days AS (
  SELECT CAST(unnest(generate_series(min("Date"), max("Date"), INTERVAL 1 DAY)) AS DATE) AS "Date"
  FROM series)
SELECT "Date", {', '.join(f'''CAST(coalesce(sum("count") FILTER (topic = '{t}'), 0) AS BIGINT) AS {n}'''
                          for t, n in (('1-URGENT', 'urgent'), ('2-HIGH', 'high'),
                                       ('3-MEDIUM', 'medium'), ('4-NOT SPECIFIED', 'not_specified'),
                                       ('5-LOW', 'low')))}
FROM days LEFT JOIN series USING ("Date") GROUP BY 1""",
    "series_tumbling5": f"""WITH {ORDERS}, first AS (SELECT min("Date") AS d0 FROM series)
SELECT CAST(d0 + CAST(floor(("Date" - d0) / 5) AS INTEGER) * 5 AS DATE) AS "Date", topic,
       CAST(sum("count") AS BIGINT) AS "count"
FROM series, first GROUP BY 1, 2""",
    "series_weekly": f"""WITH {ORDERS}
SELECT topic, CAST(date_trunc('week', "Date") AS DATE) AS start_of_week,
       CAST(sum("count") AS BIGINT) AS "count",
       CAST(weekofyear(date_trunc('week', "Date")) AS INTEGER) AS week
FROM series GROUP BY 1, 2, 4""",
    "series_rollup": """SELECT CAST(o_orderdate AS DATE) AS "Date", r_name AS category,
       count(*) AS "count"
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    "series_union": """SELECT CAST(o_orderdate AS DATE) AS "Date",
       count(*) FILTER (o_orderstatus = 'F') AS "Finished",
       count(*) FILTER (o_orderstatus = 'O') AS "Opened",
       count(*) FILTER (o_orderstatus = 'P') AS "Pending"
FROM orders GROUP BY 1
UNION ALL
SELECT CAST(l_shipdate AS DATE), count(*) FILTER (l_linestatus = 'F'),
       count(*) FILTER (l_linestatus = 'O'), 0
FROM lineitem GROUP BY 1""",
    "series_quarantine": """WITH parts AS (
  SELECT event_type, strftime(ts, '%Y-%m-%d') AS d, event_id, user_id, CAST(ts AS DATE) AS "Date"
  FROM events)
SELECT concat_ws(',', CASE WHEN event_type = 'signup' THEN '1540' || d ELSE d END, event_id,
                 CASE event_type WHEN 'view' THEN '' WHEN 'purchase' THEN 'x' WHEN 'error' THEN NULL
                                 ELSE CAST(user_id AS VARCHAR) END) AS value,
       CASE WHEN event_type <> 'signup' THEN CAST("Date" AS VARCHAR) END AS "Date", event_id AS event,
       CASE WHEN event_type IN ('click', 'signup') THEN CAST(user_id AS VARCHAR) END AS "user",
       event_type IN ('error', 'signup', 'purchase') AS quarantined
FROM parts""",
    "series_headers": """WITH parts AS (
  SELECT event_id, event_id % 4 AS layout, event_type, user_id, ts,
         CASE WHEN event_type = 'signup' THEN '1540' ELSE '' END || strftime(ts, '%Y-%m-%d') AS d,
         CASE event_type WHEN 'view' THEN '' WHEN 'purchase' THEN 'x' WHEN 'error' THEN NULL
                         ELSE CAST(user_id AS VARCHAR) END AS u
  FROM events),
lines AS (
  SELECT event_id, event_type, user_id, ts,
         CASE layout WHEN 1 THEN concat_ws(',', u, d, event_id) WHEN 2 THEN concat_ws(',', d, event_type, u, event_id)
                     ELSE concat_ws(',', d, event_id, u) END AS value,
         CASE WHEN layout = 3 THEN 'no header' WHEN event_type = 'error' THEN 'fields'
              WHEN event_type = 'signup' THEN 'date' WHEN event_type = 'purchase' THEN 'number' END AS reason
  FROM parts)
SELECT value, CASE WHEN reason IS NULL THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS "Date",
       CASE WHEN reason IS NULL THEN event_id END AS event,
       CASE WHEN reason IS NULL AND event_type = 'click' THEN CAST(user_id AS VARCHAR) END AS "user",
       reason IS NOT NULL AS quarantined, reason
FROM lines""",
    "series_diff": f"""WITH {EVENTS}, users AS (
  SELECT event_type AS topic, CAST(ts AS DATE) AS "Date", count(DISTINCT user_id) AS "count"
  FROM events GROUP BY 1, 2)
SELECT coalesce(s."Date", u."Date") AS "Date", coalesce(s.topic, u.topic) AS topic,
       s."count" AS left_count, u."count" AS right_count
FROM series s FULL JOIN users u ON s."Date" = u."Date" AND s.topic = u.topic
WHERE s."count" IS DISTINCT FROM u."count\"""",
}

ORACLES["cooccurrence_joined"] = ORACLES["cooccurrence"]

_ANTI = f"""WITH {POSTS}, {BENCH_WORDS},
t AS (SELECT unnest({post_tokens('full_text')}) AS token FROM posts)
SELECT token, count(*) AS n FROM t WHERE token NOT IN (SELECT word FROM bench_words) GROUP BY token"""
ORACLES["stopword_anti"] = ORACLES["stopword_anti_salted"] = _ANTI


def _mapped(
    exclude: str = "FALSE", after: str = "TRUE", before: str = "TRUE", text: str = "full_text"
) -> str:
    """Token by token through the stems, in order."""
    return f"""WITH {POSTS}, {BENCH_WORDS}, {STEMS},
listed AS (SELECT id_str, {post_tokens(text)} AS toks FROM posts),
rows_ AS (SELECT id_str, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM listed),
mapped AS (
  SELECT id_str, pos, CASE WHEN {exclude} THEN token ELSE coalesce(head, token) END AS token
  FROM rows_ LEFT JOIN stems ON token = synonym WHERE {before}),
joined AS (
  SELECT id_str, string_agg(token, ' ' ORDER BY pos) AS tokens, count(*) AS n
  FROM mapped WHERE {after} GROUP BY id_str)
SELECT p.id_str, coalesce(tokens, '') AS tokens, CAST(coalesce(n, 0) AS INTEGER) AS n_tokens
FROM posts p LEFT JOIN joined USING (id_str)"""


ORACLES["token_map"] = ORACLES["token_map_joined"] = _mapped()
_STOP = f"token NOT IN ('', '''', ':') AND token NOT IN ({strings([*STOPWORDS, 'ther', 'thin'])})"
ORACLES["token_map_excl"] = _mapped(
    "token IN ('hein', 'therble', 'thin')", _STOP, _STOP, clean("full_text")
)


# --- phrases, stems and lemmas of any number --------------------------------------

RUNS = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_]+"

# Of pairs that overlap in a row, every other one from the first on is the leftmost.
ORACLES["phrases_large"] = rf"""
WITH {POSTS},
page_runs AS (SELECT regexp_extract_all(lower(concat_ws(' ', url, html)), '{RUNS}') AS runs FROM pages),
pairs AS (
  SELECT DISTINCT runs[i] AS a, runs[i + 2] AS b
  FROM (SELECT runs, unnest(range(1, len(runs) - 1)) AS i FROM page_runs) WHERE runs[i + 1] = ' '),
post_runs AS (SELECT id_str, regexp_extract_all(lower(full_text), '{RUNS}') AS runs FROM posts),
placed AS (
  SELECT id_str, i, runs[i] AS run, runs[i + 1] AS gap, runs[i + 2] AS following
  FROM (SELECT id_str, runs, unnest(range(1, len(runs) + 1)) AS i FROM post_runs)),
matched AS (
  SELECT id_str, i FROM placed JOIN pairs ON run = a AND following = b WHERE gap = ' '),
streaks AS (
  SELECT id_str, i, i // 2 - row_number() OVER (PARTITION BY id_str ORDER BY i) AS streak FROM matched),
chosen AS (
  SELECT id_str, i FROM streaks
  QUALIFY (row_number() OVER (PARTITION BY id_str, streak ORDER BY i)) % 2 = 1),
covered AS (SELECT id_str, i, i AS first FROM chosen UNION ALL SELECT id_str, i + d, i FROM chosen, range(1, 3) r(d)),
shown AS (
  SELECT p.id_str, p.i,
         CASE WHEN c.first = p.i THEN p.run || '_' || p.following WHEN c.i IS NOT NULL THEN '' ELSE p.run END AS piece
  FROM placed p LEFT JOIN covered c ON c.id_str = p.id_str AND c.i = p.i)
SELECT id_str, string_agg(piece, '' ORDER BY i) AS text FROM shown GROUP BY id_str
UNION ALL
SELECT id_str, lower(full_text) FROM posts WHERE coalesce(full_text, '') = ''"""


def _words(lang: str, tokens: str) -> str:
    return f"WITH {POSTS}, words AS (SELECT DISTINCT unnest({tokens}) AS word FROM posts WHERE lang = '{lang}')"


ORACLES["stem_en"] = _words("en", post_tokens("full_text")) + ", " + stem_sql.english("words")
ORACLES["stem_es"] = _words("es", spanish_tokens("full_text")) + ", " + stem_sql.spanish("words")
ORACLES["stem_posts"] = f"""
WITH {POSTS},
listed AS (SELECT id_str, {without(post_tokens(clean("lower(coalesce(full_text, ''))")))} AS t FROM posts),
words AS (SELECT DISTINCT unnest(t) AS word FROM listed),
stems AS MATERIALIZED (WITH {stem_sql.english("words")}),
placed AS (
  SELECT id_str, i, t[i] AS word FROM (SELECT id_str, t, unnest(range(1, len(t) + 1)) AS i FROM listed)),
mapped AS (
  SELECT id_str, list(coalesce(stem, word) ORDER BY i) AS t FROM placed LEFT JOIN stems USING (word) GROUP BY id_str)
SELECT id_str, {shown("coalesce(m.t, [])")} FROM posts LEFT JOIN mapped m USING (id_str)"""


def _lemma_rows(classes: tuple[str, ...]) -> tuple[str, str]:
    endings = sorted({rule for c in classes for rule in DETACHMENT[c]})
    forms = sorted({(w, lemma) for c in classes for w, lemma in IRREGULAR[c].items()})
    return tuple(", ".join(f"({q(a)}, {q(b)})" for a, b in rows) for rows in (endings, forms))


_ENDINGS, _FORMS = _lemma_rows(("n", "v", "a"))
ORACLES["lemmatize_rules"] = f"""
WITH {POSTS},
words AS (SELECT DISTINCT unnest({post_tokens("full_text")}) AS word FROM posts),
known AS (SELECT DISTINCT unnest({post_tokens("concat_ws(' ', url, html)")}) AS lemma FROM pages),
rules(tail, head) AS (VALUES {_ENDINGS}),
forms(word, lemma) AS (VALUES {_FORMS}),
irregular AS (
  SELECT word, min((length(lemma), lemma))[2] AS lemma FROM words JOIN forms USING (word) GROUP BY word),
candidates AS (
  SELECT word, word AS lemma FROM words
  UNION SELECT word, left(word, length(word) - length(tail)) || head FROM words, rules
  WHERE ends_with(word, tail) AND length(word) > length(tail)),
best AS (
  SELECT word, min((length(lemma), lemma))[2] AS lemma
  FROM candidates JOIN known USING (lemma) WHERE word NOT IN (SELECT word FROM irregular) GROUP BY word)
SELECT word, lemma FROM irregular WHERE word <> lemma
UNION ALL SELECT word, lemma FROM best WHERE word <> lemma"""
