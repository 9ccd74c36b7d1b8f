"""The registered queries in plain SQL, written independently of the Spark code."""

from __future__ import annotations

# The words left out of title tokens.
STOPWORDS = (
    "the", "a", "an", "to", "of", "in", "on", "for", "and", "is", "are", "at", "by", "with",
    "as", "it", "its", "from", "after", "over", "into", "amid", "how", "why", "what", "will",
    "says", "said", "new", "more", "than", "this", "that", "be", "has", "have", "had", "not",
    "but", "or", "was", "were", "been", "being",
)
_STOP_LIST = "[" + ", ".join(f"'{word}'" for word in STOPWORDS) + "]"
_TIME = "'%Y-%m-%d %H:%M:%S'"
_MICRO = "'%Y-%m-%d %H:%M:%S.%f'"

#: Named subqueries with the ones they read.
VIEWS: dict[str, tuple[list[str], str]] = {}


def _view(name: str, needs: str, sql: str) -> None:
    VIEWS[name] = (needs.split(), sql)


_view("articles", "", """
    SELECT doc_id, sha256(CAST(doc_id AS VARCHAR)) AS url_hash,
        CASE WHEN doc_id % 5 = 0 THEN source END AS source_id,
        CASE WHEN doc_id % 41 <> 0 THEN source END AS source_name,
        CASE WHEN doc_id % 6 = 0 THEN '  ' || split_part(text, chr(10), 1) || ' '
             ELSE split_part(text, chr(10), 1) END AS title,
        CASE WHEN doc_id % 7 <> 0 THEN split_part(text, chr(10), 2) END AS description,
        text AS content,
        'https://' || source || '.example.com/' || lang || '/' || doc_id AS url,
        lang AS category,
        CASE WHEN doc_id % 3 = 0 THEN 'gnews' ELSE 'newsapi' END AS source_provider,
        CASE WHEN doc_id % 53 <> 0
             THEN TIMESTAMP '2024-01-01' + to_hours(doc_id % 240) END AS published_at,
        TIMESTAMP '2024-02-01' + to_hours(doc_id // 100) AS fetched_at,
        CASE WHEN doc_id % 4 <> 0 THEN 'https://' || source || '.example.com/' || lang || '/'
             || doc_id || '.jpg' END AS url_to_image
    FROM documents""")

_view("article_versions", "articles", """
    SELECT *, 0 AS seq FROM articles
    UNION ALL
    SELECT * REPLACE ('second ' || title AS title,
                      fetched_at + to_days(CAST(doc_id % 3 - 1 AS INTEGER)) AS fetched_at),
        1 AS seq
    FROM articles""")

_view("pages_first", "", """
    SELECT page_id, split_part(url, '/', 4) AS category, url,
        regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, html AS content,
        CASE WHEN page_id % 11 <> 0
             THEN TIMESTAMP '2024-01-01' + to_minutes(page_id) END AS published_at,
        page_id % 11 = 0 AS has_bad_time
    FROM pages""")

_view("items", "pages_first", """
    SELECT 'newsapi' AS source_provider, 1 AS batch_rank, * FROM pages_first
    UNION ALL
    SELECT 'gnews', 2, * REPLACE (
        CASE WHEN page_id % 17 = 0 THEN ''
             WHEN page_id % 19 = 0 THEN NULL
             WHEN page_id % 3 = 0 THEN split_part(url, '#', 1)
                 || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END
                 || 'utm_medium=x&fbclid=7'
             WHEN page_id % 3 = 1 THEN regexp_replace(url, '^http', 'HTTP')
             ELSE 'https://wire.example.org/' || page_id END AS url)
    FROM pages_first""")


def _canonical(source: str) -> str:
    """Canonical form of the ``url`` column of a relation, as one more column."""
    return f"""
    SELECT *, sha256(canonical) AS url_hash FROM (
        SELECT * EXCLUDE (parts, kept),
            lower(regexp_extract(url, '^([A-Za-z]+):', 1)) || '://'
            || lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1))
            || CASE WHEN rtrim(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/') = ''
                    THEN '/'
                    ELSE rtrim(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/') END
            || CASE WHEN len(kept) = 0 THEN '' ELSE '?' || array_to_string(kept, '&') END
            AS canonical
        FROM (
            SELECT *,
                list_sort(list_transform(
                    list_filter(parts, lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_')
                        AND NOT list_contains(['fbclid', 'gclid', 'msclkid', 'mc_cid', 'mc_eid'],
                                              lower(split_part(p, '=', 1)))),
                    lambda p: replace(url_encode(url_decode(split_part(p, '=', 1))), '%20', '+')
                        || '='
                        || replace(url_encode(url_decode(split_part(p, '=', 2))), '%20', '+')))
                AS kept
            FROM (
                SELECT *, string_split(regexp_extract(url, '^[^?#]*[?]([^#]*)', 1), '&') AS parts
                FROM {source}
            )
        )
    )"""


_view("keyed_items", "items", _canonical("(SELECT * FROM items WHERE url <> '')"))

_view("stage", "articles", """
    SELECT * REPLACE (trim(title, ' ') AS title, trim(description, ' ') AS description),
        strlen(content) >= 260 AS is_content_truncated,
        regexp_extract(url, '://([^/:]+)', 1) AS url_domain
    FROM articles""")

_view("dim", "stage", """
    SELECT coalesce(source_name, 'Unknown') AS source_name, min(source_id) AS source_id,
        min(url_domain) AS sample_domain
    FROM stage GROUP BY 1""")

_view("mart", "stage dim", """
    SELECT a.* EXCLUDE (source_id), d.source_id
    FROM stage a LEFT JOIN dim d ON coalesce(a.source_name, 'Unknown') = d.source_name""")

_view("ods", "article_versions", """
    WITH old AS (SELECT * FROM article_versions WHERE seq = 0),
    fresh AS (SELECT * FROM article_versions
              WHERE seq = 1 AND fetched_at > (SELECT max(fetched_at) FROM old))
    SELECT * REPLACE (trim(title, ' ') AS title) FROM old
    WHERE url_hash NOT IN (SELECT url_hash FROM fresh)
    UNION ALL SELECT * REPLACE (trim(title, ' ') AS title) FROM fresh""")

_view("daily", "mart", """
    SELECT strftime(published_at, '%Y-%m-%d') AS published_date, source_name,
        count(*) AS article_count
    FROM mart WHERE published_at IS NOT NULL GROUP BY 1, 2""")

_TOKENS = f"""
    SELECT url_hash, published_at, list_sort(list_distinct(list_filter(
        regexp_extract_all(lower(title), '[a-z0-9]+'),
        lambda w: length(w) > 2 AND NOT list_contains({_STOP_LIST}, w)))) AS tokens
    FROM {{articles}}"""
_view("tokens", "articles", _TOKENS.format(articles="articles"))

_view("busy_articles", "", """
    SELECT sha256(CAST(doc_id AS VARCHAR)) AS url_hash,
        CASE WHEN doc_id % 10 = 0
             THEN 'five tagfive' || doc_id % 5 || ' seven tagseven' || doc_id % 7
                  || ' three tagthree' || doc_id % 3 || ' forty tagforty' || doc_id % 40
                  || ' ninety tagninety' || doc_id % 90
             ELSE 'tagfive' || doc_id % 5 || ' tagseven' || doc_id % 7
                  || ' tagthree' || doc_id % 3 || ' tagforty' || doc_id % 40
                  || ' tagninety' || doc_id % 90 END AS title,
        CASE WHEN doc_id % 97 <> 0
             THEN TIMESTAMP '2024-01-01' + to_hours(doc_id % 48) END AS published_at
    FROM documents""")

_view("busy_tokens", "busy_articles", _TOKENS.format(articles="busy_articles"))


_view("assigned", "", """
    SELECT sha256(CAST(doc_id AS VARCHAR)) AS url_hash,
        sha256(CAST(doc_id - doc_id % 3 AS VARCHAR)) AS cluster_id
    FROM documents""")

_view("summary", "articles", """
    SELECT url_hash AS cluster_id, doc_id, trim(title, ' ') AS summary,
        list_filter(regexp_extract_all(lower(title), '[a-z0-9]+'),
                    lambda w: length(w) >= 3) AS keywords,
        category AS topic,
        CASE WHEN toxic = 1 THEN 'negative' ELSE 'neutral' END AS sentiment,
        CAST(CAST((doc_id % 21 - 10) / 10.0 AS FLOAT) AS DOUBLE) AS sentiment_score,
        1 + doc_id % 6 AS article_count,
        TIMESTAMP '2024-03-01' + to_minutes(doc_id) AS enriched_at,
        CASE WHEN quality = 1 THEN 'success' ELSE 'failed' END AS status,
        CASE WHEN doc_id % 5 = 0 THEN category ELSE '' END AS organizations,
        CASE WHEN doc_id % 2 = 0 THEN 'matters to ' || category ELSE '' END AS why_it_matters,
        CASE WHEN doc_id % 3 = 0 THEN 'before' END AS before_state,
        CASE WHEN doc_id % 4 = 0 THEN 'after' END AS after_state,
        CASE WHEN doc_id % 6 > 0 THEN trim(title, ' ') ELSE '' END AS consensus
    FROM labels JOIN articles USING (doc_id)""")

_view("media", "assigned articles", """
    SELECT cluster_id, min(published_at) AS first_published_at, min(url_to_image) AS image_url
    FROM assigned JOIN articles USING (url_hash) GROUP BY cluster_id""")

_view("feed", "summary media", """
    SELECT * FROM summary JOIN media USING (cluster_id) WHERE status = 'success'""")

_CARD = f"""cluster_id, summary, topic, sentiment, sentiment_score,
    array_to_string(keywords, '|') AS keywords, article_count,
    strftime(enriched_at, {_TIME}) AS enriched_at,
    strftime(first_published_at, {_TIME}) AS first_published_at, image_url"""

_view("members", "assigned articles summary", """
    SELECT cluster_id, url_hash, title, description, source_name,
        row_number() OVER (PARTITION BY cluster_id ORDER BY url_hash) AS member_no
    FROM assigned JOIN articles USING (url_hash)
    WHERE cluster_id NOT IN (SELECT cluster_id FROM summary WHERE status = 'success')""")

_view("answers", "articles", r"""
    SELECT cluster_id, attempt, CASE
            WHEN attempt = 2 THEN CASE WHEN doc_id % 2 = 0 THEN body ELSE broken END
            WHEN doc_id % 9 = 0 THEN broken
            WHEN doc_id % 4 = 0 THEN 'Here it is:' || chr(10) || body || chr(10) || 'Done.'
            ELSE body END AS raw_text
    FROM (SELECT *, replace(body, '"neutral"', '') AS broken FROM (
        SELECT doc_id, url_hash AS cluster_id,
            '{"summary": "' || replace(replace(replace(trim(title, ' '), '\', '\\'),
                                               '"', '\"'), chr(9), '\t') || '"'
            || CASE WHEN doc_id % 11 <> 0 THEN ', "topic": "' || category || '"' ELSE '' END
            || ', "sentiment": "neutral"'
            || CASE WHEN doc_id % 5 = 0 THEN ', "sentiment_score": 0.5' ELSE '' END
            || ', "keywords": ["' || category || '", "' || category || '"]'
            || ', "source_perspectives": [{"index": 1, "focus": "one"}, {"index": 9, "focus": '
            || '"none"}, {"index": 1, "focus": "again"}]}' AS body
        FROM articles)), (VALUES (1), (2)) AS attempts(attempt)""")

_view("checked", "answers", r"""
    SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY is_valid DESC,
            CASE WHEN is_valid THEN attempt ELSE -attempt END) AS place
        FROM (
            SELECT *, CASE WHEN json_valid(block) THEN
                    coalesce(json_type(block, '$.summary') = 'VARCHAR'
                         AND json_type(block, '$.topic') = 'VARCHAR'
                         AND json_type(block, '$.sentiment') = 'VARCHAR', false)
                ELSE false END AS is_valid
            FROM (SELECT *, regexp_extract(raw_text, '(?s)\{.*\}') AS block FROM answers)))
    WHERE place = 1""")

_view("outcome", "members checked", """
    SELECT s.cluster_id, s.article_count, s.first_key, coalesce(c.is_valid, false) AS ok, c.block,
        c.raw_text
    FROM (SELECT cluster_id, count(*) AS article_count,
              max(CASE WHEN member_no = 1 THEN url_hash END) AS first_key
          FROM members GROUP BY 1) s
    LEFT JOIN checked c USING (cluster_id)""")

_view("vote_events", "", """
    SELECT event_id, user_id, ts,
        sha256(CAST(3 * ((7 * CAST(json_extract(props, '$.k') AS BIGINT) + 13 * user_id)
                 % (SELECT count(*) // 3 + 1 FROM documents))
               AS VARCHAR)) AS cluster_id,
        CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 1 WHEN 'error' THEN -1
             WHEN 'signup' THEN 5 END AS vote
    FROM events""")

_view("votes", "vote_events", """
    SELECT user_id, cluster_id, vote, ts FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, cluster_id
                                     ORDER BY ts DESC, event_id DESC) AS place
        FROM vote_events WHERE vote IS NULL OR vote IN (1, -1))
    WHERE place = 1 AND vote IS NOT NULL""")

_view("liked_words", "votes summary", """
    SELECT user_id, cluster_id, topic, keywords
    FROM votes JOIN summary USING (cluster_id) WHERE vote = 1""")

_view("topic_weight", "liked_words", """
    SELECT user_id, topic, count(*) AS weight FROM liked_words GROUP BY ALL""")

_view("word_weight", "liked_words", """
    SELECT user_id, word, count(*) AS weight
    FROM (SELECT user_id, unnest(keywords) AS word FROM liked_words) GROUP BY ALL""")

_view("log", "", """
    WITH attempts AS (
        SELECT strftime(ts, '%Y-%m-%d') AS run_id, event_type AS task_id,
            1 + user_id % 3 AS try_number, event_id % 4 <> 0 AS is_close, ts, event_id,
            CASE WHEN value > 100 THEN 'failed' ELSE 'success' END AS status,
            CAST(floor(value) AS BIGINT) AS rows_fetched,
            CAST(json_extract(props, '$.k') AS BIGINT) AS k, user_id,
            CASE WHEN value > 100 THEN 1 ELSE 0 END AS rows_failed,
            CASE WHEN value > 100 THEN least(4000, 900 * (length(event_type) + 1)) END AS err
        FROM events),
    opened AS (SELECT *, row_number() OVER (PARTITION BY run_id, task_id, try_number
                                            ORDER BY ts, event_id) AS n
               FROM attempts WHERE NOT is_close),
    closed AS (SELECT *, row_number() OVER (PARTITION BY run_id, task_id, try_number
                                            ORDER BY ts DESC, event_id DESC) AS n
               FROM attempts WHERE is_close)
    SELECT o.run_id, o.task_id, o.try_number, date_trunc('day', o.ts) AS execution_date,
        o.ts AS started_at, c.ts AS finished_at, coalesce(c.status, 'running') AS status,
        coalesce(c.rows_fetched, 0) AS rows_fetched, coalesce(c.k, 0) AS rows_new,
        coalesce(c.rows_failed, 0) AS rows_failed, c.err AS error_length,
        '{"k":' || c.k || ',"user_id":' || c.user_id || '}' AS extra_metadata
    FROM (SELECT * FROM opened WHERE n = 1) o
    LEFT JOIN (SELECT * FROM closed WHERE n = 1) c USING (run_id, task_id, try_number)""")


def _order(names: list[str]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        if name not in done:
            for need in VIEWS[name][0]:
                visit(need)
            done.append(name)

    for name in names:
        visit(name)
    return done


def _query(needs: str, sql: str, recursive: str = "") -> str:
    parts = [f"{name} AS ({VIEWS[name][1]}\n)" for name in _order(needs.split())]
    if recursive:
        parts.append(recursive)
    if not parts:
        return sql
    word = "WITH RECURSIVE" if recursive else "WITH"
    return f"{word} {', '.join(parts)}\n{sql}"


def _stories(tokens: str) -> tuple[str, str]:
    """All pairs of articles that share a word, and what each reaches by links."""
    return f"""
        SELECT r.a AS url_hash, arg_min(t.url_hash,
            {{'t': coalesce(t.published_at, TIMESTAMP '1900-01-01'), 'k': t.url_hash}}) AS cluster_id
        FROM reach r JOIN {tokens} t ON t.url_hash = r.b GROUP BY r.a""", f"""
        words AS (SELECT url_hash, unnest(tokens) AS word FROM {tokens}),
        shared AS (SELECT x.url_hash AS a, y.url_hash AS b, count(*) AS n
                   FROM words x JOIN words y ON x.word = y.word AND x.url_hash <> y.url_hash
                   GROUP BY ALL),
        links AS (SELECT s.a, s.b FROM shared s
                  JOIN {tokens} x ON x.url_hash = s.a JOIN {tokens} y ON y.url_hash = s.b
                  WHERE 2 * s.n >= len(x.tokens) + len(y.tokens) - s.n
                    AND coalesce(abs(epoch(x.published_at) - epoch(y.published_at)), 0) <= 86400),
        reach AS (SELECT url_hash AS a, url_hash AS b FROM {tokens}
                  UNION
                  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)"""


def _age(column: str) -> str:
    seconds = f"date_diff('second', {column}, TIMESTAMP '2024-01-20')"
    return f"""CASE WHEN {column} IS NULL THEN NULL
        WHEN {seconds} < 60 THEN 'just now'
        WHEN {seconds} < 3600 THEN ({seconds} // 60) || 'm ago'
        WHEN {seconds} < 86400 THEN ({seconds} // 3600) || 'h ago'
        WHEN {seconds} < 2592000 THEN ({seconds} // 86400) || 'd ago'
        ELSE strftime({column}, '%Y-%m-%d') END"""


_STAGE_TYPES = [
    ("url_hash", "string"), ("source_id", "string"), ("source_name", "string"),
    ("author", "string"), ("title", "string"), ("description", "string"),
    ("content", "string"), ("is_content_truncated", "boolean"), ("url", "string"),
    ("url_domain", "string"), ("url_to_image", "string"), ("published_at", "timestamp"),
    ("category", "string"), ("source_provider", "string"), ("fetched_at", "timestamp"),
    ("ingestion_run_id", "string"),
]


def _catalog() -> str:
    filled = {"author": "count(*)", "ingestion_run_id": "0"}
    rows = [
        f"SELECT 'stage.stg_articles' AS table_name, CAST({i} AS BIGINT) AS position, "
        f"'{name}' AS column_name, '{kind}' AS type, count(*) AS rows, "
        f"CAST({filled.get(name, f'count(*) - count({name})')} AS BIGINT) AS nulls FROM stage"
        for i, (name, kind) in enumerate(_STAGE_TYPES, start=1)
    ]
    return _query("stage", " UNION ALL ".join(rows))


#: Columns of the published layers: table, what it is built from, name, type, comment.
_LAYER_COLUMNS = [
    *(("stage", "", name, kind, "") for name, kind in _STAGE_TYPES),
    ("dim_source", "stage", "source_name", "string", "outlet name; Unknown stands for a missing one"),
    ("dim_source", "stage", "source_id", "string", "one provider id seen for the outlet"),
    ("dim_source", "stage", "sample_domain", "string", "one host seen for the outlet"),
    *(("mart_articles", "dim_source|stage", *column) for column in (
        ("url_hash", "string", "key of the article"), ("title", "string", "headline"),
        ("description", "string", "short summary"), ("content", "string", "article body"),
        ("is_content_truncated", "boolean", "body is 260 bytes or longer"),
        ("url", "string", "article URL"), ("url_domain", "string", "host of the URL"),
        ("url_to_image", "string", "image URL"), ("published_at", "timestamp", "publish time"),
        ("category", "string", "category"), ("source_provider", "string", "provider"),
        ("source_id", "string", "id of the outlet from the source dimension"),
        ("source_name", "string", "outlet name of the article, may be missing"),
        ("fetched_at", "timestamp", "time of the fetch"))),
    ("daily_stats", "mart_articles", "published_date", "date", "publish date (UTC)"),
    ("daily_stats", "mart_articles", "source_name", "string", "outlet name"),
    ("daily_stats", "mart_articles", "article_count", "bigint",
     "articles of that outlet on that date"),
]


def _layers() -> str:
    values = ", ".join(
        "(" + ", ".join(f"'{text}'" for text in column) + ")" for column in _LAYER_COLUMNS)
    return _query("stage dim mart daily", f"""
        SELECT c.table_name, c.sources, c.column_name, c.type, c.comment, n.rows
        FROM (VALUES {values}) AS c(table_name, sources, column_name, type, comment)
        JOIN (SELECT 'stage' AS table_name, count(*) AS rows FROM stage
              UNION ALL SELECT 'dim_source', count(*) FROM dim
              UNION ALL SELECT 'mart_articles', count(*) FROM mart
              UNION ALL SELECT 'daily_stats', count(*) FROM daily) n USING (table_name)""")


def _quality() -> str:
    versions = "(SELECT url_hash, url, published_at FROM article_versions)"
    tables = [
        ("stage", versions, ["url_hash", "url", "published_at"], "url_hash"),
        ("ods", "ods", ["url_hash", "title", "url", "source_name"], "url_hash"),
        ("mart", "mart", ["url_hash", "url"], "url_hash"),
        ("dim_source", "dim", ["source_name"], "source_name"),
    ]
    rows = []
    for name, relation, required, unique in tables:
        rows += [
            f"SELECT '{name}' AS table_name, '{column}' AS column_name, "
            f"'not_null' AS check_name, count(*) - count({column}) AS failures FROM {relation}"
            for column in required
        ]
        rows.append(
            f"SELECT '{name}', '{unique}', 'unique', count(*) FROM (SELECT {unique} "
            f"FROM {relation} WHERE {unique} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
        )
    return _query("article_versions ods mart dim", " UNION ALL ".join(rows))


_FIRST_SEEN = """
    SELECT url_hash, url, source_provider{more} FROM (
        SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY batch_rank, page_id) AS n
        FROM keyed_items) WHERE n = 1"""

_PENDING = """
    SELECT cluster_id, count(*) AS article_count FROM assigned JOIN articles USING (url_hash)
    WHERE cluster_id NOT IN (SELECT cluster_id FROM summary WHERE status = 'success'{more})
    GROUP BY cluster_id"""

_CHECKED = "SELECT cluster_id, CAST(attempt AS BIGINT) AS attempt, is_valid{more} FROM checked"

_VOTE_ROWS = f"""user_id, cluster_id, CAST(vote AS BIGINT) AS vote,
    strftime(ts, {_MICRO}) AS created_at"""

_RANKED = """
        candidates AS (
            SELECT *, row_number() OVER (ORDER BY enriched_at DESC, cluster_id) AS place
            FROM {feed} ORDER BY enriched_at DESC, cluster_id LIMIT 200),
        pairs AS (
            SELECT u.user_id, c.place, c.cluster_id, c.topic, c.keywords, v.vote,
                CASE WHEN v.vote = 1 THEN 1 ELSE 0 END AS own
            FROM (SELECT DISTINCT user_id FROM votes) u CROSS JOIN candidates c
            LEFT JOIN votes v ON v.user_id = u.user_id AND v.cluster_id = c.cluster_id),
        words AS (
            SELECT p.user_id, p.place, sum(greatest(coalesce(w.weight, 0) - p.own, 0)) AS score
            FROM (SELECT user_id, place, own, unnest(keywords) AS word FROM pairs) p
            LEFT JOIN word_weight w ON w.user_id = p.user_id AND w.word = p.word
            GROUP BY ALL),
        scores AS (
            SELECT p.*, 2 * greatest(coalesce(t.weight, 0) - p.own, 0) + coalesce(w.score, 0)
                AS score
            FROM pairs p
            LEFT JOIN topic_weight t ON t.user_id = p.user_id AND t.topic = p.topic
            LEFT JOIN words w ON w.user_id = p.user_id AND w.place = p.place)"""

ORACLE = {
    "landed_items": _query("keyed_items", f"""
        SELECT source_provider, page_id AS ordinal, url_hash,
            CASE WHEN source_provider = 'newsapi' THEN 'wire' END AS source_id,
            category AS source_name,
            CASE WHEN source_provider = 'newsapi' THEN 'author ' || page_id END AS author,
            title, title AS description, md5(content) AS content_md5, url,
            'img-' || page_id AS url_to_image, strftime(published_at, {_TIME}) AS published_at,
            has_bad_time, category
        FROM keyed_items"""),
    "first_seen_pages": _query(
        "keyed_items", _FIRST_SEEN.format(more=", 'run-1' AS ingestion_run_id")
    ),
    "stream_first_seen": _query("keyed_items", _FIRST_SEEN.format(more="")),
    "rerun_counts": _query("keyed_items", """
        SELECT 'run-1' AS run_id, count(*) AS rows_seen,
            count(DISTINCT url_hash) AS rows_new,
            count(*) - count(DISTINCT url_hash) AS rows_duplicate
        FROM keyed_items WHERE source_provider = 'newsapi'
        UNION ALL
        SELECT 'run-2', rows_seen, rows_new, rows_seen - rows_new FROM (
            SELECT count(*) AS rows_seen, count(DISTINCT CASE WHEN url_hash NOT IN (
                SELECT url_hash FROM keyed_items WHERE source_provider = 'newsapi')
                THEN url_hash END) AS rows_new
            FROM keyed_items)"""),
    "page_keys": f"""SELECT page_id, canonical, url_hash,
            regexp_extract(url, '://([^/:?#]+)', 1) AS host
        FROM ({_canonical("pages")})""",
    "run_copy": _query("article_versions", """
        SELECT url_hash, title, 'run-' || seq AS ingestion_run_id,
            count(*) OVER (PARTITION BY seq) AS rows_copied
        FROM article_versions"""),
    "evolved_schema": _query("articles", """
        SELECT category, 'newsapi' AS source_provider, '' AS key_facts, count(*) AS rows,
            count(url_to_image) AS images
        FROM articles GROUP BY category
        UNION ALL
        SELECT category, source_provider, NULL, count(*), count(url_to_image)
        FROM articles GROUP BY category, source_provider"""),
    "column_catalog": _catalog(),
    "latest_articles": _query("article_versions", f"""
        SELECT url_hash, title, strftime(fetched_at, {_TIME}) AS fetched_at,
            CAST(seq AS BIGINT) AS seq
        FROM (SELECT *, row_number() OVER (PARTITION BY url_hash
                                           ORDER BY fetched_at DESC, seq DESC) AS n
              FROM article_versions) WHERE n = 1"""),
    "appended_versions": _query("article_versions", """
        SELECT url_hash, title, CAST(seq AS BIGINT) AS seq, CAST(seq + 1 AS BIGINT) AS append_no
        FROM (SELECT *, row_number() OVER (PARTITION BY url_hash
                                           ORDER BY fetched_at DESC, seq DESC) AS n
              FROM article_versions) WHERE n = 1"""),
    "appended_answers": _query("answers", r"""
        SELECT cluster_id, CAST(attempt AS BIGINT) AS attempt, is_valid, md5(raw_text) AS raw_md5
        FROM (
            SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY is_valid DESC,
                CASE WHEN is_valid THEN attempt ELSE -attempt END, append DESC) AS place
            FROM (
                SELECT *, CASE WHEN json_valid(block) THEN
                        coalesce(json_type(block, '$.summary') = 'VARCHAR'
                             AND json_type(block, '$.topic') = 'VARCHAR'
                             AND json_type(block, '$.sentiment') = 'VARCHAR', false)
                    ELSE false END AS is_valid
                FROM (SELECT *, regexp_extract(raw_text, '(?s)\{.*\}') AS block FROM (
                    SELECT cluster_id, attempt, raw_text, 1 AS append FROM answers
                    UNION ALL SELECT url_hash, 1 + doc_id % 2, 'taken back', 2 FROM articles))))
        WHERE place = 1"""),
    "layer_catalog": _layers(),
    "daily_job": _query("items keyed_items", """
        SELECT * FROM (WITH runs AS (SELECT * FROM (VALUES (1, 'newsapi', 1), (2, 'gnews', 2), (3, 'gnews', 2))
                      AS r(run, provider, upto)),
        firsts AS (SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY url_hash ORDER BY batch_rank, page_id) AS n
            FROM keyed_items) WHERE n = 1),
        ingested AS (
            SELECT run, (SELECT count(*) FROM items i WHERE i.source_provider = r.provider) AS fetched,
                (SELECT count(*) FROM keyed_items k WHERE k.source_provider = r.provider) AS seen,
                CASE WHEN run = 3 THEN 0 ELSE (SELECT count(*) FROM firsts f
                    WHERE f.source_provider = r.provider) END AS fresh
            FROM runs r),
        built AS (
            SELECT run, (SELECT count(*) FROM firsts f WHERE f.batch_rank <= r.upto) AS articles,
                (SELECT count(DISTINCT coalesce(category, 'Unknown')) FROM firsts f
                 WHERE f.batch_rank <= r.upto) AS sources,
                (SELECT count(*) FROM (
                     SELECT DISTINCT date_trunc('day', published_at), category FROM firsts f
                     WHERE f.batch_rank <= r.upto AND published_at IS NOT NULL)) AS days
            FROM runs r)
        SELECT 'run-' || run AS run_id, 'ingest' AS task_id, 'success' AS status,
            fetched AS rows_fetched, fresh AS rows_new, seen - fresh AS rows_duplicate,
            CAST(NULL AS BIGINT) AS n_sources FROM ingested
        UNION ALL SELECT 'run-' || run, 'layers', 'success', articles, days, 0, sources FROM built
        UNION ALL SELECT 'run-3', 'cluster', 'success', articles, articles, 0, NULL FROM built
        WHERE run = 3)"""),
    "stage_articles": _query("stage", f"""
        SELECT url_hash, source_id, source_name, title, description, md5(content) AS content_md5,
            is_content_truncated, url, url_domain,
            strftime(published_at, {_TIME}) AS published_at, category, source_provider
        FROM stage"""),
    "ods_increment": _query("ods", f"""
        SELECT url_hash, title, strftime(fetched_at, {_TIME}) AS fetched_at FROM ods"""),
    "source_dim": _query("dim", "SELECT source_name, source_id, sample_domain FROM dim"),
    "mart_articles": _query("mart", f"""
        SELECT url_hash, title, source_id, source_name, url_domain, is_content_truncated,
            strftime(published_at, {_TIME}) AS published_at
        FROM mart"""),
    "daily_stats": _query("daily", "SELECT * FROM daily"),
    "stream_daily_stats": _query("daily", "SELECT * FROM daily"),
    "daily_stats_page": _query("daily", """
        SELECT * FROM daily
        ORDER BY published_date DESC, article_count DESC, source_name NULLS LAST LIMIT 100"""),
    "title_tokens": _query("tokens", """
        SELECT url_hash, CAST(len(tokens) AS BIGINT) AS n_tokens,
            array_to_string(tokens, ' ') AS tokens
        FROM tokens"""),
    "story_clusters": _query("tokens", *_stories("tokens")),
    "story_clusters_hot": _query("busy_tokens", *_stories("busy_tokens")),
    "pending_clusters": _query("assigned articles summary", _PENDING.format(more="")),
    "refreshed_clusters": _query(
        "assigned articles summary", _PENDING.format(more=" AND topic <> 'en'")
    ),
    "prompts": _query("members", """
        SELECT cluster_id, CAST(0 AS BIGINT) AS part, CAST(1 AS BIGINT) AS parts,
            count(*) AS article_count,
            'Story:' || chr(10) || string_agg(
                member_no || '. [' || coalesce(source_name, 'unknown source') || '] '
                || coalesce(title, '') || chr(10) || '   ' || coalesce(description, ''),
                chr(10) ORDER BY member_no) || chr(10) || 'End {}.' AS prompt
        FROM members GROUP BY cluster_id"""),
    "enrichment_errors": _query("members", """
        SELECT cluster_id, 'failed' AS enrichment_status, length(raw) AS n_chars,
            md5(raw) AS raw_md5
        FROM (SELECT m.cluster_id, CASE WHEN a.doc_id % 7 <> 0
                  THEN left(repeat(trim(a.title, ' ') || '; ', 100), 2000)
                  ELSE 'No JSON object found in LLM response: ''''' END AS raw
              FROM (SELECT DISTINCT cluster_id FROM members) m
              JOIN articles a ON a.url_hash = m.cluster_id)"""),
    "landed_payloads": _query("keyed_items", """
        SELECT source_provider, page_id AS ordinal, 'wire' AS category,
            CASE source_provider WHEN 'gnews'
                THEN 'author|content|description|image|publishedAt|source|title|url'
                ELSE 'author|content|description|publishedAt|source|title|url|urlToImage' END
                AS names,
            category AS outlet, url, CASE WHEN has_bad_time THEN 'not a time'
                ELSE strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') END AS published,
            md5(content) AS content_md5
        FROM keyed_items"""),
    "stream_daily_late": _query("articles", """
        SELECT strftime(published_at, '%Y-%m-%d') AS published_date, source_name,
            count(*) AS article_count,
            count(*) FILTER (date_trunc('day', published_at) + INTERVAL 1 DAY
                             <= newest - INTERVAL 2 DAY) AS late_count
        FROM (SELECT *, CASE
                  WHEN doc_id % 240 < 120 THEN (SELECT max(published_at) FROM articles
                      WHERE doc_id % 240 >= 120 AND doc_id % 2 = 0)
                  WHEN doc_id % 2 = 1 THEN (SELECT max(published_at) FROM articles
                      WHERE doc_id % 240 < 120 OR doc_id % 2 = 0) END AS newest
              FROM articles WHERE published_at IS NOT NULL)
        GROUP BY 1, 2"""),
    "responses_checked": _query("checked", _CHECKED.format(more="""
        , CASE WHEN is_valid THEN json_extract_string(block, '$.summary') END AS summary,
        CASE WHEN is_valid THEN json_extract_string(block, '$.topic') END AS topic,
        CASE WHEN is_valid THEN CAST(json_extract(block, '$.sentiment_score') AS DOUBLE) END
            AS sentiment_score""")),
    "stream_responses": _query("checked", _CHECKED.format(more="")),
    "enrichment_outcomes": _query("outcome", """
        SELECT cluster_id,
            CASE WHEN ok THEN json_extract_string(block, '$.summary') ELSE '' END AS summary,
            CASE WHEN ok THEN array_to_string(json_extract_string(block, '$.keywords[*]'), '|')
                 ELSE '' END AS keywords,
            CASE WHEN ok THEN json_extract_string(block, '$.topic') ELSE '' END AS topic,
            CASE WHEN ok THEN 'success' ELSE 'failed' END AS enrichment_status,
            CASE WHEN NOT ok THEN raw_text END AS raw_llm_response, article_count,
            CASE WHEN ok THEN first_key || ':one|' || first_key || ':again' ELSE '' END
                AS perspectives
        FROM outcome"""),
    "enrichment_gate": _query("outcome", """
        SELECT count(*) AS attempted, count(*) FILTER (ok) AS succeeded,
            count(*) FILTER (NOT ok) AS failed,
            count(*) > 0 AND count(*) FILTER (NOT ok) > 0.2 * count(*) AS is_over_limit
        FROM outcome"""),
    "story_cards": _query("feed", f"""
        SELECT CASE WHEN article_count >= 5 THEN 'High consensus'
                    WHEN article_count >= 3 THEN 'Medium consensus'
                    ELSE 'Low consensus' END AS consensus,
            {_age("feed.first_published_at")} AS age,
            'Covered by ' || article_count || CASE WHEN article_count = 1 THEN ' source'
                ELSE ' sources' END AS coverage, {_CARD}
        FROM feed"""),
    "feed_page": _query("feed", f"""
        SELECT {_CARD} FROM feed ORDER BY feed.enriched_at DESC, cluster_id LIMIT 20 OFFSET 5"""),
    "feed_search": _query("feed", f"""
        SELECT {_CARD} FROM feed
        WHERE topic = 'en' AND (summary ILIKE '%TH_N%'
            OR len(list_filter(feed.keywords, lambda k: k ILIKE '%TH_N%')) > 0)
        ORDER BY feed.enriched_at DESC, cluster_id LIMIT 100"""),
    "feed_keyset_page": _query("feed", f"""
        SELECT {_CARD} FROM feed
        WHERE feed.enriched_at < TIMESTAMP '2024-03-01 05:00:00'
           OR (feed.enriched_at = TIMESTAMP '2024-03-01 05:00:00' AND cluster_id > '')
        ORDER BY feed.enriched_at DESC, cluster_id LIMIT 20"""),
    "topic_stats": _query("summary", """
        SELECT topic, count(*) AS cluster_count FROM summary WHERE status = 'success'
        GROUP BY topic"""),
    "story_detail": _query("feed", """
        SELECT cluster_id, summary, why_it_matters, before_state, after_state, organizations,
            consensus, why_it_matters <> '' AS has_analysis,
            why_it_matters <> '' AND before_state IS NOT NULL AND after_state IS NOT NULL
                AS has_change,
            organizations <> '' AS has_key_facts, doc_id % 6 > 0 AS has_consensus
        FROM feed"""),
    "story_lookup": _query("feed", """
        SELECT cluster_id, summary, why_it_matters FROM feed
        WHERE cluster_id = (SELECT min(cluster_id) FROM feed)"""),
    "story_head_jaccard": _query("tokens assigned", """
        SELECT url_hash, cluster_id,
            CASE WHEN least(n, m) = 0 THEN 0.0 ELSE round(shared / (n + m - shared), 6) END AS jaccard,
            shared > 0 AND 3 * shared >= n + m AS is_similar
        FROM (SELECT a.url_hash, cluster_id, len(t.tokens) AS n, len(h.tokens) AS m,
                  len(list_intersect(t.tokens, h.tokens)) AS shared
              FROM assigned a JOIN tokens t ON t.url_hash = a.url_hash
              JOIN tokens h ON h.url_hash = a.cluster_id)"""),
    "story_sources": _query("assigned mart summary", f"""
        SELECT cluster_id, m.url_hash, source_name,
            coalesce(source_name, 'Unknown source') AS source_label, source_provider, m.title,
            url, url_to_image, strftime(published_at, {_TIME}) AS published_at,
            {_age("m.published_at")} AS age, category,
            CASE m.doc_id - s.doc_id WHEN 0 THEN 'last' WHEN 1 THEN 'next' END AS source_summary
        FROM assigned a JOIN mart m USING (url_hash) JOIN summary s USING (cluster_id)
        WHERE status = 'success'"""),
    "valid_feedback": _query("vote_events", """
        SELECT CASE WHEN vote IS NULL OR abs(vote) = 1 THEN 'valid' ELSE 'invalid' END AS verdict,
            CAST(vote AS BIGINT) AS vote, count(*) AS events
        FROM vote_events GROUP BY ALL"""),
    "current_votes": _query("votes", f"SELECT {_VOTE_ROWS} FROM votes"),
    "stream_votes": _query("votes", f"SELECT {_VOTE_ROWS} FROM votes"),
    "toggled_votes": f"""
        WITH presses AS (
            SELECT user_id, event_id, ts,
                sha256(CAST(CAST(json_extract(props, '$.k') AS BIGINT)
                  % greatest(4, (SELECT (count(*) // 3 + 1) // 80 FROM documents)) AS VARCHAR))
                    AS cluster_id,
                CASE WHEN event_type IN ('click', 'purchase', 'view') THEN 1 ELSE -1 END AS vote
            FROM events),
        turns AS (
            SELECT *, CASE WHEN vote IS DISTINCT FROM lag(vote) OVER w THEN 1 ELSE 0 END AS turn
            FROM presses WINDOW w AS (PARTITION BY user_id, cluster_id ORDER BY ts, event_id)),
        runs AS (
            SELECT *, sum(turn) OVER (PARTITION BY user_id, cluster_id
                ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run
            FROM turns),
        ends AS (
            SELECT user_id, cluster_id, run, any_value(vote) AS vote, max(ts) AS ts,
                count(*) AS presses,
                row_number() OVER (PARTITION BY user_id, cluster_id ORDER BY run DESC) AS n
            FROM runs GROUP BY user_id, cluster_id, run)
        SELECT {_VOTE_ROWS} FROM ends WHERE n = 1 AND presses % 2 = 1""",
    "liked_page": _query("votes feed", """
        SELECT user_id, like_rank, cluster_id, summary, CAST(1 AS BIGINT) AS my_vote
        FROM (SELECT user_id, cluster_id, row_number() OVER (
                  PARTITION BY user_id ORDER BY ts DESC, cluster_id) AS like_rank
              FROM votes WHERE vote = 1) JOIN feed USING (cluster_id)
        WHERE like_rank BETWEEN 3 AND 12"""),
    "affinity_profile": _query("topic_weight word_weight", """
        SELECT user_id, 'topic' AS kind, topic AS name, weight FROM topic_weight
        UNION ALL SELECT user_id, 'keyword', word, weight FROM word_weight"""),
    "affinity_feed": _query("feed votes topic_weight word_weight", """
        SELECT user_id, rank, CAST(score AS BIGINT) AS score, cluster_id, topic,
            CAST(vote AS BIGINT) AS my_vote
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, place)
                  AS rank FROM scores)
        WHERE rank BETWEEN 4 AND 23""", _RANKED.format(feed="feed")),
    "affinity_feed_deep": _query("summary articles votes topic_weight word_weight", """
        SELECT user_id, rank, CAST(score AS BIGINT) AS score, cluster_id
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, place)
                  AS rank FROM scores)
        WHERE rank BETWEEN 4 AND 103""",
        _RANKED.format(feed="summary")),
    "run_log": _query("log", f"""
        SELECT run_id, task_id, try_number, 'daily' AS dag_id,
            strftime(execution_date, {_TIME}) AS execution_date,
            strftime(started_at, {_MICRO}) AS started_at,
            strftime(finished_at, {_MICRO}) AS finished_at, status, rows_fetched, rows_new,
            CAST(0 AS BIGINT) AS rows_duplicate, CAST(rows_failed AS BIGINT) AS rows_failed,
            error_length, extra_metadata
        FROM log"""),
    "run_history": _query("log", f"""
        SELECT run_id, task_id, try_number, status, strftime(started_at, {_MICRO}) AS started_at,
            rows_fetched
        FROM log ORDER BY log.started_at DESC, run_id, task_id, try_number LIMIT 20"""),
    "quality_report": _quality(),
    "member_audit": _query("assigned summary", """
        SELECT cluster_id, article_count, members
        FROM (SELECT cluster_id, count(DISTINCT url_hash) AS members FROM assigned GROUP BY 1)
        JOIN summary USING (cluster_id) WHERE article_count <> members"""),
}
