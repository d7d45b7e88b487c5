"""Building blocks of the SQL that queries are held against: the bindings, said in SQL."""

from __future__ import annotations


def key(x: str) -> str:
    """The key of a line id."""
    return f"(CAST(substr(right({x}, 7), 1, 4) AS INTEGER) * 300 + CAST(strpos('abc', substr(right({x}, 7), 5, 1)) - 1 AS INTEGER) * 100 + CAST(right({x}, 2) AS INTEGER))"


def line_id(n: str) -> str:
    return f"printf('D%dn%d_p%04d%s%02d', juan, juan, {n} // 21 + 1, substr('abc', ({n} % 21) // 7 + 1, 1), {n} % 7 + 1)"


LINES = f"""raw AS (SELECT source AS work, CAST(doc_id AS INTEGER) AS juan, unnest(string_split(text, chr(10))) AS text,
    CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS n FROM documents WHERE text IS NOT NULL),
named AS (SELECT work, juan, n, text, {line_id("n")} AS line_id FROM raw),
lines AS (SELECT work, juan, n, line_id, {key("line_id")} AS line_key, text FROM named)"""

SEGMENTS = f"""lasts AS (SELECT work, juan, max(n) AS last FROM raw GROUP BY work, juan),
firsts AS (SELECT work, juan, last, CAST(unnest(range(0, last + 1, 5)) AS INTEGER) AS first FROM lasts),
ends AS (SELECT work, juan, first, greatest(least(first + 4 + CASE juan % 7 WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END, last), first) AS e FROM firsts),
ided AS (SELECT work, juan, CAST(first // 5 + 1 AS INTEGER) AS number,
    CASE WHEN juan % 7 = 3 AND first = 0 THEN printf('D%dn%d_p0000a01', juan, juan) ELSE {line_id("first")} END AS start_id, {line_id("e")} AS end_id FROM ends),
segments AS (SELECT work, juan, number, 'Part ' || number AS title, start_id, end_id, {key("start_id")} AS start_key, {key("end_id")} AS end_key,
    CASE WHEN number % 3 = 0 THEN 'note ' || number ELSE '' END AS note FROM ided)"""

SECTIONS = """sourced AS (SELECT s.work, s.juan, s.number, string_agg(l.text, chr(10) ORDER BY l.line_key) AS source
    FROM segments s JOIN lines l ON l.work = s.work AND l.juan = s.juan AND l.line_key BETWEEN s.start_key AND s.end_key AND l.text <> '' GROUP BY s.work, s.juan, s.number),
joined AS (SELECT s.*, coalesce(o.source, '') AS source FROM segments s LEFT JOIN sourced o ON o.work = s.work AND o.juan = s.juan AND o.number = s.number),
sections AS (SELECT work, juan, number - 1 AS idx, title,
    CASE WHEN start_id = end_id THEN start_id ELSE start_id || '-p' || right(end_id, 7) END AS range_label, start_id, end_id, start_key, end_key, source,
    CASE WHEN number % 5 = 0 THEN '' ELSE translate(source, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') END AS translation, note FROM joined)"""

BOUNDS = "bounds AS (SELECT work, juan, arg_min(line_id, line_key) AS first_id, arg_max(line_id, line_key) AS last_id FROM lines WHERE text <> '' GROUP BY work, juan)"

TERMS = """word_items AS (SELECT item_id, unnest(list_distinct(regexp_split_to_array(lower(text), '[\\s.,]+'))) AS w FROM benchmark),
words AS (SELECT w, min(item_id) AS item_id FROM word_items WHERE length(w) >= 8 GROUP BY w),
works AS (SELECT DISTINCT source AS work, CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 4 AS quarter FROM documents),
terms AS (SELECT work, CAST(row_number() OVER (PARTITION BY work ORDER BY w) - 1 AS INTEGER) AS pos, w AS id, CASE WHEN item_id % 3 = 0 THEN 'no ' || w ELSE translate(w, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') END AS pattern FROM words JOIN works ON quarter = item_id % 4)"""

EVENTS = """job_events AS (SELECT user_id AS job_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS juan, ts, event_id AS seq, event_type,
    CASE event_type WHEN 'click' THEN 'running' WHEN 'view' THEN 'queued' WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' ELSE 'held' END AS state FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY job_id, juan ORDER BY ts DESC, seq DESC) AS r FROM job_events),
volumes AS (SELECT job_id, juan, state, ts, CASE WHEN state = 'held' THEN ts + INTERVAL 1 HOUR END AS resume_at FROM ranked WHERE r = 1)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


LINES_SQL = with_(LINES)
SEGMENTS_SQL = with_(LINES, SEGMENTS)
SECTIONS_SQL = with_(LINES, SEGMENTS, SECTIONS)
CHECK_SQL = with_(LINES, SEGMENTS, SECTIONS, BOUNDS)
TERMS_SQL = with_(LINES, SEGMENTS, SECTIONS, TERMS)
EVENTS_SQL = with_(EVENTS)
DRAFTS_SQL = with_("""drafts AS (SELECT 'C' AS work, CAST(u.conv_id AS INTEGER) AS juan, CAST(u.turn AS INTEGER) AS idx, u.text AS source, a.text AS draft
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant')""")
