"""SQL for the queries that SQL can express."""

from __future__ import annotations

import string

from . import quality, urls

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = "list_distinct(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}]+'))"

#: Holds where there are no more labelled documents of either kind than the fit's bound.
_LEDGER = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
known AS (SELECT doc_id, max(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
sizes AS (SELECT count(*) FILTER (WHERE toxic = 1) AS n1, count(*) FILTER (WHERE toxic = 0) AS n0 FROM known),
sample AS (SELECT DISTINCT k.toxic, text FROM documents JOIN known k USING (doc_id)),
seen AS (SELECT toxic, unnest({_WORDS}) AS word FROM sample),
counted AS (SELECT word, CAST(sum(toxic) AS BIGINT) AS t, CAST(sum(1 - toxic) AS BIGINT) AS o FROM seen WHERE length(word) >= 3 GROUP BY word),
chosen AS (SELECT word FROM counted, sizes WHERE t >= 8 AND t >= 0.02 * n1 AND t / (n1 + 1.0) >= 40.0 * (o + 0.5) / (n0 + 1.0)),
own AS (SELECT r, unnest({_WORDS}) AS word FROM d),
toxic AS (SELECT r, count(*) AS n FROM own WHERE word IN (SELECT word FROM chosen) GROUP BY r),
w AS (SELECT r, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words, list_filter(string_split(text, chr(10)), lambda x: translate(x, {_SPACES}, '') <> '') AS lines FROM d),
windows AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS w FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM again) GROUP BY r),
m AS (SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(translate(text, {_SPACES}, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
 CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
 length(text) - length(translate(text, '{_UPPER}', '')) AS n_capitals, len(list_distinct(words)) AS n_distinct_words, coalesce(t.n, 0) AS n_toxic_words
 FROM d JOIN w ON w.r = d.r LEFT JOIN covered c ON c.r = d.r LEFT JOIN toxic t ON t.r = d.r),
f AS (SELECT *, CAST({" + ".join(f"CASE WHEN {condition} THEN {1 << i} ELSE 0 END" for i, condition in enumerate(quality.RULES.values()))} AS BIGINT) AS failures FROM m)"""
QUALITY = f"""{_LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, failures = 0 AS kept, failures FROM f"""
ABLATIONS = f"""{_LEDGER}
SELECT rule, count(*) FILTER (WHERE failures & bit <> 0) AS n_failed, count(*) FILTER (WHERE failures = bit) AS n_only
FROM f, (VALUES {", ".join(f"('{name}', {1 << i}::BIGINT)" for i, name in enumerate(quality.RULES))}) AS v(rule, bit) GROUP BY rule"""


def _strength(level: str) -> str:
    low, high = urls.STRENGTH
    return f"""{level}_sums AS (SELECT CAST(sum(n) AS DOUBLE) AS n, sum(bad) / CAST(sum(n) AS DOUBLE) AS m, CAST(sum(n * n) AS DOUBLE) AS n2, count(*) AS k, sum(bad * bad / CAST(n AS DOUBLE)) AS q FROM {level} WHERE n > 0),
{level}_between AS (SELECT m, k, CASE WHEN n > n2 / n THEN (q - n * m * m - (k - 1) * m * (1 - m)) / (n - n2 / n) ELSE 0 END AS b FROM {level}_sums),
{level}_strength AS (SELECT CASE WHEN m IS NULL OR k < 2 OR b <= 0 THEN {high} ELSE least(greatest(m * (1 - m) / b - 1, {low}), {high}) END AS s FROM {level}_between)"""


# the rules as the query's contract states them, the longest first
_FITS = """CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/7') THEN {0}
 WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/de/8') THEN {1}
 WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/en/') THEN {2}
 WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/de/') THEN {3}
 WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/es/') THEN {4} END"""
_RULE = _FITS.format("'example.com/en/7'", "'example.net/de/8'", "'com/en/'", "'net/de/'", "'org/es/'")
_VERDICT = _FITS.format("'allow'", "'block'", "'block'", "'allow'", "'block'")

URLS = f"""WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
q AS (SELECT *, regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':[0-9]*$', '') AS name FROM p),
known AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
counted AS (SELECT name, count(known.bad) AS n, CAST(coalesce(sum(known.bad), 0) AS BIGINT) AS bad, string_split(name, '.') AS l FROM q LEFT JOIN known ON known.doc_id = q.page_id GROUP BY name),
cut AS (SELECT *, CASE WHEN regexp_full_match(name, '[0-9.]+') THEN 0 WHEN len(l) >= 3 AND length(l[-1]) = 2 AND l[-2] IN ('{"', '".join(urls.SECOND)}') THEN 2 ELSE 1 END AS parts FROM counted),
hosts AS (SELECT name, n, bad, CASE WHEN parts = 0 THEN name ELSE array_to_string(l[-(parts + 1):], '.') END AS domain, CASE WHEN parts = 0 THEN '' ELSE array_to_string(l[-parts:], '.') END AS suffix FROM cut),
domains AS (SELECT domain, suffix, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bad) AS BIGINT) AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bad) AS BIGINT) AS bad FROM domains GROUP BY suffix),
overall AS (SELECT (coalesce(sum(bad), 0) + {urls.UNLABELLED}) / (coalesce(sum(n), 0) + 1.0) AS m FROM suffixes),
{_strength("hosts")}, {_strength("domains")}, {_strength("suffixes")},
s AS (SELECT suffix, (bad + k.s * o.m) / (n + k.s) AS m FROM suffixes, suffixes_strength k, overall o),
d AS (SELECT domain, suffix, (bad + k.s * s.m) / (n + k.s) AS m FROM domains JOIN s USING (suffix), domains_strength k),
ab AS (SELECT name, bad + k.s * d.m AS a, n - bad + k.s * (1 - d.m) AS b FROM hosts JOIN d USING (domain, suffix), hosts_strength k),
blocked AS (SELECT name FROM ab WHERE a / (a + b) - {urls.DEVIATIONS} * sqrt(a / (a + b) * (b / (a + b)) / (a + b + 1)) > {urls.ACCEPTED})
SELECT page_id, host, path, {_RULE} AS rule, coalesce({_VERDICT}, CASE WHEN name IN (SELECT name FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict FROM q"""

#: Holds where no row without vec_id and no repeated anchor row is found.
NEGATIVES = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
a AS (SELECT DISTINCT vec_id, label, x FROM e WHERE vec_id % 100 = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, e.label, e.vec_id AS other, CAST(list_sum(list_transform(list_zip(a.x, e.x), lambda p: p[1] * p[2])) AS BIGINT) AS score FROM a JOIN e ON len(a.x) = len(e.x)),
p AS (SELECT anchor_id, own, other AS positive_id, score AS positive_score FROM s WHERE label = own AND other <> anchor_id QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
r AS (SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own WHERE 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT * FROM r WHERE rank <= 5"""
