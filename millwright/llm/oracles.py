"""SQL for the corpus queries that SQL can express, over the same tables."""

from __future__ import annotations

from .common import LOWER, UPPER

# Fixed values of the contracts, as in the operators.
_WORD = r"'[^\x20\x09-\x0D]+'"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINES = f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
numbered AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS no FROM split
),
keyed AS (
    SELECT doc_id, no, line, translate(trim(line, {_SPACES}), '{UPPER}', '{LOWER}') AS key FROM numbered
),
repeated AS (
    SELECT key, max(doc_id) AS last_id FROM keyed
    WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE r.last_id <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.no)
                       FILTER (WHERE r.last_id IS NULL OR r.last_id = k.doc_id), '')) AS kept_sha256
FROM keyed k LEFT JOIN repeated r ON k.key = r.key
GROUP BY k.doc_id"""

MIXING = f"""
WITH sizes AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS BIGINT) AS size,
           md5('7:' || CAST(doc_id AS VARCHAR)) AS key
    FROM documents
),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM sizes GROUP BY source
),
weighed AS (
    SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
           CAST(sum(source_size) OVER () AS BIGINT) AS total
    FROM sources
),
levels AS (
    SELECT *,
           coalesce(sum(2 * source_size) OVER earlier, 0) AS capped, coalesce(sum(weight) OVER earlier, 0) AS gone,
           sum(weight) OVER () AS all_weight
    FROM (SELECT *, source_size * 2 / CAST(weight AS DOUBLE) AS room FROM weighed) w
    WINDOW earlier AS (ORDER BY room, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
levelled AS (
    SELECT source, place, source_size, total, least(source_size * 2.0e0, level * weight) AS target
    FROM (SELECT *, max((total * 1.5e0 - CAST(capped AS DOUBLE)) / CAST(all_weight - gone AS DOUBLE)) OVER () AS level FROM levels) l
),
targets AS (
    SELECT *, greatest(1, CASE WHEN words < 8 * common THEN CAST(floor(words / 32) AS BIGINT) ELSE common END) AS width
    FROM (SELECT *, least(CAST(source_size AS DOUBLE), target) AS words, (3 * total) // 8192 AS common FROM levelled) c
),
sized AS (
    SELECT *, (source_size + width - 1) // width AS n_blocks FROM targets
),
seats AS (
    SELECT place, n_blocks, total, width, target, unnest(range(1, 2 * n_blocks + 1)) AS seat FROM sized WHERE n_blocks > 0
),
quotas AS (
    SELECT place, n_blocks, count(*) AS quota
    FROM (SELECT *, coalesce(sum(width) OVER (ORDER BY target / ((2 * seat - 1) * width) DESC, place, seat
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS dealt FROM seats) r
    WHERE 2 * dealt + width <= 3 * total GROUP BY place, n_blocks
),
blocks AS (
    SELECT place, quota, n_blocks, unnest(range(0, n_blocks)) AS block FROM quotas
),
taken_blocks AS (
    SELECT place, block,
           (quota - row_number() OVER (PARTITION BY place ORDER BY md5('7:' || place || ':' || block), block) + n_blocks)
           // n_blocks AS times
    FROM blocks
),
stream AS (
    SELECT s.*, t.place, t.source_size, t.target, t.width,
           coalesce(sum(s.size) OVER (PARTITION BY t.place ORDER BY s.key, s.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
met AS (
    SELECT *, unnest(range(CAST(first // width AS BIGINT), CAST((first + greatest(size, 1) - 1) // width AS BIGINT) + 1)) AS block
    FROM stream
)
SELECT m.doc_id, m.size, m.source_size, m.target,
       CAST(sum(coalesce(b.times, 0) * greatest(0, least(m.first + m.size, (m.block + 1) * m.width)
                                                   - greatest(m.first, m.block * m.width))) AS BIGINT) AS taken
FROM met m LEFT JOIN taken_blocks b ON m.place = b.place AND m.block = b.block
GROUP BY m.doc_id, m.size, m.source_size, m.target"""

QUALITY = f"""
WITH words AS (
    SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w,
           [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, {_WORD})] AS lines
    FROM documents
),
windows AS (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words) p
),
repeated AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) n WHERE n >= 2
),
covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM repeated) r GROUP BY doc_id
),
counted AS (
    SELECT w.doc_id, w.source, CAST(len(w.w) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum([length(x) FOR x IN w.w]), 0) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(w.text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(w.lines) - len(list_distinct(w.lines)) AS BIGINT) AS n_dup_lines,
           coalesce(c.n, 0) AS n_repeat_words
    FROM words w LEFT JOIN covered c ON w.doc_id = c.doc_id
),
page_hosts AS (
    SELECT page_id, min(host) AS page_host
    FROM (SELECT page_id, translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host FROM pages) h
    WHERE host <> '' GROUP BY page_id
),
judged AS (
    SELECT c.*, coalesce(page_host, source) AS host, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM counted c LEFT JOIN page_hosts p ON c.doc_id = p.page_id
),
hosts AS (
    SELECT host, count(*) AS n_docs, count(*) FILTER (WHERE base_failed) AS n_failed FROM judged GROUP BY host
),
prior AS (
    SELECT m, CASE WHEN v <= 0 THEN 1e6 ELSE greatest(1.0e0, least(1e6, m * (1 - m) / v - 1)) END AS s
    FROM (SELECT avg(n_failed / CAST(n_docs AS DOUBLE)) AS m, var_pop(n_failed / CAST(n_docs AS DOUBLE)) AS v FROM hosts) x
),
verdicts AS (
    SELECT host, (n_failed + m * s) / (n_docs + s) > least(0.8e0, m + 3 * sqrt(m * (1 - m) / (s + 1))) AS host_failed
    FROM hosts, prior
)
SELECT j.doc_id, j.n_words, j.word_chars, j.n_symbols, j.n_dup_lines, j.n_repeat_words, j.base_failed,
       NOT j.base_failed AND NOT v.host_failed AS kept
FROM judged j JOIN verdicts v ON j.host IS NOT DISTINCT FROM v.host"""

CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
escaped AS (
    SELECT *, len(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*(?:/?INST|/?ANS|/?TURN|AS)\]')) AS text_chars,
           len(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*(?:/?INST|/?ANS|/?TURN|AS)\]')) AS role_chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(len('<s></s>') + sum(text_chars + CASE role WHEN 'user' THEN len('[INST][/INST]') WHEN 'assistant' THEN len('[ANS][/ANS]')
            ELSE len('[TURN][AS][/TURN]') + role_chars END) AS BIGINT) AS formatted_chars
FROM escaped
GROUP BY conv_id"""

RANKING = r"""WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
    FROM documents
),
items AS (
    SELECT row_number() OVER () AS i, item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
    FROM benchmark
),
asked AS (SELECT i, term, count(*) AS times FROM (SELECT i, unnest(terms) AS term FROM items) GROUP BY i, term),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS all_terms FROM docs),
spread AS (SELECT r, doc_id, 25 + (75 * len(terms) * n_docs) // all_terms AS m FROM docs, totals WHERE len(terms) > 0),
postings AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY r, term
),
weights AS (
    SELECT term, floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM postings, totals GROUP BY term
),
scored AS (
    SELECT i, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN spread USING (r)
    GROUP BY i, r
),
ranked AS (
    SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
    FROM scored JOIN spread USING (r) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN items USING (i) WHERE rank <= 10"""

ORACLES: dict[str, str] = {
    "op2_line_dedup": LINES,
    "op7_source_mixing": MIXING,
    "op10_quality_rules": QUALITY,
    "op11_chat_formatting": CHAT,
    "op13_ranked_search": RANKING,
}
