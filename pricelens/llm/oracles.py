"""The same results stated in SQL for DuckDB, where SQL can express them."""

_BLANK = r"'[^\x20\x09-\x0D]+'"
_LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MIXING = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {_BLANK})), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, (source_size * 2)::DOUBLE AS cap,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight FROM s),
l AS (SELECT *, cap / weight AS ratio,
        (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM r),
t AS (SELECT source, source_size, coalesce(least(cap, weight * (SELECT level FROM l WHERE ratio > level ORDER BY ratio, source NULLS LAST LIMIT 1)), cap) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216::DOUBLE)::BIGINT ELSE 0 END AS each,
        ('0x' || substr(md5('11:' || coalesce(source, chr(0) || 'null')), 1, 6))::BIGINT AS shift FROM t),
k AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.each,
        row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC, coalesce(d.doc_id, 0) % 64, d.doc_id NULLS FIRST) * e.each + e.shift AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, ((upto >> 24) - ((upto - each) >> 24)) * size AS taken, (upto >> 24) - ((upto - each) >> 24) AS copies FROM k
"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOW.format('text')}, {_LETTERS}), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW.format('text')}, {_LETTERS}) AS w, least(10, len(w)) AS m FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM b WHERE m > 0),
g AS (SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS gram FROM i),
x AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d, (SELECT DISTINCT m FROM g) WHERE len(w) >= m),
h AS (SELECT x.doc_id, x.p, x.m, g.item_id FROM x JOIN g ON g.m = x.m AND g.gram = array_to_string(x.w[x.p:x.p + x.m - 1], ' ')),
n AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS place FROM h) GROUP BY doc_id),
f AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN f USING (doc_id)
"""

SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT w.doc_id, w.i, coalesce(w.i > lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) + 50, true) AS new FROM w JOIN f ON w.s = f.s AND f.first < w.doc_id),
run AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM hit) GROUP BY doc_id, k),
gap AS (SELECT r.doc_id, r.a, r.z, coalesce(lag(r.z) OVER (PARTITION BY r.doc_id ORDER BY r.a), 0) AS since FROM run r),
k AS (SELECT g.doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS last, string_agg(substr(h, (2 * since + 1)::BIGINT, (2 * (a - since))::BIGINT), '' ORDER BY a) AS kept
      FROM gap g JOIN d USING (doc_id) GROUP BY g.doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, (2 * last + 1)::BIGINT), h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

NGRAM_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOW.format('text')}, {_BLANK}), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * common >= 90 * (na.n + nb.n - common)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, {_BLANK}), []) AS w FROM documents),
x AS (SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
f AS (SELECT g FROM x GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS place FROM x SEMI JOIN f USING (g)),
u AS (SELECT doc_id, place, w[place] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS place FROM d)),
k AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept FROM u ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, len(d.w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, upper(sha1(coalesce(html, ''))) AS h FROM pages),
f AS (SELECT body, min(page_id) AS first FROM p GROUP BY body),
b AS (SELECT page_id, body, first, [('0x' || substr(h, (i * 5 + 1)::BIGINT, 5))::BIGINT for i in range(8)] AS q FROM p JOIN f USING (body))
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 0) & 31) + 1, 1) for v in q], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

LINE_QUALITY = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_BLANK}) AS w FROM documents),
l AS (SELECT doc_id, source, line, regexp_extract_all({_LOW.format('line')}, {_BLANK}) AS v FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line FROM d)),
m AS (SELECT doc_id, source, line, array_to_string(v, ' ') AS norm, len(v) AS k FROM l WHERE len(v) > 0),
u AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM m GROUP BY doc_id),
h AS (SELECT source, count(*) AS docs FROM d GROUP BY source),
c AS (SELECT m.source, norm FROM m JOIN h ON m.source IS NOT DISTINCT FROM h.source GROUP BY m.source, norm, docs HAVING count(DISTINCT doc_id) > 10 AND count(DISTINCT doc_id) > docs * 0.05::DOUBLE),
o AS (SELECT doc_id, sum(k)::BIGINT AS lost FROM m JOIN c ON m.source IS NOT DISTINCT FROM c.source AND m.norm = c.norm GROUP BY doc_id),
x AS (SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8)),
y AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS times FROM x),
r AS (SELECT doc_id, count(DISTINCT place) AS n_repeat FROM (SELECT doc_id, unnest(range(p, p + 8)) AS place FROM y WHERE times > 1) GROUP BY doc_id),
e AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(z) for z in w]), 0)::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words, coalesce(lost, 0) AS n_common_words
      FROM d LEFT JOIN u USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN o USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM e)
SELECT *, NOT base_failed AND NOT (n_common_words > 0 AND (n_words - n_common_words < 20 OR n_words - n_common_words < n_words * 0.3::DOUBLE)) AS kept FROM b
"""

#: What the tables' pages say of themselves: the article element. The operator does not rely on it.
HTML_TEXT = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)</article>', 1) AS x FROM pages),
b AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '\s+', ' ', 'g'), '<br[^>]*>', ' ', 'g'),
        '</?(p|h[1-6]|div|ul|ol|li|blockquote|section)(\s[^>]*)?>', chr(10), 'g'), '<[^>]*>', '', 'g'), chr(10)) AS parts FROM a),
c AS (SELECT page_id, url, array_to_string([z FOR z IN [trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(q,
        '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'), ' +', ' ', 'g')) FOR q IN parts] IF z <> ''], chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM c
"""

FILTER_AUDIT = f"""
WITH letter(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_BLANK}) AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, CASE WHEN len(w) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM d LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT m.*, filter_order, coalesce(list_min([instr(filter_order, z) FOR z IN string_split(fails, '') IF z <> '']), 6) AS gone FROM m, o),
r AS (SELECT part, filter_order, step, sum(CASE WHEN gone > step THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN gone = step THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN gone < step AND contains(fails, substr(filter_order, step, 1)) THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN fails = substr(filter_order, step, 1) THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN gone = step THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN gone = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM x, (SELECT unnest(range(1, 6))::INT AS step) GROUP BY part, filter_order, step)
SELECT *, sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1))::BIGINT AS shapley FROM r
"""

SPELLING = f"""
WITH RECURSIVE r AS (SELECT doc_id, unnest(regexp_extract_all({_LOW.format('text')}, '[A-Za-z\u00C0-\u00FF]+')) AS w FROM documents),
c AS (SELECT doc_id, w, count(*) AS n FROM r WHERE length(w) >= 6 GROUP BY doc_id, w),
b AS (SELECT w, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS bytes FROM c),
h AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(bytes) * 4), lambda i: CASE WHEN i % 8 = 0 THEN ('0x' || substr(bytes, (i // 4 + 1)::BIGINT, 2))::BIGINT ELSE 0::BIGINT END)),
        lambda s, z: xor(xor(s, z) >> 1, 3988292384::BIGINT * (xor(s, z) & 1))), 4294967295::BIGINT) AS crc FROM b),
t AS (SELECT n, CASE WHEN crc % 199 = 0 THEN substr(w, 1, (crc % length(w))::BIGINT) || substr(w, (crc % length(w) + 2)::BIGINT) ELSE w END AS word FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM t WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
e AS (SELECT word, n, length(word) AS m, p, substr(word, 1, p - 1) || substr(word, p + 1) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM v)),
k AS (SELECT a.word, b.word AS near, b.n AS near_n FROM e a JOIN e b ON a.cut = b.cut AND a.p = b.p AND a.m = b.m AND a.word <> b.word
      UNION SELECT e.word, v.word, v.n FROM e JOIN v ON e.cut = v.word UNION SELECT v.word, e.word, e.n FROM e JOIN v ON e.cut = v.word),
g AS (SELECT word, count(*) AS n_near, max(near_n) AS best_n FROM k GROUP BY word),
q AS (SELECT k.word, g.n_near, g.best_n, min(k.near) AS best FROM k JOIN g ON k.word = g.word AND k.near_n = g.best_n GROUP BY k.word, g.n_near, g.best_n),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 5 * v.n THEN best END AS form, CASE WHEN best_n >= 5 * v.n THEN best_n END AS form_n FROM v LEFT JOIN q USING (word)),
z(word, root) AS (SELECT word, word FROM f WHERE form IS NULL UNION ALL SELECT f.word, z.root FROM f JOIN z ON f.form = z.word)
SELECT f.word, f.form, z.root, f.n, f.n_near, f.form_n::BIGINT AS form_n FROM f JOIN z USING (word)
"""

ORACLE = {
    "op1_mixing": MIXING,
    "op2_decontamination": DECONTAMINATION,
    "op4_suffix_dedup": SUFFIX_DEDUP,
    "op5_ngram_join": NGRAM_JOIN,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op8_warc": WARC,
    "op10_line_quality": LINE_QUALITY,
    "op11_html_text": HTML_TEXT,
    "op12_filter_audit": FILTER_AUDIT,
    "op13_spelling": SPELLING,
}
