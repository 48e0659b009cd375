"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BENCH_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = f"""
WITH item AS (SELECT item_id, {_BENCH_WORDS} AS words FROM benchmark),
doc AS (SELECT doc_id, {_BENCH_WORDS} AS words FROM documents),
item_start AS (SELECT item_id, words, least(10, len(words)) AS n, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS i FROM item WHERE len(words) > 0),
item_window AS (SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS gram FROM item_start),
sizes AS (SELECT DISTINCT n FROM item_window),
doc_start AS (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM doc, sizes WHERE len(words) >= n),
doc_window AS (SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS gram FROM doc_start),
found AS (SELECT doc_id, item_id, d.n, i FROM doc_window d JOIN item_window USING (gram, n)),
word AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM found),
hit AS (SELECT doc_id, count(*) AS n_hit FROM word GROUP BY doc_id),
name AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM name GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP5 = f"""
WITH line AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS content
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (SELECT *, translate(trim(content, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS k FROM line),
held AS (SELECT k, min(doc_id) AS first_doc, count(DISTINCT doc_id) AS n FROM keyed WHERE length(k) >= 10 GROUP BY k),
judged AS (SELECT keyed.*, coalesce(n >= 2 AND doc_id > first_doc, false) AS gone FROM keyed LEFT JOIN held USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(content, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP8 = rf"""
WITH doc AS (SELECT doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
start AS (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM doc WHERE len(words) >= 5),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS gram FROM start),
twice AS (SELECT doc_id, gram FROM windows GROUP BY doc_id, gram HAVING count(*) >= 2),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS at FROM windows JOIN twice USING (doc_id, gram)),
repeated AS (SELECT doc_id, count(*) AS n_repeat_words FROM covered GROUP BY doc_id),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS content FROM doc),
lines AS (SELECT doc_id, count(*) - count(DISTINCT content) AS n_dup_lines FROM line WHERE trim(content, {_BLANKS}) <> '' GROUP BY doc_id),
facts AS (
  SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM doc LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM facts),
host AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS BIGINT)) AS bad FROM base GROUP BY source),
moments AS (SELECT least(greatest(avg(bad / n), 0.001), 0.999) AS m, var_pop(bad / n) AS v FROM host),
prior AS (SELECT m, least(greatest(m * (1 - m) / greatest(v, 0.000001) - 1, 1.0), 10000.0) AS s FROM moments),
rated AS (SELECT source, m * s + bad AS a, (1 - m) * s + n - bad AS b FROM host, prior),
verdict AS (SELECT source, a / (a + b) - 2.0 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5 AS host_failed FROM rated)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT host_failed AS kept
FROM base JOIN verdict ON base.source IS NOT DISTINCT FROM verdict.source
"""


def _fill(parents: str, name: str, nodes: str) -> str:
    """Water-filling among the rows of ``nodes`` with equal ``parents`` columns, in whole numbers."""
    by = f"PARTITION BY {parents}" if parents else ""
    return f"""
  (WITH s AS (
     SELECT *, coalesce(sum(capacity) OVER ({by} ORDER BY capacity::DOUBLE / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled_before,
            sum(weight) OVER ({by} ORDER BY capacity::DOUBLE / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
     FROM ({nodes})),
   f AS (SELECT *, capacity * weight_left <= (parent_budget - filled_before) * weight AS fills FROM s),
   g AS (SELECT *, coalesce(sum(CASE WHEN fills THEN capacity END) OVER ({by}), 0) AS filled, coalesce(sum(CASE WHEN NOT fills THEN weight END) OVER ({by}), 0) AS open_weight FROM f)
   SELECT * EXCLUDE (parent_budget), CASE WHEN fills THEN capacity ELSE least(capacity, ((parent_budget - filled) * weight) // greatest(open_weight, 1)) END AS budget FROM g)"""


_TOKENS = f"CAST(len({_WORDS}) AS HUGEINT)"
OP10 = f"""
WITH crc(source, domain) AS (SELECT source, 'd' || CAST(crc AS VARCHAR) FROM ({{crc}}) t(source, crc)),
doc AS (SELECT doc_id, domain, lang, source, {_TOKENS} AS tokens, CAST(doc_id AS VARCHAR) || '|' || md5(coalesce(text, '')) AS k FROM documents JOIN crc USING (source)),
leaf AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS tokens, (sum(tokens) * 4)::HUGEINT AS capacity FROM doc GROUP BY ALL),
total AS (SELECT CAST(floor(sum(tokens)::DOUBLE * 1.25) AS HUGEINT) AS t FROM doc),
d AS (SELECT domain, budget FROM {_fill("", "domain", "SELECT domain, sum(capacity)::HUGEINT AS capacity, (CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 ELSE 2 END)::HUGEINT AS weight, (SELECT t FROM total) AS parent_budget FROM leaf GROUP BY domain")}),
l AS (SELECT domain, lang, budget FROM {_fill("domain", "lang", "SELECT domain, lang, sum(capacity)::HUGEINT AS capacity, (CASE lang WHEN 'en' THEN 2 ELSE 3 END)::HUGEINT AS weight, any_value(d.budget)::HUGEINT AS parent_budget FROM leaf JOIN d USING (domain) GROUP BY domain, lang")}),
s AS (SELECT domain, lang, source, budget FROM {_fill("domain, lang", "source", "SELECT domain, lang, source, capacity, 1::HUGEINT AS weight, l.budget::HUGEINT AS parent_budget FROM leaf JOIN l USING (domain, lang)")}),
q AS (SELECT domain, lang, source, budget AS quota, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole, tokens AS leaf_tokens FROM s JOIN leaf USING (domain, lang, source)),
placed AS (SELECT doc.*, whole, quota - whole * leaf_tokens AS rest, ('0x' || substr(md5('17|' || CAST(whole AS VARCHAR) || '|' || k), 1, 15))::BIGINT AS place FROM doc JOIN q USING (domain, lang, source)),
run AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, k ROWS UNBOUNDED PRECEDING) AS upto FROM placed),
taken AS (SELECT doc_id, domain, lang, source, tokens, whole AS epoch FROM run WHERE upto <= rest AND whole < 4
          UNION ALL SELECT doc_id, domain, lang, source, tokens, unnest(range(0, whole::BIGINT)) FROM placed WHERE whole > 0)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens, CAST(epoch AS INTEGER) AS epoch FROM taken
"""


# DuckDB has no crc32: a byte's remainder by rule, and the checksum as a fold over the bytes of the UTF-8 text.
_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_BYTES_OF = "list_transform(range(0, strlen({s})), lambda i: CAST('0x' || substr(hex(encode({s})), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))"
OP12 = rf"""
WITH rest AS (SELECT list_transform(range(0, 256), lambda b: list_reduce(range(0, 8), lambda c, k: {_CRC_STEP}, b)) AS r),
run AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
long AS (SELECT run, CAST(doc_id AS VARCHAR) || ':' || run AS s, count(*) AS times FROM run WHERE length(run) >= 7 GROUP BY ALL),
summed AS (SELECT run, times, xor(list_reduce({_BYTES_OF.format(s="s")}, lambda c, b: xor(c >> 8, r[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM long, rest),
spelled AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, times FROM summed),
w AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
hole AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
without AS (SELECT word, n, i, substr(word, 1, CAST(i AS INTEGER) - 1) || substr(word, CAST(i AS INTEGER) + 1) AS cut FROM hole),
pair AS (
  SELECT a.word AS u, b.word AS v, b.n AS n FROM without a JOIN without b ON a.cut = b.cut AND a.i = b.i AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION SELECT a.word, w.word, w.n FROM without a JOIN w ON a.cut = w.word
  UNION SELECT w.word, a.word, a.n FROM without a JOIN w ON a.cut = w.word),
best AS (SELECT u, count(*) AS n_near, max(n) AS best_n, min(v ORDER BY v) FILTER (WHERE n = most) AS best FROM (SELECT *, max(n) OVER (PARTITION BY u) AS most FROM pair) GROUP BY u),
judged AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM w LEFT JOIN best ON u = word),
path AS (SELECT word, word AS here, 0 AS step FROM judged UNION ALL SELECT path.word, j.form, step + 1 FROM path JOIN judged j ON path.here = j.word WHERE j.form IS NOT NULL),
last AS (SELECT word, arg_max(here, step) AS root FROM path GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN last USING (word)
""".replace("WITH rest", "WITH RECURSIVE rest")

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13 = rf"""
WITH doc AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
total AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS all_terms FROM doc WHERE len(terms) > 0),
place AS (SELECT doc_id, unnest(terms) AS term, 100 - 25 + (25 * len(terms)::BIGINT * total.docs) // all_terms AS m FROM doc, total),
tf AS (SELECT doc_id, term, m, count(*) AS tf FROM place GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
weight AS (SELECT item_id, term, times, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w FROM asked JOIN df USING (term), total),
score AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM weight JOIN tf USING (term) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM score WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20
"""


def _crc_of_sources() -> str:
    """DuckDB has no crc32: the checksums of the tables' source names, as rows."""
    import zlib

    return " UNION ALL ".join(f"SELECT 'src{i}', {zlib.crc32(f'src{i}'.encode()) % 4}" for i in range(64))


def oracle_sql() -> dict[str, str]:
    return {"op3_decontaminate": OP3, "op5_line_dedup": OP5, "op8_quality_rules": OP8, "op10_mixing": OP10.replace("{crc}", _crc_of_sources()), "op12_variants": OP12, "op13_length_index": OP13}
