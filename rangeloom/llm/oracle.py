"""SQL that must give the rows of the queries that SQL can express, whole tables and whole texts."""

from __future__ import annotations

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position FROM documents),
keyed AS (SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
frequent AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, frequent.last IS NOT NULL AND doc_id <> frequent.last AS gone FROM keyed LEFT JOIN frequent USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: One row with the table of CRC-32, from its polynomial.
_CRC_TABLE = "crc AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) r(i)))"


def _crc(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text, beside the row of _CRC_TABLE."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(strlen({text})), lambda k: CAST('0x' || substr({digits}, 2 * k + 1, 2) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)))"


SPELLING = (
    r"WITH " + _CRC_TABLE + r""",
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
each AS (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL),
hashed AS (SELECT run, k, """ + _crc("doc_id || ':' || run") + r""" AS h FROM each, crc),
written AS (SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM written WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
without AS (SELECT word, unnest(range(1, length(word) + 1)) AS spot FROM words),
cut AS (SELECT word, spot, substr(word, 1, spot - 1) || substr(word, spot + 1) AS rest FROM without),
pairs AS (
  SELECT a.word AS word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.spot = b.spot AND a.word <> b.word
  UNION SELECT cut.word, w.word FROM cut JOIN words w ON cut.rest = w.word
  UNION SELECT w.word, cut.word FROM cut JOIN words w ON cut.rest = w.word),
near AS (SELECT pairs.word, count(*) AS n_near, first(o.word ORDER BY o.n DESC, o.word) AS best, max(o.n) AS best_n FROM pairs JOIN words o ON o.word = pairs.other GROUP BY pairs.word),
formed AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form, CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM words LEFT JOIN near USING (word)),
chain AS (SELECT f0.word, coalesce(f8.form, f7.form, f6.form, f5.form, f4.form, f3.form, f2.form, f1.form, f0.form, f0.word) AS root FROM formed f0
  LEFT JOIN formed f1 ON f1.word = f0.form LEFT JOIN formed f2 ON f2.word = f1.form LEFT JOIN formed f3 ON f3.word = f2.form LEFT JOIN formed f4 ON f4.word = f3.form
  LEFT JOIN formed f5 ON f5.word = f4.form LEFT JOIN formed f6 ON f6.word = f5.form LEFT JOIN formed f7 ON f7.word = f6.form LEFT JOIN formed f8 ON f8.word = f7.form)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN chain USING (word)
"""
)

_RESAMPLING = r"""
words AS (SELECT kind, doc_id, list_filter(string_split(trim(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' '), ' '), lambda x: x <> '') AS w
  FROM (SELECT 0 AS kind, doc_id, coalesce(text, '') AS text FROM documents UNION ALL SELECT 1, item_id, coalesce(text, '') FROM benchmark)),
grams AS (SELECT kind, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS gram FROM words),
bucketed AS (SELECT gram, """ + _crc("gram") + r""" % 10000 AS bucket FROM (SELECT DISTINCT gram FROM grams), crc),
held AS (SELECT kind, doc_id, bucket FROM grams JOIN bucketed USING (gram)),
counted AS (SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM held GROUP BY bucket),
totals AS (SELECT count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b FROM held),
gained AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (a + 10000) AS DOUBLE) / CAST((s + 1) * (b + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM counted, totals),
weighed AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM held JOIN gained USING (bucket) WHERE kind = 0 GROUP BY doc_id),
scored AS (SELECT words.doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || words.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM words LEFT JOIN weighed USING (doc_id) WHERE kind = 0),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * able // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)
"""
RESAMPLING = "WITH " + _CRC_TABLE + ", " + _RESAMPLING.lstrip()

SQL = {"op11_importance_resampling": RESAMPLING, "op12_spelling_variants": SPELLING, "op13_line_dedup": LINE_DEDUP}
