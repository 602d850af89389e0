"""The operators' queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakework.llm import dedup, exact, licenses, media, mixing, packing, pii, quality, repeats, spelling, turns, urlfilter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_table(spark, sf_dir, "documents"))


def op2_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op4_fuzzy_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).withColumn("spans", F.to_json("spans"))


def op5_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_url_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, urlfilter.rule_table(spark)).drop("url")


def op7_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("rate")


def op8_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(_table(spark, sf_dir, "documents"))


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_wav_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(_table(spark, sf_dir, "documents"))


def op11_recursive_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damaged(_table(spark, sf_dir, "conversations")))


def op12_wavelet_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_patricia_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_divergence,
        op2_hyperminhash_dedup,
        op3_run_length_index,
        op4_fuzzy_licenses,
        op5_bm25_packing,
        op6_url_expressions,
        op7_poisson_mixing,
        op8_semi_markov_pii,
        op9_warc_revisits,
        op10_wav_fingerprints,
        op11_recursive_turns,
        op12_wavelet_spelling,
        op13_patricia_owners,
    )
}


_QUALITY = r"""
WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM docs, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)
), repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows), LATERAL (SELECT unnest(range(0, 5)) AS k) WHERE n > 1 GROUP BY doc_id
), base AS (
  SELECT d.doc_id, d.lang, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, length(t) AS n_chars
  FROM docs d LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base
), classes(class, pattern) AS (
  VALUES ('lower', '[^a-z]'), ('upper', '[^A-Z]'), ('digit', '[^0-9]'), ('space', '[^ \t\r\x0B\x0C]'), ('newline', '[^\n]'), ('stop', '[^.,;:!?''"()-]'), ('symbol', '[^#*$%&|<>]'), ('non_ascii', '[\x00-\x7F]'), ('ascii', '[^\x00-\x7F]')
), counted AS (
  SELECT doc_id, lang, class, length(regexp_replace(t, pattern, '', 'g')) AS n FROM docs, classes
), bins AS (
  SELECT doc_id, lang, 'c' AS kind, class AS bin, n FROM counted WHERE class <> 'ascii'
  UNION ALL
  SELECT doc_id, lang, 'c', 'other_ascii', 2 * sum(n) FILTER (WHERE class = 'ascii') - sum(n) FILTER (WHERE class <> 'non_ascii') FROM counted GROUP BY doc_id, lang
  UNION ALL
  SELECT doc_id, lang, 'w', CASE WHEN list_contains([COMMON], bare) THEN bare ELSE '' END, count(*)
  FROM (SELECT doc_id, lang, trim(translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.,;:!?''"()-') AS bare FROM docs) GROUP BY ALL
), reference AS (
  SELECT lang, kind, bin, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang, kind) AS total FROM bins GROUP BY lang, kind, bin
  QUALIFY total >= CASE kind WHEN 'w' THEN 10000 ELSE 50000 END
), shares AS (
  SELECT b.doc_id, r.kind, coalesce(x.n, 0) / b.total AS p, r.n / r.total AS q
  FROM (SELECT doc_id, lang, kind, sum(n) AS total FROM bins GROUP BY ALL HAVING sum(n) > 0) b
  JOIN reference r ON b.lang IS NOT DISTINCT FROM r.lang AND b.kind = r.kind
  LEFT JOIN bins x ON x.doc_id = b.doc_id AND x.kind = r.kind AND x.bin = r.bin
), distances AS (
  SELECT doc_id, kind, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS d FROM shares GROUP BY ALL
), measured AS (
  SELECT j.*, CASE WHEN n_chars >= 200 THEN c.d END AS cd, CASE WHEN n_words >= 100 THEN w.d END AS wd
  FROM judged j LEFT JOIN distances c ON c.doc_id = j.doc_id AND c.kind = 'c' LEFT JOIN distances w ON w.doc_id = j.doc_id AND w.kind = 'w'
), cuts AS (
  SELECT lang, least(0.5, greatest(0.25, q3 + 1.5 * (q3 - q1))) AS word_cut
  FROM (SELECT lang, quantile_disc(floor(wd * 10000), 0.25) / 10000 AS q1, quantile_disc(floor(wd * 10000), 0.75) / 10000 AS q3 FROM measured WHERE NOT base_failed AND wd IS NOT NULL GROUP BY lang)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(cd > 0.3, false) AND NOT coalesce(wd > coalesce(word_cut, 0.5), false) AS kept, round(cd, 6) AS class_distance, round(wd, 6) AS word_distance
FROM measured m LEFT JOIN cuts c ON m.lang IS NOT DISTINCT FROM c.lang
""".replace("COMMON", ", ".join(f"'{w}'" for w in dict.fromkeys(quality.COMMON_WORDS)))

_MIX = """
WITH sizes AS (
  SELECT source, count(*) AS n_docs, sqrt(count(*)::DOUBLE) AS weight FROM documents GROUP BY source
), rates AS (
  SELECT source, weight / (SELECT sum(weight) FROM sizes) * (SELECT sum(n_docs) FROM sizes) / n_docs AS rate FROM sizes
), terms AS (
  SELECT source, rate, k::INT AS k,
         sum(exp(-rate + k * ln(rate) - lgamma(k + 1.0))) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM rates, LATERAL (SELECT unnest(range(0, ceil(rate + 9 * sqrt(rate) + 21)::BIGINT)) AS k)
), numbered AS (
  SELECT *, ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::UBIGINT::DOUBLE / 4503599627370496.0 AS u FROM documents
), counted AS (
  SELECT d.doc_id, any_value(d.source) AS source, count(*) FILTER (WHERE t.cdf <= d.u) AS n
  FROM numbered d JOIN terms t ON d.source IS NOT DISTINCT FROM t.source GROUP BY d.doc_id
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy::INT AS copy, n.n::INT AS copies,
       md5('mix-order:' || d.doc_id::VARCHAR || ':' || c.copy::VARCHAR) AS shuffle_key
FROM documents d JOIN counted n USING (doc_id), LATERAL (SELECT unnest(range(0, n.n)) AS copy) c
"""

_URLS = r"""
WITH rules(r_host, r_path, r_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), split AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM split
), best AS (
  SELECT page_id, arg_max(r_host || r_path, length(r_host || r_path)) AS rule, arg_max(r_verdict, length(r_host || r_path)) AS verdict
  FROM parts JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  GROUP BY page_id
)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b USING (page_id)
"""

_DEDUP = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 2))) AS i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 75 * ((SELECT n FROM sizes WHERE doc_id = a.doc_id) + (SELECT n FROM sizes WHERE doc_id = b.doc_id) - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""

_WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS original FROM pages
), bits AS (
  SELECT *, list_transform(range(0, 32), lambda i: list_sum(list_transform(range(0, 5), lambda j:
    (((instr('0123456789abcdef', substr(h, ((i * 5 + j) // 4 + 1)::INT, 1)) - 1) >> (3 - (i * 5 + j) % 4)) & 1) << (4 - j)))) AS quintets FROM p
)
SELECT page_id, payload_bytes, array_to_string(list_transform(quintets, lambda q: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', q::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to
FROM bits
"""

#: DuckDB has no CRC-32: its table of 16 entries, built by rule, is applied to the low and the high half of each byte.
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(i, [1, 2, 3, 4]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS crc
  FROM (SELECT unnest(range(0, 16))::BIGINT AS i)
)"""
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(range(0, octet_length(encode(KEY))), lambda j: list_transform([2 * j + 2, 2 * j + 1], lambda p: (instr('0123456789ABCDEF', substr(hex(encode(KEY)), p::INT, 1)) - 1)::BIGINT)))),
  lambda c, x: xor(c // 16, crc[(xor(c, x) % 16 + 1)::INT])), 4294967295)"""

_TURNS = r"""
WITH RECURSIVE CRC_TABLE, keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), hashed AS (
  SELECT *, CRC % 20 AS kind FROM keyed, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM hashed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, substr(role, 1, 1) AS r FROM damaged
), said AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth FROM placed
), faults AS (
  SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY pos) || r AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM said
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id
), every AS (
  SELECT c.conv_id, coalesce(n, 0) AS n FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts d ON c.conv_id IS NOT DISTINCT FROM d.conv_id
), steps(state, r, after) AS (
  VALUES ('-', 's', 's'), ('-', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
), one AS (
  SELECT state, after, CASE r WHEN 'u' THEN ['user:'] ELSE ['assistant:'] END AS lines FROM steps WHERE r <> 's'
), inserts AS (
  SELECT state, state AS after, '' AS edits, 0 AS cost, []::VARCHAR[] AS lines FROM (VALUES ('-'), ('s'), ('u'), ('a')) t(state)
  UNION ALL SELECT state, after, 'I', 2, lines FROM one
  UNION ALL SELECT a.state, b.after, 'II', 4, a.lines || b.lines FROM one a JOIN one b ON a.after = b.state
), moves AS (
  SELECT conv_id, pos, e.state, e.after, e.edit, e.cost + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 1 ELSE 0 END AS cost, CASE WHEN edit = 'D' THEN []::VARCHAR[] ELSE [coalesce(e.role, f.role) || ':' || text] END AS lines
  FROM faults f JOIN (
    SELECT state, state AS after, 'D' AS edit, 3 AS cost, NULL AS r, NULL AS role FROM (VALUES ('-'), ('s'), ('u'), ('a')) t(state)
    UNION ALL SELECT state, after, 'K', 0, r, NULL FROM steps
    UNION ALL SELECT state, after, 'R', 2, NULL, CASE r WHEN 'u' THEN 'user' ELSE 'assistant' END FROM steps WHERE r <> 's'
  ) e ON (e.r IS NULL OR e.r = f.r) AND (edit = 'D' OR fault NOT IN ('blank', 'duplicate'))
), best(conv_id, i, state, b) AS (
  SELECT conv_id, 0::BIGINT, after, {'cost': cost::BIGINT, 'audit': edits, 'lines': lines} FROM every, inserts WHERE state = '-'
  UNION ALL
  SELECT p.conv_id, p.i + 1, t.after, min({'cost': p.b.cost + m.cost + t.cost, 'audit': p.b.audit || m.edit || t.edits, 'lines': p.b.lines || m.lines || t.lines})
  FROM best p JOIN moves m ON p.conv_id IS NOT DISTINCT FROM m.conv_id AND p.i + 1 = m.pos AND p.state = m.state JOIN inserts t ON t.state = m.after
  GROUP BY p.conv_id, p.i, t.after
), chosen AS (
  SELECT e.conv_id, min(p.b) AS b FROM every e JOIN best p ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = e.n WHERE p.state IN ('-', 'a') GROUP BY e.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       b.cost AS cost, b.audit AS audit, sha256(array_to_string(b.lines, chr(10))) AS repaired_sha256
FROM chosen c LEFT JOIN counts d ON c.conv_id IS NOT DISTINCT FROM d.conv_id
""".replace("CRC_TABLE", _CRC_TABLE).replace("CRC", _CRC.replace("KEY", "k"))

_SPELLING = r"""
WITH RECURSIVE CRC_TABLE, runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), hashed AS (
  SELECT run, n, CRC AS h FROM (SELECT doc_id, run, count(*) AS n, doc_id::VARCHAR || ':' || run AS k FROM runs GROUP BY ALL), crc_table
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), dropped AS (
  SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, LATERAL (SELECT unnest(range(0, length(word)))::INT AS i)
), pairs AS (
  SELECT a.word, b.word AS other, b.n FROM dropped a JOIN dropped b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM dropped a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM dropped a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, min({'less': -n, 'other': other}) AS b FROM pairs GROUP BY word
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 2 * n THEN b.other END AS form, CASE WHEN -b.less >= 2 * n THEN -b.less END AS form_n FROM words LEFT JOIN best USING (word)
), chain(word, tip) AS (
  SELECT word, word FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.tip WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.tip AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c USING (word) JOIN forms e ON e.word = c.tip AND e.form IS NULL
""".replace("CRC_TABLE", _CRC_TABLE).replace("CRC", _CRC.replace("KEY", "k"))

_EXACT = r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents
)
SELECT doc_id, first(doc_id) OVER (PARTITION BY t ORDER BY chars DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = first(doc_id) OVER (PARTITION BY t ORDER BY chars DESC, doc_id) AS kept, sha256(t) AS text_sha256
FROM bare
"""

ORACLES: dict[str, str] = {
    "op1_quality_divergence": _QUALITY,
    "op2_hyperminhash_dedup": _DEDUP,
    "op6_url_expressions": _URLS,
    "op7_poisson_mixing": _MIX,
    "op9_warc_revisits": _WARC,
    "op11_recursive_turns": _TURNS,
    "op12_wavelet_spelling": _SPELLING,
    "op13_patricia_owners": _EXACT,
}
