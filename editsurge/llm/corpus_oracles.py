"""DuckDB SQL for resampling, fingerprints and the fill-in-middle transformation."""

from __future__ import annotations

from editsurge.llm import imatch, infill, resampling

LOWERED = f"translate(coalesce(text, ''), '{imatch.UPPER}', '{imatch.LOWER}')"
FEATURE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def hex_integer(digest: str, group: int) -> str:
    """An 8-digit group (from 0) of a hexadecimal digest as integer."""
    return f"CAST('0x' || {digest}[{8 * group + 1}:{8 * group + 8}] AS BIGINT)"


def infill_sql() -> str:
    p, s, m = infill.PREFIX, infill.SUFFIX, infill.MIDDLE
    h = [hex_integer("h", k) for k in range(4)]
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{infill.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cuts AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, {h[0]} % (length(text) + 1) AS c1, {h[1]} % (length(text) + 1) AS c2,
  CASE WHEN text = '' OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}') OR {h[2]} % 100 >= {infill.CUT_PERCENT} THEN 'plain'
       WHEN {h[3]} % 100 < {infill.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM d),
parts AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b, substring(text, 1, least(c1, c2)) AS pre,
  substring(text, least(c1, c2) + 1, greatest(c1, c2) - least(c1, c2)) AS mid, substring(text, greatest(c1, c2) + 1) AS suf FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{p}' || pre || '{s}' || suf || '{m}' || mid
         ELSE '{s}' || suf || '{p}' || pre || '{m}' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts"""


def resampling_sql() -> str:
    """crc32 byte by byte for each distinct word, over a table made by its rule."""
    b, seed = resampling.BUCKETS, resampling.SEED
    return f"""
WITH RECURSIVE crc_rule(i, k, v) AS (SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_rule WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_rule WHERE k = 8),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWERED}, '{FEATURE}') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS w FROM d),
g AS (SELECT unnest(regexp_extract_all({LOWERED}, '{FEATURE}')) AS w FROM benchmark),
places AS (SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(w)), '..'),
    lambda p: CAST('0x' || p AS BIGINT))), lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) % {b} AS bucket
  FROM (SELECT w FROM w UNION SELECT w FROM g), crc_table),
source AS (SELECT bucket, count(*) AS n FROM w JOIN places USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS n FROM g JOIN places USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM source)::BIGINT AS s_all, (SELECT coalesce(sum(n), 0) FROM target)::BIGINT AS t_all),
gains AS (SELECT source.bucket, CAST(floor(1000 * ln(CAST((coalesce(target.n, 0) + 1) * (s_all + {b}) AS DOUBLE)
    / CAST((source.n + 1) * (t_all + {b}) AS DOUBLE))) AS BIGINT) AS gain FROM source LEFT JOIN target USING (bucket), sums),
weights AS (SELECT rid, sum(gain)::BIGINT AS weight FROM w JOIN places USING (w) JOIN gains USING (bucket) GROUP BY rid),
scored AS (SELECT rid, doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    ({hex_integer(f"sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), ''))", 0)} + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (rid)),
able AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features, weight) AS r, count(*) OVER () AS n
  FROM scored WHERE n_features >= {resampling.LEAST_WORDS})
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN r <= n * {resampling.DRAW_PERCENT} // 100 THEN r END AS rank
FROM scored LEFT JOIN able USING (rid)"""


def imatch_sql(rare: int = imatch.RARE, common: int = imatch.COMMON) -> str:
    terms = lambda text: (
        f"list_distinct(regexp_extract_all(translate({text}, '{imatch.UPPER}', '{imatch.LOWER}'), '{FEATURE}'))")
    near = lambda a, b: (
        f"CASE WHEN {a}.mark = {b}.mark THEN 1.0::DOUBLE WHEN {a}.entries IS NULL AND {b}.entries IS NULL THEN 0.0::DOUBLE ELSE "
        f"len(list_intersect(coalesce({a}.entries, []), coalesce({b}.entries, [])))::DOUBLE / "
        f"len(list_distinct(list_transform(list_concat(coalesce({a}.entries, []), coalesce({b}.entries, [])), lambda e: e[1:2]))) END")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
counted AS (SELECT w, count(*) AS df FROM (SELECT unnest({terms("text")}) AS w FROM documents) GROUP BY w),
lexicon AS (SELECT w, md5('{imatch.SALT}' || w)[1:{imatch.CODE_DIGITS}] AS code FROM counted, (SELECT count(*) AS n FROM documents)
  WHERE df * {rare} >= n AND df * {common} <= n),
distinct_docs AS (SELECT DISTINCT doc_id, text FROM d),
ordered AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, md5(text) DESC) AS at, count(*) OVER () AS n FROM distinct_docs),
pairs AS (SELECT a.doc_id, a.text, b.text AS after, substring(a.text, 1, length(a.text) - length(a.text) // 3)
    || substring(b.text, 1, length(a.text) // 3) AS edited FROM ordered a JOIN ordered b ON b.at = a.at % a.n + 1),
texts AS (SELECT text FROM pairs UNION SELECT edited FROM pairs),
runs AS (SELECT text, code[1:2] AS subset, string_agg(code, '' ORDER BY code) AS codes
  FROM (SELECT text, unnest({terms("text")}) AS w FROM texts) JOIN lexicon USING (w) GROUP BY text, subset),
lists AS (SELECT text, list(subset || md5(codes)[1:{imatch.HASH_DIGITS}] ORDER BY subset) AS entries FROM runs GROUP BY text),
marks AS (SELECT text, entries, coalesce(array_to_string(entries, '{imatch.MARK}'), '=' || sha256(text)) AS mark FROM texts LEFT JOIN lists USING (text))
SELECT d.doc_id, CAST(length(d.text) AS BIGINT) AS n_chars, sha256(p.edited) AS edited_sha256, x.mark AS fingerprint, y.mark AS edited_fingerprint,
  {near("x", "y")} AS near_edited, {near("x", "z")} AS near_next
FROM d JOIN pairs p ON d.doc_id IS NOT DISTINCT FROM p.doc_id AND d.text = p.text
JOIN marks x ON x.text = d.text JOIN marks y ON y.text = p.edited JOIN marks z ON z.text = p.after"""
