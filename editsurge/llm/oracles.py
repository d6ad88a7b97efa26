"""DuckDB SQL for the corpus operators that SQL can express."""

from __future__ import annotations

from editsurge.llm import secret_scan as s
from editsurge.llm.sharding import PRIME, round_keys


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(kind: int, pattern: str, group: int = 0) -> str:
    """Matches with their positions: the running length of the texts between and of the matches."""
    p = _quoted(pattern)
    return f"""
SELECT rid, {kind} AS k, i, m, c, sum(length(between_) + length(m)) OVER (PARTITION BY rid ORDER BY i) - length(m) AS s
FROM (SELECT rid, unnest(regexp_extract_all(text, {p})) AS m, unnest(regexp_extract_all(text, {p}, {group})) AS c,
             unnest(string_split_regex(text, {p})[1:-2]) AS between_, generate_subscripts(regexp_extract_all(text, {p}), 1) AS i
      FROM d WHERE regexp_matches(text, {p}))"""


def secret_scan_sql() -> str:
    kinds = "[" + ", ".join(map(_quoted, s.KINDS)) + "]"
    listed = lambda t: f"string_agg({kinds}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) FROM {t} t WHERE t.rid = d.rid"
    sides = ", ".join(
        f"{fn}({edge}) FILTER (WHERE k IN ({roles})) OVER (PARTITION BY rid, block ORDER BY s, e, k ROWS BETWEEN {frame}) AS {name}"
        for fn, edge, frame, side in (("max", "e", "UNBOUNDED PRECEDING AND 1 PRECEDING", "before"),
                                      ("min", "s", "1 FOLLOWING AND UNBOUNDED FOLLOWING", "after"))
        for roles, name in (("1, 3", f"{side}_i"), ("0, 2, 4", f"{side}_z")))
    near = lambda x: f"(coalesce(s - before_{x} <= {s.SCOPE}, false) OR coalesce(after_{x} - e <= {s.SCOPE}, false))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join([_matches(0, s.ASSIGN, 2), _matches(1, s.ACCESS), _matches(2, s.HEX), _matches(3, s.IDENT),
                               _matches(4, s.KEY), _matches(5, s.ENDPOINT), _matches(-1, s.BLANK_LINE)])}),
spans AS (SELECT rid, k, CAST(s AS BIGINT) AS s, CAST(s + length(m) AS BIGINT) AS e, m, c FROM found),
base AS (SELECT rid, k, s, e FROM spans WHERE (k = 0 AND length(c) >= {s.ASSIGN_LEAST}) OR (k = 1 AND length(m) >= {s.ACCESS_LEAST}) OR k = 2),
weak AS (SELECT rid, k, s, e FROM spans x WHERE k = 5 OR (k IN (3, 4)
  AND (k = 3 OR (regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')))
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = x.rid AND b.s < x.e AND x.s < b.e))),
parts AS (SELECT *, sum(CASE WHEN k = -1 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY s, e, k) AS block
  FROM (SELECT * FROM base UNION ALL SELECT * FROM weak UNION ALL SELECT rid, k, s, e FROM spans WHERE k = -1)),
sides AS (SELECT rid, k, s, e, {sides} FROM parts),
linked AS (SELECT rid, k, s, e FROM sides WHERE (k = 3 AND {near("z")}) OR (k = 4 AND {near("i")}) OR (k = 5 AND {near("i")} AND {near("z")})),
everything AS (SELECT * FROM base UNION ALL SELECT * FROM linked)
SELECT doc_id, (SELECT count(*) FROM base t WHERE t.rid = d.rid AND k = 0) AS n_assign,
  (SELECT count(*) FROM base t WHERE t.rid = d.rid AND k = 1) AS n_access, (SELECT count(*) FROM base t WHERE t.rid = d.rid AND k = 2) AS n_hex,
  sha256(coalesce((SELECT {listed("base")}), '')) AS base_sha256, coalesce((SELECT {listed("everything")}), '') AS spans
FROM d"""


def sharding_sql(shards: int = 8) -> str:
    """Row numbers, Feistel rounds and cycle walking; crc32 byte by byte over a table made by its rule."""
    rounds = []
    for k, (x, y) in enumerate(round_keys()):
        own, other, size = ("r", "l", "b") if k % 2 else ("l", "r", "a")
        mixed = f"(({other}{k} + {x}) % {PRIME})"
        f = f"((({mixed} * {mixed}) % {PRIME}) * {y} + {mixed}) % {PRIME}"
        rounds.append(f"({own}{k} + {f}) % {size} AS {own}{k + 1}, {other}{k} AS {other}{k + 1}")
    n = len(rounds)
    step = lambda source, where: (
        f"SELECT row, l{n} * b + r{n} AS x FROM (SELECT row, a, b, x // b AS l0, x % b AS r0, {', '.join(rounds)} FROM {source}, dims {where})")
    return f"""
WITH RECURSIVE crc_rule(i, k, v) AS (SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_rule WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM crc_rule WHERE k = 8),
facts AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
        lambda p: CAST('0x' || p AS BIGINT))), lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS row FROM facts),
dims AS (SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b FROM (SELECT count(*) AS n, CAST(greatest(1, ceil(sqrt(count(*)))) AS BIGINT) AS a FROM documents)),
seeds AS (SELECT row, row AS x FROM numbered),
walk(row, x) AS ({step("seeds", "")} UNION ALL {step("walk", "WHERE x >= n")})
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % {shards} AS INTEGER) AS shard, x // {shards} AS slot,
  CAST(NULL AS INTEGER) AS grown_shard, numbered.row AS row
FROM numbered JOIN walk ON numbered.row = walk.row, dims WHERE x < n"""
