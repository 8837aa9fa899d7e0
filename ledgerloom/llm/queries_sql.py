"""DuckDB SQL of the operators' queries whose results SQL can state."""

from __future__ import annotations

from collections.abc import Sequence


def chat_sql(marks: Sequence[str], controls: Sequence[str], trial: str) -> str:
    """``marks``: those of every turn; ``controls``: strings that a text holds only with an escape."""
    counts = " + ".join(
        f"(length(x) - length(replace(x, '{c}', ''))) // {len(c)}" for c in controls) + r" + length(x) - length(replace(x, '\', ''))"
    added = {name: counts.replace("(x", f"({name}") for name in ("role", "text")}
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{trial}' UNION ALL SELECT -7, 1, 'assistant', '{trial}'),
measured AS (
  SELECT *, {sum(map(len, marks))} + length(role) + length(text) + {added['role']} + {added['text']} AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM measured GROUP BY conv_id"""


NEGATIVES_SQL = """
WITH vectors AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.rid, a.vec_id AS anchor_id, a.label AS own, r.rid AS other, r.vec_id, r.label,
    list_dot_product(a.v, r.v)::BIGINT AS score
  FROM vectors a JOIN vectors r ON a.rid <> r.rid WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT * FROM pairs WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  row_number() OVER (PARTITION BY p.rid, p.other ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.rid = n.rid AND n.label <> n.own
  AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5"""

#: Levels that the SQL below climbs: groups of up to 8 ** 6 leaves, and up to 64 groups.
LEAF_LEVELS, TOP_LEVELS = 6, 2


def merkle_sql() -> str:
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
    leaf = "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""
steps AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS step),
checked AS (
  SELECT d.*, xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
    lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS crc FROM documents d, steps),
leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, {leaf.format(field.format('text'))} AS leaf,
    CASE WHEN crc % 3 = 0 THEN {leaf.format(field.format(lower))} END AS tampered FROM checked),
p0 AS (
  SELECT rid, doc_id, leaf, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, coalesce(tampered, leaf) AS f0, '' AS s0
  FROM leaves),
n0 AS (SELECT g, pos, leaf AS d, count(*) OVER (PARTITION BY g) AS n FROM p0)"""]

    def climb(k: int) -> None:
        """One level: runs of 8 of n<k> become n<k+1>; the proofs p<k> go on where more than one node is left."""
        parts.append(f"""
r{k} AS (SELECT g, pos // 8 AS run, any_value(n) AS n, list(d ORDER BY pos) AS ds FROM n{k} GROUP BY ALL),
n{k + 1} AS (
  SELECT g, run AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d,
    count(*) OVER (PARTITION BY g) AS n FROM r{k}),
p{k + 1} AS (
  SELECT p.* EXCLUDE (pos, f{k}, s{k}), p.pos // 8 AS pos,
    CASE WHEN n > 1 THEN sha256(array_to_string(ds[1:p.pos % 8], '') || f{k} || array_to_string(ds[p.pos % 8 + 2:8], '')) ELSE f{k} END AS f{k + 1},
    CASE WHEN n > 1 THEN s{k} || array_to_string(ds[1:p.pos % 8], '') || array_to_string(ds[p.pos % 8 + 2:8], '') ELSE s{k} END AS s{k + 1}
  FROM p{k} p JOIN r{k} r ON p.g = r.g AND p.pos // 8 = r.run)""")

    for k in range(LEAF_LEVELS):
        climb(k)
    k = LEAF_LEVELS
    parts.append(f"""
n{k + 1} AS (SELECT 0 AS g, g AS pos, d, count(*) OVER () AS n FROM n{k}),
p{k + 1} AS (
  SELECT rid, doc_id, leaf, n{k}.d AS subroot, 0 AS g, p.g AS pos, f{k} AS f{k + 1}, s{k} AS s{k + 1}
  FROM p{k} p JOIN n{k} ON p.g = n{k}.g)""")
    for k in range(LEAF_LEVELS + 1, LEAF_LEVELS + 1 + TOP_LEVELS):
        climb(k)
    k = LEAF_LEVELS + 1 + TOP_LEVELS
    return f"""WITH {','.join(parts)}
SELECT doc_id, leaf, subroot, d AS root, sha256(s{k}) AS proof_sha256, f{k} AS folded_root, f{k} = d AS verified
FROM p{k} JOIN n{k} USING (g)"""
