"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

#: A-Z to a-z only, as the contracts lower-case
_LOW = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXT = _LOW.format(t="coalesce(text, '')")

OP9 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_TEXT}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 5 THEN [a]
         ELSE list_transform(range(1, len(a) - 3), lambda i: a[i:i+4]) END) AS sh FROM w
), e AS (SELECT doc_id, unnest(sh) AS g FROM s),
 p AS (
  SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS n_common FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), l AS (
  SELECT u, v FROM p JOIN s a ON a.doc_id = u JOIN s b ON b.doc_id = v
  WHERE 100 * n_common >= 85 * (len(a.sh) + len(b.sh) - n_common)
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, l.v FROM reach JOIN l ON l.u = reach.r
), m AS (SELECT doc_id, min(r) AS c FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, c AS component_id, c = s.doc_id AS kept
FROM s JOIN m USING (doc_id)
"""

OP1 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_TEXT}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_TEXT}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(13, len(a)) AS k, unnest(list_transform(range(1, len(a) - least(13, len(a)) + 2), lambda i: a[i:i + least(13, len(a)) - 1])) AS g
  FROM b WHERE len(a) > 0
), dw AS (
  SELECT doc_id, k, i, a[i:i + k - 1] AS g FROM (SELECT doc_id, a, k, unnest(range(1, len(a) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(a) >= k)
), hits AS (
  SELECT doc_id, i, dw.k, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k
), n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY 1
), s AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hits) GROUP BY 1
)
SELECT d.doc_id, CAST(len(a) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(a) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
"""

OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 5
"""

OP13 = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a FROM documents
), s AS (
  SELECT doc_id, i, md5(array_to_string(a[i:i + 34], ' ')) AS g
  FROM (SELECT doc_id, a, unnest(range(1, len(a) - 33)) AS i FROM w WHERE len(a) >= 35)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM s JOIN (SELECT g FROM s GROUP BY g HAVING count(*) > 1) USING (g)
), k AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
  FROM (SELECT doc_id, unnest(a) AS x, unnest(range(1, len(a) + 1)) AS p FROM w) ANTI JOIN gone USING (doc_id, p) GROUP BY 1
)
SELECT w.doc_id, CAST(len(a) AS BIGINT) AS n_words, CAST(len(a) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""


def _manifest_sql(levels: int = 6, source_levels: int = 4) -> str:
    """The tree level by level; sources of up to 16^levels documents."""
    field = "coalesce(CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"
    leaf = "sha256(" + " || ".join(field.format(x=c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {t})"
    text = leaf.format(t=field.format(x="text"))
    low = leaf.format(t=field.format(x=_LOW.format(t="text")))
    bit = "list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
           lambda d: CAST(ascii(d) AS BIGINT))), lambda h, d: {bit.replace("[c,", "[xor(h, d),")}))"""
    parts = [f"""d AS (SELECT doc_id, coalesce('s' || source, '') AS tree, {text} AS leaf,
  CASE WHEN {crc} % 5 = 0 THEN {low} ELSE {text} END AS other FROM documents)""",
             "n0 AS (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos, leaf AS h FROM d))",
             "f0 AS (SELECT doc_id, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos, leaf, other AS cur, '' AS proof FROM d)"]

    def up(n: str, to: str) -> str:
        return f"""{to} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM (
  SELECT tree, pos // 16 AS pos, CASE WHEN max(c) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {n} GROUP BY 1, pos // 16))"""

    def fold(n: str, f: str, to: str) -> str:
        return f"""{to} AS (SELECT {f}.doc_id, {f}.tree, {f}.pos // 16 AS pos, leaf,
  CASE WHEN max(c) = 1 THEN max(cur) ELSE sha256(string_agg(CASE WHEN {n}.pos = {f}.pos THEN cur ELSE h END, '' ORDER BY {n}.pos)) END AS cur,
  max(proof) || coalesce(string_agg(h, '' ORDER BY {n}.pos) FILTER ({n}.pos <> {f}.pos), '') AS proof
  FROM {f} JOIN {n} ON {n}.tree = {f}.tree AND {n}.pos // 16 = {f}.pos // 16 GROUP BY {f}.doc_id, {f}.tree, {f}.pos, leaf)"""

    for k in range(levels):
        parts += [up(f"n{k}", f"n{k + 1}"), fold(f"n{k}", f"f{k}", f"f{k + 1}")]
    parts += [f"m0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, tree AS t, count(*) OVER () AS c FROM n{levels})",
              f"g0 AS (SELECT doc_id, '' AS tree, m0.pos, leaf, cur, proof FROM f{levels} f JOIN m0 ON m0.t = f.tree)"]
    for k in range(source_levels):
        parts += [up(f"m{k}", f"m{k + 1}"), fold(f"m{k}", f"g{k}", f"g{k + 1}")]
    return "WITH " + ",\n".join(parts) + f"""
SELECT d.doc_id, d.leaf, m0.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.h AS verified
FROM g{source_levels} JOIN d USING (doc_id) JOIN m0 ON m0.t = d.tree, m{source_levels} r"""


OP12 = _manifest_sql()

ORACLES: dict[str, str] = {"op1_decontaminate": OP1, "op7_top_k": OP7, "op9_near_duplicates": OP9, "op12_merkle_manifest": OP12,
                           "op13_passage_dedup": OP13}
