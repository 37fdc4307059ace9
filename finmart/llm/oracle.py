"""DuckDB SQL of the registered queries that SQL can express on whole tables.

The others have fitted models, tokenizers or archives in them and are compared with brute force
in the tests.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(nodes: str, links: str) -> str:
    """CTE ``reach(id, component_id)``: smallest id along links; ``links`` holds both directions."""
    return f"""walk(id, seen) AS (
  SELECT id, id FROM {nodes} UNION SELECT l.b, w.seen FROM walk w JOIN {links} l ON l.a = w.id
  WHERE w.seen < l.b),
reach AS (SELECT id, min(seen) AS component_id FROM walk GROUP BY id)"""


OP2 = f"""WITH RECURSIVE v AS (
  SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.id AS a, b.id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.id <> b.id
  AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98),
{_components('v', 'links')},
n AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT v.id AS vec_id, coalesce(n.n, 0) AS n_links, r.component_id, v.id = r.component_id AS kept
FROM v LEFT JOIN n ON n.id = v.id JOIN reach r ON r.id = v.id"""

_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
OP5 = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS x,
  min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr({_BASE32},
    CAST(((CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1
      AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d"""

OP8 = """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""


def op10(n: int = 3, percent: int = 90) -> str:
    return f"""WITH RECURSIVE w AS (
  SELECT doc_id AS id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n}
    THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' ')) END) AS g
  FROM w),
c AS (SELECT id, count(*) AS n FROM s GROUP BY id),
met AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.id <> b.id
  GROUP BY a.id, b.id),
links AS (SELECT a, b FROM met JOIN c ca ON ca.id = a JOIN c cb ON cb.id = b
  WHERE 100 * k >= {percent} * (ca.n + cb.n - k)),
{_components('w', 'links')}
SELECT w.id AS doc_id, coalesce(c.n, 0) AS n_shingles, r.component_id
FROM w LEFT JOIN c ON c.id = w.id JOIN reach r ON r.id = w.id"""


# CRC-32 from its polynomial: a table of 256 entries by rule, then one step a byte
_CRC_TABLE = ("(SELECT list(t ORDER BY i) FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), "
              "list_transform(range(0, 8), lambda x: CAST(0 AS BIGINT))), lambda c, x: CASE WHEN c & 1 = 1 "
              "THEN xor(CAST(3988292384 AS BIGINT), c >> 1) ELSE c >> 1 END) AS t FROM range(0, 256) AS r(i)))")


def _crc32(text: str, hexed: str) -> str:
    """CRC-32 of ``text``, whose bytes in hex are ``hexed``; the table is ``tb``."""
    return f"""xor(CAST(4294967295 AS BIGINT), list_reduce(list_prepend(
    CAST(4294967295 AS BIGINT), list_transform(range(0, strlen({text})),
      lambda i: CAST(CAST('0x' || substr({hexed}, CAST(1 + 2 * i AS INT), 2) AS INT) AS BIGINT))),
    lambda c, b: xor(tb[CAST(xor(c, b) & 255 AS INT) + 1], c >> 8)))"""


def op7(shards: int = 24) -> str:
    def score(s: str) -> str:
        bits = f"CAST(CAST('0x' || substr(md5(k || '|' || {s}), 1, 13) AS BIGINT) AS DOUBLE)"
        return f"CAST(-1 AS DOUBLE) / ln(({bits} + CAST(1 AS DOUBLE)) / CAST({2 ** 52 + 1} AS DOUBLE))"
    return f"""WITH d AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS k, coalesce(text, '') AS t,
  hex(encode(coalesce(text, ''))) AS h FROM documents),
tab AS (SELECT {_CRC_TABLE} AS tb),
crc AS (SELECT doc_id, t, {_crc32('t', 'h')} AS text_crc32 FROM d, tab),
sc AS (SELECT doc_id, s, {score('CAST(s AS VARCHAR)')} AS v FROM d, range(0, {shards + 1}) AS r(s)),
put AS (SELECT doc_id, CAST(arg_max(s, v) FILTER (WHERE s < {shards}) AS INTEGER) AS shard,
  CAST(arg_max(s, v) AS INTEGER) AS grown_shard FROM sc GROUP BY doc_id)
SELECT put.doc_id, CAST(strlen(t) + 8 AS BIGINT) AS size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY substr(md5(CAST(put.doc_id AS VARCHAR)), 1, 3), put.doc_id) - 1 AS slot,
  grown_shard
FROM put JOIN crc ON crc.doc_id = put.doc_id"""


def op11(levels: int = 12, group_levels: int = 6) -> str:
    """Level by level; a level of one node is handed on as it is, so surplus levels change nothing."""
    def field(c: str) -> str:
        v = f"CAST({c} AS VARCHAR)"
        return f"coalesce(strlen({v}) || ':' || {v}, '-')"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    row = "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"
    ctes = [f"tab AS (SELECT {_CRC_TABLE} AS tb)",
            f"d AS (SELECT doc_id, '1' || lang AS g, {row.format(field('text'))} AS leaf, "
            f"CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)', 'hex(encode(CAST(doc_id AS VARCHAR)))')} % 3 = 0 "
            f"THEN {row.format(field(lower))} END AS changed FROM documents, tab)",
            "m AS (SELECT doc_id, coalesce(g, '0') AS g, leaf, coalesce(changed, leaf) AS start, row_number() "
            "OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)",
            "a0 AS (SELECT g, i, leaf AS x FROM m)"]

    def climb(name: str, top: int) -> None:
        for k in range(top):
            ctes.append(f"""{name}n{k} AS (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {name}{k})""")
            ctes.append(f"""{name}{k + 1} AS (SELECT g, i // 8 AS i, CASE WHEN max(n) = 1 THEN max(x)
  ELSE sha256(string_agg(x, '' ORDER BY i)) END AS x FROM {name}n{k} GROUP BY g, i // 8)""")
            # before and after: digests of the run's other nodes; nothing when the level has one node
            ctes.append(f"""{name}s{k} AS (SELECT g, i, n, x,
  coalesce(string_agg(x, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
  coalesce(string_agg(x, '') OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS f
  FROM {name}n{k})""")

    climb("a", levels)
    ctes += [f"r0 AS (SELECT g AS tree, row_number() OVER (ORDER BY encode(g)) - 1 AS rank, x AS subroot FROM a{levels})",
             "b0 AS (SELECT '' AS g, rank AS i, subroot AS x FROM r0)"]
    climb("b", group_levels)
    ctes.append("w0 AS (SELECT m.doc_id, m.g, m.i, m.leaf, m.start AS y, '' AS p, r.rank, r.subroot "
                "FROM m JOIN r0 r ON r.tree = m.g)")
    steps = [("a", k, "w.g", f"w.i // {8 ** k}") for k in range(levels)]
    steps += [("b", k, "''", f"w.rank // {8 ** k}") for k in range(group_levels)]
    for t, (name, k, g, i) in enumerate(steps):
        ctes.append(f"""w{t + 1} AS (SELECT w.doc_id, w.g, w.i, w.leaf, CASE WHEN s.n = 1 THEN w.y
  ELSE sha256(s.b || w.y || s.f) END AS y, w.p || s.b || s.f AS p, w.rank, w.subroot
  FROM w{t} w JOIN {name}s{k} s ON s.g = {g} AND s.i = {i})""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root.x AS root, sha256(p) AS proof_sha256, y AS folded_root, y = root.x AS verified
FROM w{len(steps)}, (SELECT x FROM b{group_levels}) AS root"""


_Q = "list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))"
OP12 = f"""WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  {_Q} AS q FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same,
  CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.q) = len(b.q)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id,
  positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 5"""


ORACLE = {"op2_graph_dedup": OP2, "op5_warc_index": OP5, "op7_rendezvous": op7(),
          "op8_exact_dedup": OP8, "op10_ngram_jaccard": op10(),
          "op11_merkle_manifest": op11(), "op12_hard_negatives": OP12}
