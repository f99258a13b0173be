"""DuckDB SQL of ``op13_merkle_manifest``: the trees level by level, proofs and
folds by recursive queries."""

from __future__ import annotations


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Table of the reflected polynomial of crc32, one entry a byte.
_TABLE = ("list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], "
          "lambda x, _: xor(x >> 1, 3988292384 * (x & 1))))")


def _levels(name: str, base: str) -> str:
    return f"""
{name}(tree, n, lvl, idx, digest) AS (
    {base}
    UNION ALL
    SELECT tree, (n + 7) // 8, lvl + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx))
    FROM {name} WHERE n > 1 GROUP BY tree, n, lvl, idx // 8)"""


def _siblings(name: str, nodes: str) -> str:
    return f"""
{name} AS (
    SELECT tree, lvl, idx,
           coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {nodes} WHERE n > 1 WINDOW w AS (PARTITION BY tree, lvl, idx // 8 ORDER BY idx))"""


def _path(name: str, siblings: str, base: str) -> str:
    return f"""
{name}(doc, tree, lvl, idx, digest, proof) AS (
    {base}
    UNION ALL
    SELECT doc, p.tree, p.lvl + 1, p.idx // 8, sha256(before || digest || after), proof || before || after
    FROM {name} p JOIN {siblings} s ON p.tree = s.tree AND p.lvl = s.lvl AND p.idx = s.idx)"""


SQL = f"""
WITH RECURSIVE t AS (SELECT {_TABLE} AS crc),
leaf AS (
    SELECT doc_id, lang, {_leaf('text')} AS leaf, {_leaf(_LOWER)} AS changed,
           xor(list_reduce([4294967295] || list_transform(range(1, strlen(doc_id::VARCHAR) + 1),
                                                          lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))),
                           lambda a, b: xor(a >> 8, crc[xor(a & 255, b) + 1])), 4294967295) % 3 = 0 AS tampered
    FROM documents, t),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
           count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
           row_number() OVER () AS doc
    FROM leaf),
{_levels('node', 'SELECT tree, n, 0, idx, leaf FROM placed')},
{_levels('above', '''SELECT 0::BIGINT, (SELECT count(DISTINCT tree) FROM placed), 0, tree, digest
    FROM node WHERE n = 1''')},
{_siblings('near', 'node')},
{_siblings('far', 'above')},
{_path('low', 'near', '''SELECT doc, tree, 0, idx, CASE WHEN tampered THEN changed ELSE leaf END, \'\' FROM placed''')},
subroot AS (SELECT tree, lvl, digest AS subroot FROM node WHERE n = 1),
{_path('high', 'far', '''SELECT doc, 0, 0, tree, digest, proof FROM low JOIN subroot USING (tree, lvl)''')},
top AS (SELECT lvl, digest AS root FROM above WHERE n = 1),
ended AS (SELECT doc, root, proof, digest AS folded_root FROM high JOIN top USING (lvl))
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN ended USING (doc) JOIN subroot USING (tree)
"""
