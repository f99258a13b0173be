"""DuckDB SQL of ``op12_conversation_repair``: row by row, the cheapest (cost,
audit, lines) of the four states; no blocks, no ranks."""

from __future__ import annotations

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_TABLE = ("list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], "
          "lambda x, _: xor(x >> 1, 3988292384 * (x & 1))))")
_NONE = "{'c': 1000000000, 'a': '', 't': ''}"


def _step(state: str, cost: str, letter: str, line: str) -> str:
    """The entry of ``state`` after an edit; lines end in a line break."""
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}}"


def _least(*entries: str) -> str:
    return f"list_sort([{', '.join(entries)}])[1]"


def _closed(prefix: str, source: str) -> str:
    """States of ``source`` after any inserted turns (a chain of at most three)."""
    user, reply = "'user:' || chr(10)", "'assistant:' || chr(10)"
    return f"""
{prefix}a AS (SELECT * REPLACE ({_least('s2', _step('s0', '3', 'I', user), _step('s1', '3', 'I', user),
                                      _step('s3', '3', 'I', user))} AS s2) FROM {source}),
{prefix}b AS (SELECT * REPLACE ({_least('s3', _step('s2', '3', 'I', reply))} AS s3) FROM {prefix}a),
{prefix}c AS (SELECT * REPLACE ({_least('s2', _step('s3', '3', 'I', user))} AS s2) FROM {prefix}b)"""


def _after_row(s: str) -> str:
    """The states after one more row ``r`` from the closed states of ``s``."""
    line = "(r.role || ':' || r.text || chr(10))"
    user, reply = "('user:' || r.text || chr(10))", "('assistant:' || r.text || chr(10))"

    def deleted(q):
        return _step(f"{s}.{q}", "4", "D", "''")

    def kept(q, initial):
        step = _step(f"{s}.{q}", "r.cut", "K", line)
        return f"CASE WHEN r.stays AND r.initial = '{initial}' THEN {step} ELSE {_NONE} END"

    def reroled(q, to):
        return f"CASE WHEN r.stays THEN {_step(f'{s}.{q}', '3 + r.cut', 'R', to)} ELSE {_NONE} END"

    return ", ".join((
        deleted("s0") + " AS s0",
        _least(deleted("s1"), kept("s0", "s")) + " AS s1",
        _least(deleted("s2"), *[e for q in ("s0", "s1", "s3") for e in (kept(q, "u"), reroled(q, user))]) + " AS s2",
        _least(deleted("s3"), kept("s2", "a"), reroled("s2", reply)) + " AS s3"))


def _closed_row(s: str) -> str:
    """A subquery with the closed states of the recursion's row ``s``."""
    return f"(WITH {_closed('x', s)} SELECT * FROM xc)"


SQL = f"""
WITH RECURSIVE t AS (SELECT {_TABLE} AS crc),
keyed AS (
    SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k,
           coalesce(role, ' ') AS ro, coalesce(text, ' ') AS tx FROM conversations),
fates AS (
    SELECT conv_id, turn, ro, tx, xor(list_reduce(
               [4294967295] || list_transform(range(1, strlen(k) + 1), lambda i: ascii(substr(k, i::INT, 1))),
               lambda a, b: xor(a >> 8, crc[xor(a & 255, b) + 1])), 4294967295) % 20 AS fate FROM keyed, t),
rows_ AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE ro END AS role,
           CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(tx, '.!?', '') ELSE tx END AS text,
           unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM fates WHERE fate <> 0),
ordered AS (
    SELECT conv_id, turn, role, text, rtrim(text, {_SPACES}) AS core, substr(role, 1, 1) AS initial,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
                              md5(role || chr(0) || text)) AS pos FROM rows_),
faulty AS (
    SELECT *, core = '' AS is_blank, core <> '' AND pos > min(pos) OVER (PARTITION BY conv_id, role, text) AS is_again,
           initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS pair FROM ordered),
r AS (
    SELECT *, NOT is_blank AND NOT is_again AS stays,
           NOT is_blank AND NOT is_again AND right(core, 1) NOT IN ('.', '!', '?') AS is_cut,
           CASE WHEN is_cut THEN 3 ELSE 0 END AS cut FROM faulty),
facts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count_if(is_blank)::BIGINT AS blank, count_if(is_again)::BIGINT AS duplicate,
           count_if(is_cut)::BIGINT AS truncated, count_if(pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal,
           max(pos) AS n FROM r GROUP BY conv_id),
best AS (
    SELECT conv_id, 0::BIGINT AS pos, {{'c': 0, 'a': '', 't': ''}} AS s0, {_NONE} AS s1, {_NONE} AS s2, {_NONE} AS s3
    FROM facts
    UNION ALL
    SELECT r.conv_id, r.pos, {_after_row('z')}
    FROM {_closed_row('best')} z
    JOIN r ON r.conv_id IS NOT DISTINCT FROM z.conv_id AND r.pos = z.pos + 1),
{_closed('e', 'best').strip()},
done AS (
    SELECT f.*, {_least('s0', 's3')} AS w FROM ec JOIN facts f
    ON f.conv_id IS NOT DISTINCT FROM ec.conv_id AND f.n = ec.pos)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w.c, 0)::BIGINT AS cost,
       coalesce(w.a, '') AS audit, sha256(coalesce(left(w.t, length(w.t) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN done ON i.conv_id IS NOT DISTINCT FROM done.conv_id
"""
