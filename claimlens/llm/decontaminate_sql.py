"""DuckDB SQL of operator 3's query, written from the operator's definition."""

from __future__ import annotations

from claimlens.llm.decontaminate import CONSISTENCY, NAMED, PLAIN, THRESHOLD, UNITS, WINDOW_WORDS, WORDS

_SLOTS = "('0', '@', '%')"
_NAMES = r"(?: \p{Lu}\p{Ll}\p{L}*)+"
_NUMBERS = "(?: [0-9]+)+"


def _spaced(text: str) -> str:
    digits = rf"regexp_replace(coalesce({text}, ''), '([0-9]+)', ' \1 ', 'g')"
    return rf"' ' || regexp_replace({digits}, '[^\p{{L}}0-9]+', ' ', 'g') || ' '"


def _windows(source: str, form: int) -> str:
    """(id, p, canonical tokens c, raw tokens r, window w) of one form."""
    t = f"regexp_replace(s, '{_NAMES}', ' @', 'g')" if form == NAMED else "s"
    if form == PLAIN:
        t, pattern = "lower(s)", " [^ ]+"
    else:
        t = f"lower(regexp_replace({t}, '{_NUMBERS}', ' 0', 'g'))"
        t = f"regexp_replace({t}, '0 ({'|'.join(UNITS)}) ', '0 % ', 'g')"
        pattern = _NUMBERS + (f"|{_NAMES}" if form == NAMED else "") + "| [^ ]+"
    n = WINDOW_WORDS
    return f"""(
      SELECT id, {form} AS f, p, tok[p:p + {n - 1}] AS c, raw[p:p + {n - 1}] AS r,
             '{form} ' || array_to_string(tok[p:p + {n - 1}], ' ') AS w
      FROM (SELECT *, unnest(range(1, greatest(len(tok) - {n - 1}, 1) + 1)) AS p FROM (
              SELECT id, list_filter(string_split({t}, ' '), lambda x: x <> '') AS tok,
                     list_transform(regexp_extract_all(s, '{pattern}'), lambda x: trim(x)) AS raw FROM {source})
            WHERE len(tok) > 0))"""


def _all(source: str, where: str = "") -> str:
    return " UNION ALL ".join(f"SELECT * FROM {_windows(source, f)} x {where if f == PLAIN else ''}"
                              for f in (NAMED, WORDS, PLAIN))


_IN = f"(f = {PLAIN} OR len(list_filter(c, lambda x: x NOT IN {_SLOTS})) > 0)"

SQL = f"""
WITH d AS (SELECT doc_id AS id, {_spaced('text')} AS s FROM documents),
  b AS (SELECT item_id AS id, {_spaced('text')} AS s FROM benchmark WHERE item_id IS NOT NULL),
  told AS (SELECT DISTINCT id FROM (SELECT * FROM {_windows('b', NAMED)} x UNION ALL SELECT * FROM {_windows('b', WORDS)} y)
           WHERE {_IN}),
  dw AS ({_all('d')}),
  bw AS ({_all('b', 'WHERE id NOT IN (SELECT id FROM told)')}),
  gram AS (SELECT DISTINCT id AS item, f, w FROM bw WHERE {_IN}),
  size AS (SELECT item, f, count(*) AS n FROM gram GROUP BY item, f),
  cand AS (SELECT id, item, f FROM (SELECT id, item, gram.f, count(DISTINCT w) AS found FROM dw JOIN gram USING (w)
                                    GROUP BY ALL) JOIN size USING (item, f) WHERE found >= {THRESHOLD} * n),
  hit AS (SELECT d.id, b.id AS item, b.f, d.p, b.p AS q, d.w, b.c, b.r AS br, d.r AS dr
          FROM dw d JOIN bw b USING (w) SEMI JOIN cand k ON k.id = d.id AND k.item = b.id AND k.f = b.f),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY id, item, f, p ORDER BY support DESC, q) AS rank FROM (
               SELECT *, p - q AS shift, count(*) OVER (PARTITION BY id, item, f, p - q) AS support FROM hit)),
  turned AS (SELECT *, rank = 1 AND q <= last_value(CASE WHEN rank = 1 THEN q END IGNORE NULLS) OVER (
               PARTITION BY id, item, f ORDER BY p, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS turn
             FROM ranked),
  runs AS (SELECT *, count(*) FILTER (turn) OVER (
             PARTITION BY id, item, f ORDER BY p, rank ROWS UNBOUNDED PRECEDING) AS run FROM turned),
  place AS (SELECT *, unnest(list_concat(['all', 'shift ' || shift], CASE WHEN rank = 1 THEN ['run ' || run] ELSE [] END))
              AS g FROM runs),
  held AS (SELECT id, item, f, g FROM (
             SELECT id, item, f, g, count(DISTINCT CASE WHEN {_IN} THEN w END) AS found FROM place GROUP BY ALL)
           JOIN size USING (item, f) WHERE found >= {THRESHOLD} * n),
  slot AS (SELECT id, item, f, g, c[k] AS kind, br[k] AS value, dr[k] AS said, weight FROM (
             SELECT *, unnest(range(1, len(c) + 1)) AS k, 1.0 / count(*) OVER (PARTITION BY id, item, f, g, q) AS weight
             FROM place SEMI JOIN held USING (id, item, f, g))
           WHERE f <> {PLAIN} AND c[k] IN {_SLOTS}),
  agree AS (SELECT id, item, f, g, sum(best) / sum(total) AS share FROM (
              SELECT id, item, f, g, max(weight) AS best, sum(weight) AS total FROM (
                SELECT id, item, f, g, kind, value, said, sum(weight) AS weight FROM slot GROUP BY ALL)
              GROUP BY id, item, f, g, kind, value) GROUP BY ALL),
  found AS (SELECT id, count(DISTINCT item) AS n, min(item) AS first_item
            FROM held LEFT JOIN agree USING (id, item, f, g) WHERE coalesce(share, 1) >= {CONSISTENCY} GROUP BY id)
SELECT doc_id, coalesce(n, 0) AS n_items, first_item, n IS NOT NULL AS contaminated
FROM documents LEFT JOIN found ON found.id = doc_id
"""
