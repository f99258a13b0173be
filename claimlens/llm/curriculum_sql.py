"""DuckDB SQL of ``op11_curriculum_mix``: the same targets, seeded order and
inverse of the integrated schedules, stated with windows over whole sources."""

from __future__ import annotations

from claimlens.llm.curriculum import MAX_REPEATS, SCHEDULES, SEED, SHARE, WORD, Schedule, integral


def _progress(share: str, schedule: Schedule) -> str:
    total, reached, cases = integral(schedule), 0.0, []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        slope = (w1 - w0) / (t1 - t0)
        rest = f"({share} * {total}::DOUBLE - {reached}::DOUBLE)"
        root = f"sqrt(greatest(0::DOUBLE, {w0 * w0}::DOUBLE + {2 * slope}::DOUBLE * {rest}))"
        reached += (t1 - t0) * (w0 + w1) / 2
        cases.append(f"WHEN {share} * {total}::DOUBLE < {reached}::DOUBLE THEN "
                     f"CASE WHEN {rest} <= 0 THEN {t0}::DOUBLE ELSE {t0}::DOUBLE + 2::DOUBLE * {rest} "
                     f"/ ({w0}::DOUBLE + {root}) END")
    return f"least(1::DOUBLE, CASE {' '.join(cases)} ELSE 1::DOUBLE END)"


_POSITION = " ".join(f"WHEN {kind} THEN {_progress('(before::DOUBLE / wanted)', s)}"
                     for kind, s in enumerate(SCHEDULES))
_WEIGHT = " ".join(f"WHEN {kind} THEN {integral(s)}::DOUBLE" for kind, s in enumerate(SCHEDULES))
_TAKEN = " + ".join(f"greatest(0, least(size, wanted - before - {i} * source_size))" for i in range(MAX_REPEATS))

SQL = f"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, '-') || ':{SEED}:' || coalesce(text, '')) AS k
    FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
ranked AS (
    SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(SCHEDULES)} AS kind
    FROM src),
weighed AS (SELECT *, CASE kind {_WEIGHT} END AS weight, {MAX_REPEATS} * source_size AS most FROM ranked),
levels AS (  -- the level if the sources before this one are at their most
    SELECT weight, most, row_number() OVER o AS n, ({SHARE} * sum(source_size) OVER () - (sum(most) OVER o - most))
           / (sum(weight) OVER () - (sum(weight) OVER o - weight)) AS level
    FROM weighed WINDOW o AS (ORDER BY most / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
water AS (SELECT coalesce(arg_min(level, n) FILTER (level * weight <= most),
                          (SELECT max(most / weight) FROM weighed)) AS level FROM levels),
target AS (
    SELECT source, source_size, kind, least(level * weight, most::DOUBLE) AS target FROM weighed, water),
placed AS (
    SELECT doc_id, size, source_size, kind, target, round(target)::BIGINT AS wanted,
           coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM d JOIN target t ON d.source IS NOT DISTINCT FROM t.source),
taken AS (SELECT *, ({_TAKEN})::BIGINT AS taken FROM placed)
SELECT doc_id, size, source_size, target, taken,
       round(CASE WHEN taken > 0 THEN CASE kind {_POSITION} END END, 9) AS position
FROM taken
"""
