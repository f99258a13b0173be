"""Sums and moments of doubles that do not depend on the order of rows.

Adding doubles rounds, so a sum changes in its last bits with the partitioning, and
a near tie in an arg-max or a top n can change with it. Here every value is cut into
whole multiples of fixed units (24 bits apart); the multiples are summed as
``bigint``, which is exact, combinable before the shuffle and the same in any order.
The totals are put together at the end, in a fixed order.

Units reach from 2^-72 to 2^72: values below 2^96 are rounded, one by one, to whole
multiples of 2^-72, so the result still does not depend on the order. Larger,
infinite and NaN values are added up as plain doubles. A group may hold up to 2^39
rows; beyond that ``bigint`` sums overflow with an error.

Values are given as SQL text: the formulas are long, and text is parsed in one call.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a multiple, and the exponents of the units.
BITS = 24
EXPONENTS = tuple(range(-72, 96, BITS))
_TOP = 2.0 ** (EXPONENTS[-1] + BITS)
#: Above it a square does not fit.
_TOP_ROOT = 2.0 ** ((EXPONENTS[-1] + BITS) // 2)


def _d(x: float) -> str:
    return f"{x!r}D"


def _near(x: str, e: int) -> str:
    """The value's nearest whole multiple of the unit."""
    return f"rint({x} * {_d(2.0 ** -e)})"


def _steps(near: Sequence[str]) -> list[str]:
    """What each unit adds to the nearest multiple of the next one. Scaling by
    powers of two, rounding to a whole number and differences of at most 24 bits
    are exact in doubles."""
    return [f"bigint({a} - {b} * {_d(2.0 ** BITS)})" for a, b in zip(near, near[1:])] + [f"bigint({near[-1]})"]


def exact_sum(x: str) -> Column:
    """Aggregate: the sum of ``x`` (SQL text), null if there is no value."""
    fits = f"abs({x}) < {_d(_TOP)}"
    kept = f"CASE WHEN {fits} THEN {x} WHEN ({x}) IS NOT NULL THEN 0D END"
    total = [f"sum(CASE WHEN {fits} THEN 0D ELSE {x} END)"]
    steps = _steps([_near(f"({kept})", e) for e in EXPONENTS])
    total += [f"double(sum({s})) * {_d(2.0 ** e)}" for s, e in zip(steps, EXPONENTS)]   # smallest first
    return F.expr(" + ".join(total))


def exact_avg(x: str) -> Column:
    """Aggregate: the mean of ``x`` (SQL text), null if there is no value."""
    return F.try_divide(exact_sum(x), F.expr(f"count({x})"))


def grouped_moments(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per group of ``keys``: ``rows`` and ``m``, what ``moment_stats`` needs of
    ``value`` (SQL text): count, least and greatest, sums of x and x * x by unit, and
    how many do not fit (2^48 or more, as their squares would not).

    One aggregate, combined before the shuffle. The row's numbers are computed in
    steps of their own, each once: x, its square as rounded product and exact error
    (a factor cut in halves of 26 bits, whose products are exact), their multiples."""
    rows = df.select(*keys, F.expr(value).cast("double").alias("_x")) \
        .selectExpr(*keys, "_x", f"CASE WHEN abs(_x) < {_d(_TOP_ROOT)} THEN _x END AS _f") \
        .selectExpr(*keys, "_x", "_f", "_f * 134217729D - (_f * 134217729D - _f) AS _h") \
        .selectExpr(*keys, "_x", "_f", "_f * _f AS _s",
                    "((_h * _h - _f * _f) + _h * (_f - _h) * 2D) + (_f - _h) * (_f - _h) AS _e")
    # x stays below 2^48 and the error below 2^43: their upper units are always 0
    wide = {"_f": EXPONENTS[:-2], "_s": EXPONENTS, "_e": EXPONENTS[:-2]}
    rows = rows.selectExpr(*keys, "_x", "_f", *[
        f"{_near(c, e)} AS {c}{i}" for c, units in wide.items() for i, e in enumerate(units)])
    steps = {c: _steps([f"{c}{i}" for i in range(len(units))]) for c, units in wide.items()}
    squares = [f"{s} + {e}" for s, e in zip(steps["_s"], steps["_e"])] + steps["_s"][len(steps["_e"]):]
    rows = rows.selectExpr(*keys, "_x", "_f", *[f"{s} AS _a{i}" for i, s in enumerate(steps["_f"])],
                           *[f"{s} AS _b{i}" for i, s in enumerate(squares)])
    sums = ", ".join(f"sum(_a{i})" for i in range(len(steps["_f"])))
    square_sums = ", ".join(f"sum(_b{i})" for i in range(len(squares)))
    return rows.groupBy(*keys).agg(F.expr("count(1) AS rows"), F.expr(
        f"struct(count(_x) AS n, min(_x) AS least, max(_x) AS most, array({sums}) AS sums, "
        f"array({square_sums}) AS squares, count(_x) - count(_f) AS unfit, avg(_x) AS avg, var_pop(_x) AS var) AS m"))


def _pair_sum(terms: Sequence[str]) -> str:
    """struct<h, l>: the sum of doubles as a double and its error."""
    return (f"aggregate(array({', '.join(terms)}), struct(0D AS h, 0D AS l), (a, t) -> struct(a.h + t AS h, a.l + "
            "((a.h - ((a.h + t) - ((a.h + t) - a.h))) + (t - ((a.h + t) - a.h))) AS l))")


def _unit_terms(sums: str, units: int) -> list[str]:
    """Sums by unit as doubles, greatest first: each in two halves that are exact."""
    out = []
    for i in range(units - 1, -1, -1):
        out.append(f"double(shiftright({sums}[{i}], 32)) * {_d(2.0 ** (EXPONENTS[i] + 32))}")
        out.append(f"double({sums}[{i}] & 4294967295L) * {_d(2.0 ** EXPONENTS[i])}")
    return out


def _error(a: str, ah: str, b: str, bh: str) -> str:
    """The exact error of the rounded product a * b (``ah``, ``bh``: their upper halves)."""
    return (f"((({ah} * {bh} - {a} * {b}) + {ah} * ({b} - {bh})) + ({a} - {ah}) * {bh}) "
            f"+ ({a} - {ah}) * ({b} - {bh})")


def _half(a: str) -> str:
    return f"{a} * 134217729D - ({a} * 134217729D - {a})"


def moment_stats(groups: DataFrame) -> DataFrame:
    """``grouped_moments`` with ``m`` replaced by ``mean``, ``var_pop`` and
    ``var_samp``.

    The sum of squares around the mean m is S2 - m (2 S1 - n m); the sums are exact
    and the differences are taken in pairs of doubles (about 100 bits), so little is
    lost where the spread is small beside the mean. Equal values have variance 0;
    ``var_samp`` of one value is null."""
    keep, units = [c for c in groups.columns if c != "m"], len(EXPONENTS)
    df = groups.selectExpr(*keep, "m", "double(m.n) AS _n", f"{_pair_sum(_unit_terms('m.sums', units - 2))} AS _s1",
                           f"{_pair_sum(_unit_terms('m.squares', units))} AS _s2")
    df = df.selectExpr("*", "try_divide(_s1.h + _s1.l, _n) AS _m")
    df = df.selectExpr("*", f"{_half('_n')} AS _nh", f"{_half('_m')} AS _mh")
    df = df.selectExpr("*", _pair_sum(["2D * _s1.h", "-(_n * _m)", "2D * _s1.l",
                                       f"-({_error('_n', '_nh', '_m', '_mh')})"]) + " AS _d")
    df = df.selectExpr("*", "_d.h + _d.l AS _dh", "(_d.h - (_d.h + _d.l)) + _d.l AS _dl")
    df = df.selectExpr("*", f"{_half('_dh')} AS _dhh")
    df = df.selectExpr("*", _pair_sum(["_s2.h", "-(_m * _dh)", "_s2.l", f"-({_error('_m', '_mh', '_dh', '_dhh')})",
                                       "-(_m * _dl)"]) + " AS _v")
    df = df.selectExpr("*", "CASE WHEN m.n > 0 THEN CASE WHEN m.unfit > 0 THEN m.var * _n WHEN m.least = m.most THEN 0D "
                            "ELSE greatest(0D, _v.h + _v.l) END END AS _around")
    return df.selectExpr(
        *keep, "CASE WHEN m.unfit > 0 THEN m.avg WHEN m.least = m.most THEN m.least ELSE _m END AS mean",
        "try_divide(_around, _n) AS var_pop", "CASE WHEN m.n > 1 THEN _around / (_n - 1D) END AS var_samp")
