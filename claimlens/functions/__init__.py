"""Scalar column functions (I1-I11). All are built-in Spark expressions.

Each returns a ``Column`` and stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: ColumnOrName) -> Column:
    """Text to double; bad text is NULL (not an error), and so is NaN.

    NaN would sort above every number under ``desc``; keeping it out makes
    every top-k total and engine independent.
    """
    v = _c(c).try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def to_bigint(c: ColumnOrName) -> Column:
    """Text to bigint; ``'050441'`` becomes 50441, bad text NULL."""
    return F.trim(_c(c)).try_cast("bigint")


def to_int(c: ColumnOrName) -> Column:
    """Text to int (``cast(x as int)``); bad text is NULL."""
    return F.trim(_c(c)).try_cast("int")


def code_prefix(c: ColumnOrName) -> Column:
    """Everything before the first space (``'039 - NAME'`` -> ``'039'``)."""
    return F.regexp_replace(_c(c), " .*", "")


def flip_region(c: ColumnOrName, anchored: bool = False) -> Column:
    """``'CA - Santa Cruz'`` -> ``'Santa Cruz,CA'``; no match: unchanged."""
    pattern = "^(..) - (.*)$" if anchored else "(..) - (.*)"
    return F.regexp_replace(_c(c), pattern, "$2,$1")


def leading_digits(c: ColumnOrName) -> Column:
    """Leading digits after optional spaces (``'  0604 x'`` -> ``'0604'``)."""
    return F.regexp_replace(_c(c), "^ *([0-9]*).*", "$1")


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Division that yields NULL on a zero divisor instead of raising."""
    return F.try_divide(_c(a), _c(b))


def better_first(*keys: tuple[ColumnOrName, str]) -> Column:
    """A struct whose ascending order is the requested order, nulls last.

    ``keys`` are ``(column, "asc"|"desc")`` pairs for numeric or string
    columns ("desc" only for numeric ones). ``min_by(x, better_first(...))``
    then picks the first row of a group in that order: a map-side
    combinable arg-min instead of a window over all rows of the group.
    """
    fields = []
    for i, (c, direction) in enumerate(keys):
        col = _c(c)
        fields.append(col.isNull().alias(f"n{i}"))
        fields.append((-col if direction == "desc" else col).alias(f"v{i}"))
    return F.struct(*fields)


def claims_text(c: ColumnOrName) -> Column:
    """``array<struct<claim_id,n>>`` -> ``'id,n,id,n'`` (sorted, set)."""
    parts = F.transform(_c(c), lambda e: F.concat(e["claim_id"], F.lit(","),
                                                  e["n"].cast("string")))
    return F.concat_ws(",", F.array_sort(F.array_distinct(parts)))


def decode_claims(c: ColumnOrName) -> Column:
    """``'id,n,id,n'`` -> ``array<struct<claim_id,n>>`` (stride-2 read).

    An odd trailing item (no count) is dropped; a bad count is NULL.
    """
    items = F.split(_c(c), ",")
    pairs = F.sequence(F.lit(0), F.size(items) - 2, F.lit(2))
    arr = F.when(F.size(items) >= 2, pairs).otherwise(F.array().cast("array<int>"))
    return F.transform(arr, lambda i: F.struct(
        F.element_at(items, i + 1).alias("claim_id"),
        F.element_at(items, i + 2).try_cast("bigint").alias("n")))


def seeded_key(c: ColumnOrName, seed: int | str) -> Column:
    """A repeatable pseudo-random key: hex md5 of ``id:seed``.

    Lowercase hex of fixed length orders like the number it spells, so
    sorting by this string is sorting by a uniform 128-bit hash.
    """
    return F.md5(F.concat(_c(c).cast("string"), F.lit(f":{seed}")))


def double_array(values: Sequence[float]) -> Column:
    """A constant ``array<double>``: one literal, folded once by the
    optimizer (``lit`` of a list would make one expression per element)."""
    if not len(values):
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(map(repr, map(float, values)))), ",").cast("array<double>")
