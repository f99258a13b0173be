"""Benchmark decontamination by template windows (operator 3).

DataFrame and SQL functions only.

*Canonical form.* Texts become tokens: runs of digits and of letters; other
characters separate. A run of number tokens becomes ``0``, a run of
capitalised words (a capital, then a small letter) becomes ``@``, a unit after
a number becomes ``%``; other words are lower-cased. A second form leaves names
as lower-cased words, so that copies in other case are found too. An item of which
both forms hold placeholders only ("2 4 8 16 32 64") has a third, its plain
lower-cased words and numbers.

*Windows.* Every ``WINDOW_WORDS`` consecutive canonical tokens form a template
window (a shorter text is one window, which only a text of the same words has). The
windows of all documents, of all forms in one pass, are hash-joined with those of
the benchmark; the benchmark side is broadcast only behind a check of its size.

*Decision.* In either form, an item is found in a document with an occurrence
that holds at least ``THRESHOLD`` of its distinct windows and fills its slots
consistently: following the matched windows, each value of the item (number,
name or unit) must stand for one value of the occurrence. ``consistency`` is
the share of the slot weight that agrees with the value most often seen for
it; every matched item position weighs 1, divided among its places in the
occurrence.

*Occurrences.* The matched places with one alignment (document position minus
item position); every run of places whose item positions go forward, so that
words put into a copy do not part it (of the item positions of one place, the
one with the commonest alignment counts); and all places of the document, so
that a copy in another order is one too. Other passages of the same template
with other values do not hide a copy.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import small, stored

WINDOW_WORDS = 5
THRESHOLD = 0.8
CONSISTENCY = 0.8

# Units that may follow a number.
UNITS = ("km m cm mm mi miles mile feet foot ft inch inches kg g mg lb lbs pounds tons ton l ml "
         "liters litres gallons hours hour h minutes minute min seconds second s ms days day "
         "weeks week months month years year percent dollars dollar euros euro cents usd eur "
         "degrees kmh mph hz khz mhz ghz kb mb gb tb w kw v").split()

_PAIR = ["d", "k", "item_id", "f"]

# Possessive runs: matched in a loop, whatever their length.
_NAMES = r"(?: \p{Lu}\p{Ll}\p{L}*)++"
_NUMBERS = "(?: [0-9]+)++"
_RAW_TOKEN = _NUMBERS + "|{names} [^ ]+"


def _spaced(text: Column) -> Column:
    """Tokens, each after one space; a space ends the text."""
    digits = F.regexp_replace(F.coalesce(text, F.lit("")), "([0-9]+)", " $1 ")
    return F.concat(F.lit(" "), F.regexp_replace(digits, r"[^\p{L}0-9]+", " "), F.lit(" "))


#: Canonical forms: names as placeholders, names as words, nothing replaced.
NAMED, WORDS, PLAIN = 1, 0, 2


def canonical_tokens(text: Column, form: int = NAMED) -> Column:
    """The canonical tokens; an empty array for a text without tokens."""
    return _canonical(_spaced(text), form)


def _canonical(t: Column, form: int) -> Column:
    if form == NAMED:
        t = F.regexp_replace(t, _NAMES, " @")
    t = F.lower(t)
    if form != PLAIN:
        t = F.regexp_replace(t, _NUMBERS, " 0")
        t = F.regexp_replace(t, f"0 ({'|'.join(UNITS)}) ", "0 % ")
    return F.filter(F.split(t, " "), lambda x: x != "")


def raw_tokens(text: Column, form: int = NAMED) -> Column:
    """The same tokens with their values, one for one."""
    return _raw(_spaced(text), form)


def _raw(t: Column, form: int) -> Column:
    pattern = " [^ ]+" if form == PLAIN else _RAW_TOKEN.replace("{names}", f"{_NAMES}|" if form == NAMED else "")
    return F.transform(F.regexp_extract_all(t, F.lit(pattern), 0), lambda x: F.trim(x))


def _windows(tokens: Column, n: int, form: Column | int) -> Column:
    """The hash of each window and the form, in order (a shorter text: of all
    tokens)."""
    last = F.greatest(F.size(tokens) - F.lit(n), F.lit(0))
    form = F.lit(form) if isinstance(form, int) else form
    return F.when(F.size(tokens) > 0, F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(form, *[F.get(tokens, i + k) for k in range(n)]))
    ).otherwise(F.array().cast("array<bigint>"))


def _row_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                 window: int = WINDOW_WORDS, threshold: float = THRESHOLD,
                 consistency: float = CONSISTENCY) -> DataFrame:
    """(``id_col``, row_key, item_id) of each benchmark item found in a document.

    ``row_key`` is the hash of the row's text: rows that share an id are judged
    apart unless their texts are equal, and rows without an id are judged too.
    Null or empty texts and items match nothing; items without an id are
    ignored; repeated items and rows count once. Further columns are not read.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("t")) \
        .where("item_id is not null")
    rows = docs.select(F.col(id_col).alias("d"), _row_key(F.col(text_col)).alias("k"),
                       F.col(text_col).alias("t"))
    return _found(rows, items, window, threshold, consistency) \
        .select(F.col("d").alias(id_col), F.col("k").alias("row_key"), "item_id").distinct()


def _item_forms(items: DataFrame, window: int) -> DataFrame:
    """(item_id, f, canon, raw, q, w): every window of every form an item has."""
    spaced = items.select("item_id", _spaced(F.col("t")).alias("s"))
    forms = F.array(*[F.struct(F.lit(f).alias("f"), _canonical(F.col("s"), f).alias("canon"),
                               _raw(F.col("s"), f).alias("raw")) for f in (NAMED, WORDS, PLAIN)])
    each = spaced.select("item_id", F.explode(forms).alias("x")).select("item_id", "x.*")
    places = stored(each.select("item_id", "f", "canon", "raw",
                                F.posexplode(_windows(F.col("canon"), window, F.col("f"))).alias("q", "w")), "item-forms")
    literal = places.where((F.col("f") != PLAIN) & _literal(F.slice("canon", F.col("q") + 1, window)))
    told = literal.select("item_id").distinct()
    return places.where(F.col("f") != PLAIN).unionByName(
        places.where(F.col("f") == PLAIN).join(told, "item_id", "left_anti").select(places.columns))


def _literal(canon: Column) -> Column:
    """Whether a window holds a token that is no placeholder (in a plain form every
    token is itself)."""
    return F.exists(canon, lambda x: ~x.isin("0", "@", "%")) | (F.col("f") == PLAIN)


def _found(rows: DataFrame, items: DataFrame, window: int = WINDOW_WORDS,
           threshold: float = THRESHOLD, consistency: float = CONSISTENCY) -> DataFrame:
    """(d, k, item_id) found; ``rows`` (d, k, t) and ``items`` (item_id, t) hold the
    texts."""
    item = _item_forms(items, window)
    grams = stored(item.where(_literal(F.slice("canon", F.col("q") + 1, window)))
                   .select("item_id", "f", "w").distinct(), "item-windows")
    used = sorted(r["f"] for r in grams.select("f").distinct().collect())
    sizes = grams.groupBy("item_id", "f").agg(F.count(F.lit(1)).alias("n_windows"))
    # the tokens are columns of their own: inside the window expression they
    # would be made again for every window
    spaced = rows.select("d", "k", _spaced(F.col("t")).alias("s"))
    canon = spaced.select("d", "k", *[_canonical(F.col("s"), f).alias(f"c{f}") for f in used])
    every = F.flatten(F.array(F.array().cast("array<bigint>"), *[_windows(F.col(f"c{f}"), window, f) for f in used]))
    hits = canon.select("d", "k", F.explode(F.array_distinct(every)).alias("w")).join(small(grams, 32), "w")
    cand = stored(
        hits.groupBy("d", "k", "item_id", "f").agg(F.count_distinct("w").alias("found"))
        .join(small(sizes, 32), ["item_id", "f"])
        .where(F.col("found") >= F.lit(threshold) * F.col("n_windows")), "candidates")

    # values of the slots, only for the candidate documents
    keys = small(cand.select(F.col("d").alias("kd"), F.col("k").alias("kk"), "f").distinct(), 32)
    # one row a text and form: equal rows count once
    texts = rows.join(keys, [rows["d"].eqNullSafe(keys["kd"]), rows["k"] == keys["kk"]]) \
        .select("d", "k", "f", "t").distinct().select("d", "k", "f", _spaced(F.col("t")).alias("s"))

    def by_form(make) -> Column:
        return F.when(F.col("f") == NAMED, make(F.col("s"), NAMED)).when(F.col("f") == WORDS, make(F.col("s"), WORDS)) \
            .otherwise(make(F.col("s"), PLAIN))

    placed = texts.select("d", "k", "f", by_form(_canonical).alias("canon"), by_form(_raw).alias("raw")) \
        .select("d", "k", "f", "raw", F.posexplode(_windows(F.col("canon"), window, F.col("f"))).alias("p", "w")) \
        .select("d", "k", F.col("f").alias("df"), "p", "w", F.slice("raw", F.col("p") + 1, window).alias("doc_raw"))
    at_item = item.select("item_id", "f", "q", "w", F.slice("canon", F.col("q") + 1, window).alias("canon"),
                          F.slice("raw", F.col("q") + 1, window).alias("item_raw"))
    at_item = small(stored(at_item, "item-places"), 400)
    matched = placed.join(at_item, "w").drop("df")
    c = cand.select(F.col("d").alias("cd"), F.col("k").alias("ck"), F.col("item_id").alias("ci"), F.col("f").alias("cf"))
    matched = stored(matched.join(
        small(c, 40), [matched["d"].eqNullSafe(c["cd"]), matched["k"] == c["ck"],
                       matched["item_id"] == c["ci"], matched["f"] == c["cf"]], "left_semi"), "matched")
    placed_at = _occurrences(matched)
    # the literal windows alone count for containment
    held = placed_at.groupBy(*_PAIR, "g").agg(
        F.count_distinct(F.when(_literal(F.col("canon")), F.col("w"))).alias("found")) \
        .join(small(sizes, 32), ["item_id", "f"]) \
        .where(F.col("found") >= F.lit(threshold) * F.col("n_windows")).drop("found", "n_windows")
    held = stored(held, "occurrences")
    of = [*_PAIR, "g"]

    def same_as(x: str, y: str, columns: list[str]) -> Column:
        return reduce(and_, [F.col(f"{x}.{c}").eqNullSafe(F.col(f"{y}.{c}")) for c in columns])

    kept = placed_at.alias("m").join(small(held, 64).alias("h"), same_as("m", "h", of), "left_semi")
    places = kept.groupBy(*of, "q").agg(F.count(F.lit(1)).alias("places"))
    slot = F.filter(F.arrays_zip("canon", "item_raw", "doc_raw"),
                    lambda x: x["canon"].isin("0", "@", "%") & (F.col("m.f") != PLAIN))
    pair = kept.alias("m").join(places.alias("p"), same_as("m", "p", [*of, "q"])) \
        .select(*[f"m.{c}" for c in of], (F.lit(1.0) / F.col("places")).alias("weight"),
                F.explode(slot).alias("s"))
    seen = pair.groupBy(*of, "s.canon", "s.item_raw", "s.doc_raw").agg(F.sum("weight").alias("weight"))
    by_value = seen.groupBy(*of, "canon", "item_raw") \
        .agg(F.max("weight").alias("best"), F.sum("weight").alias("total"))
    slots = by_value.groupBy(*of).agg((F.sum("best") / F.sum("total")).alias("consistency"))
    return held.alias("a").join(slots.alias("b"), same_as("a", "b", of), "left") \
        .where(F.coalesce("consistency", F.lit(1.0)) >= F.lit(consistency)) \
        .select("a.d", "a.k", "a.item_id").distinct()


def _occurrences(matched: DataFrame) -> DataFrame:
    """``matched`` with ``g``, one row for each occurrence a place belongs to."""
    pair = _PAIR
    m = matched.withColumn("shift", F.col("p") - F.col("q"))
    m = m.withColumn("support", F.count(F.lit(1)).over(Window.partitionBy(*pair, "shift")))
    m = m.withColumn("rank", F.row_number().over(
        Window.partitionBy(*pair, "p").orderBy(F.desc("support"), "q")))
    first = F.col("rank") == 1
    # a place's item position goes on from the last one, or a new run begins
    in_order = Window.partitionBy(*pair).orderBy("p", "rank")
    before = F.last(F.when(first, F.col("q")), True).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    m = m.withColumn("turn", F.when(first & (F.col("q") <= before), 1).otherwise(0))
    m = m.withColumn("run", F.sum("turn").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    groups = F.array(F.lit("all"), F.concat(F.lit("shift "), F.col("shift")),
                     F.when(first, F.concat(F.lit("run "), F.col("run"))))
    return m.withColumn("g", F.explode(F.array_compact(groups))).drop("shift", "support", "rank", "turn", "run")


def _joined(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    f = small(stored(found.withColumnRenamed(id_col, "_found_id")
                     .withColumnRenamed("row_key", "_found_key"), "found"), 48)
    return docs.join(f, docs[id_col].eqNullSafe(f["_found_id"])
                     & (_row_key(docs[text_col]) == f["_found_key"]), how)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           **options) -> DataFrame:
    """One row per row of ``docs``: id, n_items, first_item (smallest id of the
    items found, else null), contaminated."""
    per_row = contaminated(docs, benchmark, id_col, text_col, **options).groupBy(id_col, "row_key") \
        .agg(F.count(F.lit(1)).alias("n_items"), F.min("item_id").alias("first_item"))
    return _joined(docs.select(id_col, text_col), per_row, id_col, text_col, "left").select(
        id_col, F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"), "first_item",
        F.col("n_items").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, unchanged."""
    rows = contaminated(docs, benchmark, id_col, text_col, **options).select(id_col, "row_key").distinct()
    return _joined(docs, rows, id_col, text_col, "left_anti").select(docs.columns)
