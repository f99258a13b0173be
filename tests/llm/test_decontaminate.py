"""Operator 3: canonical form, re-parameterised items, slot consistency."""
import random

import pytest
from pyspark.sql import functions as F

from claimlens.llm import decontaminate as dc

ITEM = ("Alice Smith has 12 apples and gives 5 apples to Bob. Later Alice Smith buys 3 kg of pears for Bob and "
        "walks 7 km home with him in the rain while counting all of the fruit she has left.")


def other_values(names=("Carol Jones", "Dave"), numbers=("40", "9", "8", "2")):
    t = ITEM.replace("Alice Smith", names[0]).replace("Bob", names[1])
    for a, b in zip(("12", "5", "3", "7"), numbers, strict=True):
        t = t.replace(f" {a} ", f" {b} ")
    return t.replace(" kg ", " lb ").replace(" km ", " miles ")


def noise(seed, n=200):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "River", "stone", "4", "km", "Walter", "was"]) for _ in range(n))


@pytest.fixture
def bench(spark):
    return spark.createDataFrame(
        [(1, ITEM, 5, "x"), (1, ITEM, 5, "x"), (2, "Short Question", 5, "x"), (3, None, 5, "x"), (4, "", 5, "x"),
         (None, ITEM, 5, "x"), (5, "the quick brown fox jumps over the lazy dog near a quiet river bank today", 5, "x")],
        "item_id bigint, text string, d int, w string")


def tokens(spark, text, names=True):
    df = spark.createDataFrame([(text,)], "text string")
    r = df.select(dc.canonical_tokens(F.col("text"), names).alias("c"), dc.raw_tokens(F.col("text"), names).alias("r")).first()
    assert len(r.c) == len(r.r)
    return r.c, r.r


def test_canonical_form(spark):
    assert tokens(spark, "John Smith ran 3.5 km, then 12kg of ÉTÉ fish; It was 7") == (
        ["@", "ran", "0", "%", "then", "0", "%", "of", "été", "fish", "@", "was", "0"],
        ["John Smith", "ran", "3 5", "km", "then", "12", "kg", "of", "ÉTÉ", "fish", "It", "was", "7"])
    assert tokens(spark, "John Smith ran", False)[0] == ["john", "smith", "ran"]
    assert tokens(spark, "") == ([], []) and tokens(spark, " .,! ") == ([], [])


def test_found_items(docs_of, bench):
    inconsistent = ITEM.replace("Alice Smith has", "Zoe has", 1).replace("to Bob", "to Max")
    rows = [(1, noise(1) + " " + ITEM + " " + noise(2)), (2, noise(3) + other_values() + noise(4)), (3, noise(5)),
            (4, ITEM.upper()), (5, "half of it: " + ITEM[:70]), (6, None), (7, ""), (8, "SHORT question"), (9, noise(6, 60_000) + ITEM),
            (None, ITEM), (None, "clean"), (10, ITEM), (10, "clean"), (11, ITEM + " " + ITEM), (12, inconsistent),
            (13, "The Quick brown fox jumps over the lazy dog near a quiet river bank today")]
    rows += [(14, "Éan " * 60_000), (15, "7 " * 60_000 + ITEM)]
    docs = docs_of(rows)
    got = sorted((r.doc_id or -1, r.contaminated, r.n_items, r.first_item or -1) for r in dc.report(docs, bench).collect())
    assert got == [(-1, False, 0, -1), (-1, True, 1, 1), (1, True, 1, 1), (2, True, 1, 1), (3, False, 0, -1), (4, True, 1, 1),
                   (5, False, 0, -1), (6, False, 0, -1), (7, False, 0, -1), (8, True, 1, 2), (9, True, 1, 1),
                   (10, False, 0, -1), (10, True, 1, 1), (11, True, 1, 1), (12, True, 1, 1), (13, True, 1, 5),
                   (14, False, 0, -1), (15, True, 1, 1)]
    docs = docs.withColumns({"_row_key": F.lit(1), "_found_id": F.lit(2), "_found_key": F.lit(3), "row_key": F.lit(4)})
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 3, 5, 6, 7, 10, 14]
    assert {(r._row_key, r._found_id, r._found_key, r.row_key) for r in kept.collect()} == {(1, 2, 3, 4)}


def test_a_value_must_stand_for_one_value(docs_of, spark):
    item = "We know that 4 plus 4 is not 9 but 4 times 4 is more than 9 and 4 less 9 is below 4 of 4"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    swapped = item.replace(" 4", " 6").replace(" 9", " 11")
    rng = random.Random(3)
    mixed = " ".join(str(rng.randrange(100, 999)) if w in "49" else w for w in item.split())
    got = {r.doc_id: r.contaminated for r in dc.report(docs_of([(1, swapped), (2, mixed)]), bench).collect()}
    assert got == {1: True, 2: False}


def test_each_occurrence_is_judged_by_itself(docs_of, bench):
    one, two = other_values(), other_values(("Eve Brown", "Mallory"), ("61", "77", "5", "13"))
    inserted = ITEM.replace("Later", "Later that very long and rather cold day in spring")
    docs = docs_of([(1, ITEM + " " + one), (2, one + " and then " + ITEM + " and then " + two), (3, one + "\n" + two),
                    (4, noise(1) + one + noise(2) + two + noise(3) + ITEM), (5, inserted + " or else " + one),
                    (6, ITEM[:80] + " or " + one[:80]), (7, " ".join([one, two, ITEM] * 200))])
    got = {r.doc_id: r.first_item for r in dc.report(docs, bench).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: None, 7: 1}


def test_no_python_in_the_plan_and_empty_tables(docs_of, bench, spark):
    docs = docs_of([(1, ITEM)])
    plan = dc.report(docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert dc.report(docs_of([]), bench).collect() == []
    assert [r.contaminated for r in dc.report(docs, bench.where("false")).collect()] == [False]


def test_items_of_numbers_or_names_only(docs_of, spark):
    """All windows of both template forms are placeholders: the plain form counts."""
    bench = spark.createDataFrame([(1, "2 4 8 16 32 64"), (2, "12 + 7 = 19; 3 + 8 = 11"), (3, "Anna Berta Carla Dora Emma Frieda")],
                                  "item_id bigint, text string")
    docs = docs_of([(1, "Go on: 2, 4, 8, 16, 32, 64 and so on"), (2, "3 5 9 17 33 65"), (3, "so 12 + 7 = 19; 3 + 8 = 11."),
                    (4, "12 + 7 = 20; 3 + 8 = 12"), (5, "anna berta carla dora emma frieda"), (6, "Xaver Yvonne Zoe Udo Vera Willi"),
                    (7, noise(1))])
    got = {r.doc_id: r.first_item for r in dc.report(docs, bench).collect()}
    assert got == {1: 1, 2: None, 3: 2, 4: None, 5: 3, 6: None, 7: None}


def test_the_sql_judges_occurrences_too(docs_of, bench, spark):
    import duckdb

    from claimlens.llm.decontaminate_sql import SQL
    one, two = other_values(), other_values(("Eve Brown", "Mallory"), ("61", "77", "5", "13"))
    inserted = ITEM.replace("Later", "Later that very long and rather cold day in spring")
    rng = random.Random(8)
    texts = [ITEM + " " + one, one + " and then " + ITEM + " and then " + two, one + "\n" + two, ITEM[:90] + " or " + one[:80],
             inserted + " or else " + one, ITEM.upper(), "half of it: " + ITEM[:70], noise(3), None, "",
             "the quick brown fox jumps over the lazy dog near a quiet river bank today 1 2 3 4 5 6",
             " ".join(rng.sample(ITEM.split(" "), len(ITEM.split(" ")))), ITEM[70:] + " " + ITEM[:70]]
    for _ in range(40):     # passages cut and mixed
        parts = [rng.choice([ITEM, one, two, noise(rng.randrange(9), 20), inserted]) for _ in range(rng.randrange(1, 4))]
        texts.append(" ".join(p[rng.randrange(0, 40):len(p) - rng.randrange(0, 40)] for p in parts))
    docs = docs_of(list(enumerate(texts)))
    items = [tuple(r) for r in bench.select("item_id", "text").collect()] + [(9, "2 4 8 16 32 64")]
    items = spark.createDataFrame(items, "item_id bigint, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [[i, t] for i, t in enumerate(texts)])
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", [list(r) for r in items.collect()])
    want = sorted(con.execute(f"SELECT doc_id, n_items, first_item, contaminated FROM ({SQL})").fetchall(), key=repr)
    got = sorted(((r.doc_id, r.n_items, r.first_item, r.contaminated) for r in dc.report(docs, items).collect()), key=repr)
    assert got == want and sum(r[3] for r in got) > 10
