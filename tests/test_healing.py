"""Tables completed from siblings, against all pairs."""

import random
import time

from pyspark.sql import functions as F

from recordforge.operators import healing as H


def md(rows):
    return "\n".join([f"| {rows[0]} |", "|---|", *[f"| {r} |" for r in rows[1:]]]) if rows else ""


def test_siblings_equal_all_pairs(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(2), rng.randrange(60), k, ["H", *sorted(rng.sample("abcd", rng.randrange(4)))] + ["a"] * rng.randrange(2)) for k in range(120)]
    rows += [(0, 70, 200, []), (0, 71, 201, [" ", "x"]), (0, 72, 202, ["G"]), (0, 72, 203, ["G", "z"]), (0, 73, 204, ["G", "z"]), (0, 73, 205, ["G"]), (None, 74, 206, ["H"])]
    want = {}
    for c, i, p, r in rows:
        less = lambda r: [x.strip().lower() for x in r]
        d = [(len(s), -j, -q, md(s)) for e, j, q, s in rows if e == c is not None and j != i and less(s)[:1] in (less(r)[:1], [*less(r), ""][:1]) and set(less(r)) <= set(less(s)) and len(s) > len(r)]
        want[p] = max(d)[3] if d else md(r)
    df = spark.createDataFrame([(c, i, p, md(r)) for c, i, p, r in rows], "chapter int, id int, pos int, markdown string")
    got = H.complete_tables(df)
    assert got.columns == ["chapter", "id", "pos", "markdown", "healed"]
    assert {r.pos: r.healed for r in got.collect()} == want


def test_many_copies_do_not_meet_in_pairs(spark):
    """20,000 tables of one header: 3 * 10^8 pairs, of four classes."""
    df = spark.range(20000).selectExpr("1 as chapter", "id", "0 as pos", "concat('| H |\n|---|\n| a |', repeat('\n| b |', int(id % 4))) as markdown")
    began = time.time()
    assert H.complete_tables(df).where("healed <> markdown").count() == 15000
    assert time.time() - began < 60


def test_a_repeated_text_is_read_once(spark):
    """30,000 tables of four texts of up to 1,200 rows; to split each of them into rows took 55 s."""
    df = spark.range(30000).selectExpr("1 as chapter", "id", "0 as pos", "concat('| H |\n|---|', array_join(transform(sequence(1, 300 * (1 + int(id % 4))), x -> concat('\n| row ', x, ' |')), '')) as markdown")
    began = time.time()
    got = H.complete_tables(df).groupBy(F.size(F.split("markdown", "\n")).alias("was"), F.size(F.split("healed", "\n")).alias("now")).count().collect()
    assert sorted(map(tuple, got)) == [(302 + 300 * k, 1202, 7500) for k in range(4)]
    assert time.time() - began < 30


def test_copies_of_one_text_are_given_by_the_first_of_another_id(spark):
    """A text that one id has twice and others have, too; missing ids and places give and get nothing."""
    rows = [(0, 1, 0, ["H", "a"]), (0, 1, 1, ["H", "a", "b"]), (0, 1, 2, ["H", "a", "b"]), (0, 2, 5, ["h ", " A", "b"]), (0, 2, 3, ["H", "a", "b"]), (0, 3, 0, ["H", "a"]), (0, None, 0, ["H", "a"]), (0, 0, None, ["H", "a", "b", "c"])]
    df = spark.createDataFrame([(c, i, p, md(r)) for c, i, p, r in rows], "chapter int, id int, pos int, markdown string")
    got = [r.healed for r in H.complete_tables(df.repartition(3)).collect()]
    assert sorted(got) == sorted([md(rows[4][3]), md(rows[1][3]), md(rows[2][3]), md(rows[3][3]), md(rows[4][3]), md(rows[1][3]), md(rows[6][3]), md(rows[7][3])])
