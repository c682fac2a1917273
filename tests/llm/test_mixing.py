import bisect

import duckdb
from pyspark.sql import Row
import pytest

from recordforge.llm import mixing


def rows():
    out = [(i, f"s{i % 5}" if i % 5 < 4 else None, "w " * (i * 7 % 90)) for i in range(300)]
    out += [(i, "hot", "a b\tc d " * (i % 30)) for i in range(300, 900)]
    return out + [(None, "s1", "x y z"), (7, "s2", "a b"), (7, "s2", "a b"), (1000, "big", "z " * 20_000), (1001, "none", None), (1002, "none", "")]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("mix"))
    spark.createDataFrame([(*r, 1) for r in rows()], "doc_id long, source string, text string, size int").repartition(3).write.parquet(f"{d}/documents.parquet")
    return d


def waterfill(sizes):
    """Targets by repeated resharing."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        aim = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if aim[s] > 2 * sizes[s]]
        if not over:
            return fixed | aim
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_query_equals_sql_and_keeps_its_promises(spark, data):
    got = mixing.op7_mix(spark, data).collect()
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{data}/documents.parquet/*.parquet'")
    want = con.execute(f"select doc_id, size, source_size, target, taken, first_slot, n_slots, slot_sum from ({mixing.ORACLE})").fetchall()
    show = lambda r: str((r[0], r[1], r[2], round(r[3], 6), *r[4:]))
    assert sorted(map(show, want)) == sorted(map(show, got))
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    sizes = {}
    for _, s, t in rows():
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    aims = waterfill(sizes)
    assert {round(r.target, 6) for r in got} == {round(a, 6) for a in aims.values()}


def test_pieces_are_the_schedule(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out, pieces = mixing.mix(docs)
    by_doc = {}
    for r in pieces.collect():
        by_doc[r.doc_id] = by_doc.get(r.doc_id, 0) + r.words
    assert by_doc == {d: n for d, n in out.groupBy("doc_id").sum("taken").collect() if n}
    slots = mixing.schedule(spark.createDataFrame([(0, 300), (1, 100), (2, 200)], "si int, want long")).collect()
    assert sorted((r.si, r.block) for r in slots) == [(s, b) for s, n in ((0, 300), (1, 100), (2, 200)) for b in range(n)]
    head = [r.si for r in sorted(slots, key=lambda r: r.slot)[:120]]
    assert abs(head.count(0) - 60) <= 4 and abs(head.count(1) - 20) <= 4


def test_empty_and_blank_tables(spark, tmp_path):
    schema = "doc_id long, source string, text string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    assert mixing.op7_mix(spark, f"{tmp_path}/a").collect() == []
    spark.createDataFrame([(1, "s", ""), (2, None, None)], schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert {(r.doc_id, r.taken) for r in mixing.op7_mix(spark, f"{tmp_path}/b").collect()} == {(1, 0), (2, 0)}


def test_many_sources_share_the_line(spark):
    quota = [(i, 1 + i % 7) for i in range(6000)]
    slots = mixing.schedule(spark.createDataFrame(quota, "si int, want long")).collect()
    assert sorted((r.si, r.block) for r in slots) == [(s, b) for s, n in quota for b in range(n)]
    n = sum(w for _, w in quota)
    ends, total = [], 0
    for _, w in quota:
        total += w
        ends.append(total)
    for r in slots:
        if r.slot < n:
            point = (r.slot + 1) * mixing.PHI
            assert bisect.bisect_right(ends, (point % 1) * n) == r.si


def test_columns_of_any_name_are_kept_and_reruns_agree(spark):
    names = ["times", "rows", "n", "r", "_h", "_row", "si", "has", "size", "taken", "start", "bucket", "key", "m", "copies", "sharers", "block", "slot"]
    rows = [(i % 4, "s" if i % 4 < 3 else None, "a b c d e " * (1 + i % 4), *[f"{c}{i}" for c in names]) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, " + ", ".join(f"`{c}` string" for c in names))
    got = [sorted(map(str, mixing.mixed(df.repartition(k)).collect())) for k in (1, 3)]
    assert got[0] == got[1] and mixing.mixed(df).columns == df.columns
    taken, _ = mixing.mix(df.select("doc_id", "source", "text"))
    assert len(got[0]) == sum(int(r.taken / r.size + 0.5) for r in taken.collect())
    assert set(got[0]) <= {str(Row(**dict(zip(df.columns, r)))) for r in rows}
