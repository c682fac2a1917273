import datetime as dt

from pyspark.sql import functions as F

from recordforge.operators import review
from recordforge.streaming import ledgers as L

T0 = dt.datetime(2024, 1, 1, 12)


def stream(spark, tmp_path, parts, schema, name="in"):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    return L.read_files(spark, f"{tmp_path}/{name}", spark.createDataFrame([], schema).schema)


def drain(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name).collect()


def test_ledger_to_state_equals_batch(spark, tmp_path):
    schema = "k string, pos int, action string"
    parts = [[("a", 1, "approved"), ("b", 1, "approved")], [("a", 2, "reopened")], [("a", 0, "late")]]
    s = stream(spark, tmp_path, parts, schema)
    got = drain(L.current_state(s, "k", ["pos"], ["action"]), "ledger_state", "complete")
    batch = L.current_state(spark.read.parquet(f"{tmp_path}/in"), "k", ["pos"], ["action"]).collect()
    assert {(r.k, r.action) for r in got} == {("a", "reopened"), ("b", "approved")} == {(r.k, r.action) for r in batch}


def test_watermark_closes_windows(spark, tmp_path):
    schema = "ts timestamp, k string"
    parts = [[(T0, "a"), (T0, "a")], [(T0 + dt.timedelta(hours=3), "a")], [(T0, "a")], [(T0 + dt.timedelta(hours=6), "a")]]
    s = stream(spark, tmp_path, parts, schema)
    got = drain(L.windowed_counts(s, "ts", "10 minutes", "1 hour", "k"), "window_counts", "append")
    assert {(r.start.hour, r.n) for r in got} >= {(12, 2), (15, 1)} or {(r.start.hour, r.n) for r in got} >= {(12, 3), (15, 1)}


def test_carried_blocks_equal_batch(spark, tmp_path):
    schema = "conv_id long, turn long, text string"
    parts = [[(1, 0, "open"), (1, 1, "closed."), (2, 0, "done.")], [(1, 2, "x."), (2, 1, "open"), (2, 2, None)]]
    s = stream(spark, tmp_path, parts, schema)
    got = drain(L.carried_blocks(s), "carried", "append")
    batch = review.carry(spark.read.parquet(f"{tmp_path}/in"), "conv_id", "turn", ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[.!?]\s*$")).collect()
    assert {(r.conv_id, r.turn, r.carried) for r in got} == {(r.conv_id, r.turn, r.carried) for r in batch}


def test_daily_calls(spark, tmp_path):
    schema = "key string, ts timestamp"
    s = stream(spark, tmp_path, [[("a", T0)] * 3, [("a", T0 - dt.timedelta(hours=6))]], schema)
    got = drain(L.daily_calls(s, cap=3), "calls", "complete")
    assert {(r.day, r.calls, r.spent) for r in got} == {("2024-01-01", 3, True), ("2023-12-31", 1, False)}


def test_late_fragments_meet_their_owner(spark, tmp_path):
    h = dt.timedelta(hours=1)
    f = stream(spark, tmp_path, [[("x", T0), ("y", T0)], [("z", T0 + 9 * h)], [("zz", T0 + 20 * h)]], "frag_key string, ts timestamp", "f")
    o = stream(spark, tmp_path, [[("x", 7, T0 + h / 2)], [("w", 8, T0 + 9 * h)], [("ww", 8, T0 + 20 * h)]], "frag_key string, owner int, owner_ts timestamp", "o")
    got = {r.frag_key: r.owner for r in drain(L.late_fragments(f, o), "late", "append")}
    assert got["x"] == 7 and got["y"] is None


def test_replacement_is_idempotent(spark, tmp_path):
    schema = "chapter string, n int"
    s = stream(spark, tmp_path, [[("a", 1), ("b", 1)], [("a", 2)]], schema)
    for run in ("one", "two"):
        L.replace_chapters(s, f"{tmp_path}/out", f"{tmp_path}/ck-{run}", "chapter").awaitTermination()
        assert {(r.chapter, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {("a", 2), ("b", 1)}
