"""Event-time operators against row-by-row versions, hot keys and odd rows included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import temporal
from riskloom.plans import timeline
from riskloom.sources.tables import read_table, timed_transactions
from tests.conftest import SF001

DAY0 = dt.datetime(2020, 1, 1)


def stamp(hours):
    return None if hours is None else DAY0 + dt.timedelta(hours=hours)


def streams(n=400, seed=3):
    """Rows (key, hour, value): key 0 has most of them, times and rows repeat, some are null."""
    rng = random.Random(seed)
    key = lambda: rng.choice([0, 0, 0, 0, 1, 2, 3, None])
    hour = lambda: rng.choice([None] + [rng.randint(0, 300)] * 12)
    left = [(key(), hour(), f"l{i}") for i in range(n)]
    right = [(key(), hour(), f"r{rng.randint(0, 60)}") for i in range(n // 3)]
    return left + left[:5], right + right[:5]


def frames(spark, left, right):
    make = lambda rows, schema: spark.createDataFrame([(k, stamp(h), v, 1) for k, h, v in rows], schema)
    return (make(left, "k int, t timestamp_ntz, v string, _slice int"),
            make(right, "k int, t timestamp_ntz, v string, _time int"))


@pytest.mark.parametrize("slice_rows", [10, 75, 10_000])
@pytest.mark.parametrize("strict, tolerance", [(False, None), (True, None), (False, 5), (True, 30)])
def test_asof_against_scanning(spark, slice_rows, strict, tolerance):
    left, right = streams()
    a, b = frames(spark, left, right)
    got = temporal.asof_join(a, b, ["k"], "t", "t", {"v": "found", "t": "at"}, tie=["v"], strict=strict, slice_rows=slice_rows,
                             tolerance_seconds=None if tolerance is None else tolerance * 3600)
    assert got.columns == ["k", "t", "v", "_slice", "found", "at"]
    want = []
    for k, h, v in left:
        before = [(g, w) for q, g, w in right if None not in (k, h, g) and q == k and (g < h or g == h and not strict)]
        best = max(before, default=(None, None))
        if best[0] is not None and tolerance is not None and h - best[0] > tolerance:
            best = (None, None)
        want.append((k, stamp(h), v, best[1], stamp(best[0])))
    assert sorted(map(str, [(r.k, r.t, r.v, r.found, r.at) for r in got.collect()])) == sorted(map(str, want))


def test_asof_empty_sides(spark):
    a, b = frames(spark, [(1, 5, "x"), (None, 1, "y")], [])
    assert sorted((r.v, r.found) for r in temporal.asof_join(a, b, ["k"], "t", "t", {"v": "found"}).collect()) == [("x", None), ("y", None)]
    assert temporal.asof_join(a.limit(0), a, ["k"], "t", "t", {"v": "found"}).collect() == []


def test_asof_cuts_a_hot_key(spark, monkeypatch):
    """No window task holds more than a few slices' worth of the hot key."""
    left = [(0, i % 997, f"l{i}") for i in range(4000)]
    a, b = frames(spark, left, [(0, i, f"r{i}") for i in range(0, 990, 7)])
    got = temporal.asof_join(a, b, ["k"], "t", "t", {"v": "found"}, slice_rows=500)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_k0" in plan and "_slice" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan
    want = {v: f"r{h // 7 * 7 if h < 990 else 987}" for _, h, v in left}
    assert {r.v: r.found for r in got.collect()} == want


@pytest.mark.parametrize("lower, upper", [(0, 10), (-20, -3), (-5, 5), (4, 4)])
def test_interval_against_all_pairs(spark, lower, upper):
    left, right = streams(120)
    a, b = frames(spark, left, right)
    got = temporal.interval_join(a, b, ["k"], "t", "t", lower * 3600, upper * 3600, {"v": "w"})
    want = [(k, v, w) for k, h, v in left for q, g, w in right
            if None not in (k, h, q, g) and k == q and lower <= g - h <= upper]
    assert sorted((r.k, r.v, r.w) for r in got.collect()) == sorted(want) and (want or lower == upper)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_interval_bounds():
    with pytest.raises(ValueError):
        temporal.interval_join(None, None, [], "t", "t", 1, 0, {})


@pytest.mark.parametrize("slice_hours", [1, 24, 10_000])
@pytest.mark.parametrize("gap", [0, 2, 9])
def test_sessions_against_scanning(spark, gap, slice_hours):
    left, _ = streams(150)
    a, _ = frames(spark, left, [])
    got = temporal.sessions(a, ["k"], "t", gap * 3600, {"total": F.lit(2)}, slice_seconds=slice_hours * 3600)
    want = []
    for k in (0, 1, 2, 3, None):
        hours = sorted(h for q, h, _ in left if q == k and h is not None)
        run = []
        for h in hours:
            if run and h - run[-1] > gap:
                want.append((k, stamp(run[0]), stamp(run[-1]), len(run), 2 * len(run)))
                run = []
            run.append(h)
        if run:
            want.append((k, stamp(run[0]), stamp(run[-1]), len(run), 2 * len(run)))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def _run_stream(spark, tmp_path, report, rows):
    """The rows of ``report`` over ``rows`` landing as three files in time order, then a late end marker."""
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    folder = str(tmp_path / "land")
    cut = rows.select(F.expr("percentile_approx(txn_time, array(0.33, 0.66))").alias("c")).first().c
    stampless = rows.withColumn("txn_time", F.col("txn_time").cast("timestamp"))
    at = F.col("txn_time")
    parts = [stampless.where(at <= F.lit(cut[0])), stampless.where((at > F.lit(cut[0])) & (at <= F.lit(cut[1]))), stampless.where(at > F.lit(cut[1]))]
    end = stampless.limit(1).withColumn("loan_id", F.lit("END")).withColumn("transaction_type", F.lit("Cash_Withdrawal")).withColumn(
        "txn_time", F.lit("2100-01-01").cast("timestamp"))
    for p in [*parts, end]:
        p.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(stampless.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out, name = str(tmp_path / "out"), "t"
    running = report(stream)
    running.writeStream.format("parquet").outputMode("append").option("path", out).option(
        "checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).queryName(name).start().awaitTermination()
    return spark.read.schema(running.schema).parquet(out).where("loan_id <> 'END'")


@pytest.mark.parametrize("batch, running", [(timeline.structuring_windows, timeline.structuring_windows_running),
                                            (timeline.withdrawal_bursts, timeline.withdrawal_bursts_running)])
def test_streams_give_the_batch_rows(spark, tmp_path, batch, running):
    rows = timed_transactions(read_table(spark, SF001, "lineitem"))
    # files land in the order of their names, which is not that of time: the watermark allows for all of it
    got = _run_stream(spark, tmp_path, lambda s: running(s, delay="20000 days"), rows)
    want = batch(rows)
    both = sorted(map(tuple, want.collect()))
    assert len(both) > 20
    assert sorted(map(tuple, got.select(*want.columns).collect())) == both


def test_late_rows_are_left_out_and_state_goes(spark, tmp_path):
    """A row past its window's end plus the delay changes nothing any more."""
    rows = timed_transactions(read_table(spark, SF001, "lineitem")).where("transaction_type = 'Cash_Withdrawal'").limit(1)
    make = lambda day, n: rows.withColumn("txn_time", F.lit(day).cast("timestamp")).crossJoin(spark.range(n)).drop("id")
    folder, out = str(tmp_path / "land"), str(tmp_path / "out")
    schema = make("2020-01-01", 1).schema
    def run():
        stream = spark.readStream.schema(schema).parquet(folder)
        timeline.structuring_windows_running(stream, "1 day", 10, 10, 2).writeStream.format("parquet").outputMode("append").option(
            "path", out).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination()
        return sorted((str(r.window_start), r.txns) for r in spark.read.parquet(out).collect())
    make("2020-01-05", 3).write.mode("append").parquet(folder)
    assert run() == []  # the window is open
    make("2020-03-01", 1).write.mode("append").parquet(folder)
    first = run()
    assert [n for _, n in first] == [3]
    make("2020-01-05", 5).write.mode("append").parquet(folder)  # late; the query starts again from its checkpoint
    make("2020-06-01", 1).write.mode("append").parquet(folder)
    assert run() == first
