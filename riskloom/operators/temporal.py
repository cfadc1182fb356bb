"""Joins and groups over event time.

``asof_join``      each left row with the last right row of its keys at or before its time;
``interval_join``  right rows whose time lies in an interval around the left row's;
``sessions``       runs of events with no gap over a limit, per key.

All are equi-shuffles on the keys and a slice of time, never a nested loop.  A key with a large share
of the rows is cut by time: into slices of a bounded number of rows (as-of), into buckets of the
interval's length (interval), into calendar slices whose partial sessions are merged
(sessions); so no task holds all rows of a hot key.  Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize


def _micros(time: Column) -> Column:
    """A time stamp as microseconds; one without zone is taken in the session's, which the reports set to UTC."""
    return F.unix_micros(time.cast("timestamp"))


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
              values: dict[str, str], tie: Sequence[str] = (), tolerance_seconds: int | None = None,
              strict: bool = False, slice_rows: int = 1_000_000) -> DataFrame:
    """``left`` with the columns ``values`` (right name -> result name) of the last right row
    with equal ``on`` and a time at or before (``strict``: before) the left row's; null where there is none,
    or none within ``tolerance_seconds``.  Of right rows at one time, the greatest in
    ``tie`` (then in ``values``) counts.

    Both sides are one stream sorted by time per key, along which the last right row is carried.  A key with more than
    ``slice_rows`` rows is cut into time slices at its quantiles; each slice carries its own rows, and the
    last right row before the slice comes from a table with one row per slice.

    Left rows with a null key or time are kept, with nulls; right rows with one are dropped;
    columns of either side may have any name; all rows of one key at one time are in one slice.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    payload = F.struct(F.col(right_time).alias("time"), F.struct(*[F.col(t) for t in tie]).alias("tie") if tie else F.lit(0).alias("tie"),
                       F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]).alias("values"))
    events = right.select(*[F.col(o).alias(k) for o, k in zip(on, keys)], F.col(right_time).alias("_time"), payload.alias("_right"))
    asks = left.select(*[F.col(o).alias(k) for o, k in zip(on, keys)], F.col(left_time).alias("_time"),
                       F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left"))
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in [*keys, "_time"]])
    # a left row comes after the right rows of its time, or (strict) before them
    side = lambda n: F.lit(n).alias("_side")
    both = events.filter(known).select(*keys, "_time", side(1), F.lit(None).cast(asks.schema["_left"].dataType).alias("_left"), "_right").union(
        asks.filter(known).select(*keys, "_time", side(0 if strict else 2), "_left", F.lit(None).cast(events.schema["_right"].dataType)))

    many = both.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slice_rows)
    hot = materialize(many, "asof-hot")
    if hot.isEmpty():
        sliced = both.withColumn("_slice", F.lit(0))
    else:
        most = -(-hot.agg(F.max("n")).first()[0] // slice_rows)
        cuts = F.percentile_approx(_micros(F.col("_time")), [i / most for i in range(1, most)], 10_000) if most > 1 else F.array()
        bounds = materialize(both.join(hot.drop("n"), keys, "left_semi").groupBy(*keys).agg(F.array_distinct(cuts).alias("_cuts")), "asof-cuts")
        before = F.size(F.filter("_cuts", lambda c: c < _micros(F.col("_time"))))
        sliced = both.join(bounds, keys, "left").withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(before)).drop("_cuts")
    along = Window.partitionBy(*keys, "_slice").orderBy("_time", "_side", "_right").rowsBetween(Window.unboundedPreceding, 0)
    carried = sliced.withColumn("_last", F.last("_right", ignorenulls=True).over(along)).filter("_left is not null")
    if not hot.isEmpty():
        ends = materialize(sliced.filter("_right is not null").join(hot.drop("n"), keys, "left_semi").groupBy(*keys, "_slice").agg(
            F.max("_right").alias("_end")), "asof-ends")
        # one row per slice; slices without right rows too
        asked = materialize(sliced.filter("_left is not null").join(hot.drop("n"), keys, "left_semi").select(*keys, "_slice").distinct(), "asof-slices")
        earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        entry = asked.join(ends, [*keys, "_slice"], "full").withColumn("_entry", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
        carried = carried.join(materialize(entry, "asof-entries"), [*keys, "_slice"], "left").withColumn(
            "_last", F.coalesce("_last", "_entry"))
    if tolerance_seconds is not None:
        near = _micros(F.col("_time")) - _micros(F.col("_last.time")) <= tolerance_seconds * 1_000_000
        carried = carried.withColumn("_last", F.when(near, F.col("_last")))
    names = [F.col(f"_last.values.v{i}").alias(name) for i, name in enumerate(values.values())]
    found = carried.select("_left.*", *names)
    types = [found.schema[name].dataType for name in values.values()]
    rest = asks.filter(~known).select("_left.*", *[F.lit(None).cast(t).alias(name) for t, name in zip(types, values.values())])
    return found.union(rest)


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
                  lower_seconds: int, upper_seconds: int, values: dict[str, str]) -> DataFrame:
    """Pairs of a left and a right row with equal ``on`` where the right time minus the left
    time lies in [``lower_seconds``, ``upper_seconds``]: the left columns and the columns ``values`` (right
    name -> result name).

    Time is cut into buckets as long as the interval.  A right row is in one bucket, a left row in the one or two that its
    interval meets, so every pair meets once, in an equi-join on keys and bucket.  Rows with a null
    key or time pair with nothing.
    """
    if upper_seconds < lower_seconds:
        raise ValueError("upper_seconds must not be under lower_seconds")
    width = max(1, upper_seconds - lower_seconds) * 1_000_000
    keys = [f"_k{i}" for i in range(len(on))]
    bucket = lambda micros: F.floor(micros / width)
    a = left.select(*[F.col(o).alias(k) for o, k in zip(on, keys)], _micros(F.col(left_time)).alias("_from"),
                    F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left")).filter("_from is not null")
    a = a.withColumn("_from", F.col("_from") + lower_seconds * 1_000_000).withColumn(
        "_bucket", F.explode(F.sequence(bucket(F.col("_from")), bucket(F.col("_from") + (upper_seconds - lower_seconds) * 1_000_000))))
    b = right.select(*[F.col(o).alias(k) for o, k in zip(on, keys)], _micros(F.col(right_time)).alias("_at"),
                     *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)]).filter("_at is not null").withColumn("_bucket", bucket(F.col("_at")))
    pairs = a.join(b, [*keys, "_bucket"]).filter(
        (F.col("_at") >= F.col("_from")) & (F.col("_at") <= F.col("_from") + (upper_seconds - lower_seconds) * 1_000_000))
    return pairs.select("_left.*", *[F.col(f"_v{i}").alias(name) for i, name in enumerate(values.values())])


def sessions(events: DataFrame, on: Sequence[str], time: str, gap_seconds: int, sums: dict[str, Column] | None = None,
             slice_seconds: int = 30 * 86_400) -> DataFrame:
    """One row per session: ``on``, session_start, session_end (times of the first and last event), events,
    and the sums ``sums`` (result name -> column).  A session ends where the next event of its keys
    comes more than ``gap_seconds`` later.

    Events are first grouped per key and calendar slice; the partial sessions, at most one more per slice than
    there are sessions, are then merged per key, so a hot key's events spread over its
    slices.  Null keys are one key; events with a null time belong to no session.
    """
    sums = sums or {}
    gap, stamp = gap_seconds * 1_000_000, _micros(F.col(time))
    rows = events.filter(F.col(time).isNotNull()).select(
        *[F.col(o).alias(f"_k{i}") for i, o in enumerate(on)], F.col(time).alias("_first"), F.col(time).alias("_last"),
        F.lit(1).cast("long").alias("_n"), *[c.alias(f"_s{i}") for i, c in enumerate(sums.values())],
        F.floor(stamp / (slice_seconds * 1_000_000)).alias("_slice"))
    keys = [f"_k{i}" for i in range(len(on))]

    def merge(parts: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy("_first", "_last")
        begins = F.coalesce(_micros(F.col("_first")) - _micros(F.max("_last").over(w.rowsBetween(Window.unboundedPreceding, -1))) > gap, F.lit(True))
        number = F.sum(begins.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
        return parts.withColumn("_session", number).groupBy(*by, "_session").agg(
            F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"),
            *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(sums))]).drop("_session")

    whole = merge(merge(rows, [*keys, "_slice"]).drop("_slice"), keys)
    return whole.select(*[F.col(k).alias(o) for k, o in zip(keys, on)], F.col("_first").alias("session_start"),
                        F.col("_last").alias("session_end"), F.col("_n").alias("events"),
                        *[F.col(f"_s{i}").alias(name) for i, name in enumerate(sums)])
