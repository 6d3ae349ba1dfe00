"""Trailing transaction velocity per user.

For every transaction ``t`` and window ``w``: the number and the amount sum
of the same user's transactions with ``t.ts - w < x.ts <= t.ts``, the row
itself and equal-time peers included. The window is left-open: it is the
running total up to ``t`` minus the running total up to ``t - w`` (both
``RANGE`` frames over epoch microseconds, exact for counts and decimals).
A NULL user or NULL time matches nothing: both metrics are 0.

Skew: a plain ``partitionBy(user_id)`` sends each user's whole history to one
task. Instead the time axis is cut into buckets of ``bucket_minutes``
(default four times the widest window). Each row is owned by its bucket
``b``; it is also copied, payload-free, into a following bucket ``b + j``
(``j <= k = ceil(max_window / bucket)``) when it lies within the widest
window before that bucket's start, i.e. only where some owner's frame can
reach it. The window runs over ``(user_id, bucket)`` and only owner rows are
kept. A hot user is spread over as many tasks as it has active buckets; with
the default width about a quarter of the rows travel twice, as narrow
copies. All windows share one partition/order spec, so Spark evaluates them
after a single exchange and sort.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewatch.functions.constants import VELOCITY_WINDOWS_MIN
from scorewatch.functions.timecols import MICROS_PER_MINUTE, epoch_micros

SUM_TYPE = "decimal(18,2)"
TARGET_ROWS_PER_TASK = 5_000_000
NOBODY = 1009  # groups for rows without a user or time


def choose_buckets(df: DataFrame, user_col: str, ts_col: str, widest_min: int,
                   target_rows: int = TARGET_ROWS_PER_TASK) -> dict:
    """Pick the strategy and bucket width from the data: the densest
    (user, hour) count comes from one partial-aggregated job (one number
    reaches the driver). Buckets hold about ``target_rows`` of the hottest
    user, at least the widest window (halo copies stay below one per row) and
    at most a day; if even that is too dense, the copy-free probe strategy
    with buckets of whole seconds is used."""
    hour = F.floor(epoch_micros(F.col(ts_col)) / F.lit(3600 * 1_000_000))
    peak = (df.filter(F.col(user_col).isNotNull() & F.col(ts_col).isNotNull())
            .groupBy(F.col(user_col), hour.alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.max("_n").alias("_peak")).first()["_peak"]) or 0
    per_minute = max(peak / 60.0, 1e-9)
    minutes = int(target_rows / per_minute)
    if minutes >= widest_min:
        return {"strategy": "halo", "bucket_minutes": min(minutes, 24 * 60)}
    instants = (df.filter(F.col(user_col).isNotNull() & F.col(ts_col).isNotNull())
                .groupBy(user_col, ts_col).agg(F.count(F.lit(1)).alias("_n"))
                .agg(F.max("_n").alias("_peak")).first()["_peak"])
    if instants > target_rows:
        return {"strategy": "instants", "target_rows_per_task": target_rows}
    return {"strategy": "probe", "bucket_seconds": max(1, int(target_rows / (per_minute / 60.0)))}


def with_velocity(df: DataFrame, user_col: str = "user_id", ts_col: str = "created_at",
                  amount_col: str = "amount_usd",
                  windows_min: Sequence[int] = VELOCITY_WINDOWS_MIN,
                  bucket_minutes: int | str | None = None,
                  metrics: Sequence[str] = ("cnt", "sum"),
                  strategy: str = "halo", bucket_seconds: int | None = None,
                  target_rows_per_task: int = TARGET_ROWS_PER_TASK) -> DataFrame:
    """Add ``cnt_{w}min`` / ``sum_{w}min`` columns for each window ``w``.

    ``strategy="halo"`` (default): one exchange, about a quarter of the rows
    copied. ``strategy="probe"``: no copies and buckets of any width
    (``bucket_seconds``, default 60), for data where one user-bucket of
    halo width could still hold a large share of all rows; it costs a second
    exchange (see :func:`_with_velocity_probe`). ``strategy="instants"``: rows
    of one user and instant are added up first, for data where a single instant
    holds a large share of all rows (see :func:`_with_velocity_instants`).
    ``bucket_minutes="auto"`` picks strategy and width from the data
    (:func:`choose_buckets`).
    """
    if bucket_minutes == "auto":
        return with_velocity(df, user_col, ts_col, amount_col, windows_min, metrics=metrics,
                             **{"target_rows_per_task": target_rows_per_task}
                             | choose_buckets(df, user_col, ts_col, max(windows_min), target_rows_per_task))
    if strategy == "instants":
        return _with_velocity_instants(df, user_col, ts_col, amount_col, windows_min, bucket_minutes, metrics,
                                       target_rows_per_task)
    if strategy == "probe":
        return _with_velocity_probe(df, user_col, ts_col, amount_col, windows_min,
                                    bucket_seconds or 60, metrics)
    if strategy != "halo":
        raise ValueError(f"unknown strategy {strategy!r}")
    one, amount = F.lit(1), F.col(amount_col)
    return _halo(df, user_col, ts_col, amount_col, one, amount, windows_min, bucket_minutes, metrics)


def _halo(df: DataFrame, user_col: str, ts_col: str, weight_col: str, count: Column, amount: Column,
          windows_min: Sequence[int], bucket_minutes: int | None, metrics: Sequence[str]) -> DataFrame:
    """Window totals of ``count`` and ``amount``, expressions of ``weight_col``
    (the one column that copies into a following bucket carry along)."""
    spread = spread_over_buckets(df, user_col, ts_col, weight_col, max(windows_min), bucket_minutes)
    owner = F.col("_shift") == 0

    # (t - w, t] = (-inf, t] minus (-inf, t - w]. Both are UNBOUNDED PRECEDING
    # frames, which Spark evaluates incrementally (a sliding frame would
    # re-aggregate its whole buffer each time its lower bound moves). Rows
    # with a NULL time sit in their own partition, so prefixes never see them.
    spec = Window.partitionBy(user_col, "_pb").orderBy("_us")
    upto_now = spec.rangeBetween(Window.unboundedPreceding, 0)
    guard = F.col(user_col).isNull() | F.col("_us").isNull()
    none = F.lit(0)
    cols = []
    for w in windows_min:
        upto_before = spec.rangeBetween(Window.unboundedPreceding, -w * MICROS_PER_MINUTE)
        if "cnt" in metrics:
            cnt = F.sum(count).over(upto_now) - F.coalesce(F.sum(count).over(upto_before), none)
            cols.append(F.when(guard, none).otherwise(cnt).cast("bigint").alias(f"cnt_{w}min"))
        if "sum" in metrics:
            total = (F.coalesce(F.sum(amount).over(upto_now), none)
                     - F.coalesce(F.sum(amount).over(upto_before), none))
            cols.append(F.when(guard, none).otherwise(total).cast(SUM_TYPE).alias(f"sum_{w}min"))
    out = spread.select("*", *cols).filter(owner)
    return out.select(*df.columns, *out.columns[len(spread.columns):])


def _with_velocity_instants(df: DataFrame, user_col: str, ts_col: str, amount_col: str, windows_min: Sequence[int],
                            bucket_minutes: int | None, metrics: Sequence[str], target_rows: int) -> DataFrame:
    """Velocity by instants: two levels of totals.

    All rows of one user and time have the same windows. They are added up to one
    row per (user, time) with their number and amount (partial sums on the map
    side, so a crowded instant is a row per map task); the windows run over these,
    and the result goes back to the rows by a join on (user, time). There the
    rows of an instant with more than ``target_rows`` are dealt out over
    ceil(n / target_rows) shares and its totals are copied to each.
    """
    known = df.filter(F.col(user_col).isNotNull() & F.col(ts_col).isNotNull())
    instants = known.groupBy(F.col(user_col).alias("_iu"), F.col(ts_col).alias("_it")).agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum(amount_col).alias("s")).alias("_w"))
    totals = _halo(instants, "_iu", "_it", "_w", F.col("_w.n"), F.col("_w.s"), windows_min, bucket_minutes, metrics)
    names = [c for c in totals.columns if c.startswith(("cnt_", "sum_"))]
    shares = F.ceil(F.col("_w.n") / F.lit(target_rows)).cast("int")
    dealt = totals.withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_w")
    rows = deal_out(df, instants, user_col, ts_col, target_rows)
    joined = rows.join(dealt, (F.col(user_col) == F.col("_iu")) & (F.col(ts_col) == F.col("_it"))
                       & (F.col("_s") == F.col("_share")), "left")
    return joined.select(*df.columns, *[F.coalesce(F.col(c), F.lit(0)).cast(totals.schema[c].dataType).alias(c) for c in names])


#: Crowded instants (24 bytes each) that may be broadcast; more are joined by shuffle.
MOST_CROWDED = 100_000


def deal_out(df: DataFrame, instants: DataFrame, user_col: str, ts_col: str, target_rows: int) -> DataFrame:
    """The rows with ``_s``, the share of their instant they go to, by a hash
    of the row. Each crowded instant stands for ``target_rows`` rows at least, so
    there are few; they are counted before they are broadcast."""
    crowded = instants.filter(F.col("_w.n") > target_rows).select(
        F.col("_iu").alias("_cu"), F.col("_it").alias("_ct"), F.ceil(F.col("_w.n") / F.lit(target_rows)).alias("_k"))
    if crowded.limit(MOST_CROWDED + 1).count() <= MOST_CROWDED:
        crowded = F.broadcast(crowded)
    marked = df.join(crowded, (F.col(user_col) == F.col("_cu")) & (F.col(ts_col) == F.col("_ct")), "left")
    # Rows without a user or time meet no instant; they go anywhere.
    nobody = F.col(user_col).isNull() | F.col(ts_col).isNull()
    share = F.pmod(F.xxhash64(*df.columns), F.when(nobody, F.lit(NOBODY)).otherwise(F.coalesce("_k", F.lit(1))))
    return marked.select(*df.columns, share.cast("int").alias("_s"))


def spread_over_buckets(df: DataFrame, user_col: str, ts_col: str, amount_col: str, widest: int,
                        bucket_minutes: int | None) -> DataFrame:
    """The rows and their copies with ``_pb``: one window group per user and
    ``_pb``; owners have ``_shift`` 0."""
    bucket = bucket_minutes or 4 * widest
    if bucket < 1:
        raise ValueError("bucket_minutes must be positive")
    k = math.ceil(widest / bucket)
    bucket_us = bucket * MICROS_PER_MINUTE

    payload = [c for c in df.columns if c not in (user_col, ts_col, amount_col)]
    us = epoch_micros(F.col(ts_col))
    widest_us = widest * MICROS_PER_MINUTE
    staged = (df.withColumn("_us", us)
              .withColumn("_b", F.floor(F.col("_us") / F.lit(bucket_us)))
              .withColumn("_shift", F.explode(F.sequence(
                  F.lit(0), F.when(F.col("_us").isNull(), F.lit(0)).otherwise(F.lit(k))))))
    owner = F.col("_shift") == 0
    # A copy is useful only if it is within the widest window of the start of
    # the bucket it is copied into: (b + j) * bucket - widest < ts.
    reachable = F.col("_us") > (F.col("_b") + F.col("_shift")) * F.lit(bucket_us) - F.lit(widest_us)
    staged = staged.filter(owner | reachable)
    # Context copies keep only what the frame needs: user, time, amount.
    # Rows without a user or time have no window: they go anywhere, so that
    # many of them don't meet in one task.
    nobody = F.col(user_col).isNull() | F.col("_us").isNull()
    return staged.select(
        F.col(user_col), F.col(ts_col), F.col(amount_col), "_us", "_shift",
        F.when(nobody, F.pmod(F.xxhash64(*payload, ts_col, amount_col), F.lit(NOBODY)))
        .otherwise(F.col("_b") + F.col("_shift")).alias("_pb"),
        *[F.when(owner, F.col(c)).alias(c) for c in payload])


def _with_velocity_probe(df: DataFrame, user_col: str, ts_col: str, amount_col: str,
                         windows_min: Sequence[int], bucket_seconds: int,
                         metrics: Sequence[str]) -> DataFrame:
    """Velocity without copies: running totals at probe times.

    ``P(u, tau)`` = count (and amount sum) of user ``u``'s rows with time
    <= ``tau``, so the window ``(t - w, t]`` is ``P(t) - P(t - w)``. Every
    input row becomes one data row (its amount) and one probe per time in
    ``{t} + {t - w}``; the owner probe (at ``t``) carries the payload. Rows
    and probes are bucketed by ``(user, floor(time / bucket))``:

    1. per bucket, the data count/sum and, over a user's buckets in order,
       the totals of all earlier buckets (a narrow table, one row per active
       bucket);
    2. joined to it on the bucket key, one pass per bucket in time order
       (data before probes at equal times) gives each probe the running
       totals inside its bucket; offset + running = ``P(tau)``;
    3. probes are regrouped by their source row (an id assigned before the
       rows were generated, so all pieces of one row share it).

    The largest task holds one user-bucket, whatever its width; nothing is
    replicated beyond the probes.
    """
    bucket_us = bucket_seconds * 1_000_000
    if bucket_us < 1:
        raise ValueError("bucket_seconds must be positive")
    payload = [c for c in df.columns if c not in (user_col, ts_col, amount_col)]
    us = epoch_micros(F.col(ts_col))
    offsets_min = [0, *windows_min]
    # A row is known by its content and its number among equal rows, which a
    # retried task finds again.
    alike = Window.partitionBy("_h", *df.columns).orderBy("_h")
    base = (df.withColumn("_h", F.xxhash64(*df.columns)).withColumn("_nr", F.row_number().over(alike))
            .select(*df.columns, us.alias("_us"), F.struct("_h", "_nr", F.struct(*df.columns).alias("_row")).alias("_rid")))
    pieces = [F.struct(F.lit(0).alias("_kind"), F.col("_us").alias("_tau"), F.lit(-1).alias("_w"))]
    pieces += [F.struct(F.lit(1).alias("_kind"), (F.col("_us") - F.lit(w * MICROS_PER_MINUTE)).alias("_tau"),
                        F.lit(w).alias("_w")) for w in offsets_min]
    gen = base.select(F.col(user_col), F.col(ts_col), F.col(amount_col), *payload, "_rid",
                      F.inline(F.array(*pieces)))
    is_data = F.col("_kind") == 0
    is_owner = (F.col("_kind") == 1) & (F.col("_w") == 0)
    rows = gen.select(
        F.col(user_col), "_rid", "_kind", "_w", "_tau",
        F.floor(F.col("_tau") / F.lit(bucket_us)).alias("_b"),
        F.when(is_data, F.col(amount_col)).alias("_amt"),
        *[F.when(is_owner, F.col(c)).alias(c) for c in (ts_col, amount_col, *payload)])

    per_bucket = rows.groupBy(user_col, "_b").agg(
        F.count_if(F.col("_kind") == 0).alias("_bn"), F.sum("_amt").alias("_bs"))
    before = Window.partitionBy(user_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        F.col(user_col).alias("_ou"), F.col("_b").alias("_ob"),
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off_n"),
        F.coalesce(F.sum("_bs").over(before), F.lit(0)).alias("_off_s"))
    joined = rows.join(offsets, (F.col(user_col) == F.col("_ou")) & (F.col("_b") == F.col("_ob")), "left")

    running = (Window.partitionBy(user_col, "_b").orderBy("_tau", "_kind")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    probed = joined.select(
        "*",
        (F.col("_off_n") + F.sum(F.when(is_data, F.lit(1)).otherwise(F.lit(0))).over(running)).alias("_pn"),
        (F.col("_off_s") + F.coalesce(F.sum("_amt").over(running), F.lit(0))).alias("_ps"),
    ).filter(F.col("_kind") == 1)

    first = lambda c: F.first(F.col(c), ignorenulls=True).alias(c)
    regrouped = probed.groupBy("_rid").agg(
        F.first(F.col(user_col)).alias(user_col), first(ts_col), first(amount_col), *[first(c) for c in payload],
        *[F.max(F.when(F.col("_w") == w, F.col("_pn"))).alias(f"_pn{w}") for w in offsets_min],
        *[F.max(F.when(F.col("_w") == w, F.col("_ps"))).alias(f"_ps{w}") for w in offsets_min])
    guard = F.col(user_col).isNull() | F.col(ts_col).isNull()
    cols = []
    for w in windows_min:
        if "cnt" in metrics:
            cols.append(F.when(guard, F.lit(0)).otherwise(F.col("_pn0") - F.col(f"_pn{w}"))
                        .cast("bigint").alias(f"cnt_{w}min"))
        if "sum" in metrics:
            cols.append(F.when(guard, F.lit(0)).otherwise(F.col("_ps0") - F.col(f"_ps{w}"))
                        .cast(SUM_TYPE).alias(f"sum_{w}min"))
    return regrouped.select(*df.columns, *cols)


def user_transaction_velocity(stg_transactions: DataFrame, **kw) -> DataFrame:
    """``int_user_transaction_velocity``: one row per staged transaction."""
    base = stg_transactions.select("user_id", "transaction_id", "created_at", "amount_usd")
    v = with_velocity(base, **kw)
    metrics = [c for c in v.columns if c.startswith(("cnt_", "sum_"))]
    return v.select("user_id", "transaction_id", "created_at", *metrics)


def velocity_for_dates(stg_transactions: DataFrame, dates: Sequence[dt.date | None], date_col: str = "event_date",
                       **kw) -> DataFrame:
    """The velocity model's rows of some dates, from those dates' transactions
    and the widest window's worth of the dates before them. ``stg_transactions``
    has ``date_col``, the date of ``created_at``; where it is a partition column,
    only these dates' partitions are read, and of the halo's only late row groups.
    """
    widest = max(kw.get("windows_min", VELOCITY_WINDOWS_MIN))
    wanted, known = set(dates), sorted(d for d in dates if d is not None)
    halo = set()  # the dates that the widest window reaches back to
    for d in known:
        halo.update(d - dt.timedelta(days=x) for x in range(1, math.ceil(widest / 1440) + 1))
    own = F.col(date_col).isin(known)
    if None in wanted:
        own = own | F.col(date_col).isNull()
    near = F.lit(False)
    for d in sorted(halo - wanted):
        # Rows that some later wanted date's first window can hold.
        reached = [x for x in known if x > d and x - d <= dt.timedelta(days=math.ceil(widest / 1440))]
        since = dt.datetime.combine(min(reached), dt.time()) - dt.timedelta(minutes=widest)
        near = near | ((F.col(date_col) == F.lit(d)) & (F.col("created_at") > F.lit(since).cast("timestamp_ntz")))
    rows = stg_transactions.filter(own | near).select("user_id", "transaction_id", "created_at", "amount_usd", date_col)
    v = with_velocity(rows, **kw).filter(own)
    metrics = [c for c in v.columns if c.startswith(("cnt_", "sum_"))]
    return v.select("user_id", "transaction_id", "created_at", *metrics, date_col)
