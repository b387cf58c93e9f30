"""Site KPIs kept up to date by signed rows, at the cost of what changed.

A change to the silver table is a set of rows with a sign: +1 for a new row, -1 for one that is
gone; an update is both. The state of a KPI row holds what signed rows can be added to: sums and
counts, how many rows each device has, and each extreme with the number of rows that have it. If
the last row of an extreme is withdrawn the next one is not known, and only such hours are computed
again from the table. Everything else is a join of the change with the state of its own hours.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.functions.values import round_fixed
from fleetmeter.operators.upsert import same_key
from fleetmeter.schemas import GOLD, GOLD_KEYS

SIGN = "sign"
_MEANS = {"avg_temperature": 2, "avg_humidity": 2, "avg_battery_pct": 2, "uptime_hours": 1}
_EXTREMES = {"max_temperature": F.max, "min_temperature": F.min}
_ADDED = [
    "n_rows", *(f"{kind}_{c}" for c in _MEANS for kind in ("sum", "n")), "data_usage_mb",
    "total_alerts", "alert_temp_count", "alert_humidity_count", "total_records",
]
_KPIS = [c for c in GOLD.names if c not in (*GOLD_KEYS, "loaded_at")]


class Maintained(NamedTuple):
    """``state`` per hour and site, ``devices`` the number of rows per hour, site and device."""

    state: DataFrame
    devices: DataFrame


def _keyed(silver: DataFrame) -> DataFrame:
    return silver.withColumnRenamed("hour_bucket", "analysis_hour")


def _added(sign: Column) -> list[Column]:
    """Signed sums of the rows of a group."""
    warm, humid = F.col("has_temperature_alert"), F.col("has_humidity_alert")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value * sign), F.lit(0))

    def count(condition: Column) -> Column:
        return total(F.when(condition, 1).otherwise(0))

    sums = [F.sum(sign).alias("n_rows")]
    for c in _MEANS:
        sums += [total(F.col(c)).alias(f"sum_{c}"), count(F.col(c).isNotNull()).alias(f"n_{c}")]
    return [
        *sums,
        total(F.col("data_usage_mb")).alias("data_usage_mb"),
        count(warm | humid).alias("total_alerts"),
        count(warm).alias("alert_temp_count"),
        count(humid).alias("alert_humidity_count"),
        total(F.col("record_count")).alias("total_records"),
    ]


def maintained(silver: DataFrame) -> Maintained:
    """The state of all rows of a silver table: one aggregate of the rows, one of their devices."""
    rows = _keyed(silver).withColumn(SIGN, F.lit(1))
    state = rows.groupBy(*GOLD_KEYS).agg(
        *_added(F.col(SIGN)), *(pick(c).alias(c) for c, pick in _EXTREMES.items())
    )
    for c in _EXTREMES:
        found = rows.groupBy(*GOLD_KEYS, c).agg(F.count("*").alias(f"n_{c}"))
        same = same_key("s", "x", GOLD_KEYS, null_safe=True) & F.col(f"s.{c}").eqNullSafe(F.col(f"x.{c}"))
        state = state.alias("s").join(found.alias("x"), same).select("s.*", f"x.n_{c}")
    devices = rows.groupBy(*GOLD_KEYS, "device_id").agg(F.count("*").alias("n"))
    return Maintained(state, devices)


def _in_groups(table: DataFrame, groups: DataFrame, kind: str = "left_semi") -> DataFrame:
    same = same_key("t", "g", GOLD_KEYS, null_safe=True)
    return table.alias("t").join(groups.alias("g"), same, kind)


def _extreme(old: DataFrame, rows: DataFrame, c: str) -> DataFrame:
    """Per touched group the extreme ``c`` after the change, its count ``n_c``, and whether it was
    withdrawn. Values beyond the old extreme begin anew; the old one loses and gains rows."""
    net = rows.groupBy(*GOLD_KEYS, c).agg(F.sum(SIGN).alias("net"))
    same = same_key("n", "o", GOLD_KEYS, null_safe=True)
    both = net.alias("n").join(old.select(*GOLD_KEYS, c, f"n_{c}").alias("o"), same, "left")
    value, before = F.col(f"n.{c}"), F.col(f"o.{c}")
    beyond = before.isNull() | (value > before if c.startswith("max") else value < before)
    better = F.when(value.isNotNull() & beyond & (F.col("net") > 0), value)
    pick = F.max_by if c.startswith("max") else F.min_by
    found = both.groupBy(F.col("n.analysis_hour").alias("analysis_hour"), F.col("n.site_id").alias("site_id")).agg(
        (F.max if c.startswith("max") else F.min)(better).alias("better"),
        pick("net", better).alias("n_better"),
        F.first(before).alias("before"),
        F.first(f"o.n_{c}").alias("n_before"),
        F.sum(F.when(value.eqNullSafe(before), F.col("net")).otherwise(0)).alias("n_more"),
    )
    left = F.coalesce(F.col("n_before"), F.lit(0)) + F.col("n_more")
    is_new = F.col("better").isNotNull()
    return found.select(
        *GOLD_KEYS,
        F.when(is_new, F.col("better")).otherwise(F.col("before")).alias(c),
        F.when(is_new, F.col("n_better")).otherwise(left).alias(f"n_{c}"),
        (~is_new & F.col("before").isNotNull() & (left <= 0)).alias(f"lost_{c}"),
    )


class Change(NamedTuple):
    """The maintained view after a change; KPI rows of the touched groups before and after it; and
    the groups that were computed again, as the last row of an extreme was withdrawn."""

    view: Maintained
    before: DataFrame
    after: DataFrame
    recomputed: DataFrame


def apply_change(view: Maintained, delta: DataFrame, silver_after: DataFrame) -> Change:
    """Add signed silver rows (``sign`` +1 or -1) to a maintained view.

    ``silver_after`` is the table after the change. It is read only for the groups whose extreme
    was withdrawn. A group without rows is gone. NULL is an hour like any other. State that is read
    again should be stored by the caller; this moves only the change and the state of its groups.
    """
    rows = _keyed(delta)
    groups = rows.select(*GOLD_KEYS).distinct()
    old = _in_groups(view.state, groups)
    summed = rows.groupBy(*GOLD_KEYS).agg(*_added(F.col(SIGN)))
    zeros = old.select(*GOLD_KEYS, *_ADDED).unionByName(summed.select(*GOLD_KEYS, *_ADDED))
    sums = zeros.groupBy(*GOLD_KEYS).agg(*(F.sum(c).alias(c) for c in _ADDED))
    new = sums.filter("n_rows > 0")
    for c in _EXTREMES:
        found = _extreme(old, rows, c)
        same = same_key("s", "x", GOLD_KEYS, null_safe=True)
        new = new.alias("s").join(found.alias("x"), same).select("s.*", f"x.{c}", f"x.n_{c}", f"x.lost_{c}")
    lost = reduce(lambda a, b: a | b, [F.col(f"lost_{c}") for c in _EXTREMES])
    recomputed = new.filter(lost).select(*GOLD_KEYS)
    kept = new.filter(~lost).select(*view.state.columns)
    again = maintained(_in_groups(_keyed(silver_after), recomputed)).state
    touched = kept.unionByName(again)
    device = rows.groupBy(*GOLD_KEYS, "device_id").agg(F.sum(SIGN).alias("n"))
    old_devices = _in_groups(view.devices, groups)
    devices = (
        old_devices.unionByName(device).groupBy(*GOLD_KEYS, "device_id").agg(F.sum("n").alias("n")).filter("n > 0")
    )
    after = Maintained(touched, devices)
    whole = Maintained(
        _in_groups(view.state, groups, "left_anti").unionByName(touched),
        _in_groups(view.devices, groups, "left_anti").unionByName(devices),
    )
    return Change(whole, kpis(Maintained(old, old_devices)), kpis(after), recomputed)


def kpis(view: Maintained) -> DataFrame:
    """The KPI rows of a view, as ``gold.fleet_metrics`` computes them."""
    active = view.devices.groupBy(*GOLD_KEYS).agg(F.count("device_id").alias("active_devices"))
    same = same_key("s", "d", GOLD_KEYS, null_safe=True)
    rows = view.state.alias("s").join(active.alias("d"), same).select("s.*", "d.active_devices")

    def mean(name: str) -> Column:
        return round_fixed(F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}")), _MEANS[name])

    made = rows.select(
        *GOLD_KEYS,
        "active_devices",
        *(mean(c).alias("avg_uptime_hours" if c == "uptime_hours" else c) for c in _MEANS),
        *(round_fixed(F.col(c), 2).alias(c) for c in _EXTREMES),
        round_fixed(F.col("data_usage_mb"), 2).alias("total_data_usage_mb"),
        *(F.col(c).cast("long").alias(c) for c in _ADDED[-4:]),
    )
    return made.select(*GOLD_KEYS, *_KPIS)


def change_stats(change: Change) -> DataFrame:
    """One row, ``(rows_added, rows_removed)``, of what a change did to the view, from the touched
    groups alone. A row that changed counts on both sides, one that came out equal on none."""
    before = change.before.select(*GOLD_KEYS, F.struct(*_KPIS).alias("row"), F.lit(True).alias("here"))
    after = change.after.select(*GOLD_KEYS, F.struct(*_KPIS).alias("row"), F.lit(True).alias("here"))
    same = same_key("b", "a", GOLD_KEYS, null_safe=True)
    both = before.alias("b").join(after.alias("a"), same, "full")
    changed = both.filter(~F.col("a.row").eqNullSafe(F.col("b.row")))
    return changed.agg(F.count("a.here").alias("rows_added"), F.count("b.here").alias("rows_removed"))
