"""Trailing traffic and delay-rate windows, and their cold-start fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from delaylens.constants import TRAFFIC_WINDOWS
from delaylens.operators.prefix import running_totals

HOUR = 3600
MICROS = 1_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def trailing_windows(
    df: DataFrame,
    key: str = "adep",
    ts: str = "first_seen",
    label: str = "delayed_15min",
    windows: dict[str, int] = TRAFFIC_WINDOWS,
    cell_seconds: int = HOUR,
) -> DataFrame:
    """Adds `traffic_<w>` (labels of the key in [t - w, t), 0 if none) and
    `delay_rate_<w>` (their mean, null if none). Ties at t do not see each
    other. The label must be an integer or boolean.

    A sliding RANGE frame costs rows x frame rows and binds each key to one
    task. Here the window is the difference of two running totals: every
    distinct (key, t) adds its count at t and takes it away again after t + w,
    and the value at t is the total of all such changes strictly before t. The
    work is linear, spreads over (key, cell) groups of any width, and each
    input row meets its result in one join on (key, t) whose heavy keys
    adaptive execution can split.
    """
    observed = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    points = observed.groupBy(key, ts).agg(
        F.count(label).alias("_n"), F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).alias("_s")
    )
    measures = [f"{m}_{w}" for w in windows for m in ("_n", "_s")]

    def change(at: Column, sign: dict[str, int], arrival: bool) -> Column:
        return F.struct(
            at.alias("_t"),
            F.lit(arrival).alias("_arrival"),
            *[(F.col(m) * sign[w]).alias(f"{m}_{w}") for w in windows for m in ("_n", "_s")],
        )

    t = micros(F.col(ts))
    changes = [change(t, {w: 1 for w in windows}, True)]
    for w, seconds in windows.items():
        changes.append(change(t + F.lit(seconds * MICROS), {x: -int(x == w) for x in windows}, False))
    deltas = points.select(key, ts, F.inline(F.array(*changes)))
    running = running_totals(
        deltas, [key], "_t", measures, F.floor(F.col("_t") / F.lit(cell_seconds * MICROS)), frame="range"
    )
    result = running.where("_arrival").select(
        key,
        ts,
        *[F.col(f"_n_{w}_before").alias(f"traffic_{w}") for w in windows],
        *[
            F.when(F.col(f"_n_{w}_before") > 0, F.col(f"_s_{w}_before") / F.col(f"_n_{w}_before")).alias(f"delay_rate_{w}")
            for w in windows
        ],
    )
    return df.join(result, [key, ts], "left").fillna(0, [f"traffic_{w}" for w in windows])


def trailing_windows_direct(
    df: DataFrame,
    key: str = "adep",
    ts: str = "first_seen",
    label: str = "delayed_15min",
    windows: dict[str, int] = TRAFFIC_WINDOWS,
) -> DataFrame:
    """The same by plain RANGE windows; used as the check of trailing_windows.

    A sliding frame is worked out anew for every row, so each window is what a
    frame that only grows holds up to t less what one holds up to t - w. The time
    axis is cut into cells as long as the longest window: a label counts in its own
    cell and the next, and each (key, cell) is a window of its own. The label must
    be an integer or boolean; a row without a time has empty windows."""
    span = max(windows.values()) * MICROS
    own = df.withColumn("_t", micros(F.col(ts))).withColumns({"_cell": F.floor(F.col("_t") / F.lit(span)), "_own": F.lit(True)})
    seen = own.where(F.col("_t").isNotNull() & F.col(label).isNotNull())
    later = seen.select(key, label, "_t", (F.col("_cell") + 1).alias("_cell"), F.lit(False).alias("_own"))
    in_cell = Window.partitionBy(key, "_cell").orderBy("_t")

    def upto(end: int) -> tuple[Column, Column]:
        frame = in_cell.rangeBetween(Window.unboundedPreceding, -end)
        return F.count(label).over(frame), F.coalesce(F.sum(F.col(label).cast("bigint")).over(frame), F.lit(0))

    ends = {"now": 1, **{w: seconds * MICROS + 1 for w, seconds in windows.items()}}
    held = {f"_{m}_{w}": c for w, end in ends.items() for m, c in zip("ns", upto(end))}
    out = own.unionByName(later, allowMissingColumns=True).withColumns(held).where("_own")
    for w in windows:
        n, total = (F.col(f"_{m}_now") - F.col(f"_{m}_{w}") for m in "ns")
        out = out.withColumns({f"traffic_{w}": n, f"delay_rate_{w}": F.when(n > 0, total / n)})
    return out.drop("_t", "_cell", "_own", *held)


def key_rates(df: DataFrame, key: str = "adep", label: str = "delayed_15min", rate: str = "mean_rate") -> DataFrame:
    """Mean label per key; partial sums are combined before the shuffle."""
    return df.groupBy(key).agg(F.avg(F.col(label).cast("double")).alias(rate))


def fill_cold_start(
    df: DataFrame,
    key: str = "adep",
    ts: str = "first_seen",
    label: str = "delayed_15min",
    windows: dict[str, int] = TRAFFIC_WINDOWS,
    fill: str = "key",
    as_of: str | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Replaces null delay rates by the key's mean label (fill="key", 0.0 for a
    key without labels) or by the overall mean (fill="global").

    `history` are the labelled rows the means come from (default: df itself);
    `as_of` keeps only those before a cutoff, so later labels cannot leak into
    training rows.
    """
    labelled = df if history is None else history
    if as_of is not None:
        labelled = labelled.where(F.col(ts) < F.lit(as_of).cast("timestamp_ntz"))
    rates = [f"delay_rate_{w}" for w in windows]
    if fill == "global":
        mean = labelled.agg(F.avg(F.col(label).cast("double"))).scalar()
        return df.withColumns({r: F.coalesce(F.col(r), mean) for r in rates})
    if fill != "key":
        raise ValueError(f"unknown fill {fill!r}")
    means = key_rates(labelled, key, label, "_fill")
    filled = df.join(means, key, "left")
    return filled.withColumns({r: F.coalesce(F.col(r), F.col("_fill"), F.lit(0.0)) for r in rates}).drop("_fill")
