"""Running totals and exact order statistics that never need a whole group in
one task.

A key may hold a third of all rows, so `Window.partitionBy(key)` would put a
third of the data into one task. Instead each key's order axis is cut into
cells. Totals per cell are small (keys x cells rows); their prefix sums give
every cell its starting offset, and the running sum inside a cell is an
ordinary window over (key, cell).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from delaylens.session import stage

_STRICT_BEFORE = (Window.unboundedPreceding, -1)
#: Cells that value_cells cuts a column into; a power of two.
CELLS = 256


def value_cells(points: DataFrame, value: str, cells: int = CELLS) -> Column:
    """A cell number for each value, ascending, such that about equally many rows
    of `points` fall into each whatever the values look like. The boundaries are
    approximate percentiles (`cells` numbers on the driver); the number is found by
    halving, so a row takes log2(cells) comparisons."""
    shares = [i / cells for i in range(1, cells)]
    found = points.agg(F.percentile_approx(F.col(value).cast("double"), shares, 10 * cells)).first()[0]
    bounds = sorted(set(found or []))

    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(value) <= bounds[middle], place(low, middle)).otherwise(place(middle + 1, high))

    return place(0, len(bounds))


def running_totals(
    points: DataFrame,
    keys: list[str],
    order: str,
    sums: list[str],
    cell: Column,
    descending: bool = False,
    frame: str = "rows",
) -> DataFrame:
    """Adds `<s>_before` (total strictly before the row) and `<s>_total` (total
    of the key) for each column in `sums`.

    `points` should be pre-aggregated. With frame="rows" there is one row per
    (keys, order); with frame="range" `order` is a long, rows may tie, and ties
    do not see each other. `cell` maps `order` monotonically to a long. Sums
    are exact for integer columns.
    """
    if frame == "range" and descending:
        raise ValueError("range frames run upward only")
    cut = points.withColumn("_cell", cell.cast("bigint"))
    per_cell = cut.groupBy(*keys, "_cell").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    earlier_cells = Window.partitionBy(*keys).orderBy(direction("_cell")).rowsBetween(*_STRICT_BEFORE)
    whole_key = Window.partitionBy(*keys)
    offsets = per_cell.select(
        *keys,
        "_cell",
        *[F.coalesce(F.sum(f"_{s}").over(earlier_cells), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_{s}").over(whole_key).alias(f"{s}_total") for s in sums],
    )
    inside = Window.partitionBy(*keys, "_cell").orderBy(direction(order))
    inside = inside.rangeBetween(*_STRICT_BEFORE) if frame == "range" else inside.rowsBetween(*_STRICT_BEFORE)
    local = cut.withColumns({f"_loc_{s}": F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in sums})
    # a null key is a key like any other
    side = offsets.withColumnsRenamed({k: f"_key_{k}" for k in keys}).withColumnRenamed("_cell", "_key_cell")
    same = F.col("_cell") == F.col("_key_cell")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    joined = local.join(side, same).drop("_key_cell", *[f"_key_{k}" for k in keys])
    return joined.withColumns({f"{s}_before": F.col(f"_loc_{s}") + F.col(f"_off_{s}") for s in sums}).drop(
        "_cell", *[f"_loc_{s}" for s in sums], *[f"_off_{s}" for s in sums]
    )


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], cell: Column | None = None
) -> DataFrame:
    """Exact interpolated quantiles per key, named by `probabilities`.

    The rows shrink to one per distinct (key, value) before the shuffle; equal
    values may repeat any number of times. These counts are written once, for
    they are read for the cells, the offsets and the ranks. `cell` cuts the values
    of a key into spans one task orders; without it the spans follow the values."""
    counts = stage(df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n")), "value-counts")
    cell = value_cells(counts, value) if cell is None else cell
    ranked = running_totals(counts, keys, value, ["_n"], cell)
    low, high = F.col("_n_before"), F.col("_n_before") + F.col("_n")
    picks, outputs = [], []
    for name, p in probabilities.items():
        position = (F.col("_n_total") - 1) * F.lit(float(p))
        below, above = F.floor(position), F.ceil(position)
        picks += [
            F.max(F.when((low <= below) & (below < high), F.col(value))).alias(f"_lo_{name}"),
            F.max(F.when((low <= above) & (above < high), F.col(value))).alias(f"_hi_{name}"),
            F.max(position - below).alias(f"_fr_{name}"),
        ]
        lo, hi, frac = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_fr_{name}")
        outputs.append((lo + (hi - lo) * frac).alias(name))
    return ranked.groupBy(*keys).agg(*picks).select(*keys, *outputs)


def dense_ids(df: DataFrame, natural_key: list[str], id_name: str, start: int = 1, cells_hex: int = 3) -> DataFrame:
    """Dense surrogate keys start..start+n-1 for distinct rows of `natural_key`.

    Ids follow the order of the key's md5, so the cells (its first hex digits)
    are evenly filled whatever the keys look like, and the same key set always
    gets the same ids."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in natural_key])
    hashed = df.withColumns({"_hash": F.unhex(F.md5(text)), "_one": F.lit(1).cast("bigint")})  # half as long, the same order
    cell = F.conv(F.substring(F.hex("_hash"), 1, cells_hex), 16, 10)
    ranked = running_totals(hashed, [], "_hash", ["_one"], cell)
    return ranked.withColumn(id_name, F.col("_one_before") + F.lit(start)).drop("_hash", "_one", "_one_before", "_one_total")
