"""Aviation-weather expressions: category, visibility text, ceilings, units."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from delaylens.constants import (
    CATEGORY_LIMITS,
    CEILING_COVERS,
    FLIGHT_CATEGORIES,
    KMH_PER_KNOT,
    KMH_PER_MPS,
    UNLIMITED_CEILING_FT,
)


def flight_category(visibility: Column, ceiling: Column, null_policy: str = "null") -> Column:
    """Ordinal category 0..3, worst first.

    null_policy="null": any missing input gives null (live path).
    null_policy="fallthrough": a missing input fails its own comparisons only
    (hourly history path), which is what a bare CASE does.
    """
    if null_policy not in ("null", "fallthrough"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    code = F.lit(0)
    for value, vis_limit, ceil_limit in reversed(CATEGORY_LIMITS):
        code = F.when((visibility < vis_limit) | (ceiling < ceil_limit), value).otherwise(code)
    if null_policy == "null":
        code = F.when(visibility.isNotNull() & ceiling.isNotNull(), code)
    return code.cast("bigint")


def category_label(code: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in FLIGHT_CATEGORIES]), code.cast("int"))


def parse_visibility(text: Column, mixed: bool = False) -> Column:
    """Statute miles from report text such as `10+`, `3`, `1/2`, `M1/4`.

    Mixed numbers (`1 1/2`) are null unless mixed=True."""
    body = F.regexp_replace(F.regexp_replace(F.trim(text), r"\+$", ""), "^M", "")
    pieces = F.split(body, "/")
    fraction = F.when(
        F.size(pieces) == 2,
        F.try_divide(_number(F.get(pieces, F.lit(0))), _number(F.get(pieces, F.lit(1)))),
    )
    value = F.when(body.contains("/"), fraction).otherwise(_number(body))
    if mixed:
        halves = F.split(body, r"\s+")
        tail = F.split(F.get(halves, F.lit(1)), "/")
        whole_and_part = _number(F.get(halves, F.lit(0))) + F.try_divide(
            _number(F.get(tail, F.lit(0))), _number(F.get(tail, F.lit(1)))
        )
        value = F.when(body.rlike(r"^\d+\s+\d+/\d+$"), whole_and_part).otherwise(value)
    return value


def _number(text: Column) -> Column:
    # plain decimals only: Spark's cast would also take suffixes such as "1d"
    return F.when(F.trim(text).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), F.trim(text).try_cast("double"))


def ceiling_from_layers(layers: Column) -> Column:
    """Lowest BKN/OVC/VV base of an array<struct<cover, base>>; none = unlimited."""
    bases = F.transform(
        F.filter(layers, lambda c: c["cover"].isin(CEILING_COVERS) & c["base"].isNotNull()),
        lambda c: c["base"].cast("double"),
    )
    return F.coalesce(F.array_min(bases), F.lit(UNLIMITED_CEILING_FT))


def ceiling_from_columns(covers: list[str], bases: list[str]) -> Column:
    """The same over sibling columns skyc1..n / skyl1..n, without building arrays."""
    kept = [F.when(F.col(c).isin(CEILING_COVERS), F.col(b).cast("double")) for c, b in zip(covers, bases)]
    lowest = kept[0] if len(kept) == 1 else F.least(*kept)
    return F.coalesce(lowest, F.lit(UNLIMITED_CEILING_FT))


def knots_to_kmh(speed: Column) -> Column:
    return speed * F.lit(KMH_PER_KNOT)


def mps_to_kmh(speed: Column) -> Column:
    return speed * F.lit(KMH_PER_MPS)
