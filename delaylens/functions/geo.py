"""Positions: matching to a list of airports, bounding boxes, motion.

A short list is written out as column arithmetic: no join, no shuffle, and it
stays in generated code. A longer one is a constant array that is gone through
per row. For a site table use operators.joins.grid_match and nearest_grid.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from delaylens.constants import AIRPORTS, BBOX_MARGIN_DEG, MATCH_RADIUS_DEG, METRES_PER_DEGREE

#: Sites written out one by one; more make the generated code too long.
UNROLLED_SITES = 60


def _site_array(sites: list[tuple]) -> Column:
    """All sites as one constant: code, place in the list, latitude, longitude."""
    return F.array(
        *[
            F.struct(F.lit(i).alias("place"), F.lit(s[0]).alias("code"), F.lit(float(s[1])).alias("lat"), F.lit(float(s[2])).alias("lon"))
            for i, s in enumerate(sites)
        ]
    )


def near(lat: Column, lon: Column, site_lat: float, site_lon: float, radius: float = MATCH_RADIUS_DEG) -> Column:
    return (F.abs(lat - F.lit(site_lat)) <= radius) & (F.abs(lon - F.lit(site_lon)) <= radius)


def sites_in_range(lat: Column, lon: Column, sites: list[tuple] = AIRPORTS, radius: float = MATCH_RADIUS_DEG) -> Column:
    """Array of every matching site code; one position can match several."""
    if len(sites) <= UNROLLED_SITES:
        return F.array_compact(F.array(*[F.when(near(lat, lon, s[1], s[2], radius), F.lit(s[0])) for s in sites]))
    close = F.filter(_site_array(sites), lambda s: (F.abs(lat - s["lat"]) <= radius) & (F.abs(lon - s["lon"]) <= radius))
    return F.when(lat.isNotNull() & lon.isNotNull(), F.transform(close, lambda s: s["code"]))


def nearest_site(lat: Column, lon: Column, sites: list[tuple] = AIRPORTS, metric: str = "degrees") -> Column:
    """Code of the closest site, ties to the first listed.

    metric="degrees" is the plain squared degree distance; "haversine" weighs
    longitude by latitude."""
    if len(sites) > UNROLLED_SITES:
        ranked = F.transform(
            _site_array(sites),
            lambda s: F.struct(_distance(lat, lon, s["lat"], s["lon"], metric).alias("distance"), s["place"].alias("place"), s["code"].alias("code")),
        )
        return F.when(lat.isNotNull() & lon.isNotNull(), F.array_min(ranked)["code"])
    distances = [_distance(lat, lon, F.lit(s[1]), F.lit(s[2]), metric) for s in sites]
    best = distances[0] if len(distances) == 1 else F.least(*distances)
    code = F.lit(None).cast("string")
    for site, distance in reversed(list(zip(sites, distances))):
        code = F.when(distance == best, F.lit(site[0])).otherwise(code)
    return code


def _distance(lat: Column, lon: Column, site_lat: Column, site_lon: Column, metric: str) -> Column:
    if metric == "degrees":
        dlat, dlon = lat - site_lat, lon - site_lon
        return dlat * dlat + dlon * dlon
    if metric == "haversine":
        half_lat = F.sin(F.radians(lat - site_lat) / 2)
        half_lon = F.sin(F.radians(lon - site_lon) / 2)
        return half_lat * half_lat + F.cos(F.radians(lat)) * F.cos(F.radians(site_lat)) * half_lon * half_lon
    raise ValueError(f"unknown metric {metric!r}")


def bounding_box(sites: list[tuple] = AIRPORTS, margin: float = BBOX_MARGIN_DEG) -> dict[str, float]:
    lats, lons = [s[1] for s in sites], [s[2] for s in sites]
    return {
        "lat_min": min(lats) - margin,
        "lat_max": max(lats) + margin,
        "lon_min": min(lons) - margin,
        "lon_max": max(lons) + margin,
    }


def in_box(lat: Column, lon: Column, box: dict[str, float]) -> Column:
    return lat.between(box["lat_min"], box["lat_max"]) & lon.between(box["lon_min"], box["lon_max"])


def degrees_per_second(lat: Column, speed: Column, heading: Column) -> tuple[Column, Column]:
    """(lat, lon) rate of change for a ground speed in m/s and a heading in
    degrees clockwise from north; missing speed or heading counts as zero."""
    v, h = F.coalesce(speed, F.lit(0.0)), F.radians(F.coalesce(heading, F.lit(0.0)))
    v_lat = v * F.cos(h) / METRES_PER_DEGREE
    v_lon = v * F.sin(h) / (F.cos(F.radians(lat)) * METRES_PER_DEGREE)
    return v_lat, v_lon


def project_position(lat: Column, lon: Column, speed: Column, heading: Column, dt: Column) -> tuple[Column, Column]:
    v_lat, v_lon = degrees_per_second(lat, speed, heading)
    return lat + v_lat * dt, lon + v_lon * dt
