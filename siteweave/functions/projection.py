"""Equal-area projections in closed form, areas and centroids of rings.

Albers and Lambert azimuthal equal-area on the GRS80 ellipsoid, after Snyder,
Map Projections: A Working Manual (1987), pages 101 and 187.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from siteweave.functions.wkt import parse_polygons

# The GRS80 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
ECC2 = FLATTENING * (2 - FLATTENING)
ECC = ECC2**0.5

# Standard parallels, origin latitude and central meridian.
ALBERS_CONUS = (29.5, 45.5, 23.0, -96.0)
ALBERS_ALASKA = (55.0, 65.0, 50.0, -154.0)
LAMBERT_HAWAII = (20.5, -157.5)


def _authalic(phi: np.ndarray) -> np.ndarray:
    s = np.sin(phi)
    return (1 - ECC2) * (s / (1 - ECC2 * s * s) - np.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))


def _parallel(phi: float) -> float:
    return np.cos(phi) / np.sqrt(1 - ECC2 * np.sin(phi) ** 2)


def albers(lon: np.ndarray, lat: np.ndarray, south: float, north: float, origin: float, meridian: float) -> tuple[np.ndarray, np.ndarray]:
    p1, p2, p0 = np.radians([south, north, origin])
    m1, m2 = _parallel(p1), _parallel(p2)
    q0, q1, q2 = _authalic(p0), _authalic(p1), _authalic(p2)
    n = (m1 * m1 - m2 * m2) / (q2 - q1)
    c = m1 * m1 + n * q1
    radius = lambda q: SEMI_MAJOR * np.sqrt(c - n * q) / n
    theta, rho = n * np.radians(np.asarray(lon) - meridian), radius(_authalic(np.radians(lat)))
    return rho * np.sin(theta), radius(q0) - rho * np.cos(theta)


def lambert(lon: np.ndarray, lat: np.ndarray, origin: float, meridian: float) -> tuple[np.ndarray, np.ndarray]:
    p1 = np.radians(origin)
    qp = _authalic(np.array(np.pi / 2))
    beta, beta1 = np.arcsin(np.clip(_authalic(np.radians(lat)) / qp, -1, 1)), np.arcsin(_authalic(p1) / qp)
    rq = SEMI_MAJOR * np.sqrt(qp / 2)
    d = SEMI_MAJOR * _parallel(p1) / (rq * np.cos(beta1))
    dl = np.radians(np.asarray(lon) - meridian)
    b = rq * np.sqrt(2 / (1 + np.sin(beta1) * np.sin(beta) + np.cos(beta1) * np.cos(beta) * np.cos(dl)))
    return b * d * np.cos(beta) * np.sin(dl), (b / d) * (np.cos(beta1) * np.sin(beta) - np.sin(beta1) * np.cos(beta) * np.cos(dl))


def projector(state: str | None) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """The equal-area projection of a jurisdiction."""
    if state == "AK":
        return lambda lon, lat: albers(lon, lat, *ALBERS_ALASKA)
    if state == "HI":
        return lambda lon, lat: lambert(lon, lat, *LAMBERT_HAWAII)
    return lambda lon, lat: albers(lon, lat, *ALBERS_CONUS)


def polygon_area_m2(text: str | None, state: str | None = None) -> float | None:
    """Projected area of a polygon or multipolygon text without its holes; None where there is none."""
    project, total = projector(state), 0.0
    for rings in parse_polygons(text):
        for k, ring in enumerate(rings):
            x, y = project(np.array([p[0] for p in ring]), np.array([p[1] for p in ring]))
            # Measured from a corner: far from the origin the products would cancel digits.
            x, y = x - x[0], y - y[0]
            area = abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2
            total += area if k == 0 else -area
    return float(total) if total > 0 else None


def _areas(shape: pd.Series, state: pd.Series) -> pd.Series:
    return pd.Series([polygon_area_m2(t, s) for t, s in zip(shape, state)], dtype="object")


def _project(lon: pd.Series, lat: pd.Series, state: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame({"x": np.nan, "y": np.nan}, index=lon.index)
    for code in state.fillna("").unique():
        rows = state.fillna("") == code
        x, y = projector(code or None)(lon[rows].to_numpy(float), lat[rows].to_numpy(float))
        out.loc[rows, "x"], out.loc[rows, "y"] = x, y
    return out


def area_m2(shape: Column | str, state: Column | str) -> Column:
    """Square metres of an outline's text in the projection of its jurisdiction."""
    return F.pandas_udf(_areas, "double")(shape, state)


def projected(lon: Column | str, lat: Column | str, state: Column | str) -> Column:
    """Metres (x, y) east and north in the projection of each row's jurisdiction."""
    return F.pandas_udf(_project, "x double, y double")(lon, lat, state)


def ring_centroid(points: Column) -> Column:
    """(lat, lon) of the planar centroid of a list of (lat, lon); the mean of a ring without area."""
    first = F.element_at(points, 1)
    n = F.size(points)
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("area", "x", "y", "lat", "lon")])

    def add(acc: Column, i: Column) -> Column:
        """Adds the side from point i to the next one; that from the last to the first is nothing where the ring is closed."""
        p, q = F.element_at(points, i), F.element_at(points, i % n + 1)
        # Relative to the first point, so that the products keep their digits.
        x, y, u, v = p["lon"] - first["lon"], p["lat"] - first["lat"], q["lon"] - first["lon"], q["lat"] - first["lat"]
        cross = x * v - u * y
        return F.struct((acc["area"] + cross).alias("area"), (acc["x"] + (x + u) * cross).alias("x"), (acc["y"] + (y + v) * cross).alias("y"), (acc["lat"] + p["lat"]).alias("lat"), (acc["lon"] + p["lon"]).alias("lon"))

    def centre(acc: Column) -> Column:
        flat = F.abs(acc["area"]) < 1e-18
        lat, lon = first["lat"] + acc["y"] / (3 * acc["area"]), first["lon"] + acc["x"] / (3 * acc["area"])
        return F.struct(F.when(flat, acc["lat"] / n).otherwise(lat).alias("lat"), F.when(flat, acc["lon"] / n).otherwise(lon).alias("lon"))

    return F.when(n >= 1, F.aggregate(F.sequence(F.lit(1), n), zero, add, centre))


def ring_wkt(points: Column) -> Column:
    """POLYGON text of a list of (lat, lon), closed; null below three points."""
    first = F.element_at(points, 1)
    closed = F.when(F.element_at(points, -1) == first, points).otherwise(F.concat(points, F.array(first)))
    pairs = F.transform(closed, lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string")))
    return F.when(F.size(points) >= 3, F.concat(F.lit("POLYGON (("), F.array_join(pairs, ", "), F.lit("))")))
