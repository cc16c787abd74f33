"""Geometry and map projections on plain coordinate columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotline import fixed_values as fv
from lotline.functions.columns import _col


@dataclass(frozen=True)
class TransverseMercator:
    """Transverse Mercator plane; Krueger series to the fourth order of the third flattening."""

    lon0: float
    lat0: float
    false_easting: float
    false_northing: float
    scale: float
    semi_major: float
    inverse_flattening: float

    @property
    def _n(self) -> float:
        f = 1.0 / self.inverse_flattening
        return f / (2.0 - f)

    @property
    def _eccentricity(self) -> float:
        n = self._n
        return 2.0 * math.sqrt(n) / (1.0 + n)

    @property
    def _radius(self) -> float:
        n = self._n
        return self.scale * self.semi_major / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    def _series(self, rows) -> list[float]:
        n = self._n
        return [sum(c * n ** (j + k) for k, c in enumerate(row)) for j, row in enumerate(rows, 1)]

    @property
    def _alpha(self) -> list[float]:
        # fixed values: published series coefficients, forward
        return self._series([
            [1 / 2, -2 / 3, 5 / 16, 41 / 180],
            [13 / 48, -3 / 5, 557 / 1440],
            [61 / 240, -103 / 140],
            [49561 / 161280],
        ])

    @property
    def _beta(self) -> list[float]:
        # fixed values: published series coefficients, inverse
        return self._series([
            [1 / 2, -2 / 3, 37 / 96, -1 / 360],
            [1 / 48, 1 / 15, -437 / 1440],
            [17 / 480, -37 / 840],
            [4397 / 161280],
        ])

    @property
    def _delta(self) -> list[float]:
        # fixed values: published series coefficients, conformal to geodetic latitude
        return self._series([
            [2, -2 / 3, -2, 116 / 45],
            [7 / 3, -8 / 5, -227 / 45],
            [56 / 15, -136 / 35],
            [4279 / 630],
        ])

    @property
    def _origin_arc(self) -> float:
        """Length along the central meridian from the equator to the origin."""
        phi, e = math.radians(self.lat0), self._eccentricity
        chi = math.atan(math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi))))
        xi = chi + sum(a * math.sin(2 * j * chi) for j, a in enumerate(self._alpha, 1))
        return self._radius * xi

    def forward(self, lon: Column | str, lat: Column | str) -> tuple[Column, Column]:
        """Degrees to metres: (easting, northing)."""
        e = self._eccentricity
        phi, dlon = F.radians(_col(lat)), F.radians(_col(lon) - F.lit(self.lon0))
        t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
        xi = F.atan2(t, F.cos(dlon))
        eta = F.atanh(F.sin(dlon) / F.sqrt(1 + t * t))
        north, east = xi, eta
        for j, a in enumerate(self._alpha, 1):
            north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
            east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        return (
            self.false_easting + self._radius * east,
            self.false_northing + self._radius * north - self._origin_arc,
        )

    def inverse(self, x: Column | str, y: Column | str) -> tuple[Column, Column]:
        """Metres to degrees: (longitude, latitude)."""
        xi0 = (_col(y) - self.false_northing + self._origin_arc) / self._radius
        eta0 = (_col(x) - self.false_easting) / self._radius
        xi, eta = xi0, eta0
        for j, b in enumerate(self._beta, 1):
            xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
            eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
        chi = F.asin(F.sin(xi) / F.cosh(eta))
        phi = chi
        for j, d in enumerate(self._delta, 1):
            phi = phi + d * F.sin(2 * j * chi)
        return self.lon0 + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(phi)


@dataclass(frozen=True)
class WebMercator:
    """Spherical Mercator on the WGS84 major axis."""

    semi_major: float = fv.WGS84[0]

    def forward(self, lon: Column | str, lat: Column | str) -> tuple[Column, Column]:
        x = self.semi_major * F.radians(_col(lon))
        y = self.semi_major * F.asinh(F.tan(F.radians(_col(lat))))
        return x, y

    def inverse(self, x: Column | str, y: Column | str) -> tuple[Column, Column]:
        lon = F.degrees(_col(x) / self.semi_major)
        lat = F.degrees(F.atan(F.sinh(_col(y) / self.semi_major)))
        return lon, lat


MAGNA_BOGOTA = TransverseMercator(**fv.MAGNA_BOGOTA, semi_major=fv.GRS80[0], inverse_flattening=fv.GRS80[1])
CITY_PLANE = TransverseMercator(
    **fv.CITY_PLANE,
    semi_major=fv.CITY_PLANE_ELLIPSOID[0],
    inverse_flattening=fv.CITY_PLANE_ELLIPSOID[1],
)
WEB_MERCATOR = WebMercator()


def utm_zone(mean_lon: float) -> int:
    return math.floor((mean_lon + 180.0) / 6.0) + 1


def utm(zone: int, south: bool = False) -> TransverseMercator:
    """UTM plane of a zone on WGS84."""
    return TransverseMercator(
        lon0=zone * 6.0 - 183.0, lat0=0.0, false_easting=500000.0,
        false_northing=10000000.0 if south else 0.0, scale=0.9996,
        semi_major=fv.WGS84[0], inverse_flattening=fv.WGS84[1],
    )


def squared_distance(x1, y1, x2, y2) -> Column:
    dx, dy = _col(x1) - _col(x2), _col(y1) - _col(y2)
    return dx * dx + dy * dy


def within_radius(x1, y1, x2, y2, radius: float) -> Column:
    """Disc around a point as a predicate; the rim belongs to it."""
    return squared_distance(x1, y1, x2, y2) <= float(radius) ** 2


def segment_squared_distance(px, py, x1, y1, x2, y2) -> Column:
    """Squared distance from a point to the segment between two others."""
    px, py, x1, y1, x2, y2 = map(_col, (px, py, x1, y1, x2, y2))
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    along = F.when(length2 > 0, ((px - x1) * dx + (py - y1) * dy) / length2).otherwise(F.lit(0.0))
    t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
    return squared_distance(px, py, x1 + t * dx, y1 + t * dy)


def crosses_ray(px, py, x1, y1, x2, y2) -> Column:
    """True where the edge cuts the ray going from the point to larger x."""
    px, py, x1, y1, x2, y2 = map(_col, (px, py, x1, y1, x2, y2))
    spans = (y1 > py) != (y2 > py)
    return F.when(spans, px < (x2 - x1) * (py - y1) / (y2 - y1) + x1).otherwise(F.lit(False))


def on_segment(px, py, x1, y1, x2, y2) -> Column:
    """True where the point lies on the edge itself."""
    px, py, x1, y1, x2, y2 = map(_col, (px, py, x1, y1, x2, y2))
    flat = (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1)
    return (
        flat
        & px.between(F.least(x1, x2), F.greatest(x1, x2))
        & py.between(F.least(y1, y2), F.greatest(y1, y2))
    )
