"""Closed-form map projections of longitude and latitude columns.

Formulas: J. P. Snyder, Map Projections - A Working Manual, USGS Professional
Paper 1395, 1987.  Only the vertices of an area are projected, never the cells.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Semi-major axis and inverse flattening of the WGS 84 and GRS 80
# ellipsoids (metres).
WGS84 = (6378137.0, 298.257223563)
GRS80 = (6378137.0, 298.257222101)


@dataclass(frozen=True)
class LambertConformal:
    """Lambert conformal conic with two standard parallels (degrees, metres)."""

    lat_1: float
    lat_2: float
    lat_0: float
    lon_0: float
    false_easting: float
    false_northing: float
    ellipsoid: tuple[float, float] = GRS80

    def _eccentricity(self) -> float:
        flattening = 1.0 / self.ellipsoid[1]
        return math.sqrt(2.0 * flattening - flattening * flattening)

    def _m(self, lat: float) -> float:
        e = self._eccentricity()
        return math.cos(lat) / math.sqrt(1.0 - (e * math.sin(lat)) ** 2)

    def _t(self, lat: float) -> float:
        e = self._eccentricity()
        s = e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1.0 - s) / (1.0 + s)) ** (e / 2)

    def constants(self) -> tuple[float, float, float]:
        """Cone constant, scale factor and radius of the origin parallel."""
        first, second, origin = (math.radians(v) for v in (self.lat_1, self.lat_2, self.lat_0))
        if abs(first - second) < 1e-12:
            n = math.sin(first)
        else:
            n = (math.log(self._m(first)) - math.log(self._m(second))) / (
                math.log(self._t(first)) - math.log(self._t(second))
            )
        f = self._m(first) / (n * self._t(first) ** n)
        return n, f, self.ellipsoid[0] * f * self._t(origin) ** n

    def project(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        n, f, rho_0 = self.constants()
        e = self._eccentricity()
        phi = F.radians(lat)
        s = F.lit(e) * F.sin(phi)
        t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(e / 2))
        rho = F.lit(self.ellipsoid[0] * f) * F.pow(t, F.lit(n))
        theta = F.lit(n) * F.radians(lon - self.lon_0)
        x = F.lit(self.false_easting) + rho * F.sin(theta)
        y = F.lit(self.false_northing + rho_0) - rho * F.cos(theta)
        return x, y


# Parameters of ETRS89-extended / LCC Europe (EPSG:3034), the
# projection of the daily climate grids of central Europe.
LCC_EUROPE = LambertConformal(35.0, 65.0, 52.0, 10.0, 4_000_000.0, 2_800_000.0)


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Spherical Mercator on the WGS 84 radius (EPSG:3857)."""
    radius = F.lit(WGS84[0])
    x = radius * F.radians(lon)
    y = radius * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))
    return x, y


def project(lon: Column, lat: Column, target: int | LambertConformal) -> tuple[Column, Column]:
    """Longitude and latitude (EPSG:4326) in the target system.

    ``target`` is 4326, 3857, 3034 or the parameters of a Lambert conformal
    conic; any other system is an error rather than a guess.
    """
    if isinstance(target, LambertConformal):
        return target.project(lon, lat)
    if target == 4326:
        return lon, lat
    if target == 3857:
        return web_mercator(lon, lat)
    if target == 3034:
        return LCC_EUROPE.project(lon, lat)
    raise ValueError(f"no closed form for the coordinate system {target!r}")
