"""Inverse Lambert conformal conic projection as column arithmetic (Snyder, USGS PP 1395, eqs. 15-1 to 15-11)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LambertConic:
    """Two standard parallels on an ellipsoid; false origin in metres, coordinates in ``unit`` metres."""

    lat_0: float
    lon_0: float
    lat_1: float
    lat_2: float
    x_0: float
    y_0: float
    axis: float
    flattening: float
    unit: float

    @property
    def e(self) -> float:
        return math.sqrt(self.flattening * (2 - self.flattening))

    def _m(self, lat: float) -> float:
        s = math.sin(lat)
        return math.cos(lat) / math.sqrt(1 - (self.e * s) ** 2)

    def _t(self, lat: float) -> float:
        s = math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) * math.exp(self.e * math.atanh(self.e * s))

    def constants(self) -> tuple[float, float, float]:
        """Cone constant, scaled radius factor and radius of the origin."""
        lat0, lat1, lat2 = (math.radians(d) for d in (self.lat_0, self.lat_1, self.lat_2))
        n = math.log(self._m(lat1) / self._m(lat2)) / math.log(self._t(lat1) / self._t(lat2))
        scale = self.axis * self._m(lat1) / (n * self._t(lat1) ** n)
        return n, scale, scale * self._t(lat0) ** n

    def sql(self, x: str, y: str, steps: int = 6) -> tuple[str, str]:
        """Longitude and latitude in degrees as SQL text over the two operand texts."""
        n, scale, rho0 = self.constants()
        sign = math.copysign(1.0, n)
        dx = f"(({x}) * {self.unit!r}D - {self.x_0!r}D)"
        dy = f"({rho0!r}D - (({y}) * {self.unit!r}D - {self.y_0!r}D))"
        rho = f"({sign!r}D * hypot({dx}, {dy}))"
        theta = f"atan2({sign!r}D * {dx}, {sign!r}D * {dy})"
        t = f"power({rho} / {scale!r}D, {1 / n!r}D)"
        lat = f"({math.pi / 2!r}D - 2D * atan({t}))"
        for _ in range(steps):
            # ((1 - s) / (1 + s)) ^ (e / 2) equals exp(-e * atanh(s)): one use of the latitude per step.
            lat = f"({math.pi / 2!r}D - 2D * atan({t} * exp(-{self.e!r}D * atanh({self.e!r}D * sin({lat})))))"
        return f"degrees({theta} / {n!r}D) + {self.lon_0!r}D", f"degrees({lat})"


# The projection of the network's coordinates, GRS80 ellipsoid, millimetres.
NETWORK_GRID = LambertConic(
    lat_0=-37.0,
    lon_0=145.0,
    lat_1=-36.0,
    lat_2=-38.0,
    x_0=1_000_000.0,
    y_0=1_000_000.0,
    axis=6_378_137.0,
    flattening=1 / 298.257222101,
    unit=0.001,
)


def st_x(x: str, y: str, grid: LambertConic = NETWORK_GRID) -> Column:
    """Longitude in degrees of a point given by the names of two double columns."""
    return F.expr(grid.sql(x, y)[0])


def st_y(x: str, y: str, grid: LambertConic = NETWORK_GRID) -> Column:
    """Latitude in degrees of a point given by the names of two double columns."""
    return F.expr(grid.sql(x, y)[1])
