"""Projected coordinates to longitude and latitude, from a WKT description.

Geographic descriptions pass through; transverse Mercator zones are inverted by the usual series
in the third flattening (to the sixth order, well below a millimetre).  Lambert's conformal conic,
Albers' and Lambert's equal areas, Mercator and the polar stereographic projection follow the
closed formulas on the ellipsoid (`Sheet`).  Others are an error.

Every formula works on numbers, arrays and Columns alike, so pixels are placed by SQL functions.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _either(of_column, of_array):
    """A function of numbers, arrays or Columns."""
    return lambda *v: of_column(*v) if any(isinstance(x, Column) for x in v) else of_array(*v)


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


sin, cos, tan, sqrt, exp, log = (_either(getattr(F, n), getattr(np, n)) for n in ("sin", "cos", "tan", "sqrt", "exp", "log"))
sinh, cosh = _either(F.sinh, np.sinh), _either(F.cosh, np.cosh)
arcsin, arctan, arctanh, arcsinh = _either(F.asin, np.arcsin), _either(F.atan, np.arctan), _either(F.atanh, np.arctanh), _either(F.asinh, np.arcsinh)
arctan2, hypot = _either(F.atan2, np.arctan2), _either(F.hypot, np.hypot)
degrees, radians = _either(F.degrees, np.degrees), _either(F.radians, np.radians)
maximum = _either(lambda a, b: F.greatest(_lit(a), _lit(b)), np.maximum)
clip = _either(lambda v, lo, hi: F.greatest(F.least(v, F.lit(float(hi))), F.lit(float(lo))), np.clip)
where = _either(lambda c, a, b: F.when(c, a).otherwise(b), np.where)


def turned(d):
    """Degrees of longitude within half a turn."""
    return F.pmod(d + 180, F.lit(360.0)) - 180 if isinstance(d, Column) else (d + 180) % 360 - 180


def let(value, body):
    """`body(value)`, a Column's value being computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1) if isinstance(value, Column) else body(value)


def iterated(step, start, times: int):
    """`step` applied to `start` again and again."""
    if isinstance(start, Column):
        return F.aggregate(F.sequence(F.lit(1), F.lit(times)), start, lambda v, i: step(v))
    for _ in range(times):
        start = step(start)
    return start


def plain(v):
    """Numbers as arrays; Columns as they are."""
    return v if isinstance(v, Column) else np.asarray(v, float)


@dataclass(frozen=True)
class Projection:
    """Of a transverse Mercator grid; `scale` 0 means coordinates are degrees already.  `unit` is the
    length of a step of the grid in metres."""

    a: float = 6378137.0
    inverse_flattening: float = 298.257223563
    lon0: float = 0.0
    lat0: float = 0.0
    scale: float = 0.0
    east: float = 0.0
    north: float = 0.0
    unit: float = 1.0

    @classmethod
    def parse(cls, wkt: str) -> Projection:
        ellipsoid = re.search(r'(?:SPHEROID|ELLIPSOID)\s*\[\s*"[^"]*"\s*,\s*([\d.eE+]+)\s*,\s*([\d.eE+]+)', wkt)
        a, rf = map(float, ellipsoid.groups()) if ellipsoid else (6378137.0, 298.257223563)
        if wkt.lstrip().startswith(("GEOGCS", "GEOGCRS")) or not wkt.strip():
            return cls(a, rf)
        def number(*names: str, default: float | None = None) -> float:
            for n in names:
                m = re.search(rf'PARAMETER\s*\[\s*"{n}"\s*,\s*([-+\d.eE]+)', wkt, re.I)
                if m:
                    return float(m[1])
            if default is None:
                raise ValueError(f"no parameter {names[0]!r}")
            return default

        units = [float(k) for name, k in re.findall(r'UNIT\s*\[\s*"([^"]*)"\s*,\s*([-+\d.eE]+)', wkt) if not re.search("degree|radian|grad|unity", name, re.I)]
        unit = units[-1] if units else 1.0
        lon0 = lambda: number("central_meridian", "longitude_of_center", "longitude_of_origin")
        east, north = (lambda: number("false_easting") * unit), (lambda: number("false_northing") * unit)
        if re.search(r"transverse[_ ]mercator", wkt, re.I):
            return cls(a, rf, lon0(), number("latitude_of_origin"), number("scale_factor"), east(), north(), unit)
        named = re.search(r'PROJECTION\s*\[\s*"([^"]*)"', wkt, re.I)
        kind = next((k for pattern, k in KINDS if named and re.search(pattern, named[1], re.I)), None)
        if kind is None:
            raise ValueError(f"projection not supported: {wkt[:60]!r}")
        lat0 = number("latitude_of_origin", "latitude_of_center", default=0.0)
        lat1 = number("standard_parallel_1", default=lat0)
        lat2 = number("standard_parallel_2", default=lat1)
        if re.search(r"pseudo|auxiliary_sphere|\+nadgrids", wkt, re.I):
            rf = 0.0  # a sphere
        return Sheet(a, rf, lon0(), lat0, number("scale_factor", default=1.0), east(), north(), unit, kind, lat1, lat2)

    @classmethod
    def utm(cls, zone: int, south: bool = False) -> Projection:
        return cls(lon0=zone * 6 - 183.0, scale=0.9996, east=500000.0, north=1e7 if south else 0.0)

    def to_degrees_by_series(self, x, y):
        """As `to_degrees`, by series to the third order in the third flattening, the latitude's too: within
        a ten-millionth of a degree over the width of a zone, and with nothing to iterate."""
        x, y = plain(x), plain(y)
        if not self.scale:
            return x, y
        f = 1 / self.inverse_flattening
        n = f / (2 - f)
        radius = self.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        back = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
        conformal = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
        xi, eta = (y * self.unit - self.north + self.scale * self._origin()) / (self.scale * radius), (x * self.unit - self.east) / (self.scale * radius)
        p = xi - sum(c * sin(2 * j * xi) * cosh(2 * j * eta) for j, c in enumerate(back, 1))
        q = eta - sum(c * cos(2 * j * xi) * sinh(2 * j * eta) for j, c in enumerate(back, 1))
        lat = let(arcsin(sin(p) / cosh(q)), lambda chi: chi + sum(c * sin(2 * j * chi) for j, c in enumerate(conformal, 1)))
        return self.lon0 + degrees(arctan2(sinh(q), cos(p))), degrees(lat)

    def _origin(self) -> float:
        """Metres from the equator to the latitude of origin, without scale."""
        if not self.lat0:
            return 0.0
        return float(Projection(self.a, self.inverse_flattening, self.lon0, 0.0, 1.0).to_grid(np.array(self.lon0), np.array(self.lat0))[1])

    # coefficients of the two series, and the radius of the rectifying sphere
    def _series(self) -> tuple[np.ndarray, np.ndarray, float, float]:
        n = 1 / (2 * self.inverse_flattening - 1)
        n2, n3, n4, n5, n6 = (n**k for k in range(2, 7))
        forward = np.array([
            n / 2 - 2 * n2 / 3 + 5 * n3 / 16 + 41 * n4 / 180 - 127 * n5 / 288 + 7891 * n6 / 37800,
            13 * n2 / 48 - 3 * n3 / 5 + 557 * n4 / 1440 + 281 * n5 / 630 - 1983433 * n6 / 1935360,
            61 * n3 / 240 - 103 * n4 / 140 + 15061 * n5 / 26880 + 167603 * n6 / 181440,
            49561 * n4 / 161280 - 179 * n5 / 168 + 6601661 * n6 / 7257600,
            34729 * n5 / 80640 - 3418889 * n6 / 1995840,
            212378941 * n6 / 319334400,
        ])
        back = np.array([
            n / 2 - 2 * n2 / 3 + 37 * n3 / 96 - n4 / 360 - 81 * n5 / 512 + 96199 * n6 / 604800,
            n2 / 48 + n3 / 15 - 437 * n4 / 1440 + 46 * n5 / 105 - 1118711 * n6 / 3870720,
            17 * n3 / 480 - 37 * n4 / 840 - 209 * n5 / 4480 + 5569 * n6 / 90720,
            4397 * n4 / 161280 - 11 * n5 / 504 - 830251 * n6 / 7257600,
            4583 * n5 / 161280 - 108847 * n6 / 3991680,
            20648693 * n6 / 638668800,
        ])
        radius = self.a / (1 + n) * (1 + n2 / 4 + n4 / 64 + n6 / 256)
        f = 1 / self.inverse_flattening
        return forward, back, radius, np.sqrt(f * (2 - f))

    def to_grid(self, lon, lat):
        """Easting and northing of degrees."""
        lon, lat = plain(lon), plain(lat)
        if not self.scale:
            return lon, lat
        forward, _, radius, e = self._series()

        def raw(lon_, lat_):
            s = sin(radians(lat_))
            t = sinh(arctanh(s) - e * arctanh(e * s))
            d = radians(lon_ - self.lon0)
            xi, eta = arctan2(t, cos(d)), arcsinh(sin(d) / hypot(t, cos(d)))
            x = let(eta, lambda v: v + sum(float(c) * cos(2 * k * xi) * sinh(2 * k * v) for k, c in enumerate(forward, 1)))
            y = let(xi, lambda v: v + sum(float(c) * sin(2 * k * v) * cosh(2 * k * eta) for k, c in enumerate(forward, 1)))
            return radius * x, radius * y

        x, y = raw(lon, lat)
        y0 = float(raw(np.array(self.lon0), np.array(self.lat0))[1])
        return (self.east + self.scale * x) / self.unit, (self.north + self.scale * (y - y0)) / self.unit

    def to_degrees(self, x, y):
        """Longitude and latitude of eastings and northings."""
        x, y = plain(x), plain(y)
        if not self.scale:
            return x, y
        x, y = x * self.unit, y * self.unit
        forward, back, radius, e = self._series()
        e, y0 = float(e), self._origin()
        eta, xi = (x - self.east) / (self.scale * radius), ((y - self.north) / self.scale + y0) / radius
        eta1 = eta - sum(float(c) * cos(2 * k * xi) * sinh(2 * k * eta) for k, c in enumerate(back, 1))
        xi1 = xi - sum(float(c) * sin(2 * k * xi) * cosh(2 * k * eta) for k, c in enumerate(back, 1))
        tau = sin(xi1) / hypot(sinh(eta1), cos(xi1))

        def latitude(tau):
            def step(t):  # Newton on the isometric latitude
                sigma = sinh(e * arctanh(e * t / hypot(1.0, t)))
                ti = t * hypot(1.0, sigma) - sigma * hypot(1.0, t)
                return t + (tau - ti) / hypot(1.0, ti) * (1 + (1 - e * e) * t * t) / ((1 - e * e) * hypot(1.0, t))

            return iterated(step, tau, 4)

        lon = self.lon0 + degrees(arctan2(sinh(eta1), cos(xi1)))
        return lon, degrees(arctan(let(tau, latitude)))


#: Names of projections in descriptions, by pattern; the first that fits counts.
KINDS = (
    ("lambert.*conformal", "lambert"), ("albers", "albers"), ("azimuthal.*equal", "azimuthal"), ("polar.*stereographic|stereographic.*(north|south).*pole", "polar"), ("^mercator", "mercator"),
)


@dataclass(frozen=True)
class Sheet(Projection):
    """Of a cone, a cylinder or a plane: `kind` is one of KINDS, `lat1` and `lat2` its parallels."""

    kind: str = ""
    lat1: float = 0.0
    lat2: float = 0.0

    @property
    def e(self) -> float:
        f = 1 / self.inverse_flattening if self.inverse_flattening else 0.0
        return float(sqrt(f * (2 - f)))

    def _m(self, lat):
        return cos(lat) / sqrt(1 - (self.e * sin(lat)) ** 2)

    def _t(self, lat):
        """Of conformal projections: the tangent of half the conformal colatitude."""
        es = self.e * sin(lat)
        return tan(np.pi / 4 - lat / 2) / ((1 - es) / (1 + es)) ** (self.e / 2)

    def _lat_of_t(self, t):
        def step(lat):
            es = self.e * sin(lat)
            return np.pi / 2 - 2 * arctan(t * ((1 - es) / (1 + es)) ** (self.e / 2))

        return iterated(step, np.pi / 2 - 2 * arctan(t), 12)

    def _q(self, lat):
        """Of equal areas: the area between the equator and a parallel, up to a factor."""
        e, s = self.e, sin(lat)
        if not e:
            return 2 * s
        return (1 - e * e) * (s / (1 - (e * s) ** 2) + arctanh(e * s) / e)

    def _lat_of_q(self, q):
        e = self.e

        def step(lat):
            s, c = sin(lat), maximum(cos(lat), 1e-12)
            return lat + (1 - (e * s) ** 2) ** 2 / (2 * c) * (q / (1 - e * e) - s / (1 - (e * s) ** 2) - arctanh(e * s) / e)

        start = arcsin(clip(q / 2, -1, 1))
        return iterated(step, start, 12) if e else start

    def _cone(self):
        """Of a cone: its constant, and the radius of a parallel and back."""
        l0, l1, l2 = (math.radians(v) for v in (self.lat0, self.lat1, self.lat2))
        m1, m2 = float(self._m(l1)), float(self._m(l2))
        if self.kind == "lambert":
            n = float(sin(l1) if l1 == l2 else log(m1 / m2) / log(self._t(l1) / self._t(l2)))
            r = float(self.a * self.scale * m1 / (n * self._t(l1) ** n))
            return n, l0, lambda lat: r * self._t(lat) ** n, lambda rho: self._lat_of_t((rho / r) ** (1 / n))
        n = float(sin(l1) if l1 == l2 else (m1**2 - m2**2) / (self._q(l2) - self._q(l1)))
        c = float(m1**2 + n * self._q(l1))
        return n, l0, lambda lat: self.a * sqrt(maximum(c - n * self._q(lat), 0)) / n, lambda rho: self._lat_of_q((c - (rho * n / self.a) ** 2) / n)

    def _plane(self):
        """Of the polar plane: which pole, and the radius of a parallel and back, as of the north's."""
        pole = 1.0 if self.lat0 >= 0 else -1.0
        true = math.radians(abs(self.lat1 if abs(self.lat0) == 90 and self.lat1 != self.lat0 else self.lat0))
        e = self.e
        if math.degrees(true) >= 90 - 1e-9:
            r = 2 * self.a * self.scale / sqrt((1 + e) ** (1 + e) * (1 - e) ** (1 - e))
        else:
            r = self.a * self.scale * self._m(true) / self._t(true)
        r = float(r)
        return pole, lambda lat: r * self._t(lat), lambda rho: self._lat_of_t(rho / r)

    def _area(self):
        """Of the equal-area plane: the pole's q, its radius, the centre's authalic latitude, and a ratio."""
        l0, top = math.radians(self.lat0), float(self._q(np.pi / 2))
        radius, b0 = float(self.a * sqrt(top / 2)), float(arcsin(self._q(l0) / top))
        return top, radius, b0, float(self.a * self._m(l0) / (radius * cos(b0)))

    def _cylinder(self) -> float:
        return self.a * (self.scale if self.lat1 == self.lat0 == 0 else float(self._m(math.radians(self.lat1))))

    def to_grid(self, lon, lat):
        lat = radians(plain(lat))
        d = radians(turned(plain(lon) - self.lon0))
        if self.kind in ("lambert", "albers"):
            n, l0, radius, _ = self._cone()
            rho, at = radius(lat), n * d
            x, y = rho * sin(at), float(radius(l0)) - rho * cos(at)
        elif self.kind == "polar":
            pole, radius, _ = self._plane()
            rho = radius(pole * lat)
            x, y = rho * sin(d), -pole * rho * cos(d)
        elif self.kind == "azimuthal":
            top, radius, b0, ratio = self._area()
            b = arcsin(clip(self._q(lat) / top, -1, 1))
            size = radius * sqrt(2 / (1 + math.sin(b0) * sin(b) + math.cos(b0) * cos(b) * cos(d)))
            x, y = size * ratio * cos(b) * sin(d), size / ratio * (math.cos(b0) * sin(b) - math.sin(b0) * cos(b) * cos(d))
        else:
            k = self._cylinder()
            x, y = k * d, -k * log(self._t(lat))
        return (self.east + x) / self.unit, (self.north + y) / self.unit

    def to_degrees(self, x, y):
        x, y = plain(x) * self.unit - self.east, plain(y) * self.unit - self.north
        if self.kind in ("lambert", "albers"):
            n, l0, radius, back = self._cone()
            up = float(radius(l0)) - y
            side = math.copysign(1.0, n)
            d, lat = arctan2(side * x, side * up) / n, back(side * hypot(x, up))
        elif self.kind == "polar":
            pole, _, back = self._plane()
            d, lat = arctan2(x, -pole * y), pole * back(hypot(x, y))
        elif self.kind == "azimuthal":
            top, radius, b0, ratio = self._area()
            rho = hypot(x / ratio, ratio * y)
            c = 2 * arcsin(clip(rho / (2 * radius), -1, 1))
            part = where(rho > 0, ratio * y * sin(c) * math.cos(b0) / where(rho > 0, rho, 1), 0.0)
            lat = self._lat_of_q(top * (cos(c) * math.sin(b0) + part))
            d = arctan2(x * sin(c), ratio * rho * math.cos(b0) * cos(c) - ratio**2 * y * math.sin(b0) * sin(c))
        else:
            k = self._cylinder()
            d, lat = x / k, self._lat_of_t(exp(-y / k))
        return turned(self.lon0 + degrees(d)), degrees(lat)


def lon_lat(x: Column, y: Column, wkt: str, series: bool = False) -> Column:
    """Struct of longitude and latitude of projected coordinates, by SQL functions; with `series`, of
    transverse Mercator grids, by `to_degrees_by_series`."""
    at = F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    def place(p: Column) -> Column:
        projection = Projection.parse(wkt)
        place_of = projection.to_degrees_by_series if series and type(projection) is Projection else projection.to_degrees
        lon, lat = place_of(p["x"], p["y"])
        return F.struct(lon.alias("longitude"), lat.alias("latitude"))

    return let(at, place)


def pixel_place(geo: Column, row: Column, col: Column) -> tuple[Column, Column]:
    """Projected coordinates of a pixel's corner; rotation terms are ignored."""
    return geo[0] + geo[1] * col, geo[3] + geo[5] * row
