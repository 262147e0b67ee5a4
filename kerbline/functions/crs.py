"""Coordinate transforms as column expressions.

UTM uses the Krüger series to fourth order in the third flattening, which is
exact to well below a micrometre inside a zone; the state-plane inverse is the
two-parallel Lambert conic on the GRS80 ellipsoid.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: ellipsoids and projection parameters
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
GRS80_F = 1 / 298.257222101
EARTH_RADIUS_M = 6371000.0
UTM_K0, UTM_FALSE_EASTING = 0.9996, 500000.0
US_SURVEY_FOOT = 1200.0 / 3937.0
CALIFORNIA_3 = {"lat0": 36.5, "lon0": -120.5, "sp1": 37.0 + 4.0 / 60, "sp2": 38.0 + 26.0 / 60,
                "fe": 2000000.0, "fn": 500000.0}

_n = WGS84_F / (2 - WGS84_F)
MERIDIAN_RADIUS = WGS84_A / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
CONFORMAL_E = 2 * math.sqrt(_n) / (1 + _n)
ALPHA = (_n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16 + 41 * _n**4 / 180,
         13 * _n**2 / 48 - 3 * _n**3 / 5 + 557 * _n**4 / 1440,
         61 * _n**3 / 240 - 103 * _n**4 / 140,
         49561 * _n**4 / 161280)
BETA = (_n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96 - _n**4 / 360,
        _n**2 / 48 + _n**3 / 15 - 437 * _n**4 / 1440,
        17 * _n**3 / 480 - 37 * _n**4 / 840,
        4397 * _n**4 / 161280)
DELTA = (2 * _n - 2 * _n**2 / 3 - 2 * _n**3 + 116 * _n**4 / 45,
         7 * _n**2 / 3 - 8 * _n**3 / 5 - 227 * _n**4 / 45,
         56 * _n**3 / 15 - 136 * _n**4 / 35,
         4279 * _n**4 / 630)


def central_meridian(zone: int) -> float:
    return zone * 6.0 - 183.0


# Each transform is three short steps so that intermediate values are computed
# once, whether the steps become projections (scalars) or chained lambdas (arrays).

def _fwd_1(lon: Column, lat: Column, zone: int) -> dict[str, Column]:
    s = F.sin(F.radians(lat))
    return {"t": F.sinh(F.atanh(s) - CONFORMAL_E * F.atanh(CONFORMAL_E * s)),
            "dl": F.radians(lon - central_meridian(zone))}


def _fwd_2(t: Column, dl: Column) -> dict[str, Column]:
    return {"xi": F.atan2(t, F.cos(dl)), "eta": F.atanh(F.sin(dl) / F.sqrt(1 + t * t))}


def _fwd_3(xi: Column, eta: Column) -> dict[str, Column]:
    e, n = eta, xi
    for j, a in enumerate(ALPHA, 1):
        e = e + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n = n + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    k = UTM_K0 * MERIDIAN_RADIUS
    return {"x": UTM_FALSE_EASTING + k * e, "y": k * n}


def _inv_1(x: Column, y: Column) -> dict[str, Column]:
    k = UTM_K0 * MERIDIAN_RADIUS
    return {"xi": y / k, "eta": (x - UTM_FALSE_EASTING) / k}


def _inv_2(xi: Column, eta: Column) -> dict[str, Column]:
    p, q = xi, eta
    for j, b in enumerate(BETA, 1):
        p = p - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        q = q - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return {"p": p, "q": q}


def _inv_3(p: Column, q: Column, zone: int) -> dict[str, Column]:
    return {"chi": F.asin(F.sin(p) / F.cosh(q)),
            "lon": central_meridian(zone) + F.degrees(F.atan2(F.sinh(q), F.cos(p)))}


def _inv_4(chi: Column) -> Column:
    phi = chi
    for j, d in enumerate(DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.degrees(phi)


def _step(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    return df.withColumns({f"_crs_{k}": v for k, v in cols.items()})


def _tmp(*names: str) -> list[Column]:
    return [F.col(f"_crs_{n}") for n in names]


def add_utm(df: DataFrame, lon: str = "lon", lat: str = "lat", x: str = "x", y: str = "y",
            zone: int = 10) -> DataFrame:
    """Add UTM easting/northing columns for a lon/lat column pair."""
    df = _step(df, _fwd_1(F.col(lon), F.col(lat), zone))
    df = _step(df, _fwd_2(*_tmp("t", "dl")))
    out = _fwd_3(*_tmp("xi", "eta"))
    return df.withColumns({x: out["x"], y: out["y"]}).drop("_crs_t", "_crs_dl", "_crs_xi", "_crs_eta")


def add_lonlat(df: DataFrame, x: str = "x", y: str = "y", lon: str = "lon", lat: str = "lat",
               zone: int = 10) -> DataFrame:
    """Add lon/lat columns for a UTM column pair."""
    df = _step(df, _inv_1(F.col(x), F.col(y)))
    df = _step(df, _inv_2(*_tmp("xi", "eta")))
    df = _step(df, _inv_3(*_tmp("p", "q"), zone))
    return (df.withColumns({lon: F.col("_crs_lon"), lat: _inv_4(F.col("_crs_chi"))})
            .drop("_crs_xi", "_crs_eta", "_crs_p", "_crs_q", "_crs_chi", "_crs_lon"))


def _struct(cols: dict[str, Column]) -> Column:
    return F.struct(*[v.alias(k) for k, v in cols.items()])


def utm_line(line: Column, zone: int = 10) -> Column:
    """Apply the forward transform to every vertex of a coordinate array."""
    a = F.transform(line, lambda p: _struct(_fwd_1(p["x"], p["y"], zone)))
    b = F.transform(a, lambda p: _struct(_fwd_2(p["t"], p["dl"])))
    return F.transform(b, lambda p: _struct(_fwd_3(p["xi"], p["eta"])))


def lonlat_line(line: Column, zone: int = 10) -> Column:
    """Apply the inverse transform to every vertex of a coordinate array."""
    a = F.transform(line, lambda p: _struct(_inv_1(p["x"], p["y"])))
    b = F.transform(a, lambda p: _struct(_inv_2(p["xi"], p["eta"])))
    c = F.transform(b, lambda p: _struct(_inv_3(p["p"], p["q"], zone)))
    return F.transform(c, lambda p: F.struct(p["lon"].alias("x"), _inv_4(p["chi"]).alias("y")))


def haversine(lon0: Column, lat0: Column, lon1: Column, lat1: Column) -> Column:
    """Great-circle distance in metres."""
    sp = F.sin(F.radians(lat1 - lat0) / 2)
    sl = F.sin(F.radians(lon1 - lon0) / 2)
    a = sp * sp + F.cos(F.radians(lat0)) * F.cos(F.radians(lat1)) * sl * sl
    return 2 * EARTH_RADIUS_M * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def conic_constants(p: dict[str, float] = CALIFORNIA_3) -> dict[str, float]:
    """Cone constant, scale and origin radius of a two-parallel Lambert conic."""
    e = math.sqrt(GRS80_F * (2 - GRS80_F))

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

    def t(phi: float) -> float:
        return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

    p1, p2, p0 = (math.radians(p[k]) for k in ("sp1", "sp2", "lat0"))
    n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
    f = m(p1) / (n * t(p1) ** n)
    return {"e": e, "n": n, "af": WGS84_A * f, "rho0": WGS84_A * f * t(p0) ** n}


def add_state_plane_lonlat(df: DataFrame, x_ft: str, y_ft: str, lon: str, lat: str,
                           p: dict[str, float] = CALIFORNIA_3) -> DataFrame:
    """Add lon/lat columns for state-plane coordinates in US survey feet."""
    k = conic_constants(p)
    e = k["e"]
    df = df.withColumns({"_sp_x": F.col(x_ft) * US_SURVEY_FOOT - p["fe"],
                         "_sp_y": k["rho0"] - (F.col(y_ft) * US_SURVEY_FOOT - p["fn"])})
    df = df.withColumns({
        "_sp_t": F.pow(F.sqrt(F.col("_sp_x") * F.col("_sp_x") + F.col("_sp_y") * F.col("_sp_y")) / k["af"],
                       F.lit(1 / k["n"])),
        "_sp_lon": p["lon0"] + F.degrees(F.atan2(F.col("_sp_x"), F.col("_sp_y")) / k["n"])})
    df = df.withColumn("_sp_phi", math.pi / 2 - 2 * F.atan(F.col("_sp_t")))
    for _ in range(6):  # fixed-point latitude, converged far below a millimetre
        s = e * F.sin(F.col("_sp_phi"))
        df = df.withColumn("_sp_phi", math.pi / 2 - 2 * F.atan(
            F.col("_sp_t") * F.pow((1 - s) / (1 + s), F.lit(e / 2))))
    return (df.withColumns({lon: F.col("_sp_lon"), lat: F.degrees("_sp_phi")})
            .drop("_sp_x", "_sp_y", "_sp_t", "_sp_lon", "_sp_phi"))
