"""Compact position reporting (CPR): decode against a reference or from a frame pair.

Each step is a column of its own, so that the optimiser evaluates a latitude
once although the longitude uses it several times.
"""

from __future__ import annotations

import math

from tarmac.functions.fixed_values import RECEIVER_LAT, RECEIVER_LON
from tarmac.functions.steps import Steps

SCALE = "131072D"
AIRBORNE_ZONE = "360D"
SURFACE_ZONE = "90D"


def zone_count(lat: str) -> str:
    """Number of longitude zones at a latitude (59 at the equator, 1 at the poles)."""
    widest = 1.0 - math.cos(math.pi / 30)
    arc = f"acos(1D - {widest!r}D / (cos(radians({lat})) * cos(radians({lat}))))"
    return (
        f"cast(case when abs({lat}) < 1e-9D then 59 when abs({lat}) > 87D then 1 when abs({lat}) = 87D then 2 "
        f"else floor({2 * math.pi!r}D / {arc}) end as int)"
    )


def _floor_mod(value: str, divisor: str) -> str:
    return f"({value} - {divisor} * floor({value} / {divisor}))"


def _nearest(code: str, step: str, reference: float) -> str:
    """The position with this fraction of a step that lies nearest the reference."""
    ref = f"({float(reference)!r}D)"
    inside = f"floor(0.5D + {_floor_mod(ref, step)} / {step} - {code} / {SCALE})"
    return f"{step} * (floor({ref} / {step}) + {inside} + {code} / {SCALE})"


def reference_latitude(zone: str, odd: str, code: str, ref_lat: float = RECEIVER_LAT) -> str:
    """Latitude of a position code near the reference; null for a null frame parity."""
    return f"if({odd} is null, null, {_nearest(code, f'({zone} / (60 - {odd}))', ref_lat)})"


def longitude_step(zone: str, odd: str, lat: str) -> str:
    return f"if({odd} is null, null, {zone} / greatest({zone_count(lat)} - {odd}, 1))"


def reference_longitude(step: str, code: str, ref_lon: float = RECEIVER_LON) -> str:
    """Longitude of a position code near the reference."""
    return f"if({step} is null, null, {_nearest(code, step, ref_lon)})"


def pair_position(even: str, odd: str, newest_odd: str, ground: str, ref_lat: float = RECEIVER_LAT, ref_lon: float = RECEIVER_LON) -> Steps:
    """Steps up to the columns ``pair_lat`` and ``pair_lon`` of two structs ``(lat, lon)`` of codes.

    The result is null where the two latitudes fall in different zones. Airborne codes divide the
    whole circle. Codes of frames on the ground divide a quarter of it, and the quarter nearest
    the receiver is taken.
    """
    ye, xe = f"({even}.lat / {SCALE})", f"({even}.lon / {SCALE})"
    yo, xo = f"({odd}.lat / {SCALE})", f"({odd}.lon / {SCALE})"
    lat, lon = f"({float(ref_lat)!r}D)", f"({float(ref_lon)!r}D)"

    def northern(value: str) -> str:
        """A latitude of 0 to 90 or, for airborne codes, 0 to 360 degrees as a signed one."""
        south = f"if(abs({value} - 90 - {lat}) < abs({value} - {lat}), {value} - 90, {value})"
        return f"if({ground}, {south}, if({value} >= 270, {value} - 360, {value}))"

    # boundaries keep each value from being written out again wherever it is used
    return (
        Steps()
        .once({"__j": f"floor(59 * {ye} - 60 * {yo} + 0.5D)", "__circle": f"if({ground}, {SURFACE_ZONE}, {AIRBORNE_ZONE})"})
        .once({"__even": f"__circle / 60 * (pmod(__j, 60) + {ye})", "__odd": f"__circle / 59 * (pmod(__j, 59) + {yo})"})
        .once({"__even_lat": northern("__even"), "__odd_lat": northern("__odd")})
        .once({"__even_zones": zone_count("__even_lat"), "__odd_zones": zone_count("__odd_lat")})
        .add(
            {
                "__zones": "if(__even_zones = __odd_zones, __even_zones, null)",
                "__count": f"greatest(__zones - if({newest_odd}, 1, 0), 1)",
                "__m": f"floor({xe} * (__zones - 1) - {xo} * __zones + 0.5D)",
            }
        )
        .once({"__lon": f"__circle / __count * (pmod(__m, __count) + if({newest_odd}, {xo}, {xe}))"})
        .add(
            {
                "__quarter": f"__lon + 90 * floor(({lon} - __lon) / 90 + 0.5D)",
                "pair_lat": f"if(__zones is null, null, if({newest_odd}, __odd_lat, __even_lat))",
                "pair_lon": f"if(__zones is null, null, if({ground}, __quarter, if(__lon >= 180, __lon - 360, __lon)))",
            }
        )
    )


def position_codes(zone: str, odd: str, lat: str, lon: str) -> dict[str, str]:
    """Columns, in order, up to the 17-bit codes ``lat_code`` and ``lon_code`` of a position."""
    return {
        "__dlat": f"{zone} / (60 - {odd})",
        "__yz": f"floor({SCALE} * {_floor_mod(lat, '__dlat')} / __dlat + 0.5D)",
        "__rlat": f"__dlat * (__yz / {SCALE} + floor({lat} / __dlat))",
        "__dlon": f"{zone} / greatest({zone_count('__rlat')} - {odd}, 1)",
        "__xz": f"floor({SCALE} * {_floor_mod(lon, '__dlon')} / __dlon + 0.5D)",
        "lat_code": "pmod(__yz, 131072L)",
        "lon_code": "pmod(__xz, 131072L)",
    }
