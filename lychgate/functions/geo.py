"""Distances, proximity tiers and postal codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
UNKNOWN_KM = 9_999_999.0
#: First letter of a Canadian postal code and its province.
POSTAL_LETTERS = {
    "A": "NL", "B": "NS", "C": "PE", "E": "NB", "G": "QC", "H": "QC", "J": "QC", "K": "ON", "L": "ON", "M": "ON", "N": "ON",
    "P": "ON", "R": "MB", "S": "SK", "T": "AB", "V": "BC", "X": "NT", "Y": "YT",
}
#: Provinces by name.
PROVINCES = {
    "alberta": "AB", "british columbia": "BC", "manitoba": "MB", "new brunswick": "NB", "newfoundland and labrador": "NL",
    "northwest territories": "NT", "nova scotia": "NS", "nunavut": "NU", "ontario": "ON", "prince edward island": "PE",
    "quebec": "QC", "saskatchewan": "SK", "yukon": "YT",
}


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres on a sphere; UNKNOWN_KM where a coordinate is missing, zero or out of range."""
    p, q = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((q - p) / 2), 2) + F.cos(p) * F.cos(q) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    ok = placed(lat1, lon1) & placed(lat2, lon2)
    return F.when(ok, 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))).otherwise(F.lit(UNKNOWN_KM))


def placed(lat: Column, lon: Column) -> Column:
    known = lat.isNotNull() & lon.isNotNull()
    return known & (lat != 0) & (lon != 0) & (F.abs(lat) <= 90) & (F.abs(lon) <= 180)


def valid_place(code: Column, province: Column, lat: Column, lon: Column) -> Column:
    return F.coalesce(F.length(code).isin(3, 7) & province.isNotNull() & (lat != 0) & (lon != 0), F.lit(False))


def proximity_points(km: Column, same_province: Column, northern: Column) -> Column:
    """Points for nearness: by distance, else for a shared province."""
    return (
        F.when(km < 25, 750).when(km < 100, 500).when(km < 250, 350).when(km < 750, 250)
        .when(same_province & northern, 250).when(same_province, 150).otherwise(0)
    )


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def province_of_code(code: Column, compat: bool = False) -> Column:
    """Province of a postal code's first letter. compat: letters up to P are taken as the next one."""
    letter = F.upper(F.left(F.trim(code), F.lit(1)))
    if compat:
        moved = F.chr(F.ascii(letter) - 1)
        letter = F.when(letter.between("B", "Q"), moved).otherwise(F.when(letter < "R", F.lit("?")).otherwise(letter))
    return F.try_element_at(_map(POSTAL_LETTERS), letter)


def province_code(name: Column) -> Column:
    """Two letters of a province given by name or by letters."""
    key = F.lower(F.translate(F.trim(name), "éÉ", "eE"))
    return F.coalesce(F.try_element_at(_map(PROVINCES), key), F.when(F.upper(key).isin(*PROVINCES.values()), F.upper(key)))
