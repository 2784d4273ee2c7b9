"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardbook.functions.numbers import decimal_text

# The attributes behind each key, in hashing order and in the order of the
# dimension's columns, and the text that stands in for NULL. The separator is not escaped, so equal joined text means an
# equal key.
SEPARATOR = "|"
LOCATION_NULL = ""
ATTRIBUTE_NULL = "<NULL>"
LOCATION_KEY = [
    "city",
    "borough",
    "landmark",
    "street_name",
    "incident_zip",
    "park_borough",
    "cross_street_1",
    "cross_street_2",
    "intersection_street_1",
    "intersection_street_2",
    "incident_address",
    "park_facility_name",
    "latitude",
    "longitude",
    "x_coordinate_state_plane",
    "y_coordinate_state_plane",
    "community_board",
    "council_district",
]
AGENCY_KEY = ["agency", "agency_name"]
COMPLAINT_TYPE_KEY = ["complaint_type", "descriptor", "descriptor_2"]
STATUS_KEY = ["status"]
CHANNEL_KEY = ["open_data_channel_type"]


def hashed(parts: list[Column], null_text: str) -> Column:
    """Lower-case md5 hex of the joined parts; never NULL."""
    return F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(p, F.lit(null_text)) for p in parts]))


def hashed_array(parts: list[Column], null_text: str) -> Column:
    """hashed() for many parts.

    Eighteen coalesces beside the cleaning of all columns make one generated method of
    over 8,000 bytes, which the JVM never compiles. transform keeps this projection out
    of that method; staging runs three times as fast.
    """
    known = F.transform(F.array(*parts), lambda part: F.coalesce(part, F.lit(null_text)))
    return F.md5(F.concat_ws(SEPARATOR, known))


def surrogate_keys() -> dict[str, Column]:
    """The five keys of a cleaned request."""
    location = [
        decimal_text(F.col(c)) if c in ("latitude", "longitude") else F.col(c)
        for c in LOCATION_KEY
    ]

    def attributes(columns: list[str]) -> Column:
        return hashed([F.col(c) for c in columns], ATTRIBUTE_NULL)

    return {
        "location_key": hashed_array(location, LOCATION_NULL),
        "agency_key": attributes(AGENCY_KEY),
        "complaint_type_key": attributes(COMPLAINT_TYPE_KEY),
        "status_key": attributes(STATUS_KEY),
        "channel_key": attributes(CHANNEL_KEY),
    }
