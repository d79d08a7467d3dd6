"""UTC instant → clock string for a zone (FN-10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: hours behind UTC used for the
# four zone labels (a fixed offset, no daylight-saving rule).
#   est = 4, cst = 5, mst = 6, pst = 7
ZONE_OFFSETS = {"est": 4, "cst": 5, "mst": 6, "pst": 7}
ZONES = tuple(ZONE_OFFSETS)


def parse_zone(zone: str) -> str:
    """Normalise a zone label (`EST`, ` pst `) to its key; reject others."""
    key = zone.strip().lower() if isinstance(zone, str) else zone
    if key not in ZONE_OFFSETS:
        raise ValueError(f"unknown zone {zone!r}; expected one of {', '.join(ZONES)}")
    return key


def utc_clock(ts: Column | str, zone: str) -> Column:
    """``H:MM`` of a UTC ``timestamp_ntz`` in a fixed-offset zone.

    The hour wraps modulo 24 and is not padded, minutes are two digits
    (``19:05``, ``0:30``).  The date is not shifted.  ``ts`` should be a
    ``timestamp_ntz`` so that ``hour`` does not depend on the session zone.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    k = ZONE_OFFSETS[parse_zone(zone)]
    return F.concat(
        F.pmod(F.hour(ts) - F.lit(k), F.lit(24)).cast("string"),
        F.lit(":"),
        F.lpad(F.minute(ts).cast("string"), 2, "0"),
    )


def local_clock(ts: Column | str, time_zone: str) -> Column:
    """``H:MM`` of a UTC ``timestamp_ntz`` under real zone rules (with DST).

    An alternative to :func:`utc_clock`: ``America/New_York`` at 00:30 UTC is
    19:30 in January and 20:30 in April.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    shifted = F.convert_timezone(F.lit("UTC"), F.lit(time_zone), ts)
    return F.date_format(shifted, "H:mm")


# date, time, seconds with up to six of their fraction digits (more are cut off), offset
_INSTANT = r"^(\d{4})-(\d{2})-(\d{2})T(\d{2}):(\d{2}):(\d{2}(?:\.\d{1,6})?)(?:(?<=\.\d{6})\d+)?(?:Z|([+-])(\d{2}):?(\d{2}))?$"


def parse_utc_instant(text: Column | str) -> Column:
    """``2021-03-01T23:00:00Z`` (optionally with a fraction of any length, or an
    offset such as ``+01:00`` in place of ``Z``) → ``timestamp_ntz`` holding the
    UTC wall clock; anything else, or an impossible date, → NULL.

    Built from the parts with ``try_make_timestamp_ntz``: no session time zone
    is involved, so a wall clock that falls into a daylight-saving gap of the
    session zone is kept as written.
    """
    text = F.col(text) if isinstance(text, str) else text

    def part(i: int, type_: str) -> Column:
        return F.regexp_extract(text, _INSTANT, i).try_cast(type_)

    built = F.try_make_timestamp_ntz(
        part(1, "int"), part(2, "int"), part(3, "int"), part(4, "int"), part(5, "int"), part(6, "decimal(8,6)")
    )
    minutes = F.coalesce(part(8, "int") * 60 + part(9, "int"), F.lit(0))
    ahead = F.when(F.regexp_extract(text, _INSTANT, 7) == "-", -minutes).otherwise(minutes)
    return F.when(text.rlike(_INSTANT), built - F.make_dt_interval(mins=ahead))
