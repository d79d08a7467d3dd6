"""Validation of report parameters (the reference's menu answers).

The reference reads these from a console; here they are function
parameters.  Unknown values raise ``ValueError`` instead of silently widening
the report (M9), and ``metro`` / ``metropolitan`` are both accepted (M10).
"""

from __future__ import annotations

from faceoff.functions.clock import ZONES, parse_zone

# Fixed values that must equal the reference's value domains.
CONFERENCES = ("Western", "Eastern")
DIVISIONS = ("Atlantic", "Metropolitan", "Central", "Pacific")
POSITIONS = ("Center", "Left Wing", "Right Wing", "Defenseman", "Goalie")
METRICS = ("GP", "W", "L", "OTL", "PTS", "GPG", "GAPG")
DEFAULT_METRIC = "PTS"
USER_TYPES = ("basic", "admin")

_DIVISION_ALIASES = {"metro": "Metropolitan"}


def _pick(value: str, domain: tuple[str, ...], what: str, aliases: dict[str, str] | None = None) -> str:
    key = " ".join(str(value).split()).lower()
    if aliases and key in aliases:
        return aliases[key]
    for item in domain:
        if item.lower() == key:
            return item
    raise ValueError(f"unknown {what} {value!r}; expected one of {', '.join(domain)}")


def parse_conference(value: str) -> str:
    return _pick(value, CONFERENCES, "conference")


def parse_division(value: str) -> str:
    return _pick(value, DIVISIONS, "division", _DIVISION_ALIASES)


def parse_position(value: str) -> str:
    return _pick(value, POSITIONS, "position")


def parse_metric(value: str) -> str:
    return _pick(value, METRICS, "metric")


def parse_user_type(value: str) -> str:
    return _pick(value, USER_TYPES, "user type")


def parse_team_id(value: int | str | None) -> int | None:
    """``None`` / ``"all"`` → no filter; a positive id → that team (M11)."""
    if value is None or (isinstance(value, str) and value.strip().lower() == "all"):
        return None
    try:
        team_id = int(str(value).strip())
    except ValueError:
        raise ValueError(f"team id must be a positive integer, got {value!r}") from None
    if team_id <= 0:
        raise ValueError(f"team id must be a positive integer, got {value!r}")
    return team_id


__all__ = [
    "CONFERENCES",
    "DEFAULT_METRIC",
    "DIVISIONS",
    "METRICS",
    "POSITIONS",
    "USER_TYPES",
    "ZONES",
    "parse_conference",
    "parse_division",
    "parse_metric",
    "parse_position",
    "parse_team_id",
    "parse_user_type",
    "parse_zone",
]
