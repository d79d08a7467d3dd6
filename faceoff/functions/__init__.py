"""Column-level helpers; all are native expressions (no UDFs)."""

from faceoff.functions.clock import (
    ZONE_OFFSETS,
    ZONES,
    local_clock,
    parse_utc_instant,
    parse_zone,
    utc_clock,
)
from faceoff.functions.text import (
    JAVA_WHITESPACE,
    java_trim,
    json_scalar,
    label,
    normalize_key,
    normalize_key_text,
    try_double,
    try_int,
    try_long,
    without_separator,
)

__all__ = [
    "JAVA_WHITESPACE",
    "ZONES",
    "ZONE_OFFSETS",
    "java_trim",
    "json_scalar",
    "label",
    "local_clock",
    "normalize_key",
    "normalize_key_text",
    "parse_utc_instant",
    "parse_zone",
    "try_double",
    "try_int",
    "try_long",
    "utc_clock",
    "without_separator",
]
