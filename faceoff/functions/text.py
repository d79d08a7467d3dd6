"""Text helpers: key normalisation, trimming, safe casts, JSON scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Java's Character.isWhitespace accepts — regex
# whitespace, the separators U+001C..U+001F and every Unicode space
# separator except the three non-breaking ones (U+00A0, U+2007, U+202F).
JAVA_WHITESPACE = r"[\s\x1C-\x1F\p{Z}&&[^\u00A0\u2007\u202F]]"

# Java String.trim strips every character up to and including U+0020.
# (\z: ``$`` would also match before a last line separator such as U+2028.)
_JAVA_TRIM = r"\A[\x00-\x20]+|[\x00-\x20]+\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_key(c: Column | str) -> Column:
    """Lower-case and drop all whitespace (FN-7 + FN-9): `` Bob\\t`` → ``bob``."""
    return F.regexp_replace(F.lower(_col(c)), JAVA_WHITESPACE, "")


_NON_BREAKING = {"\u00a0", "\u2007", "\u202f"}


def _java_whitespace(ch: str) -> bool:
    import unicodedata

    if ch in "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f":
        return True
    return unicodedata.category(ch) in ("Zs", "Zl", "Zp") and ch not in _NON_BREAKING


def normalize_key_text(text: str) -> str:
    """:func:`normalize_key` for a Python string (a literal key on the driver)."""
    return "".join(ch for ch in text.lower() if not _java_whitespace(ch))


def java_trim(c: Column | str) -> Column:
    """Strip leading/trailing characters ≤ U+0020 (Spark ``trim`` strips spaces only)."""
    return F.regexp_replace(_col(c), _JAVA_TRIM, "")


def label(c: Column | str) -> Column:
    """Upper-case display label (FN-8), e.g. a zone key ``est`` → ``EST``."""
    return F.upper(_col(c))


def try_int(c: Column | str) -> Column:
    """Text → int, NULL when malformed (ANSI ``cast`` would throw)."""
    return _col(c).try_cast("int")


def try_long(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def try_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def json_scalar(doc: Column | str, key: str, cast: str | None = None) -> Column:
    """Value of top-level ``key`` in a JSON text column (SRC-6).

    Strings come back unquoted; with ``cast`` the text is converted with
    ``try_cast`` so malformed values become NULL instead of failing the task.
    """
    if "'" in key:  # a JSON path has no escape for it
        value = F.from_json(_col(doc), "map<string, string>").getItem(key)
    else:
        value = F.get_json_object(_col(doc), f"$['{key}']")
    return value.try_cast(cast) if cast else value


def without_separator(c: Column | str, sep: str = ",", what: str = "value") -> Column:
    """Pass the value through, failing the job if it contains ``sep`` (FN-12).

    Used as a guard on delimited sinks: the format has no quoting, so a
    separator inside a value would shift every later column.
    """
    c = _col(c)
    return F.when(F.instr(c, sep) > 0, F.raise_error(F.lit(f"{what} contains the separator {sep!r}"))).otherwise(c)
