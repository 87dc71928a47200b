"""Text cleaning and tolerant casts. Bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything Unicode counts as white space; plain trim() knows the blank only.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Digits may be grouped by single underscores, as in 1_000.
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
NUMBER = (
    rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
    r"|^[+-]?(?i:inf|infinity)$|^(?i:nan)$"
)
SIGNED_NAN = r"^[+-](?i:nan)$"
INTEGER = rf"^[+-]?{_DIGITS}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without surrounding white space of any kind.

    Where plain trimming leaves printable ASCII at both ends nothing more can
    come off, and the slow search through the whole character set is spared.
    """
    c = _col(c)
    bare = F.trim(c)
    done = F.ascii(bare).between(33, 126) & F.ascii(F.substring(bare, -1, 1)).between(33, 126)
    return F.when(done, bare).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def code(c: Column | str) -> Column:
    """A code in its canonical form: NULL as '', stripped, upper case."""
    return F.upper(strip(F.coalesce(_col(c), F.lit(""))))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def label_or(c: Column | str, default: str) -> Column:
    """A label, or the default where it is NULL or empty (blanks are kept)."""
    c = _col(c)
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(strip(c))


def double_or_null(c: Column | str) -> Column:
    """Text to double: surrounding blanks, inf and nan are accepted, junk is NULL.

    The pattern comes first because a cast alone would take '1d' and miss '1_000'.
    """
    text = strip(c)
    return F.when(
        text.rlike(NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    ).when(text.rlike(SIGNED_NAN), F.lit(float("nan")))


def int_or_null(c: Column | str) -> Column:
    """Text to int: '2015' is taken, '2015.0' is not."""
    text = strip(c)
    return F.when(text.rlike(INTEGER), F.replace(text, F.lit("_"), F.lit("")).try_cast("int"))


def date_or_null(c: Column | str) -> Column:
    """Text to date: exactly yyyy-mm-dd, and a day of the calendar."""
    text = strip(c)
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))


def number_or(a: Column | str, b: Column | str) -> Column:
    """``a``, but ``b`` where ``a`` is NULL *or zero*."""
    a, b = _col(a), _col(b)
    return F.when(a.isNull() | (a == 0), b).otherwise(a)


def text_or(a: Column | str, b: Column | str) -> Column:
    """``a``, but ``b`` where ``a`` is NULL *or empty*."""
    a, b = _col(a), _col(b)
    return F.when(a.isNull() | (a == ""), b).otherwise(a)


def allow_list(text: str | None, single: str | None = None) -> list[str]:
    """Codes of a comma list; where the list is blank, the one fallback code."""
    if text and text.strip():
        return [p.strip().upper() for p in text.split(",") if p.strip()]
    fallback = (single or "").strip().upper()
    return [fallback] if fallback else []


def allowed(c: Column | str, codes: list[str]) -> Column:
    """Membership in the list; an empty list allows everything."""
    return _col(c).isin(codes) if codes else F.lit(True)


def in_years(c: Column | str, years: tuple[int, int]) -> Column:
    return _col(c).between(*years)


def any_present(columns: list[str]) -> Column:
    """True where at least one column holds a value; zero is a value."""
    return F.coalesce(*columns).isNotNull()


def is_aggregate_code(c: Column | str, prefix: str) -> Column:
    """Codes that stand for a group of countries, or for nothing."""
    c = _col(c)
    return (c == "") | c.startswith(prefix)
