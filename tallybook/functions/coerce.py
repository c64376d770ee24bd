"""Forgiving text-to-value conversions: bad input becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes; Spark's plain trim removes blanks only.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_SPACE = f"[{WHITESPACE}]"


def _maybe_space(character: Column) -> Column:
    code = F.ascii(character)
    return (code <= 32) | (code >= 0x85)


def strip(c: Column | str) -> Column:
    """Python's str.strip(); the slow character-set trim runs only on text that may need it."""
    text = F.trim(col(c).cast("string"))
    ragged = _maybe_space(text) | _maybe_space(F.right(text, F.lit(1)))
    return F.when(ragged, F.btrim(text, F.lit(WHITESPACE))).otherwise(text)


def is_blank(c: Column | str) -> Column:
    """Null, empty or the text ``nan``, whatever blanks surround it."""
    return F.coalesce(F.lower(strip(c)).isin("", "nan"), F.lit(True))


def starts_with_c(c: Column | str) -> Column:
    return col(c).cast("string").rlike(f"^{_SPACE}*[cC]")


def to_number(c: Column | str) -> Column:
    """Double or null. Java's ``1d``/``1f``/hex-float spellings are not numbers here."""
    text = col(c).cast("string")  # the cast to double trims by itself
    return F.when(~text.rlike("[dDfFpP]"), text.try_cast("double"))


def to_whole(c: Column | str) -> Column:
    """Number truncated toward zero."""
    return to_number(c).try_cast("bigint")


#: Accepted besides ISO: US dates with and without a time, and a named month.
DATE_FORMATS = ["M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "d-MMM-yyyy H:mm:ss", "d-MMM-yyyy H:mm", "d-MMM-yyyy"]
#: Moments outside these years are no dates.
FIRST_YEAR, LAST_YEAR = 1678, 2261


def to_moment(c: Column | str) -> Column:
    """ISO text, or one of ``DATE_FORMATS``, within the accepted years; anything else is null."""
    value = col(c)
    text = value.cast("string")
    shaped = text.rlike(r"^\s*[0-9]{1,2}[/-][0-9A-Za-z]{1,3}[/-][0-9]{4}")
    other = F.coalesce(*[F.try_to_timestamp(F.trim(text), F.lit(f)).cast("timestamp_ntz") for f in DATE_FORMATS])
    moment = F.coalesce(value.try_cast("timestamp_ntz"), F.when(shaped, other))
    return F.when(F.year(moment).between(FIRST_YEAR, LAST_YEAR), moment)


def title_case(c: Column | str) -> Column:
    """Capitalise after every character that has no case, as Python's str.title() does.

    ``initcap`` only restarts after a blank, so where that differs a marker and a blank are put after
    each other uncased character first and taken out again afterwards.
    """
    text = col(c)
    marked = F.regexp_replace(text, r"([^\p{Lu}\p{Ll}\p{Lt} ])(?=\p{L})", "$1\u0001 ")
    exact = F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))
    done = text.rlike("^[A-Z][a-z]*(?: [A-Z][a-z]*)*$")  # most names are in title case already
    return F.when(done, text).when(text.rlike("[^A-Za-z ]"), exact).otherwise(F.initcap(text))
