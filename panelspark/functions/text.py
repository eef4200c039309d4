"""Text, code and key expressions.  All of them are built-ins, so they stay in code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accented letters that name matching folds, and their plain forms.
ACCENTED = "éèêëàâäîïôöùûüç"
UNACCENTED = "eeeeaaaiioouuuc"

# Default for missing text, default for a missing postcode, valid unit codes.
MISSING_TEXT = "non spécifié"
MISSING_POSTCODE = "00000"
UNIT_CODE = "^(2A|2B|[0-9]{1,3})$"
REGION_CODE = "^[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standard_text(c: Column | str, default: str = MISSING_TEXT) -> Column:
    """Lower-case and trim; a missing value becomes ``default``."""
    return F.coalesce(F.trim(F.lower(_col(c))), F.lit(default))


def name_key(c: Column | str) -> Column:
    """Spelling-insensitive matching key of a place name."""
    folded = F.translate(F.lower(F.trim(_col(c))), ACCENTED, UNACCENTED)
    return F.regexp_replace(folded, "[-' ]", "")


def plain_apostrophes(c: Column | str) -> Column:
    """Typographic apostrophes become the ASCII one, so map keys match either spelling."""
    return F.translate(_col(c), "’‘`´", "''''")


def upper_name(c: Column | str) -> Column:
    return F.trim(F.upper(plain_apostrophes(c)))


def without_brackets(c: Column | str) -> Column:
    """``NAME (PARTY)`` → ``NAME``."""
    return F.trim(F.regexp_replace(_col(c), r"\([^)]*\)", ""))


def without_quotes(c: Column | str) -> Column:
    return F.regexp_replace(F.trim(_col(c)), '"', "")


def without_decimal_tail(c: Column | str) -> Column:
    """``7.0`` → ``7`` (a code that a spreadsheet turned into a number)."""
    return F.regexp_replace(_col(c), r"\.0$", "")


def pad_code(c: Column | str, width: int = 2) -> Column:
    """Left-pad with zeros, never truncating a longer code such as ``971``."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def unit_code(c: Column | str) -> Column:
    """Full normalisation of a unit code: quotes, blanks, decimal tail, padding."""
    cleaned = F.trim(without_decimal_tail(without_quotes(_col(c).cast("string"))))
    return pad_code(cleaned)


def is_unit_code(c: Column | str) -> Column:
    return _col(c).rlike(UNIT_CODE)


def code_in_range(c: Column | str, low: int, high: int) -> Column:
    """True for an all-digit code whose number lies in the range."""
    c = _col(c)
    return c.rlike("^[0-9]+$") & c.try_cast("int").between(low, high)


def year_in_path(path: Column | str, pattern: str) -> Column:
    """Year from a file path by the first group of ``pattern``; NULL if it does not match."""
    return F.regexp_extract(_col(path), pattern, 1).try_cast("int")


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first last``; NULL if either part is missing."""
    return F.concat(_col(first), F.lit(" "), _col(last))


def panel_key(year: Column | str, unit: Column | str) -> Column:
    """``YYYY_UU``; NULL if either part is missing."""
    return F.concat(_col(year).cast("string"), F.lit("_"), _col(unit))


def panel_key_year(key: Column | str) -> Column:
    """Year of a ``YYYY_UU`` key; NULL when there is no underscore or no number before it."""
    key = _col(key)
    return F.when(
        F.contains(key, F.lit("_")), F.split_part(key, F.lit("_"), F.lit(1)).try_cast("int")
    )
