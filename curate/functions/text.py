"""Column functions that turn untrusted text into typed values.

Each takes and returns a ``Column``. Text that does not parse gives null,
never an error, whatever ``spark.sql.ansi.enabled`` says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A refused cast costs far more than a pattern: it raises and catches inside the
# task. So text that cannot be a number is turned away before the cast.
_NUMBER = r"^[\x00-\x20]*[+-]?0*[0-9]{1,10}(?:\.[0-9]*)?[\x00-\x20]*$"
_FRACTION = r"^[\x00-\x20]*[+-]?\.[0-9]*[\x00-\x20]*$"


def to_int(text: Column) -> Column:
    """Text to ``int``, dropping any fraction: ``85.5`` gives 85.

    Exponents, separators and values that do not fit give null.
    """
    whole = F.substring_index(text, ".", 1).try_cast("int")
    return F.when(text.rlike(_NUMBER), whole).when(text.rlike(_FRACTION), F.lit(0))


def to_decimal(text: Column, precision: int = 3, scale: int = 1) -> Column:
    """Text to ``decimal(precision, scale)``, half up; too large gives null."""
    return F.when(text.rlike("[0-9]"), text.try_cast(f"decimal({precision},{scale})"))


def to_double(text: Column) -> Column:
    """Text to ``double``, ``NaN`` and infinity included."""
    return F.when(text.rlike("(?i)[0-9]|nan|inf"), text.try_cast("double"))


def to_float(number: Column) -> Column:
    return number.try_cast("float")


def to_date_strict(text: Column, pattern: str = "dd MMM yyyy") -> Column:
    """Text to ``date`` when it has exactly the given pattern, else null."""
    return F.when(text.rlike("[0-9]"), F.try_to_date(text, pattern))


def to_iso_date(value: Column) -> Column:
    """A date, or ISO text, to ``date``."""
    return value.try_cast("date")


def parse_unit(text: Column, unit: str) -> Column:
    """``121 min`` with unit `` min`` gives 121; ``93%`` with ``%`` gives 93."""
    return to_int(F.replace(text, F.lit(unit), F.lit("")))


def parse_grouped_int(text: Column) -> Column:
    """``1,234,567`` gives 1234567."""
    return to_int(F.replace(text, F.lit(","), F.lit("")))


def parse_money(text: Column, sign: str = "$") -> Column:
    """``$460,998,507`` gives 460998507."""
    return parse_grouped_int(F.replace(text, F.lit(sign), F.lit("")))


def score_text(text: Column) -> Column:
    """The part before the slash: ``8.1/10`` gives the text ``8.1``."""
    return F.substring_index(text, "/", 1)


def parse_score(text: Column, precision: int = 3, scale: int = 1) -> Column:
    """The part before the slash as a decimal: ``74/100`` gives 74.0."""
    return to_decimal(score_text(text), precision, scale)


def strip_list_markup(text: Column) -> Column:
    """``['A', 'B']`` gives ``A, B``."""
    return F.translate(text, "[]'", "")


def split_list(text: Column) -> Column:
    """``['A', 'B']`` gives the array ``A``, ``B`` without empty entries."""
    parts = F.transform(F.split(strip_list_markup(text), ","), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def ms_to_minutes(ms: Column) -> Column:
    return ms / F.lit(60000.0)


def launch_year(text: Column) -> Column:
    """First year of a year or a year range: ``1999–2003`` gives 1999."""
    return F.regexp_extract(text, r"^\s*([0-9]{4})", 1).try_cast("int")
