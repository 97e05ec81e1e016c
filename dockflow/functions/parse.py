"""Text to numbers and names, as native column expressions (PF-09..11, SC-01)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"([0-9]+(?:\.[0-9]+)?)"


def parse_amount(c: Column) -> Column:
    """Amount texts: ``...none`` is 0, ``a~b`` the middle, ``under a`` half of a, ``a or more`` a, a number with a unit itself;
    anything else is NULL."""
    t = F.trim(c)
    a = F.try_to_number(F.regexp_extract(t, _NUMBER, 1), F.lit("999999999D999999")).cast("double")
    low = F.regexp_extract(t, rf"^{_NUMBER}[a-z]*~{_NUMBER}[a-z]*$", 1).try_cast("double")
    high = F.regexp_extract(t, rf"^{_NUMBER}[a-z]*~{_NUMBER}[a-z]*$", 2).try_cast("double")
    return (
        F.when(t.endswith("none"), F.lit(0.0))
        .when(t.rlike(rf"^{_NUMBER}[a-z]*~{_NUMBER}[a-z]*$"), (low + high) / 2)
        .when(t.rlike(rf"^under {_NUMBER}[a-z]*$"), a / 2)
        .when(t.rlike(rf"^{_NUMBER}[a-z]* or more$"), a)
        .when(t.rlike(rf"^{_NUMBER}[a-z]*$"), a)
    )


def parse_number(c: Column) -> Column:
    """A number with an optional sign and unit; anything else is NULL."""
    return F.nullif(F.regexp_extract(F.trim(c), r"^([+-]?[0-9]+(?:\.[0-9]+)?)[a-z%/]*$", 1), F.lit("")).try_cast("double")


def split_station_name(c: Column) -> tuple[Column, Column]:
    """``102. name`` to (102, name); without a number (NULL, trimmed name); an empty name is NULL."""
    number = F.nullif(F.regexp_extract(F.trim(c), r"^([0-9]+)\.\s*", 1), F.lit("")).try_cast("int")
    return number, F.nullif(F.trim(F.regexp_replace(F.trim(c), r"^[0-9]+\.\s*", "")), F.lit(""))


def month_of_file(c: Column) -> Column:
    """``..._YYMM.csv`` to ``20YY-MM``; NULL where the month isn't 1 to 12 (SR-04)."""
    yy, mm = F.regexp_extract(c, r"_([0-9]{2})([0-9]{2})\.csv$", 1), F.regexp_extract(c, r"_([0-9]{2})([0-9]{2})\.csv$", 2)
    return F.when(mm.try_cast("int").between(1, 12), F.concat(F.lit("20"), yy, F.lit("-"), mm))
