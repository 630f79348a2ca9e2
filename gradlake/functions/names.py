"""What the name of a data or run file says: stem, parameter setting and code path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_stem(path: Column) -> Column:
    """Drop the directories and the last suffix."""
    return F.regexp_replace(F.regexp_replace(path, "^.*/", ""), r"\.[^.]*$", "")


def run_parameter(path: Column) -> Column:
    """The number that is the second-to-last ``-`` piece of ``<name>-<parameter>-<path>.json``."""
    return F.element_at(F.split(path, "-"), -2).cast("bigint")


def run_codepath(path: Column) -> Column:
    """The last ``-`` piece of the stem of ``<name>-<parameter>-<path>.json``."""
    return F.element_at(F.split(file_stem(path), "-"), -1)


def numeric_suffix(name: Column) -> Column:
    """The last run of digits in a name, as a number (null when there is none)."""
    digits = F.regexp_extract(name, r"([0-9]+)[^0-9]*$", 1)
    return F.when(digits != "", digits.cast("bigint"))


def natural_key(name: Column) -> Column:
    """Pieces of a name whose text order is its natural order: each number is led by its length."""

    def piece(p: Column) -> Column:
        digits = F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.when(p.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 6, "0"), digits)).otherwise(p)

    return F.transform(F.regexp_extract_all(name, F.lit("([0-9]+|[^0-9]+)"), F.lit(1)), piece)
