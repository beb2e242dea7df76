"""Scalar column functions (all built-in expressions, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def numbered_name(pattern: str, *numbers: Column) -> Column:
    """Fill a ``%d`` / ``%03d`` file-name pattern."""
    return F.format_string(pattern, *numbers)


def epoch_of(path: Column, artifact: str = "weights") -> Column:
    """Epoch number in ``<artifact>.<N>.pkl``; NULL for any other file name."""
    number = F.regexp_extract(base_name(path), rf"^{artifact}\.(\d+)\.pkl$", 1)
    return number.try_cast("int")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dir_name(path: Column) -> Column:
    """Everything before the last slash; empty without a slash."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def extension(path: Column) -> Column:
    """Last suffix with its dot; empty for none and for dot files."""
    return F.regexp_extract(base_name(path), r"^.+(\.[^.]*)$", 1)


def relative_path(path: Column, root: Column) -> Column:
    """``path`` below the folder ``root``; other paths are returned unchanged."""
    prefix = F.concat(F.regexp_replace(root, "/+$", ""), F.lit("/"))
    return F.when(F.startswith(path, prefix), F.substr(path, F.length(prefix) + 1)).otherwise(path)


def enum_label(code: Column, labels: dict[int, str]) -> Column:
    """Text of a coded choice; NULL for an unknown code."""
    pairs = [F.lit(item) for entry in labels.items() for item in entry]
    return F.try_element_at(F.create_map(*pairs), code)


def quotient(a: Column, b: Column) -> Column:
    """Floor quotient, so that ``quotient * b + remainder = a``."""
    return ((a - F.pmod(a, b)) / b).cast("bigint")


def remainder(a: Column, b: Column) -> Column:
    return F.pmod(a, b)


def is_multiple(value: Column, of: int) -> Column:
    return F.pmod(value, F.lit(of)) == 0


def is_even(value: Column) -> Column:
    return is_multiple(value, 2)


def int_range(n: Column) -> Column:
    """``0 .. n-1``; empty for ``n <= 0``."""
    return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1)).otherwise(
        F.array().cast("array<bigint>")
    )


def constant_fill(value: Column, n: Column) -> Column:
    return F.array_repeat(value, n.cast("int"))


def concat_arrays(arrays: Column) -> Column:
    return F.flatten(arrays)


def as_vector(value: Column) -> Column:
    """A one-element vector from a number."""
    return F.array(value.cast("double"))


def vector_to_csv(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda x: x.cast("string")), ",")


def csv_to_vector(text: Column) -> Column:
    return F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("double"))


def clamp(value: Column, top: int) -> Column:
    return F.least(value, F.lit(top))


def optional_value(flag: Column, value: Column) -> Column:
    """``value`` when the flag is set, else NULL."""
    return F.when(flag, value)


def member_of(value: Column, values: list) -> Column:
    """Membership in a short literal list; for data use a semi join."""
    return value.isin(*values) if values else F.lit(False)
