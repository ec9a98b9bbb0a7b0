"""Values out of ``array<struct<key, value: struct<string_value, int_value>>>``.

``param`` and ``prop`` use the parallel arrays ``a.key`` and ``a.value.<slot>``
instead of a lambda: that keeps them inside whole-stage codegen, and lets the
Parquet scan leave out the slot nobody asked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = {"string": "string_value", "int": "int_value"}


def _column(array: Column | str) -> Column:
    return F.col(array) if isinstance(array, str) else array


def param(array: Column | str, key: str, kind: str = "string", strict: bool = False) -> Column:
    """Value of ``key``, NULL if the key is missing.

    Of several entries with this key the first counts; with ``strict`` they are an error.
    """
    entries = _column(array)
    keys, values = entries["key"], entries["value"][SLOTS[kind]]
    value = F.get(values, (F.array_position(keys, key) - 1).cast("int"))
    if not strict:
        return value
    occurrences = F.size(keys) - F.size(F.array_remove(keys, key))
    return F.when(
        occurrences > 1, F.raise_error(F.lit(f"key '{key}' occurs more than once"))
    ).otherwise(value)


def prop(key: str, strict: bool = False, array: Column | str = "user_properties") -> Column:
    """String value of a user property."""
    return param(array, key, "string", strict)


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns, each evaluated once per row.

    Catalyst moves a filter below the projection that makes its columns, and so evaluates
    every lookup anew for each mention, in predicates and in derived null checks alike.
    Rows that come out of ``inline`` of a one-row array are not taken apart that way, and
    they stay inside codegen.  Filters on the other columns still reach the scan.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def with_largest_params(
    df: DataFrame,
    integers: Mapping[str, str],
    strings: Mapping[str, str],
    array: str = "event_params",
) -> DataFrame:
    """``df`` with the largest value of each key as a column (output column -> key).

    Of an array that holds a key once, that entry counts; only an array that repeats one of the
    keys is sorted to find the largest.  Entries with another key count as '' for a string and
    as NULL for an integer, and so does an array without entries; NULL values do not count.
    """
    wanted = {"int": integers, "string": strings}
    slots = {kind: f"__{kind}s" for kind, columns in wanted.items() if columns}
    keys = F.col(array)["key"]
    df = evaluate_once(
        df,
        __keys=keys,
        __reversed=F.reverse(keys),
        **{column: F.col(array)["value"][SLOTS[kind]] for kind, column in slots.items()},
    )
    df = evaluate_once(
        df,
        **{
            f"{column}_ordered": _largest_first(F.col(column), wanted[kind].values())
            for kind, column in slots.items()
        },
    )
    values = {name: _first("__ints_ordered", key) for name, key in integers.items()}
    values |= {
        name: _first_or_default("__strings_ordered", key, "") for name, key in strings.items()
    }
    helpers = [c for column in slots.values() for c in (column, f"{column}_ordered")]
    return evaluate_once(df, **values).drop("__keys", "__reversed", *helpers)


def _largest_first(values: Column, wanted: Iterable[str]) -> Column:
    """Keys and values as parallel arrays in which the first entry of a wanted key is its
    largest.  A key is repeated if it is found in different places from the two ends."""
    keys, ends = F.col("__keys"), F.col("__reversed")
    repeats = F.lit(False)
    for key in wanted:
        first = F.array_position(keys, key)
        repeats |= (first > 0) & (first + F.array_position(ends, key) != F.size(keys) + 1)
    ordered = F.sort_array(F.arrays_zip(keys.alias("key"), values.alias("value")), asc=False)
    return F.when(
        repeats, F.struct(ordered["key"].alias("keys"), ordered["value"].alias("values"))
    ).otherwise(F.struct(keys.alias("keys"), values.alias("values")))


def _first(ordered: str, key: str) -> Column:
    entries = F.col(ordered)
    return F.get(entries["values"], (F.array_position(entries["keys"], key) - 1).cast("int"))


def _first_or_default(ordered: str, key: str, default: str) -> Column:
    keys = F.col(ordered)["keys"]
    only_key = (F.size(keys) > 0) & (F.size(F.array_remove(keys, key)) == 0)
    value = _first(ordered, key)
    return F.when(only_key, value).otherwise(F.greatest(value, F.lit(default)))
