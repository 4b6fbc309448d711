"""Expressions over JSON payloads that hold arrays of ``[epoch_ms, value]`` points.

A payload looks like ``{"prices": [[1704067200000, 42000.0], ...], ...}``. It is untyped text, so
elements of any shape have to be expected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_arrays(payload: Column, names: Sequence[str]) -> Column:
    """A struct with one array of JSON text per name.

    A missing field, a JSON null, a value that is no array and malformed text all give null.
    """
    return F.from_json(payload, ", ".join(f"`{name}` array<string>" for name in names))


def nested_arrays(payload: Column, texts: Sequence[str], numbers: Sequence[str]) -> Column:
    """A struct with the points of each array, read in one JSON pass.

    The arrays in ``texts`` keep the text of both entries, which the timestamps need: only text
    tells ``1704067200000`` from ``1704067200000.0``. Those in ``numbers`` become doubles right
    away, which takes less than half the time. One element of another shape makes its whole array
    null; ``text_points`` and ``number_points`` cover those.
    """
    fields = [f"`{name}` array<array<string>>" for name in texts]
    fields += [f"`{name}` array<array<double>>" for name in numbers]
    return F.from_json(payload, ", ".join(fields))


def text_points(nested: Column, payload: Column, name: str) -> Column:
    """Array ``name`` with each point as an array of scalar text.

    Uses the one-pass result where there is one. Otherwise each element is parsed by itself, so
    that an odd element (``5``, ``{"a": 1}``) becomes null and its neighbours stay.
    """
    return F.coalesce(nested[name], F.transform(json_arrays(payload, [name])[name], _point))


def number_points(nested: Column, payload: Column, name: str, raise_bad: bool = True) -> Column:
    """Array ``name`` with each point as an array of doubles; the first entry has no meaning."""

    def parsed(element: Column) -> Column:
        value = checked_double(_point(element), raise_bad)
        return F.array(F.lit(None).cast("double"), value)

    return F.coalesce(nested[name], F.transform(json_arrays(payload, [name])[name], parsed))


def _point(element: Column) -> Column:
    return F.from_json(element, "array<string>")


def _unconvertible(text: Column, dtype: str) -> Column:
    # Nested arrays and objects are no scalars: they read as null like a JSON null does.
    nested = text.startswith("[") | text.startswith("{")
    return text.isNotNull() & ~nested & text.try_cast(dtype).isNull()


def _checked(text: Column, dtype: str, what: str, raise_bad: bool) -> Column:
    value = text.try_cast(dtype)
    if not raise_bad:
        return value
    # Stops the job whatever the session's ANSI setting is.
    error = F.raise_error(F.concat(F.lit(f"not a valid {what}: "), text))
    return F.when(_unconvertible(text, dtype), error).otherwise(value)


def checked_millis(point: Column, raise_bad: bool = True) -> Column:
    """First entry of a point as a timestamp."""
    text = F.get(point, F.lit(0))
    return F.timestamp_millis(_checked(text, "bigint", "epoch millisecond", raise_bad))


def checked_double(point: Column, raise_bad: bool = True) -> Column:
    """Second entry of a point as a double."""
    return _checked(F.get(point, F.lit(1)), "double", "number", raise_bad)


def bad_millis(point: Column) -> Column:
    return F.coalesce(_unconvertible(F.get(point, F.lit(0)), "bigint"), F.lit(False))


def bad_double(point: Column) -> Column:
    return F.coalesce(_unconvertible(F.get(point, F.lit(1)), "double"), F.lit(False))


def points_json(points: Column, millis: str, value: str) -> Column:
    """Array of structs -> JSON text of ``[epoch_ms, value]`` points. Null values become ``null``.

    Written from text because an ``array<double>`` would print the milliseconds as ``1.7E12``.
    """

    def point(p: Column) -> Column:
        number = F.coalesce(p[value].cast("string"), F.lit("null"))
        return F.concat(F.lit("["), p[millis].cast("string"), F.lit(", "), number, F.lit("]"))

    return F.concat(F.lit("["), F.array_join(F.transform(points, point), ", "), F.lit("]"))
