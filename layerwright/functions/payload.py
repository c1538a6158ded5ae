"""Reading JSON payload columns: one typed parse per row, then struct and array access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerwright.functions.columns import _col


def parse(payload: Column | str, schema: str) -> Column:
    """The payload as a struct. Fields absent or JSON null become NULL."""
    return F.from_json(_col(payload), schema)


def json_text(payload: Column | str, path: str) -> Column:
    """Text of one path, for a payload whose shape is not declared."""
    return F.get_json_object(_col(payload), path)


def raw_elements(payload: Column | str) -> Column:
    """A JSON array as an array of JSON texts, one per element."""
    return F.from_json(_col(payload), "array<string>")


def array_of(payload: Column | str, element: str) -> Column:
    """A JSON array as an array of structs, ``element`` giving the struct's fields."""
    return F.from_json(_col(payload), f"array<struct<{element}>>")


def payload_subset(payload: Column | str, schema: str) -> Column:
    """JSON text holding only the fields named in ``schema``."""
    return F.to_json(F.from_json(_col(payload), schema))


def matching(entries: Column | str, path: str, value: str) -> Column:
    """Elements of an array of structs whose (nested) field equals ``value``, in order."""

    def is_match(entry: Column) -> Column:
        field = entry
        for name in path.split("."):
            field = field[name]
        return field == value

    return F.filter(_col(entries), is_match)


def last_match(entries: Column | str, path: str, value: str) -> Column:
    """Last matching element, NULL when none matches. No explode and no shuffle."""
    return F.try_element_at(matching(entries, path, value), F.lit(-1))


def first_match(entries: Column | str, path: str, value: str) -> Column:
    """First matching element, NULL when none matches."""
    return F.try_element_at(matching(entries, path, value), F.lit(1))
