"""Expressions over JSON held in VARIANT columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def member(doc: Column, key: str) -> Column:
    """The member of an object as VARIANT; NULL when there is none."""
    quoted = key.replace("\\", "\\\\").replace('"', '\\"')
    return F.try_variant_get(doc, f'$["{quoted}"]', "variant")


def contains(doc: Column, literal) -> Column:
    """``doc @> literal`` for a literal made of dicts, lists and scalars.

    Every member of a literal object must be contained in the member of the same name;
    every element of a literal list must be contained in some element of the array.
    Types count: the number 1 is not the text "1".
    """
    kind = F.schema_of_variant(doc)
    if isinstance(literal, dict):
        test = kind.startswith("OBJECT")
        for key, value in literal.items():
            test = test & contains(member(doc, key), value)
    elif isinstance(literal, (list, tuple)):
        test = kind.startswith("ARRAY")
        elements = F.try_variant_get(doc, "$", "array<variant>")
        for value in literal:
            test = test & F.coalesce(_some_contains(elements, value), F.lit(False))
    elif literal is None:
        test = F.is_variant_null(doc)
    elif isinstance(literal, bool):
        test = (kind == "BOOLEAN") & (F.try_variant_get(doc, "$", "boolean") == F.lit(literal))
    elif isinstance(literal, (int, float, Decimal)):
        number = kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
        test = number & (F.try_variant_get(doc, "$", "decimal(38,10)") == F.lit(Decimal(str(literal))))
    else:
        test = (kind == "STRING") & (F.try_variant_get(doc, "$", "string") == F.lit(str(literal)))
    return F.coalesce(test, F.lit(False))


def _some_contains(elements: Column, literal) -> Column:
    return F.exists(elements, lambda element: contains(element, literal))


def has_key(json: Column | str, key: str) -> Column:
    """Top-level key test on JSON text; NULL when the text is not an object."""
    return F.array_contains(F.json_object_keys(json), key)


def has_any_key(json: Column | str, keys: list[str]) -> Column:
    return F.arrays_overlap(F.json_object_keys(json), F.array(*[F.lit(k) for k in keys]))


def has_all_keys(json: Column | str, keys: list[str]) -> Column:
    wanted = F.array(*[F.lit(k) for k in dict.fromkeys(keys)])
    return F.size(F.array_intersect(F.json_object_keys(json), wanted)) == F.size(wanted)
