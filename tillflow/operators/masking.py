"""Personal data in documents: replace e-mail and phone by pseudonyms, at any struct depth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.masking import mask_phone, mask_value

_MASKS = {"email": mask_value, "phone": mask_phone}

# Structs masked by default. Add "manager" to cover the people named in store documents too.
DEFAULT_STRUCTS = ("customer",)


def _masked(c: Column, field: str, key: str | bytes, missing: str) -> Column:
    hashed = _MASKS[field](c, key)
    return F.when(c.isNotNull(), hashed) if missing == "null" else hashed


def mask_fields(df: DataFrame, key: str | bytes, *, missing: str = "hash") -> DataFrame:
    """Swap top-level ``email`` and ``phone`` for ``email_masked`` and ``phone_masked``, if present.

    ``missing``: a NULL is hashed like empty text (``hash``), or stays NULL (``null``) so that
    records without contact data do not all share one value.
    """
    present = [f for f in _MASKS if f in df.columns]
    return df.withColumns({f"{f}_masked": _masked(F.col(f), f, key, missing) for f in present}).drop(*present) \
        if present else df


def mask_struct(df: DataFrame, column: str, key: str | bytes, *, missing: str = "hash") -> DataFrame:
    """The same inside a struct column; a NULL struct stays NULL."""
    if column not in df.columns or not isinstance(df.schema[column].dataType, T.StructType):
        return df
    present = [f for f in _MASKS if f in df.schema[column].dataType.names]
    if not present:
        return df
    masked = F.col(column)
    for f in present:
        masked = masked.withField(f"{f}_masked", _masked(F.col(column)[f], f, key, missing))
    return df.withColumn(column, masked.dropFields(*present))


def _mask_members(members: Column, key: str | bytes, missing: str) -> Column:
    """A map<string, variant> with contact fields swapped; a field that is absent stays absent."""
    rest, added = members, []
    for field in _MASKS:
        present = F.map_contains_key(members, field)
        value = _masked(F.variant_get(F.element_at(members, field), "$", "string"), field, key, missing)
        added.append(F.when(present, F.create_map(F.lit(f"{field}_masked"), value.cast("variant"))).otherwise(
            F.expr("CAST(map() AS map<string, variant>)")))
        # A masked field that came along is replaced where the field itself is there.
        rest = F.map_filter(rest, lambda k, _: ~((k == field) | (present & (k == f"{field}_masked"))))  # noqa: B023
    return F.map_concat(rest, *added)


def mask_text(body: Column, key: str | bytes, *, structs: Sequence[str] = DEFAULT_STRUCTS, missing: str = "hash"
              ) -> Column:
    """JSON text of an object with its contact fields masked at the top level and inside ``structs``.

    Everything else is passed on as it is, undeclared fields and scalar types included. A field that is absent
    gets no pseudonym; an explicit null is hashed like empty text, or stays null with ``missing="null"``.
    """
    members = _mask_members(F.from_json(body, "map<string, variant>"), key, missing)
    for name in structs:
        inner = F.try_variant_get(F.element_at(members, name), "$", "map<string, variant>")
        masked = F.create_map(F.lit(name), F.parse_json(F.to_json(_mask_members(inner, key, missing))))
        others = F.map_filter(members, lambda k, _: k != name)  # noqa: B023
        members = F.when(inner.isNotNull(), F.map_concat(others, masked)).otherwise(members)
    return F.to_json(members)


def mask_documents(df: DataFrame, key: str | bytes, *, structs: Sequence[str] = DEFAULT_STRUCTS,
                   missing: str = "hash") -> DataFrame:
    """Mask a document frame at the top level and inside the given structs."""
    df = mask_fields(df, key, missing=missing)
    for column in structs:
        df = mask_struct(df, column, key, missing=missing)
    return df
