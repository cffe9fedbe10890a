"""Schema drift of raw documents: fields nobody declared, and declared ones of another type than declared.

Documents are looked at as variants, so what arrives need not fit any schema. Paths are those of an object and of the
objects inside it; what is inside arrays is reported under the array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.schemas import DOCUMENTS, ENTITIES

# The types of JSON values that a declared type can be read from without loss.
_FITS = {"string": ("STRING",), "boolean": ("BOOLEAN",), "bigint": ("BIGINT",), "double": ("DOUBLE", "DECIMAL", "BIGINT"),
         "array": ("ARRAY",), "struct": ("OBJECT",)}


def declared_paths(schema: str, prefix: str = "") -> dict[str, str]:
    """Declared paths of a document schema with their kinds; objects are listed with what they hold."""
    out = {}
    for f in T._parse_datatype_string(schema) if isinstance(schema, str) else schema:
        path = f"{prefix}{f.name}"
        out[path] = f.dataType.typeName() if f.dataType.typeName() in ("array", "struct") else f.dataType.simpleString()
        if isinstance(f.dataType, T.StructType):
            out |= declared_paths(f.dataType, f"{path}.")
    return out


def _kind(value: Column) -> Column:
    """The type of a variant, without the details of what it holds."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def shapes(raw: DataFrame) -> DataFrame:
    """(source, documents, raw_json): how many readable documents of a topic have the same shape, and one of them.

    Every document is parsed once, here; paths are then listed for one document of each shape.
    """
    shape = F.schema_of_variant(F.try_parse_json("raw_json"))
    return raw.select("source", "raw_json", shape.alias("shape")).where(F.col("shape").startswith("OBJECT")).groupBy(
        "source", "shape").agg(F.count("*").alias("documents"), F.min("raw_json").alias("raw_json")).drop("shape")


def found_paths(shaped: DataFrame, entity: str, depth: int = 3) -> DataFrame:
    """(path, kind, documents) of every field of the shapes of an entity, objects opened up to ``depth`` levels."""
    whole = F.try_parse_json("raw_json")
    level = shaped.where(F.col("source") == entity).select(F.lit("").alias("prefix"), whole.alias("value"), "documents")
    parts = None
    for _ in range(depth):
        names = F.json_object_keys(F.to_json("value"))
        fields = level.select("prefix", "value", "documents", F.explode(names).alias("name"))
        # A name with quotes in it cannot be put into a path; it is reported as it is, without a type.
        step = F.when(~F.contains("name", F.lit("'")), F.concat(F.lit("$['"), F.col("name"), F.lit("']")))
        opened = fields.select(F.concat("prefix", "name").alias("path"), F.try_variant_get("value", step, "variant").alias("value"), "documents")
        here = opened.select("path", _kind(F.col("value")).alias("kind"), "documents")
        parts = here if parts is None else parts.unionByName(here)
        level = opened.where(F.schema_of_variant("value").startswith("OBJECT")).select(
            F.concat("path", F.lit(".")).alias("prefix"), "value", "documents")
    return parts


def drift_report(shaped: DataFrame, entities: Sequence[str] = ENTITIES) -> DataFrame:
    """(entity, path, problem, kind, documents): undeclared paths, and declared ones of a type they cannot be read from.

    ``shaped`` is the result of :func:`shapes`; store it first where documents are many, as it is looked at once per level.
    Paths below an undeclared object are not listed one by one. NULL values fit everything.
    """
    out = None
    for entity in entities:
        declared = declared_paths(DOCUMENTS[entity])
        known = F.create_map(*[F.lit(v) for pair in declared.items() for v in pair])
        fits = F.create_map(*[v for k, kinds in _FITS.items() for v in (F.lit(k), F.array(*map(F.lit, kinds)))])
        above = F.regexp_extract("path", r"^(.*)\.[^.]*$", 1)
        inside = (above == "") | (F.try_element_at(known, above) == "struct")
        kind, wanted = F.col("kind"), F.try_element_at(known, F.col("path"))
        problem = F.when(wanted.isNull(), "undeclared").when(
            (kind != "VOID") & ~F.array_contains(F.try_element_at(fits, wanted), kind), "retyped")
        one = found_paths(shaped, entity).where(inside).withColumn("problem", problem).where("problem IS NOT NULL").groupBy(
            F.lit(entity).alias("entity"), "path", "problem", "kind").agg(F.sum("documents").alias("documents"))
        out = one if out is None else out.unionByName(one)
    return out


def whole_schema(raw: DataFrame) -> DataFrame:
    """(source, shape): the type that all readable documents of a topic have in common, merged by Spark."""
    variant = F.try_parse_json("raw_json")
    return raw.where(variant.isNotNull()).groupBy("source").agg(F.schema_of_variant_agg(variant).alias("shape"))


def redrive(quarantined: DataFrame, mend) -> tuple[DataFrame, DataFrame]:
    """(messages, rest): quarantined rows that ``mend(text)``, a function of columns, makes readable, ready to be published to
    their topics again, and the rows it does not, with their text as it was."""
    mended = quarantined.withColumn("mended", mend(F.col("raw_json")))
    good = F.coalesce(F.col("source").isin(*ENTITIES) & F.json_object_keys("mended").isNotNull(), F.lit(False))
    messages = mended.where(good).select(F.col("source").alias("topic"), F.col("mended").alias("value"))
    return messages, mended.where(~good).drop("mended")
