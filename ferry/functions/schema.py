"""Schema operators (H1–H3): mapping ↔ schema, inference and field profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Mapping field types and the Spark type each one reads as.
MAPPING_TYPES = {
    "keyword": T.StringType(),
    "text": T.StringType(),
    "long": T.LongType(),
    "integer": T.IntegerType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "date": T.TimestampType(),
}

_REVERSE = [
    (T.StringType, "keyword"), (T.LongType, "long"), (T.IntegerType, "integer"),
    (T.ShortType, "short"), (T.ByteType, "byte"), (T.DoubleType, "double"),
    (T.FloatType, "float"), (T.BooleanType, "boolean"), (T.TimestampType, "date"),
    (T.TimestampNTZType, "date"), (T.DateType, "date"),
]


def _properties(mapping: dict) -> dict:
    """Accept ``{properties}``, ``{mappings:{properties}}`` or ``{index:{mappings:…}}``."""
    if "properties" in mapping:
        return mapping["properties"]
    if "mappings" in mapping:
        return _properties(mapping["mappings"])
    if len(mapping) == 1:
        (only,) = mapping.values()
        if isinstance(only, dict):
            return _properties(only)
    raise ValueError("mapping has no 'properties'")


def mapping_to_schema(mapping: dict) -> T.StructType:
    """H2: recursive ``properties`` → ``StructType``; unknown types read as VARIANT."""
    fields = []
    for name, spec in _properties(mapping).items():
        if "properties" in spec:
            dtype = mapping_to_schema(spec)
        else:
            dtype = MAPPING_TYPES.get(spec.get("type", "object"), T.VariantType())
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def schema_to_mapping(schema: T.StructType) -> dict:
    """The inverse, for writing a collection's mapping next to its data."""
    props = {}
    for f in schema.fields:
        dt = f.dataType
        if isinstance(dt, T.ArrayType):
            dt = dt.elementType  # search mappings have no array type
        if isinstance(dt, T.StructType):
            props[f.name] = schema_to_mapping(dt)["mappings"]
            continue
        kind = next((k for cls, k in _REVERSE if isinstance(dt, cls)), "object")
        props[f.name] = {"type": kind}
    return {"mappings": {"properties": props}}


def infer_schema(docs: DataFrame, col: str = "doc") -> DataFrame:
    """H3: one-row frame with the merged schema of all documents (distributed agg)."""
    return docs.agg(F.schema_of_variant_agg(F.col(col)).alias("schema"))


def shape_profile(docs: DataFrame, col: str = "doc") -> DataFrame:
    """H3: document count per distinct document shape (partial aggregation)."""
    return (docs.groupBy(F.schema_of_variant(F.col(col)).alias("shape"))
            .agg(F.count(F.lit(1)).alias("docs")))


def field_profile(flat: DataFrame) -> DataFrame:
    """H1: ``(path, type, docs)`` over flattened ``(doc key, path, value VARIANT)`` rows.

    Mixed types show as several rows for one path; a JSON null is ``VOID``.
    """
    return (flat.groupBy("path", F.schema_of_variant("value").alias("type"))
            .agg(F.count(F.lit(1)).alias("docs")))


#: Kinds of a typed value as bits; a path's bits are combined by a bitwise or.
_KINDS = (("BOOLEAN", 1), ("BIGINT", 2), ("DECIMAL", 4), ("DOUBLE", 8), ("FLOAT", 8), ("DATE", 16), ("TIMESTAMP_NTZ", 32),
          ("TIMESTAMP", 64), ("STRING", 128), ("BINARY", 256), ("UUID", 512))


def merged_schema(flat: DataFrame, key: str) -> DataFrame:
    """H3 typed: ``(path, type, docs, nulls)`` over flattened ``(key, path, value VARIANT)`` rows.

    List positions fold into ``[]``. ``type`` is the narrowest type that holds all values of the path: BIGINT, then DECIMAL
    wide enough for the integer digits and the scale seen, then DOUBLE; DATE, then TIMESTAMP_NTZ, then TIMESTAMP; STRING for
    any other mixture of scalars; VOID if all are null. ``docs``: documents that have the path, ``nulls``: values that are null.
    The merge is an associative aggregate of a few integers (kinds seen as bits, digits, scale), first per document, then per
    path, both combined where they are read.
    """
    shape = F.schema_of_variant("value")
    path = F.regexp_replace("path", r"\[[0-9]+\]", "[]")
    bits = F.lit(0)
    for name, bit in reversed(_KINDS):
        bits = F.when(shape.startswith(name), F.lit(bit)).otherwise(bits)
    digits = F.regexp_extract(shape, r"^DECIMAL\((\d+),", 1).try_cast("int")
    scale = F.regexp_extract(shape, r",\s*(\d+)\)$", 1).try_cast("int")
    whole = F.when(shape == "BIGINT", F.lit(19)).otherwise(digits - scale)
    rows = flat.select(F.col(key).alias("k"), path.alias("path"), bits.alias("bits"), whole.alias("whole"), scale.alias("scale"),
                       (shape == "VOID").cast("long").alias("void"))
    merged = [F.bit_or("bits").alias("bits"), F.max("whole").alias("whole"), F.max("scale").alias("scale")]
    docs = rows.groupBy("k", "path").agg(*merged, F.sum("void").alias("void"))
    paths = docs.groupBy("path").agg(*merged, F.count(F.lit(1)).alias("docs"), F.sum("void").alias("nulls"))
    seen = F.col("bits")

    def only(*kinds):
        mask = sum({bit for name, bit in _KINDS if name in kinds})
        return seen.bitwiseAND(F.lit(~mask)) == 0

    wide = F.least(F.col("whole") + F.col("scale"), F.lit(38))
    kind = (F.when(seen == 0, "VOID").when(only("BOOLEAN"), "BOOLEAN").when(only("BIGINT"), "BIGINT")
            .when(only("BIGINT", "DECIMAL"), F.format_string("DECIMAL(%d,%d)", wide, F.col("scale")))
            .when(only("BIGINT", "DECIMAL", "DOUBLE"), "DOUBLE").when(only("DATE"), "DATE").when(only("DATE", "TIMESTAMP_NTZ"), "TIMESTAMP_NTZ")
            .when(only("DATE", "TIMESTAMP_NTZ", "TIMESTAMP"), "TIMESTAMP").when(only("BINARY"), "BINARY").when(only("UUID"), "UUID").otherwise("STRING"))
    return paths.select("path", kind.alias("type"), "docs", "nulls")
