"""Document envelope: ``_id``, ``_index``, ``_source``.

A collection row is packed as ``struct(_id STRING, _index STRING, _source
STRUCT|VARIANT)``. Packing and unpacking are pure projections, so Catalyst
collapses ``struct(...).field`` back to the scanned column and filters on
``_source.x`` still reach the Parquet scan.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dsl import quote

ENVELOPE_COLS = ("_id", "_index", "_source")


def is_envelope(df: DataFrame) -> bool:
    names = set(df.columns)
    return {"_id", "_source"} <= names


def pack(df: DataFrame, index: str, id_col: str | Column | None = None) -> DataFrame:
    """B1: wrap every row as ``{_id, _index, _source}``.

    ``id_col`` is the document id (cast to string); the id column stays in
    ``_source`` as well, like a stored field. Without one the id is derived
    from the content (``sha2`` of the canonical JSON), stable across retries.
    """
    cols = [F.col(quote(c)) for c in df.columns]
    source = F.struct(*cols)
    if id_col is None:
        doc_id = F.sha2(F.to_json(F.to_variant_object(source)), 256)
    elif isinstance(id_col, str):
        doc_id = F.col(quote(id_col)).cast("string")
    else:
        doc_id = id_col.cast("string")
    return df.select(doc_id.alias("_id"), F.lit(index).alias("_index"), source.alias("_source"))


def unpack(df: DataFrame, keep_id: bool = True, fields: Iterable[str] | None = None) -> DataFrame:
    """B2: the content keyed by id: ``_id`` plus the fields of ``_source``.

    Of untyped documents every field becomes a VARIANT column, null where a document lacks it. Their names are ``fields``, or
    those that the documents have (one aggregate over the top-level keys, in order of the names).
    """
    src_type, ident = df.schema["_source"].dataType, [F.col("_id")] if keep_id else []
    if isinstance(src_type, T.VariantType):
        if fields is None:
            keys = F.map_keys(F.try_variant_get("_source", "$", "map<string,variant>"))
            fields = sorted(r["k"] for r in df.select(F.explode(keys).alias("k")).distinct().collect())
        chosen = [f for f in fields if not (keep_id and f == "_id")]
        return df.select(*ident, *[F.try_variant_get("_source", f"$[{json.dumps(f)}]", "variant").alias(f) for f in chosen])
    if not isinstance(src_type, T.StructType):
        raise TypeError("_source is neither a struct nor a VARIANT")
    names = [f.name for f in src_type.fields if not (keep_id and f.name == "_id")]
    if fields is not None:
        names = [n for n in fields if n in names]
    return df.select(*ident, *[F.col("_source").getField(n).alias(n) for n in names])


def split_fields(spec: str | Iterable[str] | None) -> list[str]:
    """``"a,b,,c"`` → ``["a","b","c"]`` (empty names dropped)."""
    if spec is None:
        return []
    items = spec.split(",") if isinstance(spec, str) else list(spec)
    return [s.strip() for s in items if s and s.strip()]


def _pick(base: Column, dtype: T.DataType, tree: dict) -> Column | None:
    """Rebuild ``base`` keeping only the branches named in ``tree``."""
    if tree is None:  # whole sub-tree requested
        return base
    if isinstance(dtype, T.StructType):
        parts = []
        for f in dtype.fields:
            if f.name in tree:
                sub = _pick(base.getField(f.name), f.dataType, tree[f.name])
                if sub is not None:
                    parts.append(sub.alias(f.name))
        if not parts:
            return None
        return F.when(base.isNull(), F.lit(None)).otherwise(F.struct(*parts))
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        elem = dtype.elementType
        probe = _pick(F.col("x"), elem, tree)  # noqa: F841 - validates the tree
        return F.transform(base, lambda x: _pick(x, elem, tree))
    return None  # a scalar cannot have named children


def _pick_untyped(v: Column, tree: dict | None) -> Column:
    """Rebuild the VARIANT ``v`` with the branches named in ``tree`` only; SQL null where none is there."""
    if tree is None:
        return v

    def branches(x: Column) -> Column:
        found = F.array(*[F.struct(F.lit(name).alias("k"),
                                   _pick_untyped(F.try_variant_get(x, f"$[{json.dumps(name, ensure_ascii=False)}]",
                                                                   "variant"), sub).alias("v"))
                          for name, sub in tree.items()])
        found = F.filter(found, lambda e: e["v"].isNotNull())
        return F.when(F.size(found) > 0, F.to_variant_object(F.map_from_entries(found)))

    kept = F.filter(F.transform(F.try_variant_get(v, "$", "array<variant>"), branches), lambda e: e.isNotNull())
    shape = F.schema_of_variant(v)
    return (F.when(shape.startswith("OBJECT"), branches(v))
            .when(shape.startswith("ARRAY") & (F.size(kept) > 0), F.to_variant_object(kept)))


def _path_tree(fields: list[str]) -> dict:
    tree: dict = {}
    for path in fields:
        node = tree
        parts = path.split(".")
        for i, p in enumerate(parts):
            last = i == len(parts) - 1
            if last:
                node[p] = None
            else:
                if node.get(p, {}) is None:
                    break  # already whole
                node = node.setdefault(p, {})
    return tree


def include_fields(df: DataFrame, fields: str | Iterable[str] | None) -> DataFrame:
    """Keep only the listed (dotted) source fields; ``_id``/``_index`` stay.

    Works on enveloped frames (restricts ``_source``) and on flat frames.
    Unknown names are omitted without error. An empty list keeps everything.
    Untyped (VARIANT) sources keep their nesting: objects without a listed
    branch are left out, lists of objects keep the listed branches of each.
    """
    names = split_fields(fields)
    if not names:
        return df
    tree = _path_tree(names)
    if is_envelope(df):
        src_type = df.schema["_source"].dataType
        if isinstance(src_type, T.VariantType):
            source = F.coalesce(_pick_untyped(F.col("_source"), tree), F.parse_json(F.lit("{}")))
        else:
            picked = _pick(F.col("_source"), src_type, tree)
            source = picked if picked is not None else F.struct()
        others = [F.col(c) for c in df.columns if c != "_source"]
        return df.select(*others, source.alias("_source"))
    out = []
    for f in df.schema.fields:
        if f.name in tree:
            sub = _pick(F.col(quote(f.name)), f.dataType, tree[f.name])
            if sub is not None:
                out.append(sub.alias(f.name))
    return df.select(*out)
