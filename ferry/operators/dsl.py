"""Query DSL → Spark ``Column``.

A query is one JSON object built from the clauses ``bool`` (``must``, ``filter``,
``must_not``, ``should``, ``minimum_should_match``), ``term``, ``terms``, ``range``,
``match`` (with ``operator``), ``match_phrase``, ``prefix``, ``wildcard``,
``exists``, ``ids`` and ``match_all``.
It compiles into a single boolean ``Column`` so Catalyst sees one filter it
can simplify and push into the scan.

Truth rules
-----------
* A leaf over a missing or null field is *unknown* (SQL null). In positive
  positions (AND / OR) unknown drops the row, exactly as "does not match".
  Leaves are left un-coalesced there so plain comparisons still reach
  ``PushedFilters``.
* ``must_not`` coalesces its child to false *before* negating, so a document
  lacking the field is kept.
* ``should`` filters only when the bool has no ``must`` or ``filter``, or where
  ``minimum_should_match`` asks for it; otherwise it would only change ranking,
  which is not part of the result.
* An empty ``filter`` list and the short form ``{"wildcard": {field: text}}`` are refused.
* ``exists`` takes null, an empty list and a list of nulls as missing.
* Array fields match when any element matches (``term``, ``match``) or when one
  element satisfies all bounds (``range``).
* Literals are converted to the column type while the plan is built; a literal
  that cannot be converted is a ``QueryError`` then, not a runtime failure.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import clauses as C
from .clauses import RANGE_OPS, TOKEN_SPLIT, QueryError, match_tokens, parse_query, variant_type_for  # noqa: F401

Leaf = Callable[[Column, T.DataType], Column]


def compile_query(query, schema: T.StructType, root: str | None = None) -> Column | None:
    """Compile ``query`` against ``schema``. ``None`` means match everything.

    ``root`` names a struct / variant column whose fields the query addresses
    (``"_source"`` for enveloped documents); when None, fields are top-level
    columns, or fields of ``_source`` if the frame is an envelope.
    """
    q = parse_query(query)
    if not q:
        return None
    return compile_tree(C.clause(q), _Resolver(schema, root))


def apply_query(df: DataFrame, query, root: str | None = None) -> DataFrame:
    """Filter ``df`` by the DSL query."""
    cond = compile_query(query, df.schema, root)
    return df if cond is None else df.filter(cond)


# --------------------------------------------------------------------------
# clauses


def compile_tree(node: dict, r: "_Resolver") -> Column:
    """The predicate of a clause tree (see :mod:`.clauses`)."""
    return _COMPILERS[node["k"]](node, r)


def _bool(node, r) -> Column:
    parts = [compile_tree(c, r) for c in node["must"]]
    should, wanted = [compile_tree(c, r) for c in node["should"]], node["wanted"]
    nots = [compile_tree(c, r) for c in node["not"]]
    if wanted == 1:
        parts.append(reduce(lambda a, b: a | b, should))
    elif wanted > 1:
        parts.append(reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(False)).cast("int") for c in should]) >= wanted)
    parts += [~F.coalesce(c, F.lit(False)) for c in nots]
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def _term(node, r) -> Column:
    value, path = node["v"], node["path"]

    def leaf(c: Column, t: T.DataType) -> Column:
        if C.fraction_for_integer(value, t.simpleString()):
            return F.when(c.isNotNull(), F.lit(False))
        return c == literal_for(value, t, path)

    return r.on_field(node["f"], leaf, probe=value, eq_value=value, path=path)


def _range(node, r) -> Column:
    bounds, path = node["b"], node["path"]

    def leaf(c: Column, t: T.DataType) -> Column:
        conds = []
        for op, v in bounds.items():
            lit = literal_for(C.bound_for(v, t.simpleString(), op), t, f"{path}.{op}")
            conds.append({"gte": c >= lit, "gt": c > lit, "lte": c <= lit, "lt": c < lit}[op])
        return reduce(lambda a, b: a & b, conds)

    return r.on_field(node["f"], leaf, probe=next(iter(bounds.values())), path=path)


def _terms(node, r) -> Column:
    path = node["path"]
    groups: dict[str, list] = {}
    for v in node["vs"]:  # untyped fields are read by the type of what they are compared with
        groups.setdefault(variant_type_for(v), []).append(v)

    def leaf_of(group):
        def leaf(c: Column, t: T.DataType) -> Column:
            lits = [literal_for(v, t, path) for v in group if not C.fraction_for_integer(v, t.simpleString())]
            return c.isin(*lits) if lits else F.when(c.isNotNull(), F.lit(False))
        return leaf

    if not groups:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [r.on_field(node["f"], leaf_of(g), probe=g[0], path=path) for g in groups.values()])


def _exists(node, r) -> Column:
    return r.on_field(node["f"], lambda c, t: c.isNotNull(), probe=_PRESENT, path=node["path"])


def _ids(node, r) -> Column:
    if "_id" not in r.schema.fieldNames():
        return _missing()
    return F.col("_id").cast("string").isin(*node["vs"]) if node["vs"] else F.lit(False)


def _text(node, r) -> Column:
    """``prefix`` and ``wildcard`` on the whole value, ``match_phrase`` on consecutive tokens of it."""
    kind, spec, path = node["k"], node["v"], node["path"]

    def leaf(c: Column, t: T.DataType) -> Column:
        if not isinstance(t, T.StringType):
            raise QueryError(f"{path}: {kind} needs a text field, not {t.simpleString()}")
        if kind == "prefix":
            return c.startswith(spec)
        if kind == "wildcard":
            return c.like(C.like_pattern(spec))
        tokens = C.tokens_in_order(spec)
        return F.lower(c).rlike(C.phrase_pattern(tokens)) if tokens else F.lit(False)

    return r.on_field(node["f"], leaf, probe=spec, path=path)


def _match(node, r) -> Column:
    text, tokens, path = node["v"], node["tokens"], node["path"]
    if node["every"]:
        # one test a token, so that a list field may hold them in different elements
        single = [{**node, "tokens": [w], "every": False} for w in tokens] if _is_text(r, node["f"]) else [{**node, "every": False}]
        return reduce(lambda a, b: a & b, [_match(n, r) for n in single])

    def leaf(c: Column, t: T.DataType) -> Column:
        if isinstance(t, T.StringType):
            if not tokens:
                return F.lit(False)
            # a query token is a whole token of the text when no token
            # character touches it on either side: one compiled pattern scans
            # the text, no token array is built per row
            return F.lower(c).rlike(C.token_pattern(tokens))
        # non-text columns behave like term
        return c == literal_for(text, t, path)

    return r.on_field(node["f"], leaf, probe=str(text), path=path)


_COMPILERS = {"all": lambda node, r: F.lit(True), "bool": _bool, "term": _term, "terms": _terms, "range": _range,
              "match": _match, "phrase": _text, "prefix": _text, "wildcard": _text, "exists": _exists, "ids": _ids}


# --------------------------------------------------------------------------
# literals


def literal_for(value, dtype: T.DataType, path: str = "value") -> Column:
    """Convert a JSON scalar to a literal of ``dtype`` at plan-build time."""
    text = C.literal_text(value, "string" if isinstance(dtype, T.StringType) else dtype.simpleString(), path)
    if isinstance(dtype, T.StringType):
        return F.lit(text)
    if dtype.simpleString() in C.INTEGRAL_BITS:
        return F.lit(int(text)).cast(dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.lit(float(text)).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(text == "true")
    return F.lit(text).cast(dtype)


_VARIANT_PROBE = {"boolean": T.BooleanType(), "decimal(38,9)": T.DecimalType(38, 9),
                  "double": T.DoubleType(), "string": T.StringType()}


# --------------------------------------------------------------------------
# field resolution

#: probe of ``exists``: whether the field is there, whatever its type
_PRESENT = object()


def _is_text(r: "_Resolver", field: str) -> bool:
    """Whether ``field`` holds texts (untyped fields are compared as texts)."""
    kinds: list[bool] = []
    r.on_field(field, lambda c, t: kinds.append(isinstance(t, T.StringType)) or F.lit(True), probe="", path=field)
    return all(kinds)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class _Resolver:
    def __init__(self, schema: T.StructType, root: str | None):
        self.schema = schema
        if root is None and "_source" in schema.fieldNames() and "_id" in schema.fieldNames():
            root = "_source"
        self.root = root
        if root is not None:
            f = _field(schema, root)
            if f is None:
                raise QueryError(f"root column '{root}' not found")
            self.base, self.base_type = F.col(quote(root)), f.dataType
        else:
            self.base, self.base_type = None, schema

    def on_field(self, field: str, leaf: Leaf, *, probe, path: str, eq_value=None) -> Column:
        parts = field.split(".")
        return _walk(self.base, self.base_type, parts, leaf, probe, eq_value, path)


def _field(st: T.StructType, name: str) -> T.StructField | None:
    for f in st.fields:
        if f.name == name:
            return f
    return None


def _missing() -> Column:
    # an unknown field never matches; under must_not it is kept
    return F.lit(None).cast("boolean")


def _walk(base: Column | None, dtype, parts: list[str], leaf: Leaf, probe, eq_value, path) -> Column:
    if isinstance(dtype, T.ArrayType):
        elem = dtype.elementType
        if not parts and eq_value is not None and not C.fraction_for_integer(eq_value, elem.simpleString()) and not isinstance(
                elem, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
            return F.array_contains(base, literal_for(eq_value, elem, path))
        return F.exists(base, lambda x: _walk(x, elem, parts, leaf, probe, eq_value, path))
    if isinstance(dtype, T.VariantType):
        return _variant_leaf(base, "$" + "".join(f"[{json.dumps(p)}]" for p in parts), leaf, probe)
    if not parts:
        if probe is _PRESENT:
            return base.isNotNull()
        if isinstance(dtype, (T.StructType, T.MapType)):
            raise QueryError(f"{path}: field is an object, not a value")
        return leaf(base, dtype)
    head, rest = parts[0], parts[1:]
    if isinstance(dtype, T.StructType):
        f = _field(dtype, head)
        if f is None:
            # allow dotted names that are a single column, e.g. "a.b" as one name
            for k in range(len(parts), 1, -1):
                joined = ".".join(parts[:k])
                g = _field(dtype, joined)
                if g is not None:
                    col = F.col(quote(joined)) if base is None else base.getField(joined)
                    return _walk(col, g.dataType, parts[k:], leaf, probe, eq_value, path)
            return _missing()
        col = F.col(quote(head)) if base is None else base.getField(head)
        return _walk(col, f.dataType, rest, leaf, probe, eq_value, path)
    if isinstance(dtype, T.MapType):
        if not isinstance(dtype.keyType, T.StringType):
            raise QueryError(f"{path}: only string-keyed maps can be addressed")
        return _walk(F.try_element_at(base, F.lit(head)), dtype.valueType, rest, leaf, probe, eq_value, path)
    return _missing()


def _variant_leaf(base: Column, jpath: str, leaf: Leaf, probe) -> Column:
    node = F.try_variant_get(base, jpath, "variant")
    if probe is _PRESENT:
        return ~F.schema_of_variant(node).isin("VOID", "ARRAY<VOID>", "OBJECT<>")
    vtype = variant_type_for(probe)
    stype = _VARIANT_PROBE[vtype]
    scalar = leaf(F.try_variant_get(node, "$", vtype), stype)
    arr = F.try_variant_get(node, "$", f"array<{vtype}>")
    any_elem = F.exists(arr, lambda x: leaf(x, stype))
    return F.when(F.schema_of_variant(node).startswith("ARRAY"), any_elem).otherwise(scalar)
