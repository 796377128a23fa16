"""Column functions (I1–I4): collection name of a URL, flatten to paths, text
preview and canonical JSON. All built-in expressions; no Python UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An http(s) URL in any letter case; the collection name is its
# path without the one leading slash, query and fragment excluded.
URL_PATH = r"^(?i:https?)://[^/?#]*/?([^?#]*)"
# Preview keeps texts up to 160 characters, else the first 64,
# "..." and the last 64.
PREVIEW_MAX, PREVIEW_EDGE, PREVIEW_JOIN = 160, 64, "..."


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def index_name(url) -> Column:
    """Collection name from an http/https URL, else ``''``.

    The path is percent-decoded (a ``+`` stays a ``+``); a bad escape makes
    the URL invalid, giving ``''``. Null input gives ``''``.
    """
    raw = F.regexp_extract(F.coalesce(_c(url), F.lit("")), URL_PATH, 1)
    decoded = F.when(raw.contains("%"),
                     F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))).otherwise(raw)
    return F.coalesce(decoded, F.lit(""))


def text_preview(text) -> Column:
    """Short texts whole; long ones as head + ``...`` + tail (in characters)."""
    t = _c(text)
    return F.when(F.length(t) <= PREVIEW_MAX, t).otherwise(
        F.concat(F.left(t, F.lit(PREVIEW_EDGE)), F.lit(PREVIEW_JOIN), F.right(t, F.lit(PREVIEW_EDGE))))


def canonical_json(text) -> Column:
    """I4: re-serialise JSON text with sorted keys and no spaces; nulls kept."""
    return F.to_json(F.parse_json(_c(text)))


def nesting_depth(doc: Column) -> Column:
    """Levels of objects and arrays in a VARIANT (0 for a scalar): brackets of its JSON outside strings."""
    bare = F.regexp_replace(F.to_json(doc), r'"(?:[^"\\]++|\\.)*+"', "")
    marks = F.regexp_extract_all(bare, F.lit(r"([{}\[\]])"), F.lit(1))
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("most"))

    def step(s, mark):
        at = s["at"] + F.when(mark.isin("{", "["), 1).otherwise(-1)
        return F.struct(at.alias("at"), F.greatest(s["most"], at).alias("most"))

    return F.aggregate(marks, start, step, lambda s: s["most"])


def flatten_paths(df: DataFrame, key: str, doc) -> DataFrame:
    """One row ``(key, path, value VARIANT)`` per leaf of each document.

    Objects add ``.name``, arrays ``[i]``; empty objects and arrays give no
    row, a JSON null leaf gives a row with a VARIANT null. ``doc`` may be a
    VARIANT or a struct column (converted with ``to_variant_object``).

    One read of the documents, at any depth: a container row expands into its children by a generator,
    ``_EAGER_LEVELS`` times; a leaf passes through as a one-element array. What is still a container then is
    expanded inside its row by a loop over the levels that it has itself; documents
    without such depth never enter that branch. A container left at the end is an error, never a value.
    """
    from pyspark.sql import types as T

    d = _c(doc)
    dtype = df.select(d.alias("__d")).schema["__d"].dataType
    if not isinstance(dtype, T.VariantType):
        d = F.to_variant_object(d)
    no = F.lit(False)
    level = df.select(F.col(key).alias("__key"),
                      F.struct(F.lit("").alias("path"), d.alias("value"), no.alias("done")).alias("n"))
    for _ in range(_EAGER_LEVELS):
        level = level.select("__key", F.explode(_expanded(F.col("n"))).alias("n"))
    n = F.col("n")
    deep = F.aggregate(F.sequence(F.lit(0), nesting_depth(n["value"])), F.array(n),
                       lambda nodes, _: F.flatten(F.transform(nodes, _expanded)))
    level = level.select("__key", F.explode(F.when(n["done"], F.array(n)).otherwise(deep)).alias("n"))
    done = F.when(F.col("n.done"), True).otherwise(
        F.raise_error(F.lit("nested deeper than its JSON tells")).cast("boolean"))
    return level.filter(done).select(F.col("__key").alias(key), F.col("n.path").alias("path"), F.col("n.value").alias("value"))


#: Levels of nesting that flatten_paths expands by generators.
_EAGER_LEVELS = 2


def _expanded(n: Column) -> Column:
    """The children of a node (path, value, done); of a leaf the leaf itself, marked once and not parsed again."""
    path, value = n["path"], n["value"]
    as_map = F.try_variant_get(value, "$", "map<string,variant>")
    as_arr = F.try_variant_get(value, "$", "array<variant>")
    no = F.lit(False)
    objects = F.transform(F.map_entries(as_map), lambda e: F.struct(
        F.when(path == "", e["key"]).otherwise(F.concat(path, F.lit("."), e["key"])).alias("path"),
        e["value"].alias("value"), no.alias("done")))
    items = F.transform(as_arr, lambda x, i: F.struct(
        F.concat(path, F.lit("["), i.cast("string"), F.lit("]")).alias("path"), x.alias("value"), no.alias("done")))
    leaf = F.array(F.struct(path.alias("path"), value.alias("value"), F.lit(True).alias("done")))
    return F.when(n["done"], F.array(n)).when(as_map.isNotNull(), objects).when(as_arr.isNotNull(), items).otherwise(leaf)
