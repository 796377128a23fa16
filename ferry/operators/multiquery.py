"""Many queries over one collection.

A query list is a bag union: a document matching two lines appears twice
(once per ``query_no``); matching two ``should`` terms of one line counts once.

* ``multi_query`` (E1): a short list of DSL objects evaluated in one scan:
  every row computes the array of query numbers it matches and is exploded.
* ``batch_query`` (E2): a query *table* of any length, over typed or untyped documents.

  1. Each line is planned in the tasks (:mod:`.lineplan`): canonical form, literals
     typed once, a postfix program, and anchors, i.e. leaves of which every matching document
     meets at least one. Equal lines have equal plans; each different plan is answered once and
     its result fanned out to the line numbers at the end; the numbers of a plan are held as arrays.
  2. Candidates come from one equi-join per kind and field of the anchors:

     - ``value`` (term, terms, ids): hash join on the typed value;
     - ``range``: a dyadic cover. The list's own end points cut the number line into cells;
       a range is the O(log n) dyadic nodes that make it up, a document's value has one cell and
       O(log n) ancestors, and they meet by equality. No statistics of the documents are needed, and a
       pair that meets is a hit (only values equal to an open bound may still be rejected);
     - ``token`` (match): the tokens of the list, looked for in the documents' tokens;
     - ``rare`` (match with ``and``, match_phrase): only the line's rarest token or, of a phrase, pair of neighbouring tokens, by document
       frequency;
     - ``head`` and ``tail`` (prefix, wildcards that begin or end with literal characters): hash join on the first or last characters,
       one length at a time;
     - ``gram`` (other wildcards): the rarest n-gram of their literal runs, by document frequency, looked for among the values' n-grams.

     Documents' tokens are first tested against a small bitmap of the list's tokens, so a
     document is copied only for tokens that the list holds.
  3. Lines that are one leaf are decided by their join. The others are verified on the JVM: lines
     that differ in their literals only share a *shape*, and each of the most frequent shapes is one compiled
     predicate over the document's columns and the line's literals; lines of rarer shapes run their program on a bit stack.
     A document is kept only for the first anchor it meets, so no de-duplication shuffle and no
     document id is needed.

  Fields inside VARIANT, maps and arrays of objects become lists of values of the type that the query compares with,
  once per document, and then take the same joins. Lines with no anchor (e.g. only ``must_not``: they match most of the
  collection anyway) are compiled with the DSL compiler and evaluated in slices with ``multi_query``.

  A query side is broadcast only below a measured bound (rows and plan bytes); otherwise both sides shuffle and AQE splits skewed
  keys.
* ``multi_query_cap`` (E3): the shared cap over the concatenated results.
"""

from __future__ import annotations

import json
import math
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .clauses import RANGE_OPS, TOKEN_SPLIT
from .dsl import _VARIANT_PROBE, _Resolver, _exists, _field, compile_query, quote
from .lineplan import _DECIDED, AS, GRAM, ID_KEY  # noqa: F401
from .order import cap, number_rows

QUERY_NO = "query_no"


# --------------------------------------------------------------------------- E1


def multi_query(df: DataFrame, queries: list, root: str | None = None, first_no: int = 0,
                query_col: str = QUERY_NO) -> DataFrame:
    """``(query_no, *df)`` for every (query, matching row) pair, one scan.

    Rows matching no query are dropped before the explode by the OR of all
    predicates, which also reaches the scan as a pushed filter when possible.
    """
    plain = [compile_query(q, df.schema, root) for q in queries]
    plain = [F.lit(True) if c is None else c for c in plain]
    conds = [F.coalesce(c, F.lit(False)) for c in plain]
    if not conds:
        return df.select(F.lit(None).cast("long").alias(query_col), "*").limit(0)
    hits = F.filter(F.array(*[F.when(c, F.lit(first_no + i).cast("long")) for i, c in enumerate(conds)]),
                    lambda x: x.isNotNull())
    any_hit = reduce(lambda a, b: a | b, plain)  # not coalesced, so that it can be pushed into the scan
    return (df.filter(any_hit)
            .select(F.explode(hits).alias(query_col), *[F.col(quote(c)) for c in df.columns]))


def multi_query_cap(results: DataFrame, max_docs: int, spec=None, tiebreak=None,
                    query_col: str = QUERY_NO) -> DataFrame:
    """One cap shared by all queries, filled in query order."""
    order = [query_col] + ([spec] if isinstance(spec, str) else list(spec or []))
    spec_all = ",".join(o if isinstance(o, str) else f"{o[0]}:{'asc' if o[1] else 'desc'}" for o in order if o)
    return cap(results, max_docs, spec_all, tiebreak)


# --------------------------------------------------------------------------- E2: documents


def _all(parts):
    return reduce(lambda a, b: a & b, parts)


def _element_types(t) -> set[str]:
    """Types (simple names) of the values that fields of a schema (``jsonValue``) can hold; VARIANT: those it is read as."""
    if t == "variant":
        return set(_VARIANT_PROBE)
    if not isinstance(t, dict):
        return {T._parse_datatype_json_value(t).simpleString()}
    if t["type"] == "struct":
        return set().union(*[_element_types(f["type"]) for f in t["fields"]], set())
    return _element_types(t.get("elementType") or t.get("valueType") or "string")


def _values(base: Column | None, dtype, parts: list[str], vtype: str | None):
    """(column, element type, whether a list) of a field; a list holds what the compiler would test one by one."""
    if isinstance(dtype, T.ArrayType):
        _, etype, nested = _values(base, dtype.elementType, parts, vtype)
        if not parts and not isinstance(dtype.elementType, (T.ArrayType, T.VariantType)):
            return base, dtype.elementType, True
        lists = F.transform(base, lambda x: _values(x, dtype.elementType, parts, vtype)[0])
        return (F.flatten(F.filter(lists, lambda x: x.isNotNull())) if nested else lists), etype, True
    if isinstance(dtype, T.VariantType):
        path = "$" + "".join(f"[{json.dumps(p)}]" for p in parts)
        # only arrays can be read as one; two lookups a field, without the text of its schema
        found = F.coalesce(F.try_variant_get(base, path, f"array<{vtype}>"), F.array(F.try_variant_get(base, path, vtype)))
        return found, _VARIANT_PROBE[vtype], True
    if not parts:
        return base, dtype, False
    if isinstance(dtype, T.MapType):
        return _values(F.try_element_at(base, F.lit(parts[0])), dtype.valueType, parts[1:], vtype)
    for n in (1, *range(len(parts), 1, -1)):
        name = ".".join(parts[:n])
        f = _field(dtype, name)
        if f is not None:
            return _values(F.col(quote(name)) if base is None else base.getField(name), f.dataType, parts[n:], vtype)
    raise KeyError(".".join(parts))


def _each(frame: DataFrame, xs: Column, name: str) -> DataFrame:
    """A row per value of ``xs`` that is not null. A plain explode would let the optimizer test ``xs`` for emptiness below the
    projections, which computes tokens once more."""
    return frame.select("*", F.explode_outer(xs).alias(name)).where(F.col(name).isNotNull())


def _pairs(words: Column) -> Column:
    """Neighbouring tokens, joined by a space."""
    after = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(0)))
    return F.filter(F.zip_with(words, after, lambda a, b: F.concat(a, F.lit(" "), b)), lambda x: x.isNotNull())


def _tokens(c: Column) -> Column:
    return F.split(F.lower(c), TOKEN_SPLIT)


class _Docs:
    """The documents with the field values and tokens that a join or a predicate needs, computed once per document."""

    def __init__(self, df: DataFrame, root: str | None):
        self.df, self.resolver = df, _Resolver(df.schema, root)
        self.columns = [F.col(quote(c)) for c in df.columns]
        self.names: dict[str, int] = {}
        self.found: dict[str, tuple] = {}

    def field(self, key: str):
        """(column, element type, whether a list) of a field key."""
        if key not in self.found:
            if key == ID_KEY:
                self.found[key] = F.col("_id").cast("string"), T.StringType(), False
            else:
                name, _, vtype = key.partition(AS)
                self.found[key] = _values(self.resolver.base, self.resolver.base_type, name.split("."), vtype or None)
        return self.found[key]

    def stored_name(self, kind: str, key: str) -> str:
        return f"__ferry_{kind}{self.names.setdefault(key, len(self.names))}"

    def frame(self, needs: set[tuple[str, str]], *more: Column) -> DataFrame:
        """All columns, a column per need (``value``, ``tokens`` or ``words`` of a field), and more."""
        df, extra = self.df, []
        words = [F.col(self.stored_name("words", key)) for kind, key in sorted(needs) if kind == "words"]
        if words:  # before the rest, so that a text is split once: a list of tokens in order for each text
            lists = []
            for key in sorted(key for kind, key in needs if kind == "words"):
                col, _, is_list = self.field(key)
                texts = F.filter(col, lambda x: x.isNotNull()) if is_list else F.array(F.coalesce(col, F.lit("")))
                lists.append(F.transform(texts, lambda x: F.filter(_tokens(x), lambda t: t != "")).alias(self.stored_name("words", key)))
            df = df.select(*self.columns, *lists)
        for kind, key in sorted(needs):
            if kind == "words":
                continue
            col, _, is_list = self.field(key)
            if kind == "tokens" and ("words", key) in needs:
                col = F.array_distinct(F.flatten(self.stored_name("words", key)))
            elif kind == "tokens":
                col = F.array_distinct(F.flatten(F.transform(F.filter(col, lambda x: x.isNotNull()), _tokens)) if is_list else _tokens(col))
                col = F.filter(col, lambda t: t != "")
            extra.append(col.alias(self.stored_name(kind, key)))
        return df.select(*self.columns, *words, *extra, *more)


# --------------------------------------------------------------------------- E2: lines

_ANCHOR = "struct<j:int,how:string,key:string,ty:int,keys:array<string>,gte:string,gt:string,lte:string,lt:string>"
_PROG = "array<struct<op:int,a:int,b:int,c:int,w:int>>"
_LEAVES = "array<struct<kind:string,key:string,ty:int,a:int,li:int,t:int,gte:int,gt:int,lte:int,lt:int>>"
_PLAN = (f"struct<never:boolean,exact:boolean,q:string,shape:string,depth:int,prog:{_PROG},leaves:{_LEAVES},anchors:array<{_ANCHOR}>,"
         "lits:array<array<string>>,lists:array<array<array<string>>>,tokens:array<array<string>>>")


def _typed(x: Column, type_name: str) -> Column:
    """A literal's text as a value of the type (a float by way of the double that a single query compares with).

    The planner has checked the text against its field's type; a text meant for another type becomes null here.
    """
    if type_name == "string":
        return x
    return x.try_cast("double").cast("float") if type_name == "float" else x.try_cast(type_name)


def _typed_list(xs: Column, type_name: str) -> Column:
    return F.transform(xs, lambda x: _typed(x, type_name))


def _typed_lists(lists: Column, type_name: str) -> Column:
    return F.transform(lists, lambda xs: _typed_list(xs, type_name))


#: About so many numbers of lines with one plan are in one array.
_SET = 1 << 16


def _sets() -> Column:
    return F.ceil(F.col("n") / _SET)


def _alone() -> Column:
    """Whether a plan is that of one line, and its number can stand for it."""
    return (F.col("n") == 1) & (F.col("no") >= 0)


def _line() -> Column:
    """The number to answer by: of a line alone its own, else one below zero, for which the lines' numbers are put in at the end."""
    return F.when(_alone(), F.col("no")).otherwise(-1 - F.col("uid"))


def _number_sets(numbers: DataFrame) -> DataFrame:
    """``(line, __numbers)``: the numbers of each line in ascending order, those of a very common one in several arrays."""
    at = F.pmod(F.xxhash64(QUERY_NO), _sets())
    return numbers.groupBy("line", at.alias("__at")).agg(F.sort_array(F.collect_list(QUERY_NO)).alias("__numbers")).drop("__at")


def _plan_lines(queries: DataFrame, schema, has_id: bool, slots: list[str]) -> tuple[DataFrame, DataFrame, dict]:
    """(lines, numbers, told): the different plans, stored, with a number each (``uid``), the count of the lines that have it (``n``), the least
    of their numbers (``no``) and the number to answer by (``line``); ``(line, n, query_no)`` of the plans that several lines have; and how many plans
    there are (``plans``) of how many lines (``lines``), how many without anchors (``open``) and how many to verify (``tested``), how many lines have
    such a shared plan (``many``) and in how many arrays their numbers are (``sets``), observed while they are written."""
    from . import clauses, lineplan

    # the planner and the parser travel with the task, so the executors need no installed copy of this package
    for mod in (clauses, lineplan):
        cloudpickle.register_pickle_by_value(mod)
    planned = materialize(queries.select(QUERY_NO, F.to_json("query").alias("q"))
                          .mapInPandas(lineplan.plan_batches(schema, has_id, slots), "query_no long, same string, plan string"), "line-plans")
    p = F.from_json("plan", _PLAN)
    different = planned.groupBy("same").agg(F.first("plan").alias("plan"), F.count(F.lit(1)).alias("n"), F.min(QUERY_NO).alias("no"))
    typed = [_typed_list(F.get("p.lits", i), t).alias(f"l{i}") for i, t in enumerate(slots)] + \
            [_typed_lists(F.get("p.lists", i), t).alias(f"x{i}") for i, t in enumerate(slots)]
    flat = (different.select("same", "n", "no", p.alias("p"), F.octet_length("plan").alias("bytes")).where(~F.coalesce("p.never", F.lit(False)))
            .select(F.monotonically_increasing_id().alias("uid"), "same", "n", "no", "bytes", "p.exact", "p.q", "p.shape", F.md5("p.shape").alias("shape_id"),
                    "p.depth", "p.prog", "p.leaves", "p.anchors", "p.tokens", *typed))
    seen = Observation()
    lines = materialize(flat.observe(seen, F.count(F.lit(1)).alias("plans"), F.coalesce(F.sum("n"), F.lit(0)).alias("lines"), F.count("q").alias("open"),
                                     F.count(F.when(~F.col("exact"), 1)).alias("tested"),
                                     F.coalesce(F.sum(F.when(~_alone(), F.col("n"))), F.lit(0)).alias("many"),
                                     F.coalesce(F.sum(F.when(~_alone(), _sets())), F.lit(0)).alias("sets")), "lines")
    lines = lines.withColumn("line", _line())
    numbers = planned.select(QUERY_NO, "same").join(lines.where(~_alone()).select("line", "same", "n"), "same").select("line", "n", QUERY_NO)
    return lines, numbers, seen.get


# --------------------------------------------------------------------------- E2: predicates


#: So many tokens are looked for one by one.
_FEW = 4


class _Verifier:
    """Predicates over a candidate row: the document's columns, the line's literals ``__c`` and the anchor met ``__j``."""

    def __init__(self, docs: _Docs, slots: list[str]):
        self.docs, self.slots = docs, slots

    def needs(self, leaves) -> set[tuple[str, str]]:
        """What predicates on leaves (kind, key) read of the documents."""
        out = set()
        for kind, key in leaves:
            if kind in ("match", "every"):
                out.add(("tokens", key))
            elif kind != "exists" and (AS in key or self.docs.field(key)[2]):
                out.add(("value", key))
        return out

    def truth(self, kind: str, key: str, leaf) -> Column:
        """Truth (never null) of a leaf; ``leaf`` holds the places of its literals (numbers or columns)."""
        c = F.col("__c")
        if kind == "exists":
            return F.coalesce(_exists({"f": key, "path": key}, self.docs.resolver), F.lit(False))
        if kind in ("match", "every"):
            have, want = F.col(self.docs.stored_name("tokens", key)), F.get(c["tokens"], leaf["t"])
            one_by_one = [F.array_contains(have, F.get(want, F.lit(i))) for i in range(_FEW)]  # without a set per row
            if kind == "match":
                test = F.when(F.size(want) == 1, one_by_one[0]).otherwise(F.arrays_overlap(have, want))
            else:
                test = F.when(F.size(want) <= _FEW, _all([(F.size(want) <= i) | x for i, x in enumerate(one_by_one)])) \
                        .otherwise(F.size(F.array_except(want, have)) == 0)
            return F.coalesce(test, F.lit(False))
        col, etype, is_list = self.docs.field(key)
        if AS in key or is_list:
            col = F.col(self.docs.stored_name("value", key))
        slot = self.slots.index(etype.simpleString())

        def lit(place):
            return F.get(c[f"l{slot}"], place)

        if kind == "terms":
            values = F.get(c[f"x{slot}"], leaf["li"])
            test = F.arrays_overlap(col, values) if is_list else F.array_contains(values, col)
        elif kind == "range":
            def inside(x):
                return _all([lit(leaf[op]).isNull() | cmp(lit(leaf[op])) for op, cmp in _compare(x) if not isinstance(leaf[op], int) or leaf[op] >= 0])
            test = F.exists(col, inside) if is_list else inside(col)
        else:
            one = {"term": lambda x: x == lit(leaf["a"]), "prefix": lambda x: x.startswith(lit(leaf["a"])),
                   "wildcard": lambda x: F.like(x, lit(leaf["a"])), "phrase": lambda x: F.rlike(F.lower(x), lit(leaf["a"]))}[kind]
            test = F.exists(col, one) if is_list else one(col)
        return F.coalesce(test, F.lit(False))

    def compiled(self, shape: dict, met: int) -> Column:
        """The predicate of all lines of a shape on rows that met the anchor ``met``; a leaf that its join decides is not tested again."""
        truths = [F.lit(True) if j == met and leaf["kind"] in _DECIDED else self.truth(leaf["kind"], leaf["key"], leaf)
                  for j, leaf in enumerate(shape["leaves"])]
        stack: list[Column] = []
        for op in shape["prog"]:
            if op["op"] == 0:
                stack.append(truths[op["a"]])
            elif op["op"] == 2:
                stack.append(F.lit(True))
            else:
                k = op["a"] + op["b"] + op["c"]
                top, stack = stack[len(stack) - k:], stack[:len(stack) - k]
                must, nots, should = top[:op["a"]], top[op["a"]: op["a"] + op["b"]], top[op["a"] + op["b"]:]
                parts = must + [~x for x in nots]
                if op["w"] == 1:
                    parts.append(reduce(lambda a, b: a | b, should))
                elif op["w"] > 1:
                    parts.append(reduce(lambda a, b: a + b, [x.cast("int") for x in should]) >= op["w"])
                stack.append(_all(parts) if parts else F.lit(True))
        # only for the first anchor that the document meets
        return _all([stack[0], *[~truths[a["j"]] for a in shape["anchors"] if a["j"] < met]] + ([truths[met]] if len(shape["anchors"]) > 1 else []))

    def interpreted(self, leaves) -> Column:
        """The predicate of lines of any shape whose leaves are of the given (kind, key) pairs."""
        c = F.col("__c")

        def one(leaf):
            out = None
            for kind, key in sorted(leaves):
                cond = (leaf["kind"] == kind) & (leaf["key"] == key)
                test = self.truth(kind, key, leaf)
                out = F.when(cond, test) if out is None else out.when(cond, test)
            return out.otherwise(F.lit(False))

        def verdict(t):
            owner = F.array_min(F.filter(c["places"], lambda j: F.get(t, j)))
            ok = F.when(c["depth"] <= _BIT_DEPTH, _run_bits(c["prog"], t)).otherwise(_run_prog(c["prog"], t))
            return ok & (F.col("__j") == owner)
        # the truths are bound once (a one-element transform acts as "let"):
        # as a plain column Catalyst would inline them at every use
        return F.get(F.transform(F.array(F.transform(c["leaves"], one)), verdict), 0)


def _compare(x: Column):
    return (("gte", x.__ge__), ("gt", x.__gt__), ("lte", x.__le__), ("lt", x.__lt__))


#: deepest program stack the bit machine holds (one bit per entry in a bigint)
_BIT_DEPTH = 62


def _run_bits(prog: Column, truths: Column) -> Column:
    """The postfix program with its stack as bits of a bigint (depth <= ``_BIT_DEPTH``).

    A bool op pops ``k = must + must_not + should`` bits (must children are
    the lowest) and tests them with masks; no array is built per step.
    """
    one = F.lit(1).cast("long")

    def _shl(x, n):
        return F.call_function("shiftleft", x, n)

    def _shr(x, n):
        return F.call_function("shiftright", x, n)

    def mask(width: Column) -> Column:
        return _shl(one, width) - one

    def step(st, op):
        bits, n = st["bits"], st["n"]
        push = op["op"] != 1
        val = F.when(op["op"] == 0, F.get(truths, op["a"])).otherwise(F.lit(True))
        k = op["a"] + op["b"] + op["c"]
        top = _shr(bits, n - k).bitwiseAND(mask(k))
        m_must = mask(op["a"])
        m_not = _shl(mask(op["b"]), op["a"])
        m_should = _shl(mask(op["c"]), op["a"] + op["b"])
        res = ((top.bitwiseAND(m_must) == m_must) & (top.bitwiseAND(m_not) == 0)
               & (F.bit_count(top.bitwiseAND(m_should)) >= op["w"]))
        pushed = F.struct(bits.bitwiseOR(_shl(val.cast("long"), n)).alias("bits"), (n + 1).alias("n"))
        popped = F.struct(bits.bitwiseAND(mask(n - k)).bitwiseOR(_shl(res.cast("long"), n - k))
                          .alias("bits"), (n - k + 1).alias("n"))
        return F.when(push, pushed).otherwise(popped)
    start = F.struct(F.lit(0).cast("long").alias("bits"), F.lit(0).alias("n"))
    return F.aggregate(prog, start, step)["bits"].bitwiseAND(one) == one


def _run_prog(prog: Column, truths: Column) -> Column:
    """Evaluate the postfix bool program over the leaf truths (a stack in ``aggregate``)."""
    def step(st, op):
        k = F.when(op["op"] == 1, op["a"] + op["b"] + op["c"]).otherwise(F.lit(1))
        n = F.size(st)
        top = F.slice(st, F.greatest(n - k + 1, F.lit(1)), k)
        rest = F.slice(st, F.lit(1), F.greatest(n - k, F.lit(0)))
        m, nn, s = op["a"], op["b"], op["c"]
        res = (F.forall(F.slice(top, F.lit(1), m), lambda x: x)
               & ~F.exists(F.slice(top, m + 1, nn), lambda x: x)
               & (F.size(F.filter(F.slice(top, m + nn + 1, s), lambda x: x)) >= op["w"]))
        return (F.when(op["op"] == 0, F.concat(st, F.array(F.get(truths, op["a"]))))
                .when(op["op"] == 2, F.concat(st, F.array(F.lit(True))))
                .otherwise(F.concat(rest, F.array(res))))
    return F.get(F.aggregate(prog, F.array().cast("array<boolean>"), step), 0)


# --------------------------------------------------------------------------- E2: joins

#: Places of the token bitmap (one byte each).
_PLACES = 1 << 16
#: Most cells that the end points of the ranges on one field cut; beyond it every k-th end point cuts.
_CELLS = 1 << 20


def _listed(keys: DataFrame):
    """A test whether a text may be among ``keys`` (column ``k``): a bitmap of fixed size in the expression."""
    bits = bytearray(_PLACES)
    for r in keys.select(F.pmod(F.xxhash64("k"), F.lit(_PLACES)).cast("int").alias("at")).distinct().collect():  # at most _PLACES
        bits[r["at"]] = 1
    table = F.lit(bytes(bits))
    return lambda t: F.substring(table, (F.pmod(F.xxhash64(t), F.lit(_PLACES)) + 1).cast("int"), F.lit(1)) == F.lit(b"\x01")


def _as_double(c: Column, etype: T.DataType) -> Column:
    """An order-preserving double; wall clocks without a zone are read without one."""
    if isinstance(etype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(etype, T.TimestampNTZType):
        seconds = F.unix_date(c.cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
        return seconds.cast("double") * 1e6 + (F.extract(F.lit("SECOND"), c) * 1000000).cast("double")
    if isinstance(etype, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")


def _in_bounds(x: Column) -> Column:
    """``x`` within the row's typed bounds ``__gte`` .. ``__lt`` (null = absent)."""
    return _all([F.col(f"__{op}").isNull() | cmp(F.col(f"__{op}")) for op, cmp in _compare(x)])


def _cuts(ends: DataFrame):
    """(ascending finite cuts, whether every end point is one) of the distinct end points ``e``."""
    import numpy as np

    most, step = _CELLS // 2, 1
    points = [r["e"] for r in ends.limit(most + 1).collect()]
    if len(points) > most:
        step = -(-ends.count() // most)
        points = [r["e"] for r in number_rows(ends, [F.col("e").asc()], "rn").where(F.col("rn") % step == 0).select("e").collect()]
    at = np.array(points, dtype="float64")
    at = at[np.isfinite(at)]
    cuts = np.unique(np.concatenate([at, np.nextafter(at, np.inf)]))
    return cuts[np.isfinite(cuts)], step == 1


def _cells(spark, cuts):
    """The cell of a double column: how many cuts are not above it; NaN, above all numbers, has the cell after the last.

    The cuts are one broadcast array: as parameters of a transformer or literals of the plan each of them would pass the driver by itself.
    """
    held = spark.sparkContext.broadcast(cuts)

    @F.pandas_udf("long")
    def cell(x: pd.Series) -> pd.Series:
        import numpy as np
        import pandas as pd

        v = x.to_numpy("float64")
        return pd.Series(np.where(np.isnan(v), len(held.value) + 1, np.searchsorted(held.value, v, side="right")))

    return cell


def _range_join(docs: _Docs, needs, rows: DataFrame, key: str, type_name: str, most_rows: int) -> DataFrame:
    """Candidates of range anchors: dyadic nodes of the ranges against the ancestors of the documents' cells."""
    col, etype, is_list = docs.field(key)
    rows = rows.select("line", "__exact", "__c", "__j", *[_typed(F.col(f"a.{op}"), type_name).alias(f"__{op}") for op in RANGE_OPS])
    rows = rows.select("*", *[_as_double(F.col(f"__{op}"), etype).alias(f"__d{op}") for op in RANGE_OPS])
    ends = rows.select(F.explode(F.array(*[f"__d{op}" for op in RANGE_OPS])).alias("e")).where("e is not null and not isnan(e)").distinct()
    cuts, all_cut = _cuts(ends)
    # a double stands for one value only: then open bounds exclude their own cell
    plain = not isinstance(etype, T.DecimalType) and bool((abs(cuts) < 2.0 ** 53).all())
    sharp = all_cut and (plain or isinstance(etype, (T.FloatType, T.DoubleType)))
    top = len(cuts) + 1  # cells 0 .. top - 1, and NaN in cell top
    placed = _cells(rows.sparkSession, cuts)
    rows = rows.withColumns({f"__at{op}": placed(f"__d{op}") for op in RANGE_OPS})  # of an absent bound: not used

    def cell(op, shift):
        at = F.col(f"__at{op}")
        finite = F.abs(F.col(f"__d{op}")) < math.inf  # infinite and NaN bounds share a cell with other values
        return F.when(F.col(f"__d{op}").isNotNull(), at + F.when(finite & ~F.isnan(f"__d{op}"), F.lit(shift if sharp else 0)).otherwise(0))

    lo = F.greatest(cell("gte", 0), cell("gt", 1), F.lit(0).cast("long"))
    hi = F.least(cell("lte", 0), cell("lt", -1), F.lit(top).cast("long"))
    height = (top + 1).bit_length()

    def cover(j):
        left = F.call_function("shiftright", F.col("__lo") + F.call_function("shiftleft", F.lit(1).cast("long"), j) - 1, j)
        right = F.call_function("shiftright", F.col("__hi") + 1, j)
        node = lambda i: F.struct(j.alias("level"), i.alias("i"))
        odd_left = (left < right) & (left % 2 == 1)
        odd_right = (left < right) & (right % 2 == 1) & (left + F.when(odd_left, 1).otherwise(0) <= right - 1)
        return F.array(F.when(odd_left, node(left)), F.when(odd_right, node(right - 1)))

    nodes = (rows.withColumns({"__lo": lo, "__hi": hi})  # none where lo > hi
             .withColumn("__n", F.explode(F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(height)), cover)), lambda x: x.isNotNull())))
             .select("line", "__exact", "__c", "__j", *[f"__{op}" for op in RANGE_OPS],
                     F.col("__n.level").alias("__level"), (F.col("__n.level").cast("long") * (1 << 32) + F.col("__n.i")).alias("__node")))
    used = nodes.groupBy("__level").agg(F.count(F.lit(1)).alias("n")).collect()  # one row a level
    if not used:
        return None
    small = sum(r["n"] for r in used) <= most_rows
    if is_list:
        needs, held = needs | {("value", key)}, F.col(docs.stored_name("value", key))
        dside = _each(docs.frame(needs), F.array_distinct(held), "__v")
    else:
        dside = docs.frame(needs, col.alias("__v")).where(F.col("__v").isNotNull())
    dside = dside.withColumn("__d", _as_double(F.col("__v"), etype))
    dside = dside.withColumn("__at", placed("__d")).drop("__d")
    at = F.col("__at")
    ancestors = F.array(*[F.lit(r["__level"] * (1 << 32)).cast("long") + F.shiftright(at, r["__level"]) for r in sorted(used)])
    joined = dside.withColumn("__node", F.explode(ancestors)).join(F.broadcast(nodes) if small else nodes, "__node")
    hit = _in_bounds(F.col("__v"))
    if is_list:  # a document meets a range once: for its smallest value inside
        hit = hit & ((F.size(held) < 2) | (F.col("__v") == F.array_min(F.filter(held, _in_bounds))))
    return joined.where(hit)


def _rarest(rows: DataFrame, held) -> DataFrame:
    """The rows of anchors with the one of their keys that the fewest documents hold as ``__k``; without those with a key that no document holds.

    ``held`` takes a test for listed keys and returns the documents' distinct keys (``__k``) that pass it.
    """
    wanted = rows.select("uid", "__j", F.explode("a.keys").alias("k"))
    counts = held(_listed(wanted.select("k").distinct())).groupBy(F.col("__k").alias("k")).agg(F.count(F.lit(1)).alias("df"))
    best = (wanted.join(counts, "k", "left").groupBy("uid", "__j")
            .agg(F.min(F.struct("df", "k")).alias("m"), F.max(F.col("df").isNull()).alias("absent"))
            .where("not absent").select("uid", "__j", F.col("m.k").alias("__k")))
    return rows.join(materialize(best, "rare-keys"), ["uid", "__j"])


def _candidates(docs: _Docs, needs, rows: DataFrame, how: str, key: str, type_name: str, lengths: list[int], choice: bool, paired: bool, small: bool, most_rows: int):
    """Rows of documents and anchors (line, __exact, __c, __j) that meet, each pair once per anchor; ``choice``: some anchors have several keys, ``paired``: some keys are
    pairs of tokens."""
    base = ["line", "__exact", "__c", "__j"]
    if how == "range":
        return _range_join(docs, needs, rows, key, type_name, most_rows)
    col, etype, is_list = docs.field(key)
    own = None
    if how == "value":
        qside = rows.select(*base, _typed_list(F.col("a.keys"), type_name).alias("__ks"))
        qside = qside.select("*", F.explode("__ks").alias("__k"))
        if is_list:  # a document with several of the values: for the smallest one
            needs, values = needs | {("value", key)}, F.col(docs.stored_name("value", key))
            dside = _each(docs.frame(needs), F.array_distinct(values), "__k")
            own = (F.size("__ks") < 2) | (F.size(values) < 2) | (F.col("__k") == F.array_min(F.array_intersect(values, F.col("__ks"))))
        else:
            dside, qside = docs.frame(needs, col.alias("__k")).where(F.col("__k").isNotNull()), qside.drop("__ks")
    elif how in ("token", "rare"):
        needs = needs | {("tokens", key)}
        have = F.col(docs.stored_name("tokens", key))
        if how == "token":
            qside = rows.select(*base, F.col("a.keys").alias("__ks"), F.explode("a.keys").alias("__k"))
            own = F.col("__k") == F.array_min(F.array_intersect(have, F.col("__ks")))
        else:
            keyed = {("tokens", key)}
            if paired:  # no token holds a space
                keyed, have = keyed | {("words", key)}, F.concat(have, F.flatten(F.transform(F.col(docs.stored_name("words", key)), _pairs)))
            needs = needs | keyed

            def held(test):
                return _each(docs.frame(keyed), F.array_distinct(F.filter(have, test)), "__k").select("__k")
            qside = (_rarest(rows, held) if choice else rows.withColumn("__k", F.get("a.keys", 0))).select(*base, "__k")
        listed = _listed(qside.select(F.col("__k").alias("k")))
        dside = _each(docs.frame(needs), F.array_distinct(F.filter(have, listed)), "__k")
    else:
        if how == "gram":
            def keys(x):
                return F.flatten(F.array(*[F.regexp_extract_all(x, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in lengths]))
        else:
            def keys(x):
                return F.array(*[F.when(F.length(x) >= n, F.substring(x, 1 if how == "head" else -n, n)) for n in lengths])
        found = F.flatten(F.transform(F.filter(col, lambda x: x.isNotNull()), keys)) if is_list else keys(col)

        def having(test, needs=frozenset()):
            return _each(docs.frame(set(needs)), F.array_distinct(F.filter(found, lambda x: x.isNotNull() & test(x))), "__k")
        qside = (_rarest(rows, lambda test: having(test).select("__k")) if choice else rows.withColumn("__k", F.get("a.keys", 0))).select(*base, "__k")
        dside = having(_listed(qside.select(F.col("__k").alias("k"))), needs)
    joined = dside.join(F.broadcast(qside) if small else qside, "__k")
    return joined if own is None else joined.where(own)


# --------------------------------------------------------------------------- E2


def batch_query(df: DataFrame, queries: DataFrame, id_col: str = "_id", root: str | None = None,
                broadcast_rows: int = 2_000_000, slice_size: int = 128, broadcast_bytes: int = 256 << 20,
                compiled_shapes: int = 24) -> DataFrame:
    """``(query_no, *df)`` for a query table ``(query_no, query VARIANT)``.

    No join path needs a document id: a document is emitted once per line by
    construction. ``id_col`` is accepted for callers that pass one. ``compiled_shapes``: so many of the most
    frequent line shapes get a predicate of their own; the other lines are interpreted, with equal results.
    """
    docs = _Docs(df, root)
    schema = docs.resolver.base_type.jsonValue()
    slots = sorted(_element_types(schema) | {"string"})
    lines, numbers, told = _plan_lines(queries, schema, "_id" in df.columns, slots)
    anchors = lines.where(F.col("anchors").isNotNull())
    # small jobs over the stored plans, bounded by kinds x fields and by the shapes asked for
    each = anchors.select("exact", "bytes", F.explode("anchors").alias("a"))
    weight = F.greatest(F.size("a.keys"), F.lit(1))
    stats = (each.groupBy(F.col("a.how").alias("how"), F.col("a.key").alias("key"))
             .agg(F.max("a.ty").alias("ty"), (F.max(F.size("a.keys")) > 1).alias("choice"),
                  F.max(F.exists("a.keys", lambda k: k.contains(" "))).alias("paired"), F.sum(weight).alias("rows"), F.sum(weight * F.when(F.col("exact"), 64).otherwise(F.col("bytes"))).alias("bytes"),
                  F.collect_set(F.when(F.col("a.how").isin("head", "tail", "gram"), F.length(F.get("a.keys", 0)))).alias("lengths"))
             .collect())
    shapes = (lines.where(~F.col("exact")).groupBy("shape_id").agg(F.count(F.lit(1)).alias("n"), F.first("shape").alias("shape"))
              .orderBy(F.desc("n"), "shape_id").limit(compiled_shapes + 1).collect()) if told["tested"] else []
    every = len(shapes) <= compiled_shapes
    shapes = [(r["shape_id"], json.loads(r["shape"])) for r in shapes[:compiled_shapes]]
    verifier = _Verifier(docs, slots)
    others: set[tuple[str, str]] = set()
    if not every:
        rest = lines.where(~F.col("exact") & ~F.col("shape_id").isin(*[s for s, _ in shapes]))
        others = {(r["kind"], r["key"]) for r in rest.select(F.explode("leaves").alias("f")).select("f.kind", "f.key").distinct().collect()}

    sid = reduce(lambda w, x: w.when(F.col("shape_id") == x[1][0], F.lit(x[0])), list(enumerate(shapes))[1:],
                 F.when(F.col("shape_id") == shapes[0][0], F.lit(0))).otherwise(-1) if shapes else F.lit(-1)
    carried = ["tokens", *[f"l{i}" for i in range(len(slots))], *[f"x{i}" for i in range(len(slots))]]
    program = [F.when(F.col("__sid") < 0, F.col(c)).alias(c) for c in ("prog", "leaves", "depth")]
    program.append(F.when(F.col("__sid") < 0, F.transform("anchors", lambda a: a["j"])).alias("places"))
    carry = F.struct(F.col("__sid").alias("sid"), *carried, *([] if every else program))
    anchored = (anchors.withColumn("__sid", sid).withColumn("__c", carry)
                .select("uid", "line", F.col("exact").alias("__exact"), F.when(~F.col("exact"), F.col("__c")).alias("__c"), F.explode("anchors").alias("a"))
                .withColumn("__j", F.col("a.j")))

    parts: list[DataFrame] = []
    for r in sorted(stats, key=lambda r: (r["how"], r["key"])):
        how, key = r["how"], r["key"]
        mine = [(i, s) for i, (_, s) in enumerate(shapes) if any((a["how"], a["key"]) == (how, key) for a in s["anchors"])]
        tested = bool(mine) or not every
        leaves = {(f["kind"], f["key"]) for _, s in mine for f in s["leaves"]} | others
        rows = anchored.where((F.col("a.how") == how) & (F.col("a.key") == key))
        if not tested:
            rows = rows.withColumn("__c", F.lit(None).cast("boolean"))
        size = 2 * int(r["bytes"])
        small = r["rows"] <= broadcast_rows and size <= broadcast_bytes
        # plan bytes per anchor row turn the byte budget into a row budget
        most_rows = min(broadcast_rows, broadcast_bytes // max(1, size // int(r["rows"])))
        found = _candidates(docs, verifier.needs(leaves), rows, how, key, slots[r["ty"]], sorted(r["lengths"]), r["choice"], r["paired"], small, most_rows)
        if found is None:
            continue
        if tested:
            keep = F.when(F.col("__exact"), F.lit(True))
            for i, s in mine:
                for j in [a["j"] for a in s["anchors"] if (a["how"], a["key"]) == (how, key)]:
                    keep = keep.when((F.col("__c.sid") == i) & (F.col("__j") == j), verifier.compiled(s, j))
            found = found.where(keep.otherwise(F.lit(False) if every else verifier.interpreted(others)))
        parts.append(found.select("line", *docs.columns))
    if told["open"]:
        parts.extend(_unanchored(df, lines.where(F.col("q").isNotNull()), root, slice_size))
    if not parts:
        return df.select(F.lit(None).cast("long").alias(QUERY_NO), *docs.columns).limit(0)
    out = reduce(DataFrame.unionByName, parts)
    if not told["many"]:
        return out.select(F.col("line").cast("long").alias(QUERY_NO), *docs.columns)
    numbers = materialize(_number_sets(numbers), "line-numbers")
    if told["sets"] <= broadcast_rows and 8 * told["many"] + 64 * told["sets"] <= broadcast_bytes:
        # the documents of a line one after the other: its numbers then come as equal runs, which writers pack well (the join by shuffle sorts
        # anyway). A sort right below a join would be optimized away, the always true filter keeps it
        out, numbers = out.sortWithinPartitions("line").where(F.monotonically_increasing_id() >= 0), F.broadcast(numbers)
    # an array of numbers a hit, not a row each: what is shuffled or broadcast does not grow with the result
    return out.join(numbers, "line", "left").select(F.explode(F.coalesce("__numbers", F.array("line"))).alias(QUERY_NO), *docs.columns)


def _unanchored(df: DataFrame, lines: DataFrame, root, slice_size: int) -> list[DataFrame]:
    """Lines that match most documents, compiled on the driver one slice at a time."""
    out, batch = [], []

    def flush():
        if batch:
            part = multi_query(df, [json.loads(q) for _, q in batch], root, query_col="__at")
            mapping = F.element_at(F.array(*[F.lit(n) for n, _ in batch]), F.col("__at").cast("int") + 1)
            out.append(part.select(mapping.cast("long").alias("line"), *[F.col(quote(c)) for c in df.columns]))
            batch.clear()

    for r in lines.select("line", "q").orderBy("line").toLocalIterator():
        batch.append((int(r["line"]), r["q"]))
        if len(batch) >= slice_size:
            flush()
    flush()
    return out
