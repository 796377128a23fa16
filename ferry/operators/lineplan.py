"""Per-line planning of query lists (a small helper run in tasks).

A line is read by the one parser (:mod:`.clauses`), brought into a canonical form, and flattened into data
that the joins of :mod:`.multiquery` evaluate on the JVM. Lines with equal plans are equal and are answered once.

Canonical form: every literal is the text of its field's typed value, nested bools are flattened, clauses that
cannot filter go, duplicates are folded, ``should`` terms on one field become one ``terms``, children are sorted.

Plan (JSON):

* ``leaves``: kind, field key, type slot, and places of the literals in the line's ``lits`` (one list a type slot),
  ``lists`` (value lists) and ``tokens``;
* ``prog``: the tree in postfix order. ``op`` 0 pushes the truth of leaf ``a``; ``op`` 1 pops ``a`` must, ``b`` must_not
  and ``c`` should values, of which ``w`` must hold, and pushes the bool's truth; ``op`` 2 pushes true;
* ``anchors``: leaves such that every document matching the line matches at least one of them, each with its join
  (``how``: ``value``, ``range``, ``token``, ``rare``: the rarest of its tokens or, of a phrase, of its pairs of neighbouring tokens, ``head`` and ``tail``: the first or last characters, ``gram``: the rarest of its n-grams) and keys;
* ``exact``: the line is one leaf that its join decides;
* ``shape``: the plan without its literals; lines of one shape are verified by one compiled predicate;
* ``q``: the line itself where it has no anchors (it matches most documents).

A line that can match nothing has the plan ``never``.
"""

from __future__ import annotations

import hashlib
import json

from . import clauses as C
from .clauses import RANGE_OPS, QueryError

#: Key of the document id among the field keys (ids clauses), and what parts a field from the type an untyped value is read as.
ID_KEY, AS = "\x1fid", "\x1f"
_NAMES = {"integer": "int", "long": "bigint", "short": "smallint", "byte": "tinyint"}
_RANGED = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")
_COST = {"value": 1, "head": 2, "tail": 2, "rare": 3, "range": 4, "gram": 5, "token": 8}
NEVER, ALL = ["never"], ["all"]
GRAM = 3


def ranged(type_name: str) -> bool:
    """Whether ranges on the type have a join."""
    return type_name in _RANGED or type_name.startswith("decimal")


class Fields:
    """Resolves field names against a schema (its ``jsonValue``), by the rules of the compiler."""

    def __init__(self, schema: dict, has_id: bool):
        self.schema, self.has_id = schema, has_id

    def find(self, field: str, probe, path: str) -> tuple[str, str, bool] | None:
        """(field key, element type, whether a list of values) or None if the schema has no such field."""
        vtype = C.variant_type_for(probe)
        found = self._walk(self.schema, field.split("."), vtype, path)
        if found is None:
            return None
        type_name, is_list, untyped = found
        return (field + AS + vtype if untyped else field), type_name, is_list

    def there(self, field: str) -> bool:
        try:
            return self._walk(self.schema, field.split("."), "string", "") is not None
        except QueryError:
            return True  # an object

    def _walk(self, t, parts, vtype, path):
        if t == "variant":
            return vtype, True, True
        if isinstance(t, dict) and t["type"] == "udt":
            return None
        if isinstance(t, dict) and t["type"] == "array":
            inner = self._walk(t["elementType"], parts, vtype, path)
            return inner and (inner[0], True, inner[2])
        if not parts:
            if isinstance(t, dict):
                raise QueryError(f"{path}: field is an object, not a value")
            return _NAMES.get(t, t), False, False
        if isinstance(t, dict) and t["type"] == "struct":
            by_name = {f["name"]: f["type"] for f in t["fields"]}
            for n in (1, *range(len(parts), 1, -1)):  # a dotted name may be a single column
                if ".".join(parts[:n]) in by_name:
                    return self._walk(by_name[".".join(parts[:n])], parts[n:], vtype, path)
            return None
        if isinstance(t, dict) and t["type"] == "map":
            if t["keyType"] != "string":
                raise QueryError(f"{path}: only string-keyed maps can be addressed")
            return self._walk(t["valueType"], parts[1:], vtype, path)
        return None


def _dump(x) -> str:
    return json.dumps(x, sort_keys=True, ensure_ascii=False)


def _folded(nodes: list) -> list:
    by_text = {_dump(n): n for n in nodes}
    return [by_text[k] for k in sorted(by_text)]


# --------------------------------------------------------------------------
# canonical form: ["all"], ["never"], ["leaf", {...}], ["bool", must, not, should, wanted]


def _leaf(kind, found, **payload):
    return ["leaf", {"kind": kind, "key": found[0], "type": found[1], "list": found[2], **payload}]


def _values(found, values: list[str]):
    values = sorted(set(values))
    if not values:
        return NEVER
    return _leaf("terms", found, vs=values) if len(values) > 1 else _leaf("term", found, v=values[0])


def canonical(node: dict, fields: Fields):
    """The canonical form of a clause tree."""
    kind = node["k"]
    if kind == "all":
        return ALL
    if kind == "bool":
        return _bool([canonical(c, fields) for c in node["must"]], [canonical(c, fields) for c in node["not"]],
                     [canonical(c, fields) for c in node["should"]], node["wanted"])
    if kind == "ids":
        return _values((ID_KEY, "string", False), node["vs"]) if fields.has_id else NEVER
    field, path = node["f"], node["path"]
    if kind == "exists":
        return _leaf("exists", (field, "string", False)) if fields.there(field) else NEVER
    if kind == "terms":
        groups: dict = {}
        for v in node["vs"]:
            found = fields.find(field, v, path)
            if found and not C.fraction_for_integer(v, found[1]):
                groups.setdefault(found, []).append(C.literal_text(v, found[1], path))
        return _bool([], [], [_values(f, vs) for f, vs in groups.items()], 1) if groups else NEVER
    probe = next(iter(node["b"].values())) if kind == "range" else str(node["v"]) if kind == "match" else node["v"]
    found = fields.find(field, probe, path)
    if found is None:
        return NEVER
    if kind == "range":
        bounds = {op: C.literal_text(C.bound_for(v, found[1], op), found[1], f"{path}.{op}") for op, v in node["b"].items()}
        return _leaf("range", found, b=bounds)
    if kind == "term":
        if C.fraction_for_integer(node["v"], found[1]):
            return NEVER
        return _values(found, [C.literal_text(node["v"], found[1], path)])
    if found[1] != "string":
        if kind == "match":  # non-text fields behave like term
            return _values(found, [C.literal_text(node["v"], found[1], path)])
        raise QueryError(f"{path}: {kind} needs a text field, not {found[1]}")
    if kind == "match":
        if not node["tokens"]:
            return NEVER
        return _leaf("every" if node["every"] else "match", found, tokens=node["tokens"])
    if kind == "phrase":
        tokens = C.tokens_in_order(node["v"])
        return _leaf("phrase", found, v=C.phrase_pattern(tokens), tokens=tokens) if tokens else NEVER
    if kind == "wildcard":
        return _leaf("wildcard", found, v=C.like_pattern(node["v"]), parts=[p if isinstance(p, str) else None for p in C.wildcard_parts(node["v"])])
    return _leaf("prefix", found, v=node["v"])


def _bool(must, nots, should, wanted):
    must, nots, should = list(must), list(nots), list(should)
    if wanted:  # clauses that are always or never true
        wanted -= sum(n == ALL for n in should)
        should = [n for n in should if n not in (ALL, NEVER)]
        if wanted > len(should):
            return NEVER
    if wanted <= 0:
        should, wanted = [], 0
    if wanted == 1:
        flat = []
        for n in should:  # an inner bool of should clauses only
            flat += n[3] if n[0] == "bool" and not n[1] and not n[2] and n[4] == 1 else [n]
        values: dict = {}
        for n in flat:
            if n[0] == "leaf" and n[1]["kind"] in ("term", "terms"):
                values.setdefault((n[1]["key"], n[1]["type"], n[1]["list"]), []).extend(n[1].get("vs") or [n[1]["v"]])
        should = _folded([n for n in flat if not (n[0] == "leaf" and n[1]["kind"] in ("term", "terms"))]
                         + [_values(f, vs) for f, vs in values.items()])
    if should and wanted == len(should):
        must, should, wanted = must + should, [], 0
    flat, inner_nots = [], []
    for n in must:
        if n[0] == "bool":
            flat += n[1] + ([["bool", [], [], n[3], n[4]]] if n[3] else [])
            inner_nots += n[2]
        else:
            flat.append(n)
    nots = nots + inner_nots
    flat_nots = []
    for n in nots:  # not (a or b) = not a and not b
        flat_nots += n[3] if n[0] == "bool" and not n[1] and not n[2] and n[4] == 1 else [n]
    if NEVER in flat or ALL in flat_nots:
        return NEVER
    must, nots = _folded([n for n in flat if n != ALL]), _folded([n for n in flat_nots if n != NEVER])
    if not must and not nots and not should:
        return ALL
    if len(must) == 1 and not nots and not should:
        return must[0]
    return ["bool", must, nots, sorted(should, key=_dump), wanted]


# --------------------------------------------------------------------------
# plans


class _Plan:
    def __init__(self, slots: list[str]):
        self.slots, self.leaves, self.prog, self.tokens = slots, [], [], []
        self.lits: list[list[str]] = [[] for _ in slots]
        self.lists: list[list[list[str]]] = [[] for _ in slots]

    def node(self, n):
        """Adds a node's program; returns (cost, [anchor]) or None."""
        if n == ALL:
            self.prog.append({"op": 2, "a": 0, "b": 0, "c": 0, "w": 0})
            return None
        if n[0] == "leaf":
            return self.leaf(n[1])
        must, nots, should = ([self.node(c) for c in group] for group in n[1:4])
        self.prog.append({"op": 1, "a": len(must), "b": len(nots), "c": len(should), "w": n[4]})
        options = [a for a in must if a is not None]
        # who meets w of n clauses meets one of any n - w + 1
        met = sorted((a for a in should if a is not None), key=lambda a: a[0])
        need = len(should) - n[4] + 1
        if should and len(met) >= need:
            options.append((sum(a[0] for a in met[:need]), [x for a in met[:need] for x in a[1]]))
        return min(options, key=lambda a: a[0], default=None)

    def leaf(self, f):
        kind, ty = f["kind"], self.slots.index(f["type"])
        at = len(self.leaves)
        out = {"kind": kind, "key": f["key"], "ty": ty, "a": -1, "li": -1, "t": -1, **{op: -1 for op in RANGE_OPS}}
        anchor = {"j": at, "key": f["key"], "ty": ty, "keys": [], **{op: None for op in RANGE_OPS}}
        how = None

        def literal(text):
            self.lits[ty].append(text)
            return len(self.lits[ty]) - 1

        if "tokens" in f and kind != "phrase":
            out["t"] = len(self.tokens)
            self.tokens.append(f["tokens"])
        if "v" in f:
            out["a"] = literal(f["v"])
        if kind in ("term", "terms"):
            how, anchor["keys"] = "value", f.get("vs") or [f["v"]]
            if kind == "terms":
                out["li"] = len(self.lists[ty])
                self.lists[ty].append(f["vs"])
        elif kind == "range":
            out.update({op: literal(text) for op, text in sorted(f["b"].items())})
            if ranged(f["type"]):
                how = "range"
                anchor.update(f["b"])
        elif kind == "match":
            how, anchor["keys"] = "token", f["tokens"]
        elif kind == "phrase" and len(f["tokens"]) > 1:
            how, anchor["keys"] = "rare", sorted({f"{a} {b}" for a, b in zip(f["tokens"], f["tokens"][1:])})
        elif kind in ("every", "phrase"):
            how, anchor["keys"] = "rare", f["tokens"]
        elif kind == "prefix":
            how, anchor["keys"] = "head", [f["v"]]
        elif kind == "wildcard":
            runs, first, last = [p for p in f["parts"] if p], *(f["parts"][i] if f["parts"] else None for i in (0, -1))
            edge, longest = max(len(first or ""), len(last or "")), max(map(len, runs), default=0)
            if edge and edge >= min(GRAM, longest):  # a short edge meets more values than a longer run inside
                how, anchor["keys"] = ("head", [first]) if len(first or "") == edge else ("tail", [last])
            elif runs:
                n = min(GRAM, longest)
                how, anchor["keys"] = "gram", sorted({p[i: i + n] for p in runs for i in range(len(p) - n + 1)})
        self.leaves.append(out)
        self.prog.append({"op": 0, "a": at, "b": 0, "c": 0, "w": 0})
        if how is None:
            return None
        anchor["how"] = how
        cost = _COST[how] + (len(anchor["keys"]) if how == "token" else 0) + (4 if how == "range" and len(f["b"]) == 1 else 0)
        return cost, [anchor]


#: kinds that their own join decides when they are the whole line
_DECIDED = ("term", "terms", "range", "prefix", "match")


def plan_line(text: str, fields: Fields, slots: list[str]) -> dict:
    """The plan of one query line (JSON text); ``QueryError`` if it is not a valid query."""
    q = json.loads(text)
    if not isinstance(q, dict):
        raise QueryError("query must be a JSON object")
    tree = canonical(C.clause(q), fields)
    if tree == NEVER:
        return {"never": True}
    p = _Plan(slots)
    anchor = p.node(tree)
    if anchor is None:
        return {"q": _dump(q)}
    anchors = sorted(anchor[1], key=lambda a: a["j"])
    if tree[0] == "leaf" and tree[1]["kind"] in _DECIDED:
        return {"exact": True, "anchors": anchors}
    depth = height = 0
    for op in p.prog:
        height += 1 if op["op"] != 1 else 1 - (op["a"] + op["b"] + op["c"])
        depth = max(depth, height)
    shape = {"prog": p.prog, "leaves": p.leaves, "anchors": [{k: a[k] for k in ("j", "how", "key")} for a in anchors]}
    return {"exact": False, "anchors": anchors, "prog": p.prog, "leaves": p.leaves, "depth": depth, "tokens": p.tokens,
            "lits": p.lits, "lists": p.lists, "shape": _dump(shape)}


def plan_batches(schema: dict, has_id: bool, slots: list[str]):
    """``mapInPandas`` body: ``(query_no, q)`` → ``(query_no, same, plan JSON)``; ``same`` is equal for equal lines."""
    def run(batches):
        import pandas as pd

        fields = Fields(schema, has_id)
        for pdf in batches:
            plans = [_dump(plan_line(t, fields, slots)) for t in pdf["q"]]
            same = [hashlib.md5(p.encode()).hexdigest() for p in plans]
            yield pd.DataFrame({"query_no": pdf["query_no"].astype("int64"), "same": same, "plan": plans})
    return run
