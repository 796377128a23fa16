"""Reading the query language: JSON objects to clause trees and literals.

The one parser of the library. :mod:`.dsl` compiles its trees into a ``Column``, :mod:`.lineplan` plans them for
the joins of a query list. Nothing here needs Spark, so the module can travel with a task.

A tree is made of dicts. ``k`` names the kind: ``all`` (matches everything), ``bool`` (``must``, ``not``, ``should``:
lists of trees; ``wanted``: how many of ``should`` must hold, 0 = they do not filter), and the leaves ``term``, ``terms``,
``range``, ``match``, ``phrase``, ``prefix``, ``wildcard``, ``exists`` (field ``f``) and ``ids``. ``path`` says where the
clause stands, for messages.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import json
import math
import re


class QueryError(ValueError):
    """A query that is not a valid object of the supported clauses."""


# Token rule of the ``match`` clause (lower-cased text split on
# every run of characters that are not letters, digits or underscore).
TOKEN_SPLIT = r"[^\p{L}\p{N}_]+"
_PY_TOKEN_SPLIT = re.compile(r"\W+")

RANGE_OPS = ("gte", "gt", "lte", "lt")
BOOL_KEYS = {"must", "filter", "must_not", "should", "minimum_should_match"}
INTEGRAL_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}
TEMPORAL = ("date", "timestamp", "timestamp_ntz")


def parse_query(query) -> dict | None:
    """Accept a dict, a JSON string or None; return a dict or None (= all)."""
    if query is None:
        return None
    if isinstance(query, (str, bytes)):
        text = query.decode() if isinstance(query, bytes) else query
        if not text.strip():
            return None
        try:
            query = json.loads(text)
        except json.JSONDecodeError as e:
            raise QueryError(f"query is not valid JSON: {e}") from e
    if not isinstance(query, dict):
        raise QueryError("query must be a JSON object")
    return query


def tokens_in_order(text: str) -> list[str]:
    return [t for t in _PY_TOKEN_SPLIT.split(text.lower()) if t]


def match_tokens(text) -> list[str]:
    """Query-side tokens of ``match``: same rule as the column side."""
    return sorted(set(tokens_in_order(str(text))))


# --------------------------------------------------------------------------
# clauses


def clause(q, path: str = "query") -> dict:
    """The tree of one clause object."""
    if not isinstance(q, dict):
        raise QueryError(f"{path}: clause must be an object")
    if len(q) == 0:
        return {"k": "all"}
    if len(q) != 1:
        raise QueryError(f"{path}: a clause object holds exactly one clause, got {sorted(q)}")
    (name, body), = q.items()
    if name not in _READERS:
        raise QueryError(f"unsupported clause '{name}' at {path}")
    return _READERS[name](body, f"{path}.{name}")


def as_list(body, path: str) -> list:
    if isinstance(body, dict):
        return [body]
    if isinstance(body, list):
        return body
    raise QueryError(f"{path}: expected an object or a list of objects")


def single_field(body, path) -> tuple[str, object]:
    if not isinstance(body, dict) or len(body) != 1:
        raise QueryError(f"{path}: expected an object with exactly one field")
    (field, spec), = body.items()
    if not isinstance(field, str) or not field:
        raise QueryError(f"{path}: field name must be a non-empty string")
    return field, spec


def is_scalar(v) -> bool:
    return v is not None and not isinstance(v, (dict, list))


def _bool(body, path) -> dict:
    if not isinstance(body, dict):
        raise QueryError(f"{path}: must be an object")
    unknown = set(body) - BOOL_KEYS
    if unknown:
        raise QueryError(f"unsupported clause '{sorted(unknown)[0]}' at {path}")
    if body.get("filter") == []:
        raise QueryError(f"{path}.filter: needs a clause")

    def group(role):
        return [clause(c, f"{path}.{role}[{i}]") for i, c in enumerate(as_list(body.get(role, []), path))]

    must, nots, should = group("must") + group("filter"), group("must_not"), group("should")
    wanted = _wanted(body.get("minimum_should_match"), len(should), bool(must), path)
    return {"k": "bool", "must": must, "not": nots, "should": should, "wanted": max(0, wanted) if should else 0}


def _wanted(spec, n: int, required: bool, path: str) -> int:
    """How many of ``n`` should clauses must hold: a count, a negative count (so many may fail) or a percentage."""
    if spec is None:
        return 0 if required else 1
    text = str(spec).strip()
    try:
        if isinstance(spec, (bool, float)):
            raise ValueError
        if text.endswith("%"):
            share = int(text[:-1])
            count = n * abs(share) // 100
            return count if share >= 0 else n - count
        count = int(text)
    except ValueError as e:
        raise QueryError(f"{path}.minimum_should_match: not a count or percentage: {spec!r}") from e
    return count if count >= 0 else n + count


def _all(body, path) -> dict:
    if body not in ({}, None):
        raise QueryError(f"{path}: takes no arguments")
    return {"k": "all"}


def _term(body, path) -> dict:
    field, value = single_field(body, path)
    if isinstance(value, dict):
        if set(value) != {"value"}:
            raise QueryError(f"{path}.{field}: term takes 'value' only")
        value = value["value"]
    if not is_scalar(value):
        raise QueryError(f"{path}.{field}: term value must be a scalar")
    return {"k": "term", "f": field, "v": value, "path": f"{path}.{field}"}


def _terms(body, path) -> dict:
    field, values = single_field(body, path)
    if not isinstance(values, list) or not all(is_scalar(v) for v in values):
        raise QueryError(f"{path}.{field}: terms takes a list of scalars")
    return {"k": "terms", "f": field, "vs": values, "path": f"{path}.{field}"}


def _range(body, path) -> dict:
    field, spec = single_field(body, path)
    if not isinstance(spec, dict) or not spec:
        raise QueryError(f"{path}.{field}: range needs at least one of {RANGE_OPS}")
    unknown = set(spec) - set(RANGE_OPS)
    if unknown:
        raise QueryError(f"{path}.{field}: unsupported range key(s) {sorted(unknown)}")
    bounds = {k: v for k, v in spec.items() if v is not None}
    if not bounds:
        raise QueryError(f"{path}.{field}: range needs a non-null bound")
    if not all(is_scalar(v) for v in bounds.values()):
        raise QueryError(f"{path}.{field}: range bounds must be scalars")
    return {"k": "range", "f": field, "b": bounds, "path": f"{path}.{field}"}


def _match(body, path) -> dict:
    field, text = single_field(body, path)
    operator = "or"
    if isinstance(text, dict):
        if set(text) - {"query", "operator"} or "query" not in text:
            raise QueryError(f"{path}.{field}: match takes 'query' and 'operator' only")
        operator = str(text.get("operator", "or")).lower()
        if operator not in ("and", "or"):
            raise QueryError(f"{path}.{field}: operator must be and or or")
        text = text["query"]
    if not is_scalar(text):
        raise QueryError(f"{path}.{field}: match query must be a scalar")
    tokens = [str(text).lower()] if isinstance(text, bool) else match_tokens(text)
    return {"k": "match", "f": field, "v": text, "tokens": tokens, "every": operator == "and" and len(tokens) > 1,
            "path": f"{path}.{field}"}


def _text(kind: str, key: str):
    def read(body, path) -> dict:
        field, spec = single_field(body, path)
        if isinstance(spec, dict):
            if set(spec) != {key}:
                raise QueryError(f"{path}.{field}: takes '{key}' only")
            spec = spec[key]
        elif kind == "wildcard":
            raise QueryError(f"{path}.{field}: wildcard takes an object with 'value'")
        if not isinstance(spec, str):
            raise QueryError(f"{path}.{field}: takes a text")
        return {"k": kind, "f": field, "v": spec, "path": f"{path}.{field}"}
    return read


def _exists(body, path) -> dict:
    if not isinstance(body, dict) or set(body) != {"field"} or not isinstance(body["field"], str):
        raise QueryError(f"{path}: takes 'field' only")
    return {"k": "exists", "f": body["field"], "path": path}


def _ids(body, path) -> dict:
    values = body.get("values") if isinstance(body, dict) and set(body) == {"values"} else None
    if not isinstance(values, list) or not all(is_scalar(v) and not isinstance(v, bool) for v in values):
        raise QueryError(f"{path}: takes a list of ids as 'values'")
    return {"k": "ids", "vs": [str(v) for v in values], "path": path}


_READERS = {"bool": _bool, "match_all": _all, "term": _term, "terms": _terms, "range": _range, "match": _match,
            "match_phrase": _text("phrase", "query"), "prefix": _text("prefix", "value"),
            "wildcard": _text("wildcard", "value"), "exists": _exists, "ids": _ids}


# --------------------------------------------------------------------------
# texts

TOKEN_CHARS = r"\p{L}\p{N}_"


def token_pattern(tokens: list[str]) -> str:
    """Whole-token alternation; tokens hold only token characters (no escaping needed)."""
    return f"(?<![{TOKEN_CHARS}])(?:{'|'.join(tokens)})(?![{TOKEN_CHARS}])"


def phrase_pattern(tokens: list[str]) -> str:
    """The tokens one after the other, whatever other characters stand between them."""
    return token_pattern([f"[^{TOKEN_CHARS}]+".join(tokens)])


def wildcard_parts(wildcard: str) -> list[str]:
    """Runs of literal characters, and ``*`` / ``?`` as one-element tuples between them."""
    out, run, chars = [], [], iter(wildcard)
    for ch in chars:
        if ch in "*?":
            if run:
                out.append("".join(run))
                run = []
            out.append((ch,))
        else:
            run.append(next(chars, ch) if ch == "\\" else ch)
    return [*out, "".join(run)] if run else out


def like_pattern(wildcard: str) -> str:
    """``*`` and ``?`` as SQL wildcards; a backslash takes the next character as it is."""
    def shown(part):
        if isinstance(part, tuple):
            return "%" if part == ("*",) else "_"
        return "".join("\\" + ch if ch in "%_\\" else ch for ch in part)
    return "".join(map(shown, wildcard_parts(wildcard)))


# --------------------------------------------------------------------------
# literals


def variant_type_for(value) -> str:
    """Type used to read a VARIANT field compared with ``value``."""
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "double" if abs(value) <= 1 << 53 else "decimal(38,9)"  # by value: 5.7 is neither 5 nor below it
    if isinstance(value, float):
        return "double"
    return "string"


def fraction_for_integer(value, type_name: str) -> bool:
    """A number with a fraction equals no integer; as a bound it stands for the neighbouring one."""
    return (type_name in INTEGRAL_BITS and isinstance(value, float) and math.isfinite(value)
            and not value.is_integer())


def bound_for(value, type_name: str, op: str):
    """A range bound of an integer field: the next integer (gte, lt) or the previous one (gt, lte)."""
    if fraction_for_integer(value, type_name):
        return math.ceil(value) if op in ("gte", "lt") else math.floor(value)
    return value


def literal_text(value, type_name: str, path: str = "value") -> str:
    """A JSON scalar as the text that a cast turns into the value of the type; ``QueryError`` if it has none."""
    try:
        if type_name == "string":
            return value if isinstance(value, str) else json.dumps(value)
        if type_name == "boolean":
            text = str(value).strip().lower()
            if text in ("true", "false") and isinstance(value, (bool, str)):
                return text
            raise ValueError(f"{value!r} is not a boolean")
        if isinstance(value, bool):
            raise ValueError("boolean for a number or date field")
        if type_name in INTEGRAL_BITS:
            if isinstance(value, float):
                if not value.is_integer():
                    raise ValueError(f"{value} is not integral")
                value = int(value)
            number, bits = int(str(value).strip()), INTEGRAL_BITS[type_name]
            if not -(1 << (bits - 1)) <= number < (1 << (bits - 1)):
                raise ValueError(f"{number} out of range")
            return str(number)
        if type_name in ("float", "double"):
            return repr(float(str(value).strip()) if isinstance(value, str) else float(value))
        if type_name.startswith("decimal"):
            return str(decimal.Decimal(str(value).strip()))
        if type_name in TEMPORAL:
            if isinstance(value, (int, float)):
                # epoch milliseconds, as search stores take them: an instant, or the UTC wall clock where there is no zone
                at = (_dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=value)).isoformat(sep=" ")
                return at + "Z" if type_name == "timestamp" else at[:10] if type_name == "date" else at
            return _dt.datetime.fromisoformat(str(value).strip().replace("Z", "+00:00")).isoformat(sep=" ")
    except (ValueError, decimal.InvalidOperation, OverflowError) as e:
        raise QueryError(f"{path}: cannot use {value!r} for a {type_name} field ({e})") from e
    raise QueryError(f"{path}: fields of type {type_name} cannot be queried")
