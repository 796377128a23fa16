"""One data transfer as a lazy DataFrame: scan → filter → fields → sort → cap → sink.

This is the whole of a dump run expressed declaratively; Catalyst pushes the
filter and the field list into the scan and plans sort + cap as a top-k.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.dsl import QueryError, apply_query, parse_query
from ..operators.envelope import include_fields
from ..operators.multiquery import QUERY_NO, batch_query, multi_query_cap
from ..operators.order import cap, sort_docs
from ..sources.ndjson import scan_query_list


@dataclass
class Transfer:
    query: object = None          # DSL object / JSON text / None
    fields: object = None         # "a,b" or list
    sort: object = None           # "f:desc,g" or list
    max_docs: int = 0             # 0 = no cap
    tiebreak: object = None       # unique field(s) for a total order
    query_file: str | None = None  # one query per line; exclusive with ``query``

    def check(self) -> None:
        if self.query_file and parse_query(self.query):
            raise QueryError("query and query file are exclusive")
        if self.max_docs < 0:
            raise ValueError("max must be >= 0")


def plan(df: DataFrame, t: Transfer) -> DataFrame:
    """The result documents of one transfer: of a single query, or of each line of a query file in turn.

    A document that several lines match comes once for each; the cap is shared.
    """
    t.check()
    if t.query_file:
        found = batch_query(df, scan_query_list(df.sparkSession, t.query_file))
        return include_fields(multi_query_cap(found, t.max_docs, t.sort, t.tiebreak).drop(QUERY_NO), t.fields)
    out = apply_query(df, t.query)
    if t.max_docs:
        out = cap(out, t.max_docs, t.sort, t.tiebreak)
        return include_fields(out, t.fields)
    out = sort_docs(out, t.sort, t.tiebreak) if t.sort else out
    return include_fields(out, t.fields)
