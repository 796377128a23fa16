"""Queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from ferry.llm.op1_decontaminate import op1_decontaminate
from ferry.llm.op2_bpe import op2_bpe
from ferry.llm.op3_partenum import op3_partenum
from ferry.llm.op4_chat import OP4_SQL, op4_chat
from ferry.llm.op5_secrets import op5_secrets
from ferry.llm.op6_shards import op6_shards
from ferry.llm.op7_chains import op7_chains
from ferry.llm.op8_recompression import op8_recompression
from ferry.llm.op9_outliers import op9_outliers
from ferry.llm.op10_buckets import op10_buckets
from ferry.llm.op11_repair import OP11_SQL, op11_repair
from ferry.llm.op12_phrases import OP12_SQL, op12_phrases
from ferry.llm.op13_mixing import OP13_SQL, op13_mixing

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_bpe": op2_bpe,
    "op3_partenum": op3_partenum,
    "op4_chat": op4_chat,
    "op5_secrets": op5_secrets,
    "op6_shards": op6_shards,
    "op7_chains": op7_chains,
    "op8_recompression": op8_recompression,
    "op9_outliers": op9_outliers,
    "op10_buckets": op10_buckets,
    "op11_repair": op11_repair,
    "op12_phrases": op12_phrases,
    "op13_mixing": op13_mixing,
}

ORACLE: dict[str, str] = {
    "op4_chat": OP4_SQL,
    "op11_repair": OP11_SQL,
    "op12_phrases": OP12_SQL,
    "op13_mixing": OP13_SQL,
}
