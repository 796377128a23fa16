"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Each match of the split pattern is encoded by itself with ordinary (no special)
tokens. A text longer than ``piece_chars`` is first cut at safe places: between a
printable ASCII character and a following blank or line feed. No match of the pattern can
hold a non-space followed by a space, and no look-ahead reaches across such a place,
so the ids of the pieces are the ids of the whole. A match of more than
``merge_chars`` characters without such a place (one endless word) is merged by a heap in
n log n steps, with the same result as repeated lowest-rank merging.

Ids are packed as little-endian unsigned 32-bit integers in one binary column, as
training shards store them; :func:`id_array` unpacks them with SQL functions. Decoding joins the
tokens' raw bytes and returns binary, since a cut sequence need not be valid UTF-8.

Repeated rows: each encoded for itself. Other columns are kept; one that has the name of a result is replaced. Ties between merges: as the
library, the leftmost of the lowest rank. Empty table: empty result. Null or empty text: no ids, empty bytes. An id without a token: the task fails. The rank file (about
1 MB) is read once on the driver and broadcast; its size is checked.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm import textkit as K
from ferry.llm.frames import small_batches

RANK_BYTES_MAX = 64 << 20
PIECE_CHARS = 1 << 17
MERGE_CHARS = 1 << 12


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file (base64 token, blank, rank per line)."""
    with open(path, "rb") as f:
        data = f.read(RANK_BYTES_MAX + 1)
    if len(data) > RANK_BYTES_MAX:
        raise ValueError(f"rank file over {RANK_BYTES_MAX} bytes: {path}")
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def merge_long(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match by lowest-rank-first (leftmost on ties) merging, with a heap over neighbour pairs."""
    n = len(data)
    end = list(range(1, n + 1))  # end of the part that starts here; 0 once merged away
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(data[i: i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, lo, mid, hi = heapq.heappop(heap)
        if end[lo] != mid or mid >= n or end[mid] != hi:
            continue
        end[lo], end[mid] = hi, 0
        if hi < n:
            before[hi] = lo
            if (r := ranks.get(data[lo: end[hi]])) is not None:
                heapq.heappush(heap, (r, lo, hi, end[hi]))
        if (p := before[lo]) >= 0 and (r := ranks.get(data[p: hi])) is not None:
            heapq.heappush(heap, (r, p, lo, hi))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[data[at: end[at]]])
        at = end[at]
    return ids


SAFE = re.compile(r"[!-~](?=[ \n])")


def safe_pieces(text: str, size: int) -> Iterator[str]:
    """The text cut at safe places, in pieces of at least size characters (the last may be shorter)."""
    at = 0
    while len(text) - at > size and (m := SAFE.search(text, at + size)):
        yield text[at: m.end()]
        at = m.end()
    yield text[at:]


class Coder:
    """Encoder and decoder of one task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import tiktoken

        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.endless = re.compile(r"\S{%d}|\s{%d}" % (MERGE_CHARS, MERGE_CHARS))

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in safe_pieces(text, PIECE_CHARS):
            if len(piece) >= MERGE_CHARS and self.endless.search(piece):
                for match in self.pattern.findall(piece):
                    if len(match) >= MERGE_CHARS:
                        data = match.encode()
                        ids += [self.ranks[data]] if data in self.ranks else merge_long(data, self.ranks)
                    else:
                        ids += self.library.encode_ordinary(match)
            else:
                ids += self.library.encode_ordinary(piece)
        return ids

    def decode(self, ids: np.ndarray) -> bytes:
        return self.library.decode_bytes(ids.tolist())


def _with_column(df: DataFrame, drop: str | None, name: str, kind: str):
    """Output schema: the frame's columns without drop, then name."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in (drop, name)]
    return ", ".join([*fields, f"`{name}` {kind}"])


def encode(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
           keep: list[str] | None = None, bytes_col: str | None = None) -> DataFrame:
    """The columns in keep (all others by default) and ids_col: the text's ids, packed. The text column goes.

    With bytes_col, also the raw bytes that the packed ids stand for, decoded in the same pass (as :func:`decode`
    of the result, but with one Python worker and one rank table a task instead of two).
    """
    small_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    keep = [c for c in (df.columns if keep is None else keep) if c not in (text_col, ids_col, bytes_col)]
    plain = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text"))

    def run(batches):
        coder = Coder(ranks.value, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            out = [pa.array([np.asarray(coder.encode(t.as_py() or ""), dtype="<u4").tobytes() for t in texts], pa.binary())]
            if bytes_col:
                out.append(pa.array([coder.decode(np.frombuffer(x.as_py(), dtype="<u4")) for x in out[0]], pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], names=[*batch.schema.names[:-1], *added])

    added = [ids_col, bytes_col] if bytes_col else [ids_col]
    schema = _with_column(plain, "__text", ids_col, "binary") + (f", `{bytes_col}` binary" if bytes_col else "")
    return plain.mapInArrow(K.frugal(run), schema)


def decode(df: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """The frame with bytes_col: the raw bytes that the packed ids stand for (null ids: empty)."""
    small_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    plain = df.drop(bytes_col)
    at = plain.columns.index(ids_col)

    def run(batches):
        coder = Coder(ranks.value, pattern)
        for batch in batches:
            out = [coder.decode(np.frombuffer(x.as_py() or b"", dtype="<u4")) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, bytes_col])

    return plain.mapInArrow(K.frugal(run), _with_column(plain, None, bytes_col, "binary"))


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def id_array(ids: Column) -> Column:
    """Packed ids as array<long>."""
    def number(i):
        four = F.hex(F.substring(ids, i * 4 + 1, F.lit(4)))
        back = F.concat(*[F.substring(four, k, 2) for k in (7, 5, 3, 1)])
        return F.conv(back, 16, 10).cast("long")

    return F.when(F.octet_length(ids) == 0, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(0), (F.octet_length(ids) / 4).cast("int") - 1), number))


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents, encoded and decoded: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode(docs, path, P.PATTERN, bytes_col="decoded")
    return coded.select("doc_id", n_ids(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
