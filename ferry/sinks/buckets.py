"""A keyed target of hash buckets and deltas (G3, G6 at scale).

Rows live in ``buckets`` hash buckets of their key. A batch is reduced to its last row per key and written
as a *delta* into the buckets that its keys fall into; nothing else is rewritten, so a batch costs its own size. Reads
merge: per key the greatest order value wins, wherever it lies. A bucket with more than ``most_deltas`` deltas is
*compacted*: it alone is read, merged and written as one base.

State is a *manifest* per commit (``_log/<n>.json``): for each bucket the list of folders that hold it. It is
written last and under a new name, so a commit is all or nothing, readers see whole commits, and a replayed batch
(same ``batch_id``) is recognised and does nothing. :meth:`BucketTable.retire` deletes folders that the newest manifest no longer names.
The manifest has one entry per bucket and delta: its size is bounded by ``buckets x (most_deltas + 1)``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dsl import quote
from .upsert import latest_per_key

_BUCKET = "__bucket"


class BucketTable:
    """The target at ``path``: last row per ``key`` by ``order`` (columns; together unique per key)."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: list[str], buckets: int = 64, most_deltas: int = 8):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, list(order)
        self.buckets, self.most_deltas = buckets, most_deltas
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._jvm = jvm

    # ------------------------------------------------------------------ manifests

    def _names(self, folder: str) -> list[str]:
        p = self._Path(f"{self.path}/{folder}")
        return sorted(st.getPath().getName() for st in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def manifest(self) -> dict:
        """The newest commit: ``{"n", "batches", "buckets": {bucket: [folder, ...]}}``."""
        numbers = [int(x[:-5]) for x in self._names("_log") if x.endswith(".json") and x[:-5].isdigit()]
        if not numbers:
            return {"n": 0, "last_batch": None, "count": self.buckets, "buckets": {}}
        stream = self._fs.open(self._Path(f"{self.path}/_log/{max(numbers):012d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        if found["count"] != self.buckets:
            raise ValueError(f"the target has {found['count']} buckets, not {self.buckets}")
        return found

    def _commit(self, now: dict) -> None:
        """Writes the next manifest under a temporary name and renames it; a name that exists means another writer won."""
        now["n"] += 1
        target = self._Path(f"{self.path}/_log/{now['n']:012d}.json")
        if self._fs.exists(target):
            raise RuntimeError(f"commit {now['n']} exists: another writer")
        draft = self._Path(f"{self.path}/_log/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(now, sort_keys=True).encode()))
        out.close()
        if not self._fs.rename(draft, target):
            raise RuntimeError(f"commit {now['n']} failed")

    # ------------------------------------------------------------------ writes

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(F.col(quote(self.key))), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        """Writes rows by bucket into a new folder; the folder and the buckets it holds."""
        folder = f"data/{uuid.uuid4().hex}"
        (self._bucketed(rows).repartition(_BUCKET).write.mode("errorifexists").partitionBy(_BUCKET).parquet(f"{self.path}/{folder}"))
        prefix = f"{_BUCKET}="
        return folder, [int(x[len(prefix):]) for x in self._names(folder) if x.startswith(prefix)]

    def apply(self, batch: DataFrame, batch_id: int | None = None) -> list[int]:
        """Adds a batch; returns the buckets it touched. A batch id that is not newer than the last one committed is a replay."""
        now = self.manifest()
        if batch_id is not None and now["last_batch"] is not None and batch_id <= now["last_batch"]:
            return []
        folder, touched = self._write(latest_per_key(batch, self.key, self.order))
        for b in touched:
            now["buckets"].setdefault(str(b), []).append(folder)
        if batch_id is not None:
            now["last_batch"] = batch_id
        self._commit(now)
        full = [b for b in touched if len(now["buckets"][str(b)]) > self.most_deltas]
        if full:
            self.compact(full)
        return touched

    def compact(self, buckets: list[int] | None = None) -> None:
        """Merges the deltas of the buckets (all by default) into one folder each; other buckets are not read."""
        now = self.manifest()
        which = [b for b in (buckets if buckets is not None else map(int, now["buckets"])) if len(now["buckets"].get(str(b), [])) > 1]
        if not which:
            return
        folder, _ = self._write(latest_per_key(self._stored(now, which), self.key, self.order))
        for b in which:
            now["buckets"][str(b)] = [folder]
        self._commit(now)

    def retire(self) -> list[str]:
        """Deletes the bucket folders that the newest manifest no longer names; returns them. Readers of older commits must be done."""
        now, gone = self.manifest(), []
        named = {(folder, b) for b, folders in now["buckets"].items() for folder in folders}
        prefix = f"{_BUCKET}="
        for name in self._names("data"):
            parts = [x for x in self._names(f"data/{name}") if x.startswith(prefix)]
            old = [x for x in parts if (f"data/{name}", x[len(prefix):]) not in named]
            for x in [""] if len(old) == len(parts) else old:  # whole folders at once where nothing is left
                self._fs.delete(self._Path(f"{self.path}/data/{name}/{x}".rstrip("/")), True)
            gone += [f"data/{name}/{x}" for x in old]
        return gone

    # ------------------------------------------------------------------ reads

    def _stored(self, now: dict, buckets: list[int] | None = None) -> DataFrame:
        chosen = {b: f for b, f in now["buckets"].items() if buckets is None or int(b) in set(buckets)}
        paths = [f"{self.path}/{folder}/{_BUCKET}={b}" for b, folders in sorted(chosen.items()) for folder in folders]
        return self.spark.read.parquet(*paths)

    def read(self) -> DataFrame | None:
        """The last row per key, or None before the first commit."""
        now = self.manifest()
        return latest_per_key(self._stored(now), self.key, self.order) if now["buckets"] else None


def stream_upsert_buckets(rows: DataFrame, table: BucketTable, checkpoint: str) -> BucketTable:
    """Applies a streaming frame to a bucket table, one delta a micro-batch; a replayed batch changes nothing."""
    q = (rows.writeStream.foreachBatch(lambda batch, i: table.apply(batch, i) and None)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return table
