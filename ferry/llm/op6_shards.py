"""Sharding by minimax contiguous partition of ordered atomic groups.

Method. Rows with equal texts form an atomic group; groups stand in the order of the
text's 64-bit hash. The hash range is cut into 65,536 intervals, and one aggregate
gives each interval's size and rows. On that table the smallest feasible shard capacity is found by binary search, each candidate checked
greedily (fill a shard up to the capacity, open the next). Intervals in which a shard of a smaller capacity could end are then cut up
further, down to single groups where needed, and the search runs again, until a smaller capacity is impossible: the capacity is the
smallest for the groups themselves, whatever their number. The cut then follows that capacity, but never fills a
shard beyond an even share of what is left when the rest still fits, so one group larger than an even share
does not leave the last shards empty. Intervals are assigned to shards through the small table.

No shard exceeds the capacity, none differs from another by more than that lets it.

A row's slot is its place in its shard: intervals in order, rows of an interval numbered by
doc_id. An interval with many rows (one large group) is numbered in parts by a hash of the row,
so no task numbers more than about ``part_rows`` rows of one interval.

Null text: size 16, all null texts are one group, text_crc32 of an empty text. Null or repeated doc_ids: numbered among
themselves in the order of the stored table; slots stay gapless. Very long texts: a group like any other, of its size. Empty table: empty result.
Other columns, whatever their names: ignored, and kept by ``write_shards``. Everything runs on built-in functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.frames import narrowed, stored


def shards_needed(sizes: list[int], capacity: int) -> int:
    """Shards that a greedy fill opens; more than len(sizes) if one size exceeds the capacity."""
    count, room = 0, 0
    for s in sizes:
        if s > capacity:
            return len(sizes) + 1
        if s > room:
            count, room = count + 1, capacity
        room -= s
    return count


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The smallest capacity for which the ordered sizes fit into so many contiguous shards."""
    lo, hi = max([0, *sizes, -(-sum(sizes) // shards)]), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        if shards_needed(sizes, mid) <= shards:
            hi = mid
        else:
            lo = mid + 1
    return lo


def minimax_cut(sizes: list[int], shards: int) -> list[int]:
    """Shard of each ordered size: contiguous, no shard beyond the smallest capacity, sizes near equal within that."""
    capacity = smallest_capacity(sizes, shards)
    # fits[i]: shards that a greedy fill of sizes[i:] needs, by jumps from the right
    n = len(sizes)
    fits, end, total = [0] * (n + 1), n, 0
    for i in range(n - 1, -1, -1):
        total += sizes[i]
        while total > capacity:
            end -= 1
            total -= sizes[end]
        fits[i] = 1 + fits[end]
    out, shard, held, left = [], 0, 0, sum(sizes)
    for i, s in enumerate(sizes):
        share = (held + left) / (shards - shard)
        over = held + s - share
        if shard + 1 < shards and held and (held + s > capacity or over > share - held) and fits[i] <= shards - shard - 1:
            shard, held = shard + 1, 0
        held, left = held + s, left - s
        out.append(shard)
    return out


BITS, SPLIT_BITS = 16, 10


class Cut:
    """The cut of the hash range: intervals of hashes in order, each with its shard.

    Intervals are named by level and prefix: level 0 has the first BITS bits of a hash, every further level SPLIT_BITS
    more. The search runs on whole intervals, and again with those intervals cut up (one level deeper) in which a
    shard could end if they were divisible. It stops when that gains nothing: then the capacity is the smallest for the groups themselves,
    although only intervals at the cuts were ever looked into. A round brings shards * 2**SPLIT_BITS rows at most to the driver.
    """

    def __init__(self, rows: DataFrame, shards: int, bits: int = BITS, split_bits: int = SPLIT_BITS):
        """rows: place (the hash; signed, as the order of the groups is) and size."""
        self.shards, self.bits, self.split_bits = shards, bits, split_bits
        table = self._sums(rows, 0, None)
        while True:
            self.items = sorted(table, key=lambda r: r[0] << (64 - self.bits_at(r[1])))
            sizes = [r[2] for r in self.items]
            self.shard_of = minimax_cut(sizes, shards)
            split = self._ends_inside(sizes)
            if not split:
                return
            gone = {(self.items[i][0], self.items[i][1]) for i in split}
            table = [r for r in table if (r[0], r[1]) not in gone]
            for level in sorted({level for _, level in gone}):
                table += self._sums(rows, level + 1, [p for p, at in gone if at == level])

    def bits_at(self, level: int) -> int:
        return min(64, self.bits + level * self.split_bits)

    def prefix(self, level: int):
        """Column: the interval of a row's place at a level."""
        return F.shiftright("place", 64 - self.bits_at(level))

    def _sums(self, rows: DataFrame, level: int, inside: list[int] | None) -> list[tuple]:
        """(prefix, level, size, rows, whether it is one group) of the intervals of a level, of all or of those inside some of the level before."""
        if inside is not None:
            within = rows.sparkSession.createDataFrame([(p,) for p in inside], "inside long")
            rows = rows.withColumn("inside", self.prefix(level - 1)).join(F.broadcast(within), "inside", "left_semi")
        found = (rows.groupBy(self.prefix(level).alias("prefix"))
                 .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("place").alias("a"), F.max("place").alias("z")).collect())
        return [(r["prefix"], level, r["bytes"], r["n"], r["a"] == r["z"]) for r in found]

    def _ends_inside(self, sizes: list[int]) -> set[int]:
        """Divisible intervals in which shards of the least thinkable capacity, or of the next smaller than the one found, end."""
        found = smallest_capacity(sizes, self.shards)
        atom = [r[4] for r in self.items]
        lo, hi, ends = max([0, *(s for s, a in zip(sizes, atom) if a), -(-sum(sizes) // self.shards)]), found, set()
        while lo < hi:  # the least capacity if the other intervals could be divided anywhere
            mid = (lo + hi) // 2
            if self._fits_divided(sizes, atom, mid, None):
                hi = mid
            else:
                lo = mid + 1
        if lo < found:
            self._fits_divided(sizes, atom, lo, ends)
        return ends

    def _fits_divided(self, sizes, atom, capacity, ends: set[int] | None) -> bool:
        count, room = 0, 0
        for i, (s, whole) in enumerate(zip(sizes, atom)):
            if s <= room:
                room -= s
                continue
            if whole:
                if s > capacity:
                    return False
                count, room = count + 1, capacity - s
                continue
            if ends is not None:
                ends.add(i)
            s -= room
            more = -(-s // capacity)
            count, room = count + more, more * capacity - s
        return count <= self.shards

    def placed(self, rows: DataFrame, part_rows: int) -> DataFrame:
        """rows with item (number of the interval), shard, before (rows of the shard ahead of the interval) and parts."""
        out, shard, before = [], -1, 0
        for i, ((prefix, level, _, n, _), to) in enumerate(zip(self.items, self.shard_of)):
            shard, before = to, before if to == shard else 0
            out.append((prefix, level, i, to, before, -(-n // part_rows)))
            before += n
        names = ("item", "shard", "before", "parts")
        schema = "prefix long, level int, item int, shard int, before long, parts int"
        table = rows.sparkSession.createDataFrame(out, schema)
        for level in sorted({r[1] for r in self.items}):
            mine = table.where(F.col("level") == level).select(F.col("prefix").alias("__prefix"), F.struct(*names).alias(f"__at{level}"))
            rows = rows.withColumn("__prefix", self.prefix(level)).join(F.broadcast(mine), "__prefix", "left").drop("__prefix")
        at = [f"__at{level}" for level in sorted({r[1] for r in self.items})]
        if not at:
            return rows.select("*", *[F.lit(None).cast(t).alias(n) for n, t in zip(names, ("int", "int", "long", "int"))])
        return rows.withColumn("__at", F.coalesce(*at)).select(*[c for c in rows.columns if c not in at], *[F.col(f"__at.{n}").alias(n) for n in names])


def assign_shards(docs: DataFrame, shards: int = 40, doc_col: str = "doc_id", text_col: str = "text",
                  part_rows: int = 20000, bits: int = BITS, split_bits: int = SPLIT_BITS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, one row per input row."""
    rows = stored(_sized(narrowed(docs, doc_id=doc_col, text=text_col), "text"), "sizes")
    placed = (Cut(rows, shards, bits, split_bits).placed(rows, part_rows)
              .withColumn("part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("doc_id", "own"), F.col("parts"))).otherwise(0).cast("int")))
    parts = placed.where("parts > 1").groupBy("item", "part").agg(F.count(F.lit(1)).alias("n"))
    ahead = parts.select("item", "part", (F.sum("n").over(Window.partitionBy("item").orderBy("part")) - F.col("n")).alias("ahead"))
    number = F.row_number().over(Window.partitionBy("item", "part").orderBy("doc_id", "own")) - 1
    return (placed.join(ahead, ["item", "part"], "left")
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("before") + F.coalesce("ahead", F.lit(0)) + number).cast("long").alias("slot")))


def _sized(rows: DataFrame, text_col: str) -> DataFrame:
    """rows with doc_id and a text: doc_id, size, text_crc32, place, own (tells apart rows of one doc_id in the stored table)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return rows.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.xxhash64(F.col(f"`{text_col}`")).alias("place"), F.monotonically_increasing_id().alias("own"))


def write_shards(docs: DataFrame, path: str, shards: int = 40, text_col: str = "text", shard_col: str = "shard", bits: int = BITS,
                 split_bits: int = SPLIT_BITS) -> None:
    """The documents, every row once and with all columns, as Parquet folders shard_col=<n>.

    A row's shard follows from its text alone, so no join on ids is needed and ids may repeat or be null. A column that
    has the name of shard_col is refused.
    """
    if shard_col in docs.columns:
        raise ValueError(f"column {shard_col!r} exists; choose another shard_col")
    text = F.col(f"`{text_col}`")
    narrow = stored(docs.select((F.octet_length(F.coalesce(text, F.lit(""))) + 16).cast("long").alias("size"), F.xxhash64(text).alias("place")), "sizes")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(text).alias("place"))
    placed = Cut(narrow, shards, bits, split_bits).placed(whole, 1)
    placed.select("row.*", F.col("shard").alias(shard_col)).write.partitionBy(shard_col).mode("errorifexists").parquet(path)


def op6_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards: doc_id, size, text_crc32, law ("bytes"), shard, slot, grown_shard (null)."""
    placed = assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
