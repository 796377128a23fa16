"""N-gram Jaccard join by PartEnum signatures, exact for every pair of documents.

A document's set is that of its distinct word n-grams (64-bit hashes; with fewer
words, the whole sequence as one). Two documents link if ``100 * intersection >= percent * union``.

Method. Equal sets are one representative. Two linked sets differ in a bounded number k of
elements, given the sizes in a band. PartEnum splits the domain (by hash) into n1
parts, each into n2 sub-parts. By the pigeonhole principle some part holds at most k2 of the differences, so
leaving out some k2 of its sub-parts leaves equal projections: each set enumerates
these subsets and emits a hash of every projection, salted with the band. Sets whose size reaches into the next
band's range emit signatures there as well, so each linked pair shares a band. (n1, n2, k2) are chosen per
band: the fewest signatures whose projections hold FILL elements on average in its smallest sets.

Sets that share a signature are candidates. Signatures of projections with STRONG or more elements are strong:
sets that share one are mostly alike. Each task that holds a range of strong signatures
emits a forest of its candidates (not pairs); the forests' connected components are
the candidate classes. A class is verified exactly in cells of two blocks of at most
about ``block`` sets (blocks of sizes too far apart never meet), so a large class is spread over tasks and no task holds
it whole. A cell counts all its intersections as one matrix product and emits a forest of the true links and
their number per set; no list of pairs is made. Weak signatures (fewer elements, or an empty
projection) must be heard too, or pairs would be lost, but would chain unrelated sets together. Their groups form no classes:
each is verified by itself in such cells, for links between sets of different classes, unless all its sets are of one class.
Before their sets are fetched, a sketch (elements per bucket, whose distance never exceeds that of the sets) rules out most.

Null or empty text, or no words: empty set, linked with nothing, its own component. Rows with equal
doc_id count as documents of their own with one id. Null doc_id: n_shingles is given, component_id is null. Very long texts: one
set each, read whole. Ties: a component's id is its smallest doc_id. Other columns, whatever their names: ignored. Empty table: empty result.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm import textkit as K
from ferry.llm.frames import components, narrowed, split_by_ids, stored

U = np.uint64
BAND_RATIO = 1.3
FILL = 3.5
STRONG = 4


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, gram: int, cache: dict):
    """Row, element (sorted by both, distinct), set size per row and set id per row of a chunk."""
    words = K.Words(K.LOWER[buf], offsets, cache)
    rows = len(offsets) - 1
    ranges = K.Ranges(words.hash, cache)
    first = np.arange(max(0, len(words.start) - gram + 1))
    first = first[words.doc[first] == words.doc[first + gram - 1]] if len(first) else first
    few = np.flatnonzero((words.count > 0) & (words.count < gram))
    row = np.concatenate([words.doc[first], few])
    element = np.concatenate([ranges.at(first, first + gram) + U(gram),
                              ranges.at(words.first[few], words.first[few + 1]) + words.count[few].astype(U)])
    order = np.lexsort((element, row))
    row, element = row[order], element[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (element[1:] != element[:-1])
    row, element = row[new], element[new]
    size = np.bincount(row, minlength=rows)
    sums = np.concatenate([np.zeros(1, U), np.cumsum(K.mix(element ^ U(0xA5A5)), dtype=U)])
    ends = np.cumsum(size)
    return row, element, size, K.mix(sums[ends] - sums[ends - size] + U(11) * size.astype(U))


def sketches(row: np.ndarray, element: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Per row, how many elements (at most 255) have each prefix of 7 bits, and of one bit more for each doubling beyond 800 elements."""
    bits = 7 + np.maximum(0, np.ceil(np.log2(np.maximum(size, 1) / 800))).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(1 << bits)])
    at = first[row] + (element >> (64 - bits[row]).astype(U)).astype(np.int64)
    count = np.minimum(np.bincount(at, minlength=int(first[-1])), 255).astype(np.uint8)
    return [count[x:y].tobytes() for x, y in zip(first.tolist(), first[1:].tolist())]


def bands(percent: int, largest: int) -> list[tuple[int, int, int, int, int]]:
    """(smallest size of its larger sets, largest, n1, n2, k2) of each band up to the given size."""
    out, lo = [], 1
    while lo <= largest:
        hi = max(lo, int(lo * BAND_RATIO))
        k = 2 * hi * (100 - percent) // (100 + percent)
        least = -(-lo * percent // 100)
        options = []
        for k2 in range(1, min(k, 3) + 1):
            n1 = -(-(k + 1) // (k2 + 1))
            for n2 in range(k2 + 2, k2 + 4):
                fill = least * (n2 - k2) / (n1 * n2)
                options.append((fill < FILL, n1 * comb(n2, k2) if fill >= FILL else -fill, n1, n2, k2))
        out.append((lo, hi, *min(options)[2:]) if k else (lo, hi, 0, 0, 0))
        lo = hi + 1
    return out


def signatures(row, element, size, percent: int):
    """(row, signature) pairs of a chunk's sets; the lowest bit marks a weak signature."""
    largest = int(size.max()) if len(size) else 0
    out_row, out_sig = [], []
    ends = np.cumsum(size)
    for number, (lo, hi, n1, n2, k2) in enumerate(bands(percent, largest * 100 // percent + 2)):
        mine = np.flatnonzero((size > 0) & (size <= hi) & (100 * size >= percent * lo))
        if not len(mine) or not n1:
            continue
        count = size[mine]
        at = np.repeat(ends[mine] - np.cumsum(count), count) + np.arange(int(count.sum()))
        local = np.repeat(np.arange(len(mine)), count)
        salted = K.mix(element[at] + U(number * 2 + 1))
        cell = local * (n1 * n2) + (salted % U(n1 * n2)).astype(np.int64)
        sums = np.zeros(len(mine) * n1 * n2, dtype=U)
        np.add.at(sums, cell, K.mix(salted))
        held = np.bincount(cell, minlength=len(sums)).reshape(len(mine), n1, n2)
        sums = sums.reshape(len(mine), n1, n2)
        total, all_held = sums.sum(axis=2, dtype=U), held.sum(axis=2)
        part = np.arange(n1, dtype=U)[None, :]
        for s, left_out in enumerate(combinations(range(n2), k2)):
            sig, there = total.copy(), all_held.copy()
            for x in left_out:
                sig -= sums[:, :, x]
                there -= held[:, :, x]
            sig = K.mix(sig + K.mix((part << U(20)) + U((number << 8) + s)))
            out_row.append(np.broadcast_to(mine[:, None], sig.shape).ravel())
            out_sig.append(((sig & ~U(1)) | (there < STRONG).astype(U)).ravel())
    if not out_row:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U)
    return np.concatenate(out_row), np.concatenate(out_sig)


def _emit_sets(gram: int):
    def run(batches):
        cache: dict = {}
        for batch in batches:
            for lo, hi, buf, offsets in K.text_chunks(batch.column("text")):
                row, element, size, sid = shingle_sets(buf, offsets, gram, cache)
                sketch = sketches(row, element, size)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), K.long_array(size), K.long_array(sid),
                                                  pa.array(sketch, pa.binary())], names=["doc_id", "n", "sid", "sketch"])
    return run


def _emit_signatures(gram: int, percent: int):
    def run(batches):
        cache: dict = {}
        seen: set[int] = set()  # a set sends its signatures once a task, however many rows hold it
        for batch in batches:
            for _, _, buf, offsets in K.text_chunks(batch.column("text")):
                row, element, size, sid = shingle_sets(buf, offsets, gram, cache)
                rows, sig = signatures(row, element, size, percent)
                fresh = np.zeros(len(sid), dtype=bool)
                different, at = np.unique(sid, return_index=True)
                fresh[[i for s, i in zip(different.tolist(), at.tolist()) if s not in seen]] = True
                seen.update(different.tolist())
                rows, sig = rows[fresh[rows]], sig[fresh[rows]]
                yield pa.RecordBatch.from_arrays([K.long_array(sig), K.long_array(sid[rows])], names=["sig", "sid"])
    return run


def _emit_forest(batches):
    """Edges u, v that connect, within this partition, the sets that share a strong signature (weak 0), and the sets v of
    each weak signature u that several sets share (weak 1)."""
    parts = [(b.column("sig").to_numpy(), b.column("sid").to_numpy()) for b in batches]
    if not parts:
        return
    sig, sid = (np.concatenate(x) for x in zip(*parts))
    del parts
    order = np.argsort(sig, kind="stable")
    sig, sid = sig[order], sid[order]
    new = np.ones(len(sig), dtype=bool)
    new[1:] = sig[1:] != sig[:-1]
    group = np.cumsum(new) - 1
    head = sid[new][group]
    edge = head != sid
    shared = np.zeros(int(new.sum()), dtype=bool)
    shared[group[edge]] = True
    weak = shared[group] & (sig & 1 == 1)
    members = np.unique(np.stack([sig[weak], sid[weak]], axis=1), axis=0)
    edge &= sig & 1 == 0
    pairs = np.unique(np.stack([head[edge], sid[edge]], axis=1), axis=0)
    nodes, at = np.unique(pairs, return_inverse=True)
    roots = forest_roots(len(nodes), at.reshape(-1, 2))
    some = roots != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([nodes[some], members[:, 0]])), pa.array(np.concatenate([nodes[roots[some]], members[:, 1]])),
         pa.array(np.repeat([0, 1], [int(some.sum()), len(members)]).astype(np.int32))], names=["u", "v", "weak"])


def forest_roots(n: int, edges: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component, by union-find."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges.tolist():
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.array([find(x) for x in range(n)], dtype=np.int64)


def _emit_cells(gram: int):
    """The set of each wanted row, once for each cell it belongs to."""
    def run(batches):
        cache: dict = {}
        for batch in batches:
            cells = batch.column("cells")
            wanted = batch.column("wanted").to_numpy()
            for lo, hi, buf, offsets in K.text_chunks(batch.column("text")):
                _, element, size, sid = shingle_sets(buf, offsets, gram, cache)
                ends = np.cumsum(size)
                for i in np.flatnonzero(sid.view(np.int64) == wanted[lo:hi]):
                    mine = cells.slice(lo + int(i), 1).flatten()
                    n = len(mine)
                    data = element[ends[i] - size[i]: ends[i]].tobytes()
                    yield pa.RecordBatch.from_arrays(
                        [mine.field("cell"), mine.field("side"), pa.array(np.full(n, wanted[lo + i])),
                         batch.column("copies").take(pa.array(np.full(n, lo + i))), pa.array([data] * n, pa.binary()),
                         batch.column("component").take(pa.array(np.full(n, lo + i)))],
                        names=["cell", "side", "sid", "copies", "elements", "component"])
    return run


def cell_links(side: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of a cell link; sides 0 and 1 are two blocks, side 2 alone is one block with itself."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), size)
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[at] > 1
    column = np.cumsum(times > 1) - 1
    owner, at = owner[shared], column[at[shared]]
    both = np.zeros((n, n), dtype=np.int64)
    width = int(at.max()) + 1 if len(at) else 0
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for lo in range(0, width, 4096):
        a, b = np.searchsorted(at, [lo, lo + 4096])
        m = np.zeros((n, min(4096, width - lo)), dtype=np.float32)
        m[owner[a:b], at[a:b] - lo] = 1
        both += (m @ m.T).astype(np.int64)
    link = (100 + percent) * both >= percent * (size[:, None] + size[None, :])
    link &= (side[:, None] != side[None, :]) | (side[:, None] == 2)
    np.fill_diagonal(link, False)
    return link


def link_forest(link: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component."""
    n = len(link)
    label = np.arange(n)
    while True:
        low = np.minimum(label, np.where(link, label[None, :], n).min(axis=1))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _screen(percent: int):
    """Of each cell of a weak group, the sets whose sketch lets them link with some set of another class."""
    def run(batches):
        def flush():
            name, side, sid, n, sketch, own = zip(*held.values())
            side, n, own = np.array(side), np.array(n, dtype=np.int64), np.array(own)
            width = min(map(len, sketch))  # longer sketches are folded: sums of counts keep the bound
            counts = np.stack([np.frombuffer(x, dtype=np.uint8).astype(np.int32).reshape(width, -1).sum(axis=1) for x in sketch])
            for i in range(len(n)):  # the sketches' distance is at most that of the sets
                far = np.abs(counts - counts[i]).sum(axis=1)
                may = ((100 + percent) * far <= (100 - percent) * (n + n[i])) & (own != own[i])
                if (may & ((side != side[i]) | (side == 2))).any():
                    out.append((name[i], int(side[i]), sid[i]))

        held: dict[int, tuple] = {}
        cell, out = None, []
        for batch in batches:
            for r in zip(*[batch.column(c).to_pylist() for c in ("cell", "side", "sid", "n", "sketch", "own")]):
                if cell != r[0]:
                    if len(held) > 1:
                        flush()
                    held, cell = {}, r[0]
                held[r[2]] = r
        if len(held) > 1:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64()))],
                                         names=["cell", "side", "sid"])
    return run


def _verify(percent: int):
    def run(batches):
        held: dict[int, tuple] = {}  # by set: a repeated row brings its set twice
        cell = None

        def flush():
            if len(held) < 2:
                return None
            name, side, sid, copies, data, component = zip(*held.values())
            sid, copies = np.array(sid, dtype=np.int64), np.array(copies, dtype=np.int64)
            link = cell_links(np.array(side), [np.frombuffer(d, dtype=U) for d in data], percent)
            if name[0][0] == "w":  # links between classes, one by one: several weak signatures may lead to the same one
                own = np.array([x if x is not None else i for i, x in zip(sid.tolist(), component)], dtype=np.int64)
                a, b = np.nonzero(link & (own[:, None] != own[None, :]))
                return sid[a], sid[b], copies[b], np.ones(len(a), dtype=np.int32)
            label, links = link_forest(link), link @ copies
            edge, some = label != np.arange(len(sid)), links > 0
            u, v = np.concatenate([sid[edge], sid[some]]), np.concatenate([sid[label[edge]], sid[some]])
            return u, v, np.concatenate([np.zeros(int(edge.sum()), dtype=np.int64), links[some]]), np.zeros(len(u), dtype=np.int32)

        ready = []
        for batch in batches:
            columns = [batch.column(c) for c in ("cell", "side", "sid", "copies", "elements", "component")]
            for r in zip(*[c.to_pylist() for c in columns]):
                if cell != r[0]:
                    ready.append(flush())
                    held.clear()
                    cell = r[0]
                held[r[2]] = r
            ready = [x for x in ready if x is not None]
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*ready)], names=["u", "v", "links", "weak"])
                ready = []
        last = flush()
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in last], names=["u", "v", "links", "weak"])
    return run


def jaccard_classes(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", gram: int = 4, percent: int = 85,
                    block: int = 256) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), n_links (documents linked), one row per input row."""
    if not 50 < percent <= 100 or gram < 1:
        raise ValueError("percent must be in 51..100, gram at least 1")
    plain = narrowed(docs, doc_id=doc_col, text=text_col)
    sized = stored(plain.mapInArrow(K.frugal(_emit_sets(gram)), "doc_id long, n long, sid long, sketch binary"), "sets")
    distinct = sized.where("n > 0").groupBy("sid", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                             F.first("sketch").alias("sketch"))
    distinct = stored(distinct, "distinct")
    sigs = plain.mapInArrow(K.frugal(_emit_signatures(gram, percent)), "sig long, sid long")
    forest = stored(sigs.repartition("sig").mapInArrow(K.frugal(_emit_forest), "u long, v long, weak int"), "candidates")
    classes = stored(components(forest.where("weak = 0").select("u", "v"), "classes").withColumnRenamed("node", "sid"), "classes")

    # cells: a class in blocks by size class and hash; neighbouring size classes meet
    step = float(np.log(100 / percent)) if percent < 100 else 1.0
    member = (distinct.join(classes, "sid")
              .withColumn("sc", F.floor(F.log(F.col("n").cast("double")) / step).cast("int")))
    in_class = member.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    in_size = member.groupBy("component", "sc").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    spread = in_size.groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("sc", "blocks"))).alias("blocks"))
    member = member.join(in_class, "component").join(spread, "component")

    def n_blocks(sc):
        return F.coalesce(F.col("blocks")[sc], F.lit(0))

    def cells(lo_sc, lo_block, hi_sc, hi_block, side):
        name = F.concat_ws("/", F.col("component").cast("string"), lo_sc, lo_block, hi_sc, hi_block)
        return F.struct(name.alias("cell"), side.cast("int").alias("side"))

    def places(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    sc, mine = F.col("sc"), F.pmod(F.xxhash64("sid"), n_blocks(F.col("sc")).cast("long")).cast("int")
    own = F.transform(places(n_blocks(sc)), lambda b: cells(sc, F.least(b, mine), sc, F.greatest(b, mine),
                                                            F.when(b == mine, 2).when(mine < b, 0).otherwise(1)))
    up = F.transform(places(n_blocks(sc + 1)), lambda b: cells(sc, mine, sc + 1, b, F.lit(0)))
    down = F.transform(places(n_blocks(sc - 1)), lambda b: cells(sc - 1, b, sc, mine, F.lit(1)))
    whole = F.array(F.struct(F.col("component").cast("string").alias("cell"), F.lit(2).cast("int").alias("side")))
    strong = member.select("sid", F.when(F.col("members") <= block, whole).otherwise(F.concat(own, up, down)).alias("cells"))

    # weak groups that reach over several classes, each in blocks by hash
    crowd = forest.where("weak = 1").select(F.col("u").alias("sig"), F.col("v").alias("sid")).join(classes, "sid", "left")
    own_class = F.coalesce("component", "sid")
    wide = (crowd.groupBy("sig").agg(F.min(own_class).alias("a"), F.max(own_class).alias("z"),
                                     F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts")).where("a <> z"))
    at = F.pmod(F.xxhash64("sid"), F.col("parts").cast("long")).cast("int")
    several = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda b: F.struct(
        F.concat_ws("/", F.lit("w"), F.col("sig").cast("string"), F.least(b, at), F.greatest(b, at)).alias("cell"),
        F.when(b == at, 2).when(at < b, 0).otherwise(1).cast("int").alias("side")))
    seats = (crowd.withColumn("own", own_class).join(wide, "sig").select("sid", "own", F.explode(several).alias("c"))
             .join(distinct.select("sid", "n", "sketch"), "sid").select("c.cell", "c.side", "sid", "n", "sketch", "own"))
    weak = (seats.repartition("cell").sortWithinPartitions("cell").mapInArrow(K.frugal(_screen(percent)), "cell string, side int, sid long")
            .select("sid", F.array(F.struct("cell", "side")).alias("cells")))
    wanted = (strong.union(weak).groupBy("sid").agg(F.flatten(F.collect_list("cells")).alias("cells"))
              .join(distinct, "sid").join(classes, "sid", "left")
              .select(F.col("rep").alias("doc_id"), F.col("sid").alias("wanted"), "copies", "component", "cells"))
    wanted = stored(wanted, "wanted")
    held = (split_by_ids(plain, wanted)[0].join(wanted, "doc_id")
            .mapInArrow(K.frugal(_emit_cells(gram)), "cell string, side int, sid long, copies long, elements binary, component long"))
    links = stored(held.repartition("cell").sortWithinPartitions("cell")
                   .mapInArrow(K.frugal(_verify(percent)), "u long, v long, links long, weak int"), "links")
    links = links.where("weak = 0").union(links.where("weak = 1").distinct())

    joined = components(links.where("u <> v").select("u", "v"), "components").withColumnRenamed("node", "sid")
    least = (joined.join(distinct, "sid").groupBy("component").agg(F.min("rep").alias("least")))
    of_set = (distinct.join(joined.join(least, "component").select("sid", "least"), "sid", "left")
              .join(links.where("links > 0").groupBy(F.col("u").alias("sid")).agg(F.sum("links").alias("links")), "sid", "left")
              .select("sid", F.coalesce("least", "rep").alias("least"),
                      (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    out = sized.drop("sketch").join(of_set, "sid", "left")
    empty = F.col("n") == 0
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNull() | empty, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
                      F.when(empty, 0).otherwise(F.col("links")).cast("long").alias("n_links"))


def op3_partenum(spark, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_shingles, component_id, n_links."""
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
