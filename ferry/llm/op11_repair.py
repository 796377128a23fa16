"""Conversation structure repair by Wagner-Fischer alignment with the alternating grammar.

The turns of a conversation are edited, at least cost, into ``(s?(ua)+)?``: an optional system turn, then user and assistant
turns in alternation, or nothing. Keep costs 0, Rerole (to user or assistant) 1, Delete 2 (required for blank and
duplicate turns), Insert (an empty user or assistant turn) 5; a truncated turn that is not deleted costs 5 more. A role counts by its first character.

Method. For each feasible length of the grammar string the turns are aligned with that string by the Wagner-Fischer
table. Strings of all lengths that end alike share their ends, so one table from the end backwards serves them all.
Ukkonen: only cells are filled from which the difference of the remaining lengths (5 an insertion, 2 a deletion) does not
exceed an incumbent cost, which is doubled until no wanted cost lies above it. From every length of least cost the
audit (the edits' initials) is traced through its table, always by the ASCII-least edit that keeps the cost, and
the audits are compared as texts: the least one is the result.

A conversation of any length is cut into blocks of at most ``BLOCK`` turns. A block is aligned once for each grammar state before and after
it; an insertion belongs to the turn that follows, so audits of a block cannot be prefixes of each other and the least audit
of the whole is made of least audits of blocks. Costs to go pass over the blocks backwards, the chosen states forwards: two sorted
streams of a few numbers a block. No task holds a conversation, and blocks with equal initials and faults
are aligned once a task (bounded cache).

Faults. Each turn's first one counts: blank (nothing but spaces and \\x09-\\x0D), duplicate (role and text seen earlier in
the conversation, at a smaller turn or as an identical row of the same turn), truncated (last other character not ``.!?``).
Turns stand by turn number, nulls first, ties by role, then by the text's md5. Null roles and texts count as one
space, a null conversation id as a conversation of its own. Repeated rows: one turn each, all but the first duplicates
(they are combined before any shuffle by order). Empty table: empty results. Other columns, whatever their names: ignored.
Texts are read in two places only: for their digest at the start and at the end for those turns that stay.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.frames import narrowed, small_batches, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLOCK = 256
#: Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
FAR = 1 << 60
#: Cheapest way from a state to an accepted end by insertions alone, and its audit.
ENDS = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
BLANKS = " \t\n\x0b\x0c\r"


class Table:
    """Costs of aligning the turns i.. with the last m symbols of the alternating string that ends in ``end``.

    The turns are given by their initials and faults (``d`` must go, ``t`` truncated, ``.`` none). Cells outside
    the band of the incumbent cost are absent, and so stand for costs above it.
    """

    def __init__(self, initials: str, faults: str, end: str, incumbent: int):
        self.initials, self.faults, self.end = initials, faults, end
        other = "u" if end == "a" else "a"
        n = len(initials)
        self.cost: list[dict[int, int]] = [{} for _ in range(n)] + [{0: 0}]
        for i in range(n - 1, -1, -1):
            row, below, rest = self.cost[i], self.cost[i + 1], n - i
            for m in range(max(0, rest - incumbent // DELETE), rest + incumbent // INSERT + 1):
                best = DELETE + below.get(m, FAR)
                if m:
                    symbol = end if m % 2 else other
                    if faults[i] != "d":
                        fit = below.get(m - 1, FAR) + (TRUNCATED if faults[i] == "t" else 0)
                        best = min(best, fit + (KEEP if initials[i] == symbol else REROLE))
                    best = min(best, INSERT + row.get(m - 1, FAR))
                if best < FAR:
                    row[m] = best

    def symbol(self, m: int) -> str:
        return self.end if m % 2 else "u" if self.end == "a" else "a"

    def trace(self, i: int, m: int) -> str:
        """The ASCII-least audit of the turns i.. against the last m symbols (D < I < K < R)."""
        out, n = [], len(self.initials)
        while i < n:
            left, below, row = self.cost[i][m], self.cost[i + 1], self.cost[i]
            fault, keeps = self.faults[i], m > 0 and self.initials[i] == self.symbol(m)
            if DELETE + below.get(m, FAR) == left:
                out.append("D")
                i += 1
            elif m and INSERT + row.get(m - 1, FAR) == left:
                out.append("I")
                m -= 1
            else:  # the turn meets the symbol
                out.append("K" if keeps and below.get(m - 1, FAR) + (TRUNCATED if fault == "t" else 0) == left else "R")
                i, m = i + 1, m - 1
        return "".join(out)


def _with_system(table: Table, m: int) -> tuple[int, str]:
    """Cost and least audit of the turns against a system turn and then the last m symbols (m > 0)."""
    best, n = (FAR, ""), len(table.initials)
    for i in range(n):  # the turns before the kept system turn are deleted
        if table.initials[i] == "s" and table.faults[i] != "d":
            cost = DELETE * i + (TRUNCATED if table.faults[i] == "t" else 0) + table.cost[i + 1].get(m, FAR)
            if cost < FAR and cost <= best[0]:
                found = (cost, "D" * i + "K" + table.trace(i + 1, m))
                best = min(best, found)
    return best


@lru_cache(maxsize=1 << 15)
def aligned(initials: str, faults: str) -> tuple[tuple[tuple[int, str] | None, ...], ...]:
    """For each state before (row) and after (column) the turns: least cost and its least audit, None if impossible."""
    n = len(initials)
    incumbent = 8
    while True:
        out = _aligned(initials, faults, incumbent)
        worst = max((x[0] for row in out for to, x in enumerate(row) if x and to in (USER, ASSISTANT)), default=0)
        reachable = all(out[e][to] for e in range(4) for to in (USER, ASSISTANT)) or n == 0
        if (reachable and worst <= incumbent) or incumbent > (DELETE + INSERT + TRUNCATED) * (n + 4):
            return out
        incumbent *= 2


def _aligned(initials: str, faults: str, incumbent: int):
    n = len(initials)
    out: list[list] = [[None] * 4 for _ in range(4)]
    for end in "ua":
        table, to = Table(initials, faults, end, incumbent), AFTER[end]
        top = table.cost[0]
        for start in range(4):
            options = [(top[m], m) for m in top if (table.symbol(m) == NEXT[start] if m else start == to)]
            best = min(options, default=(FAR, 0))[0]
            found = [(best, table.trace(0, m)) for cost, m in options if cost == best and best <= incumbent]
            if start == START:
                lengths = {m for row in table.cost for m in row if m and table.symbol(m) == "u"}
                found += [x for m in lengths if (x := _with_system(table, m))[0] <= incumbent]
            out[start][to] = min(found, default=None)
    out[START][START] = (DELETE * n, "D" * n)
    kept = [(DELETE * (n - 1) + (TRUNCATED if faults[i] == "t" else 0), "D" * i + "K" + "D" * (n - 1 - i))
            for i in range(n) if initials[i] == "s" and faults[i] != "d"]
    out[START][SYSTEM] = min(kept, default=None)
    out[SYSTEM][SYSTEM] = (DELETE * n, "D" * n)
    return tuple(tuple(row) for row in out)


def placed_symbols(audit: str, initials: str, state: int) -> tuple[list[tuple[int, str, str]], int]:
    """(turn index or -1 for an insertion, edit, symbol) of each turn of the result, and the state after them."""
    out, i = [], 0
    for edit in audit:
        symbol = "s" if edit == "K" and state == START and initials[i] == "s" else NEXT[state]
        if edit != "D":
            out.append((-1 if edit == "I" else i, edit, symbol))
            state = AFTER[symbol]
        if edit != "I":
            i += 1
    return out, state


# ------------------------------------------------------------------------------------------------ tasks

KEYS = "ck string, pid int, seq long"


def _rows_of(batches):
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        yield from zip(*columns)


def _batched(schema: pa.Schema, rows, most: int = 2000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


BLOCKS = pa.schema([("ck", pa.string()), ("pid", pa.int32()), ("seq", pa.int64()), ("initials", pa.string()), ("faults", pa.string()),
                    ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("ths", pa.list_(pa.string())),
                    ("costs", pa.list_(pa.int64()))])


def cut_blocks(batches):
    """Sorted turns (ck, turn, role, th, n, first, blank, truncated, pid) to blocks of one conversation each."""
    def block(ck, pid, seq, turns):
        initials, faults = "".join(t[0] for t in turns), "".join(t[1] for t in turns)
        costs = [x[0] if x else FAR for row in aligned(initials, faults) for x in row]
        return (ck, pid, seq, initials, faults, [t[2] for t in turns], [t[3] for t in turns], [t[4] for t in turns], costs)

    def rows():
        now, place, seq, held = None, None, 0, []
        for ck, turn, role, th, n, first, blank, truncated, pid in _rows_of(batches):
            if held and ck != now:
                yield block(now, place, seq, held)
                seq, held = seq + 1, []
            now, place = ck, pid
            initial = role[:1] or " "
            for copy in range(n):
                fault = "d" if blank or copy or not first else "t" if truncated else "."
                held.append((initial, fault, turn, role, th))
                if len(held) == BLOCK:
                    yield block(now, place, seq, held)
                    seq, held = seq + 1, []
        if held:
            yield block(now, place, seq, held)
    yield from _batched(BLOCKS, rows(), 200)


LEGAL = {"su", "ua", "au"}
COSTS = pa.schema([("ck", pa.string()), ("pid", pa.int32()), ("seq", pa.int64()), ("togo", pa.list_(pa.int64())),
                   ("cost", pa.int64()), ("illegal", pa.int64())])


def costs_to_go(batches):
    """Blocks of each conversation, last one first (ck, pid, seq, initials, costs): the costs to go behind each block by state.

    The first block's row also has the conversation's whole cost and its number of illegal neighbours.
    """
    def rows():
        now, waiting, togo, illegal, follows = None, None, None, 0, ""
        for ck, pid, seq, initials, costs in _rows_of(batches):
            if waiting and ck != now:
                yield (*waiting, togo[START], illegal)
                waiting = None
            elif waiting:
                yield (*waiting, None, None)
            if ck != now:
                now, togo, illegal, follows = ck, [c for c, _ in ENDS], 0, ""
            chain = initials + follows
            illegal += sum(chain[i: i + 2] not in LEGAL for i in range(len(chain) - 1))
            follows = initials[0]
            waiting = (ck, pid, seq, togo)
            togo = [min(min(costs[4 * e + to] + togo[to] for to in range(4)), FAR) for e in range(4)]
        if waiting:
            yield (*waiting, togo[START], illegal)
    yield from _batched(COSTS, rows())


CHOICES = pa.schema([("ck", pa.string()), ("pid", pa.int32()), ("seq", pa.int64()), ("initials", pa.string()),
                     ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("ths", pa.list_(pa.string())),
                     ("audits", pa.list_(pa.string()))])


def choose(batches):
    """Per block and state before it: the least audit among those that keep the whole cost least."""
    def rows():
        for ck, pid, seq, initials, faults, turns, roles, ths, togo in _rows_of(batches):
            audits = []
            for row in aligned(initials, faults):
                options = [(x[0] + togo[to], x[1]) for to, x in enumerate(row) if x and togo[to] < FAR]
                least = min(options, default=(0, ""))[0]
                audits.append(min((a for c, a in options if c == least), default=None))
            yield ck, pid, seq, initials, turns, roles, ths, audits
    yield from _batched(CHOICES, rows(), 200)


EDITS = pa.schema([("ck", pa.string()), ("pid", pa.int32()), ("seq", pa.int64()), ("idx", pa.int32()), ("edit", pa.string()),
                   ("turn", pa.int64()), ("role", pa.string()), ("th", pa.string()), ("new_role", pa.string())])
NAMES = {"u": "user", "a": "assistant"}


def walk(batches):
    """Blocks of each conversation in order (CHOICES): one row per edit (idx -1: the block's audit, in ``edit``)."""
    def tail(last, state):
        if last:
            ck, pid, seq = last
            audit = ENDS[state][1]
            if audit:
                yield ck, pid, seq + 0, 1 << 30, audit, None, None, None, None
                for k, symbol in enumerate("ua"[-len(audit):]):
                    yield ck, pid, seq, (1 << 30) + 1 + k, "I", None, None, None, NAMES[symbol]

    def rows():
        last, state = None, START
        for ck, pid, seq, initials, turns, roles, ths, audits in _rows_of(batches):
            if last and ck != last[0]:
                yield from tail(last, state)
                state = START
            audit = audits[state]
            yield ck, pid, seq, -1, audit, None, None, None, None
            done, state = placed_symbols(audit, initials, state)
            for k, (i, edit, symbol) in enumerate(done):
                if edit == "I":
                    yield ck, pid, seq, k, edit, None, None, None, NAMES[symbol]
                else:
                    yield ck, pid, seq, k, edit, turns[i], roles[i], ths[i], roles[i] if edit == "K" else NAMES[symbol]
            last = (ck, pid, seq)
        yield from tail(last, state)
    yield from _batched(EDITS, rows())


# ------------------------------------------------------------------------------------------------ operator

NO_ID = " "


def _turns(rows: DataFrame) -> DataFrame:
    """conv, ck, turn, role, text, th, blank, truncated of rows with conv, turn, role, text."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    bare = F.rtrim(text, F.lit(BLANKS))
    return rows.select("conv", F.coalesce(F.col("conv").cast("string"), F.lit(NO_ID)).alias("ck"), F.col("turn").cast("long").alias("turn"),
                       role.alias("role"), text.alias("text"), F.md5(text).alias("th"), (bare == "").alias("blank"),
                       (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"))


class Repair:
    """The repair of all conversations.

    ``counts``: conv and per conversation gaps, blank, duplicate, truncated, illegal, cost (conversations with rows).
    ``turns``: ck, pid, seq, idx (in this order the place), edit (K, R or I), turn, role, text, new_role: the repaired turns.
    ``audits``: ck, pid, seq, idx, audit: pieces of the audits, to be joined in order.
    """

    def __init__(self, rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"):
        rows = _turns(narrowed(rows, conv=conv_col, turn=turn_col, role=role_col, text=text_col))
        same = ["ck", "turn", "role", "th"]
        groups = stored(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"),
                                                F.first("truncated").alias("truncated")), "repair-turns")
        null_turn = F.max(F.col("turn").isNull())
        firsts = groups.groupBy("ck", "role", "th").agg(F.min("turn").alias("least"), null_turn.alias("unplaced"))
        marked = groups.join(firsts, ["ck", "role", "th"]).select(
            *same, "n", F.when(F.col("unplaced"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("least")).alias("first"),
            "blank", "truncated")
        marked = stored(marked, "repair-marked")
        ordered = (marked.repartitionByRange(*[F.col(c) for c in same]).sortWithinPartitions(*same)
                   .select(*same, "n", "first", "blank", "truncated", F.spark_partition_id().alias("pid")))
        blocks = stored(ordered.mapInArrow(cut_blocks, f"{KEYS}, initials string, faults string, turns array<long>, roles array<string>, "
                                           "ths array<string>, costs array<long>"), "repair-blocks")
        back = (blocks.select("ck", "pid", "seq", "initials", "costs").repartition("ck")
                .sortWithinPartitions("ck", F.desc("pid"), F.desc("seq")))
        costs = stored(back.mapInArrow(costs_to_go, f"{KEYS}, togo array<long>, cost long, illegal long"), "repair-costs")
        key = ["ck", "pid", "seq"]
        chosen = (blocks.join(costs.select(*key, "togo"), key)
                  .select(*key, "initials", "faults", "turns", "roles", "ths", "togo")
                  .mapInArrow(choose, f"{KEYS}, initials string, turns array<long>, roles array<string>, ths array<string>, audits array<string>"))
        forth = chosen.repartition("ck").sortWithinPartitions(*key)
        edits = stored(forth.mapInArrow(walk, f"{KEYS}, idx int, edit string, turn long, role string, th string, new_role string"), "repair-edits")
        self.audits = edits.where("new_role is null").select(*key, "idx", F.col("edit").alias("audit"))
        order = [*key, "idx", "edit", "turn", "role"]
        texts = rows.groupBy(*same).agg(F.first("text").alias("text")).select(
            F.col("ck").alias("__ck"), F.col("turn").alias("__turn"), F.col("role").alias("__role"), F.col("th").alias("__th"), "text")
        met = (F.col("ck") == F.col("__ck")) & F.col("turn").eqNullSafe(F.col("__turn")) & (F.col("role") == F.col("__role")) & (F.col("th") == F.col("__th"))
        kept = edits.where("new_role is not null and edit <> 'I'").join(texts, met).select(*order, "text", "new_role")
        added = edits.where("new_role is not null and edit = 'I'").select(*order, F.lit("").alias("text"), "new_role")
        self.turns = kept.unionByName(added)
        repeats = F.when(~F.col("blank"), F.col("n") - F.when(F.col("first"), 1).otherwise(0)).otherwise(0)
        cut = F.when(~F.col("blank") & F.col("first") & F.col("truncated"), 1).otherwise(0)
        span = F.max("turn") - F.min("turn") + 1 - F.count_distinct(F.col("turn"))
        sums = marked.groupBy("ck").agg(
            F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
            F.sum(repeats).cast("long").alias("duplicate"), F.sum(cut).cast("long").alias("truncated"))
        self.counts = sums.join(costs.where("cost is not null").select("ck", "illegal", "cost"), "ck")


DIGESTS = pa.schema([("ck", pa.string()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def digests(batches):
    """Sorted pieces (ck, pid, seq, idx, audit, line) to the audit and the digest of the lines of each conversation."""
    def rows():
        now, audit, sha, lines = None, [], None, 0
        for ck, _, _, _, piece, line in _rows_of(batches):
            if ck != now:
                if now is not None:
                    yield now, "".join(audit), sha.hexdigest()
                now, audit, sha, lines = ck, [], hashlib.sha256(), 0
            if piece is not None:
                audit.append(piece)
            if line is not None:
                sha.update(("\n" + line if lines else line).encode())
                lines += 1
        if now is not None:
            yield now, "".join(audit), sha.hexdigest()
    yield from _batched(DIGESTS, rows(), 500)


def digested(repair: Repair) -> DataFrame:
    """ck, audit, repaired_sha256 (of the lines role:text): a stream over the sorted pieces, whatever a conversation's length."""
    pieces = repair.audits.select("ck", "pid", "seq", "idx", "audit", F.lit(None).cast("string").alias("line")).unionByName(
        repair.turns.select("ck", "pid", "seq", "idx", F.lit(None).cast("string").alias("audit"), F.concat("new_role", F.lit(":"), "text").alias("line")))
    small_batches(pieces.sparkSession)
    return (pieces.repartition("ck").sortWithinPartitions("ck", "pid", "seq", "idx")
            .mapInArrow(digests, "ck string, audit string, repaired_sha256 string"))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32 of ``conv_id:turn`` modulo 20 names.

    0 drops the row, 1 empties the text, 2 removes its ``.!?``, 3 repeats the row, 4 sets role user. Nulls count as one space.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = narrowed(rows, conv_id="conv_id", turn="turn", role="role", text="text")
    rows = rows.withColumn("how", F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20).where("how <> 0")
    text, role = shown("text"), shown("role")
    rows = rows.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(role).alias("role"),
                       F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                       F.explode(F.sequence(F.lit(1), F.when(F.col("how") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def repaired(spark, conversations: DataFrame) -> DataFrame:
    """The contract's row per original conversation."""
    repair = Repair(damaged(conversations))
    every = conversations.select("conv_id").distinct().withColumn("ck", F.coalesce(F.col("conv_id").cast("string"), F.lit(NO_ID)))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = repair.counts.join(digested(repair), "ck")
    return every.join(found, "ck", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op11_repair(spark, sf_dir: str) -> DataFrame:
    """All conversations, damaged by rule: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    return repaired(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: The same as a recursion over the turns. crc32 is computed from its table (polynomial 3988292384); insertions are left out, since
#: deleting a neighbour of an inserted turn (2) is always cheaper than the insertion (5).
OP11_SQL = r"""
WITH RECURSIVE
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
         lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
damage AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(
               string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS how
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM damage, (VALUES (1), (2)) AS c(copy) WHERE how <> 0 AND (copy = 1 OR how = 3)),
placed AS (
  SELECT *, left(role, 1) AS initial, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare,
         row_number() OVER w AS i, lag(left(role, 1)) OVER w AS was
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text))),
turns AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (was IS NOT NULL AND was || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM turns GROUP BY conv_id),
-- cheapest edits up to each turn by the last symbol kept ('' none); an insertion (5) is never cheaper than deleting a neighbour (2)
paths AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '' AS last, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best FROM counts
  UNION ALL
  SELECT conv_id, i, last, min(best) AS best FROM (
    SELECT p.conv_id, t.i,
           CASE WHEN e.edit = 'D' THEN p.last WHEN e.edit = 'K' THEN t.initial WHEN p.last = 'u' THEN 'a' ELSE 'u' END AS last,
           {'cost': p.best.cost + CASE e.edit WHEN 'D' THEN 2 WHEN 'K' THEN 0 ELSE 1 END
                    + CASE WHEN e.edit <> 'D' AND t.fault = 'truncated' THEN 5 ELSE 0 END,
            'audit': p.best.audit || e.edit,
            'lines': CASE e.edit WHEN 'D' THEN p.best.lines WHEN 'K' THEN list_append(p.best.lines, t.role || ':' || t.text)
                     ELSE list_append(p.best.lines, CASE WHEN p.last = 'u' THEN 'assistant:' ELSE 'user:' END || t.text) END} AS best
    FROM paths p JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1, (VALUES ('D'), ('K'), ('R')) AS e(edit)
    WHERE e.edit = 'D' OR (t.fault NOT IN ('blank', 'duplicate') AND (e.edit = 'R'
          OR t.initial = CASE WHEN p.last = 'u' THEN 'a' ELSE 'u' END OR (p.last = '' AND t.initial = 's')))) AS o
  GROUP BY conv_id, i, last),
done AS (
  SELECT c.conv_id, min(p.best) AS best FROM paths p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND p.i = c.n
  WHERE p.last IN ('', 'a') GROUP BY c.conv_id)
SELECT a.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
       coalesce(c.illegal, 0) AS illegal, CAST(coalesce(d.best.cost, 0) AS BIGINT) AS cost, coalesce(d.best.audit, '') AS audit,
       sha256(coalesce(array_to_string(d.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM a.conv_id
"""
