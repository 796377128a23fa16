"""Secret scans with password guess-cost dynamic programming.

Base patterns find assignments, access keys and hex strings (spans in code points,
leftmost and non-overlapping per kind; short values are dropped after matching, so a
short match still consumes its text). The method adds values that stand in a
credential context (a keyword, then ``:``, ``=`` or ``is``, or a user:password@ URL
part; user and password of any length) when guessing them is expensive: the cheapest segmentation of the value into
dictionary words, dates, repeats, keyboard walks, sequences and brute-force spans is
found by dynamic programming over log10 guesses, and a value of at least
``min_guesses`` decimal digits of cost is a secret of kind ``guess``. Placeholder-like values
("password", "changeme1", "aaaaaaaaaaaa", "qwertyuiop") are cheap and stay.

The cost of a segmentation of k spans is the sum of the spans' log10 guesses plus
log10(k!), for the unknown order. The search is exact over the span kinds and over the whole value, however long: a
position keeps only numbers of spans that no smaller number undercuts. Repeats may have a unit of any
length; they are found by comparing the value with itself at each distance (quadratic in its length, as array operations).

Words are ranked by a short list of common passwords, then by the corpus: the words of letters that most texts hold, counted by
Spark outside credential values, so that a secret many copies repeat does not become a word. The list is a model of bounded size
(``most`` words, in at least ``least`` texts); a word beyond it costs what its characters cost.

After a bare ``is`` (no ``:`` or ``=``) a plain word that another plain word follows is prose ("the token is easily
obtained"); else the cost alone decides. Quotes and brackets at a value's end are not part of it; ``.,;:!?`` there
are, if the value has such characters inside, too.

Null or empty text: no spans. Nothing is cut; a text is scanned whole. Repeated rows: each scanned for itself. Spans that start
together: in the order of the kinds. Other columns are kept; one that has the spans column's name is refused. Empty table: empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.frames import small_batches, stored

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Credential contexts of the method: the value is group 1.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_ -]?key|auth(?:orization)?|login|pin)"""
    r"""["']?(?:\x20+is\x20*:?|\x20*(?:[:=]|=>|:=))\x20*(?:bearer\x20+)?["'`]?([!-~]{6,})""", re.I | re.A)
URL = re.compile(r"""[a-z][a-z0-9+.-]{1,15}://[^\s:/@]*+:([^\s/@]{6,}+)@""", re.I | re.A)
#: Common words of passwords and placeholders, most common first (a small own list; pass words= for another).
WORDS = """password secret token admin welcome login master dragon monkey letmein sunshine princess shadow football
baseball superman batman trustno hello freedom whatever computer internet service server system root user test guest
default example sample change changeme your here none null true false value string please enter key pass word my the
and love money happy summer winter spring autumn monday friday january october blue green red black white orange
purple tiger lion eagle horse correct battery staple house garden river mountain open access private public database
production development staging demo account email name company office home family mother father baby angel michael
daniel jessica thomas george robert charlie jordan hunter killer soccer hockey cheese coffee cookie chocolate banana
flower star moon light dark fire water earth magic wizard ninja pirate dummy placeholder todo insert replace""".split()
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "qazwsxedcrfvtgbyhnujmikolp", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik9ol")
SEQUENCES = ("abcdefghijklmnopqrstuvwxyz", "0123456789")
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)")
LEET = str.maketrans("430157$@!", "aeoistsai")


def repeats(s: str) -> list[tuple[int, int, int]]:
    """(start, end, unit length) of the longest runs of whole, primitive units, two at least, from each start."""
    out: dict[tuple[int, int], int] = {}
    codes = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for unit in range(1, len(s) // 2 + 1):
        same = codes[:-unit] == codes[unit:]
        if np.count_nonzero(same) < unit:
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo >= unit:  # [lo, hi + unit) has the period; a smaller one has claimed the whole run before
                out.setdefault((lo, hi + unit), unit)
    return [(i, i + (hi - i) // unit * unit, unit) for (lo, hi), unit in out.items() for i in range(lo, hi - 2 * unit + 1)
            if (hi - i) // unit * unit >= 3]


class GuessCost:
    """log10 guesses of a value by its cheapest segmentation."""

    def __init__(self, words: list[str] = WORDS):
        self.rank = {w.lower(): i for i, w in reversed(list(enumerate(words, 1)))}
        self.longest = max(map(len, self.rank), default=0)
        self.walks = ROWS + SEQUENCES + tuple(r[::-1] for r in ROWS + SEQUENCES)

    def spans(self, s: str) -> list[tuple[int, int, float]]:
        """All non-brute-force spans (start, end, log10 guesses)."""
        out, n, low = [], len(s), s.lower()
        plain = low.translate(LEET)
        for i in range(n):
            for j in range(i + 3, min(n, i + self.longest) + 1):
                for text, extra in ((low, 0.0), (plain, 0.6)):
                    if (r := self.rank.get(text[i:j])):
                        upper = 0.0 if s[i:j].islower() or not s[i:j].isalpha() else 0.5 if s[i:j].istitle() or s[i:j].isupper() else 1.5
                        out.append((i, j, math.log10(r) + 0.3 + extra + upper))
                        break
            if m := DATE.match(s, i):
                out.append((i, m.end(), 2.1 if m.end() - i == 4 else 4.6))
            for walk in self.walks:
                at = walk.find(low[i: i + 3]) if i + 3 <= n else -1
                if at >= 0:
                    k = 3
                    while i + k < n and at + k < len(walk) and walk[at + k] == low[i + k]:
                        k += 1
                    out.append((i, i + k, 2.0 + math.log10(k)))
        units: dict[str, float] = {}
        for i, j, unit in repeats(s):
            u = s[i: i + unit]
            if u not in units:  # a unit costs what it costs alone
                units[u] = min(self.brute(u), self.segmented(u)) if unit > 3 else self.brute(u)
            out.append((i, j, units[u] + math.log10((j - i) // unit)))
        return out

    @staticmethod
    def brute(s: str) -> float:
        """Brute force: the size of the character classes in use, a character."""
        size = sum(n for n, there in ((10, any(c.isdigit() for c in s)), (26, any(c.islower() for c in s)),
                                      (26, any(c.isupper() for c in s)), (33, any(not c.isalnum() for c in s))) if there)
        return len(s) * math.log10(max(size, 2))

    def segmented(self, s: str) -> float:
        """The cheapest segmentation of the whole value."""
        n, unit = len(s), self.brute(s) / max(1, len(s))
        by_end: dict[int, list[tuple[int, float]]] = {}
        for i, j, cost in self.spans(s):
            by_end.setdefault(j, []).append((i, cost))
        # best[j]: (spans, ends in brute force) -> cheapest cover of s[:j]; brute-force characters in a row are one span
        best: list[dict[tuple[int, bool], float]] = [{(0, False): 0.0}]
        for j in range(1, n + 1):
            here: dict[tuple[int, bool], float] = {}
            for (k, brute), cost in best[j - 1].items():
                to = (k if brute else k + 1, True)
                if cost + unit < here.get(to, math.inf):
                    here[to] = cost + unit
            for i, extra in by_end.get(j, ()):
                for (k, _), cost in best[i].items():
                    if cost + extra < here.get((k + 1, False), math.inf):
                        here[k + 1, False] = cost + extra
            best.append(self._undercut(here))
        return min(cost + math.lgamma(k + 1) / math.log(10) for (k, _), cost in best[n].items())

    @staticmethod
    def _undercut(states: dict) -> dict:
        """Without states that one of no more spans undercuts (one that ends in brute force can go on for a span less)."""
        out, least = {}, {False: math.inf, True: math.inf}
        for (k, brute), cost in sorted(states.items(), key=lambda x: (x[0][0], not x[0][1])):
            if cost < least[True] and (brute or cost < least[False]):
                out[k, brute] = cost
                least[brute] = cost
        return out

    def __call__(self, value: str) -> float:
        return self.segmented(value)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of kind, end) of the base patterns."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


MARKS = re.compile(r"[:=]| is ", re.I | re.A)
PROSE = re.compile(r"\x20+[a-z]+(?![^\s.,;:!?])")
CLOSERS = "\"'`)]}>"


def values(text: str):
    """(start, value) of what stands in a credential context."""
    if MARKS.search(text):
        for m in CONTEXT.finditer(text):
            found = m.group(1)
            core = found.rstrip(CLOSERS + ".,;:!?")
            if any(not c.isalnum() for c in core):  # punctuation that the value uses elsewhere, too
                core += re.match(r"[.,;:!?]*", found[len(core):]).group()
            lead = text[m.start(): m.start(1)]
            plain = core.isalpha() and (core.islower() or core.istitle())
            if ":" not in lead and "=" not in lead and plain and PROSE.match(text, m.start(1) + len(core)):
                continue
            yield m.start(1), core
        if "://" in text:
            for m in URL.finditer(text):
                yield m.start(1), m.group(1)


def guess_spans(text: str, cost: GuessCost, min_guesses: float) -> list[tuple[int, int, int]]:
    """(start, 3, end) of the values that the method adds."""
    return sorted({(at, 3, at + len(v)) for at, v in values(text) if len(v) >= 6 and cost(v) >= min_guesses})


WORD = re.compile(r"[a-z]{3,24}")


def _text_words(batches):
    """(word, n): words of letters of the batches' texts outside credential values, with the number of texts that hold them."""
    counts: Counter = Counter()

    def run():
        words, numbers = zip(*counts.items()) if counts else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(numbers, pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column("text").to_pylist():
            if text:
                found = values(text)
                for at, value in sorted(found, reverse=True):
                    text = f"{text[:at]} {text[at + len(value):]}"
                counts.update(set(WORD.findall(text.lower())))
        if len(counts) > 1 << 18:  # partial counts: Spark adds them up
            yield run()
            counts.clear()
    yield run()


def corpus_words(docs: DataFrame, text_col: str = "text", most: int = 50_000, least: int = 3) -> list[str]:
    """The common words of passwords, then those of the corpus by the number of texts that hold them (ties by the word).

    At most ``most`` of them: the words of a frequency are taken together or not at all.
    """
    small_batches(docs.sparkSession)
    counts = stored(docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(_text_words, "word string, n long")
                    .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "words")
    # the least frequency whose words fit, from the most frequent down; a top-k would send k rows of every task
    room, floor = most, None
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).toLocalIterator():
        if r["words"] > room:
            break
        room, floor = room - r["words"], r["n"]
    top = counts.where(F.col("n") >= floor).collect() if floor is not None else []  # at most `most` short words
    return [*WORDS, *(r["word"] for r in sorted(top, key=lambda r: (-r["n"], r["word"])) if r["word"] not in set(WORDS))]


def _shared_cost(docs: DataFrame, text_col: str, words: list[str] | None):
    """A function for tasks that gives the guess cost over the broadcast dictionary, built once a process."""
    held = docs.sparkSession.sparkContext.broadcast(corpus_words(docs, text_col) if words is None else words)
    small_batches(docs.sparkSession)
    built: list[GuessCost] = []

    def shared() -> GuessCost:
        if not built:
            built.append(GuessCost(held.value))
        return built[0]
    return shared


def scan_secrets(docs: DataFrame, text_col: str = "text", spans_col: str = "secret_spans",
                 min_guesses: float = 11.0, words: list[str] | None = None) -> DataFrame:
    """The frame with spans_col: array of (start, end, kind) by start, then kind, in code points.

    words: the ranked dictionary, by default the one of these texts (``corpus_words``).
    """
    if spans_col in docs.columns:
        raise ValueError(f"column {spans_col!r} exists; choose another spans_col")
    shared = _shared_cost(docs, text_col, words)

    @F.pandas_udf("array<struct<start:int,end:int,kind:string>>")
    def scan(texts: pd.Series) -> pd.Series:
        cost = shared()
        out = []
        for t in texts:
            t = t or ""
            found = sorted(base_spans(t) + guess_spans(t, cost, min_guesses))
            out.append([{"start": a, "end": b, "kind": KINDS[k]} for a, k, b in found])
        return pd.Series(out)

    return docs.withColumn(spans_col, scan(F.col(f"`{text_col}`")))


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "<SECRET>", min_guesses: float = 11.0,
                   words: list[str] | None = None) -> DataFrame:
    """The frame with every span (overlapping ones together) replaced by the mark; texts without one, and nulls, unchanged."""
    shared = _shared_cost(docs, text_col, words)

    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        cost = shared()
        out = []
        for t in texts:
            if t:
                found = sorted(base_spans(t) + guess_spans(t, cost, min_guesses))
                parts, at, upto = [], 0, -1
                for a, _, b in found:
                    if a >= upto:
                        parts += [t[at:a], mark]
                        at = upto = b
                    else:
                        at = upto = max(upto, b)
                t = "".join([*parts, t[at:]]) if found else t
            out.append(t)
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, redact(F.col(f"`{text_col}`")))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    spans = F.col("secret_spans")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"] != "guess")
    return scan_secrets(docs).select("doc_id", count("assign"), count("access"), count("hex"),
                                     F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"),
                                     count("guess"))
