"""Conversation repair, phrase mining and mixing on small hostile inputs, against plain Python versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from ferry.llm import op11_repair as op11
from ferry.llm import op12_phrases as op12
from ferry.llm import op13_mixing as op13
from ferry.llm.textkit import text_chunks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"

# ------------------------------------------------------------------------------------------------ op11


def plain_damage(rows):
    shown = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        how, role, text = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20, shown(role), shown(text)
        if how:
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            yield from [(conv, turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)


def plain_repair(rows):
    """The least (cost, audit) per grammar state, turn by turn; a dict by conversation."""
    out, convs = {}, defaultdict(list)
    for conv, *row in plain_damage(rows):
        convs[conv].append(tuple(row))
    for conv in {r[0] for r in rows}:
        turns = sorted(convs[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        numbers, seen, faults = {t for t, _, _ in turns if t is not None}, set(), []
        for _, role, text in turns:
            bare = text.rstrip(BLANKS)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[:1] or " " for _, r, _ in turns]
        states = {"": (0, "", ())}

        def inserted(states):
            states = dict(states)
            for _ in range(4):
                for last, (cost, audit, lines) in list(states.items()):
                    to, name = ("a", "assistant:") if last == "u" else ("u", "user:")
                    new = (cost + 5, audit + "I", (*lines, name))
                    if to not in states or new[:2] < states[to][:2]:
                        states[to] = new
            return states

        for initial, fault, (_, role, text) in zip(initials, faults, turns):
            after = {}

            def put(to, cost, audit, lines):
                if to not in after or (cost, audit) < after[to][:2]:
                    after[to] = (cost, audit, lines)

            for last, (cost, audit, lines) in inserted(states).items():
                put(last, cost + 2, audit + "D", lines)
                if fault not in ("blank", "duplicate"):
                    cost += 5 * (fault == "truncated")
                    to, name = ("a", "assistant") if last == "u" else ("u", "user")
                    put(to, cost + 1, audit + "R", (*lines, f"{name}:{text}"))
                    if initial == to or (initial == "s" and last == ""):
                        put(initial, cost, audit + "K", (*lines, f"{role}:{text}"))
            states = after
        end = inserted(states)
        cost, audit, lines = min(end[x] for x in ("", "a") if x in end)
        count = Counter(faults)
        out[conv] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, count["blank"], count["duplicate"], count["truncated"],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations():
    r = random.Random(4)
    texts = ["Yes.", "No!", "well", "a b c?", " \n", "", None, "Ü.\n", "so so. ", "x"]
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(r.randrange(0, 12)):
            rows.append((conv, r.choice([turn, turn, turn, turn * 3, None]), r.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
                         r.choice(texts) if r.random() < 0.5 else f"t{r.randrange(9)}."))
    rows += [(99, t, "user" if t % 2 else "assistant", f"turn {t}" + r.choice([".", ""])) for t in range(700)]
    rows += [(98, 5, "user", "same.")] * 600 + [(98, 6, "assistant", "ok.")]
    return rows


@pytest.fixture(scope="module")
def chats(spark):
    schema = "conv_id long, turn long, role string, text string, ck string, pid int, seq int, idx string, edit string, th int, n int"
    return spark.createDataFrame([(*r, "x", 1, 2, "i", "e", 3, 4) for r in conversations()], schema).repartition(5)


def test_repair_equals_plain_version(spark, chats):
    got = {r["conv_id"]: tuple(r)[1:] for r in op11.repaired(spark, chats).collect()}
    assert got == plain_repair(conversations())


def test_repair_of_no_rows(spark, chats):
    assert op11.repaired(spark, chats.limit(0)).collect() == []
    # a conversation whose only row the damage drops
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    only = spark.createDataFrame([(conv, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    row = op11.repaired(spark, only).collect()
    assert [tuple(r) for r in row] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns_follow_the_grammar(chats):
    repair = op11.Repair(chats)
    rows = repair.turns.collect()
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["pid"], r["seq"], r["idx"])):
        by[r["ck"]].append(r["new_role"][0])
    assert by and all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in by.values())
    assert {r["edit"] for r in rows} == {"K", "R"}  # at these costs a deletion is always cheaper than an insertion


def test_blocks_of_any_size_give_the_same_repair():
    r = random.Random(8)

    def by_blocks(initials, faults, size):
        blocks = [(initials[i: i + size], faults[i: i + size]) for i in range(0, len(initials), size)]
        behind, togo = [], [c for c, _ in op11.ENDS]
        for block in reversed(blocks):
            behind.insert(0, togo)
            togo = [min((x[0] + togo[to] for to, x in enumerate(row) if x), default=op11.FAR) for row in op11.aligned(*block)]
        state, audit = op11.START, ""
        for block, after in zip(blocks, behind):
            row = op11.aligned(*block)[state]
            piece = min((x[0] + after[to], x[1]) for to, x in enumerate(row) if x and after[to] < op11.FAR)[1]
            audit += piece
            state = op11.placed_symbols(piece, block[0], state)[1]
        return togo[op11.START], audit + op11.ENDS[state][1]

    for _ in range(300):
        n = r.randrange(1, 30)
        initials, faults = "".join(r.choice("uuaasx") for _ in range(n)), "".join(r.choice("....dt") for _ in range(n))
        assert len({by_blocks(initials, faults, size) for size in (1, 2, 5, 64)}) == 1


# ------------------------------------------------------------------------------------------------ op12


def plain_counts(rows, most=3):
    counts = defaultdict(Counter)
    for text, lang in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, most + 1):
                counts["und" if lang is None else lang].update(" ".join(words[i: i + k]) for i in range(len(words) - k + 1))
    return counts


def plain_phrases(rows, top, most=3, least=10, share=50):
    out = []
    for lang, f in plain_counts(rows, most).items():
        n = sum(c for p, c in f.items() if " " not in p)
        found = {p: c for p, c in f.items() if " " in p and c >= least}
        rows_ = []
        for p, a in found.items():
            w = p.split(" ")
            if any(len(q) > len(p) and 100 * b >= share * a and f" {p} " in f" {q} " and q.count(" ") > p.count(" ") for q, b in found.items()):
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = f[" ".join(w[:k])], f[" ".join(w[k:])]
                cuts.append((10 ** 6 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            rows_.append((-score, -a, p.encode(), p, a, left, right, n, score))
        out += [(lang, i, p, a, left, right, n, score) for i, (_, _, _, p, a, left, right, n, score) in enumerate(sorted(rows_)[:top], 1)]
    return sorted(out, key=str)


def phrase_rows():
    r = random.Random(2)
    words = ["the", "The", "of", "ß", "a", "New", "york", "city", "x\x0by", "\xa0", "é"] + [f"w{i}" for i in range(30)]
    rows = [(" ".join(r.choice(words) + r.choice(["", "", "", ",", ". ", "\n", "\t", "  "]) for _ in range(r.randrange(0, 60))), r.choice(["en", "de", None]))
            for _ in range(200)]
    rows += [("New York City", "en")] * 30 + [("go go go go go go", "und")] * 9 + [(None, "en"), ("", None), (" .,; ", "en"), ("one", "fr")]
    rows += [("hot pair " + str(i % 7), "de") for i in range(300)] + [("long text " * 5000, "en")]
    return rows


@pytest.mark.parametrize("limits", [{}, {"room": 40, "burst": 4, "vocabulary": 12}])
def test_phrases_equal_plain_version(spark, limits):
    rows = phrase_rows()
    df = spark.createDataFrame([(*x, 1, "p", 2, 3) for x in rows], "text string, lang string, f int, phrase string, k int, prefix int").repartition(4)
    for options in ({"top": 2000}, {"top": 7, "min_count": 3, "share": 80}):
        got = op12.collocations(df, **options, **limits)
        want = plain_phrases(rows, options["top"], least=options.get("min_count", 10), share=options.get("share", 50))
        assert sorted((tuple(r) for r in got.collect()), key=str) == want and want


def test_phrases_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert op12.collocations(empty).collect() == []
    assert op12.collocations(spark.createDataFrame([(None, None), ("", "x")], "text string, lang string")).collect() == []


def test_scores_pass_64_bits(spark):
    # the exact form that the operator uses, at counts whose products need more than 64 bits
    a, left, right = 987_654_321_012, 1_987_654_321_013, 2_987_654_321_017
    row = spark.sql(f"""SELECT (cast({a} as decimal(19,0)) * cast({a} as decimal(19,0)) * cast(1000000 as decimal(7,0)))
        div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0))) AS s""").first()
    assert row["s"] == 10 ** 6 * a * a // (left * right)


def test_trie_bursts_and_spills():
    r = random.Random(3)
    trie, want = op12.HatTrie(3, 21, burst=8), Counter()
    for _ in range(60):
        keys = [((r.choice([1, 1, 1, r.randrange(50)]) << 42) | (r.choice([2, r.randrange(9)]) << 21) | r.randrange(40)) for _ in range(30)]
        want.update(keys)
        k, c = np.unique(np.array(keys, dtype=np.int64), return_counts=True)
        trie.add(k, c)
    assert trie.size == len(want) and all(trie.find(k) == n for k, n in want.items())
    assert any(c.node is not None for c in trie.root.children) and len(trie.root.children) > 1
    out = Counter()
    for keys, counts in trie.spill(len(want) // 2):
        out.update(dict(zip(keys.tolist(), counts.tolist())))
    assert trie.size <= len(want) // 2 and out
    for keys, counts in trie.spill(0):
        out.update(dict(zip(keys.tolist(), counts.tolist())))
    assert out == want and trie.size == 0


def test_tokens_of_a_chunk():
    texts = ["Ab cd", None, "", "e,f g\n\nh", "x y  z", "last"]
    rows = []
    for lo, hi, buf, offsets in text_chunks(pa.array(texts, pa.string())):
        t = op12.Tokens(buf, offsets, op12.lang_hashes(["en"] * (hi - lo)), {})
        rows += [(lo + int(r), w.decode()) for r, w in zip(t.row, t.words.to_pylist())]
        assert [(t.words[i].as_py(), t.words[i + 1].as_py()) for i in t.places(2).tolist()] == [
            (b"ab", b"cd"), (b"f", b"g"), ("x y".encode(), b"z")]
    assert rows == [(0, "ab"), (0, "cd"), (3, "e"), (3, "f"), (3, "g"), (3, "h"), (4, "x y"), (4, "z"), (5, "last")]


# ------------------------------------------------------------------------------------------------ op13


def plain_targets(sizes, weights, epochs=3, budget=None):
    """Rounds of clamping in exact fractions; sizes and weights by source."""
    left, target, open_ = Fraction(sum(sizes.values()) if budget is None else budget), {}, set(sizes)
    while open_:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if total and left * weights[s] / total > epochs * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = Fraction(epochs * sizes[s])
        left -= sum(target[s] for s in over)
        open_ -= over
    total = sum(weights[s] for s in open_)
    return target | {s: left * weights[s] / total if total else Fraction(0) for s in open_}


def mix_rows():
    r = random.Random(9)
    rows = []
    for source, n, most in (("big", 60, 40), ("a", 3, 5), ("ä", 4, 6), ("", 5, 9), (None, 6, 30), ("B", 2, 400), ("zero", 3, 0), ("\U0001F600", 1, 7), ("￿", 2, 7)):
        rows += [(None if r.random() < 0.05 else r.randrange(10 ** 6), " \n".join("w" * r.randrange(1, 4) for _ in range(r.randint(0, most))), source) for _ in range(n)]
    rows += [(7, "same row here", "big")] * 20 + [(None, None, "big"), (3, "", "a")]
    return rows


MIX_SCHEMA = "doc_id long, text string, source string, size long, key string, no int, rest string, target string, cell1 int, weight int"


@pytest.fixture(scope="module")
def sources(spark):
    return spark.createDataFrame([(*x, 1, "k", 2, "r", "t", 3, 4) for x in mix_rows()], MIX_SCHEMA).repartition(4)


def check_mix(rows, got, want, epochs=3):
    size_of = Counter()
    for _, text, source in rows:
        size_of[source] += len(WORD.findall(text or ""))
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((d, len(WORD.findall(t or "")), s) for d, t, s in rows)
    taken, tied = Counter(), Counter((r["source"], r["doc_id"], r["size"]) for r in got)
    for r in got:
        assert r["source_size"] == size_of[r["source"]] and 0 <= r["taken"] <= epochs * r["size"]
        assert r["taken"] == r["repeats"] * r["size"] + r["part_words"] and 0 <= r["part_words"] <= r["size"]
        assert abs(r["target"] - float(want[r["source"]])) <= 1e-9 * max(1, r["target"])
        taken[r["source"]] += r["taken"]
    for s in size_of:
        spare = max(n for (x, _, _), n in tied.items() if x == s)  # equal rows share what one of them would take
        assert abs(taken[s] - want[s]) <= 0.5 + (spare - 1)
    for s in size_of:  # at most one group of equal rows is cut
        cut = {(r["doc_id"], r["size"]) for r in got if r["source"] == s and 0 < r["part_words"] < r["size"]}
        assert len(cut) <= 1


def test_mix_equals_plain_water_filling(sources):
    rows = mix_rows()
    size_of = Counter()
    for _, text, source in rows:
        size_of[source] += len(WORD.findall(text or ""))
    order = sorted((s for s in size_of if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: i % 3 + 1 for i, s in enumerate(order)}
    for options in ({}, {"max_epochs": 1}, {"budget": 40}, {"budget": 10 ** 6}, {"weights": (5, 1), "seed": 3}):
        mine = {s: options["weights"][i % 2] for i, s in enumerate(order)} if "weights" in options else weights
        want = plain_targets(size_of, mine, options.get("max_epochs", 3), options.get("budget"))
        got = op13.mix_sources(sources, **options).collect()
        check_mix(rows, got, want, options.get("max_epochs", 3))
    assert any(want[s] == 3 * size_of[s] for s in size_of)


def test_mix_with_a_table_of_weights(spark, sources):
    rows, table = mix_rows(), {"big": 3, None: 2, "B": 0, "a": 7}
    size_of = Counter()
    for _, text, source in rows:
        size_of[source] += len(WORD.findall(text or ""))
    want = plain_targets(size_of, {s: table.get(s, 0) for s in size_of})
    weights = spark.createDataFrame(list(table.items()), "source string, weight int")
    check_mix(rows, op13.mix_sources(sources, weights=weights).collect(), want)


def test_mix_reruns_agree_and_small_tables(spark, sources):
    first = op13.mix_sources(sources).collect()
    again = op13.mix_sources(sources.repartition(7)).collect()
    key = lambda r: str(tuple(r))
    assert sorted(first, key=key) == sorted(again, key=key)
    assert op13.mix_sources(sources.limit(0)).collect() == []
    nothing = spark.createDataFrame([(1, None, "s"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r["taken"], r["target"]) for r in op13.mix_sources(nothing).collect()} == {(0, 0.0)}


def test_mixed_texts_hold_the_words_taken(sources):
    taken = Counter()
    for r in op13.mix_sources(sources).collect():
        taken[r["doc_id"], r["source"]] += r["taken"]
    texts = op13.mixed_texts(sources)
    assert texts.columns == [*sources.columns, "mix_copy"]
    words = Counter()
    for r in texts.collect():
        words[r["doc_id"], r["source"]] += len(WORD.findall(r["text"]))
    assert +words == +taken
    with pytest.raises(ValueError):
        op13.mixed_texts(sources, copy_col="size")


def test_mix_broadcast_bound(sources, monkeypatch):
    want = sorted(map(tuple, op13.mix_sources(sources).collect()), key=str)
    monkeypatch.setattr(op13, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, op13.mix_sources(sources).collect()), key=str) == want
