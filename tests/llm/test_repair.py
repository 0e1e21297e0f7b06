import hashlib
import itertools
import random
import re
import zlib

import pytest

from quarry.llm import repair
from quarry.llm.queries import op13_conversation_repair

SEEN = re.compile(r"[^\x20\x09-\x0D]")
WANTED = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: ((r[1] is not None, r[1] or 0), r[2], r[3]))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        visible = SEEN.findall(text)
        out.append("blank" if not visible else "duplicate" if (role, text) in seen
                   else "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """By dynamic programming over (row, state) forward with whole strings: least (cost, audit)."""
    found = faults(rows)
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def close(states):
        for _ in range(3):
            for q, (cost, audit, lines) in list(states.items()):
                for r in ("user", "assistant"):
                    if (to := step[q].get(r[0])) is not None:
                        new = (cost + 3, audit + "I", lines + (r + ":",))
                        if to not in states or new[:2] < states[to][:2]:
                            states[to] = new
        return states

    states = close({0: (0, "", ())})
    for (_, _, role, text), fault in zip(rows, found):
        new = {}
        for q, (cost, audit, lines) in states.items():
            options = [(q, 4, "D", ())]
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                if (to := step[q].get(role[:1])) is not None:
                    options.append((to, more, "K", (f"{role}:{text}",)))
                options += [(step[q][r[0]], 3 + more, "R", (f"{r}:{text}",)) for r in ("user", "assistant") if r[0] in step[q]]
            for to, price, edit, line in options:
                x = (cost + price, audit + edit, lines + line)
                if to not in new or x[:2] < new[to][:2]:
                    new[to] = x
        states = close(new)
    cost, audit, lines = min((states[q] for q in (0, 3) if q in states), key=lambda x: x[:2])
    turns = {t for _, t, _, _ in rows if t is not None}
    initials = [r[2][:1] for r in rows]
    return ((max(turns) - min(turns) + 1 - len(turns)) if turns else 0, found.count("blank"), found.count("duplicate"),
            found.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def wanted(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return {c: brute(damage(own)) for c, own in groups.items()}


def results(df):
    got = {}
    for r in df.collect():
        assert r.conv_id not in got
        got[r.conv_id] = tuple(r)[1:]
    return got


def test_every_short_sequence_is_repaired_at_least_cost():
    """All sequences of up to four edits, applied one by one, against the tables."""
    texts = {"": "Hm.", "t": "Hm", "b": " "}
    for n in range(4):
        for kinds in itertools.product([(r, k) for r in ("system", "user", "assistant", "tool") for k in ("", "t")], repeat=n):
            rows = [(1, i, r, f"{i} {texts[k]}") for i, (r, k) in enumerate(kinds)]
            got = repair.repaired([(t, r, x, 1) for _, t, r, x in rows])
            assert got == brute(rows), kinds


def everything(rows, longest):
    """Least (cost, audit) by trying every string of edits: no dynamic programming at all."""
    found, best = faults(rows), None
    for n in range(longest + 1):
        for edits in itertools.product("DIKR", repeat=n):
            if sum(e != "I" for e in edits) != len(rows):
                continue
            for choice in itertools.product("ua", repeat=sum(e in "IR" for e in edits)):
                pick, at, cost, made, ok = iter(choice), 0, 0, "", True
                for e in edits:
                    if e == "I":
                        cost, made = cost + 3, made + next(pick)
                        continue
                    fault, role = found[at], rows[at][2]
                    at += 1
                    if e == "D":
                        cost += 4
                    else:
                        ok &= fault in ("", "truncated")
                        cost += 3 * (fault == "truncated") + 3 * (e == "R")
                        made += next(pick) if e == "R" else (role[:1] or "-")
                if ok and WANTED.fullmatch(made) and (best is None or (cost, "".join(edits)) < best):
                    best = (cost, "".join(edits))
    return best


def test_against_all_edit_strings():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(1, i, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["Yes.", "No", "  ", "Why?"]))
                for i in range(rng.randint(0, 3))]
        assert brute(rows)[5:7] == everything(rows, len(rows) + 3)


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_block_length_does_not_matter(block):
    rng = random.Random(block)
    plain, blocks = repair.Tables(1), repair.Tables(block)
    for _ in range(200):
        s = bytes(rng.randrange(repair.SYMBOLS) for _ in range(rng.randrange(30)))
        left, cost = plain.back(s, 0)
        assert blocks.back(s, 0) == (left, cost) and blocks.trace(s, 0, 0) == plain.trace(s, 0, 0)
        ends, costs = blocks.sweep(s)
        assert (ends[0], costs[0]) == (left, cost)


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, longest)):
            turn = None if rng.random() < 0.03 else t + (5 if rng.random() < 0.1 else 0)
            rows.append((c, turn if not any(x[:2] == (c, turn) for x in rows) else None if turn is None else 1000 + t,
                         rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None]),
                         rng.choice([f"Text {rng.randrange(6)}.", f"cut {rng.randrange(6)}", "", " \t", None, "Same!", f"long {t} " * 50 + "?"])))
    once = {}
    for r in rows:  # one row a turn, so that the order is fixed
        once[r[:2]] = r
    return list(once.values())


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("limits", [{}, {"most_rows": 0, "piece_rows": 3}, {"most_rows": 6, "piece_rows": 4, "piece_chars": 500}])
def test_whole_and_split_conversations_against_brute_force(spark, limits):
    rows = random_rows(3, 60, 25) + [(None, 1, "user", "A."), (None, 2, "assistant", "B.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert results(repair.repair(df, **limits)) == wanted(rows)


def test_one_conversation_holds_nearly_all_rows(spark):
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No!", f"{t}?", f"{t}", ""])) for t in range(3000)]
    df = spark.createDataFrame(rows + [(8, 0, "user", "Hello.")], SCHEMA)
    got = results(repair.repair(df, most_rows=100, piece_rows=64))
    assert got == wanted(rows + [(8, 0, "user", "Hello.")])


def test_query_against_brute_force(spark, small_sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(op13_conversation_repair(spark, small_sf)) == wanted(rows)


@pytest.mark.parametrize("most_rows", [20_000, 0])
def test_defined_cases(spark, most_rows):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "Ho."), (2, None, None, None),
            (3, None, "user", "x" * 200_000), (4, 5, "", "A."), (5, 1, "user", "Same."), (5, 2, "assistant", "Same."), (5, 3, "user", "Same.")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", times int, key string")
    got = results(repair.repair(df, most_rows=most_rows, piece_rows=1))
    assert got == wanted(rows)
    assert got[1][2] == 1  # a repeated row is a duplicate
    assert repair.repair(df.limit(0), most_rows=most_rows).count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    alone = spark.createDataFrame([(dropped, 0, "user", "Gone.")], SCHEMA)
    assert results(repair.repair(alone, most_rows=most_rows)) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    named = spark.createDataFrame([("a b", 1, "user", "Hi."), (" ", 1, "user", "Hi."), (None, 1, "user", "Hi.")],
                                  "conv_id string, turn int, role string, text string")
    assert set(results(repair.repair(named, most_rows=most_rows))) == {"a b", " ", None}
