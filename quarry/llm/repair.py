"""Conversation structure repair by block tables (the method of the Four Russians).

Rows of a conversation are kept, given another role, deleted, or joined by new empty
rows, at least cost, so that its role initials read ``(s?(ua)+)?``. The costs to the end
of a conversation from each of the four states of that pattern make a cost vector; less
its smallest entry it is one of a few, since rows can be inserted at a fixed price. For
every such vector and every block of ``BLOCK`` symbols a table, made once from the edit
costs, gives the vector before the block and what was taken off. So a conversation is
worked through from its end by one lookup a block. The edits are then read from its
start: each block is expanded again, symbol by symbol, from the vector behind it, and of
the edits that keep the least cost the one of the smallest initial is taken, which makes
the audit the ASCII-least of all cheapest ones.

Symbols are a row's role initial (s, u, a or another) and whether its text is truncated.
Blank rows and repeated ones must go; they cost the same in every state, so they are no
symbols, and in the audit stand where they stood.

A conversation of at most ``most_rows`` rows and ``most_chars`` characters is repaired by
one task, many a task. Larger ones are split: equal rows are counted first, rows dealt
out by range of (conversation, turn) and cut into pieces; each piece gives the whole
function from the vector behind it to the vector before it, these are chained backward,
then the pieces' functions from state to state forward, and last each piece's edits are
made by itself. Only the digest of the repaired text, a chain by definition, is passed
over the pieces in order, one piece at a time.

Defined cases: null roles and texts count as one space, in the damage's key null ids and
turns too. Rows of equal turn follow each other by role, then by a hash of the text, then the text.
Rows that are equal in all columns are repeated rows. A null conv_id is one conversation
of its own. Other columns are ignored, whatever their names. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise

#: Costs, as the contract fixes them.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a. The state that the one role which may
#: be inserted or given next leads to, and that role.
NEXT, GIVEN = (2, 2, 3, 2), ("user", "user", "assistant", "user")
#: The state that keeping a row leads to, by its initial and the state before.
KEPT: dict[str, dict[int, int]] = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "": {}}
INITIALS = ("s", "u", "a", "")
SYMBOLS = 2 * len(INITIALS)
#: Code of a row that must go.
GONE = SYMBOLS
BLOCK = 4
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"
VISIBLE = r"[^\x20\x09-\x0D]"


def _normal(costs: list[int]) -> tuple[tuple[int, ...], int]:
    low = min(costs)
    return tuple(c - low for c in costs), low


def _options(symbol: int, state: int, after: tuple[int, ...]) -> list[tuple[str, int, int]]:
    """What can become of a row, in order of the initials: edit, cost with all that
    follows, state."""
    keep, more = KEPT[INITIALS[symbol >> 1]].get(state), CUT_OFF * (symbol & 1)
    out = [("D", DELETE + after[state], state)]
    if keep is not None:
        out.append(("K", more + after[keep], keep))
    out.append(("R", REROLE + more + after[NEXT[state]], NEXT[state]))
    return out


def _before(symbol: int, after: tuple[int, ...]) -> list[int]:
    """Costs before a row from those after it, rows inserted in front of it included."""
    own = [min(c for _, c, _ in _options(symbol, q, after)) for q in range(4)]
    # From 2 and 3 an insertion leads to the other; from 0 and 1 to 2.
    two, three = min(own[2], INSERT + own[3]), min(own[3], INSERT + own[2])
    return [min(own[0], INSERT + two), min(own[1], INSERT + two), two, three]


class Tables:
    """The cost vectors there are, and the tables of symbols and of blocks of them."""

    def __init__(self, block: int = BLOCK) -> None:
        self.block = block
        self.vectors = [(0, 2 * INSERT, INSERT, 0)]  # behind the last row
        known = {self.vectors[0]: 0}
        step: list[list[tuple[int, int]]] = []
        for v in self.vectors:  # grows while it is read
            row = []
            for symbol in range(SYMBOLS):
                new, low = _normal(_before(symbol, v))
                if new not in known:
                    known[new] = len(self.vectors)
                    self.vectors.append(new)
                row.append((known[new], low))
            step.append(row)
        self.one = np.array([[v for v, _ in row] for row in step])
        self.low = np.array([[c for _, c in row] for row in step])
        self.blocks, self.lows = self.one, self.low
        for _ in range(block - 1):
            rest, off = self.blocks, self.lows
            self.blocks = np.concatenate([self.one[rest, s] for s in range(SYMBOLS)], axis=1)
            self.lows = np.concatenate([off + self.low[rest, s] for s in range(SYMBOLS)], axis=1)
        self.steps = self.one.tolist()
        self.edits = [[[self._edit(v, s, q) for q in range(4)] for s in range(SYMBOLS)] for v in range(len(self.vectors))]

    def _edit(self, right: int, symbol: int, state: int) -> tuple[str, int]:
        """Edits at a row and the state after it: the least initials of the cheapest."""
        after, before = self.vectors[right], _before(symbol, self.vectors[right])
        out = ""
        while True:
            options = {e: (c, q) for e, c, q in _options(symbol, state, after)}
            options["I"] = (INSERT + before[NEXT[state]], NEXT[state])
            edit = min(e for e, (c, _) in options.items() if c == before[state])
            out, state = out + edit, options[edit][1]
            if edit != "I":
                return out, state

    def codes(self, symbols: bytes) -> list[int]:
        """The numbers of the blocks, cut from the end; symbols left over come first."""
        s = np.frombuffer(symbols, dtype=np.uint8)[len(symbols) % self.block:].reshape(-1, self.block)
        return (s.astype(np.int64) @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))).tolist()

    def sweep(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Of every vector behind the symbols: the vector before them, and the cost taken off."""
        at = np.arange(len(self.vectors))
        cost = np.zeros(len(at), dtype=np.int64)
        for code in reversed(self.codes(symbols)):
            cost += self.lows[at, code]
            at = self.blocks[at, code]
        for s in reversed(symbols[:len(symbols) % self.block]):
            cost += self.low[at, s]
            at = self.one[at, s]
        return at, cost

    def back(self, symbols: bytes, right: int) -> tuple[int, int]:
        """Of one vector behind the symbols: the vector before them, and the cost taken off."""
        cost = 0
        for code in reversed(self.codes(symbols)):
            cost += int(self.lows[right, code])
            right = int(self.blocks[right, code])
        for s in reversed(symbols[:len(symbols) % self.block]):
            cost += int(self.low[right, s])
            right = self.steps[right][s]
        return right, cost

    def bounds(self, symbols: bytes, right: int) -> list[int]:
        """The vectors behind the symbols left over and behind each block."""
        out = [right]
        for code in reversed(self.codes(symbols)):
            out.append(int(self.blocks[out[-1], code]))
        return out[::-1]

    def trace(self, symbols: bytes, right: int, state: int) -> tuple[list[str], int]:
        """The edits at each row, and the state after the last."""
        edits: list[str] = []
        end = len(symbols) % self.block
        at = 0
        for v in self.bounds(symbols, right):
            behind = []
            for s in reversed(symbols[at:end]):  # the block, expanded backward
                behind.append(v)
                v = self.steps[v][s]
            for s, v in zip(symbols[at:end], reversed(behind)):
                edit, state = self.edits[v][s][state]
                edits.append(edit)
            at, end = end, end + self.block
        return edits, state

    def cost(self, left: int) -> int:
        return self.vectors[left][0]

    def closing(self, state: int) -> str:
        """Insertions behind the last row."""
        return "I" * (self.vectors[0][state] // INSERT)


@lru_cache
def tables() -> Tables:
    return Tables()


class Piece:
    """A run of rows of one conversation: a code and a number of repetitions each, and
    the counts of its faults."""

    def __init__(self) -> None:
        self.codes, self.times = bytearray(), []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.chars = 0
        self.first = self.last = None

    def add(self, role: str, text: str, times: int, seen: bool) -> None:
        bare = text.strip(WHITE)
        initial = role[:1] if role[:1] in INITIALS else ""
        if not bare:
            self.blank += times
            code = GONE
        elif seen:
            self.duplicate += times
            code = GONE
        else:
            cut = bare[-1] not in ".!?"
            self.truncated += cut
            self.duplicate += times - 1
            code = 2 * INITIALS.index(initial) + cut
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += (times - 1) * (initial + initial not in LEGAL)
        self.first, self.last = initial if self.first is None else self.first, initial
        self.codes.append(code)
        self.times.append(times)
        self.roles.append(role if code != GONE else "")
        self.texts.append(text if code != GONE else "")
        self.chars += len(text)


def symbols_of(codes: bytes) -> bytes:
    return codes.replace(bytes([GONE]), b"")


def deletions(codes: bytes, times: list[int]) -> int:
    """What deleting the rows that must go, repetitions included, costs."""
    return DELETE * (sum(times) - len(symbols_of(codes)))


def written(codes: bytes, times: list[int], roles: list[str], texts: list[str], right: int,
            state: int) -> tuple[str, list[str], int]:
    """Audit and lines of a piece, and the state after it."""
    edits, after = tables().trace(symbols_of(codes), right, state)
    audit, lines, at = [], [], iter(edits)
    for code, n, role, text in zip(codes, times, roles, texts):
        if code == GONE:
            audit.append("D" * n)
            continue
        edit = next(at)
        audit.append(edit + "D" * (n - 1))
        for e in edit:
            if e == "I":
                lines.append(GIVEN[state] + ":")
            elif e == "R":
                lines.append(f"{GIVEN[state]}:{text}")
            elif e == "K":
                lines.append(f"{role}:{text}")
                state = KEPT[role[:1]][state]
            if e in "IR":
                state = NEXT[state]
    return "".join(audit), lines, after


def ending(state: int) -> tuple[str, list[str]]:
    """Audit and lines of what is inserted behind the last row."""
    audit, lines = tables().closing(state), []
    for _ in audit:
        lines.append(GIVEN[state] + ":")
        state = NEXT[state]
    return audit, lines


OUT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repaired(rows: list[tuple[object, str, str, int]]) -> tuple:
    """The result of one conversation from its rows (turn, role, text, times) in order."""
    piece, seen, turns = Piece(), set(), set()
    for turn, role, text, times in rows:
        if times:
            piece.add(role, text, times, (role, text) in seen)
            seen.add((role, text))
            if turn is not None:
                turns.add(turn)
    codes = bytes(piece.codes)
    left, taken = tables().back(symbols_of(codes), 0)
    cost = deletions(codes, piece.times) + taken + tables().cost(left)
    audit, lines, state = written(codes, piece.times, piece.roles, piece.texts, 0, 0)
    more, last = ending(state)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (int(gaps), piece.blank, piece.duplicate, piece.truncated, piece.illegal, cost, audit + more,
            hashlib.sha256("\n".join(lines + last).encode()).hexdigest())


# ------------------------------------------------------------- over all conversations

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (key, turn, role, text, times) after the damage; ``times`` is 0 for a
    dropped row, 2 for one repeated next to itself."""
    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn")).cast("binary")) % 20
    return conversations.select("conv_id", "turn", "role", "text").select(
        F.to_json(F.struct("conv_id")).alias("key"), "turn",
        F.when(kind == 4, F.lit("user")).otherwise(shown("role")).alias("role"),
        F.when(kind <= 1, F.lit("")).when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", ""))
        .otherwise(shown("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("times"))


Batches = Iterator[pa.RecordBatch]


def runs(batches: Batches, keys: list[str], columns: list[str]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Groups of neighbouring rows with equal ``keys``: (keys, rows of ``columns``), each
    row read once and in order."""
    def rows() -> Iterator[tuple]:
        for b in batches:
            for part in (b.slice(at, 1024) for at in range(0, b.num_rows, 1024)):
                yield from zip(zip(*(part[k].to_pylist() for k in keys)), zip(*(part[c].to_pylist() for c in columns)))

    source = rows()
    ahead = next(source, None)
    while ahead is not None:
        key = ahead[0]

        def own() -> Iterator[tuple]:
            nonlocal ahead
            while ahead is not None and ahead[0] == key:
                row, ahead = ahead[1], next(source, None)
                yield row

        group = own()
        yield key, group
        for _ in group:  # what was not read of it
            pass


def emit(schema: pa.Schema, rows: Iterator[tuple], most: int = 512, chars: int = 1 << 23) -> Batches:
    """Rows as batches of at most ``most`` rows and about ``chars`` characters of text."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, (str, bytes, list)))
        if len(held) >= most or size >= chars:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, h)) for h in held], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, h)) for h in held], schema=schema)


def mapped(df: DataFrame, schema: str, work: Callable[[Batches], Iterator[tuple]]) -> DataFrame:
    """``work`` over the batches of each partition, its rows in the columns of ``schema``."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])
    return df.mapInArrow(lambda batches: emit(arrow, work(batches)), schema)


def _whole(rows: DataFrame) -> DataFrame:
    """Conversations repaired by one task each."""
    order = ["turn", "role", "place", "text"]
    dealt = rows.withColumn("place", F.xxhash64("text")).repartition("key").sortWithinPartitions("key", *order)

    def work(batches: Batches) -> Iterator[tuple]:
        for (key,), own in runs(batches, ["key"], ["turn", "role", "text", "times"]):
            yield key, *repaired(list(own))

    return mapped(dealt.select("key", "turn", "role", "text", "times"), "key string, " + OUT, work)


def _pieces(rows: DataFrame, piece_rows: int, piece_chars: int) -> DataFrame:
    """Rows of large conversations cut into pieces: (key, part, no, ...), in the order of
    (part, no); equal rows are one with a number of repetitions."""
    unique = (rows.where("times > 0").groupBy("key", "turn", "role", "text").agg(F.sum("times").alias("times"))
              .withColumn("hash", F.sha2("text", 256)))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = (unique.where(F.col("text").rlike(VISIBLE)).groupBy("key", "role", "hash")
             .agg(F.min(turn).alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows"))
    # A written table, so that both sides of the join are plain exchanges and a hot text splits.
    seen = unique.join(materialise(again, "repeated"), ["key", "role", "hash"], "left").withColumn(
        "seen", F.coalesce(turn > F.col("first"), F.lit(False)).cast("int"))
    order = ["key", "turn", "role", "place"]
    dealt = (seen.withColumn("place", F.xxhash64("text")).repartitionByRange(*order)
             .sortWithinPartitions(*order, "text").select("key", "role", "text", "times", "seen"))
    counts = ["blank", "duplicate", "truncated", "illegal", "first", "last"]

    def cut(batches: Batches) -> Iterator[tuple]:
        no = 0
        for (key,), own in runs(batches, ["key"], ["role", "text", "times", "seen"]):
            piece = Piece()
            for role, text, times, before in own:
                piece.add(role, text, times, bool(before))
                if len(piece.codes) >= piece_rows or piece.chars >= piece_chars:
                    yield key, no, bytes(piece.codes), piece.times, piece.roles, piece.texts, *(getattr(piece, c) for c in counts)
                    piece, no = Piece(), no + 1
            if piece.codes:
                yield key, no, bytes(piece.codes), piece.times, piece.roles, piece.texts, *(getattr(piece, c) for c in counts)
                no += 1

    schema = ("key string, no long, codes binary, times array<long>, roles array<string>, texts array<string>, "
              "blank long, duplicate long, truncated long, illegal long, first string, last string")
    return materialise(mapped(dealt, schema, cut).withColumn("part", F.spark_partition_id()), "pieces")


def _chained(links: DataFrame, backward: bool) -> DataFrame:
    """(part, no, before): what each piece receives when its ``ends`` are followed along
    its conversation, from 0 at its end (or start)."""
    order = [F.col(c).desc() if backward else F.col(c) for c in ("part", "no")]
    dealt = links.select("key", "part", "no", "ends").repartition("key").sortWithinPartitions("key", *order)

    def follow(batches: Batches) -> Iterator[tuple]:
        for _, own in runs(batches, ["key"], ["part", "no", "ends"]):
            at = 0
            for part, no, ends in own:
                yield part, no, at
                at = ends[at]

    return materialise(mapped(dealt, "part int, no long, before int", follow), "chained")


def _split(rows: DataFrame, piece_rows: int, piece_chars: int) -> DataFrame:
    """Large conversations, each repaired by many tasks."""
    pieces = _pieces(rows, piece_rows, piece_chars)
    light = pieces.select("key", "part", "no", "codes")

    def vectors(batches: Batches) -> Iterator[tuple]:
        for (key, part), own in runs(batches, ["key", "part"], ["no", "codes"]):
            for no, codes in own:
                yield key, part, no, tables().sweep(symbols_of(codes))[0].tolist()

    def states(batches: Batches) -> Iterator[tuple]:
        for (key, part), own in runs(batches, ["key", "part"], ["no", "codes", "right"]):
            for no, codes, right in own:
                yield key, part, no, [tables().trace(symbols_of(codes), right, q)[1] for q in range(4)]

    links = "key string, part int, no long, ends array<int>"
    right = _chained(mapped(light, links, vectors), backward=True).withColumnRenamed("before", "right")
    entered = _chained(mapped(light.join(right, ["part", "no"]), links, states), backward=False).withColumnRenamed("before", "state")

    def lines(batches: Batches) -> Iterator[tuple]:
        columns = ["part", "no", "codes", "times", "roles", "texts", "right", "state", "blank", "duplicate", "truncated",
                   "illegal", "first", "last"]
        for (key,), own in runs(batches, ["key"], columns):
            for part, no, codes, times, roles, texts, right_, state, *counts in own:
                audit, out, after = written(codes, times, roles, texts, right_, state)
                left, taken = tables().back(symbols_of(codes), right_)
                yield (key, part, no, audit, "\n".join(out) if out else None, after, left, taken + deletions(codes, times), *counts)

    schema = ("key string, part int, no long, audit string, lines string, after int, left int, taken long, blank long, "
              "duplicate long, truncated long, illegal long, first string, last string")
    made = mapped(pieces.join(right, ["part", "no"]).join(entered, ["part", "no"]), schema, lines)
    turns = rows.where("times > 0").groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    ordered = (made.join(turns, "key").repartition("key").sortWithinPartitions("key", "part", "no"))

    def chain(batches: Batches) -> Iterator[tuple]:
        columns = ["gaps", "audit", "lines", "after", "left", "taken", "blank", "duplicate", "truncated", "illegal", "first", "last"]
        for (key,), own in runs(batches, ["key"], columns):
            digest, begun, audits, sums, cost, last, gaps, state = hashlib.sha256(), False, [], np.zeros(4, dtype=object), None, None, 0, 0

            def put(text: str) -> None:
                nonlocal begun
                digest.update((b"\n" if begun else b"") + text.encode())
                begun = True

            for gaps, audit, text, state, left, taken, blank, duplicate, truncated, illegal, first, end in own:
                cost = (tables().cost(left) if cost is None else cost) + taken
                audits.append(audit)
                if text is not None:
                    put(text)
                sums += (blank, duplicate, truncated, illegal + (last is not None and last + first not in LEGAL))
                last = end
            more, added = ending(state)
            for line in added:
                put(line)
            yield (key, gaps, *(int(x) for x in sums), int(cost), "".join(audits) + more, digest.hexdigest())

    return mapped(ordered, "key string, " + OUT, chain)


def repair(conversations: DataFrame, *, most_rows: int = 20_000, most_chars: int = 1 << 25, piece_rows: int = 4096,
           piece_chars: int = 1 << 22) -> DataFrame:
    """One row per conv_id: the faults after the damage, the cheapest edits and the digest
    of the repaired conversation."""
    rows = damaged(conversations)
    chars = F.when(F.col("times") > 0, F.length("text") + F.length("role"))
    sizes = rows.groupBy("key").agg(F.sum("times").alias("rows"), F.sum(chars).alias("chars"))
    large = materialise(sizes.where((F.col("rows") > most_rows) | (F.col("chars") > most_chars)).select("key"), "large")
    if large.isEmpty():
        out = _whole(rows)
    else:
        out = _whole(rows.join(large, "key", "left_anti")).unionByName(
            _split(rows.join(large, "key", "left_semi"), piece_rows, piece_chars))
    conv_id = F.from_json("key", conversations.select("conv_id").schema)["conv_id"]
    return out.select(conv_id.alias("conv_id"), *[c.split()[0] for c in OUT.split(", ")])
