"""SentencePiece encoding of the merge type with seeded dropout, and decoding.

A pre-token starts as its characters. An agenda holds every neighbouring pair whose
union is a piece, best rank first and leftmost on ties; a popped pair is merged,
unless the draw for this candidate drops it, in which case it is gone for good. The draws
are keyed by the seed, the document's id and the pre-token's number in it: every
occurrence of a word is cut by itself, and a re-run cuts everything as before. As each
candidate is dropped with the same chance, what is drawn is the number of candidates up
to the next dropped one. With ``dropout`` 0 the result is the library's own encoding.

What a worker remembers of a pre-token depends on no draw: the segmentation where nothing
is dropped, the one where the first candidate is, the second, and so on, each made when
first asked for. An occurrence looks up the number of candidates it lets through, and
goes on from there if a drop lies before the last of them. Draws are made for all
occurrences of a batch at once. When too much is remembered, what has not been met again
lately is forgotten.

Decoding gives the text back exactly, whatever was dropped: spaces are pieces,
other characters outside the vocabulary are bytes, and so is a literal space mark.

Defined cases: a null text encodes to null ids (decoded: null), an empty one to no
ids. Repeated rows are encoded alike. A null id is an id of its own. Other columns are
carried; one named like an output column is replaced by it.
"""

from __future__ import annotations

import heapq
import math
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.llm.common import carried, give_back, unused, worker_cache
from quarry.llm.pieces import SPACE, Vocabulary
from quarry.session import bound_batches


#: Parts up to this long keep their agenda as a plain list that is scanned for its
#: best entry, which is quicker than a heap there; the result is the same. Pre-tokens up
#: to this long are remembered.
_SHORT = 40
_NONE = 1 << 60
#: More candidates than a remembered pre-token can have: each merge makes two new ones.
_MOST_CANDIDATES = 3 * _SHORT + 8
#: Bits of a place in an agenda; an entry of none (less some places, it stays above ``_NONE``).
_PLACE_BITS, _FREE = 6, 1 << 62
#: Pre-tokens of one length worked on at once, at most; if fewer than ``_FEW``, with longer ones.
_AT_ONCE, _FEW = 4096, 512
#: How often what is remembered may be cleared of what was not met since, until a
#: pre-token that was met again is forgotten.
_STAYS = 3


class Drops:
    """The candidates to drop, by their number among all that are popped."""

    def __init__(self, numbers: Iterator[int]) -> None:
        self.numbers, self.at = numbers, 0
        self.next = next(numbers, _NONE)

    def drop(self) -> bool:
        """Whether the candidate now popped is dropped."""
        self.at += 1
        if self.at <= self.next:
            return False
        self.next = next(self.numbers, _NONE)
        return True


def merge_part(s: str, vocabulary: Vocabulary, drops: Drops) -> list[str]:
    """Segment one part."""
    if len(s) > _SHORT:
        return _merge_long(s, vocabulary, drops)
    rank, none = vocabulary.rank.get, _NONE
    symbols = list(s)
    agenda = [rank(a + b, none) for a, b in zip(s, s[1:])]
    left = len(agenda)
    while left:
        best = min(agenda)
        if best == none:
            break
        i = agenda.index(best)
        drops.at += 1
        if drops.at > drops.next:
            drops.next = next(drops.numbers, none)
            agenda[i] = none
            continue
        joined = symbols[i] + symbols[i + 1]
        symbols[i] = joined
        del symbols[i + 1], agenda[i]
        left -= 1
        if i < left:
            agenda[i] = rank(joined + symbols[i + 1], none)
        if i:
            agenda[i - 1] = rank(symbols[i - 1] + joined, none)
    return symbols


def _merge_long(s: str, vocabulary: Vocabulary, drops: Drops) -> list[str]:
    """The same with a heap: n log n for parts of any length."""
    rank, n = vocabulary.rank, len(s)
    symbol: list[str | None] = list(s)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    agenda = [(r, i) for i in range(n - 1) if (r := rank.get(s[i:i + 2])) is not None]
    heapq.heapify(agenda)
    waiting = {i: s[i:i + 2] for _, i in agenda}  # the pair at each place
    while agenda:
        popped, i = heapq.heappop(agenda)
        left, j = symbol[i], after[i]
        if left is None or j >= n:
            continue
        joined = left + symbol[j]
        if rank.get(joined) != popped or waiting.get(i) != joined:
            continue  # one side has changed since
        del waiting[i]
        if drops.drop():
            continue
        symbol[i], symbol[j] = joined, None
        waiting.pop(j, None)
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        for place, pair in ((i, joined + symbol[k] if k < n else ""), (before[i], (symbol[before[i]] or "") + joined)):
            if place < 0 or not pair:
                continue
            r = rank.get(pair)
            if r is None:
                waiting.pop(place, None)
            else:
                waiting[place] = pair
                heapq.heappush(agenda, (r, place))
    return [x for x in symbol if x is not None]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed word of each (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _times(x: np.ndarray) -> np.ndarray:
    """A multiple of the step for each number, modulo 2^64."""
    return np.asarray(x).astype(np.uint64) * np.array([_STEP])


class Agendas:
    """The agendas of many short pre-tokens worked on at once, each step popping one
    candidate of every one of them; the same as ``merge_part`` on each.

    An agenda's entry is a rank, a place and the number of the union, so that the least
    one is the best, leftmost on ties; from ``_NONE`` on there is none."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        names = list(vocabulary.ids) + sorted({c for p in vocabulary.ids for c in p if c not in vocabulary.ids})
        number = {x: i for i, x in enumerate(names)}
        self.none = len(names)  # no symbol, or one of no piece
        self.of_char = np.full(0x110000, self.none, dtype=np.int32)
        for c, i in number.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.of_char[ord(" ")] = self.of_char[ord(SPACE)]
        self.ids = np.array([vocabulary.ids.get(x, -1) for x in names] + [-1], dtype=np.int32)
        bits = self.bits = self.none.bit_length()
        if 3 * bits + _PLACE_BITS > 60:
            raise ValueError(f"{self.none} symbols are too many")
        self.owner_at = 2 * bits + _PLACE_BITS
        by_left: dict[int, list[tuple[int, int, int]]] = {}
        for p in vocabulary.ids:
            for k in range(1, len(p)):
                if p[:k] in number and p[k:] in number:
                    by_left.setdefault(number[p[:k]], []).append(
                        (number[p[k:]], vocabulary.rank[p] << bits + _PLACE_BITS, number[p]))
        # The unions, a row for each left symbol, all rows in one table: each is shifted so
        # far that its cells fall on free places, which then name their row.
        rows = sorted(by_left.items(), key=lambda x: -len(x[1]))
        most = 8 * sum(len(row) for _, row in rows) + 1024
        self.shift = np.full(self.none + 1, most, dtype=np.int64)
        self.cell = np.full(most + self.none + 1, self.none << self.owner_at, dtype=np.int64)
        rng = np.random.default_rng(0)
        for left, row in rows:
            right, rank, union = np.array(row, dtype=np.int64).T
            while (self.cell[(at := int(rng.integers(1, most))) + right] >> self.owner_at != self.none).any():
                pass
            self.shift[left] = at
            self.cell[at + right] = (left << self.owner_at) | rank | union

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Entries, without their places, of the pairs of symbols a and b."""
        cell = self.cell[self.shift[a] + b]
        found = (cell >> self.owner_at == a) & (a != self.none)
        return np.where(found, cell & ((1 << self.owner_at) - 1), _FREE)

    def run(self, words: list[str], paths: list[tuple[int, ...]]) -> tuple[list[bytes | None], np.ndarray]:
        """Ids of each word (None where it holds what is no piece) and the number of
        candidates popped, the candidates of its path being dropped."""
        ids, at, counts, popped, whole = self.segment(words, *_masks(paths))
        return [ids[i:i + n].tobytes() if good else None for i, n, good in zip(at, counts, whole)], popped

    def segment(self, words: list[str], low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ids of all words; of each word where its own begin, their number, the number of
        candidates popped, and whether it holds only pieces. The candidates whose bits are
        set (from the 64th on in ``high``) are dropped."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        chars = self.of_char[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        starts = np.cumsum(sizes) - sizes
        order = np.argsort(sizes, kind="stable")
        ordered = sizes[order]
        at, counts, popped = (np.zeros(len(words), dtype=np.int64) for _ in range(3))
        whole = np.ones(len(words), dtype=bool)
        out, total, begin = [np.zeros(0, dtype=np.int32)], 0, 0
        while begin < len(words):  # words of about one length, so many at a time
            end = min(begin + _AT_ONCE, len(words))
            alike = int(np.searchsorted(ordered, ordered[begin] + 1))
            end = min(end, max(alike, min(begin + _FEW, int(np.searchsorted(ordered, ordered[begin] + 6)))))
            some = order[begin:end]
            begin = end
            symbols, left, popped[some] = self._block(chars, starts[some], sizes[some], low[some], high[some])
            there = np.arange(len(symbols))[:, None] < left
            found = self.ids[symbols]
            whole[some] = ~((found < 0) & there).any(axis=0)
            out.append(found.T[there.T])
            counts[some], at[some] = left, total + np.cumsum(left) - left
            total += len(out[-1])
        return np.concatenate(out), at, counts, popped, whole

    def _block(self, chars: np.ndarray, starts: np.ndarray, sizes: np.ndarray, low: np.ndarray,
               high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols (a column a word), their number, and the number of candidates popped.

        Rows are places, from 1 on; the first and last one hold no symbol. What stands
        behind a merged pair moves up by one. Columns that are done are taken out when
        they are many."""
        n, width = len(sizes), int(sizes.max())
        row = np.arange(width)[:, None]
        symbols = np.full((width + 2, n), self.none, dtype=np.int32)
        symbols[1:-1] = np.where(row < sizes, chars[np.minimum(starts + row, len(chars) - 1)], self.none)
        agenda = np.full((width + 2, n), _FREE, dtype=np.int64)
        agenda[1:width] = self._pairs(symbols[1:width], symbols[2:width + 1]) + (row[1:] << self.bits)
        dropping = bool(low.any() or high.any())
        rows = np.arange(width + 2, dtype=np.int8)[:, None]
        final, counts, popped = np.full((width, n), self.none, dtype=np.int32), sizes.copy(), np.zeros(n, dtype=np.int64)
        every = column = np.arange(n)
        left, steps, step = sizes.copy(), np.zeros(n, dtype=np.int64), 0
        while True:
            best = agenda.min(axis=0)
            open_ = best < _NONE
            if 4 * (going := np.count_nonzero(open_)) <= 3 * len(best):
                over = np.flatnonzero(~open_)
                final[:len(symbols) - 2, column[over]] = symbols[1:-1, over]
                counts[column[over]], popped[column[over]] = left[over], steps[over]
                if not going:
                    return final, counts, popped
                stay = np.flatnonzero(open_)
                symbols, agenda = symbols.take(stay, axis=1), agenda.take(stay, axis=1)
                best, open_, column, left = best[stay], open_[stay], column[stay], left[stay]
                low, high, steps, every = low[stay], high[stay], steps[stay], every[:going]
            m = len(best)
            steps += open_
            place = (best >> self.bits) & ((1 << _PLACE_BITS) - 1)
            merged = every
            if dropping:
                gone = ((low if step < 64 else high) >> np.uint64(step % 64)) & np.uint64(1) == 1
                gone &= open_
                if gone.any():
                    which = np.flatnonzero(gone)
                    agenda[place[which], which] = _FREE
                    open_ = open_ & ~gone
            step += 1
            behind = place.astype(np.int8)
            if not open_.all():
                merged = np.flatnonzero(open_)
                behind[~open_] = 127
                place, best = place[merged], best[merged]
                if not len(merged):
                    continue
            moved = rows[:len(symbols) - 1] > behind
            symbols[:-1] = np.where(moved, symbols[1:], symbols[:-1])
            agenda[:-1] = np.where(moved, agenda[1:] - (1 << self.bits), agenda[:-1])
            union = (best & ((1 << self.bits) - 1)).astype(np.int32)
            at = place * m + merged
            own, entries = symbols.reshape(-1), agenda.reshape(-1)
            own[at] = union
            place <<= self.bits
            entries[at] = self._pairs(union, own[at + m]) + place
            entries[at - m] = self._pairs(own[at - m], union) + (place - (1 << self.bits))
            left[merged] -= 1
            height = int(left.max()) + 2
            symbols, agenda = symbols[:height], agenda[:height]


def _gathered(values: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that begin at ``at``, one behind another."""
    place = np.repeat(at - (np.cumsum(size) - size), size)
    place += np.arange(len(place))
    return values[place]


def _sums(size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of so many sizes each."""
    upto = np.concatenate([[0], np.cumsum(size)])
    return np.diff(upto[np.cumsum(counts)], prepend=0).astype(np.int64)


_BLANK, _LETTER, _MARK, _OTHER = range(4)


def _kinds(vocabulary: Vocabulary) -> np.ndarray:
    """By code point: blank, letter, mark (alone a pre-token), or another, as the vocabulary
    cuts pre-tokens."""
    kinds = np.full(0x110000, _OTHER, dtype=np.uint8)
    every = np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for x in vocabulary.letters.finditer(every):
        kinds[x.start():x.end()] = _LETTER
    kinds[ord(" ")], kinds[ord("\n")], kinds[ord(SPACE)] = _BLANK, _MARK, _MARK
    return kinds


def _masks(paths: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of each path as the bits of two words."""
    if not any(paths):
        return np.zeros(len(paths), dtype=np.uint64), np.zeros(len(paths), dtype=np.uint64)
    whole = [sum(1 << x for x in path) for path in paths]
    low, high = (np.array([x >> at & (1 << 64) - 1 for x in whole], dtype=np.uint64) for at in (0, 64))
    return low, high


class Segmenter:
    """Encodes pre-tokens; remembers up to ``most`` of their segmentations per worker.

    A remembered segmentation is a node: its ids, the number of candidates popped after
    its last drop, and by the number let through before a further drop the next node."""

    #: Of each node its pre-token's candidates dropped (bits of two words) and the last of them,
    #: the candidates popped after that, whether it was met lately, again after it was made,
    #: and where its ids begin and how many they are.
    _COLUMNS = {"low": np.uint64, "high": np.uint64, "last": np.int16, "left": np.int16, "met": np.uint8,
                "at": np.int64, "size": np.int32}

    def __init__(self, vocabulary: Vocabulary, dropout: float, seed: int, most: int = 100_000) -> None:
        self.v, self.seed, self.most, self.dropout = vocabulary, seed, most, dropout
        self.agendas = Agendas(vocabulary)
        self.kinds = _kinds(vocabulary)
        self.raw = np.frombuffer(b"".join(vocabulary.raw), dtype=np.uint8)
        self.raw_size = np.array([len(x) for x in vocabulary.raw], dtype=np.int64)
        self.raw_at = np.cumsum(self.raw_size) - self.raw_size
        self.forget()

    def forget(self) -> None:
        self.tokens: list[str] = []  # of each node
        for name, kind in self._COLUMNS.items():
            setattr(self, name, np.zeros(1024, dtype=kind))
        self.pool, self.used = np.zeros(4096, dtype=np.int32), 0  # the ids of all nodes
        self.first: dict[str, int] = {}
        self.further, self.next = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)  # sorted keys, nodes

    @property
    def ids(self) -> list[bytes]:
        return [self.pool[at:at + n].tobytes() for at, n in zip(self.at[:len(self.tokens)], self.size)]

    @property
    def paths(self) -> list[tuple[str, tuple[int, ...]]]:
        return [(t, self._path(i)) for i, t in enumerate(self.tokens)]

    def _path(self, node: int) -> tuple[int, ...]:
        dropped = int(self.low[node]) | int(self.high[node]) << 64
        return tuple(x for x in range(dropped.bit_length()) if dropped >> x & 1)

    def shrink(self) -> None:
        """Forget what was not met again lately, or all where little would go. A node is met
        whenever one behind it is, so those behind a forgotten one are forgotten too."""
        n = len(self.tokens)
        for least in range(1, _STAYS + 1):
            kept = np.flatnonzero(self.met[:n] >= least)
            if 2 * len(kept) <= self.most:
                break
        else:
            return self.forget()
        number = np.full(n, -1, dtype=np.int64)
        number[kept] = np.arange(len(kept))
        self.tokens = list(map(self.tokens.__getitem__, kept.tolist()))
        for name, kind in self._COLUMNS.items():
            setattr(self, name, np.concatenate([getattr(self, name)[kept], np.zeros(1024, dtype=kind)]))
        self.met[:len(kept)] -= 1
        size = self.size[:len(kept)].astype(np.int64)
        self.pool = _gathered(self.pool, self.at[:len(kept)], size)
        self.used = len(self.pool)
        self.at[:len(kept)] = np.cumsum(size) - size
        places = number.tolist()
        self.first = {t: places[i] for t, i in self.first.items() if places[i] >= 0}
        stay = number[self.next] >= 0
        key = self.further[stay]
        self.further = number[key // _MOST_CANDIDATES] * _MOST_CANDIDATES + key % _MOST_CANDIDATES
        self.next = number[self.next[stay]]

    def _nodes(self, asked: list[tuple[str, tuple[int, ...]]]) -> range:
        """New nodes of pre-tokens and the candidates dropped."""
        last = np.fromiter((path[-1] if path else -1 for _, path in asked), dtype=np.int16, count=len(asked))
        return self._made([t for t, _ in asked], *_masks([path for _, path in asked]), last)

    def _made(self, tokens: list[str], low: np.ndarray, high: np.ndarray, last: np.ndarray) -> range:
        """New nodes of pre-tokens and the candidates dropped, the last of them given again."""
        start = len(self.tokens)
        end = start + len(tokens)
        if end > len(self.left):
            more = max(end, start + start // 2) - len(self.left)
            for name, kind in self._COLUMNS.items():
                setattr(self, name, np.concatenate([getattr(self, name), np.zeros(more, dtype=kind)]))
        self.tokens += tokens
        new = slice(start, end)
        self.low[new], self.high[new], self.last[new] = low, high, last
        found, self.at[new], self.size[new], self.left[new], whole = self.agendas.segment(tokens, low, high)
        self.at[new] += self._kept(found)
        if SPACE in tokens:
            whole[tokens.index(SPACE)] = False
        for i in np.flatnonzero(~whole).tolist():
            drops = Drops(iter(self._path(start + i)))
            ids = np.frombuffer(self.token(tokens[i], drops), dtype=np.int32)
            self.at[start + i], self.size[start + i], self.left[start + i] = self._kept(ids), len(ids), drops.at
        self.left[new] -= last + 1
        return range(start, end)

    def _kept(self, ids: np.ndarray) -> int:
        """Where in the pool these ids begin now."""
        at, self.used = self.used, self.used + len(ids)
        if self.used > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(self.used, at + at // 2) - len(self.pool), dtype=np.int32)])
        self.pool[at:self.used] = ids
        return at

    def _further_nodes(self, keys: np.ndarray) -> None:
        """Nodes of new keys (sorted, distinct)."""
        node = keys // _MOST_CANDIDATES
        dropped = self.last[node] + 1 + keys % _MOST_CANDIDATES
        bit = np.uint64(1) << (dropped % 64).astype(np.uint64)
        low = self.low[node] | np.where(dropped < 64, bit, np.uint64(0))
        high = self.high[node] | np.where(dropped < 64, np.uint64(0), bit)
        made = self._made(list(map(self.tokens.__getitem__, node.tolist())), low, high, dropped.astype(np.int16))
        at = np.searchsorted(self.further, keys)
        self.further = np.insert(self.further, at, keys)
        self.next = np.insert(self.next, at, np.arange(made.start, made.stop))

    def _known(self, keys: np.ndarray) -> np.ndarray:
        """Which keys have their node."""
        if not len(self.further):
            return np.zeros(len(keys), dtype=bool)
        return self.further[np.minimum(np.searchsorted(self.further, keys), len(self.further) - 1)] == keys

    def token(self, t: str, drops: Drops) -> bytes:
        """The ids of a pre-token; long ones are cut where no piece crosses."""
        if t == SPACE:
            return np.array(self.v.fallback(t), dtype=np.int32).tobytes()
        parts = [t.replace(" ", SPACE)] if len(t) <= _SHORT else self.v.parts(t)
        symbols = [x for s in parts for x in merge_part(s, self.v, drops)]
        try:
            return array("i", map(self.v.ids.__getitem__, symbols)).tobytes()
        except KeyError:
            out: list[int] = []
            for piece in symbols:
                i = self.v.ids.get(piece)
                out += self.v.fallback(piece) if i is None else [i]
            return array("i", out).tobytes()

    def let_through(self, keys: np.ndarray, number: int) -> np.ndarray:
        """How many candidates each occurrence lets through before its next drop."""
        uniform = ((_mixed(keys + _times([number + 1])) >> np.uint64(11)) + np.uint64(1)) * 2.0 ** -53
        if self.dropout >= 1:
            return np.zeros(len(keys), dtype=np.int64)
        return np.minimum(np.log(uniform) / math.log1p(-self.dropout), 2.0 ** 62).astype(np.int64)

    def _own(self, token: str, key: np.uint64) -> bytes:
        """A pre-token too long to be remembered, with its own draws."""
        def numbers() -> Iterator[int]:
            at = number = 0
            while True:
                at += int(self.let_through(np.array([key], dtype=np.uint64), number)[0])
                yield at
                at, number = at + 1, number + 1

        return self.token(token, Drops(numbers() if self.dropout > 0 else iter(())))

    def cut(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct pre-tokens of the texts, of each occurrence the number of its own, and
        the occurrences of each text; as ``Vocabulary.pre_tokens`` cuts them."""
        whole = "".join([f" {t}" for t in texts if t])
        if not whole:
            return [], np.zeros(0, dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lengths = np.fromiter((len(t) + 1 if t else 0 for t in texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(lengths)
        kind = self.kinds[codes]
        begins = np.ones(len(codes), dtype=bool)
        # A pre-token begins where the kind changes, but not behind spaces, and at every mark.
        begins[1:] = (kind[1:] == _MARK) | (kind[:-1] == _MARK) | ((kind[1:] != kind[:-1]) & (kind[:-1] != _BLANK))
        begins[(ends - lengths)[lengths > 0]] = True
        starts = np.flatnonzero(begins)
        bounds = np.append(starts, len(codes))
        rows = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds * 4), pa.py_buffer(codes)])
        number = rows.dictionary_encode().indices.to_numpy().astype(np.int64)
        where = np.zeros(int(number.max()) + 1, dtype=np.int64)
        where[number] = np.arange(len(number))
        distinct = [whole[a:b] for a, b in zip(starts[where].tolist(), bounds[where + 1].tolist())]
        return distinct, number, np.diff(np.searchsorted(starts, ends), prepend=0)

    def encode_flat(self, texts: list[str], documents: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind another, and how many each has; a text's draws are
        keyed by its document's number."""
        if len(self.tokens) > self.most:
            self.shrink()
        older = len(self.tokens)
        distinct, number, counts = self.cut(texts)
        node = np.fromiter(map(self.first.get, distinct, repeat(-1)), dtype=np.int64, count=len(distinct))
        self.met[node[node >= 0]] = _STAYS
        new = [i for i in np.flatnonzero(node < 0).tolist() if len(distinct[i]) <= _SHORT]
        if new:
            made = self._nodes([(distinct[i], ()) for i in new])
            node[new] = made
            self.first.update((distinct[i], k) for i, k in zip(new, made))
        node = node[number]
        keys = np.zeros(len(node), dtype=np.uint64)
        if self.dropout > 0 and len(node):
            document = _mixed(np.array(documents, dtype=np.int64).astype(np.uint64) + _times([self.seed + 1]))
            place = (np.arange(len(node)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
            keys = _mixed(np.repeat(document, counts) + _times(place + 1))
            # Where nothing can be merged, nothing is drawn.
            open_, drawn = np.flatnonzero((node >= 0) & (self.left[node] > 0)), 0
            while len(open_):
                let = self.let_through(keys[open_], drawn)
                hit = let < self.left[node[open_]]
                open_, let, drawn = open_[hit], let[hit], drawn + 1
                asked = node[open_] * _MOST_CANDIDATES + let
                new = asked[~self._known(asked)]
                if len(new):
                    self._further_nodes(np.unique(new))
                found = self.next[np.searchsorted(self.further, asked)]
                node[open_] = found
                self.met[found[found < older]] = _STAYS
        at, size, pool = self.at[node], self.size[node].astype(np.int64), self.pool
        if len(long := np.flatnonzero(node < 0)):
            own = [np.frombuffer(self._own(distinct[number[i]], keys[i]), dtype=np.int32) for i in long.tolist()]
            size[long] = [len(x) for x in own]
            at[long] = self.used + np.cumsum(size[long]) - size[long]
            pool = np.concatenate([pool[:self.used], *own])
        return _gathered(pool, at, size), _sums(size, counts)

    def encode_all(self, texts: list[str], documents: list[int]) -> list[np.ndarray]:
        """The ids of each text."""
        ids, counts = self.encode_flat(texts, documents)
        return np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []

    def lossless(self, ids: np.ndarray, counts: np.ndarray, texts: list[str | None]) -> list[bool]:
        """Whether so many ids of each text decode to it."""
        out, end = [], np.concatenate([[0], np.cumsum(counts)])
        for low in range(0, len(texts), 64):  # a byte takes several numbers here
            some = texts[low:low + 64]
            own = ids[end[low]:end[low + len(some)]]
            size = self.raw_size[own]
            found = _gathered(self.raw, self.raw_at[own], size).tobytes()
            ends = np.cumsum(_sums(size, counts[low:low + 64])).tolist()
            out += [found[at + 1:upto] == (t or "").encode("utf-8", "surrogatepass")
                    for at, upto, t in zip([0, *ends], ends, some)]
        return out

    def encode(self, text: str, document: int) -> np.ndarray:
        return self.encode_all([text], [document])[0]


def decode(ids: np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of ``ids``: pieces and bytes joined, without the dummy space."""
    ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
    return b"".join(map(vocabulary.raw.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


def few_texts(batch: pa.RecordBatch, text: str, rows: int, chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of up to so many rows and characters, a longer text alone."""
    upto = np.cumsum(pc.fill_null(pc.utf8_length(batch[text]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(batch):
        end = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + chars, side="right"))
        end = max(at + 1, min(end, at + rows))
        yield batch.slice(at, end - at)
        at = end


def encode(docs: DataFrame, vocabulary: Vocabulary, *, text: str = "text", key: str = "doc_id",
           dropout: float = 0.1, seed: int = 17, keep: list[str] | None = None, lossless: str | None = None,
           rows_each: int = 1024) -> DataFrame:
    """Columns ``keep`` (default: all), token_ids, n_tokens, and with ``lossless`` a
    column of that name: whether the ids decode to the text (null for a null one)."""
    keep = carried(docs, keep, [], ["token_ids", "n_tokens", lossless])
    body, document = unused(docs, "text_"), unused(docs, "document_")
    rows = docs.select(*keep, F.col(text).cast("string").alias(body), F.xxhash64(F.col(key).cast("string")).alias(document))
    out = T.StructType(rows.select(*keep).schema.fields
                       + [T.StructField("token_ids", T.ArrayType(T.IntegerType(), False)),
                          T.StructField("n_tokens", T.LongType())]
                       + ([T.StructField(lossless, T.BooleanType())] if lossless else []))
    arrow = to_arrow_schema(out)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        seg = worker_cache(("bpe", v.key, dropout, seed), lambda: Segmenter(v, dropout, seed))
        for whole in batches:
            for batch in few_texts(whole, body, rows_each):  # so many texts and ids at a time
                texts = batch[body].to_pylist()
                known = [i for i, t in enumerate(texts) if t is not None]
                numbers = batch[document].to_pylist()
                counts = np.zeros(len(texts), dtype=np.int64)
                ids, counts[known] = seg.encode_flat([texts[i] for i in known], [numbers[i] for i in known])
                null = pa.array(np.isin(np.arange(len(texts)), known, invert=True))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids, pa.int32()), mask=null)
                cols = [batch[c] for c in keep] + [lists, pc.if_else(null, None, counts)]
                if lossless:
                    cols.append(pc.if_else(null, None, pa.array(seg.lossless(ids, counts, texts))))
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)
        give_back()

    return rows.mapInArrow(run, out)


def decode_column(rows: DataFrame, vocabulary: Vocabulary, ids: str = "token_ids",
                  out: str = "decoded") -> DataFrame:
    """``rows`` with the decoded text of the column ``ids``."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("string")
    def text(x):
        v = shared.value
        return x.map(lambda a: None if a is None else decode(a, v))

    return rows.withColumn(out, text(F.col(ids)))
