"""External induced sorting: the suffixes of a text in order, with the length of the prefix each shares with the one before.

A suffix is larger (L) or smaller (S) than the one that starts a place later. An
S suffix after an L one is a seed. Once the seeds are in order, one ascending
sweep induces the L suffixes and one descending sweep the S suffixes: whoever is
taken from the queue puts the suffix that starts a place earlier into the queue
of its first symbol. The seeds get their order from the same sweeps: a first pair
sorts the substrings between seeds, their ranks are the symbols of a shorter
text, and that text is sorted by recursion.

The queues are monotone priority queues: keys are taken in one direction, and a
key never goes in front of one already taken. They hold tuples of a place and
the turn at which the following suffix was taken. Symbols of a small alphabet
have a queue each, in which tuples arrive in their order. In the recursion a
queue serves a range of symbols; its tuples are sorted when it is reached,
together with those they induce in the same range.

Common prefixes are carried along. Two neighbours taken from one queue share
their first symbol and what the suffixes after them share, which is the least of
the values between the turns of these. Where larger and smaller suffixes of one
symbol meet, the shorter run of that symbol decides. Values between neighbouring
seeds are read off the text. Values are cut off at ``most``.

Queues beyond a memory limit continue in a file without a name, which vanishes
with the process, and arrays over the places of a text are mapped from such
files, so a text may be far larger than the memory.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY = 48 << 20  # bytes of queues; an array above an eighth of it is mapped from a file
BATCH = 1 << 18  # tuples that are handled together
SMALL = 256  # symbols that get a queue each


class Disk:
    """Memory up to a limit, and files without a name beyond it."""

    def __init__(self, limit: int = MEMORY):
        self.limit, self.held, self.file, self.end = limit, 0, None, 0

    def array(self, n: int, kind) -> np.ndarray:
        if n * np.dtype(kind).itemsize <= self.limit // 8:
            return np.zeros(n, kind)
        with tempfile.TemporaryFile() as file:  # the mapping keeps it
            return np.memmap(file, kind, "w+", shape=(n,))

    def put(self, piece: np.ndarray):
        if self.held + piece.nbytes <= self.limit:
            self.held += piece.nbytes
            return piece
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        at, self.end = self.end, self.end + piece.nbytes
        os.pwrite(self.file.fileno(), np.ascontiguousarray(piece).data, at)
        return at, piece.shape, piece.dtype

    def get(self, held) -> np.ndarray:
        if isinstance(held, np.ndarray):
            self.held -= held.nbytes
            return held
        at, shape, kind = held
        data = os.pread(self.file.fileno(), int(np.prod(shape)) * kind.itemsize, at)
        return np.frombuffer(data, kind).reshape(shape)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Queue:
    """Tuples, a row for each field, in the order in which they came."""

    def __init__(self, disk: Disk):
        self.disk, self.pieces = disk, []

    def push(self, *fields: np.ndarray) -> None:
        if len(fields[0]):
            self.pieces.append(self.disk.put(np.stack(fields)))

    def batches(self, backward: bool = False) -> Iterator[np.ndarray]:
        """The tuples, emptying the queue; small pieces come together."""
        pieces, self.pieces = self.pieces, []
        held, n = [], 0
        for piece in reversed(pieces) if backward else pieces:
            rows = self.disk.get(piece)
            held.append(rows[:, ::-1] if backward else rows)
            n += rows.shape[1]
            if n >= BATCH:
                yield np.concatenate(held, axis=1)
                held, n = [], 0
        if held:
            yield np.concatenate(held, axis=1)


def _blocks(n: int, backward: bool = False) -> list[slice]:
    cut = [slice(a, min(a + BATCH, n)) for a in range(0, n, BATCH)]
    return cut[::-1] if backward else cut


def smaller_types(text: np.ndarray, disk: Disk) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last, a lone least symbol, is."""
    out = disk.array(len(text), bool)
    following, kind = None, True
    for at in _blocks(len(text), backward=True):
        part = text[at].astype(np.int64)
        after = np.append(part[1:], part[-1] if following is None else following)
        step = after - part
        place = np.where(step != 0, np.arange(len(part)), len(part))
        decides = np.minimum.accumulate(place[::-1])[::-1]  # the next place whose symbol differs from its successor
        known = decides < len(part)
        out[at] = np.where(known, step[np.minimum(decides, len(part) - 1)] > 0, kind)
        following, kind = part[0], bool(out[at.start])
    return out


def _seeds(smaller: np.ndarray, disk: Disk) -> np.ndarray:
    found = []
    for at in _blocks(len(smaller)):
        low = max(at.start, 1)
        found.append(np.flatnonzero(smaller[low : at.stop] & ~smaller[low - 1 : at.stop - 1]) + low)
    out, end = disk.array(sum(map(len, found)), _place_kind(len(smaller))), 0
    for part in found:
        out[end : end + len(part)] = part
        end += len(part)
    return out


def _place_kind(n: int) -> type:
    return np.int32 if n < 1 << 31 else np.int64


def _ranges(text: np.ndarray, n_symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """``(range of each symbol, first symbol of each range)``: ranges of about a batch of places, or one frequent symbol."""
    if n_symbols <= SMALL:
        return np.arange(n_symbols), np.arange(n_symbols + 1)
    counts = np.zeros(n_symbols, np.int64)
    for at in _blocks(len(text)):
        counts += np.bincount(text[at], minlength=n_symbols)
    frequent = counts >= BATCH // 4
    block = (np.cumsum(counts) - counts) // BATCH
    new = np.append(True, (np.diff(block) > 0) | frequent[1:] | frequent[:-1])
    return np.cumsum(new) - 1, np.append(np.flatnonzero(new), n_symbols)


def _settle(symbol: np.ndarray, fixed: np.ndarray, link: np.ndarray) -> np.ndarray:
    """The order of tuples of one range.

    By symbol, induced ones before fixed ones, those without a ``link`` first
    and as they came, the others by what they are linked to (the tuple that
    induces them), which is resolved by doubling the length of the links.
    """
    n = len(symbol)
    linked = link >= 0
    key = ((symbol - symbol.min()) * 4 + fixed * 2 + linked) * (n + 1) + np.where(linked, 0, np.arange(n))
    order = np.argsort(key)
    ordered = key[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    # The rank of a tuple is the place of the first one that is not yet told apart from it.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    open_ = order[~(new & np.append(new[1:], True))]
    while len(open_):
        # All of these are linked: what is not has a key of its own.
        key = rank[open_] * (n + 1) + np.where(link[open_] >= 0, rank[link[open_]] + 1, 0)
        sort = np.argsort(key)
        some, key = open_[sort], key[sort]
        old = rank[some]
        head = np.append(True, old[1:] != old[:-1])
        new = np.append(True, key[1:] != key[:-1])
        at = np.arange(len(some))
        begin = np.maximum.accumulate(np.where(head, at, 0))
        farther = np.where(link[open_] >= 0, link[link[open_]], -1)
        rank[some] = old + np.maximum.accumulate(np.where(new, at, 0)) - begin
        link = link.copy()
        link[open_] = farther
        open_ = some[~(new & np.append(new[1:], True))]
    return np.argsort(rank)


class _Sweep:
    """One sweep over the queues, ascending for L suffixes or descending for S suffixes."""

    def __init__(self, text, smaller, wanted: bool, ranges, disk: Disk, most: int):
        self.text, self.smaller, self.wanted, self.disk, self.most = text, smaller, wanted, disk, most
        self.range_of, self.first = ranges
        self.queues = [Queue(disk) for _ in range(len(self.first) - 1)]
        self.turn = 0
        # Of each turn, the prefix shared with the turn before.
        self.shared = disk.array(len(text) + 1, np.uint8 if most < 256 else np.uint32) if most else None

    def run(self, fixed: Iterator[tuple[int, Iterator[np.ndarray]]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
        """``(range, induced, places, shared)`` in order; ``fixed`` gives the settled tuples of each range in turn.

        ``induced`` tells for each place whether this sweep has induced it.
        """
        for r, settled in fixed:
            if self.first[r + 1] - self.first[r] > 1:
                yield from self._several(r, settled)
            else:
                yield from self._one(r, settled)

    def _taken(self, places: np.ndarray, shared: np.ndarray | None) -> None:
        if shared is not None:
            self.shared[self.turn : self.turn + len(places)] = shared
        self.turn += len(places)

    def _induce(self, places: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
        """Pushes what the tuples taken last induce; returns what falls into range ``r`` itself."""
        turns = np.arange(self.turn - len(places), self.turn, dtype=places.dtype)
        before = places - 1
        good = (before >= 0) & (self.smaller[np.maximum(before, 0)] == self.wanted)
        before, turns = before[good], turns[good]
        to = self.range_of[self.text[before]]
        order = np.argsort(to.astype(np.uint8) if len(self.queues) <= 256 else to, kind="stable")
        before, turns, to = before[order], turns[order], to[order]
        cut = [0, *(np.flatnonzero(to[1:] != to[:-1]) + 1).tolist(), len(to)]
        own = (before[:0], turns[:0])
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if a == b:
                continue
            if to[a] == r:
                own = (before[a:b], turns[a:b])
            else:
                self.queues[to[a]].push(before[a:b], turns[a:b])
        return own

    def _prefixes(self, last: int | None, turns: np.ndarray) -> np.ndarray | None:
        """Shared with the tuple before, the one that was induced at turn ``last``."""
        if self.shared is None:
            return None
        out = np.zeros(len(turns), np.int64)
        bounds = turns if last is None else np.append(last, turns)
        if len(bounds) > 1:
            begin = bounds[:-1] + 1
            low = int(begin[0])
            least = np.minimum.reduceat(self.shared[low : int(bounds[-1]) + 1], begin - low)
            out[len(turns) - len(least) :] = np.minimum(least.astype(np.int64) + 1, self.most)
        return out

    def _run_length(self, place: int) -> int:
        part = self.text[place : place + self.most]
        other = np.flatnonzero(part != part[0])
        return int(other[0]) if len(other) else len(part)

    def _one(self, r: int, settled: Iterator[np.ndarray]):
        """A range of one symbol: tuples have come in order, those it induces itself follow, then the settled ones."""
        wave, last, tail = self.queues[r], None, None
        while wave.pieces:
            later = Queue(self.disk)
            for places, turns in wave.batches():
                shared = self._prefixes(last, turns)
                last, tail = int(turns[-1]), int(places[-1])
                self._taken(places, shared)
                later.push(*self._induce(places, r))
                yield r, np.ones(len(places), bool), places, shared
            wave = later
        for rows in settled:
            places, shared = rows[0], None
            if self.shared is not None:
                shared = rows[1].copy()
                if tail is not None:
                    shared[0] = min(self._run_length(tail), self._run_length(int(places[0])))
                    tail = None
            self._taken(places, shared)
            self._induce(places, r)
            yield r, np.zeros(len(places), bool), places, shared

    def _several(self, r: int, settled: Iterator[np.ndarray]):
        """A range of several symbols: all its tuples are gathered and put in order."""
        none = np.zeros(0, _place_kind(len(self.text)))
        own = np.concatenate([none, *[rows[0] for rows in self.queues[r].batches()]])
        held = np.concatenate([none, *[rows[0] for rows in settled]])
        places, links = [own, held], [np.full(len(own) + len(held), -1)]
        front, at = np.concatenate(places), np.arange(len(own) + len(held))
        n = len(front)
        while len(front):
            before = front - 1
            good = (before >= 0) & (self.smaller[np.maximum(before, 0)] == self.wanted)
            before, at = before[good], at[good]
            inside = self.range_of[self.text[before]] == r
            front, link = before[inside], at[inside]
            places.append(front)
            links.append(link)
            at = np.arange(n, n + len(front))
            n += len(front)
        if not n:
            return
        place, link = np.concatenate(places), np.concatenate(links)
        fixed = np.zeros(n, bool)
        fixed[len(own) : len(own) + len(held)] = True
        symbol = self.text[place].astype(np.int64)
        order = _settle(-symbol if self.wanted else symbol, fixed, link)
        place, fixed = place[order], fixed[order]
        self._taken(place, None)
        self._induce(place, r)
        yield r, ~fixed, place, None


def _sweeps(text, smaller, seeds, shared, ranges, disk: Disk, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """``(smaller, places, shared)`` of all suffixes in descending order, from ``seeds`` in ascending order."""
    n_ranges = len(ranges[1]) - 1
    edge = np.searchsorted(ranges[0][text[seeds]], np.arange(n_ranges + 1))

    def of_seeds(r: int) -> Iterator[np.ndarray]:
        for a in range(edge[r], edge[r + 1], BATCH):
            at = slice(a, min(a + BATCH, edge[r + 1]))
            values = shared[at].astype(seeds.dtype) if most else np.zeros(at.stop - a, seeds.dtype)
            if a == edge[r]:
                values[:1] = 0
            yield np.stack([seeds[at], values])

    larger = [Queue(disk) for _ in range(n_ranges)]
    up = _Sweep(text, smaller, False, ranges, disk, most)
    for r, induced, places, values in up.run((r, of_seeds(r)) for r in range(n_ranges)):
        values = np.zeros(len(places), np.uint8) if values is None else values
        larger[r].push(places[induced], values[induced])
    del up

    def of_larger(r: int) -> Iterator[np.ndarray]:
        carried = 0  # what the last one handed on shares with the one below it
        for rows in larger[r].batches(backward=True):
            yield np.stack([rows[0], np.append(rows[1].dtype.type(carried), rows[1][:-1])])
            carried = int(rows[1][-1])

    down = _Sweep(text, smaller, True, ranges, disk, most)
    down.queues[0].push(np.array([len(text) - 1], seeds.dtype), np.array([0], seeds.dtype))
    for _, induced, places, values in down.run((r, of_larger(r)) for r in range(n_ranges - 1, -1, -1)):
        yield induced, places, values


def _same(text: np.ndarray, left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the ``lengths`` symbols from ``left`` and from ``right`` are alike."""
    out = np.ones(len(left), bool)
    live, k = np.flatnonzero(lengths > 0), 0
    while len(live):
        alike = text[left[live] + k] == text[right[live] + k]
        out[live[~alike]] = False
        k += 1
        live = live[alike]
        live = live[lengths[live] > k]
    return out


def _sorted_seeds(text, smaller, seeds, ranges, disk: Disk) -> np.ndarray:
    """The seeds in the order of their suffixes."""
    # Seeds by their first symbol alone: the sweeps then sort the substrings from seed to seed.
    rough = seeds[np.argsort(text[seeds], kind="stable")]
    m, n, kind = len(seeds), len(text), seeds.dtype
    ordered, end = disk.array(m, kind), m
    for induced, places, _ in _sweeps(text, smaller, rough, None, ranges, disk, 0):
        places = places[induced & (places > 0)]
        places = places[~smaller[places - 1]]
        ordered[end - len(places) : end] = places[::-1]
        end -= len(places)
    number = disk.array(n, kind)
    number[seeds] = np.arange(m)
    length = np.append(np.diff(seeds) + 1, 1)  # to the next seed, this included
    name, last = disk.array(m, kind), -1
    for at in _blocks(m):
        low = max(at.start - 1, 0)
        some = ordered[low : at.stop]
        place = number[some]
        left, right = some[:-1], some[1:]
        alike = np.zeros(len(some), bool)
        fits = np.flatnonzero(length[place[:-1]] == length[place[1:]])
        # The last substring, the lone least symbol, is like no other.
        fits = fits[right[fits] + length[place[1:][fits]] <= n]
        alike[1:][fits] = _same(text, left[fits], right[fits], length[place[1:]][fits])
        own = slice(at.start - low, None)
        values = last + np.cumsum(~alike[own])
        name[place[own]] = values
        last = int(values[-1])
    if last == m - 1:
        return ordered
    del ordered, number
    out, end = disk.array(m, kind), m
    for places, _ in suffixes(name, last + 1, disk):
        out[end - len(places) : end] = seeds[places[::-1]]
        end -= len(places)
    return out


def _seed_prefixes(text: np.ndarray, seeds: np.ndarray, disk: Disk, most: int) -> np.ndarray:
    """What each seed shares with the one before, eight symbols at a time."""
    out = disk.array(len(seeds), np.uint8 if most < 256 else np.uint32)
    padded = np.zeros(len(text) + most + 8, np.uint8) if len(text) < MEMORY else disk.array(len(text) + most + 8, np.uint8)
    padded[: len(text)] = text
    at = np.ndarray((len(padded) - 7,), "<u8", padded.data, 0, (1,))
    for block in _blocks(len(seeds)):
        if block.start == 0:
            block = slice(1, block.stop)
        left, right = seeds[block.start - 1 : block.stop - 1], seeds[block]
        found = np.full(len(right), most, np.int64)
        live, k = np.arange(len(right)), 0
        while len(live) and k < most:
            gap = at[left[live] + k] ^ at[right[live] + k]
            ended = gap != 0
            bits = gap[ended] & (~gap[ended] + np.uint64(1))  # the lowest one
            found[live[ended]] = np.minimum(k + (np.log2(bits.astype(np.float64)).astype(np.int64) >> 3), most)
            live, k = live[~ended], k + 8
        out[block] = found
    return out


def suffixes(text: np.ndarray, n_symbols: int, disk: Disk, most: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """``(places, shared)``: the suffixes of ``text`` in descending order, in batches.

    ``text`` ends in a 0 that occurs nowhere else. With ``most``, ``shared`` is
    the length of the prefix common with the suffix handed out before, ``most``
    at the most; the symbols are then bytes.
    """
    smaller = smaller_types(text, disk)
    seeds = _seeds(smaller, disk)
    ranges = _ranges(text, n_symbols)
    if len(seeds) > 1:
        seeds = _sorted_seeds(text, smaller, seeds, ranges, disk)
    elif not len(seeds):  # the lone 0
        seeds = np.array([len(text) - 1], _place_kind(len(text)))
    shared = _seed_prefixes(text, seeds, disk, most) if most else None
    for _, places, values in _sweeps(text, smaller, seeds, shared, ranges, disk, most):
        yield places, values
