"""Minimal acyclic transducers: sorted terms to their places in the order, as arrays that texts are streamed through."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

#: Bytes of terms: ASCII letters and everything beyond ASCII. A-Z are lowered.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
INSIDE = np.zeros(256, dtype=bool)
INSIDE[65:91] = INSIDE[97:123] = INSIDE[128:] = True
#: Tokens that are walked at once.
TOKENS = 1 << 16


def built(terms: Iterable[bytes]) -> bytes:
    """The minimal transducer of strictly ascending terms, packed.

    States are made from the end of a term as soon as the next term leaves it, and equal ones are shared. An arc weighs the
    number of terms that come before all terms through it and after the terms its state has already counted, so that the
    weights along a term sum up to its place.
    """
    known: dict[tuple, int] = {}
    below: list[int] = []  # terms through each finished state
    path: list[list] = [[False, []]]  # [ends a term, arcs (byte, state)] of each byte of the term before
    term = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            state = known.get(key)
            if state is None:
                state = known[key] = len(below)
                below.append(final + sum(below[to] for _, to in arcs))
            path[-1][1].append((term[len(path) - 1], state))

    for following in terms:
        shared = 0
        limit = min(len(term), len(following))
        while shared < limit and term[shared] == following[shared]:
            shared += 1
        close(shared)
        path.extend([False, []] for _ in following[shared:])
        path[-1][0] = True
        term = following
    close(0)
    key = (path[0][0], tuple(path[0][1]))
    if key not in known:
        known[key] = len(below)
        below.append(0)
    keys, targets, weights, finals = [], [], [], []
    for (final, arcs), state in known.items():
        place = int(final)
        if final:
            finals.append(state)
        for byte, to in arcs:
            keys.append(state << 8 | byte)
            targets.append(to)
            weights.append(place)
            place += below[to]
    head = [len(below), len(keys), known[key], len(finals)]
    return np.array([*head, *keys, *targets, *weights, *finals], dtype=np.int32).tobytes()


class Transducers:
    """Packed transducers in one open-addressed table of arcs. Each has a language, its first term and the place of that term."""

    def __init__(self, parts: list[tuple[str, str, int, bytes]]) -> None:
        keys, targets, weights, finals, states = [], [], [], [], 0
        self.roots: dict[str, list[tuple[bytes, int, int]]] = {}
        for lang, first, base, packed in sorted(parts, key=lambda p: (p[0], p[2])):
            words = np.frombuffer(packed, dtype=np.int32).astype(np.int64)
            n, arcs, root, ends = words[:4].tolist()
            body = words[4:]
            keys.append(body[:arcs] + (states << 8))
            targets.append(body[arcs : 2 * arcs] + states)
            weights.append(body[2 * arcs : 3 * arcs])
            finals.append(body[3 * arcs : 3 * arcs + ends] + states)
            self.roots.setdefault(lang, []).append((first.encode(), root + states, base))
            states += n
        join = lambda lists: np.concatenate([np.zeros(0, dtype=np.int64), *lists])
        self.targets, self.weights = join(targets).astype(np.int32), join(weights).astype(np.int32)
        self.final = np.zeros(states + 1, dtype=bool)
        self.final[join(finals)] = True
        self._fill(join(keys))
        self.firsts = {lang: np.array([prefix_of(f) for f, _, _ in rows], dtype=np.uint64) for lang, rows in self.roots.items()}

    def _spot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def _fill(self, keys: np.ndarray) -> None:
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = 64 - bits, (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, dtype=np.int64)
        self.arcs = np.zeros(1 << bits, dtype=np.int32)
        left, spots = np.arange(len(keys)), self._spot(keys)
        while len(left):
            free = self.slots[spots] == -1
            self.slots[spots[free]] = keys[left[free]]
            stays = self.slots[spots] == keys[left]
            self.arcs[spots[stays]] = left[stays]
            left, spots = left[~stays], (spots[~stays] + 1) & self.mask

    def _arc(self, keys: np.ndarray) -> np.ndarray:
        spots = self._spot(keys)
        held = self.slots[spots]
        out = np.where(held == keys, self.arcs[spots], -1)
        left = np.flatnonzero((held != keys) & (held != -1))
        while len(left):
            spots[left] = (spots[left] + 1) & self.mask
            held = self.slots[spots[left]]
            out[left[held == keys[left]]] = self.arcs[spots[left[held == keys[left]]]]
            left = left[(held != keys[left]) & (held != -1)]
        return out

    def walk(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """Places of tokens within the transducers of the given roots; -1 where a token is no term."""
        state, place = roots.astype(np.int64), np.zeros(len(starts), dtype=np.int64)
        alive, at = np.arange(len(starts)), 0
        while len(alive):
            done = sizes[alive] == at
            if done.any():
                place[alive[done & ~self.final[state[alive]]]] = -1
                alive = alive[~done]
            arc = self._arc(state[alive] << 8 | data[starts[alive] + at])
            place[alive[arc < 0]] = -1
            alive, arc = alive[arc >= 0], arc[arc >= 0]
            state[alive] = self.targets[arc]
            place[alive] += self.weights[arc]
            at += 1
        return place

    def places(self, lang: str, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Places of tokens among all terms of a language, -1 for others. Eight bytes tell the few parts a token may be in."""
        out = np.full(len(starts), -1, dtype=np.int64)
        parts = self.roots.get(lang)
        for low in range(0, len(starts) if parts else 0, TOKENS):
            some = slice(low, low + TOKENS)
            own, start, size = out[some], starts[some], sizes[some]
            prefix = prefixes(data, start, size)
            first = np.maximum(np.searchsorted(self.firsts[lang], prefix, side="left") - 1, 0)
            last = np.searchsorted(self.firsts[lang], prefix, side="right") - 1
            todo = np.flatnonzero(last >= 0)
            while len(todo):
                root = np.array([r for _, r, _ in parts])[last[todo]]
                base = np.array([b for _, _, b in parts])[last[todo]]
                found = self.walk(data, start[todo], size[todo], root)
                own[todo[found >= 0]] = (found + base)[found >= 0]
                last[todo] -= 1
                todo = todo[(found < 0) & (last[todo] >= first[todo])]
        return out


def prefix_of(term: bytes) -> int:
    return int.from_bytes(term[:8].ljust(8, b"\0"), "big")


def prefixes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first eight bytes of each token as a number in the order of the bytes."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for k in range(8):
        has = sizes > k
        out[has] |= data[starts[has] + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def part_of(firsts: list[bytes], term: bytes) -> int:
    """Number of the part a term belongs to, if it is a term at all: the last one that does not begin after it."""
    return max(0, bisect_left(firsts, term + b"\0") - 1)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes of texts, and start, size and text of each token; NULL has none. Texts end tokens."""
    column = column.cast(pa.large_binary())
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8)[bounds[0] : bounds[-1]] if values else np.zeros(0, dtype=np.uint8)
    data, bounds = LOWER[data], bounds - bounds[0]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = INSIDE[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[bounds] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + 1
    return data, starts, ends - starts, np.searchsorted(bounds, starts, side="right") - 1


def token_strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The tokens that ``tokens`` found, as strings: their bytes are all bytes of terms, one after the other."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[INSIDE[data]])))
