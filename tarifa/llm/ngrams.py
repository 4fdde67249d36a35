"""Hashed character n-grams of whole texts, in blocks of bounded size, and linear models over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters whose n-grams are held at once.
BLOCK = 1 << 18


def code_points(text: str) -> np.ndarray:
    """Lower-cased characters, white space and digits each as one character, with a space on both sides."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(codes <= 32, 32, codes)
    return np.where((codes >= 48) & (codes <= 57), 48, codes).astype(np.uint32)


def gram_blocks(text: str | None, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """The buckets of all n-grams of the orders, block by block."""
    if not text:
        return
    codes = code_points(text)
    shift = np.uint32(32 - bits)
    longest = max(orders)
    for at in range(0, len(codes), BLOCK):
        part = codes[at : at + BLOCK + longest - 1]
        h = np.zeros(len(part), dtype=np.uint32)
        for i in range(1, longest + 1):
            if len(part) < i:
                break
            h = (h[: len(part) - i + 1] ^ part[i - 1 :]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            if i in orders:
                mine = h[: min(len(h), BLOCK)]
                yield ((mine * np.uint32(0x85EBCA6B)) >> shift).astype(np.int64)


class Presence:
    """The distinct buckets of a text, without sorting."""

    def __init__(self, orders: tuple[int, ...], bits: int) -> None:
        self.orders, self.bits = orders, bits
        self.mark = np.zeros(1 << bits, dtype=np.int64)
        self.seen = np.zeros(1 << bits, dtype=bool)

    def distinct(self, text: str | None) -> np.ndarray:
        found = []
        for block in gram_blocks(text, self.orders, self.bits):
            block = block[~self.seen[block]]
            at = np.arange(len(block))
            self.mark[block] = at
            block = block[self.mark[block] == at]  # the last of equal buckets stays
            self.seen[block] = True
            found.append(block)
        out = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
        self.seen[out] = False
        return out


def logistic(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dims: int, l2: float, rounds: int) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression by Nesterov's accelerated gradient; rows are (indices, values)."""
    sizes = np.array([len(i) for i, _ in rows])
    index = np.concatenate([i for i, _ in rows]) if len(rows) else np.zeros(0, dtype=np.int64)
    value = np.concatenate([v for _, v in rows]) if len(rows) else np.zeros(0)
    owner = np.repeat(np.arange(len(rows)), sizes)
    norm = np.bincount(owner, value * value, len(rows)).max(initial=0) + 1.0
    w, b = np.zeros(dims), 0.0
    ahead_w, ahead_b, momentum = w, b, 1.0
    step = 4.0 / norm
    for _ in range(rounds):
        z = np.bincount(owner, value * ahead_w[index], len(rows)) + ahead_b
        g = (1.0 / (1.0 + np.exp(-np.clip(z, -35, 35))) - y) / max(1, len(rows))
        new_w = ahead_w - step * (np.bincount(index, value * g[owner], dims) + l2 * ahead_w)
        new_b = ahead_b - step * g.sum()
        after = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead_w = new_w + (momentum - 1) / after * (new_w - w)
        ahead_b = new_b + (momentum - 1) / after * (new_b - b)
        w, b, momentum = new_w, new_b, after
    return w, float(b)
