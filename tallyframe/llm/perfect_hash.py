"""Minimal perfect hash of 64-bit keys, built and asked with whole arrays.

Each level is a bit table of twice the keys it gets. Keys alone at their place
set its bit and are done; the others go on to the next level. A key's number
is the count of set bits before its own, so n keys get 0 .. n-1. A stored
fingerprint tells most strangers from keys.
"""

from __future__ import annotations

import io

import numpy as np

from tallyframe.llm.vec import U64, mix

SPREAD = 2
DEEPEST = 64


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys + U64(0x9E3779B97F4A7C15) * U64(level + 1)) % U64(size)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys ^ U64(0xA5A5F00DCAFE1234)) >> U64(32)).astype(np.uint32)


class PerfectHash:
    """Numbers for a fixed set of distinct keys; ``tables`` has the bits of each level."""

    def __init__(self, tables: list[np.ndarray]):
        self.tables = tables
        self.before, total = [], 0
        for table in tables:
            # How many bits are set before each byte, over all levels so far.
            ones = np.bitwise_count(table).astype(np.int64)
            run = np.concatenate([[0], np.cumsum(ones)])
            self.before.append(total + run[:-1])
            total += int(run[-1])
        self.size = total

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        if len(np.unique(keys)) != len(keys):
            raise ValueError("keys of a perfect hash must be distinct")
        tables = []
        while len(keys):
            if len(tables) == DEEPEST:
                raise ValueError("keys do not part")
            size = -(-max(SPREAD * len(keys), 8) // 8) * 8
            at = _place(keys, len(tables), size)
            alone = np.bincount(at, minlength=size) == 1
            tables.append(np.packbits(alone, bitorder="little"))
            keys = keys[~alone[at]]
        return cls(tables)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key; -1 where no level has a bit (then it is none of the keys)."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, table in enumerate(self.tables):
            at = _place(keys[left], level, 8 * len(table))
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            here = (table[byte] >> bit) & 1 == 1
            low = table[byte] & ((np.uint8(1) << bit) - np.uint8(1)).astype(np.uint8)
            rank = self.before[level][byte] + np.bitwise_count(low)
            out[left[here]] = rank[here]
            left = left[~here]
            if not len(left):
                break
        return out

    def dump(self, **columns: np.ndarray) -> bytes:
        to = io.BytesIO()
        np.savez(to, **{f"level{i}": t for i, t in enumerate(self.tables)}, **columns)
        return to.getvalue()

    @classmethod
    def load(cls, data: bytes) -> tuple["PerfectHash", dict[str, np.ndarray]]:
        with np.load(io.BytesIO(data)) as found:
            columns = {name: found[name] for name in found.files}
        tables = [columns.pop(f"level{i}") for i in range(sum(n.startswith("level") for n in columns))]
        return cls(tables), columns
