"""Vectorised hashing of words and shingles over Arrow text columns, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
#: Bytes hashed together; a longer text is a block of its own.
BLOCK = 1 << 20
_powers: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and inverse powers, at least n of each."""
    if len(_powers.get("up", ())) < n:
        n = max(n, BLOCK + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def text_blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of whole texts: (index of the first, UTF-8 bytes, offsets of the texts in them). Nulls are empty texts."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + BLOCK, "right")) - 1)
        last = min(last, len(column))
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def words(data: np.ndarray, at: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between ASCII white space: hash, number of the text, start and end byte of each, in order."""
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE_VALUES[LOWER[data] if lower else data] * down[: len(data)], out=total[1:])
    hashed = mix((total[end] - total[start]) * up[start] + (end - start).astype(U) * U(0xA0761D6478BD642F))
    return hashed, np.searchsorted(at, start, "right") - 1, start, end


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The sorted distinct hashes of each text's word shingles, block by block: (index of the first text, its sets).

    A text with fewer words than ``width`` has its whole sequence as one shingle; one without words has none.
    """
    for first, data, at in text_blocks(column):
        hashed, doc, _, _ = words(data, at)
        n_words = np.bincount(doc, minlength=len(at) - 1)
        ends = np.cumsum(n_words)
        joined = hashed.copy()
        for k in range(1, width):
            joined[: len(hashed) - k] = mix(joined[: len(hashed) - k] * U(0xE7037ED1A0B428DB) + hashed[k:] + U(k))
        sets = []
        for n, end in zip(n_words.tolist(), ends.tolist()):
            if n >= width:
                sets.append(np.unique(joined[end - n : end - width + 1]))
            elif n:
                short = np.array([n], U)
                for k in range(end - n, end):
                    short = mix(short * U(0x8EBC6AF09C88C6E3) + hashed[k : k + 1])
                sets.append(short)
            else:
                sets.append(np.empty(0, U))
        yield first, sets


def similarity_sketch(values: np.ndarray, owner: np.ndarray, n: int, size: int) -> np.ndarray:
    """Fast similarity sketches of n sets at once, ``size`` coordinates each.

    In round i < size every element throws itself into a hashed bin, in round i >= size all elements go to bin i - size;
    a bin keeps its smallest (round, hash). A set leaves once all its bins are filled, which the last rounds guarantee,
    so every coordinate of a set with elements is filled and two sets agree in one with their similarity as the chance.
    Sets without elements keep the largest value everywhere.
    """
    empty = ~U(0)
    out = np.full((n, size), empty, U)
    flat = out.reshape(-1)
    keep = U((1 << 56) - 1)
    for i in range(2 * size):
        if not len(values):
            break
        hashed = mix(values + U(((i + 1) * 0xA24BAED4963EE407) & (2**64 - 1)))
        bins = ((hashed >> U(32)) * U(size) >> U(32)).astype(np.int64) if i < size else i - size
        np.minimum.at(flat, owner * size + bins, U(i << 56) | (mix(hashed) & keep))
        full = (out != empty).all(axis=1)
        if full.any():
            stay = ~full[owner]
            values, owner = values[stay], owner[stay]
    return out
