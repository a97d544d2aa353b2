"""Words, hashes and windows of texts as numpy arrays, for use inside tasks.

Hashes are polynomials modulo 2**64 over bytes or words, mixed afterwards. They find candidates
or stand for long sequences; where two equal hashes would decide alone, 128 bits are compared.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BLOCK = 1 << 18
SLICE_BYTES = 2 << 20


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, dtype=U64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_tables: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    known = _tables.get(base)
    if known is None or len(known) < count:
        known = _tables[base] = _powers(base, max(count, 1 << 16))
    return known[:count]


def give_back() -> None:
    """Return memory that is free to the system, as workers wait for their next task beside the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    values = values ^ (values >> U64(30))
    values = values * U64(0xBF58476D1CE4E5B9)
    values ^= values >> U64(27)
    values = values * U64(0x94D049BB133111EB)
    values ^= values >> U64(31)
    return values


def byte_class(chars: str) -> np.ndarray:
    """A table of 256 flags."""
    table = np.zeros(256, dtype=bool)
    table[[ord(c) for c in chars]] = True
    return table


#: A-Z to a-z; all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Lower-case letters, digits and every byte of characters beyond ASCII.
WORD = byte_class("abcdefghijklmnopqrstuvwxyz0123456789")
WORD[128:] = True
#: Everything but the space and the control characters 9 to 13.
VISIBLE = np.ones(256, dtype=bool)
VISIBLE[[32, 9, 10, 11, 12, 13]] = False


class Texts:
    """The UTF-8 bytes of some texts, one after the other; null is an empty text."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()).fill_null("")
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        self.bytes = (
            np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]]
            if data is not None and len(column)
            else np.zeros(0, dtype=np.uint8)
        )
        self.at = at - at[0] if len(column) else np.zeros(1, dtype=np.int64)

    def __len__(self) -> int:
        return len(self.at) - 1

    def raw(self, row: int) -> bytes:
        return self.bytes[self.at[row] : self.at[row + 1]].tobytes()


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of the batches of about ``limit`` bytes of text, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.diff(Texts(batch.column(column)).at)
        part = (np.cumsum(lengths) - lengths) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            piece = batch.slice(begin, end - begin)
            yield piece, Texts(piece.column(column))
    give_back()


def parts(texts: Texts, limit: int, at: np.ndarray) -> Iterator[tuple[Texts, np.ndarray]]:
    """The texts in parts of about ``limit`` bytes, and which text each piece of a part is of.

    Longer texts are cut before bytes of the class ``at``, at places that depend on the text alone; a stretch without
    such a byte stays whole.
    """
    begin, owner = [], []
    for row in range(len(texts)):
        place, end = int(texts.at[row]), int(texts.at[row + 1])
        begin.append(place)
        owner.append(row)
        while end - place > limit:
            # The last place within the limit, else the next one beyond.
            window = np.flatnonzero(at[texts.bytes[place + 1 : place + limit]])
            step = int(window[-1]) + 1 if len(window) else 0
            ahead = place + limit
            while not step and ahead < end:
                window = np.flatnonzero(at[texts.bytes[ahead : min(ahead + limit, end)]])
                step = ahead - place + int(window[0]) if len(window) else 0
                ahead += limit
            if not step:
                break
            place += step
            begin.append(place)
            owner.append(row)
    bounds, owner = np.array([*begin, int(texts.at[-1])], dtype=np.int64), np.array(owner, dtype=np.int64)
    group = (np.cumsum(np.diff(bounds)) - np.diff(bounds)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), len(owner)]
    for a, b in zip(cuts, cuts[1:]):
        part = Texts.__new__(Texts)
        part.bytes, part.at = texts.bytes[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
        yield part, owner[a:b]


class Words:
    """Words of texts: where they stand, a hash of each, and which text has which."""

    def __init__(self, texts: Texts, is_word: np.ndarray, lower: bool):
        self.bytes = LOWER[texts.bytes] if lower else texts.bytes
        mask = is_word[self.bytes]
        begin, end = mask.copy(), mask.copy()
        if len(mask):
            begin[1:] &= ~mask[:-1]
            end[:-1] &= ~mask[1:]
            filled = np.flatnonzero(np.diff(texts.at))
            begin[texts.at[filled]] = mask[texts.at[filled]]
            end[texts.at[filled + 1] - 1] = mask[texts.at[filled + 1] - 1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(end) + 1
        #: Words of text i are those from first[i] to first[i + 1].
        self.first = np.searchsorted(self.start, texts.at)
        self.hash = span_hashes(self.bytes, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def text(self, index: int) -> str:
        return self.bytes[self.start[index] : self.end[index]].tobytes().decode("utf-8", "replace")

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        counts = np.diff(self.first)
        return np.repeat(self.first[1:], counts) - np.arange(len(self))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans in ascending order, computed over blocks of the bytes."""
    out = np.zeros(len(start), dtype=U64)
    done = 0
    while done < len(start):
        base = start[done]
        stop = max(done + 1, int(np.searchsorted(end, base + BLOCK, side="right")))
        s, e = start[done:stop] - base, end[done:stop] - base
        length = int(e[-1])
        sums = np.zeros(length + 1, dtype=U64)
        weights = powers(BASE, length)
        np.cumsum((data[base : base + length].astype(U64) + U64(1)) * weights, out=sums[1:])
        spans = (sums[e] - sums[s]) * powers(INVERSE, length + 1)[s]
        out[done:stop] = mixed(spans + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93))
        done = stop
    return out


class Runs:
    """Hashes of word sequences from the prefix sums of word hashes."""

    def __init__(self, hashes: np.ndarray, seed: int = 0):
        self.base = (BASE * (2 * seed + 3)) % (1 << 64) | 1
        inverse = pow(self.base, -1, 1 << 64)
        count = len(hashes)
        self.sums = np.zeros(count + 1, dtype=U64)
        np.cumsum(hashes * powers(self.base, count), out=self.sums[1:])
        self.back = powers(inverse, count + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (np.asarray(end) - np.asarray(start)).astype(U64)
        found = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(found + length * U64(0xA24BAED4963EE407))

    def every(self, size: int) -> np.ndarray:
        """Hashes of all sequences of that many words, those across two texts included."""
        start = np.arange(max(0, len(self.sums) - size))
        return self.of(start, start + size)


class Bits:
    """Low bits of hashes, as made by common.hash_bits: no false negatives."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words = words.view(U64)
        self.mask = U64((1 << bits) - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        low = hashes & self.mask
        return (self.words[(low >> U64(6)).astype(np.int64)] >> (low & U64(63))) & U64(1) == 1


def signed(hashes: np.ndarray) -> np.ndarray:
    """As Spark's long."""
    return hashes.view(np.int64)


def spaced(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words with one space after each: the bytes, and start and end of the words in them."""
    length = words.end - words.start
    start = np.cumsum(length + 1) - (length + 1)
    out = np.full(int(length.sum()) + len(length), 32, dtype=np.uint8)
    if len(length):
        shift = np.repeat(words.start - start, length)
        place = np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)
        out[place] = words.bytes[place + shift]
    return out, start, start + length
