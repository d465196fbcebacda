"""Vectorised word hashing for batches of UTF-8 texts.

A batch is one byte buffer (texts joined by a line feed).  Words are maximal
runs of "word bytes"; each gets a 64-bit hash

    mix( sum_j  TABLE[byte_j] * P**j  mod 2**64 )

with pseudo-random odd table entries, so two different words collide with a
probability of about 2**-63.  Sequences of words are hashed the same way over
the word hashes.  Everything is numpy over at most ``BLOCK`` bytes at a time,
whatever the length of a text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BLOCK = 1 << 19
_POW = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the output."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _byte_table(lower: bool) -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
    if lower:
        t[65:91] = t[97:123]
    return t


_TABLES = {False: _byte_table(False), True: _byte_table(True)}
_P = 0x9E3779B97F4A7C15 | 1
_powers = np.full(_POW, _P, U64)
_powers[0] = 1
_powers = np.cumprod(_powers, dtype=U64)

#: Byte classes: True where a byte belongs to a word.
SPACE_WORDS = np.ones(256, bool)
SPACE_WORDS[[0x20, 9, 10, 11, 12, 13]] = False
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[0x30:0x3A] = ALNUM_WORDS[0x41:0x5B] = ALNUM_WORDS[0x61:0x7B] = ALNUM_WORDS[0x80:] = True


def _cuts(b: np.ndarray, is_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices of about BLOCK bytes that never cut a word."""
    pos, n = 0, len(b)
    while pos < n:
        end = min(n, pos + BLOCK)
        if end < n:
            gaps = np.flatnonzero(~is_word[b[max(pos, end - 4096):end]])
            if len(gaps):
                end = max(pos, end - 4096) + int(gaps[-1]) + 1
            else:  # a word longer than the search window: go on to its end
                while end < n and is_word[b[end]]:
                    step = is_word[b[end:end + BLOCK]]
                    stop = np.flatnonzero(~step)
                    end += int(stop[0]) if len(stop) else len(step)
        yield pos, end
        pos = end


def words_of(texts: list[bytes], lower: bool, is_word: np.ndarray = SPACE_WORDS
             ) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets): the words of text i are hash[offsets[i]:offsets[i + 1]]."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lens + 1, out=first[1:])
    b = np.frombuffer(b"\n".join(texts), np.uint8)
    table, hashes, starts = _TABLES[lower], [], []
    for lo, hi in _cuts(b, is_word):
        x = b[lo:hi]
        edge = np.diff(is_word[x].astype(np.int8), prepend=0, append=0)
        st, en = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(st):
            continue
        # position inside the word (gaps go on counting and are never summed)
        at = np.arange(len(x), dtype=np.int32)
        at[st[0]:] -= np.repeat(st, np.diff(np.append(st, len(x)))).astype(np.int32)
        part = table[x]
        if len(x) > _POW and int((en - st).max()) > _POW:
            part *= (at >> 16).astype(U64) * U64(2) + U64(1)
        at &= _POW - 1
        part *= _powers[at]
        part[~is_word[x]] = 0
        hashes.append(mix(np.add.reduceat(part, st)))
        starts.append(st + lo)
    if not hashes:
        return np.zeros(0, U64), np.zeros(len(texts) + 1, np.int64)
    at = np.concatenate(starts)
    return np.concatenate(hashes), np.searchsorted(at, first).astype(np.int64)


def grams(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of the k words from every position (length n - k + 1; empty if n < k)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    m = U64((0xC2B2AE3D27D4EB4F + 2 * salt * 0x165667B19E3779F9) & (2**64 - 1) | 1)
    acc = np.full(n, U64(k + salt * 1000003 + 1), U64)
    for j in range(k):
        acc *= m
        acc += h[j:j + n]
    return mix(acc)


def whole(offsets: np.ndarray, k: int) -> np.ndarray:
    """For each position with k words to come in the batch: do all k belong to one text?"""
    n = int(offsets[-1]) - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    return doc[:n] == doc[k - 1:]


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    done = 1
    while done < w:
        step = min(done, w - done)
        v = np.minimum(v[:-step], v[step:]) if len(v) > step else v[:0]
        done += step
    return v


def give_back() -> None:
    """Return freed memory to the system: Spark keeps Python workers, and what they once held, between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def chunks(batches, text: str, limit: int) -> Iterator[dict[str, list]]:
    """Rows of Arrow batches as column lists, cut after every ``limit`` bytes of text.

    The cuts depend on the rows only, not on how Arrow batched them, so a
    second pass over the same partition sees the same chunks.
    """
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        names = batch.schema.names
        if not held:
            held = {name: [] for name in names}
        column = batch.column(names.index(text))
        lens = pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64)
        ends = np.cumsum(lens + 64)
        start = before = 0
        while start < len(ends):
            # only the rows of the chunk become Python objects
            stop = int(np.searchsorted(ends, before + limit - size)) + 1
            part = batch.slice(start, min(stop, len(ends)) - start)
            for i, name in enumerate(names):
                held[name].extend(part.column(i).to_pylist())
            if stop > len(ends):
                size += int(ends[-1]) - before
                break
            yield held
            held = {name: [] for name in names}
            start, size, before = stop, 0, int(ends[stop - 1])
            give_back()
    if held and held[text]:
        yield held
    give_back()
