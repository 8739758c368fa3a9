"""Word positions and 64-bit word hashes of many texts at once, on numpy arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import xxhash

#: words of more bytes than this are hashed one by one
LONG = 64
_U64 = np.uint64
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)

#: the six ASCII white-space characters end a word
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: digits, lower-case letters and every byte of a non-ASCII character make a word
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


class Words(NamedTuple):
    buffer: bytes        # the lower-cased texts, a blank between two
    offsets: np.ndarray  # where each text begins in the buffer; one more entry for the end
    start: np.ndarray    # of each word in the buffer
    end: np.ndarray
    doc: np.ndarray      # number of the word's text
    first: np.ndarray    # of each text: its first word; one more entry for the end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U64(33))
    x *= _U64(0xFF51AFD7ED558CCD)
    x ^= x >> _U64(33)
    x *= _U64(0xC4CEB9FE1A85EC53)
    x ^= x >> _U64(33)
    return x


def find_words(texts: list[bytes], is_word: np.ndarray) -> Words:
    """The words of ASCII-lower-cased texts: maximal runs of bytes of ``is_word``."""
    buffer = b" ".join(texts).lower()
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    inside = np.zeros(len(buffer) + 2, dtype=np.int8)
    inside[1:-1] = is_word[np.frombuffer(buffer, dtype=np.uint8)]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(buffer, offsets, start, end, doc, first)


def hash_words(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes at a time for all words together."""
    size = words.end - words.start
    if not len(size):
        return np.zeros(0, dtype=np.uint64)
    padded = words.buffer + bytes(8)
    lanes = np.ndarray((len(words.buffer) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    h = mix(size.astype(np.uint64) * _U64(0x9E3779B97F4A7C15))
    at, left, live = words.start, size, None
    for _ in range(LONG // 8):
        lane = lanes[at] & _KEEP[np.minimum(left, 8)]
        if live is None:
            h = mix(h ^ lane)
        else:
            h[live] = mix(h[live] ^ lane)
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        live = more if live is None else live[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG):
        h[i] = xxhash.xxh3_64_intdigest(words.buffer[words.start[i]:words.end[i]])
    return h


def hash_grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` successive word hashes, one for each position that has so many."""
    out = np.full(max(len(h) - n + 1, 0), n, dtype=np.uint64)
    for k in range(n):
        out = mix((out + _U64(0x9E3779B97F4A7C15)) ^ h[k:len(h) - n + 1 + k])
    return out
