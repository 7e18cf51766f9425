"""Words, shingles and windows of text columns as numpy arrays.

The kernels take one Arrow string array at a time and work on its UTF-8
bytes, so no word ever becomes a Python object.  A word is a maximal run of
word bytes; both alphabets count every byte of a non-ASCII character as a
word byte, which makes byte runs and character runs the same thing.

A word's hash takes its bytes eight at a time and scrambles after every step.
Hashes of runs of a fixed number of words are polynomials modulo 2**64 over
those, computed from prefix sums; two with different bases give 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
PIECE = 1 << 18  # words hashed at a time
LONG = 64  # bytes of a word from which on it is hashed by itself

_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)  # the first k bytes of eight
_WINDOW_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def _alphabet(separators: bytes, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    is_word = np.ones(256, dtype=bool)
    is_word[list(separators)] = False
    table = np.arange(256, dtype=np.uint8)
    if fold:
        table[65:91] += 32
    return is_word, table


# Words separated by white space, kept as they are.
SPACED = _alphabet(b"\x20\x09\x0a\x0b\x0c\x0d", fold=False)
# Lower-cased runs of ASCII letters, digits and all non-ASCII characters.
FOLDED = _alphabet(
    bytes(b for b in range(128) if not chr(b).isalnum()),
    fold=True,
)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finalizer of splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def powers(base: int, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64, or the inverses of those."""
    key = (base, inverse)
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        step = pow(base, -1, 2**64) if inverse else base
        out = np.full(max(n, 1 << 12), step, dtype=U64)
        out[0] = 1
        have = _POWERS[key] = np.cumprod(out, dtype=U64)
    return have[:n]


@dataclass
class Words:
    """Words of a batch of texts, in order.

    ``starts`` and ``ends`` are byte positions in ``data``; ``first[i]`` is the
    index of the first word of text i (``first`` has one entry more than there
    are texts); ``hash`` has 64 bits per word.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each starts; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def find_words(texts: pa.Array, alphabet=FOLDED) -> Words:
    is_word, table = alphabet
    data, at = text_bytes(texts)
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(at), np.int64), np.zeros(0, U64))
    inside = is_word[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    inner = at[(at > 0) & (at < n)]
    before[inner] = False
    after[inner - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, at)
    return Words(data, starts, ends, first, run_hashes(table[data], starts, ends))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each run of bytes, whatever its length."""
    size = ends - starts
    out = mix(size.astype(U64) + U64(0x2545F4914F6CDD1D))
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    for a in range(0, len(starts), PIECE):
        mine = a + np.flatnonzero(size[a : a + PIECE] < LONG)
        at, left, state = starts[mine], size[mine], out[mine]
        going = np.flatnonzero(left > 0)
        while len(going):
            step = eight[at[going]] & _FIRST[np.minimum(left[going], 8)]
            state[going] = mix((state[going] ^ step) * U64(0x9E3779B97F4A7C15))
            at[going] += 8
            left[going] -= 8
            going = going[left[going] > 0]
        out[mine] = state
    for i in np.flatnonzero(size >= LONG):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), 20240229)
    return out


def window_hashes(words: Words, width: int, which: int = 0) -> np.ndarray:
    """Hash of the ``width`` words from each word on, whether or not they are of one text."""
    n = len(words.hash) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    base = _WINDOW_BASES[which]
    values = words.hash if which == 0 else mix(words.hash ^ U64(0x5851F42D4C957F2D))
    out = np.empty(n, U64)
    step = 1 << 18
    for a in range(0, n, step):
        b = min(n, a + step)
        part = values[a : b + width - 1] * powers(base, b - a + width - 1)
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(part, out=sums[1:])
        out[a:b] = (sums[width : width + b - a] - sums[: b - a]) * powers(base, b - a, inverse=True)
    return mix(out)


def whole_windows(words: Words, width: int) -> np.ndarray:
    """True for each word from which ``width`` words follow in the same text."""
    n = max(0, len(words.hash) - width + 1)
    owner = text_of_word(words)
    return owner[:n] == owner[width - 1 :] if n else np.zeros(0, bool)


def text_of_word(words: Words) -> np.ndarray:
    return np.repeat(np.arange(len(words.first) - 1), words.counts)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of the ``width`` values from each position on."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    span, low = 1, values
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:])[:n] if rest else low[:n]


def slices(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text each, one row at least."""
    _, at = text_bytes(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j
