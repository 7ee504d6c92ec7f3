"""Word and shingle hashes of whole Arrow text columns, in numpy.

A word's hash is a polynomial over its bytes modulo 2^64 (the Karp-Rabin
fingerprint). Prefix sums give it for every word of a span of text at once, so
no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15
SPAN = 1 << 20
WIDE = np.uint64

_powers = {"up": np.ones(1, WIDE), "down": np.ones(1, WIDE)}


def _table(separators, fold_case: bool = True) -> np.ndarray:
    values = np.arange(1, 257, dtype=WIDE)
    if fold_case:
        values[65:91] = values[97:123]
    values[list(separators)] = 0
    return values


#: Words between ASCII blanks (0x20, 0x09-0x0D), A-Z lower-cased.
BLANKS = _table([0x20, *range(0x09, 0x0E)])
#: Words of letters and digits only; bytes above 0x7F belong to letters.
LETTERS = _table([b for b in range(128) if not chr(b).isalnum()])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the finaliser of splitmix64)."""
    x = x ^ (x >> WIDE(30))
    x = x * WIDE(0xBF58476D1CE4E5B9)
    x = x ^ (x >> WIDE(27))
    x = x * WIDE(0x94D049BB133111EB)
    return x ^ (x >> WIDE(31))


def powers(kind: str, count: int) -> np.ndarray:
    """The first powers of the base ("up") or of its inverse ("down")."""
    if len(_powers[kind]) < count:
        factor = BASE if kind == "up" else pow(BASE, -1, 1 << 64)
        grown = np.full(max(count, SPAN + 64), factor, WIDE)
        grown[0] = 1
        np.multiply.accumulate(grown, out=grown)
        _powers[kind] = grown
    return _powers[kind][:count]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    body = column.buffers()[2]
    return np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8), offsets


def _cut(span: np.ndarray, table: np.ndarray, at: int) -> int:
    """First separator at or after ``at``."""
    while at < len(span):
        found = np.flatnonzero(table[span[at:at + SPAN]] == 0)
        if len(found):
            return at + int(found[0])
        at += SPAN
    return len(span)


def _span(values: np.ndarray, edges: np.ndarray, prefixes: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of each word of a span, and hashes of its first bytes; ``edges`` are the offsets of its rows."""
    inside = values != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    starts = edges[:-1][edges[:-1] < edges[1:]]
    ends = edges[1:][edges[:-1] < edges[1:]] - 1
    first[starts] = inside[starts]
    last[ends] = inside[ends]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(values) + 1, WIDE)
    np.cumsum(values * powers("up", len(values)), out=sums[1:])
    down = powers("down", len(values) + 1)[begin]
    heads = np.zeros((len(prefixes), len(begin)), WIDE)
    for n, size in enumerate(prefixes):
        longer = np.flatnonzero(end - begin > size)
        at = begin[longer]
        heads[n, longer] = mix((sums[at + size] - sums[at]) * down[longer] + WIDE(size))
    return begin, end, mix((sums[end] - sums[begin]) * down), heads


def _shape(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A value for the first and the last three bytes of each word."""
    near = [begin, end - 1, np.maximum(end - 2, begin), np.maximum(end - 3, begin)]
    out = np.zeros(len(begin), WIDE)
    for at in near:
        out = (out << WIDE(9)) | values[at]
    return mix(out)


def word_hashes(
    column: pa.Array, table: np.ndarray = BLANKS, shapes: bool = False, prefixes: Sequence[int] = ()
) -> Iterator[tuple[int, np.ndarray, ...]]:
    """Runs of rows as (first row, bounds, hashes).

    On request come the words' shapes, or a row of hashes for each number of first bytes
    in ``prefixes``, 0 for words that are no longer.

    Row ``first + i`` has the words ``hashes[bounds[i]:bounds[i + 1]]``. A run
    holds about a megabyte of text; a longer text is hashed in pieces cut
    between words, so memory follows the longest single text.
    """
    data, offsets = text_bytes(column)
    rows, low = len(offsets) - 1, 0
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + SPAN, side="right")) - 1)
        high = min(high, rows)
        span = data[offsets[low]:offsets[high]]
        if high == low + 1 and len(span) > SPAN:
            parts, forms, at = [], [], 0
            while at < len(span):
                stop = _cut(span, table, min(at + SPAN, len(span)))
                piece = table[span[at:stop]]
                begin, end, found, heads = _span(piece, np.array([0, len(piece)]), prefixes)
                parts.append(found)
                forms.append(_shape(piece, begin, end) if shapes else heads)
                at = stop
            hashes = np.concatenate(parts)
            run = (low, np.array([0, len(hashes)]), hashes)
            yield (*run, np.concatenate(forms, axis=-1)) if shapes or prefixes else run
        else:
            edges = offsets[low:high + 1] - offsets[low]
            values = table[span]
            begin, end, hashes, heads = _span(values, edges, prefixes)
            run = (low, np.searchsorted(begin, edges), hashes)
            yield (*run, _shape(values, begin, end) if shapes else heads) if shapes or prefixes else run
        low = high


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside rows, their bounds, and the word each begins at.

    A row with fewer words, but at least one, has the single run of all of them.
    """
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out = np.concatenate([[0], np.cumsum(made)])
    at = np.repeat(bounds[:-1] - out[:-1], made) + np.arange(out[-1])
    padded = np.concatenate([hashes, np.zeros(size, WIDE)])
    room = np.repeat(bounds[1:], made) - at
    whole = np.zeros(len(at), WIDE)
    short = bool((counts < size).any())
    for k in range(size):
        word = padded[at + k]
        if short:
            word = np.where(room > k, word, WIDE(0))
        whole = whole * WIDE(BASE) + word
    return mix(whole), out, at
