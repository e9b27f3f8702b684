"""Vectorised word scan of Arrow text columns.

Words are runs of "word bytes" in the UTF-8 text.  All separators used by the
operators are ASCII, so a byte class describes each word rule exactly.  Every
word gets a 64-bit code: a polynomial of per-byte random values, taken from
prefix sums, so the cost is a fixed number of numpy passes over the bytes.
Equal words have equal codes; different words share one with a chance of
about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from flowlens.llm.workspace import by_value, forget_others, give_back, process_cache

SPACES = bytes([0x20, *range(0x09, 0x0E)])
PIECE_BYTES = 1 << 17   # bytes scanned at once
BLOCK_BYTES = 1 << 18   # text handed to an operator at once (or one longer document)


class Words(NamedTuple):
    """Words of several documents, flat.  ``first[d]:first[d + 1]`` is document d."""

    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    first: np.ndarray


def space_words() -> np.ndarray:
    """Word bytes of ``[^\\x20\\x09-\\x0D]+``."""
    flags = np.ones(256, bool)
    flags[list(SPACES)] = False
    return flags


def alnum_words() -> np.ndarray:
    """Word bytes of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` once A-Z is lower-cased."""
    flags = np.zeros(256, bool)
    flags[0x30:0x3A] = flags[0x41:0x5B] = flags[0x61:0x7B] = flags[0x80:] = True
    return flags


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64), in place on a copy."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2 * seed + 1)) | np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(n, PIECE_BYTES + 4096)
    cached = process_cache("powers", dict)
    if cached.get("size", 0) < size:
        base = 0x9E3779B97F4A7C15
        for name, factor in (("up", base), ("down", pow(base, -1, 1 << 64))):
            values = np.full(size, factor, np.uint64)
            values[0] = 1
            cached[name] = np.cumprod(values)
        cached["size"] = size
    return cached["up"], cached["down"]


def _byte_values(fold: bool) -> np.ndarray:
    values = constants(256, 77)
    if fold:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


def scan(data: np.ndarray, bounds: np.ndarray, word_byte: np.ndarray, fold: bool) -> Words:
    """Words of the documents ``data[bounds[i]:bounds[i + 1]]``; ``fold`` lower-cases A-Z."""
    values = _byte_values(fold)
    starts, ends, codes = [], [], []
    pos, stop = int(bounds[0]), int(bounds[-1])
    while pos < stop:
        end = min(pos + PIECE_BYTES, stop)
        while end < stop and word_byte[data[end - 1]] and word_byte[data[end]]:
            gap = np.flatnonzero(~word_byte[data[end:end + PIECE_BYTES]])
            end = end + int(gap[0]) if gap.size else min(end + PIECE_BYTES, stop)
        piece = data[pos:end]
        inside = bounds[np.searchsorted(bounds, pos, "right"):np.searchsorted(bounds, end)] - pos
        mask = word_byte[piece]
        opens = mask.copy()
        opens[1:] &= ~mask[:-1]
        opens[inside] = mask[inside]
        closes = mask.copy()
        closes[:-1] &= ~mask[1:]
        closes[inside - 1] = mask[inside - 1]
        s, e = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        up, down = _powers(len(piece))
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * up[:len(piece)], out=total[1:])
        code = (total[e] - total[s]) * down[s]
        codes.append(mix(code + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        starts.append(s + pos)
        ends.append(e + pos)
        pos = end
    empty = np.empty(0, np.int64)
    start = np.concatenate(starts) if starts else empty
    return Words(start, np.concatenate(ends) if ends else empty,
                 np.concatenate(codes) if codes else np.empty(0, np.uint64),
                 np.searchsorted(start, bounds))


def window_codes(code: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """Code of every ``k`` consecutive words of the flat sequence (ignores documents)."""
    n = max(0, len(code) - k + 1)
    total = np.zeros(n, np.uint64)
    for j, factor in enumerate(constants(k, seed)):
        total += code[j:j + n] * factor
    return mix(total)


def short_code(code: np.ndarray, k: int, seed: int = 5) -> int:
    """Code of a whole sequence shorter than ``k``; its length is part of it."""
    total = (code * constants(k, seed)[:len(code)]).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total + np.full(1, len(code), np.uint64) * np.uint64(0xA0761D6478BD642F))[0])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and document bounds of an Arrow string column (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), bounds


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of at most BLOCK_BYTES of text (or one longer document) with their text buffer."""
    forget_others()
    for batch in batches:
        data, bounds = text_buffer(batch.column(batch.schema.get_field_index(text)))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + BLOCK_BYTES, "right")) - 1)
            hi = min(hi, batch.num_rows)
            yield batch.slice(lo, hi - lo), data, bounds[lo:hi + 1]
            lo = hi
    give_back()


by_value(__name__)
