"""Periodic runs of words, by block convolution at dyadic scales.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
equal) that no neighbouring word extends keeping ``q``, of at least ``min_length`` words
and ``PERIODS`` periods.  Every word of a run after its first period repeats earlier words;
``collapse`` cuts those words.

1. *Blocks.*  The words of a batch of documents are one flat sequence of exact word ids
   (a dictionary of the batch, no hash).  At scale ``B`` it is cut into blocks of ``B`` words.
   A run of period ``B <= q < 2B`` and three periods holds a whole block whose copy ``q``
   words later lies in the run, too; scale 8 also serves the periods below 8.
2. *Convolution.*  For every block the sum of squared differences to each place of the
   following window is ``sum x*x + sum y*y - 2 * sum x*y``; the last term comes from a number
   theoretic transform modulo the prime ``P``.  Word values are bounded so that the sum
   stays below ``P``: it is zero modulo ``P`` exactly where no value differs.  One transform
   per block and scale serves as block and, shifted, as part of two windows.  Transforms are
   products with matrices of residues (four-step for long ones) in doubles, all sums below
   2**53, so each is exact.  Blocks above ``LARGEST`` words are not formed: longer periods are
   searched with that block over more windows.
3. *Extension.*  A zero-mismatch place (block start, distance) is a seed.  Seeds inside one
   known run are multiples of its period and go.  The others are compared by word id;
   neighbouring blocks of one distance join and are extended by less than a block.  Of
   stretches with the same bounds the smallest distance is the period.

Everything happens inside a document: no shuffle, memory in proportion to the longest text
of a batch.  Defined results: null and empty texts have no word and no run; rows are
independent, so repeated rows, ties and null ids give one result row each; an empty table
gives an empty result; other columns do not matter (``collapse`` keeps them).
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm.wordscan import blocks, mix
from flowlens.llm.workspace import by_value, process_cache

MIN_LENGTH = 24
PERIODS = 3
P = 7 * 2 ** 20 + 1      # prime; 3 generates its units
GENERATOR = 3
SMALLEST = 8             # words of a block at the first scale: 2 * 8 - 1 <= 24 - 8
LARGEST = 1 << 17
DIRECT = 256             # longest transform done as one matrix product
CHUNK = 1 << 17          # words of blocks transformed at once
SLICE_BYTES = 1 << 20    # bytes split into words at once


def _residue(x: np.ndarray) -> np.ndarray:
    """Least absolute residues modulo P of whole doubles below 2**53, in place."""
    x -= np.rint(x * (1.0 / P)) * P
    return x


def _powers(root: int, exponents: np.ndarray, size: int) -> np.ndarray:
    table = np.empty(size, np.int64)
    value = 1
    for i in range(size):
        table[i] = value
        value = value * root % P
    return _residue(table.astype(np.float64))[exponents % size]


def _matrix(n: int, sign: int) -> np.ndarray:
    """The n-point transform (sign 1) or its inverse without the factor 1/n (sign -1)."""
    def make():
        i = np.arange(n)
        return _powers(pow(GENERATOR, (P - 1) // n, P), sign * np.outer(i, i), n)
    return process_cache(f"runs matrix {n} {sign}", make)


def _twiddles(n: int, first: int, sign: int) -> np.ndarray:
    return process_cache(f"runs twiddle {n} {first} {sign}", lambda: _powers(
        pow(GENERATOR, (P - 1) // n, P), sign * np.outer(np.arange(n // first), np.arange(first)), n))


def transform(x: np.ndarray, sign: int = 1) -> np.ndarray:
    """Number theoretic transform of every row; rows may be shorter than the power of two given by a longer zero tail."""
    rows, n = x.shape
    if n <= DIRECT:
        return _residue(x @ _matrix(n, sign))
    first = 64
    rest = n // first
    inner = _residue(x.reshape(rows, first, rest).transpose(0, 2, 1) @ _matrix(first, sign))
    inner = _residue(inner * _twiddles(n, first, sign))                       # row, rest, first
    outer = transform(np.ascontiguousarray(inner.transpose(0, 2, 1)).reshape(rows * first, rest), sign)
    return outer.reshape(rows, first, rest).transpose(0, 2, 1).reshape(rows, n)


def _block_transforms(values: np.ndarray, block: int, wanted: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(wanted), 2 * block))
    rows[:, :block] = values[wanted[:, None] * block + np.arange(block)]
    if 2 * block <= DIRECT:
        return _residue(rows[:, :block] @ _matrix(2 * block, 1)[:block])
    return transform(rows)


def zero_mismatches(values: np.ndarray, block: int, wanted: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and distances where a wanted block recurs, distances ``step * block`` to the next multiple.

    ``values`` are whole numbers whose squared differences over a block sum to less than P,
    with zeros after the last word.
    """
    n = 2 * block
    square = np.concatenate([[0], np.cumsum((values * values).astype(np.int64))])
    sign = np.where(np.arange(n) % 2 == 0, 1.0, -1.0)   # a shift by half the transform
    back = -np.arange(n) % n
    inverse = float(pow(n, -1, P))
    starts, distances = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    per = max(1, CHUNK // block)
    for lo in range(0, len(wanted), per):
        own = wanted[lo:lo + per]
        need = np.unique(np.concatenate([own, own + step, own + step + 1]))
        found = _block_transforms(values, block, need)
        left, near, far = (np.searchsorted(need, own + k) for k in (0, step, step + 1))
        spectrum = _residue(found[left][:, back] * (found[near] + sign * found[far]))
        product = (_residue(spectrum @ _matrix(n, -1)[:, :block]) if n <= DIRECT else transform(spectrum, -1)[:, :block])
        product = _residue(product * inverse)
        at = own * block
        place = at[:, None] + step * block + np.arange(block)
        squares = square[place + block] - square[place] + (square[at + block] - square[at])[:, None]
        row, lag = np.nonzero(_residue(squares - 2.0 * product) == 0)
        starts.append(at[row])
        distances.append(lag + step * block)
    return np.concatenate(starts), np.concatenate(distances)


def _values(ids: np.ndarray, block: int, size: int) -> np.ndarray:
    """Word values for one scale: spread over as many numbers as keep sums of squares below P."""
    spread = math.isqrt((P - 1) // block) + 1
    out = np.zeros(size)
    out[:len(ids)] = mix(ids.astype(np.uint64) + np.uint64(block * 2 + 1)) % np.uint64(spread)
    return out


def _verified(ids: np.ndarray, start: np.ndarray, distance: np.ndarray, block: int) -> np.ndarray:
    """Whether the words of the block and of its occurrence are equal."""
    keep = np.empty(len(start), bool)
    per = max(1, CHUNK // block)
    for lo in range(0, len(start), per):
        at = start[lo:lo + per, None] + np.arange(block)
        keep[lo:lo + per] = (ids[at] == ids[at + distance[lo:lo + per, None]]).all(axis=1)
    return keep


def _reach(ids: np.ndarray, start: np.ndarray, distance: np.ndarray, room: np.ndarray, block: int, way: int) -> np.ndarray:
    """Equal pairs beside ``start`` in direction ``way``: at most ``room``, always less than a block."""
    out = np.empty(len(start), np.int64)
    per = max(1, CHUNK // block)
    step = np.arange(block)
    for lo in range(0, len(start), per):
        room_here = room[lo:lo + per, None]
        inside = step < room_here
        at = np.where(inside, start[lo:lo + per, None] + way * step, 0)
        differs = ~inside | (ids[at] != ids[np.where(inside, at + distance[lo:lo + per, None], 0)])
        out[lo:lo + per] = np.where(differs.any(axis=1), differs.argmax(axis=1), block)
    return out


def find_runs(ids: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, flat word numbers; document d is ``first[d]:first[d + 1]``."""
    if min_length < 3 * SMALLEST:
        raise ValueError(f"min_length is at least {3 * SMALLEST}")
    length = np.diff(first)
    longest = int(length.max(initial=0))
    owner = np.repeat(np.arange(len(length)), length)
    begin = end = period = np.empty(0, np.int64)
    block = SMALLEST
    while PERIODS * block <= longest or block == SMALLEST and longest >= min_length:
        n_blocks = -(-len(ids) // block)
        tail = longest // (PERIODS * block) + 3 if block == LARGEST else 3
        at = np.arange(len(ids) // block) * block
        doc = owner[at]
        limit = first[doc + 1]
        whole = (at + block < limit) & (length[doc] >= max(min_length, PERIODS * (1 if block == SMALLEST else block)))
        values = _values(ids, block, (n_blocks + tail) * block)
        order = np.argsort(begin, kind="stable")
        known, covered_to = begin[order], np.maximum.accumulate(end[order])
        starts, distances = [], []
        last = longest // (PERIODS * block) if block == LARGEST else 1
        for step in range(0 if block == SMALLEST else 1, last + 1):
            fits = whole & (at + step * block + block <= limit)
            start, distance = zero_mismatches(values, block, np.flatnonzero(fits), step)
            keep = (distance > 0) & (start + distance + block <= first[owner[start] + 1])
            start, distance = start[keep], distance[keep]
            if len(known):
                before = np.searchsorted(known, start, "right")
                inside = (before > 0) & (covered_to[before - 1] >= start + distance + block)
                start, distance = start[~inside], distance[~inside]
            keep = _verified(ids, start, distance, block)
            starts.append(start[keep])
            distances.append(distance[keep])
        start, distance = np.concatenate(starts), np.concatenate(distances)
        order = np.lexsort((start, distance))
        start, distance = start[order], distance[order]
        if len(start):
            opens = np.ones(len(start), bool)
            opens[1:] = (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + block) | (owner[start[1:]] != owner[start[:-1]])
            lo, step = start[opens], distance[opens]
            hi = start[np.append(np.flatnonzero(opens)[1:], len(start)) - 1] + block
            lo = lo - _reach(ids, lo - 1, step, lo - first[owner[lo]], block, -1)
            hi = hi + _reach(ids, hi, step, first[owner[lo] + 1] - step - hi, block, 1)
            keep = hi + step - lo >= np.maximum(min_length, PERIODS * step)
            begin, end, period = (np.concatenate([a, b[keep]]) for a, b in ((begin, lo), (end, hi + step), (period, step)))
            order = np.lexsort((period, end, begin))
            begin, end, period = begin[order], end[order], period[order]
            new = np.ones(len(begin), bool)
            new[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
            begin, end, period = begin[new], end[new], period[new]
        if block == LARGEST:
            break
        block *= 2
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


class Vocabulary:
    """Exact word ids of one batch; a text's word list is made in slices only."""

    def __init__(self):
        self.ids = defaultdict(count().__next__)

    def encode(self, data: memoryview) -> np.ndarray:
        """Ids of the words of one text."""
        parts, lo = [np.empty(0, np.int64)], 0
        while lo < len(data):
            hi = min(lo + SLICE_BYTES, len(data))
            while hi < len(data) and data[hi] != 0x20 and not 0x09 <= data[hi] <= 0x0D:
                hi += 1
            found = data[lo:hi].tobytes().split()   # at 0x20 and 0x09 to 0x0D, nothing else
            parts.append(np.fromiter(map(self.ids.__getitem__, found), np.int64, len(found)))
            lo = hi
        return np.concatenate(parts)

    def spelled(self, word_ids: np.ndarray, words: list[bytes]) -> Iterator[bytes]:
        """The words joined by one space, in slices."""
        for lo in range(0, len(word_ids), 1 << 16):
            yield (b" " if lo else b"") + b" ".join(map(words.__getitem__, word_ids[lo:lo + (1 << 16)].tolist()))


Change = Callable[[int | None, np.ndarray], np.ndarray]


def _batches(id_column: str, min_length: int, change: Change | None, emit) -> Callable:
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(found):
            view, vocabulary = memoryview(data), Vocabulary()
            texts = [vocabulary.encode(view[lo:hi]) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            if change is not None:
                texts = [change(d, t) for d, t in zip(rows.column(id_column).to_pylist(), texts, strict=True)]
            first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            begin, end, period = find_runs(np.concatenate(texts), first, min_length)
            split = np.searchsorted(begin, first)
            words = list(vocabulary.ids)
            own = []
            for d, ids in enumerate(texts):
                part = slice(split[d], split[d + 1])
                own.append((ids, begin[part] - first[d], end[part] - first[d], period[part]))
            yield emit(rows, own, lambda ids, words=words, vocabulary=vocabulary: vocabulary.spelled(ids, words))
    return run


def kept(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The ids outside all runs' later periods."""
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, begin + period, 1)
    np.add.at(change, end, -1)
    return ids[np.cumsum(change)[:-1] == 0]


def _collapsed(columns: list[str], text: str):
    def emit(rows: pa.RecordBatch, own: list, spell) -> pa.RecordBatch:
        texts = []
        for old, (ids, begin, end, period) in zip(rows.column(text).to_pylist(), own, strict=True):
            texts.append(b"".join(spell(kept(ids, begin, end, period))).decode() if len(begin) else old)
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text else rows.column(c) for c in columns], columns)
    return emit


def collapse(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with every run in ``text`` cut to its first period (words joined by one space); other texts stay as they are."""
    return docs.mapInArrow(_batches("doc_id", min_length, None, _collapsed(docs.columns, "text")), docs.schema)


def _spans(rows: pa.RecordBatch, own: list, spell) -> pa.RecordBatch:
    per = [len(b) for _, b, _, _ in own]
    joined = [np.concatenate([np.empty(0, np.int64), *part]) for part in zip(*[(b, e - b, q) for _, b, e, q in own], strict=True)]
    return pa.RecordBatch.from_arrays([rows.column("doc_id").take(pa.array(np.repeat(np.arange(len(own)), per))),
                                       *map(pa.array, joined)], ["doc_id", "start", "length", "period"])


def run_spans(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, start, length, period) of every run."""
    texts = docs.select("doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_batches("doc_id", min_length, None, _spans), f"doc_id {kind}, start long, length long, period long")


def _digest(rows: pa.RecordBatch, own: list, spell) -> pa.RecordBatch:
    out = []
    for ids, begin, end, period in own:
        listed = "".join(f"{b},{e - b},{q}\n" for b, e, q in zip(begin.tolist(), end.tolist(), period.tolist(), strict=True))
        text = hashlib.sha256()
        for part in spell(kept(ids, begin, end, period) if len(begin) else ids):
            text.update(part)
        best = (None, None, None, None)
        for b, e, q in zip(begin.tolist(), end.tolist(), period.tolist(), strict=True):   # by start, then period: the first of equals stays
            if best[0] is None or (e - b) * best[2] > best[1] * q:
                best = (b, e - b, q, 1000 * (e - b) // q)
        out.append((len(begin), *best, hashlib.sha256(listed.encode()).hexdigest(), text.hexdigest()))
    columns = list(zip(*out, strict=True)) if out else [()] * 7
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:5]], *[pa.array(c, pa.string()) for c in columns[5:]]],
        ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])


def run_digest(docs: DataFrame, change: Change | None = None, min_length: int = MIN_LENGTH) -> DataFrame:
    """Per row: number of runs, the run of the greatest length/period, digests of the list of runs and of the collapsed text.

    ``change(doc_id, word ids)`` may rearrange a document's words before they are searched.
    """
    texts = docs.select("doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_batches("doc_id", min_length, change, _digest), f"""doc_id {kind}, n_runs long, start long,
        length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string""")


by_value(__name__)
