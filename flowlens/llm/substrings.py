"""Substring deduplication by the repeated edges of a de Bruijn graph of word k-mers.

Edges are the k-mers (windows of ``window`` words, 64-bit codes).  Only repeated edges
matter, and runs of coordinates replace the graph: no node is made, no degree counted.

0. *Copies.*  Documents of one word sequence are found by the SHA-256 of their joined words;
   all but the first are repeated throughout, and only the first takes part in what follows.  Two fixed-size
   bitmaps tell the copies apart without a join: one of the copies, one of the other
   documents that pass it by chance (which therefore still take part).
1. *Screen.*  Each window has an anchor, the least code of its shorter grams; equal
   windows have equal anchors.  About one anchor in six words is shuffled and
   counted (partial aggregation, so frequent passages are merged on the map side);
   the repeated ones fill a fixed-size bitmap.
2. *Edges.*  Windows whose anchor is repeated are shuffled with their coordinates;
   an aggregation gives each repeated edge its earliest occurrence (doc_id, start)
   and a join brings that to all its occurrences.  AQE splits a hot edge's join.
3. *Paths.*  In a document an edge continues the path of the edge before it when its
   own and its source coordinates both advance by one.  A branch, or a source that
   does not go on in step, ends the path.  Coordinates are compared, the words at them are not.
   Each path becomes one row: (document, words from, to, source document, source start).
4. *Removal.*  A word covered by an edge that also starts earlier is removed.  A
   bitmap of the affected documents lets all others pass by without a shuffle.

Defined results: null and short texts have no window and keep all words.  A null
``doc_id`` sorts before all others.  Rows that share a ``doc_id`` are versions of
one document: the same window at the same start counts as one occurrence, and a
version (128 bits of the digest of its words, with the id) loses its own repeated words
only; rows with a null id are told apart the same way.  An empty table gives an empty result.
Codes are 64-bit: two different windows agree with a chance of 2**-64 a pair, and a
chance agreement would have to advance in step to make more than a one-edge path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm import bitmaps
from flowlens.llm.wordscan import SPACES, Words, blocks, mix, scan, space_words, text_buffer, window_codes
from flowlens.llm.workspace import by_value, free_names, stored

WINDOW = 20
GRAM = 10
COPY_BITS = 24   # of the two bitmaps of copies, 2 MB each
TO_SPACE = bytes(0x20 if b in SPACES else b for b in range(256))


def _windows(code: np.ndarray, doc: np.ndarray, window: int, gram: int):
    """Valid window starts, anchor code and anchor place of every window of the flat words."""
    n = len(code) - window + 1
    if n <= 0:
        empty = np.empty(0, np.int64)
        return empty.astype(bool), empty.astype(np.uint64), empty
    grams = window_codes(code, gram, seed=11)
    least, place = grams[:n].copy(), np.arange(n)
    for j in range(1, window - gram + 1):
        after = grams[j:j + n]
        lower = after < least          # the leftmost least gram stays
        least[lower] = after[lower]
        place[lower] = np.flatnonzero(lower) + j
    return doc[:n] == doc[window - 1:], least, place


def _digests(data: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """SHA-256 of each document's words, joined by single spaces."""
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        text = data[lo:hi].tobytes().translate(TO_SPACE).strip(b" ")
        while b"  " in text:
            text = text.replace(b"  ", b" ")
        out.append(hashlib.sha256(text).digest())
    return out


def _sequence(digests: list[bytes]) -> np.ndarray:
    """64-bit code of each document's word sequence: the beginning of its digest."""
    return np.frombuffer(b"".join(digests), np.uint64)[::4]


def _rest(digests: list[bytes]) -> np.ndarray:
    """The next 64 bits of the digests; with ``_sequence`` they tell apart versions of one doc_id."""
    return np.frombuffer(b"".join(digests), np.uint64)[1::4]


def _member(ids: pa.Array, sequence: np.ndarray) -> np.ndarray:
    """Bitmap code of a (document, sequence) row."""
    return mix(_code(ids) ^ sequence)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, bounds in blocks(batches):
        words, _ = _scan(rows, data, bounds)
        digests = _digests(data, bounds)
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(_sequence(digests).astype(np.uint64).view(np.int64)),
                                          pa.array(_rest(digests).astype(np.uint64).view(np.int64)),
                                          pa.array(digests, pa.binary()), pa.array(np.diff(words.first))],
                                         ["doc_id", "sequence", "rest", "digest", "n_words"])


def _member_codes(passing: np.ndarray | None):
    """Member codes of profile rows; with a bitmap, only of those it holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            code = _member(rows.column("doc_id"), rows.column("sequence").to_numpy().view(np.uint64))
            if passing is not None:
                code = code[bitmaps.holds(passing, code)]
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64))], ["code"])
    return run


class Copies:
    """Which rows are left out as copies: in the first bitmap and not in the second."""

    def __init__(self, copies: np.ndarray, chance: np.ndarray):
        self.copies, self.chance = copies, chance

    def out(self, ids: pa.Array, sequence: np.ndarray) -> np.ndarray:
        code = _member(ids, sequence)
        return bitmaps.holds(self.copies, code) & ~bitmaps.holds(self.chance, code)


def _scan(rows: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray) -> tuple[Words, np.ndarray]:
    words = scan(data, bounds, space_words(), fold=False)
    return words, np.repeat(np.arange(rows.num_rows), np.diff(words.first))


def _anchors(window: int, gram: int, copies: Copies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches):
            words, doc = _scan(rows, data, bounds)
            valid, least, place = _windows(words.code, doc, window, gram)
            valid &= ~copies.out(rows.column("doc_id"), _sequence(_digests(data, bounds)))[doc[:len(valid)]]
            fresh = valid.copy()
            fresh[1:] &= (place[1:] != place[:-1]) | ~valid[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(least[fresh].view(np.int64))], ["anchor"])
    return run


def _edges(window: int, gram: int, repeated: np.ndarray, copies: Copies):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches):
            words, doc = _scan(rows, data, bounds)
            valid, least, _ = _windows(words.code, doc, window, gram)
            digests = _digests(data, bounds)
            sequence = _sequence(digests)
            at = np.flatnonzero(valid & ~copies.out(rows.column("doc_id"), sequence)[doc[:len(valid)]])
            at = at[bitmaps.holds(repeated, least[at])]
            edge = window_codes(words.code, window, seed=23)[at]
            owner = doc[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(edge.view(np.int64)), rows.column("doc_id").take(pa.array(owner)),
                 pa.array(sequence[owner].view(np.int64)), pa.array(_rest(digests)[owner].view(np.int64)),
                 pa.array((at - words.first[owner]).astype(np.int32))],
                ["edge", "doc_id", "sequence", "rest", "start"])
    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int = bitmaps.BITS) -> DataFrame:
    """Paths of repeated windows: (doc_id, sequence, rest, first, last, source_doc, source_start).

    ``sequence`` and ``rest`` are 128 bits of the digest of the document's words: the version of the doc_id.

    ``first`` and ``last`` are window starts in the document; all windows of the
    path also start earlier, from ``source_start`` of ``source_doc`` on.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiles = stored(texts.mapInArrow(_profiles, "doc_id long, sequence long, rest long, digest binary, n_words long").where(F.col("n_words") >= window),
                      "profiles")
    shared = (profiles.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id")).alias("source")).where("n > 1"))
    again = (profiles.join(shared, "digest").where(~F.col("source.doc_id").eqNullSafe(F.col("doc_id")))
             .select("doc_id", "sequence", "rest", "digest", "n_words", F.col("source.doc_id").alias("source_doc")).distinct())
    again = stored(again, "copies")
    small = min(bits, COPY_BITS)
    copied = bitmaps.build(again.mapInArrow(_member_codes(None), "code long"), "code", small)
    others = profiles.join(again.select("doc_id", "digest"), (profiles["digest"] == again["digest"])
                           & profiles["doc_id"].eqNullSafe(again["doc_id"]), "left_anti")
    copies = Copies(copied, bitmaps.build(others.mapInArrow(_member_codes(copied), "code long"), "code", small))

    anchors = texts.select("doc_id", "text").mapInArrow(_anchors(window, gram, copies), "anchor long")
    repeated = bitmaps.build(anchors.groupBy("anchor").count().where("count > 1"), "anchor", bits)
    edges = texts.mapInArrow(_edges(window, gram, repeated, copies), "edge long, doc_id long, sequence long, rest long, start int")
    sources = (edges.groupBy("edge").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "start")).alias("source"))
               .where("n > 1").select("edge", "source"))
    later = (edges.join(sources, "edge")
             .where(~F.col("source.doc_id").eqNullSafe(F.col("doc_id")) | (F.col("source.start") != F.col("start")))
             .select("doc_id", "sequence", "rest", "start", F.col("source.doc_id").alias("source_doc"),
                     (F.col("source.start") - F.col("start")).alias("step")))
    # rows of one (document, source, step) whose starts follow each other are one path; rows may repeat
    line = Window.partitionBy("doc_id", "sequence", "rest", "source_doc", "step").orderBy("start")
    paths = (later.withColumn("path", F.col("start") - F.dense_rank().over(line))
             .groupBy("doc_id", "sequence", "rest", "source_doc", "step", "path")
             .agg(F.min("start").alias("first"), F.max("start").alias("last"))
             .select("doc_id", "sequence", "rest", "first", "last", "source_doc", (F.col("first") + F.col("step")).alias("source_start")))
    whole = again.select("doc_id", "sequence", "rest", F.lit(0).alias("first"),
                         (F.col("n_words") - window).cast("int").alias("last"), "source_doc", F.lit(0).alias("source_start"))
    return paths.unionByName(whole)


def _code(values: pa.Array) -> np.ndarray:
    """Bitmap code of a document id (null: its own)."""
    return mix(values.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) + np.uint64(77))


def _span_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmap codes of the ids and of the (document, sequence) rows that have spans."""
    for rows in batches:
        ids = rows.column("doc_id")
        yield pa.RecordBatch.from_arrays([pa.array(_code(ids).view(np.int64)),
                                          pa.array(_member(ids, rows.column("sequence").to_numpy().view(np.uint64)).view(np.int64))],
                                         ["id_code", "code"])


class Affected:
    """Which rows may have spans: by id first, then by the words as well (only then digests are made)."""

    def __init__(self, ids: np.ndarray, members: np.ndarray):
        self.ids, self.members = ids, members

    def holds(self, rows: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        ids = rows.column("doc_id").cast(pa.int64())
        found = bitmaps.holds(self.ids, _code(ids))
        for d in np.flatnonzero(found).tolist():
            sequence = _sequence(_digests(data, bounds[d:d + 2]))
            found[d] = bitmaps.holds(self.members, _member(ids.slice(d, 1), sequence))[0]
        return found


def _touched(affected: Affected, columns: list[str]):
    """Rows that may have spans, with the version of their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches):
            at = np.flatnonzero(affected.holds(rows, data, bounds))
            digests = [_digests(data, bounds[d:d + 2])[0] for d in at.tolist()]
            own = rows.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(_sequence(digests).view(np.int64)),
                                              pa.array(_rest(digests).view(np.int64))], columns)
    return run


def covered(words: Words, d: int, spans: list, window: int) -> np.ndarray:
    """Flags of document ``d``'s words: covered by a window of one of the paths."""
    n = int(words.first[d + 1] - words.first[d])
    change = np.zeros(n + 1, np.int64)
    for span in spans:
        change[span["first"]] += 1
        change[span["last"] + window] -= 1
    return np.cumsum(change)[:n] > 0


def _rewriter(window: int, columns: list[str], paths: str, emit, affected: Affected | None = None):
    """Applies the paths to the text of each row; ``emit`` makes the output batch.

    With a bitmap of affected documents, only rows that are not in it pass, unchanged.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches):
            if affected is not None:
                rows = rows.filter(pa.array(~affected.holds(rows, data, bounds)))
                data, bounds = text_buffer(rows.column("text"))
            words, _ = _scan(rows, data, bounds)
            spans = rows.column(paths).to_pylist() if affected is None else [None] * rows.num_rows
            yield emit(rows, data, words, [covered(words, d, own or [], window) for d, own in enumerate(spans)], columns)
    return run


def _cut_text(rows: pa.RecordBatch, data: np.ndarray, words: Words, flags: list, columns: list[str]) -> pa.RecordBatch:
    """The row with the covered words cut out of its text, other text unchanged."""
    texts = []
    for d, text in enumerate(rows.column("text").to_pylist()):
        if not flags[d].any():
            texts.append(text)
            continue
        lo = int(words.first[d])
        parts, keep = [], ~flags[d]
        opens = np.flatnonzero(keep & ~np.concatenate([[False], keep[:-1]]))
        closes = np.flatnonzero(keep & ~np.concatenate([keep[1:], [False]]))
        for a, b in zip(opens.tolist(), closes.tolist(), strict=True):
            parts.append(data[words.start[lo + a]:words.end[lo + b]].tobytes())
        texts.append(b" ".join(parts).decode("utf-8"))
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else rows.column(c) for c in columns], columns)


def _digest(rows: pa.RecordBatch, data: np.ndarray, words: Words, flags: list, columns: list[str]) -> pa.RecordBatch:
    sums = []
    for d, drop in enumerate(flags):
        kept = [data[s:e].tobytes() for s, e, x in zip(words.start[words.first[d]:words.first[d + 1]].tolist(),
                                                      words.end[words.first[d]:words.first[d + 1]].tolist(),
                                                      drop.tolist(), strict=True) if not x]
        sums.append(hashlib.sha256(b" ".join(kept)).hexdigest())
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id"), pa.array(np.diff(words.first)), pa.array([int(x.sum()) for x in flags], pa.int64()),
         pa.array(sums, pa.string())], columns)


def _apply(docs: DataFrame, window: int, columns: list[str], schema, emit) -> DataFrame:
    """Find the paths, then rewrite: only rows in the bitmap are joined with the paths of their version."""
    spans = stored(repeated_spans(docs, window).select("doc_id", "sequence", "rest", "first", "last"), "spans")
    codes = spans.select("doc_id", "sequence").distinct().mapInArrow(_span_codes, "id_code long, code long")
    affected = Affected(bitmaps.build(codes.select(F.col("id_code").alias("code")), "code", 22), bitmaps.build(codes, "code", 22))
    paths, owner, sequence, rest, own_sequence, own_rest = free_names(
        ["paths", "owner", "sequence", "rest", "own_sequence", "own_rest"], docs.columns)
    same = docs.mapInArrow(_rewriter(window, columns, paths, emit, affected), schema)
    own = (spans.groupBy(F.col("doc_id").cast("long").alias(owner), F.col("sequence").alias(own_sequence), F.col("rest").alias(own_rest))
           .agg(F.collect_list(F.struct("first", "last")).alias(paths)))
    hit = docs.mapInArrow(_touched(affected, [*docs.columns, sequence, rest]),
                          docs.select("*", *[F.lit(0).cast("long").alias(c) for c in (sequence, rest)]).schema)
    joined = hit.join(own, F.col("doc_id").cast("long").eqNullSafe(F.col(owner)) & (F.col(sequence) == F.col(own_sequence))
                      & (F.col(rest) == F.col(own_rest)), "left").drop(owner, sequence, rest, own_sequence, own_rest)
    return same.unionByName(joined.mapInArrow(_rewriter(window, columns, paths, emit), schema))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with every repeated word cut out of ``text``; all other columns stay."""
    return _apply(docs, window, docs.columns, docs.schema, _cut_text)


def removal_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row."""
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return _apply(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), window, names,
                  "doc_id long, n_words long, n_removed long, kept_sha256 string", _digest)


by_value(__name__)
