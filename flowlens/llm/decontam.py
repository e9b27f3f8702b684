"""Benchmark decontamination: a broadcast hash set of test n-grams over training windows.

The benchmark's normalised word windows are counted first.  Up to ``max_windows`` (window, item)
pairs they are collected and shipped with the tasks, a broadcast of bounded size: documents are
not shuffled, each task scans the word windows of its rows, looks their codes up and verifies
every hit word by word.

A larger benchmark never leaves Spark: a fixed-size bitmap of its window codes goes to the tasks
instead, the document windows that pass it are joined with the benchmark's windows by length, code and
words (which verifies them), and the hits return to their rows.  The rows are written once, with a number,
for that.  Both ways give the same rows, spans included.

Defined results: a null or wordless text has no words and no hits; a benchmark
item without words has no window; items that repeat an id are one item, a null id
counts as the empty string; an empty benchmark gives no hits; each row is judged
alone, so repeated rows and ids simply repeat their result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm import bitmaps
from flowlens.llm.wordscan import Words, alnum_words, blocks, scan, window_codes
from flowlens.llm.workspace import by_value, stored

NGRAM = 10
MAX_WINDOWS = 1 << 17     # (window, item) pairs that are shipped with the tasks
FILTER_BITS = 22
LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
WINDOW_SCHEMA = "item string, length int, code long, words binary"


def _key(data: np.ndarray, words: Words, at: int, length: int) -> bytes:
    """The folded words of a window, joined by one space."""
    spans = zip(words.start[at:at + length], words.end[at:at + length], strict=True)
    return b" ".join(data[s:e].tobytes().translate(LOWER) for s, e in spans)


def _item_windows(ngram: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches):
            words = scan(data, bounds, alnum_words(), fold=True)
            out = []
            for d, item in enumerate(rows.column(0).to_pylist()):
                lo, hi = int(words.first[d]), int(words.first[d + 1])
                length = min(ngram, hi - lo)
                if length:
                    codes = window_codes(words.code[lo:hi], length).view(np.int64)
                    out += [(item or "", length, int(c), _key(data, words, lo + i, length)) for i, c in enumerate(codes)]
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
                 pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.binary())],
                ["item", "length", "code", "words"])
    return windows


def benchmark_windows(benchmark: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """(length, code, words, items): the benchmark's different windows with the sorted ids of their items."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return (items.mapInArrow(_item_windows(ngram), WINDOW_SCHEMA)
            .groupBy("length", "code", "words").agg(F.sort_array(F.collect_set("item")).alias("items")))


def _table(windows: DataFrame) -> dict[int, dict]:
    """Windows as a lookup: length -> code -> [(words, items)]."""
    table: dict[int, dict] = {}
    for row in windows.toLocalIterator():
        table.setdefault(row.length, {}).setdefault(row.code, []).append((bytes(row.words), row.items))
    return table


def _runs(change: np.ndarray, doc: np.ndarray, words: Words, n_rows: int) -> list[list]:
    """Per row the longest stretches of words inside some hit window; ``change`` opens and closes windows."""
    n = len(doc)
    hit = np.cumsum(change)[:n] > 0
    edge = np.concatenate([[True], doc[1:] != doc[:-1], [True]]) if n else np.ones(1, bool)
    opens = np.flatnonzero(hit & (edge[:-1] | ~np.concatenate([[False], hit[:-1]]))) if n else np.empty(0, int)
    closes = np.flatnonzero(hit & (edge[1:] | ~np.concatenate([hit[1:], [False]]))) + 1 if n else np.empty(0, int)
    spans: list[list] = [[] for _ in range(n_rows)]
    for s, e in zip(opens.tolist(), closes.tolist(), strict=True):
        base = words.first[doc[s]]
        spans[doc[s]].append({"start": int(s - base), "end": int(e - base)})
    return spans


def _scanner(table: dict[int, dict], keep: list[str]):
    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64((1 << FILTER_BITS) - 1)
        filters = {}
        for length, codes in table.items():
            known = np.array(sorted(codes), np.int64).view(np.uint64)
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[known & mask] = True
            filters[length] = (np.sort(known), seen)
        for rows, data, bounds in blocks(batches):
            words = scan(data, bounds, alnum_words(), fold=True)
            n = len(words.code)
            doc = np.repeat(np.arange(rows.num_rows), np.diff(words.first))
            change = np.zeros(n + 1, np.int64)
            items: list[set] = [set() for _ in range(rows.num_rows)]
            for length, (known, seen) in filters.items():
                codes = window_codes(words.code, length)
                at = np.flatnonzero(seen[codes & mask])
                at = at[doc[at] == doc[at + length - 1]]
                place = np.minimum(np.searchsorted(known, codes[at]), len(known) - 1)
                at = at[known[place] == codes[at]]
                for i in at.tolist():
                    own = _key(data, words, i, length)
                    for text, names in table[length][int(codes[i:i + 1].view(np.int64)[0])]:
                        if text == own:
                            change[i] += 1
                            change[i + length] -= 1
                            items[doc[i]].update(names)
            yield pa.RecordBatch.from_arrays(
                [rows.column(c) for c in keep] + [
                    pa.array(np.diff(words.first), pa.int64()), pa.array(_runs(change, doc, words, rows.num_rows), SPANS),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string()))], [*keep, "n_words", "hit_spans", "hit_items"])
    return lookup


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
SPANS_DDL = "array<struct<start: bigint, end: bigint>>"


def _candidates(lengths: list[int], bitmap: np.ndarray):
    """Document windows whose code passes the bitmap: (number, start, length, code, words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches):
            words = scan(data, bounds, alnum_words(), fold=True)
            doc = np.repeat(np.arange(rows.num_rows), np.diff(words.first))
            parts = [[], [], [], [], []]
            for length in lengths:
                codes = window_codes(words.code, length)
                at = np.flatnonzero(bitmaps.holds(bitmap, codes)) if len(codes) else np.empty(0, int)
                at = at[doc[at] == doc[at + length - 1]]
                parts[0] += doc[at].tolist()
                parts[1] += (at - words.first[doc[at]]).tolist()
                parts[2] += [length] * len(at)
                parts[3] += codes[at].view(np.int64).tolist()
                parts[4] += [_key(data, words, i, length) for i in at.tolist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("number").take(pa.array(parts[0], pa.int64())), pa.array(parts[1], pa.int64()), pa.array(parts[2], pa.int32()),
                 pa.array(parts[3], pa.int64()), pa.array(parts[4], pa.binary())], ["number", "start", "length", "code", "words"])
    return run


def _marker(keep: list[str]):
    """Rows with the (start, length) of their hits -> number of words and canonical spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches):
            words = scan(data, bounds, alnum_words(), fold=True)
            doc = np.repeat(np.arange(rows.num_rows), np.diff(words.first))
            change = np.zeros(len(words.code) + 1, np.int64)
            for d, hits in enumerate(rows.column("hits").to_pylist()):
                for hit in hits or []:
                    change[words.first[d] + hit["start"]] += 1
                    change[words.first[d] + hit["start"] + hit["length"]] -= 1
            items = [x or [] for x in rows.column("found_items").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column(c) for c in keep] + [
                    pa.array(np.diff(words.first), pa.int64()), pa.array(_runs(change, doc, words, rows.num_rows), SPANS),
                    pa.array(items, pa.list_(pa.string()))], [*keep, "n_words", "hit_spans", "hit_items"])
    return run


def _joined_hits(rows: DataFrame, windows: DataFrame, keep: list[str], schema) -> DataFrame:
    """Hits of a benchmark of any size: windows that pass a bitmap are joined with the benchmark's."""
    windows = stored(windows, "benchmark-windows")
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())   # at most the n-gram's length many
    bitmap = bitmaps.build(windows, "code")
    numbered = stored(rows.withColumn("number", F.monotonically_increasing_id()), "decontamination-rows")
    found = (numbered.select("number", "text").mapInArrow(_candidates(lengths, bitmap), "number long, start long, length int, code long, words binary")
             .join(windows, ["length", "code", "words"]).select("number", "start", "length", "items"))
    found = stored(found, "decontamination-hits")
    own = (found.groupBy("number").agg(F.collect_list(F.struct("start", "length")).alias("hits"))
           .join(found.select("number", F.explode("items").alias("item")).distinct()
                 .groupBy("number").agg(F.sort_array(F.collect_list("item")).alias("found_items")), "number"))
    return numbered.join(own, "number", "left").drop("number").mapInArrow(_marker(keep), schema)


def find_hits(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """(doc_id, text, n_words, hit_spans, hit_items) per row of ``docs``; other columns go into ``row``.

    ``hit_spans`` are the longest word ranges [start, end) whose words all lie in some benchmark window;
    ``hit_items`` the sorted ids of the items whose windows occur.
    """
    keep = ["doc_id", "text", "row"]
    others = [docs[c] for c in docs.columns if c not in ("doc_id", "text")]
    row = F.struct(*others) if others else F.lit(None).cast("string")
    rows = docs.select("doc_id", "text", row.alias("row"))
    schema = rows.select("*", F.lit(0).cast("long").alias("n_words"), F.array().cast(SPANS_DDL).alias("hit_spans"),
                         F.array().cast("array<string>").alias("hit_items")).schema
    windows = benchmark_windows(benchmark, ngram)
    pairs = windows.agg(F.sum(F.size("items"))).head()[0] or 0
    if pairs > max_windows:
        return _joined_hits(rows, windows, keep, schema)
    return rows.mapInArrow(_scanner(_table(windows), keep), schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """``docs``, all columns, without the documents that hold a benchmark window."""
    clean = find_hits(docs, benchmark, ngram).where(F.size("hit_spans") == 0)
    return clean.select(*[F.col(c) if c in ("doc_id", "text") else F.col("row")[c].alias(c) for c in docs.columns])


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        n_hit = []
        for spans in rows.column("hit_spans").to_pylist():
            covered, last = 0, 0
            for s, e in sorted((x["start"], x["end"]) for x in spans):
                covered += max(0, e - max(s, last))
                last = max(last, e)
            n_hit.append(covered)
        items = rows.column("hit_items").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("n_words"), pa.array(n_hit, pa.int64()),
             pa.array([len(x) for x in items], pa.int64()),
             pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]),
             pa.array([x > 0 for x in n_hit], pa.bool_())],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def hit_digest(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """Counts and the digest of the hit items per document."""
    found = find_hits(docs.select("doc_id", "text"), benchmark, ngram).drop("text", "row")
    return found.mapInArrow(_digest_rows, "doc_id long, n_words long, n_hit long, n_items long, "
                                          "items_sha256 string, contaminated boolean")


by_value(__name__)
