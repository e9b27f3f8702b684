"""Hard negatives by top-k inner products, with length buckets and sorted coordinate lists.

Vectors become whole numbers, scores are exact inner products.  An anchor's positives are its
best rows of the same label; for each positive, the negatives are the best rows of another label
whose score lies in a band below the positive's.  Both are one search: for every anchor and
*band* (lowest and highest score) the ``k`` best rows.

* *Blocks.*  Rows are dealt by length (and id) into groups of at most ``GROUP_ROWS``, anchors into
  blocks of at most ``BLOCK_ANCHORS``; every pair of a group and a block that can hold a
  result is one cogrouped task of bounded size.  Nothing is broadcast or collected but counts.
* *Lengths.*  ``score <= |anchor| * |row|``: an anchor is shipped only to groups whose longest row
  can reach its lowest useful score, and skips buckets (slices of a group) the same way.
* *Coordinates.*  With a positive lowest score, ``cos`` of anchor and row has a lower bound, so a row's
  coordinate ``f`` (of unit length) lies within the angles ``acos(a_f) -+ acos(bound)``.  A bucket holds
  each coordinate's values sorted: the ranges of the anchor's ``FOCUS`` largest coordinates are
  looked up, the shortest list is taken and the other ranges are intersected with it; what stays is
  scored exactly.  Ranges are widened by ``SLACK`` against rounding, so none is lost.
* *Thresholds.*  A probe of the group of the longest rows gives each band its k-th best score as
  first lowest score; it rises further from bucket to bucket.

Partial results (at most k a band and group) are merged by one ranked window.  Defined results:
rows with a null id, label or vector, or a null or non-finite component, take no part; exact
repeats of a row count once; rows that share an id but not their label or vector are separate rows, also as
anchors.  Shorter vectors count as padded with zeros.  A component of 65,536 or more in absolute
value raises an error: scores might not fit a long.  Ties go by the smaller id.  An empty table, no
anchor, no positive or an empty band give no row.  Columns other than the three named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.semantics import running_total
from flowlens.llm.workspace import by_value, stored

GROUP_ROWS = 2048
BLOCK_ANCHORS = 2048
BUCKET_ROWS = 512
FOCUS = 6
SLACK = 1e-6
SCALE = 256
LARGEST = 65_536.0
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def whole_rows(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """(vec_id, label, vector, size) of the rows that take part, each once; vector holds floor(256 * x)."""
    label = F.col("label") if label is None else label
    x = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("x"))
    fit = x.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(
        F.forall("x", lambda v: F.coalesce(F.abs(v) < F.lit(float("inf")), F.lit(False))))
    checked = F.when(F.exists("x", lambda v: F.abs(v) >= LARGEST), F.raise_error(F.lit("a component of 65,536 or more: scores might not fit a long")))
    vector = F.transform(F.coalesce(checked.cast("array<double>"), F.col("x")), lambda v: F.floor(v * SCALE).cast("int"))
    size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    return fit.select("vec_id", "label", vector.alias("vector")).distinct().withColumn("size", size)


def _dealt(rows: DataFrame, n: int, most: int, name: str) -> tuple[DataFrame, int]:
    """``rows`` with their ``place`` by falling length and the number ``name`` of their group of ``most``; and the number of groups.

    The place is the partition's offset (a prefix sum over one row a partition) plus the place inside it.
    """
    spread = rows.repartitionByRange(max(1, math.ceil(n / most)), F.col("size").desc(), "vec_id", "label", F.xxhash64("vector"))
    kept = stored(spread.withColumn("part", F.spark_partition_id().cast("long"))
                  .withColumn("inside", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), f"negatives-{name}")
    ends = running_total(kept.groupBy("part").agg(F.count("*").alias("n")), "part", "n", "end")
    placed = kept.join(ends.select("part", (F.col("end") - F.col("n")).alias("offset")), "part")
    place = F.col("offset") + F.col("inside")
    return (placed.withColumn("place", place).withColumn(name, F.floor(place / most).cast("long"))
            .drop("part", "inside", "offset")), max(1, math.ceil(n / most))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Doubles of an integer list column, padded with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    out[np.repeat(np.arange(len(lists)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = (
        lists.flatten().to_numpy())
    return out


class Bucket:
    """Rows of similar length with each coordinate's values sorted."""

    def __init__(self, vectors: np.ndarray, size: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.vectors, self.ids, self.labels = vectors, ids, labels
        self.longest = float(size.max())
        self.unit = vectors / np.where(size > 0, size, 1)[:, None]
        self.order = np.argsort(self.unit, axis=0)
        self.sorted = np.take_along_axis(self.unit, self.order, axis=0)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, bound: float) -> np.ndarray | slice:
        """Rows whose focus coordinates allow a cosine of ``bound`` (positive) with the unit anchor."""
        angle = math.acos(min(1.0, bound))
        lists = []
        for f in focus:
            own = math.acos(min(1.0, max(-1.0, float(unit[f]))))
            low, high = math.cos(min(math.pi, own + angle)) - SLACK, math.cos(max(0.0, own - angle)) + SLACK
            values = self.sorted[:, f]
            lists.append((int(np.searchsorted(values, low)), int(np.searchsorted(values, high, "right")), f, low, high))
        lists.sort(key=lambda x: x[1] - x[0])
        lo, hi, f, _, _ = lists[0]
        if 2 * (hi - lo) > len(self.ids):
            return slice(None)       # the shortest list leaves most rows: score them all
        rows = self.order[lo:hi, f]
        for _, _, f, low, high in lists[1:]:
            values = self.unit[rows, f]
            rows = rows[(values >= low) & (values <= high)]
        return rows


def _products(vectors: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
    """Exact inner products: in doubles where all sums stay below 2**53."""
    return (vectors @ anchor).astype(np.int64) if exact else vectors.astype(np.int64) @ anchor.astype(np.int64)


class Best:
    """The k best (score, id) of one anchor and band."""

    def __init__(self, low: int, high: int, k: int):
        self.low, self.high, self.k = low, high, k
        self.score, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        keep = (score >= self.low) & (score <= self.high)
        if not keep.any():
            return
        score, ids = np.concatenate([self.score, score[keep]]), np.concatenate([self.ids, ids[keep]])
        if len(score) > 4 * self.k:
            least = np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids = score[score >= least], ids[score >= least]
        order = np.lexsort((ids, -score))[:self.k]
        self.score, self.ids = score[order], ids[order]
        if len(order) == self.k:
            self.low = max(self.low, int(self.score[-1]))   # ties with a smaller id still pass


def _search(k: int, same: bool):
    """Task of one (group, block): the k best rows of every band of the block's anchors."""
    def run(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and anchors.num_rows:
            width = max(int(max(t.column("vector").combine_chunks().value_lengths().to_numpy().max() for t in (rows, anchors))), 1)
            order = np.argsort(-rows.column("size").to_numpy(), kind="stable")
            vectors, size = _matrix(rows.column("vector"), width)[order], rows.column("size").to_numpy()[order]
            ids, labels = rows.column("vec_id").to_numpy()[order], rows.column("label").to_numpy()[order]
            points = _matrix(anchors.column("vector"), width)
            exact = width * max(1.0, np.abs(vectors).max(initial=0)) * max(1.0, np.abs(points).max(initial=0)) < 2 ** 53
            buckets = [Bucket(vectors[i:i + BUCKET_ROWS], size[i:i + BUCKET_ROWS], ids[i:i + BUCKET_ROWS], labels[i:i + BUCKET_ROWS])
                       for i in range(0, len(ids), BUCKET_ROWS)]
            known = zip(anchors.column("anchor").to_pylist(), anchors.column("vec_id").to_pylist(), anchors.column("label").to_pylist(),
                        anchors.column("size").to_pylist(), anchors.column("bands").to_pylist(), points, strict=True)
            for anchor, vec_id, label, length, bands, point in known:
                best = [Best(b["low"], b["high"], k) for b in bands]
                unit = point / length if length else point
                focus = np.argsort(-np.abs(unit))[:FOCUS]
                for bucket in buckets:
                    low, reach = min(b.low for b in best), length * bucket.longest
                    if low > reach * (1 + SLACK) + SLACK:
                        break        # the buckets that follow are shorter still
                    found = bucket.candidates(unit, focus, low / reach * (1 - SLACK)) if low > 0 else slice(None)
                    found_ids, found_labels = bucket.ids[found], bucket.labels[found]
                    score = _products(bucket.vectors[found], point, exact)
                    fits = found_labels == label if same else found_labels != label
                    if same:
                        twin = np.flatnonzero(fits & (found_ids == vec_id))
                        fits[twin] = (bucket.vectors[found][twin] != point).any(axis=1)   # the anchor itself is no partner
                    for b in best:
                        b.add(score[fits], found_ids[fits])
                out += [(anchor, band["band"], i, s) for band, b in zip(bands, best, strict=True)
                        for i, s in zip(b.ids.tolist(), b.score.tolist(), strict=True)]
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(("anchor", "band", "vec_id", "score"), columns, strict=True)})
    return run


FOUND = "anchor long, band long, vec_id long, score long"


def _partials(rows: DataFrame, groups: int, anchors: DataFrame, blocks: int, k: int, same: bool) -> DataFrame:
    """The k best rows of each band in every group that can reach its lowest score."""
    longest = rows.groupBy("group").agg(F.max("size").alias("longest"))
    useful = F.array_min(F.transform("bands", lambda b: b["low"]))
    sent = (anchors.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
            .join(longest, "group").where(useful <= F.col("size") * F.col("longest") * (1 + SLACK) + SLACK).drop("longest"))
    dealt = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return (dealt.groupBy("group", "block").cogroup(sent.groupBy("group", "block"))
            .applyInArrow(_search(k, same), FOUND))


def _top(found: DataFrame, k: int) -> DataFrame:
    own = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)


def top_in_bands(rows: DataFrame, groups: int, anchors: DataFrame, blocks: int, k: int, same: bool) -> DataFrame:
    """(anchor, band, vec_id, score, rank) of the k best rows of each band; ``anchors`` carries the array ``bands``."""
    probe = stored(_top(_partials(rows.where("group = 0"), 1, anchors, blocks, k, same), k).where(F.col("rank") == k)
                   .groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("band", "score"))).alias("floor")), "negatives-probe")
    raised = (anchors.join(probe, "anchor", "left").withColumn("bands", F.transform("bands", lambda b: F.struct(
        b["band"].alias("band"), F.greatest(b["low"], F.coalesce(F.col("floor")[b["band"]], b["low"])).alias("low"), b["high"].alias("high")))))
    return _top(_partials(rows, groups, raised.drop("floor"), blocks, k, same), k)


def mine(embeddings: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 10,
         lower_percent: int = 30, upper_percent: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``vec_id`` and ``label``; ``label`` may replace the label column.  A negative's score
    lies between the two percentages of the positive's.
    """
    whole = stored(whole_rows(embeddings, label), "negatives-rows")
    rows, groups = _dealt(whole, whole.count(), GROUP_ROWS, "group")
    chosen = whole.where(is_anchor)
    anchors, blocks = _dealt(chosen, chosen.count(), BLOCK_ANCHORS, "block")
    rows, anchors = rows.drop("place"), anchors.withColumnRenamed("place", "anchor")
    all_scores = F.array(F.struct(F.lit(0).cast("long").alias("band"), F.lit(LOWEST).cast("long").alias("low"), F.lit(HIGHEST).cast("long").alias("high")))
    near = stored(top_in_bands(rows, groups, anchors.withColumn("bands", all_scores), blocks, positives, True), "negatives-positives")
    score = F.col("score").cast("decimal(20,0)")
    low = F.ceil(score * lower_percent / 100).cast("long")
    high = F.floor(score * upper_percent / 100).cast("long")
    bands = (near.withColumn("low", low).withColumn("high", high).where("low <= high")
             .groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(F.col("rank").cast("long").alias("band"), "low", "high"))).alias("bands")))
    wanted = stored(anchors.join(bands, "anchor"), "negatives-bands")
    found = top_in_bands(rows, groups, wanted, blocks, negatives, False)
    pairs = near.select("anchor", F.col("rank").cast("long").alias("band"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    return (found.join(pairs, ["anchor", "band"]).join(names, "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


by_value(__name__)
