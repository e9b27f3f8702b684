"""N-gram Jaccard self-join with vertical partitioning.

Documents are sets of distinct word n-grams (64-bit codes).  The global n-gram order
puts the n-grams known to be frequent last (by frequency), all others before them by
code; any order gives the exact result, this one keeps frequent n-grams out of the
prefixes.  The order is cut into fragments, the overlap of a candidate pair is counted
per fragment and summed per pair.

1. *Profiles.*  One scan gives every document its set size and a signature of its set
   (copies share one and are one node from here on) and the n-grams met twice or more
   within a block of text; their summed counts pick at most ``MAX_HEAVY`` heavy n-grams,
   a bounded broadcast.
2. *Postings.*  A set of n n-grams can only reach similarity t with sets that hold one of
   its first n - ceil(t n) + 1.  Those prefixes are counted by n-gram; the repeated ones
   fill a fixed-size bitmap, and only their (n-gram, set, size, position) are shuffled.
3. *Candidates.*  First every set meets only the cleanest member of its lists (a star, not
   all pairs); the verified links are closed into components.  A second star has the cleanest
   member outside the first one's component.  Then, for what is still apart, the other pairs of
   a list from different components.  Size and position bounds and, after the first star, bit
   sketches of the prefixes prune pairs that cannot reach t; no other limit applies, so no
   link between components is lost.
4. *Screening.*  What two prefixes share, plus what follows the longer remainder, bounds
   the overlap; a pair below the needed overlap is dropped before any set is fetched.
5. *Verification.*  The sets of the candidates, cut into fragments, are joined with the
   pairs, partial overlaps are counted per fragment and summed: 100 * overlap >=
   t * union is exact integer arithmetic.

Defined results: null and wordless texts have size 0 and are alone; shorter texts have
their whole word sequence as one n-gram; rows that share a ``doc_id`` keep one result
each; a null ``doc_id`` never names a component unless all its members have none.
An empty table gives an empty result.

Driver memory: bitmaps and heavy n-grams, both of bounded size.  Every join is by shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm import bitmaps
from flowlens.llm.graph import components
from flowlens.llm.wordscan import blocks, mix, scan, short_code, space_words, window_codes
from flowlens.llm.workspace import by_shuffle, by_value, free_names, release, small_batches, stored

NGRAM = 5
PERCENT = 75
MAX_HEAVY = 1 << 18     # heavy n-grams broadcast at most (2 MB)
HEAVY_DOCUMENTS = 32    # known count from which an n-gram may be heavy
HEAVY_PREFIXES = 4      # prefixes holding it from which an n-gram may be heavy
HEAVY_BLOCK = 1 << 19   # n-grams looked at together for repeats
FRAGMENTS = 8
UNSURE_BITS = 22        # bitmap of the few rows that a join decides on
SKETCH = ["s0", "s1", "s2", "s3"]


def _sets(rows: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct n-gram codes of every row."""
    words = scan(data, bounds, space_words(), fold=True)
    grams = window_codes(words.code, k)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if hi - lo >= k:
            own = np.sort(grams[lo:hi - k + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif hi > lo:
            out.append(np.array([short_code(words.code[lo:hi], k)], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _signature(codes: np.ndarray) -> int:
    """64-bit signature of a set: equal sets have equal ones."""
    total = mix(codes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total + np.uint64(len(codes))).view(np.int64)[0])


def _profiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "doc_id", "n", "code"]

        def repeats(parts: list[np.ndarray]) -> pa.RecordBatch:
            code, n = np.unique(np.concatenate(parts), return_counts=True)
            code, n = code[n > 1], n[n > 1]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(code), np.int32)), pa.nulls(len(code), pa.int64()), pa.array(n.astype(np.int64)),
                 pa.array(code.view(np.int64))], names)

        parts, held = [], 0
        for rows, data, bounds in blocks(batches):
            sets = _sets(rows, data, bounds, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(sets), np.int32)), rows.column("doc_id"),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([_signature(s) for s in sets], pa.int64())], names)
            parts += sets
            held += sum(map(len, sets))
            if held >= HEAVY_BLOCK:
                yield repeats(parts)
                parts, held = [], 0
        if parts:
            yield repeats(parts)
    return run


class Order:
    """The global n-gram order: others by code, then the heavy ones, rarest first."""

    def __init__(self, heavy: np.ndarray):
        by_code = np.argsort(heavy)
        self.code, self.rank = heavy[by_code], by_code.astype(np.uint64) + np.uint64(1 << 63)

    def keys(self, codes: np.ndarray) -> np.ndarray:
        keys = codes >> np.uint64(1)
        if len(self.code):
            place = np.minimum(np.searchsorted(self.code, codes), len(self.code) - 1)
            found = self.code[place] == codes
            keys[found] = self.rank[place[found]]
        return keys


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _prefixes(k: int, percent: int, heavy: np.ndarray, chosen: np.ndarray, repeated: np.ndarray | None):
    """Prefix n-grams of the rows in the bitmap ``chosen``; with a bitmap of repeated ones, their postings instead."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(heavy)
        for rows, data, bounds in blocks(batches):
            grams, sign, size, place, light = [], [], [], [], []
            sets = _sets(rows, data, bounds, k)
            node = np.array([_signature(s) for s in sets], np.int64)
            for d in np.flatnonzero(bitmaps.holds(chosen, _member_code(rows.column("doc_id"), node))).tolist():
                codes = sets[d]
                n = len(codes)
                if not n:
                    continue
                keys = order.keys(codes)
                by_key = np.argsort(keys, kind="stable")[:prefix_length(n, percent)]
                own, at = codes[by_key], np.arange(len(by_key))
                if repeated is not None:
                    found = bitmaps.holds(repeated, own)
                    own, at = own[found], at[found]
                    sign.append(np.full(len(own), node[d], np.int64))
                    size.append(np.full(len(own), n, np.int32))
                    place.append(at.astype(np.int32))
                    light.append(np.full(len(own), 1000 * int((keys < np.uint64(1 << 63)).sum()) // n, np.int32))
                grams.append(own)
            if not grams:
                continue
            columns = {"gram": np.concatenate(grams).view(np.int64)}
            if repeated is not None:
                columns |= {"node": np.concatenate(sign), "n": np.concatenate(size), "place": np.concatenate(place),
                            "light": np.concatenate(light)}
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))
    return run


def _member_code(doc_id: pa.Array, node: np.ndarray) -> np.ndarray:
    """Bitmap code of a (doc_id, set) row."""
    ids = doc_id.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return mix(mix(ids + np.uint64(99)) ^ node.astype(np.int64).view(np.uint64))


def _member_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        code = _member_code(rows.column("doc_id"), rows.column("node").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64))], ["code"])


def _fragments(k: int, heavy: np.ndarray, wanted: np.ndarray, fragments: int):
    """(node, fragment, codes) of the rows in the bitmap: their sets cut along the global order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = Order(heavy)
        cuts = (np.arange(1, fragments, dtype=np.uint64) * np.uint64((1 << 63) // (fragments - 1)))
        for rows, data, bounds in blocks(batches):
            sets = _sets(rows, data, bounds, k)
            node = np.array([_signature(s) for s in sets], np.int64)
            found = bitmaps.holds(wanted, _member_code(rows.column("doc_id"), node))
            nodes, parts, codes = [], [], []
            for d in np.flatnonzero(found).tolist():
                if not len(sets[d]):
                    continue
                part = np.searchsorted(cuts, order.keys(sets[d]), "right")
                for f in np.unique(part).tolist():
                    nodes.append(node[d])
                    parts.append(f)
                    codes.append(sets[d][part == f].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(parts, pa.int32()), pa.array(codes, pa.list_(pa.int64()))],
                ["node", "fragment", "codes"])
    return run


def _may_link(percent: int, n1: Column, p1: Column, n2: Column, p2: Column) -> Column:
    """Size bound, and position bound for a pair that meets at positions p1 and p2."""
    return ((100 * F.least(n1, n2) >= percent * F.greatest(n1, n2))
            & ((100 + percent) * F.least(n1 - p1, n2 - p2) >= percent * (n1 + n2)))


def _may_share(percent: int, a: str, b: str) -> Column:
    """Whether two prefixes can share as much as ``Join.screened`` asks for, by their sketches.

    Every bit that only one sketch has stands for at least one n-gram that only its prefix has.
    """
    def common(x: str, y: str) -> Column:
        own = [F.bit_count(F.col(f"{x}.s{i}").bitwiseAND(F.bitwise_not(F.col(f"{y}.s{i}")))) for i in range(4)]
        return F.col(f"{x}.held") - (own[0] + own[1] + own[2] + own[3])
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    behind = F.greatest(*[F.ceil(percent * c / 100) - 1 for c in (n, m)])
    return (100 + percent) * (F.least(common(a, b), common(b, a)) + behind) >= percent * (n + m)


class Join:
    """The self-join of ``docs`` (doc_id, text); the tables it makes lie in the shared folder."""

    def __init__(self, docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT, bits: int = bitmaps.BITS):
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        self.k, self.percent, self.bits = ngram, percent, bits
        first = stored(self.texts.mapInArrow(_profiles(ngram), "kind int, doc_id long, n long, code long"), "profiles")
        self.profiles = first.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("code").alias("node"))
        # one row of each set takes part in the scans of prefixes: copies are neither counted nor shuffled
        self.chosen = self._rows_of(self.profiles.where("n_shingles > 0"))
        known = (first.where("kind = 1").groupBy("code").agg(F.sum("n").alias("df")).where(F.col("df") >= HEAVY_DOCUMENTS)
                 .orderBy(F.desc("df"), "code").limit(MAX_HEAVY).toArrow())
        self._set_heavy(known["code"].to_numpy(), known["df"].to_numpy())
        # counted exactly where it matters: what many prefixes of this order still hold is heavy too
        crowded = (self._scan_prefixes(None, "gram long").groupBy("gram").count().where(F.col("count") >= HEAVY_PREFIXES)
                   .orderBy(F.desc("count"), "gram").limit(MAX_HEAVY))
        with small_batches(docs.sparkSession):
            often = crowded.toArrow()
        del crowded
        self._set_heavy(np.concatenate([known["code"].to_numpy(), often["gram"].to_numpy()]),
                        np.concatenate([known["df"].to_numpy(), often["count"].to_numpy()]))
        del known, often
        release(docs.sparkSession)

    def _set_heavy(self, code: np.ndarray, n: np.ndarray) -> None:
        """``heavy``: n-grams by the larger of their counts, rarest first; at most MAX_HEAVY, eight bytes each."""
        by_count = np.lexsort((code, n))
        code = code[by_count]
        last = len(code) - 1 - np.unique(code[::-1], return_index=True)[1]   # where the largest count of each is
        self.heavy = code[np.sort(last)][-MAX_HEAVY:].astype(np.int64, copy=True).view(np.uint64)

    def _scan_prefixes(self, repeated: np.ndarray | None, schema: str) -> DataFrame:
        return self.texts.mapInArrow(_prefixes(self.k, self.percent, self.heavy, self.chosen, repeated), schema)

    def _rows_of(self, profiles: DataFrame) -> np.ndarray:
        """Bitmap of one row of each set: that of its smallest doc_id."""
        rows = profiles.groupBy("node").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "node")
        return bitmaps.build(rows.mapInArrow(_member_codes, "code long"), "code", self.bits)

    def links(self) -> DataFrame:
        """Verified links (a, b) whose closure is that of all links between sets."""
        repeated = bitmaps.build(self._scan_prefixes(None, "gram long").groupBy("gram").count().where("count > 1"), "gram", self.bits)
        # dealt by n-gram once: copies that passed by chance, lists of one and the cleanest member are told there
        listed = Window.partitionBy("gram")
        postings = stored(self._scan_prefixes(repeated, "gram long, node long, n int, place int, light int").repartition("gram")
                          .withColumn("before", F.lag("node").over(listed.orderBy("node")))
                          .where("before IS NULL OR before != node").drop("before")
                          .withColumn("pivot", F.min(F.struct("light", "node", "n", "place")).over(listed))
                          .withColumn("members", F.count("*").over(listed)).where("members > 1"), "postings")
        star = (postings.where(F.col("node") != F.col("pivot.node"))
                .where(_may_link(self.percent, F.col("n"), F.col("place"), F.col("pivot.n"), F.col("pivot.place")))
                .select(F.col("pivot.node").alias("x"), F.col("pivot.n").alias("nx"), F.col("node").alias("y"), F.col("n").alias("ny")))
        prefixes = postings.groupBy("node").agg(F.collect_list("gram").alias("grams"))
        tested = stored(self._ordered(star), "pairs")
        found = stored(self.verify(stored(self.screened(tested, prefixes), "pairs")), "links")
        # a second star: the cleanest member outside the component of the first one's, met by all of other components
        # (every pair with the cleanest was met in the first star, so lists of two have nothing left)
        longer = postings.where("members > 2").select("gram", "node", "n", "place", "light")
        mixed = self._mixed(self._placed(longer, components(found)).repartition("gram"), "main").where("node != cleanest")
        mixed = stored(mixed.drop("cleanest").join(by_shuffle(self._sketches(postings)), "node"), "mixed")
        second = (mixed.where("root != main").groupBy("gram")
                  .agg(F.min(F.struct("light", "node", "n", "place", "root", "held", *SKETCH)).alias("o")))
        again = (mixed.alias("m").join(by_shuffle(second), "gram").where((F.col("m.root") != F.col("o.root"))
                 & _may_link(self.percent, F.col("m.n"), F.col("m.place"), F.col("o.n"), F.col("o.place"))
                 & _may_share(self.percent, "m", "o"))
                 .select(F.col("m.node").alias("x"), F.col("m.n").alias("nx"), F.col("o.node").alias("y"), F.col("o.n").alias("ny")))
        more = stored(self._ordered(again).join(by_shuffle(tested), ["a", "b"], "left_anti"), "pairs")
        found = self._with_links(found, more, prefixes)
        tested = stored(tested.unionByName(more), "tested")
        # then all pairs that are still apart; both cleanest members have met everyone
        met = second.select("gram", F.col("o.node").alias("met_too"))
        roots = components(found)
        apart = self._placed(mixed.drop("root"), roots).join(by_shuffle(met), "gram").where("node != met_too")
        rest = stored(self._mixed(apart.drop("main"), "own"), "mixed")
        m, o = rest.where("root != own").alias("m"), rest.alias("o")
        cross = (m.join(by_shuffle(o), (F.col("m.gram") == F.col("o.gram")) & (F.col("m.root") != F.col("o.root"))
                        & _may_link(self.percent, F.col("m.n"), F.col("m.place"), F.col("o.n"), F.col("o.place"))
                        & _may_share(self.percent, "m", "o"))
                 .select(F.col("m.node").alias("x"), F.col("m.n").alias("nx"), F.col("o.node").alias("y"), F.col("o.n").alias("ny")))
        return self._with_links(found, stored(self._ordered(cross).join(by_shuffle(tested), ["a", "b"], "left_anti"), "pairs"), prefixes)

    def _with_links(self, found: DataFrame, pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
        """``found`` and the links among further pairs."""
        pairs = stored(self.screened(pairs, prefixes), "pairs")
        if not pairs.head(1):
            return found
        return stored(found.unionByName(self.verify(pairs)), "links")

    @staticmethod
    def _placed(postings: DataFrame, roots: DataFrame) -> DataFrame:
        """Postings with the component of their set."""
        named = roots.select(F.col("node").alias("known"), F.col("root").alias("known_root"))
        return (postings.join(by_shuffle(named), F.col("node") == F.col("known"), "left")
                .withColumn("root", F.coalesce("known_root", "node")).drop("known", "known_root"))

    @staticmethod
    def _mixed(placed: DataFrame, main: str) -> DataFrame:
        """Rows in lists of several components, with the list's cleanest member and, as ``main``, its component."""
        listed = Window.partitionBy("gram")
        return (placed.withColumn("least", F.min(F.struct("light", "node", "root")).over(listed))
                .withColumn("low", F.min("root").over(listed)).withColumn("high", F.max("root").over(listed)).where("low != high")
                .withColumn(main, F.col("least.root")).withColumn("cleanest", F.col("least.node")).drop("least", "low", "high"))

    @staticmethod
    def _sketches(postings: DataFrame) -> DataFrame:
        """(node, held, s0..s3): number of a node's prefix n-grams and their bits in a sketch of 256."""
        bit = "CASE WHEN (gram & 192) = {} THEN shiftleft(1L, cast(gram & 63 AS int)) ELSE 0L END"
        return postings.groupBy("node").agg(F.count("*").alias("held"), *[
            F.expr(f"bit_or({bit.format(64 * i)})").alias(f"s{i}") for i in range(4)])

    @staticmethod
    def _ordered(pairs: DataFrame) -> DataFrame:
        """Distinct pairs with a < b and their set sizes."""
        turn = F.col("x") < F.col("y")
        return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
                            F.when(turn, F.col("nx")).otherwise(F.col("ny")).alias("na"),
                            F.when(turn, F.col("ny")).otherwise(F.col("nx")).alias("nb")).distinct()

    def screened(self, pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
        """Pairs whose prefixes share enough: the overlap is at most what they share and one remainder.

        Common n-grams up to the end of the prefix that ends first in the global order lie in
        both prefixes; behind it at most that set's n - prefix n-grams follow.
        """
        a = prefixes.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
        b = prefixes.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
        shared = F.size(F.array_intersect("grams_a", "grams_b"))
        behind = F.greatest(*[F.ceil(self.percent * F.col(n) / 100) - 1 for n in ("na", "nb")])
        return (pairs.join(by_shuffle(a), "a").join(by_shuffle(b), "b")
                .where((100 + self.percent) * (shared + behind) >= self.percent * (F.col("na") + F.col("nb")))
                .select("a", "b", "na", "nb"))

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, na, nb) that reach the similarity, by partial overlaps per fragment."""
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = self._rows_of(self.profiles.join(by_shuffle(nodes), "node"))
        parts = (self.texts.mapInArrow(_fragments(self.k, self.heavy, wanted, FRAGMENTS),
                                       "node long, fragment int, codes array<bigint>")
                 .groupBy("node", "fragment").agg(F.first("codes").alias("codes")))
        a = parts.select(F.col("node").alias("a"), "fragment", F.col("codes").alias("codes_a"))
        b = parts.select(F.col("node").alias("b"), "fragment", F.col("codes").alias("codes_b"))
        cut = pairs.withColumn("fragment", F.explode(F.array(*map(F.lit, range(FRAGMENTS)))))   # parts are dealt by both keys
        overlap = (cut.join(by_shuffle(a), ["a", "fragment"]).join(by_shuffle(b), ["b", "fragment"])
                   .select("a", "b", "na", "nb", F.size(F.array_intersect("codes_a", "codes_b")).alias("common"))
                   .groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common")))
        return overlap.where(100 * F.col("common") >= self.percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")

    def members(self) -> DataFrame:
        """(doc_id, n_shingles, node, root) per row: ``root`` names the component of sets (null: empty set)."""
        roots = components(self.links())
        p = self.profiles
        return (p.join(by_shuffle(roots), p["node"] == roots["node"], "left")
                .select("doc_id", "n_shingles", p["node"],
                        F.when(F.col("n_shingles") > 0, F.coalesce(roots["root"], p["node"])).alias("root")))


def similar_components(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the smallest doc_id reachable by links."""
    members = stored(Join(docs, ngram, percent).members(), "members")
    least = members.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    return (members.join(by_shuffle(least), "root", "left")
            .select("doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")))


def _dropped(k: int, gone: np.ndarray, unsure: np.ndarray, wanted: bool, columns: list[str], node_name: str):
    """Rows that surely stay, or those ``unsure`` holds with their set's signature; rows in ``gone`` alone are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds in blocks(batches):
            sets = _sets(rows, data, bounds, k)
            node = np.array([_signature(s) for s in sets], np.int64)
            code, filled = _member_code(rows.column("doc_id"), node), np.array([len(s) > 0 for s in sets], bool)
            asked = filled & bitmaps.holds(unsure, code)
            keep = pa.array(asked if wanted else ~filled | ~(asked | bitmaps.holds(gone, code)))
            out = [rows.column(c) for c in columns]
            names = list(columns)
            if wanted:
                out.append(pa.array(node))
                names.append(node_name)
            yield pa.RecordBatch.from_arrays(out, names).filter(keep)
    return run


def _passing(gone: np.ndarray):
    """(doc_id, node) rows in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            code = _member_code(rows.column("doc_id"), rows.column("node").to_numpy())
            yield rows.filter(pa.array(bitmaps.holds(gone, code)))
    return run


def keep_one(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component (that of its smallest doc_id); empty texts all stay.

    A bitmap of the (doc_id, set) rows to drop decides in the scan.  Texts are shuffled only of rows that
    it holds by chance and of repeated rows to keep, both found among the ids; a join decides on them.
    """
    members = stored(Join(docs, ngram, percent).members().where("root IS NOT NULL").select("doc_id", "node", "root"), "members")
    groups = (members.groupBy("root").agg(F.count("*").alias("rows"), F.min(F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")).alias("kept")).where("rows > 1"))
    groups = stored(groups, "groups")
    columns, node, owner, other = docs.columns, *free_names(["node", "owner", "other"], docs.columns)
    named = members.join(by_shuffle(groups.select("root")), "root").select(F.col("doc_id").alias(owner), F.col("node").alias(other)).distinct()
    kept = groups.select(F.col("kept.doc_id").alias("kept_doc"), F.col("kept.node").alias("kept_node"))
    drop = stored(named.join(by_shuffle(kept), F.col(owner).eqNullSafe(F.col("kept_doc")) & (F.col(other) == F.col("kept_node")), "left_anti"), "dropped")
    gone = bitmaps.build(drop.select(F.col(owner).alias("doc_id"), F.col(other).alias("node")).mapInArrow(_member_codes, "code long"), "code")
    counted = members.groupBy("doc_id", "node").count()
    asked = (counted.where("count > 1").select("doc_id", "node")
             .unionByName(members.select("doc_id", "node").mapInArrow(_passing(gone), "doc_id long, node long"))
             .join(by_shuffle(drop), F.col("doc_id").eqNullSafe(F.col(owner)) & (F.col("node") == F.col(other)), "left_anti"))
    unsure = bitmaps.build(asked.mapInArrow(_member_codes, "code long"), "code", UNSURE_BITS)
    alone = docs.mapInArrow(_dropped(ngram, gone, unsure, False, columns, node), docs.schema)
    schema = docs.select("*", F.lit(0).cast("long").alias(node)).schema
    several = docs.mapInArrow(_dropped(ngram, gone, unsure, True, columns, node), schema)
    stay = several.join(by_shuffle(drop), F.col("doc_id").eqNullSafe(F.col(owner)) & (F.col(node) == F.col(other)), "left_anti")
    return alone.unionByName(stay.dropDuplicates(["doc_id", node]).drop(node))


by_value(__name__)
