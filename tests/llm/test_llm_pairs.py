"""N-gram join, substring removal, decontamination and line rules against brute force."""

from __future__ import annotations

import hashlib
import random
import time

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowlens.llm import bitmaps, decontam, graph, linequality, ngramjoin, substrings, toxicity
from flowlens.llm.workspace import free_names, release, stored

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.corpus(), DOCS).repartition(3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("heavy", [32, 2])
def test_components_equal_brute_force(docs, monkeypatch, heavy):
    monkeypatch.setattr(ngramjoin, "HEAVY_DOCUMENTS", heavy)
    assert rows(ngramjoin.similar_components(docs)) == brute.components(brute.corpus())


def test_group_of_near_copies_keeps_every_link(spark):
    """A chain of near copies: the ends are linked only through the middle."""
    text = [f"t{i}" for i in range(100)]
    chain = []
    for i in range(14):
        text = text[3:] + [f"n{i}_{j}" for j in range(3)]
        chain.append((i, " ".join(text)))
    found = rows(ngramjoin.similar_components(spark.createDataFrame(chain, DOCS)))
    assert found == brute.components(chain)
    assert {r[2] for r in found} == {0}


def test_join_of_empty_and_repeated_rows(spark):
    assert ngramjoin.similar_components(spark.createDataFrame([], DOCS)).collect() == []
    again = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (5, ""), (3, "q")]
    assert rows(ngramjoin.similar_components(spark.createDataFrame(again, DOCS))) == [
        (1, 2, 1), (1, 2, 1), (3, 1, 3), (5, 0, 5), (None, 0, None), (None, 2, 1)]
    kept = ngramjoin.keep_one(spark.createDataFrame(again, DOCS))
    assert rows(kept) == [(1, "a b c d e f"), (3, "q"), (5, ""), (None, None)]


def test_keep_one_keeps_the_smallest_of_each_component_and_all_columns(docs):
    wide = docs.withColumn("node", F.lit("x")).withColumn("n", F.col("doc_id"))
    kept = ngramjoin.keep_one(wide)
    assert kept.columns == wide.columns
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, _, least in brute.components(brute.corpus()) if d == least]


def test_lists_of_one_and_copies_are_not_stored(spark, monkeypatch):
    """However full the bitmap of repeated n-grams is, a stored list has several sets, each once."""
    tables = {}
    monkeypatch.setattr(ngramjoin, "stored", lambda df, label: tables.setdefault(label, stored(df, label)) if label == "postings" else stored(df, label))
    rows_ = [(i, " ".join(f"w{i}_{j}" for j in range(30))) for i in range(20)]
    rows_ += [(30, rows_[3][1] + " end"), (31, rows_[3][1]), (32, rows_[3][1])]
    links = ngramjoin.Join(spark.createDataFrame(rows_, DOCS), bits=8).links()
    lists = tables["postings"].groupBy("gram").agg(F.count("*").alias("n"), F.countDistinct("node").alias("sets")).collect()
    assert lists and all(r.n == r.sets == 2 for r in lists)
    assert links.distinct().count() == 1


def test_repeated_rows_are_kept_once_and_wordless_ones_all(docs, monkeypatch):
    """With a bitmap so small that the join decides on every row, and with the usual one."""
    twice = docs.unionByName(docs)
    least = [d for d, n, first in brute.components(brute.corpus()) for _ in range(1 if n else 2) if d == first]
    for bits in (6, ngramjoin.UNSURE_BITS):
        monkeypatch.setattr(ngramjoin, "UNSURE_BITS", bits)
        assert sorted(r.doc_id for r in ngramjoin.keep_one(twice).collect()) == least


def test_a_row_to_drop_is_decided_in_the_scan():
    """Only rows in the second bitmap are handed to the join with their text."""
    batch = pa.record_batch({"doc_id": pa.array([1, 2, 3, 4]), "text": pa.array(["a b c d e", "f g h i j", "k l m n o", ""])})
    code = next(ngramjoin._dropped(5, np.zeros(1, np.uint64), np.full(1, -1, np.int64).view(np.uint64), True, ["doc_id"], "node")([batch]))
    codes = ngramjoin._member_code(code.column("doc_id"), code.column("node").to_numpy())
    assert code.column("doc_id").to_pylist() == [1, 2, 3]

    def bitmap(chosen):
        out = np.zeros(1 << 14, np.uint64)
        for place in np.concatenate(bitmaps._places(codes[chosen], 20)).tolist():
            out[place >> 6] |= np.uint64(1 << (place & 63))
        return out
    gone, unsure = bitmap([0, 1]), bitmap([1])
    stay, ask = (next(ngramjoin._dropped(5, gone, unsure, wanted, ["doc_id"], "node")([batch])).column("doc_id").to_pylist() for wanted in (False, True))
    assert (stay, ask) == ([3, 4], [2])


def test_shuffles_of_finished_queries_are_let_go(spark):
    kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    release(spark)
    time.sleep(1)
    before = kept.size()
    stored(spark.range(1000).repartition(5, "id"), "numbers")
    end = time.time() + 10
    while kept.size() > before and time.time() < end:
        time.sleep(0.1)
    assert kept.size() <= before


def test_removals_equal_brute_force(docs):
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute.removals(brute.corpus())]
    assert rows(substrings.removal_digest(docs)) == want
    assert sum(r[2] for r in want) > 500


def test_removed_text_keeps_other_columns(docs):
    wide = docs.withColumn("paths", F.lit(1)).withColumn("version", F.col("doc_id"))
    cut = substrings.remove_repeats(wide)
    assert cut.columns == wide.columns
    got = {r.doc_id: " ".join(brute.words(r.text)) for r in cut.collect()}
    assert got == {d: t for d, _, _, t in brute.removals(brute.corpus())}


def test_removals_of_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    odd = [(2, passage), (2, passage), (None, passage), (3, "x " + passage + " y"), (4, None), (5, "")]
    got = rows(substrings.removal_digest(spark.createDataFrame(odd, DOCS)))
    assert [r[:3] for r in got] == [(2, 25, 25), (2, 25, 25), (3, 27, 25), (4, 0, 0), (5, 0, 0), (None, 25, 0)]
    assert substrings.removal_digest(spark.createDataFrame([], DOCS)).collect() == []


def test_a_thousand_rows_without_id_equal_brute_force(spark):
    """Rows with a null id are versions of one document: windows count by (null, start), each row loses its own words."""
    rng = random.Random(12)
    passages = [" ".join(f"p{i}_{j}" for j in range(30)) for i in range(6)]
    texts = []
    for i in range(1000):
        body = [f"u{i}_{j}" for j in range(rng.randrange(0, 12))] + [rng.choice(passages)] * rng.randrange(0, 3) + [f"v{i}"]
        texts.append(" ".join(body))
    docs = [(None, t) for t in texts] + [(5, texts[3]), (6, passages[0] + " " + passages[1])]
    first = {}
    for d, t in docs:
        w = brute.words(t)
        for i in range(len(w) - 19):
            key = tuple(w[i:i + 20])
            first[key] = min(first.get(key, (99, 0)), (-1 if d is None else d, i))
    want = []
    for d, t in docs:
        w, gone = brute.words(t), set()
        for i in range(len(w) - 19):
            if first[tuple(w[i:i + 20])] != (-1 if d is None else d, i):
                gone.update(range(i, i + 20))
        want.append((d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    got = [tuple(r) for r in substrings.removal_digest(spark.createDataFrame(docs, DOCS).repartition(4)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(r[2] for r in want) > 5000


def test_stages_keep_columns_of_clashing_names(spark, docs):
    """Names that the operators use themselves, in any case, and empty tables."""
    names = ["_node_", "node", "owner", "other", "Toxic_Score", "toxic_score_", "paths", "sequence", "rest", "_span_doc_", "number", "hits", "row",
             "n_words", "hit_spans", "kept_doc", "root"]
    wide = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    bench = spark.createDataFrame([(1, "x y x y")], "item_id int, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    stages = [ngramjoin.keep_one, substrings.remove_repeats, lambda d: decontam.decontaminate(d, bench)]
    for stage in stages:
        got = stage(wide)
        assert got.columns == wide.columns
        rows_ = got.collect()
        assert rows_ and all(r[n] == f"{n}{r.doc_id}" for r in rows_ for n in names)
        assert stage(wide.limit(0)).collect() == []
    model = toxicity.train(wide, labels)
    (name,) = free_names(["toxic_score"], wide.columns)
    assert name == "toxic_score__" and toxicity.score(wide, model, name).columns == [*wide.columns, name]
    with pytest.raises(ValueError, match="toxic_score"):
        toxicity.score(wide, model)


def test_texts_of_the_same_words_in_another_order_are_no_copies(spark):
    """Equal words and equal sums of positions per word: the order alone tells such texts apart."""
    tail = " ".join(f"t{i}" for i in range(15))
    pairs = [(1, f"a b b a {tail} u0 u1 u2"), (2, f"b a a b {tail} u0 u1 u2"), (3, "\t" + f"b a a b  {tail}\nu0 u1 u2 ")]
    rng = random.Random(8)
    pairs += [(10 + i, " ".join(rng.choice("01") for _ in range(24))) for i in range(3000)]
    pairs += [(4000, pairs[5][1]), (4001, "0 1 " + pairs[5][1]), (4002, pairs[7][1].replace(" ", "  "))]
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute.removals(pairs)]
    got = rows(substrings.removal_digest(spark.createDataFrame(pairs, DOCS).repartition(3)))
    assert got == want
    assert [r[2] for r in want[:3]] == [0, 0, 22]


def test_decontamination_equals_brute_force_in_one_block_or_many(spark, docs):
    texts = [t for _, t in brute.corpus() if t]
    items = [(1, " ".join(brute.words(texts[20])[5:40])), (2, "One"), (3, None), (4, "two, WORDS"), (10, "x y x y"), (None, "É w5"),
             (1, " ".join(brute.words(texts[25])[:12]))]
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = sorted(brute.contamination(brute.corpus(), items))
    assert rows(decontam.hit_digest(docs, bench)) == want
    wide = docs.withColumn("number", F.col("doc_id") + 1).withColumn("hits", F.lit("x"))
    shipped, joined = (sorted(map(str, decontam.find_hits(wide, bench, max_windows=n).collect())) for n in (1 << 17, 7))
    assert shipped == joined and any("hit_spans=[Row" in r for r in shipped)
    twice = docs.unionByName(docs)
    assert len(decontam.find_hits(twice, bench, max_windows=7).collect()) == 2 * len(shipped)
    clean = decontam.decontaminate(docs.withColumn("item", F.lit(1)), bench)
    assert clean.columns == ["doc_id", "text", "item"]
    assert sorted(r.doc_id for r in clean.collect()) == [r[0] for r in want if not r[5]]
    nothing = decontam.hit_digest(docs, bench.where("false"))
    assert {r.contaminated for r in nothing.collect()} == {False}


def test_line_verdicts_equal_brute_force(spark):
    common = "Read our terms 2024 now and then " * 4
    docs = [(i, f"{common}\n" + " ".join(f"u{i}_{j}" for j in range(20 + 4 * i)) + (f"\n{common}" if i % 3 else ""), "hot")
            for i in range(24)]
    docs += [(100 + i, t, None if i % 2 else "s") for i, (_, t) in enumerate(brute.corpus())]
    docs += [(200, "a b c " * 30, "x"), (201, "###" + " q" * 60, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    assert rows(linequality.judge(df)) == brute.line_verdicts(docs)
    kept = linequality.clean(df.withColumn("n", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "source", "n"]
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in brute.line_verdicts(docs) if r[8]]
    assert all("terms" not in r.text for r in kept.where("source = 'hot'").collect())
    assert linequality.judge(df.where("false")).collect() == []


def test_no_table_that_grows_is_broadcast(spark, docs, monkeypatch):
    """However small the tables are, and whatever the session's threshold, no join gathers one in the driver."""
    plans = []
    monkeypatch.setattr(ngramjoin, "stored", lambda df, label: plans.append(df) or stored(df, label))
    monkeypatch.setattr(graph, "stored", lambda df, label: plans.append(df) or stored(df, label))
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    plans += [ngramjoin.similar_components(docs), ngramjoin.keep_one(docs)]
    joins = [df._jdf.queryExecution().executedPlan().toString() for df in plans]
    assert sum("SortMergeJoin" in p for p in joins) > 10
    assert not [p for p in joins if "Broadcast" in p]


def test_heavy_ngrams_are_the_most_frequent_rarest_first(monkeypatch):
    monkeypatch.setattr(ngramjoin, "MAX_HEAVY", 3)
    join = ngramjoin.Join.__new__(ngramjoin.Join)
    join._set_heavy(np.array([5, -7, 9, 2, 5, 9], np.int64), np.array([40, 33, 32, 90, 4, 41]))
    assert join.heavy.view(np.int64).tolist() == [5, 9, 2]
    join._set_heavy(np.array([], np.int64), np.array([], np.int64))
    assert join.heavy.tolist() == []
