"""Runs, license notices and hard negatives against plain versions of their rules."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_brute import ALNUM_WORD, words

from flowlens.llm import licenses, negatives, queries, queries_sql, runs

DOCS = "doc_id long, text string"


# ---------------------------------------------------------------- runs
def plain_runs(w, min_length=24):
    """(start, end, period) by comparing words at every distance."""
    out = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            end = j + q
            if j > i and end - i >= max(min_length, 3 * q) and not any(
                    all(w[x] == w[x + p] for x in range(i, end - p)) for p in range(1, q)):
                out.append((i, end, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = plain_runs(w)
    gone = {i for b, e, q in found for i in range(b + q, e)}
    best = max(found, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]), default=None)
    listed = "".join(f"{b},{e - b},{q}\n" for b, e, q in found)
    return (doc_id, len(found), *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4),
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def random_texts(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = []
        for _ in range(rng.randrange(5)):
            unit = [f"w{rng.randrange(rng.choice([1, 2, 3, 50]))}" for _ in range(rng.choice([1, 1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 30, 33]))]
            w += [f"w{rng.randrange(3)}" for _ in range(rng.randrange(40))] if rng.random() < 0.3 else (unit * 12)[:rng.randrange(5, 150)]
        out.append(rng.choice([" ", "\n", "  "]).join(w))
    return out


def test_transform_is_inverted_exactly():
    rng = np.random.default_rng(1)
    for n in (16, 256, 512, 4096):
        x = rng.integers(0, 50, (3, n)).astype(float)
        assert (np.mod(runs.transform(runs.transform(x), -1) * pow(n, -1, runs.P), runs.P) == x).all()


def test_zero_mismatches_are_all_occurrences():
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.integers(0, 3, 400), np.zeros(64)]).astype(float)
    for block in (4, 8, 16):
        for step in (0, 1, 2):
            wanted = np.arange(0, 400 // block - 4)
            got = set(zip(*map(np.ndarray.tolist, runs.zero_mismatches(values, block, wanted, step)), strict=True))
            want = {(j * block, q) for j in wanted.tolist() for q in range(step * block, (step + 1) * block)
                    if (values[j * block:(j + 1) * block] == values[j * block + q:(j + 1) * block + q]).all()}
            assert got == want


@pytest.mark.parametrize("largest", [8, 32, runs.LARGEST])
def test_runs_equal_brute_force(monkeypatch, largest):
    """Also where long periods are searched with the largest block over several windows."""
    monkeypatch.setattr(runs, "LARGEST", largest)
    for seed in range(12):
        texts = [words(t) for t in random_texts(seed, 9)]
        ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        got = runs.find_runs(np.array([ids[w] for t in texts for w in t], np.int64), first)
        want = [(b + first[d], e + first[d], q) for d, t in enumerate(texts) for b, e, q in plain_runs(t)]
        assert list(zip(*map(np.ndarray.tolist, got), strict=True)) == want


ODD_TEXTS = [None, "", " \t\n", "one", "a " * 23, "a " * 24, "a b " * 12 + "a", "a b c " * 100, "x" * 5000, "é ß " * 30, "a " * 60 + "b " * 60]


def test_query_of_runs_equals_brute_force(spark, tmp_path):
    texts = [*ODD_TEXTS, *random_texts(99, 150), "a b c " * 100]
    rows = [*enumerate(texts), (None, "a " * 30), (None, "a " * 30), (7, "q r " * 20)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    order = lambda x: (x[0] is None, x)
    got = sorted((tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()), key=lambda x: str(order(x)))
    assert got == sorted((plain_digest(*r) for r in rows), key=lambda x: str(order(x)))
    assert any(r[1] for r in got) and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts)))


def test_collapse_cuts_runs_and_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "x  y " + "a b " * 20 + "z", 5), (2, "plain  text", 6), (3, None, 7)], "doc_id long, text string, length int")
    got = {r.doc_id: (r.text, r.length) for r in runs.collapse(docs).collect()}
    assert got == {1: ("x y a b z", 5), 2: ("plain  text", 6), 3: (None, 7)}
    spans = [tuple(r) for r in runs.run_spans(docs).collect()]
    assert spans == [(1, 2, 40, 2)]
    empty = docs.limit(0)
    assert runs.collapse(empty).collect() == runs.run_spans(empty).collect() == runs.run_digest(empty).collect() == []


def test_long_and_repetitive_texts_take_linear_time():
    """Two texts that have a match at every distance, and one long period."""
    rng = np.random.default_rng(3)
    n = 400_000
    first = np.array([0, n])
    assert [x.tolist() for x in runs.find_runs(np.zeros(n, np.int64), first)] == [[0], [n], [1]]
    lengths = rng.integers(1, 60, n)
    assert len(runs.find_runs(np.repeat(np.arange(n) % 2, lengths)[:n].astype(np.int64), first)[0]) > 1000
    unit = rng.integers(0, 5000, n // 4)
    assert [x.tolist() for x in runs.find_runs(np.tile(unit, 4).astype(np.int64), first)] == [[0], [n], [n // 4]]


# ------------------------------------------------------------- licenses
def least_edits(notice, text):
    """Least edits between the notice and any part of the text (dynamic programming over the whole text)."""
    above = [0] * (len(text) + 1)
    for i, c in enumerate(notice, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(above[j - 1] + (c != d), above[j] + 1, row[-1] + 1))
        above = row
    return min(above)


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        i = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[i] = rng.choice("abcdefgh ")
        elif kind == 1:
            del chars[i]
        else:
            chars.insert(i, rng.choice("abcdefgh "))
    return "".join(chars)


def plain_licenses(doc_id, text):
    w = words(text, True, ALNUM_WORD)
    form = " ".join(w)
    places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(w))
              if w[i:i + len(phrase.split())] == phrase.split()]
    edits = {(n, label): least_edits(n, form) for n, label in licenses.NOTICES}
    labels = {label for _, label in places} | {label for (n, label), e in edits.items() if e <= licenses.errors(n)}
    score = max([1.0] * bool(places) + [1 - e / len(n) for (n, _), e in edits.items() if e <= licenses.errors(n)], default=0.0)
    starts = [i for i, _ in places]
    return (doc_id, len(w), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})), ",".join(sorted(labels)), round(score, 9))


def license_texts():
    rng = random.Random(4)
    out = [None, "", "!!", "MIT License", "mit licenses", "the MIT-License, the Apache\nLicense; GNU general public license MIT license",
           "mit license mit license mit license", "ALL RIGHTS RESERVED", "x" * 3000, "İ MIT license é"]
    for notice, _ in licenses.NOTICES:
        k = licenses.errors(notice)
        out.append(notice.title())
        for _ in range(4):
            n = rng.randrange(0, k + 3)
            filler = [" ".join("".join(rng.choice("aeiou licensd") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(12))) for _ in range(2)]
            out.append(f"{filler[0]} {edited(rng, notice, n)} {filler[1]}")
    out.append(" ".join(edited(rng, n, 1) for n, _ in licenses.NOTICES for _ in range(3)))
    return out


def test_query_of_licenses_equals_brute_force(spark, tmp_path):
    rows = [*enumerate(license_texts()), (3, "MIT License"), (3, "MIT License"), (None, "apache license")]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels"]
    got = [(*(r[c] for c in names), round(r.score, 9)) for r in queries.op12_license_notices(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain_licenses(*r) for r in rows), key=str)


def test_spans_are_verified_and_every_match_is_reported():
    scanner = licenses.Scanner(licenses.PHRASES, licenses.NOTICES)
    rng = random.Random(8)
    for _ in range(60):
        notice, label = rng.choice(licenses.NOTICES)
        k = licenses.errors(notice)
        parts = [edited(rng, notice, rng.randrange(k + 1)) for _ in range(3)]
        form = licenses.normal(" zq yx wv ".join(parts))
        n_words, finds = scanner.scan(form)
        own = [f for f in finds if f["kind"] == "notice" and f["label"] == label and f["similarity"] >= 1 - k / len(notice)]
        assert n_words == len(form.split(" ")) and len(own) >= 3
        for f in own:
            piece = " ".join(form.split(" ")[f["first_word"]:f["first_word"] + f["n_words"]])
            assert min(least_edits(n, piece) for n, x in licenses.NOTICES if x == label) <= f["edits"] <= licenses.MOST_EDITS


def test_a_text_full_of_notices_takes_linear_time(spark):
    rng = random.Random(5)
    text = " ".join(edited(rng, "released under the mit license", 1) for _ in range(20_000))
    n_words, finds = licenses.Scanner(licenses.PHRASES, licenses.NOTICES).scan(text)
    assert len([f for f in finds if f["kind"] == "notice" and f["label"] == "mit"]) >= 19_000


def test_scan_keeps_columns_of_clashing_names(spark):
    docs = spark.createDataFrame([(1, "mit license", 5, "x")], "doc_id long, text string, finds int, `scanned_words` string")
    row = licenses.scan(docs).head()
    assert row.finds == 5 and row.scanned_words == "x" and row.scanned_words_ == 2 and row.finds_[0].label == "mit"
    assert licenses.scan(docs.limit(0)).collect() == [] and licenses.license_digest(docs.limit(0)).collect() == []


# ------------------------------------------------------------ negatives
VECTORS = "vec_id long, embedding array<float>, label int"


def plain_negatives(rows):
    fit = {(v, (label + 1) % 10 if v % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in e))
           for v, e, label in rows if v is not None and label is not None and e is not None
           and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for anchor in fit:
        if anchor[0] % 100:
            continue
        scores = sorted((-sum(a * b for a, b in zip(anchor[2], r[2], strict=False)), r[0], r) for r in fit if r != anchor)
        for score, positive, _ in [s for s in scores if s[2][1] == anchor[1]][:5]:
            chosen = [s for s in scores if s[2][1] != anchor[1] and 30 * -score <= 100 * -s[0] <= 90 * -score][:10]
            out += [(anchor[0], positive, i, s[1], -score, -s[0]) for i, s in enumerate(chosen, 1)]
    return sorted(out)


def vector_rows(seed, n, dim):
    """Clustered vectors of several lengths, with repeated rows, copies of one vector, ties and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        x = centres[rng.integers(6)] * rng.choice([0.2, 1, 3]) + rng.normal(size=dim) * 0.4
        rows.append((i, [float(v) for v in x.astype(np.float32)], int(rng.integers(4))))
    hot = rows[3][1]
    rows += [(n + i, hot, int(rng.integers(4))) for i in range(n // 4)]
    rows += [(100, rows[5][1], 2), (100, rows[100][1], rows[100][2]), rows[100], rows[7], (None, hot, 1), (n * 3, None, 1), (n * 3 + 1, hot, None),
             (n * 3 + 2, [None] * dim, 1), (n * 3 + 3, [float("nan")] * dim, 1), (n * 3 + 4, [float("inf")] * dim, 1), (n * 3 + 5, [], 1),
             (n * 100, [0.0] * dim, 3), (n * 100 + 100, [-x for x in hot], 1), (n * 3 + 6, hot[:3], 1)]
    return rows


@pytest.mark.parametrize("sizes", [(2048, 2048, 512), (40, 3, 10)])
def test_negatives_equal_brute_force(spark, tmp_path, monkeypatch, sizes):
    for name, size in zip(("GROUP_ROWS", "BLOCK_ANCHORS", "BUCKET_ROWS"), sizes, strict=True):
        monkeypatch.setattr(negatives, name, size)
    rows = vector_rows(1, 320, 12)
    spark.createDataFrame(rows, VECTORS).withColumn("anchor", negatives.F.lit(1)).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r) for r in queries.op13_hard_negatives(spark, str(tmp_path)).collect())
    assert got == plain_negatives(rows) and len(got) > 50


def test_negatives_without_rows(spark, tmp_path):
    spark.createDataFrame([], VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.op13_hard_negatives(spark, str(tmp_path)).collect() == []


def test_scores_that_fit_no_long_raise(spark):
    far = spark.createDataFrame([(0, [1e9], 1), (1, [1.0], 1)], VECTORS)
    with pytest.raises(Exception, match="65,536"):
        negatives.whole_rows(far).collect()


def test_coordinate_ranges_lose_no_row():
    rng = np.random.default_rng(6)
    vectors = np.floor(256 * (rng.normal(size=(500, 16)) + rng.normal(size=16) * 2))
    size = np.sqrt((vectors ** 2).sum(axis=1))
    bucket = negatives.Bucket(vectors, size, np.arange(500), np.zeros(500, np.int64))
    pruned = 0
    for point in vectors[:40]:
        unit = point / np.linalg.norm(point)
        cosine = bucket.unit @ unit
        for bound in (0.1, 0.5, 0.9, 0.97, 0.999):
            found = bucket.candidates(unit, np.argsort(-np.abs(unit))[:negatives.FOCUS], bound)
            chosen = np.arange(500)[found]
            assert set(np.flatnonzero(cosine >= bound)) <= set(chosen.tolist())
            pruned += len(chosen) < 250
    assert pruned > 30


def test_sql_of_negatives_equals_brute_force():
    rows = [r for r in vector_rows(2, 220, 6) if r[0] is not None and (r[1] is None or len(r[1]) == 6) and r[0] != 100]
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                                         "label": pa.array([r[2] for r in rows], pa.int32())}))
    got = con.execute(queries_sql.OP13)
    names = [c[0] for c in got.description]
    order = [names.index(c) for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]
    assert sorted(tuple(r[i] for i in order) for r in got.fetchall()) == plain_negatives(rows)
