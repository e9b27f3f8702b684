"""Token operators against the tokenizer libraries."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql.functions import spark_partition_id
from tokenizers import Tokenizer

from flowlens.llm import piecebpe, tokencount, tokenfiles
from flowlens.llm.workspace import new_path

DOCS = "doc_id long, text string"
PARTS = [" ", "  ", "     ", "\n", "\t", " \n", "a", "The", " the", "'s", "'LL", "1", "23", "é", "ß", "漢", "　", "\x1c", "\x85", ".",
         "!!", "<|endoftext|>", "<|endoftext", "<s>", "<0x0A>", "😀", "́", "Σ", "²", "​", "\xa0", "▁", "in", "er", "tion", "----",
         "\x00", "aaaa"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 16))) for _ in range(3000)]
    return [None, "", " ", *made, *[" " * k for k in range(40)], *["a" * k for k in range(60)], "word " * 5000, "ab" * 4000]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)


def test_counts_equal_the_library(docs, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = {r.doc_id: r for r in tokencount.token_counts(docs, path, public_tokenizers.PATTERN).collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == want
    assert [got[i].n_bytes for i in range(len(texts))] == [len((t or "").encode()) for t in texts]


def test_counts_of_odd_tables(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (2, None)], DOCS)
    got = [(r.doc_id, r.n_bytes, r.n_tokens) for r in tokencount.token_counts(twice, path, public_tokenizers.PATTERN).collect()]
    assert sorted(got, key=str) == [(1, 3, 2), (1, 3, 2), (2, 0, 0), (None, 3, 2)]
    assert tokencount.token_counts(twice.where("false"), path, public_tokenizers.PATTERN).collect() == []


def test_proven_tokens_encode_alone():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, library = tokencount.whole_tokens(path), Tokenizer.from_file(path)
    assert len(whole) > 40_000
    assert all(len(library.encode(t, add_special_tokens=False).ids) == 1 for t in random.Random(1).sample(sorted(whole), 2000))


def test_character_classes_agree_up_to_the_last_common_one():
    path = public_tokenizers.path("byte_bpe_50k.json")
    counter, library = tokencount.Counter(path, public_tokenizers.PATTERN, tokencount.whole_tokens(path)), Tokenizer.from_file(path)
    points = [*range(ord(tokencount.LAST_COMMON) + 1), *random.Random(2).sample(range(0xE000, 0x30000), 500), 0x2028, 0x3000, 0x180E]
    odd = [f"a{chr(c)}1{chr(c)}! {chr(c)}{chr(c)} b {chr(c)} {chr(c)}c" for c in points]
    assert [counter.count(t) for t in odd] == [len(library.encode(t, add_special_tokens=False).ids) for t in odd]
    files, words = tokenfiles.Encoder(public_tokenizers.path("word_bpe_49k.json"), "<u2"), Tokenizer.from_file(
        public_tokenizers.path("word_bpe_49k.json"))
    assert [np.frombuffer(files.encode(t), "<u2").tolist() for t in odd] == [
        words.encode(t, add_special_tokens=False).ids for t in odd]


def test_token_files_round_trip(spark, docs, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    manifest = tokenfiles.write_tokens(docs, path, tokenfiles.token_file_folder(spark))
    got = sorted(map(tuple, tokenfiles.read_documents(manifest).collect()))
    start, want = 0, []
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    total = sum(r.n_tokens for r in manifest.collect())
    assert total == start


def test_one_task_reads_one_file(spark, docs):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    manifest = tokenfiles.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), tokenfiles.token_file_folder(spark))
    spark.conf.unset(key)
    assert manifest.count() > 1
    assert tokenfiles.read_documents(manifest).groupBy(spark_partition_id()).count().count() == manifest.count()


def test_token_files_of_odd_rows(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    empty = tokenfiles.write_tokens(spark.createDataFrame([], DOCS), path, tokenfiles.token_file_folder(spark))
    assert tokenfiles.read_documents(empty).collect() == []
    odd = spark.createDataFrame([(7, "a b"), (None, "c"), (7, "a"), (-1, None)], DOCS)
    got = tokenfiles.read_documents(tokenfiles.write_tokens(odd, path, tokenfiles.token_file_folder(spark))).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(None, 0, 2), (-1, 2, 1), (7, 3, 2), (7, 5, 3)]


def test_pieces_equal_the_library(spark, docs, texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r for r in piecebpe.round_trip_digest(docs, path).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, text in enumerate(texts):
        ids = library.encode(text or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))), repr(text)[:80]
    encoded = piecebpe.encode(docs.where("doc_id < 200"), path)
    decoded = {r.doc_id: r.text for r in piecebpe.decode(encoded, path).collect()}
    assert all(decoded[i] == library.decode(library.encode(texts[i] or "")) for i in range(200))
    assert piecebpe.round_trip_digest(docs.where("false"), path).collect() == []


def test_long_words_equal_the_library_in_linear_time():
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, codec, rng = sentencepiece.SentencePieceProcessor(model_file=path), piecebpe.Codec(path), random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    makers = [lambda n: "".join(rng.choice(letters) for _ in range(n)), lambda n: "".join(rng.choice("ACGT") for _ in range(n)),
              lambda n: "a" * n, lambda n: "".join(rng.choice(["the", "ing", "é", "漢", "😀", "er"]) for _ in range(n)),
              lambda n: "▁" * 3 + "-" * n + "=" * 50]
    for make in makers:
        for n in (1024, 1500, 4000):
            word = make(n)
            assert codec.encode([f"x {word} y"])[0].tolist() == library.encode(f"x {word} y")
    began = time.process_time()
    word = makers[0](200_000)
    assert codec.encode([word])[0].tolist() == library.encode(word) and time.process_time() - began < 30


def test_forgotten_words_equal_the_library(monkeypatch):
    """Words leave the bounded memory in two steps; new ones are merged a few at a time."""
    monkeypatch.setattr(piecebpe, "CACHE_ENTRIES", 40)
    monkeypatch.setattr(piecebpe, "CHARS_AT_ONCE", 50)
    seen, merge = [], piecebpe.encode_words
    monkeypatch.setattr(piecebpe, "encode_words", lambda vocab, words: seen.append(words) or merge(vocab, words))
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, codec, rng = sentencepiece.SentencePieceProcessor(model_file=path), piecebpe.Codec(path), random.Random(8)
    for _ in range(60):
        batch = [" ".join(["the", "z" * 60, *["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(10)]]) for _ in range(3)]
        assert [x.tolist() for x in codec.encode(batch)] == library.encode(batch)
        assert len(codec.known) + len(codec.older) <= 2 * (40 + 36)
    assert all(len(words) == 1 or sum(map(len, words)) <= 50 for words in seen)
    assert sum("▁the" in words for words in seen) == 1   # met all the time: never forgotten


def test_decoding_any_ids_equals_the_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    library, codec, rng = sentencepiece.SentencePieceProcessor(model_file=path), piecebpe.Codec(path), random.Random(5)
    for _ in range(3000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(260) for _ in range(rng.randrange(9))]
        assert codec.decode(np.array(ids, np.int64)) == library.decode(ids), ids


def test_new_path_is_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert new_path(spark, "x").startswith(root.rstrip("/") if root else "file:")
