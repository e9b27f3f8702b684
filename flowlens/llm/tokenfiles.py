"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

``write_tokens`` range-partitions the documents by ``doc_id`` (Spark samples the
bounds), sorts each partition and streams it into three files in a shared folder:

* ``*.ids``     little-endian unsigned token ids, no header, documents end to end
  (16-bit where the vocabulary fits, else 32-bit),
* ``*.offsets`` ``n + 1`` little-endian unsigned 64-bit starts within the file,
* ``*.docs``    the ``n`` signed 64-bit document ids (nulls: see the manifest).

A task that runs again writes files of its own; only those named in the manifest
of the successful attempts count.  The manifest has one row per partition; the
bases (ids before a partition) are prefix sums over it.  ``read_documents`` maps
the files back, one task per file.

Defined results: a null text is an empty document, that is only the end id; a
null ``doc_id`` sorts first; rows that share a ``doc_id`` follow each other in
text order; an empty table writes no file and reads back no row.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.llm.tokencount import LAST_COMMON, byte_alphabet
from flowlens.llm.workspace import by_value, new_path, process_cache, stored

CACHE_ENTRIES = 700_000
END_ID = 1
#: The tokenizer's own word rule, after lower-casing; white space separates and is dropped.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Python counts these as white space, the tokenizer does not.
ODD_SPACES = re.compile("[\x1c-\x1f]")

MANIFEST = "part int, n_docs long, n_tokens long, stem string, width int, first_id long, n_null long"


class Encoder:
    """Token ids of texts as bytes, with a bounded memory of words."""

    def __init__(self, tokenizer_path: str, kind: str):
        from tokenizers import Tokenizer

        with open(tokenizer_path, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f)["added_tokens"]]
        tokenizer = Tokenizer.from_file(tokenizer_path)
        self.whole, self.model, self.kind, self.added = tokenizer.encode, tokenizer.model.tokenize, kind, added
        self.alphabet = {b: chr(c) for b, c in byte_alphabet().items()}
        self.words: dict[str, bytes] = {}
        outer = self

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                if len(self) >= CACHE_ENTRIES:
                    self.clear()
                ids = outer.piece(piece)
                if len(piece) < 64:
                    self[piece] = ids
                return ids

        self.pieces = Pieces()

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= CACHE_ENTRIES:
                self.words.clear()
            ids = self.pack([t.id for t in self.model("".join(map(self.alphabet.__getitem__, word.encode("utf-8"))))])
            if len(word) < 64:
                self.words[word] = ids
        return ids

    def piece(self, piece: str) -> bytes:
        """Ids of a piece without white space."""
        if "<|" in piece and any(a in piece for a in self.added) or max(piece) > LAST_COMMON:
            return self.pack(self.whole(piece, add_special_tokens=False).ids)
        if piece.isascii():
            return b"".join(map(self.word, ASCII_WORDS.findall(piece.lower())))
        lower = "".join(map(str.lower, unicodedata.normalize("NFC", piece)))
        return b"".join(map(self.word, WORDS.findall(lower)))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if ODD_SPACES.search(text):
            return self.pack(self.whole(text, add_special_tokens=False).ids)
        return b"".join(map(self.pieces.__getitem__, text.split()))


def id_type(tokenizer_path: str) -> str:
    """Smallest unsigned numpy type that holds every id of the vocabulary."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def _writer(tokenizer_path: str, kind: str, folder: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = process_cache(f"encode {tokenizer_path} {kind}", lambda: Encoder(tokenizer_path, kind))
        end = encoder.pack([end_id])
        store, root = fs.FileSystem.from_uri(folder)
        stem = f"part-{part:06d}-{uuid.uuid4().hex[:8]}"
        out = offsets = docs = None
        total = n_docs = n_null = 0
        first_id = None
        for rows in batches:
            if not rows.num_rows:
                continue
            if out is None:
                store.create_dir(root)
                out, offsets, docs = (store.open_output_stream(f"{root}/{stem}.{x}") for x in ("ids", "offsets", "docs"))
                offsets.write(np.zeros(1, "<u8").tobytes())
            codes = [encoder.encode(t) + end for t in rows.column("text").to_pylist()]
            ends = total + np.cumsum([len(c) // len(end) for c in codes])
            out.write(b"".join(codes))
            offsets.write(ends.astype("<u8").tobytes())
            ids = rows.column("doc_id")
            n_null += ids.null_count
            values = ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8")
            docs.write(values.tobytes())
            first_id = values[0].item() if first_id is None else first_id
            total, n_docs = int(ends[-1]), n_docs + rows.num_rows
        if out is not None:
            for f in (out, offsets, docs):
                f.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "n_docs": n_docs, "n_tokens": total, "stem": f"{folder}/{stem}", "width": len(end),
                  "first_id": first_id, "n_null": n_null}],
                schema=pa.schema([("part", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                                  ("stem", pa.string()), ("width", pa.int32()), ("first_id", pa.int64()),
                                  ("n_null", pa.int64())]))
    return write


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write the token files of ``docs`` (doc_id, text) and return the manifest with bases.

    ``folder`` is a URI every executor can write (the shared store).  The manifest
    is itself written below it, so the files are made once.
    """
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    made = ordered.mapInArrow(_writer(tokenizer_path, id_type(tokenizer_path), folder, end_id), MANIFEST)
    manifest = stored(made, "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def _mapped(uri: str, kind: str) -> np.ndarray:
    """A file's values: memory-mapped where the store is a mounted folder, else read."""
    store, path = fs.FileSystem.from_uri(uri)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), kind)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for files in batches:
        for row in files.to_pylist():
            ids = _mapped(row["stem"] + ".ids", f"<u{row['width']}")
            offsets = _mapped(row["stem"] + ".offsets", "<u8").astype(np.int64)
            docs = _mapped(row["stem"] + ".docs", "<i8")
            step = 4096
            for lo in range(0, row["n_docs"], step):
                hi = min(lo + step, row["n_docs"])
                crc = [zlib.crc32(ids[offsets[i]:offsets[i + 1]].astype("<u4").tobytes()) for i in range(lo, hi)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(docs[lo:hi]), mask=np.arange(lo, hi) < row["n_null"]),
                     pa.array(row["base"] + offsets[lo:hi]), pa.array(np.diff(offsets[lo:hi + 1])),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files: one task a file."""
    files = manifest.select("stem", "width", "n_docs", "n_null", "base")
    files = files.repartition(max(1, files.count()))   # a given number is left alone by adaptive execution
    return files.mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_folder(spark: SparkSession) -> str:
    """A new folder URI in the session's shared folder."""
    path = new_path(spark, "tokens")
    return path if ":/" in path else f"file://{path}"


by_value(__name__)
