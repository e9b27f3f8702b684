"""Token counts with a whole-token shortcut.

Offline (driver, once per vocabulary) ``whole_tokens`` proves which vocabulary
strings encode alone as exactly one token: each is run through the tokenizer
itself.  In the tasks a text is cut into pre-tokens; those in the proven set
count one, and only the rest go through the merges.  Text pieces between single
spaces never share a pre-token, so a piece's count is kept and reused; the
memory of that is bounded by ``CACHE_ENTRIES`` (a full cache is emptied, which
only costs time).  No shuffle.

A piece with a character above ``LAST_COMMON`` goes to the library as a whole.

Defined results: null and empty texts have no tokens; special strings inside a
text are one token each, the library's default; every row is counted by itself, so
repeated rows, ties and null ids simply repeat their count; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from flowlens.llm.workspace import by_value, process_cache

CACHE_ENTRIES = 1_000_000
#: White space other than the plain space.
WHITE = "\t\n\x0b\x0c\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
#: Up to here Python's and the tokenizer's character classes are proven equal (tests); a piece
#: with a later character goes to the tokenizer itself.
LAST_COMMON = "\u024f"
#: A space with other text on both sides: no pre-token crosses it.
SPLIT = regex.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[int, int]:
    """Byte -> code point of the byte-level alphabet: printable bytes stay, the rest follow 255."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: b for b in keep}
    for b in range(256):
        table.setdefault(b, 256 + len(table) - len(keep))
    return table


def whole_tokens(tokenizer_path: str) -> frozenset[str]:
    """Vocabulary strings proven to encode alone as one token."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    back = {chr(c): b for b, c in byte_alphabet().items()}
    texts = []
    for piece in tokenizer.get_vocab(with_added_tokens=False):
        try:
            texts.append(bytes(back[c] for c in piece).decode("utf-8"))
        except (KeyError, UnicodeDecodeError):
            continue  # not a text of its own: always merged in place
    codes = tokenizer.encode_batch(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, codes, strict=True) if len(e.ids) == 1)


class Counter:
    """Token counts of texts, with a bounded memory of pieces and pre-tokens."""

    def __init__(self, tokenizer_path: str, pattern: str, whole: frozenset[str]):
        from tokenizers import Tokenizer

        with open(tokenizer_path, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f)["added_tokens"]]
        tokenizer = Tokenizer.from_file(tokenizer_path)
        self.merge, self.encode = tokenizer.model.tokenize, tokenizer.encode
        self.special = re.compile("|".join(map(re.escape, added))) if added else None
        self.added = added
        self.find = regex.compile(pattern).findall
        self.alphabet = {b: chr(c) for b, c in byte_alphabet().items()}
        self.whole = whole
        self.rest: dict[str, int] = {}
        outer = self

        class Pieces(dict):
            def __missing__(self, piece: str) -> int:
                if len(self) >= CACHE_ENTRIES:
                    self.clear()
                n = self[piece] = outer.count_piece(" " + piece)
                return n

        self.pieces = Pieces()

    def count_rest(self, token: str) -> int:
        """Tokens of a pre-token that is not proven whole, by the merges."""
        n = self.rest.get(token)
        if n is None:
            if len(self.rest) >= CACHE_ENTRIES:
                self.rest.clear()
            n = len(self.merge("".join(map(self.alphabet.__getitem__, token.encode("utf-8")))))
            if len(token) < 64:
                self.rest[token] = n
        return n

    def count_piece(self, text: str) -> int:
        if not text:
            return 0
        if max(text) > LAST_COMMON:
            return len(self.encode(text, add_special_tokens=False).ids)
        whole = self.whole
        return sum(1 if t in whole else self.count_rest(t) for t in self.find(text))

    def count_plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        pieces = text.split(" ")
        if "" in pieces or any(c + " " in text or " " + c in text for c in WHITE if c in text):
            pieces = SPLIT.split(text)
        known = self.pieces
        total = self.count_piece(pieces[0])
        for piece in pieces[1:]:
            total += known[piece] if len(piece) < 64 else self.count_piece(" " + piece)
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is not None and any(a in text for a in self.added):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(self.count_plain(p) for p in parts if p)
        return self.count_plain(text)


def _counter(tokenizer_path: str, pattern: str, whole: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = process_cache(f"count {tokenizer_path} {pattern}", lambda: Counter(tokenizer_path, pattern, whole))
        for rows in batches:
            texts = rows.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([len(t.encode("utf-8")) if t else 0 for t in texts], pa.int64()),
                 pa.array(list(map(counter.count, texts)), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row; ``pattern`` is the tokenizer's pre-token rule.

    ``tokenizer_path`` must be readable on the executors (vocabulary files are
    installed with the library there).
    """
    return docs.select("doc_id", "text").mapInArrow(
        _counter(tokenizer_path, pattern, whole_tokens(tokenizer_path)), "doc_id long, n_bytes long, n_tokens long")


by_value(__name__)
