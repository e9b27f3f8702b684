"""License scan: exact phrases and fuzzy search for short notices.

Texts are compared in a normal form: A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
joined by one space.  Two kinds of finds:

* *phrase*: the words of a phrase stand consecutively (every place counts).
* *notice*: some part of the normal form is within ``errors(notice)`` character edits
  (insert, delete, replace) of a notice's normal form.

Fuzzy search by pigeonhole: a notice that may have ``k`` edits is cut into ``k + 1`` pieces, of
which at least one stands unchanged in any match.  One Aho-Corasick pass finds all pieces of all
notices (seeds); a seed fixes where its notice would begin, up to ``k``.  Only that small window is
given to the ``regex`` library, whose bounded-error match (best one) verifies the edits and
gives the span.  Candidates that end before the last match of their notice does are skipped, so a
text full of notices costs time in proportion to its length; equal windows are remembered.

Narrow: no shuffle, one pass over the text, whole texts, memory in proportion to the longest text.
Defined results: null and empty texts have no word and no find; rows are independent, so
repeated rows, ties and null ids give one row each; an empty table gives an empty result; other
columns stay, also one named ``finds``, which the result's column avoids by a trailing underscore.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.workspace import by_value, latest_in_process

#: Exact phrases (fixed values of the contract).
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Short notices of public licenses and their labels.
NOTICES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge", "mit"),
    ("licensed under the apache license", "apache"),
    ("under the terms of the gnu general public license", "gpl"),
    ("licensed under the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("permission to use copy modify and or distribute", "isc"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("boost software license", "boost"),
    ("creative commons attribution", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("dedicated to the public domain", "public-domain"),
    ("released into the public domain", "public-domain"),
    ("all rights reserved", "reserved"),
]
CHARACTERS_PER_EDIT = 16
MOST_EDITS = 3
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
FINDS = "array<struct<kind string, label string, first_word long, n_words long, edits int, similarity double>>"


def normal(text: str | None) -> str:
    """Lower-cased words joined by one space."""
    data = (text or "").encode().translate(WORD_BYTES)
    while b"  " in data:
        data = data.replace(b"  ", b" ")
    return data.strip(b" ").decode()


def errors(notice: str) -> int:
    """Edits allowed in a notice: one per 16 characters, one to three."""
    return min(MOST_EDITS, max(1, len(notice) // CHARACTERS_PER_EDIT))


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """The notice cut into ``k + 1`` pieces of nearly equal length, with their offsets."""
    cuts = [len(notice) * i // (k + 1) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    """Seeds, verifiers and remembered windows of a list of phrases and notices."""

    def __init__(self, phrases: list[tuple[str, str]], notices: list[tuple[str, str]]):
        self.phrases = [(f" {normal(p)} ", label) for p, label in phrases]
        self.notices = [(normal(n), label, errors(normal(n))) for n, label in notices]
        self.verify = [regex.compile(f"(?:{regex.escape(n)}){{e<={k}}}", regex.BESTMATCH) for n, _, k in self.notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _, k) in enumerate(self.notices):
            for offset, piece in pieces(notice, k):
                seeds.setdefault(piece, []).append((i, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, where in seeds.items():
            self.seeds.add_word(piece, [(i, len(piece) - 1 + offset) for i, offset in where])
        if seeds:
            self.seeds.make_automaton()
        self.known: dict[tuple[int, str], tuple[int, int, int] | None] = {}

    def match(self, i: int, window: str) -> tuple[int, int, int] | None:
        """Start, end and edits of the best match of notice ``i`` in a window."""
        key = (i, window)
        if key not in self.known:
            if len(self.known) >= 1 << 14:
                self.known.clear()
            found = self.verify[i].search(window)
            self.known[key] = (found.start(), found.end(), sum(found.fuzzy_counts)) if found else None
        return self.known[key]

    def places(self, text: str) -> list[tuple[int, int, str, str, int, int]]:
        """(start, end, kind, label, edits, notice length) of all finds, positions in the normal form."""
        out = []
        padded = f" {text} "
        for phrase, label in self.phrases:
            at = padded.find(phrase)
            while at >= 0:
                out.append((at, at + len(phrase) - 2, "phrase", label, 0, len(phrase) - 2))
                at = padded.find(phrase, at + 1)
        if not self.notices:
            return out
        candidates: dict[int, set[int]] = {}
        for last, where in self.seeds.iter(text):
            for i, back in where:
                candidates.setdefault(i, set()).add(last - back)   # the seed's last character less its place in the notice
        for i, begins in candidates.items():
            notice, label, k = self.notices[i]
            done = 0
            for begin in sorted(begins):
                lo, hi = max(done, begin - k, 0), begin + len(notice) + 2 * k
                if hi - lo < len(notice) - k:
                    continue
                found = self.match(i, text[lo:hi])
                if found:
                    done = lo + found[1]
                    out.append((lo + found[0], done, "notice", label, found[2], len(notice)))
        return out

    def scan(self, text: str | None) -> tuple[int, list[dict]]:
        """Number of words and finds, in text order."""
        form = normal(text)
        words, at, out = 0, 0, []
        for start, end, kind, label, edits, size in sorted(self.places(form)):
            start += len(form[start:end]) - len(form[start:end].lstrip(" "))
            words += form.count(" ", at, start)
            at = start
            out.append({"kind": kind, "label": label, "first_word": words, "n_words": form[start:end].strip(" ").count(" ") + 1,
                        "edits": edits, "similarity": 1 - edits / size})
        return (form.count(" ") + 1 if form else 0), out


def _scanned(names: list[str], text: str, phrases: list, notices: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = latest_in_process("licenses", (tuple(phrases), tuple(notices)), lambda: Scanner(phrases, notices))
        kind = pa.list_(pa.struct([("kind", pa.string()), ("label", pa.string()), ("first_word", pa.int64()),
                                   ("n_words", pa.int64()), ("edits", pa.int32()), ("similarity", pa.float64())]))
        for rows in batches:
            found = [scanner.scan(value.as_py()) for value in rows.column(rows.schema.get_field_index(text))]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.array([n for n, _ in found], np.int64)),
                                              pa.array([f for _, f in found], kind)], names)
    return run


def scan(docs: DataFrame, phrases: list = PHRASES, notices: list = NOTICES) -> DataFrame:
    """``docs`` with the number of words and the list of finds; see the module for clashing names."""
    words, finds = "scanned_words", "finds"
    while words in docs.columns:
        words += "_"
    while finds in docs.columns:
        finds += "_"
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{words} long", f"{finds} {FINDS}"]
    return docs.mapInArrow(_scanned([*docs.columns, words, finds], "text", list(phrases), list(notices)), ", ".join(fields))


def _labels(finds: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(finds, lambda f: f["label"]))), ",")


def license_digest(docs: DataFrame) -> DataFrame:
    """Per row: number and bounds of the phrases, labels by phrases and by all finds, best similarity."""
    found = scan(docs.select("doc_id", "text")).withColumn("base", F.filter("finds", lambda f: f["kind"] == "phrase"))
    starts = F.transform("base", lambda f: f["first_word"])
    return found.select("doc_id", F.col("scanned_words").alias("n_words"), F.size("base").cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        _labels(F.col("base")).alias("base_labels"), _labels(F.col("finds")).alias("labels"),
                        F.coalesce(F.array_max(F.transform("finds", lambda f: f["similarity"])), F.lit(0.0)).alias("score"),
                        F.filter("finds", lambda f: f["kind"] == "notice").alias("notices"))


by_value(__name__)
