"""Quality rules: cross-document line frequency per host, beside the base counts of a text.

A line is normalised (A-Z lower-cased, digit runs to 0, white space to one space, trimmed)
and hashed.  Per host, the distinct documents that hold it are counted; copies of a text
are one document, so a group of exact copies does not make its own lines frequent.  Lines
in at least ``MIN_DOCUMENTS`` documents and more than ``MAX_SHARE`` percent of the host's
are removed.  A document is depleted, and rejected, if fewer than ``MIN_WORDS`` words or
less than ``MIN_KEPT`` percent of its words are left.

Everything is DataFrame expressions.  The counts are partial aggregations, so a hot host or
line is merged before the shuffle.  A host has at most 100 / ``MAX_SHARE`` times its mean
number of lines per document of frequent lines (their counts cannot add up to more), which
bounds the array that is joined to its documents; AQE splits a hot host's join.

Defined results: null and empty texts have no words and fail the base rules; a null host is
a host of its own, the empty name; rows that share a ``doc_id`` are judged alone; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_DOCUMENTS = 10
MAX_SHARE = 1        # percent of a host's distinct documents
MIN_WORDS = 50
MIN_KEPT = 50        # percent of the words
SPACE = "[\\x20\\x09-\\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also inside further lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words covered by a three-word window that is found twice or more in the text."""
    def covered(windows: Column) -> Column:
        def marked(pairs: Column) -> Column:
            """Positions of the repeated windows: equal neighbours in hash order."""
            last = F.size(pairs) - 1
            at = F.transform(pairs, lambda p, i: F.when(
                ((i > 0) & (F.get(pairs, i - 1)["h"] == p["h"])) | ((i < last) & (F.get(pairs, i + 1)["h"] == p["h"])), p["i"]))
            return F.sort_array(F.filter(at, lambda p: p.isNotNull()))

        def width(at: Column) -> Column:
            """Length of the union of [p, p + 3)."""
            parts = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
            return F.aggregate(parts, F.lit(0), lambda total, n: total + n)

        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(pairs, lambda p: let(marked(p), width)))

    def windows(codes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(codes) - 3),
                           lambda i: F.xxhash64(F.get(codes, i), F.get(codes, i + 1), F.get(codes, i + 2)))

    codes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(codes, lambda c: let(windows(c), covered)))


def base_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines) per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    full = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    counted = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("host"), text.alias("text"), words_of(text).alias("words"),
                          full.alias("full_lines"))
    return counted.select(
        "doc_id", "host", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.translate("text", WHITE, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.transform("full_lines", lambda line: F.struct(line_code(line).alias("code"), F.size(words_of(line)).alias("n"))).alias("lines"))


def line_code(line: Column) -> Column:
    """Hash of the normalised line."""
    lower = F.translate(line, UPPER, LOWER)
    return F.xxhash64(F.trim(F.regexp_replace(F.regexp_replace(lower, "[0-9]+", "0"), SPACE, " ")))


def frequent_lines(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, max_share: int = MAX_SHARE) -> DataFrame:
    """(host, codes): the lines of each host that are above the limits."""
    text = F.coalesce(F.col("text"), F.lit(""))
    full = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    own = docs.select(F.coalesce("source", F.lit("")).alias("host"), F.xxhash64(text).alias("document"), full.alias("full_lines"))
    hosts = own.select("host", "document").distinct().groupBy("host").agg(F.count("*").alias("documents"))
    held = (own.select("host", "document", F.explode(F.array_distinct(F.transform("full_lines", line_code))).alias("code"))
            .distinct().groupBy("host", "code").agg(F.count("*").alias("n")).where(F.col("n") >= min_documents))
    return (held.join(hosts, "host").where(100 * F.col("n") > max_share * F.col("documents"))
            .groupBy("host").agg(F.collect_list("code").alias("codes")))


def judge(docs: DataFrame) -> DataFrame:
    """Base counts and the verdict per row of ``docs`` (doc_id, text, source)."""
    base = base_counts(docs)
    judged = base.join(frequent_lines(docs), "host", "left")
    removed = F.aggregate(F.filter("lines", lambda line: F.array_contains(F.col("codes"), line["code"])), F.lit(0).cast("long"),
                          lambda total, line: total + line["n"])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    return (judged.withColumn("n_removed_words", F.when(F.col("codes").isNull(), F.lit(0).cast("long")).otherwise(removed))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (left >= MIN_WORDS) & (100 * left >= MIN_KEPT * F.col("n_words")))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words",
                    "base_failed", "kept"))


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` whose verdict is kept, with the frequent lines removed from ``text``."""
    marked = docs.withColumn("_host_", F.coalesce("source", F.lit("")))
    codes = frequent_lines(docs).select(F.col("host").alias("_host_"), F.col("codes").alias("_codes_"))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"),
                     lambda line: ~F.coalesce(F.array_contains(F.col("_codes_"), line_code(line)), F.lit(False)))
    old, new = F.size(words_of(F.coalesce("text", F.lit("")))), F.size(words_of(F.col("_text_")))
    repeated = _repeat_words(words_of(F.coalesce("text", F.lit(""))))
    kept = (marked.join(codes, "_host_", "left").withColumn("_text_", F.concat_ws("\n", lines))
            .where((new >= MIN_WORDS) & (100 * new >= MIN_KEPT * old) & (100 * repeated <= 50 * old)))
    return kept.select(*[F.col("_text_").alias("text") if c == "text" else F.col(c) for c in docs.columns])
