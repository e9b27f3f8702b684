"""Toxicity scores: Levenshtein automata run against a lexicon trie, weighed by context.

``train`` learns everything from labelled rows (near copies of a toxic text count once): a lexicon of word beginnings whose
documents are toxic far more often than others, a weight for their misspellings, and a
small logistic model.  It uses at most about ``MAX_TRAIN`` labelled documents (chosen by
a hash of the id), a documented bound; scoring covers every whole text.

The lexicon is a trie.  ``LexiconAutomaton`` runs a word through the trie and the
Levenshtein automata of its entries at once: a state is the set of (trie node, edits)
pairs, and transitions are made on first use, so a word costs one step per character.
An entry matches a word that begins with it, exactly or within its number of edits.

Every match gets a context factor from the words around it: inside quotation marks or
beside a reporting word it counts less (a quotation), beside a second-person word more
(abuse).  A document's evidence is the sum over its matches.

No shuffle of texts: the labelled sample is found by a broadcast join of bounded size.
Defined results: null and empty texts score like a text without a match; rows that share
a ``doc_id`` are scored alone; without labels, or with labels of one class, every score
is the smoothed share of toxic labels.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.wordscan import blocks, scan, space_words, window_codes
from flowlens.llm.workspace import by_value, forget_others, give_back, latest_in_process, stored

MAX_TRAIN = 12_000       # labelled documents used to learn
MAX_CANDIDATES = 200_000  # word beginnings whose counts are compared
MAX_LEXICON = 2_000
MIN_DOCUMENTS = 4        # toxic documents an entry needs
SURER = 0.1              # by which a longer beginning must be surer than an entry it continues
MIN_PRECISION = 0.5      # lower bound (95 %) of its share of toxic documents
SHORTEST, LONGEST = 3, 12
UNSEEN = 0.8             # evidence of a misspelling the sample does not show
MIN_MISSPELLED = 20      # rows with misspelled evidence from which its weight is learned
SKETCH, SAME = 8, 2      # least window codes of a text, and how many two copies share
THRESHOLD = 0.3
CACHE_ENTRIES = 300_000
MAX_STATES = 20_000      # automaton states kept before they are made anew
REACH = 6                # words looked at on each side of a match
QUOTED, REPORTED, ADDRESSED = 0.4, 0.6, 1.25
QUOTES = "\"“”„«»‘’"
REPORT_WORDS = frozenset("said says wrote writes called quote quoted word term insult phrase".split())
ADDRESS_WORDS = frozenset("you your youre u ur are".split())
WORD = re.compile(r"[^\W_]+")


def edits_allowed(entry: str) -> int:
    """Misspelling distance of an entry: short ones must match exactly."""
    return 0 if len(entry) < 5 else 1 if len(entry) < 9 else 2


class LexiconAutomaton:
    """Trie of the entries crossed with their Levenshtein automata, determinised on use."""

    def __init__(self, entries: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.entry_at: list[int] = [-1]
        self.limit: list[int] = [0]        # most edits any entry below allows
        for number, entry in enumerate(entries):
            node, k = 0, edits_allowed(entry)
            self.limit[0] = max(self.limit[0], k)
            for c in entry:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.entry_at.append(-1)
                    self.limit.append(0)
                node = self.children[node][c]
                self.limit[node] = max(self.limit[node], k)
            self.entry_at[node] = number
        self.edits = [edits_allowed(e) for e in entries]
        self._forget()

    def _forget(self) -> None:
        """Drops the states made so far; only the first is made again."""
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.accepts: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.start = self._state(self._close({0: 0}))

    def _close(self, reached: dict[int, int]) -> frozenset:
        """Adds the nodes reached by leaving out characters of an entry."""
        queue = list(reached.items())
        while queue:
            node, edits = queue.pop()
            if reached.get(node, 99) < edits:
                continue
            for child in self.children[node].values():
                if edits + 1 <= self.limit[child] and edits + 1 < reached.get(child, 99):
                    reached[child] = edits + 1
                    queue.append((child, edits + 1))
        return frozenset(reached.items())

    def _state(self, pairs: frozenset) -> int:
        if pairs not in self.states:
            self.states[pairs] = len(self.sets)
            self.sets.append(pairs)
            self.accepts.append(tuple((self.entry_at[n], e) for n, e in pairs
                                      if self.entry_at[n] >= 0 and e <= self.edits[self.entry_at[n]]))
            self.steps.append({})
        return self.states[pairs]

    def _step(self, state: int, c: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.limit[node] and edits < reached.get(node, 99):
                reached[node] = edits

        for node, edits in self.sets[state]:
            reach(node, edits + 1)                               # an extra character
            for letter, child in self.children[node].items():
                reach(child, edits + (letter != c))              # the same or another one
        target = self._state(self._close(reached))
        self.steps[state][c] = target
        return target

    def match(self, word: str) -> tuple[int, int] | None:
        """(entry, edits) of the best entry the word begins with: fewest edits, then the longest read."""
        if len(self.sets) > MAX_STATES:
            self._forget()
        state, best = self.start, None
        for c in word:
            following = self.steps[state].get(c)
            state = self._step(state, c) if following is None else following
            if not self.sets[state]:
                break
            for entry, edits in self.accepts[state]:
                if best is None or edits <= best[1]:
                    best = (entry, edits)
        return best


class Model(NamedTuple):
    """What ``train`` learned."""

    entries: list[str]
    strength: list[float]   # evidence of each entry, 0 to 1
    fuzzy: list[float]      # evidence of a misspelling of each entry, 0 to 1
    weights: list[float]    # of the logistic model over ``features``
    prior: float


class Scorer:
    """Features of texts under a model, with a bounded memory of words."""

    def __init__(self, model: Model):
        self.model, self.automaton = model, LexiconAutomaton(model.entries)
        outer = self

        class Pieces(dict):
            def __missing__(self, piece: str):
                if len(self) >= CACHE_ENTRIES:
                    self.clear()
                found = [m for m in map(outer.automaton.match, WORD.findall(piece)) if m]
                best = min(found, key=lambda m: m[1]) if found else None
                if len(piece) < 64:
                    self[piece] = best
                return best

        self.pieces = Pieces()

    @staticmethod
    def context(pieces: list[str], at: int) -> float:
        """Factor of a match from the words around it."""
        before, after = pieces[max(0, at - REACH):at + 1], pieces[at:at + REACH + 1]
        factor = 1.0
        if any(q in p for p in before for q in QUOTES) and any(q in p for p in after for q in QUOTES):
            factor *= QUOTED
        near = {w for p in before[:-1] + after[1:] for w in WORD.findall(p)}
        if near & REPORT_WORDS:
            factor *= REPORTED
        elif near & ADDRESS_WORDS:
            factor *= ADDRESSED
        return factor

    def matches(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """(word position, entry, edits, context factor) of every match."""
        pieces = (text or "").lower().split()
        found = list(map(self.pieces.__getitem__, pieces))
        return [(i, *m, self.context(pieces, i)) for i, m in enumerate(found) if m]

    def features(self, text: str | None) -> list[float]:
        """Constant, best exact match, exact evidence, misspelled evidence."""
        best = exact = fuzzy = 0.0
        for _, entry, edits, factor in self.matches(text):
            if edits == 0:
                own = factor * self.model.strength[entry]
                best, exact = max(best, own), exact + own
            else:
                fuzzy += factor * self.model.fuzzy[entry]
        return [1.0, min(best, 1.0), float(np.log1p(exact)), float(np.log1p(fuzzy))]

    def score(self, text: str | None) -> float:
        if not self.model.weights:
            return self.model.prior
        z = float(np.dot(self.model.weights, self.features(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def held_out(doc_id) -> object:
    """Rows never learned from: crc32 of the id's text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def _beginnings(text: str | None) -> set[str]:
    words = set(WORD.findall((text or "").lower()))
    return {w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)}


def _begin_counts(wanted: frozenset | None):
    """(term, documents) over small slices of the rows; of the ``wanted`` terms only, if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                counts: Counter = Counter()
                for text in batch.column("text").slice(lo, 200).to_pylist():
                    terms = _beginnings(text)
                    counts.update(terms if wanted is None else terms & wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "documents"])
    return run


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, the least codes of its three-word windows): near copies share several."""
    for rows, data, bounds in blocks(batches):
        words = scan(data, bounds, space_words(), fold=True)
        codes = window_codes(words.code, 3)
        least = [np.unique(codes[a:max(a, b - 2)])[:SKETCH] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array([x.view(np.int64) for x in least], pa.list_(pa.int64()))],
                                         ["doc_id", "least"])


def different_texts(sketches: list[tuple[int, list[int]]]) -> list[int]:
    """Ids without near copies of an earlier one; the words of a copied text are then counted once."""
    kept, seen = [], {}
    for doc_id, least in sorted(sketches):
        met = Counter(seen[code] for code in least if code in seen)
        if met and max(met.values()) >= SAME:
            continue
        kept.append(doc_id)
        for code in least:
            seen.setdefault(code, doc_id)
    return kept


def _lower_bound(p: float, n: float) -> float:
    """Wilson lower bound of p / (p + n)."""
    total = p + n
    if total <= 0:
        return 0.0
    z, share = 1.96, p / total
    return (share + z * z / (2 * total) - z * np.sqrt(share * (1 - share) / total + z * z / (4 * total * total))) / (1 + z * z / total)


def _gain(p: float, n: float, prior: float) -> float:
    """Log-likelihood gain of the share p / (p + n) over the prior share."""
    share = p / (p + n)
    return p * np.log(share / prior) + (n * np.log((1 - share) / (1 - prior)) if n else 0.0)


def choose_lexicon(counts: dict[str, tuple[int, int]], prior: float) -> tuple[list[str], list[float]]:
    """Word beginnings of (toxic, other) document counts that tell most, and their strengths.

    The strength is the lower bound of the share of toxic documents.  A longer beginning
    than an entry is added only if it is surer, a shorter one only if what the entries
    do not explain is sure by itself.
    """
    sure = sorted(((_gain(p, n, prior), len(t), t) for t, (p, n) in counts.items()
                   if p >= MIN_DOCUMENTS and _lower_bound(p, n) >= MIN_PRECISION), reverse=True)
    chosen: dict[str, float] = {}
    covered: dict[str, list[int]] = {}     # beginnings of entries -> what the entries explain
    for _, _, term in sure:
        if len(chosen) >= MAX_LEXICON:
            break
        p, n = counts[term]
        strength = float(_lower_bound(p, n))
        if any(strength < chosen[term[:k]] + SURER for k in range(SHORTEST, len(term)) if term[:k] in chosen):
            continue
        done = covered.get(term, [0, 0])
        if done[0] and (p - done[0] < MIN_DOCUMENTS or _lower_bound(p - done[0], max(0, n - done[1])) < MIN_PRECISION):
            continue
        chosen[term] = strength
        for k in range(SHORTEST, len(term)):
            total = covered.setdefault(term[:k], [0, 0])
            total[0] += p
            total[1] += n
    return list(chosen), list(chosen.values())


def _hit_rows(model: Model):
    """(toxic, features, entries met misspelled only) of labelled rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others("latest toxicity")
        scorer = latest_in_process("toxicity", model, lambda: Scorer(model))
        for rows in batches:
            features, only = [], []
            for text in rows.column("text").to_pylist():
                found = scorer.matches(text)
                features.append(scorer.features(text))
                only.append(sorted({e for _, e, k, _ in found if k}) if all(k for _, _, k, _ in found) else [])
            yield pa.RecordBatch.from_arrays(
                [rows.column("toxic"), pa.array(features, pa.list_(pa.float64())), pa.array(only, pa.list_(pa.int64()))],
                ["toxic", "features", "misspelled"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> list[float]:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        change = np.linalg.solve(curve, slope)
        w -= change
        if np.abs(change).max() < 1e-8:
            break
    return w.tolist()


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Learn a model from ``labels`` (doc_id, toxic) of rows that are not held out."""
    marks = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").alias("marked")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    total = marks.count()
    share = min(1.0, max_train / max(total, 1))
    marks = marks.where(F.pmod(F.xxhash64("marked"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select("doc_id", "text")
    sample = texts.join(F.broadcast(marks), texts["doc_id"] == marks["marked"]).select("doc_id", "text", "toxic")
    sample = stored(sample.dropDuplicates(["doc_id"]), "toxicity-sample")
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    prior = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 5)
    if not sizes.get(0) or not sizes.get(1):
        return Model([], [], [], [], prior)
    spread = sample.repartition(16)
    toxic = spread.where("toxic = 1")
    names = different_texts([(r.doc_id, r.least) for r in toxic.select("doc_id", "text").mapInArrow(
        _sketches, "doc_id long, least array<bigint>").collect()])
    ids = sample.sparkSession.createDataFrame(pa.table({"kept": pa.array(names, pa.int64())}))   # at most MAX_TRAIN; Arrow needs no worker of its own
    single = toxic.join(F.broadcast(ids), F.col("doc_id") == F.col("kept")).select("doc_id", "text", "toxic")
    bad = (single.mapInArrow(_begin_counts(None), "term string, documents long")
           .groupBy("term").agg(F.sum("documents").alias("n")).where(F.col("n") >= MIN_DOCUMENTS)
           .orderBy(F.desc("n"), "term").limit(MAX_CANDIDATES).collect())
    bad = {r.term: r.n for r in bad}
    good = (spread.where("toxic = 0").mapInArrow(_begin_counts(frozenset(bad)), "term string, documents long")
            .groupBy("term").agg(F.sum("documents").alias("n")).collect())
    good = {r.term: r.n for r in good}
    entries, strength = choose_lexicon({t: (p, good.get(t, 0)) for t, p in bad.items()}, len(names) / (sizes[0] + len(names)))
    if not entries:
        return Model([], [], [], [], prior)
    plain = Model(entries, strength, [0.0] * len(entries), [], prior)
    hits = "toxic int, features array<double>, misspelled array<bigint>"
    only = np.zeros((2, len(entries)))
    for r in (spread.mapInArrow(_hit_rows(plain), hits).select("toxic", F.explode("misspelled").alias("entry"))
              .groupBy("toxic", "entry").count().collect()):
        only[r.toxic, r.entry] = r["count"]
    rate = only / np.array([[sizes[0]], [sizes[1]]])
    # evidence of a misspelling: how much more toxic documents have it; unseen ones count UNSEEN
    seen = only.sum(axis=0)
    fuzzy = np.where(seen < 3, UNSEEN, np.clip((rate[1] - rate[0]) / np.maximum(rate[0] + rate[1], 1e-9), 0, 1))
    model = Model(entries, strength, fuzzy.tolist(), [], prior)
    rows = spread.mapInArrow(_hit_rows(model), hits).select("toxic", "features").collect()
    x, y = np.array([r.features for r in rows]), np.array([r.toxic for r in rows], float)
    weights = _logistic(x, y)
    if (x[:, 3] > 0).sum() < MIN_MISSPELLED:
        weights[3] = max(weights[3], weights[2])   # too few misspellings to learn from: as the exact ones
    return model._replace(weights=weights)


def _scores(model: Model, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others("latest toxicity")
        scorer = latest_in_process("toxicity", model, lambda: Scorer(model))
        for rows in batches:
            yield rows.append_column(name, pa.array(list(map(scorer.score, rows.column("text").to_pylist())), pa.float64()))
        give_back()
    return run


def score(docs: DataFrame, model: Model, name: str = "toxic_score") -> DataFrame:
    """``docs`` with the score (0 to 1) appended as ``name``; ``docs`` needs a ``text`` column."""
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"docs has a column {name}: give another name")
    schema = docs.withColumn(name, F.lit(0.0)).schema
    return docs.mapInArrow(_scores(model, name), schema)


by_value(__name__)
