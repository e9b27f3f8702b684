"""Plain Python versions of the operators' rules, for small inputs only."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def words(text, fold=False, rule=SPACE_WORD):
    text = text or ""
    return rule.findall(text.translate(FOLD) if fold else text)


def shingles(text, k=5):
    w = words(text, fold=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def components(docs, k=5, percent=75):
    """doc_id -> (set size, least doc_id reachable)."""
    sets = [(d, shingles(t, k)) for d, t in docs]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets))


def removals(docs, window=20):
    """(doc_id, n_words, n_removed, kept words joined) for distinct doc ids."""
    first = {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        w = words(t)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), (d, i))
    out = []
    for d, t in docs:
        w, gone = words(t), set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] != (d, i):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


def contamination(docs, items, n=10):
    """(doc_id, n_words, n_hit, n_items, digest, contaminated)."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text, True, ALNUM_WORD)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[i:i + size])].add("" if item is None else str(item))
    out = []
    for d, t in docs:
        w, hit, found = words(t, True, ALNUM_WORD), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                key = tuple(w[i:i + size])
                if key in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def line_verdicts(docs, min_documents=10, share=1, min_words=50, min_kept=50):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words, base_failed, kept)."""
    def norm(line):
        return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub(r"[0-9]+", "0", line.translate(FOLD))).strip(" ")

    hosts, held = defaultdict(set), defaultdict(set)
    for _, t, s in docs:
        hosts[s or ""].add(t or "")
        for line in (t or "").split("\n"):
            if words(line):
                held[s or "", norm(line)].add(t or "")
    out = []
    for d, t, s in docs:
        t = t or ""
        w = words(t)
        full = [x for x in t.split("\n") if words(x)]
        count = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        rep = {p for i in range(len(w) - 2) if count[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
        gone = sum(len(words(x)) for x in full if len(held[s or "", norm(x)]) >= min_documents
                   and 100 * len(held[s or "", norm(x)]) > share * len(hosts[s or ""]))
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        left = len(w) - gone
        out.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(full) - len(set(full)), len(rep), gone,
                    failed, not failed and left >= min_words and 100 * left >= min_kept * len(w)))
    return sorted(out, key=lambda r: r[0])


def corpus(seed=7, n=60):
    """Random texts with exact copies, near copies of graded strength, shared passages and lines."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)] + ["The", "the", "É", "ß,", "x.", "a"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(45))
    line = " ".join(rng.choice(vocabulary) for _ in range(12))
    base = [rng.choice(vocabulary) for _ in range(160)]
    texts = [None, "", "   \n\t", "one", "One", "two words", "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a",
             "x y " * 40, " ".join(base), " ".join(base)]
    for edits in (1, 2, 3, 4, 5, 6, 8, 12, 20):     # near copies with more and more edits
        w = base[:]
        for _ in range(edits):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
        texts.append(" ".join(w[:150 - edits]))
    while len(texts) < n:
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 200))]
        kind = rng.randrange(5)
        body = " ".join(w)
        if kind == 0:
            body = body[:len(body) // 2] + "\n" + passage + "\n" + body[len(body) // 2:]
        elif kind == 1:
            body = line + "\n" + body + "\n" + line
        elif kind == 2 and len(texts) > 20:
            body = rng.choice(texts[10:]) or ""
        texts.append(body)
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))
