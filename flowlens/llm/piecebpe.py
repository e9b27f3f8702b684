"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

Vocabulary facts are read from the model file and checked on the driver
(``Vocabulary``): identity normalisation, a leading space symbol, and that space
symbols stand only at the start of a piece or fill all of it, so a text splits
into words at its spaces and words can be encoded apart and remembered.

``encode_words`` encodes many words at once: flat numpy symbol arrays, the
segmented minimum pair rank of every word, simultaneous leftmost merges of that
rank, compaction, until no pair of the vocabulary is left.  Merging every
occurrence at once equals the one-by-one order only if no pair with the merged
piece has a rank as good; ``Vocabulary.alone`` marks the pieces where that is not
so, and for them only the leftmost occurrence is merged in a round.

``encode_long`` does the same for one long word at the cost of what each round changes.

No shuffle.  Defined results: every row is encoded by itself, so repeated rows, ties
and null ids simply repeat their ids, and an empty table gives an empty result; null and
empty texts have no ids and decode to the empty text; characters outside the vocabulary become their UTF-8 byte pieces;
a space symbol inside the text decodes to a space, as the library does.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm.workspace import by_value, forget_others, give_back, process_cache

CACHE_ENTRIES = 80_000   # words met lately; as many older ones are kept beside them
CHARS_AT_ONCE = 1 << 16  # symbols of new words merged at once (or one longer word)
LONG_WORD = 1024         # symbols from which a word keeps its pair ranks between rounds
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: The first part of a run of space symbols and the word after it.
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
NO_RANK = np.iinfo(np.int64).max


class Vocabulary:
    """Pieces, pair table and checks of a SentencePiece BPE model."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        rule, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if (model.trainer_spec.model_type != 2 or rule.precompiled_charsmap or not rule.add_dummy_prefix
                or rule.remove_extra_whitespaces or not rule.escape_whitespaces or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}
                or not model.trainer_spec.byte_fallback or model.trainer_spec.treat_whitespace_as_suffix):
            raise ValueError("not a byte-fallback BPE model with identity normalisation")
        self.size = len(model.pieces)
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("a piece holds a space symbol after other text")
        scores = sorted({p.score for p in model.pieces if p.type == NORMAL}, reverse=True)
        rank = {s: i for i, s in enumerate(scores)}
        self.chars = {p: i for p, i in normal.items() if len(p) == 1}
        if any(c not in self.chars for p in normal for c in p):
            raise ValueError("a piece holds a character that is no piece")
        pairs = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = normal.get(piece[:cut]), normal.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (rank[model.pieces[i].score], i)
        keys = np.array(sorted(pairs), np.int64)
        self.pair_key = keys
        self.pair_rank = np.array([pairs[k][0] for k in keys.tolist()], np.int64)
        self.pair_piece = np.array([pairs[k][1] for k in keys.tolist()], np.int64)
        own = np.array([rank.get(p.score, 0) if p.type == NORMAL else -1 for p in model.pieces], np.int64)
        best = np.full(self.size, NO_RANK, np.int64)
        np.minimum.at(best, keys // self.size, self.pair_rank)
        np.minimum.at(best, keys % self.size, self.pair_rank)
        self.alone = best <= own   # a pair with this piece may come before its other occurrences
        self.bytes = np.zeros(256, np.int64)
        self.piece_bytes: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes[value] = i
                self.piece_bytes.append(bytes([value]))
            elif p.type == CONTROL:
                self.piece_bytes.append(b"")
            elif p.type == UNKNOWN:
                self.piece_bytes.append(model.trainer_spec.unk_surface.encode())
            else:
                self.piece_bytes.append(p.piece.replace(SPACE, " ").encode("utf-8"))
        self.opens_word = np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in model.pieces])
        self.is_byte = np.array([p.type == BYTE for p in model.pieces])


def _pairs(vocab: Vocabulary, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and table place of each symbol with its right neighbour (NO_RANK: none)."""
    key = symbol[:-1] * vocab.size + symbol[1:]
    place = np.minimum(np.searchsorted(vocab.pair_key, key), len(vocab.pair_key) - 1)
    good = (vocab.pair_key[place] == key) & (word[:-1] == word[1:]) & (symbol[:-1] >= 0) & (symbol[1:] >= 0)
    return np.where(good, vocab.pair_rank[place], NO_RANK), place


def encode_words(vocab: Vocabulary, words: list[str]) -> list[np.ndarray]:
    """Ids of every word (each starts with its space symbols)."""
    if not words:
        return []
    text = "".join(words)
    chars = vocab.chars
    symbol = np.array([chars.get(c, -1) for c in text], np.int64)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    word = np.repeat(np.arange(len(words)), [len(w) for w in words])
    done_symbol, done_word, done_at, done_point = [], [], [], []
    at = np.arange(len(symbol))   # where a symbol began: the order of the result
    while len(symbol):
        rank, place = _pairs(vocab, symbol, word)
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        lowest = np.minimum.reduceat(np.concatenate([rank, [NO_RANK]]), starts)
        lengths = np.diff(np.concatenate([starts, [len(symbol)]]))
        over = np.repeat(lowest == NO_RANK, lengths)
        if over.any():   # words without a pair leave the arrays
            done_symbol.append(symbol[over])
            done_word.append(word[over])
            done_at.append(at[over])
            done_point.append(points[over])
            stay = ~over
            rank = np.concatenate([rank, [NO_RANK]])[stay][:-1]
            place = np.concatenate([place, [0]])[stay][:-1]
            lengths, lowest = lengths[lowest != NO_RANK], lowest[lowest != NO_RANK]
            symbol, word, at, points = symbol[stay], word[stay], at[stay], points[stay]
            if not len(symbol):
                break
        least = np.repeat(lowest, lengths)[:-1]
        hits = np.flatnonzero(rank == least)
        piece = vocab.pair_piece[place[hits]]
        # in a chain of overlapping pairs every second one merges, from the left
        chain = np.concatenate([[True], hits[1:] != hits[:-1] + 1])
        first = np.flatnonzero(chain)
        order = np.arange(len(hits)) - np.repeat(first, np.diff(np.concatenate([first, [len(hits)]])))
        merge = order % 2 == 0
        # where order matters within a word, only its leftmost pair merges in this round
        owner = word[hits]
        leftmost = np.concatenate([[True], owner[1:] != owner[:-1]])
        if vocab.alone[piece].any():
            careful = np.zeros(int(word[-1]) + 1, bool)
            careful[owner[vocab.alone[piece]]] = True
            merge &= leftmost | ~careful[owner]
        hits, piece = hits[merge], piece[merge]
        symbol[hits] = piece
        keep = np.ones(len(symbol), bool)
        keep[hits + 1] = False
        symbol, word, at, points = symbol[keep], word[keep], at[keep], points[keep]
    symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
    at, points = np.concatenate(done_at), np.concatenate(done_point)
    order = np.argsort(at, kind="stable")
    symbol, word, points = symbol[order], word[order], points[order]
    bounds = np.searchsorted(word, np.arange(len(words) + 1))
    out = [symbol[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for w in np.unique(word[symbol < 0]).tolist():   # characters outside the vocabulary
        ids = []
        for s, p in zip(out[w].tolist(), points[bounds[w]:bounds[w + 1]].tolist(), strict=True):
            ids += [s] if s >= 0 else vocab.bytes[list(chr(p).encode("utf-8"))].tolist()
        out[w] = np.array(ids, np.int64)
    return out


def encode_long(vocab: Vocabulary, word: str) -> np.ndarray:
    """Ids of one long word by the same merge rounds, each at the cost of what it changes.

    The symbols are a linked list; the ranks of the pairs stay between the rounds, and the positions of each rank lie
    in a bucket.  A round takes the least rank's bucket, drops the positions whose pair has changed, merges
    the others simultaneously from the left and ranks only the pairs beside the merged ones anew.
    """
    n = len(word)
    symbol = np.array([vocab.chars.get(c, -1) for c in word], np.int64)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    alive = np.ones(n, bool)
    current = np.full(n, NO_RANK, np.int64)      # rank of the pair that begins at a position
    buckets: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def rank_pairs(at: np.ndarray) -> None:
        right = after[at]
        ends = right >= n
        left, right = symbol[at], symbol[np.where(ends, 0, right)]
        key = left * vocab.size + right
        place = np.minimum(np.searchsorted(vocab.pair_key, key), len(vocab.pair_key) - 1)
        good = (vocab.pair_key[place] == key) & ~ends & (left >= 0) & (right >= 0)
        current[at] = np.where(good, vocab.pair_rank[place], NO_RANK)
        piece_at[at] = np.where(good, vocab.pair_piece[place], -1)
        keep(at[good])

    def keep(at: np.ndarray) -> None:
        """Put positions into the buckets of their ranks."""
        if not len(at):
            return
        at = at[np.argsort(current[at], kind="stable")]
        rank = current[at]
        cuts = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])).tolist()
        for lo, hi in zip(cuts, [*cuts[1:], len(at)], strict=True):
            r = int(rank[lo])
            if r not in buckets:
                buckets[r] = []
                heapq.heappush(ranks, r)
            buckets[r].append(at[lo:hi])

    def join(at: np.ndarray) -> None:
        """Merge the pairs at these positions, none of which overlap."""
        gone = after[at]
        symbol[at] = piece_at[at]
        alive[gone] = False
        after[at] = after[gone]
        follows = after[at] < n
        before[after[at][follows]] = at[follows]
        left = before[at]
        rank_pairs(np.unique(np.concatenate([at, left[left >= 0]])))

    piece_at = np.full(n, -1, np.int64)
    rank_pairs(np.arange(n))
    while ranks:
        least = heapq.heappop(ranks)
        at = np.unique(np.concatenate(buckets.pop(least)))
        at = at[alive[at] & (current[at] == least)]
        if not len(at):
            continue
        chain = np.concatenate([[True], at[1:] != after[at[:-1]]])
        first = np.flatnonzero(chain)
        order = np.arange(len(at)) - np.repeat(first, np.diff(np.concatenate([first, [len(at)]])))
        merge = order % 2 == 0
        if not vocab.alone[piece_at[at]].any():
            join(at[merge])
            continue
        for i, p in enumerate(at.tolist()):      # order matters: one after the other, until a new pair comes first
            if alive[p] and current[p] == least:
                join(at[i:i + 1])
                if ranks and ranks[0] <= least:
                    keep(at[i + 1:])
                    break
    at = np.flatnonzero(alive)
    ids = symbol[at]
    if (ids >= 0).all():
        return ids
    out = [[i] if i >= 0 else vocab.bytes[list(word[p].encode("utf-8"))].tolist() for i, p in zip(ids.tolist(), at.tolist(), strict=True)]
    return np.array([i for part in out for i in part], np.int64)


def _parts(words: list[str]) -> Iterator[list[str]]:
    """The words in lists of at most ``CHARS_AT_ONCE`` symbols (or one longer word)."""
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    lo = 0
    while lo < len(words):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHARS_AT_ONCE, "right")))
        yield words[lo:hi]
        lo = hi


class Codec:
    """Encoder and decoder with a bounded memory of words: those met lately and those met before them."""

    def __init__(self, model_path: str):
        self.vocab = Vocabulary(model_path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def words(text: str) -> list[str]:
        """Keys of a text's words: a plain word stands for itself with one space symbol before it."""
        if not text:
            return []
        pieces = text.split(" ")
        if "" not in pieces and SPACE not in text:
            return pieces
        found = WORD.findall(SPACE + text.replace(" ", SPACE))
        return [w[1:] if w[0] == SPACE and w[1:2] not in ("", SPACE) else w for w in found]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids (int32) of every text."""
        split = [self.words(t or "") for t in texts]
        if len(self.known) >= CACHE_ENTRIES:
            self.known, self.older = {}, self.known
        known, older, long = self.known, self.older, {}
        new = {w for words in split for w in words if w not in known}
        met = [w for w in new if w in older]
        for w in met:
            known[w] = older.pop(w)
        new.difference_update(met)
        if new:
            marked = {w: w if w[0] == SPACE else SPACE + w for w in new}
            new = [w for w in new if len(w) < LONG_WORD]
            codes = [c for part in _parts([marked[w] for w in new]) for c in encode_words(self.vocab, part)]
            far = [w for w in marked if len(w) >= LONG_WORD]
            codes += [encode_long(self.vocab, marked[w]) for w in far]
            for w, c in zip([*new, *far], codes, strict=True):
                (known if len(w) < 64 else long)[w] = c.astype(np.int32).tobytes()
        if long:
            return [np.frombuffer(b"".join([known[w] if w in known else long[w] for w in words]), np.int32) for words in split]
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        """Text of an id list: the first piece loses its leading space, byte pieces join to UTF-8."""
        if not len(ids):
            return ""
        pieces = list(map(self.vocab.piece_bytes.__getitem__, ids.tolist()))
        lead = 0
        while lead < len(pieces) - 1 and not pieces[lead]:   # control pieces stand for nothing
            lead += 1
        if self.vocab.opens_word[ids[lead]]:
            pieces[lead] = pieces[lead][1:]
        try:
            return b"".join(pieces).decode("utf-8")
        except UnicodeDecodeError:   # broken byte runs: every stray byte is a replacement character
            out, i = [], 0
            flags = self.vocab.is_byte[ids]
            while i < len(pieces):
                j = i
                while j < len(pieces) and flags[j] == flags[i]:
                    j += 1
                out.append(_repair(b"".join(pieces[i:j])) if flags[i] else b"".join(pieces[i:j]).decode("utf-8"))
                i = j
            return "".join(out)


def _repair(run: bytes) -> str:
    out, i = [], 0
    while i < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[i:i + n].decode("utf-8"))
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            n = 1
        i += n
    return "".join(out)


def _codec(model_path: str) -> Codec:
    forget_others(f"codec {model_path}", f"names {model_path}")
    return process_cache(f"codec {model_path}", lambda: Codec(model_path))


def _slices(rows: pa.RecordBatch, step: int = 128) -> Iterator[pa.RecordBatch]:
    for lo in range(0, rows.num_rows, step):
        yield rows.slice(lo, step)
    give_back()


def _encoder(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for batch in batches:
            for rows in _slices(batch):
                ids = codec.encode(rows.column("text").to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))],
                    ["doc_id", "ids"])
    return run


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids array<int>) per row of ``docs`` (doc_id, text)."""
    return docs.select("doc_id", "text").mapInArrow(_encoder(model_path), "doc_id long, ids array<int>")


def _decoder(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for batch in batches:
            for rows in _slices(batch):
                ids = [np.array(x or [], np.int64) for x in rows.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(map(codec.decode, ids), pa.string())], ["doc_id", "text"])
    return run


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) per row of ``encoded`` (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(model_path), "doc_id long, text string")


def _digests(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        names = process_cache(f"names {model_path}", lambda: list(map(str, range(codec.vocab.size))))
        sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        for batch in batches:
            for rows in _slices(batch):
                ids = codec.encode(rows.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([sha(",".join(map(names.__getitem__, x.tolist()))) for x in ids]),
                     pa.array([sha(codec.decode(x)) for x in ids])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def round_trip_digest(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the text is encoded, the ids decoded."""
    return docs.select("doc_id", "text").mapInArrow(
        _digests(model_path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


by_value(__name__)
