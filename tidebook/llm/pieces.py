"""SentencePiece encoding and decoding: words of equal length advance together through one batched search.

Unigram models are searched by Viterbi.  A merge (BPE) model has ranks instead of probabilities, and the
best sum of any scores is not what its merges give; for such a model the same batches and the same hash
probes choose merges by vectorised maxima, which gives the ids of the reference library.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import bounded_batches, whole_text

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CELLS = 1 << 20  # code points of words that advance together
_LONG = 256  # words beyond this are first cut where no piece can span
ENCODED = "doc_id long, n_pieces long, ids array<int>, round_trip boolean"


@dataclass(frozen=True)
class Vocabulary:
    """Piece hashes in ascending order with id, score and length, and what each id decodes to."""

    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    longest: int
    byte_ids: np.ndarray
    pairs: np.ndarray
    unknown_score: float
    merges: bool
    decoded: np.ndarray  # all bytes
    starts: np.ndarray

    @functools.cached_property
    def place(self) -> dict[int, int]:
        """Where each piece hash stands among the keys."""
        return {key: i for i, key in enumerate(self.keys.tolist())}


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a model file on the driver; workers get arrays only.

    Scores that are whole and not positive are ranks of merges, as merge models have them.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    ordinary = [
        i
        for i in range(n)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))
    ]
    texts = [model.id_to_piece(i) for i in ordinary]
    scores = np.array([model.get_score(i) for i in ordinary])
    keys = np.array([_hash(t) for t in texts], dtype=np.uint64)
    order = np.argsort(keys)
    if len(np.unique(keys)) != len(keys):
        raise ValueError("two pieces share a hash")
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
    decoded = [b""] * n
    for i, t in zip(ordinary, texts, strict=True):
        decoded[i] = t.replace(SPACE, " ").encode()
    for b, i in enumerate(byte_ids):
        if model.is_byte(int(i)):
            decoded[i] = bytes([b])
    pairs = {(ord(a) << 21) | ord(b) for t in texts for a, b in zip(t, t[1:], strict=False)}
    return Vocabulary(
        keys[order],
        np.array(ordinary, dtype=np.int32)[order],
        scores[order],
        max(map(len, texts)),
        byte_ids,
        np.array(sorted(pairs), dtype=np.int64),
        float(scores.min()) - 10.0,
        bool(np.all(scores <= 0) and np.all(scores == np.round(scores))),
        np.frombuffer(b"".join(decoded), dtype=np.uint8),
        np.concatenate([[0], np.cumsum([len(d) for d in decoded])]),
    )


def _hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(_BASE) + ord(c)) & (2**64 - 1)
    return h


def viterbi(vocab: Vocabulary, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best pieces of ``codes`` (words x length, code points): flat ids in order, and pieces of each word.

    A character that is no piece costs ``unknown_score`` and has the id -1 - code point.  Of equal scores
    the longer last piece wins.
    """
    n, length = codes.shape
    prefix = np.zeros((length + 1, n), dtype=np.uint64)
    power = _powers(vocab.longest)
    best = np.full((length + 1, n), -np.inf)
    best[0] = 0.0
    back = np.ones((length + 1, n), dtype=np.int16)
    piece = np.empty((length + 1, n), dtype=np.int32)
    for i in range(1, length + 1):
        prefix[i] = prefix[i - 1] * _BASE + codes[:, i - 1].astype(np.uint64)
        best[i] = best[i - 1] + vocab.unknown_score
        piece[i] = -1 - codes[:, i - 1].astype(np.int32)
        for size in range(min(i, vocab.longest), 0, -1):
            wanted = prefix[i] - prefix[i - size] * power[size]
            at = np.minimum(np.searchsorted(vocab.keys, wanted), len(vocab.keys) - 1)
            hit = np.flatnonzero(vocab.keys[at] == wanted)
            if not len(hit):
                continue
            at = at[hit]
            total = best[i - size, hit] + vocab.scores[at]
            better = total > best[i, hit]
            hit, at = hit[better], at[better]
            best[i, hit] = total[better]
            back[i, hit] = size
            piece[i, hit] = vocab.ids[at]
    # Walk all words back at once.
    at, rows, steps = np.full(n, length), np.arange(n), []
    while len(rows):
        steps.append((rows, piece[at[rows], rows]))
        at[rows] -= back[at[rows], rows]
        rows = rows[at[rows] > 0]
    counts = np.zeros(n, dtype=np.int64)
    for rows, _ in steps:
        counts[rows] += 1
    ends = np.cumsum(counts)
    flat = np.empty(int(ends[-1]) if n else 0, dtype=np.int32)
    for k, (rows, ids) in enumerate(steps):
        flat[ends[rows] - 1 - k] = ids
    return flat, counts


def _powers(longest: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest, _BASE)]), dtype=np.uint64)


def merge(vocab: Vocabulary, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of ``codes`` by a merge model, in the form that ``viterbi`` returns.

    All words start as single characters.  In each round every word joins the neighbours whose union is
    the best-ranked piece, the leftmost of equals, until no union is a piece.
    """
    n, length = codes.shape
    power = _powers(vocab.longest)
    prefix = np.zeros((n, length + 1), dtype=np.uint64)
    for i in range(length):
        prefix[:, i + 1] = prefix[:, i] * _BASE + codes[:, i].astype(np.uint64)

    def probe(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each substring among the keys, and whether it is there."""
        size = np.minimum(end - start, vocab.longest)
        wanted = prefix[row, end] - prefix[row, start] * power[size]
        at = np.minimum(np.searchsorted(vocab.keys, wanted), len(vocab.keys) - 1)
        return at, (vocab.keys[at] == wanted) & (end - start <= vocab.longest)

    def gain(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        at, hit = probe(row, start, end)
        return np.where(hit, vocab.scores[at], -np.inf)

    cuts = np.tile(np.arange(length + 1), (n, 1))
    flat_row, flat_at = np.repeat(np.arange(n), length - 1), np.tile(np.arange(length - 1), n)
    # The last column never wins; it keeps shifted rows the same width.
    union = np.full((n, length), -np.inf)
    union[:, : length - 1] = gain(flat_row, flat_at, flat_at + 2).reshape(n, length - 1)
    live, pieces_left, out = np.arange(n), length, []
    while len(live):
        at = union.argmax(axis=1)
        ended = union[np.arange(len(live)), at] == -np.inf
        if ended.any():
            out.append((live[ended], cuts[ended]))
            live, cuts, union, at = live[~ended], cuts[~ended], union[~ended], at[~ended]
            if not len(live):
                break
        rows = np.arange(len(live))
        keep = np.arange(pieces_left)[None, :] + (np.arange(pieces_left)[None, :] > at[:, None])
        cuts = np.take_along_axis(cuts, keep, axis=1)
        keep = np.arange(pieces_left - 1)[None, :] + (np.arange(pieces_left - 1)[None, :] > at[:, None])
        union = np.take_along_axis(union, keep, axis=1)
        pieces_left -= 1
        # Unions of the new piece with its neighbours.
        left = rows[at > 0]
        union[left, at[left] - 1] = gain(live[left], cuts[left, at[left] - 1], cuts[left, at[left] + 1])
        inner = at + 2 <= pieces_left
        right = rows[inner]
        union[right, at[right]] = gain(live[right], cuts[right, at[right]], cuts[right, at[right] + 2])
        if not inner.all():
            union[rows[~inner], at[~inner]] = -np.inf
    counts = np.zeros(n, dtype=np.int64)
    for rows, c in out:
        counts[rows] = c.shape[1] - 1
    starts, flat = np.cumsum(counts) - counts, np.empty(int(counts.sum()), dtype=np.int32)
    for rows, c in out:
        each = c.shape[1] - 1
        row = np.repeat(rows, each)
        start, end = c[:, :-1].ravel(), c[:, 1:].ravel()
        at, hit = probe(row, start, end)
        lone = -1 - codes[row, start].astype(np.int32)
        flat[_ranges(starts[rows], counts[rows])] = np.where(hit, vocab.ids[at], lone)
    return flat, counts


def merge_long(vocab: Vocabulary, codes: np.ndarray) -> np.ndarray:
    """Pieces of one long unit by the merges of ``merge``: the best union comes from a heap, the leftmost of equals.

    Work is the length times its logarithm, where a round for each merge would be the length squared.
    """
    length, mask, base = len(codes), (1 << 64) - 1, int(_BASE)
    power = [int(p) for p in _powers(vocab.longest)]
    prefix = [0]
    for c in codes.tolist():
        prefix.append((prefix[-1] * base + c) & mask)
    scores = vocab.scores.tolist()
    stop = list(range(1, length + 1))  # end of the piece that starts here; 0 where none does
    before = list(range(-1, length - 1))  # start of the piece to its left

    def place(start: int, end: int) -> int | None:
        size = end - start
        if size > vocab.longest:
            return None
        return vocab.place.get((prefix[end] - prefix[start] * power[size]) & mask)

    def offer(start: int, middle: int, end: int) -> None:
        at = place(start, end)
        if at is not None:
            heapq.heappush(unions, (-scores[at], start, middle, end))

    unions: list[tuple[float, int, int, int]] = []
    for start in range(length - 1):
        offer(start, start + 1, start + 2)
    while unions:
        _, start, middle, end = heapq.heappop(unions)
        if stop[start] != middle or stop[middle] != end:
            continue  # one of the two has been merged since
        stop[start], stop[middle] = end, 0
        if end < length:
            before[end] = start
            offer(start, end, stop[end])
        if before[start] >= 0:
            offer(before[start], start, end)
    out, start = [], 0
    while start < length:
        at = place(start, stop[start])
        out.append(-1 - int(codes[start]) if at is None else int(vocab.ids[at]))
        start = stop[start]
    return np.array(out, dtype=np.int32)


def _bytes_for_unknown(vocab: Vocabulary, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace unknown characters by the ids of their UTF-8 bytes."""
    unknown = np.flatnonzero(flat < 0)
    if not len(unknown):
        return flat, counts
    word = np.repeat(np.arange(len(counts)), counts)
    spelled = [vocab.byte_ids[list(chr(-1 - int(flat[i])).encode("utf-8", "replace"))] for i in unknown]
    counts = counts + np.bincount(word[unknown], [len(s) - 1 for s in spelled], len(counts)).astype(np.int64)
    parts, last = [], 0
    for i, s in zip(unknown, spelled, strict=True):
        parts += [flat[last:i], s]
        last = i + 1
    return np.concatenate([*parts, flat[last:]]), counts


def encode_words(vocab: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all words in order, and the number of ids of each."""
    codes = [np.frombuffer(w.encode("utf-32-le", "replace"), dtype=np.uint32) for w in words]
    owner, units = [], []
    for i, c in enumerate(codes):
        cut = [c]
        if len(c) > _LONG:
            pair = (c[:-1].astype(np.int64) << 21) | c[1:]
            at = np.minimum(np.searchsorted(vocab.pairs, pair), len(vocab.pairs) - 1)
            cut = np.split(c, np.flatnonzero(vocab.pairs[at] != pair) + 1)
        units += cut
        owner += [i] * len(cut)
    sizes = np.array([len(u) for u in units], dtype=np.int64)
    n_ids, found = np.zeros(len(units), dtype=np.int64), {}
    order = np.argsort(sizes, kind="stable")
    first = 0
    while first < len(order):
        size = sizes[order[first]]
        last = min(int(np.searchsorted(sizes[order], size, "right")), first + max(1, _CELLS // int(size)))
        chosen = order[first:last]
        if vocab.merges and size > _LONG:
            each = [merge_long(vocab, units[i]) for i in chosen]
            flat, counts = np.concatenate(each), np.array([len(e) for e in each], dtype=np.int64)
        else:
            search = merge if vocab.merges else viterbi
            flat, counts = search(vocab, np.stack([units[i] for i in chosen]))
        flat, counts = _bytes_for_unknown(vocab, flat, counts)
        n_ids[chosen] = counts
        found[first] = (chosen, flat, counts)
        first = last
    starts = np.concatenate([[0], np.cumsum(n_ids)])
    out = np.empty(int(starts[-1]), dtype=np.int32)
    for chosen, flat, counts in found.values():
        out[_ranges(starts[chosen], counts)] = flat
    return out, np.bincount(owner, n_ids, len(words)).astype(np.int64) if words else n_ids


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def split_words(text: str) -> list[str]:
    """Words with their leading space marks; no piece spans two of them."""
    if not text:
        return []
    parts = (SPACE + text.replace(" ", SPACE)).split(SPACE)[1:]
    out, marks = [], 0
    for part in parts:
        marks += 1
        if part:
            out.append(SPACE * marks + part)
            marks = 0
    return out + [SPACE * marks] * (marks > 0)


class Known:
    """Ids of the words that a task has met; forgets all of them beyond ``limit`` words or ``chars`` characters."""

    def __init__(self, vocab: Vocabulary, limit: int = 400_000, chars: int = 1 << 24):
        self.vocab, self.limit, self.chars = vocab, limit, chars
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.held = 0
        self.flat, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def find(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All known ids, and where those of each of the distinct ``words`` start and how many they are."""
        if len(self.place) + len(words) > self.limit or self.held > self.chars:
            self.clear()
        new = [w for w in words if w not in self.place]
        if new:
            self.held += sum(map(len, new))
            flat, counts = encode_words(self.vocab, new)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.flat, self.counts = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
        at = np.array([self.place[w] for w in words], dtype=np.int64)
        return self.flat, (np.cumsum(self.counts) - self.counts)[at], self.counts[at]


def encode_texts(known: Known, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all texts, and the number of ids of each; equal words are searched once."""
    words, n_words = [], []
    for t in texts:
        w = split_words(t)
        words += w
        n_words.append(len(w))
    if not words:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    inverse, distinct = pd.factorize(np.array(words, dtype=object))
    flat, starts, counts = known.find(list(distinct))
    ids = flat[_ranges(starts[inverse], counts[inverse])]
    text = np.repeat(np.arange(len(texts)), n_words)
    return ids, np.bincount(text, counts[inverse], len(texts)).astype(np.int64)


def decode_ids(vocab: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """UTF-8 of each text; its first space is the one that encoding put there."""
    sizes = vocab.starts[ids + 1] - vocab.starts[ids] if len(ids) else np.zeros(0, np.int64)
    raw = vocab.decoded[_ranges(vocab.starts[ids], sizes)] if len(ids) else np.zeros(0, np.uint8)
    text = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(np.bincount(text, sizes, len(counts)).astype(np.int64))
    data, out, start = raw.tobytes(), [], 0
    for end in ends:
        out.append(data[start + (data[start : start + 1] == b" ") : end])
        start = end
    return out


def encode_documents(docs: DataFrame, vocab: Vocabulary, batch_rows: int = 500) -> DataFrame:
    """doc_id, n_pieces, ids and round_trip of every row; decoding the ids gave the text again or not.

    A null or empty text has no ids and is its own round trip; a text that itself has the space mark
    U+2581 decodes to spaces, so it is none.  Null ids stay null, repeated rows repeat, other columns are
    not read, an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession, batch_rows)
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids, counts = encode_texts(known, texts)
            again = decode_ids(known.vocab, ids, counts)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                    pa.array([a == t.encode("utf-8", "replace") for a, t in zip(again, texts, strict=True)]),
                ],
                ["doc_id", "n_pieces", "ids", "round_trip"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    return rows.mapInArrow(run, ENCODED)
