from __future__ import annotations

import dataclasses
import math
import random
import time

import numpy as np
import sentencepiece
from llm import helpers as h

from tidebook.llm import pieces
from tidebook.llm.queries import op10_sentence_pieces

SF = "/root/testdata/sf0.01"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
ODD = ["", " ", "  a  b ", "\n\n x\ty", "漢字 🙂 é\x00", "aaaaaaa" * 50, "x" * 3000, "no▁mark", "Tab\tand  many   spaces    "]


def _encode(vocab, texts):
    ids, counts = pieces.encode_texts(pieces.Known(vocab), texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])], ids, counts


def test_ids_equal_the_library():
    got, ids, counts = _encode(pieces.load_vocabulary(), ODD)
    assert got == [LIBRARY.encode(t) for t in ODD]
    back = pieces.decode_ids(pieces.load_vocabulary(), ids, counts)
    assert [b.decode() for b in back] == [t.replace("▁", " ") for t in ODD]


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op10_sentence_pieces(spark, SF).collect()
    assert len(rows) == len(texts)
    want = dict(zip(texts, LIBRARY.encode(list(texts.values())), strict=True))
    for r in rows:
        assert r.round_trip and r.ids == want[r.doc_id] and r.n_pieces == len(r.ids)
        assert LIBRARY.decode(r.ids) == texts[r.doc_id]


def _best(word, scores, unknown):
    """Highest sum over every segmentation."""
    if not word:
        return 0.0
    return max(
        (scores[word[:n]] if word[:n] in scores else unknown if n == 1 else -math.inf) + _best(word[n:], scores, unknown)
        for n in range(1, len(word) + 1)
    )


def test_viterbi_equals_exhaustive_search():
    rng = random.Random(5)
    vocab = pieces.load_vocabulary()
    rank = {i: k for k, i in enumerate(vocab.ids.tolist())}
    unigram = dataclasses.replace(
        vocab, merges=False, scores=np.random.default_rng(2).uniform(-12, -2, len(vocab.scores)), unknown_score=-30.0
    )
    text_of = {i: LIBRARY.id_to_piece(i) for i in vocab.ids.tolist()}
    scores = {t: float(unigram.scores[rank[i]]) for i, t in text_of.items()}
    words = ["".join(rng.choice("etaoinsh漢字") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    for word in words:
        flat, counts = pieces.viterbi(unigram, np.array([[ord(c) for c in word]], dtype=np.uint32))
        ids = flat.tolist()
        assert counts[0] == len(ids)
        assert "".join(text_of[i] if i >= 0 else chr(-1 - i) for i in ids) == word
        total = sum(float(unigram.scores[rank[i]]) if i >= 0 else -30.0 for i in ids)
        assert abs(total - _best(word, scores, -30.0)) < 1e-9
    got, ids, back_counts = _encode(unigram, [" ".join(words), "x" * 700])
    assert [b.decode() for b in pieces.decode_ids(unigram, ids, back_counts)] == [" ".join(words), "x" * 700]


def test_awkward(spark):
    docs, vocab = h.awkward(spark), pieces.load_vocabulary()
    rows = pieces.encode_documents(docs, vocab).collect()
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), LIBRARY.encode(t or "")) for i, t in h.AWKWARD)
    assert all(r.round_trip for r in rows)
    assert pieces.encode_documents(docs.limit(0), vocab).count() == 0


def test_known_words_are_forgotten_beyond_the_limit():
    known = pieces.Known(pieces.load_vocabulary(), limit=3)
    for text in ("a b c", "d e", "a b c"):
        ids, _ = pieces.encode_texts(known, [text])
        assert ids.tolist() == LIBRARY.encode(text) and len(known.place) <= 3


def test_known_words_are_forgotten_beyond_their_characters():
    known = pieces.Known(pieces.load_vocabulary(), chars=50)
    for text in ("=" * 80, "a b", "-" * 80, "a b"):
        ids, _ = pieces.encode_texts(known, [text])
        assert ids.tolist() == LIBRARY.encode(text) and len(known.place) <= 3


def test_a_heap_gives_the_merges_of_the_rounds():
    rng, vocab = random.Random(9), pieces.load_vocabulary()
    for letters in ("ab", "=-", "the andingo", "▁x漢🙂"):
        for _ in range(40):
            codes = np.array([ord(rng.choice(letters)) for _ in range(rng.randint(1, 60))], dtype=np.uint32)
            flat, counts = pieces.merge(vocab, codes[None, :])
            assert pieces.merge_long(vocab, codes).tolist() == flat.tolist() and counts[0] == len(flat)


def test_long_words_take_seconds():
    rng, vocab = random.Random(3), pieces.load_vocabulary()
    texts = ["=" * 200_000, "-=" * 50_000, "".join(rng.choice("etaoinshr") for _ in range(200_000)), "漢" * 30_000]
    start = time.monotonic()
    got, ids, counts = _encode(vocab, texts)
    assert time.monotonic() - start < 30
    assert got == [LIBRARY.encode(t) for t in texts]
    assert [b.decode() for b in pieces.decode_ids(vocab, ids, counts)] == texts
