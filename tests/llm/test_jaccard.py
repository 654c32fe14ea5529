from __future__ import annotations

import random

import pytest
from llm import helpers as h
from pyspark.sql import functions as F

from tidebook.llm import jaccard
from tidebook.llm.common import hash_sample
from tidebook.llm.components import components
from tidebook.llm.queries import op4_jaccard_regions

SF = "/root/testdata/sf0.01"


def plain_components(docs, k, percent):
    """(doc_id, n_shingles, component_id) of every row, by comparing all rows."""
    sets = [h.shingles(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if docs[i][0] is None or docs[j][0] is None or not a or not b:
                continue
            if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
                continue
            shared = len(a & b)
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                root[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return sorted((str(d), len(s), str(low.get(find(i)))) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True)))


def _rows(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def test_query_equals_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert _rows(op4_jaccard_regions(spark, SF)) == plain_components(docs, 3, 90)


@pytest.mark.parametrize("k,percent", [(1, 50), (2, 80), (3, 90), (5, 100)])
def test_chains_of_copies_equal_all_pairs(spark, monkeypatch, k, percent):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rng, docs = random.Random(k), []
    for group in range(12):
        text = [f"w{rng.randrange(60)}" for _ in range(rng.choice([3, 20, 60]))]
        for _ in range(15):
            docs.append((len(docs) if rng.random() > 0.1 else 3, " ".join(text)))
            text = list(text)
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = f"W{rng.randrange(60)}"
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert _rows(jaccard.jaccard_join(df, k, percent)) == plain_components(docs, k, percent)


def _star(rng, members, edits):
    """Copies of one text with ``edits`` words changed: most pairs lie just beyond the radius from each other."""
    base = [f"b{i}" for i in range(120)]
    out = []
    for _ in range(members):
        text = list(base)
        for at in rng.sample(range(120), edits):
            text[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("block,depth", [(256, 6), (20, 6)])
def test_star_of_copies_beyond_the_radius(spark, monkeypatch, block, depth):
    """Exact, and leaves return at most a forest a group however many pairs are near."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "DEPTH", depth)
    made = []
    leaf = jaccard._leaf_links

    def counted(cells, *rest):
        out = leaf(cells, *rest)
        made.append((out.count(), cells.count()))
        return out

    monkeypatch.setattr(jaccard, "_leaf_links", counted)
    rng = random.Random(11)
    docs = list(enumerate([*_star(rng, 90, 2), *_star(rng, 60, 3), *_star(rng, 30, 1)]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert _rows(jaccard.jaccard_join(df)) == plain_components(docs, 5, 80)
    if block == 256:
        links, held = made[0]
        assert links <= held


def test_possible_pairs_of_many_regions_are_compared_once(spark, monkeypatch):
    """Pairs just beyond the radius share many anchors; before, leaves got both sets once for each anchor."""
    held, leaf = [], jaccard._leaf_links

    def counted(cells, *rest):
        held.append(cells.count())
        return leaf(cells, *rest)

    monkeypatch.setattr(jaccard, "_leaf_links", counted)
    texts = []
    for pair in range(60):
        text = [f"p{pair}w{i}" for i in range(120)]
        texts.append(" ".join(text))
        for at in (20, 23, 70):  # 13 of 116 shingles
            text[at] = f"x{pair}y{at}"
        texts.append(" ".join(text))
    docs = list(enumerate([*texts, *(f"{t} tail" for t in texts[:20])]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert _rows(jaccard.jaccard_join(df)) == plain_components(docs, 5, 80)
    assert len({c for _, _, c in plain_components(docs, 5, 80)}) == 110  # ten pairs are joined by their tails
    assert held == [0]


def test_frequent_shingles_are_counted_over_all_documents(spark):
    """A phrase of documents that no sample of 10,000 holds; before, only such a sample was counted."""
    df = spark.range(11_000).selectExpr("id as doc_id", "concat('t', id, ' u', id, ' v', id) as text")
    inside = {r.doc_id for r in hash_sample(df, F.col("doc_id"), 10_000).collect()}
    outside = [i for i in range(11_000) if i not in inside][:6]
    six, four = (jaccard.shingle_sets([t.encode()], 3)[0][0] for t in ("of six documents", "of four documents"))
    phrase = F.when(F.col("doc_id").isin(outside[:4]), " of six documents and of four documents").when(
        F.col("doc_id").isin(outside), " of six documents"
    )
    df = df.withColumn("text", F.concat("text", F.coalesce(phrase, F.lit(""))))
    slots = {int(s) & 0xFFFFFFFF for s in jaccard.frequent_shingles(df, 3)}
    assert int(six) & 0xFFFFFFFF in slots and int(four) & 0xFFFFFFFF not in slots and len(slots) == 1
    assert len(jaccard.frequent_shingles(df.limit(0), 3)) == 0


def test_voronoi_cells_keep_every_link(spark):
    """Two linked documents are together in some cell, whatever the pivots."""
    rng = random.Random(4)
    sets = [set(rng.sample(range(40), rng.randrange(8, 25))) for _ in range(60)]
    sets += [s ^ set(rng.sample(range(40), 2)) for s in sets]

    def far(a, b):
        return 1 - len(sets[a] & sets[b]) / len(sets[a] | sets[b])

    pivots = [0, 25, 50, 99]
    large = spark.createDataFrame([(1, i, len(sets)) for i in range(len(sets))], "cell long, node long, m long")
    met = spark.createDataFrame(
        [(p, i, far(p, i)) for p in pivots for i in range(len(sets)) if i != p], "a long, b long, distance double"
    )
    chosen = spark.createDataFrame([(1, p) for p in pivots], "cell long, pivot long")
    for radius in (0.1, 0.3):
        cells = {}
        for r in jaccard._children(large, chosen, met, radius).collect():
            cells.setdefault(r.child, set()).add(r.node)
        linked = [(a, b) for a in range(len(sets)) for b in range(a) if far(a, b) <= radius]
        assert linked and all(any({a, b} <= c for c in cells.values()) for a, b in linked)


def test_one_of_each_keeps_different_texts_of_one_id(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text), (1, text), (1, "quite another text of six words"), (2, text + " tail"), (3, ""), (3, None), (None, text)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((str(r.doc_id), r.text or "") for r in jaccard.one_of_each(df).collect())
    assert got == sorted([("1", text), ("1", "quite another text of six words"), ("3", ""), ("None", text)])


def test_awkward(spark):
    docs = h.awkward(spark)
    assert _rows(jaccard.jaccard_join(docs)) == plain_components(h.AWKWARD, 5, 80)
    assert jaccard.jaccard_join(docs.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (300, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.label for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 300: 200}
