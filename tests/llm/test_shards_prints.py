from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from llm import helpers as h
from pyspark.sql import functions as F

from tidebook.llm import fingerprint, sharding
from tidebook.llm.queries import op8_virtual_slots, op9_scaled_sketch

SF = "/root/testdata/sf0.01"


def _shards_ok(rows, docs, spread):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs
    )
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    assert max(load.values()) - min(load.values()) <= spread


def test_shards(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = op8_virtual_slots(spark, SF).collect()
    _shards_ok(rows, docs, 0.01 * sum(len(t.encode()) for _, t in docs) / 16)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_shards_awkward(spark):
    docs = h.awkward(spark)
    rows = sharding.shard_documents(docs, shards=2).collect()
    _shards_ok(rows, h.AWKWARD, 70_000)
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_map_grows_only_into_the_new_shard(spark, folder):
    sizes = {s: 1 + s * 7919 % 1000 for s in range(4096)}
    first = sharding.first_map(sizes)
    grown = sharding.edited_map(first, sizes, 17)
    moved = [(a, b) for a, b in zip(first, grown, strict=True) if a != b]
    assert moved and all(b == 16 for _, b in moved)
    load = Counter()
    for slot, shard in enumerate(grown):
        load[shard] += sizes[slot]
    assert max(load.values()) - min(load.values()) < 0.02 * sum(sizes.values()) / 17
    shrunk = sharding.edited_map(first, sizes, 15)
    assert max(shrunk) == 14
    sharding.store_map(spark, first, 0, folder)
    sharding.store_map(spark, grown, 1, folder)
    assert sharding.read_map(spark, 0, folder) == first and sharding.read_map(spark, 1, folder) == grown


def _edited(docs):
    """Edited text by position, for rows in descending id."""
    return [t[: len(t) - len(t) // 3] + docs[(i + 1) % len(docs)][1][: len(t) // 3] for i, (_, t) in enumerate(docs)]


def test_fingerprints(spark):
    docs = sorted(
        ((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True
    )
    rows = {r.doc_id: r for r in op9_scaled_sketch(spark, SF).collect()}
    assert len(rows) == len(docs)
    edited, by_text, error = _edited(docs), {}, []
    for i, (doc_id, text) in enumerate(docs):
        r = rows[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), h.sha(edited[i]))
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        a, b, c = h.shingles(text, 3), h.shingles(edited[i], 3), h.shingles(docs[(i + 1) % len(docs)][1], 3)
        if len(a | b) > 200:
            error.append(abs(len(a & b) / len(a | b) - r.near_edited))
            error.append(abs(len(a & c) / len(a | c) - r.near_next))
    assert sum(error) / len(error) < 0.03 and max(error) < 0.25


def test_next_row_over_many_buckets(spark):
    ids = [None, None, *range(0, 400, 3), 7, 7, 3, 10**12]
    docs = spark.createDataFrame([(i, f"text of {n}") for n, i in enumerate(ids)], "doc_id long, text string")
    rows = fingerprint.with_next(docs, ["doc_id"], lambda d: d, rows_per_bucket=5).collect()
    assert len(rows) == len(ids)
    after = Counter((r.doc_id, r.next_doc_id) for r in rows)
    order = sorted((i for i in ids if i is not None), reverse=True) + [None, None]
    assert after == Counter(zip(order, order[1:] + order[:1], strict=True))


def test_fingerprints_awkward(spark):
    docs = h.awkward(spark)
    rows = fingerprint.fingerprint_documents(docs).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in rows) == sorted((str(i), len(t or "")) for i, t in h.AWKWARD)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprint.fingerprint_documents(docs.limit(0)).count() == 0
    lone = fingerprint.fingerprint_documents(docs.where("doc_id = 8")).collect()
    assert len(lone) == 1 and lone[0].near_next == 1.0


def test_merged_sketch_is_sketch_of_union(spark):
    rows = spark.createDataFrame(
        [("a b c d e f g h i", "d e f g h i j k l m"), ("x", "a b c d"), ("", "p q"), ("", "")], "a string, b string"
    )
    staged = fingerprint.with_sketch(fingerprint.with_sketch(rows, "a", "ka"), "b", "kb")
    got = staged.select(fingerprint.merge(F.col("ka"), F.col("kb")).alias("m"), "ka", "kb").collect()
    for r in got:
        both = set(r.ka) | set(r.kb)
        low = sorted(x for x in both if x < fingerprint.FRACTION * 2**32)
        assert r.m == (low or sorted(both)[:1])


def test_map_is_stored_edited_and_read(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    first = sharding.shard_documents(docs, shards=8, maps=folder).collect()
    assert sharding.map_versions(spark, folder) == [0, 1] and {r.map_version for r in first} == {1}
    even, edited = sharding.read_map(spark, 0, folder), sharding.read_map(spark, 1, folder)
    assert Counter(even) == dict.fromkeys(range(8), sharding.SLOTS // 8) and even != edited
    assert all(edited[r.virtual_slot] == r.shard for r in first)
    # The same sizes move nothing; one more shard takes slots only into itself; one less gives its slots away.
    assert {r.map_version for r in sharding.shard_documents(docs, shards=8, maps=folder).collect()} == {1}
    grown = {r.doc_id: r for r in sharding.shard_documents(docs, shards=9, maps=folder).collect()}
    assert {r.map_version for r in grown.values()} == {2}
    moved = [r for r in first if grown[r.doc_id].shard != r.shard]
    assert moved and {grown[r.doc_id].shard for r in moved} == {8}
    shrunk = sharding.shard_documents(docs, shards=7, maps=folder).collect()
    assert {r.map_version for r in shrunk} == {3} and {r.shard for r in shrunk} == set(range(7))
    assert sharding.read_map(spark, 1, folder) == edited


def test_containment_of_unequal_texts(spark):
    words = [f"w{i * 7919 % 100_003}" for i in range(20_000)]
    whole = " ".join(words)
    pairs = [(" ".join(words[a : a + n]), whole) for a, n in [(0, 300), (500, 2_000), (9_000, 9_000)]]
    pairs += [(" ".join(words[:1_000] + [f"x{i}" for i in range(1_000)]), whole), ("", whole), ("other words here", whole)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a string, b string")
    staged = fingerprint.with_sketch(fingerprint.with_sketch(rows, "a", "ka"), "b", "kb")
    got = staged.select(
        "i",
        fingerprint.containment(F.col("ka"), F.col("kb")).alias("a_in_b"),
        fingerprint.containment(F.col("kb"), F.col("ka")).alias("b_in_a"),
    ).collect()
    for r in got:
        a, b = (h.shingles(t, 3) for t in pairs[r.i])
        assert abs(r.a_in_b - (len(a & b) / len(a) if a else 1.0)) < 0.06
        assert abs(r.b_in_a - len(a & b) / len(b)) < 0.03


def test_containment_columns(spark):
    rows = op9_scaled_sketch(spark, "/root/testdata/sf0.001").collect()
    docs = sorted(
        ((r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()), reverse=True
    )
    by_id, edited = {r.doc_id: r for r in rows}, _edited(docs)
    for i, (doc_id, text) in enumerate(docs):
        a, b, c = h.shingles(text, 3), h.shingles(edited[i], 3), h.shingles(docs[(i + 1) % len(docs)][1], 3)
        if min(len(a), len(b), len(c)) > 200:
            r = by_id[doc_id]
            assert abs(r.within_edited - len(a & b) / len(a)) < 0.25
            assert abs(r.within_next - len(a & c) / len(a)) < 0.25 and abs(r.holds_next - len(a & c) / len(c)) < 0.25
