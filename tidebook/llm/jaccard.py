"""Exact Jaccard join of shingle sets in metric space: regions, pivots, windows, recursion, exact leaves.

Jaccard distance is a metric, but unrelated documents are all at distance 1: cells around a few chosen
documents would hold everything.  The outermost regions are therefore the anchors, shingles of which
linked documents must share one.  In a region one document is the pivot and every other is compared with
it.  Regions whose documents are then in several components split into Voronoi cells around pivots of
different components; documents within the window of the triangle inequality are replicated, and documents
far from all pivots make a cell of their own.  Cells get new pivots while that at least halves the documents
outside the commonest component.  What is left are leaves, which compare exact sets block by block and return
a spanning forest of their links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm.common import bounded_batches, whole_text
from tidebook.llm.components import components
from tidebook.session import settle

LEAST_BITS = 512  # of a sketch
FREQUENT, FREQUENT_OF = 4, 10_000  # documents that make a shingle frequent
PIECE_CHARS, PIECES = 1 << 23, 4096  # text for a piece of the slots' range, and pieces at most
BLOCK = 512  # documents of each side of a leaf
FEW_PAIRS = 4  # possible pairs for a document of a cell, so that the cell ends as pairs
BROADCAST_NODES = 500_000
PIVOTS = 4  # of a split
DEPTH = 6  # rounds of pivots before cells become leaves whatever their size
SHRINK = 0.7  # a split must leave no cell larger than this share
_SLACK = 1e-9  # windows are a little wider than the arithmetic of doubles is wrong
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's ``k``-word shingles, words lower-cased in A-Z.

    Fewer words than ``k`` are one shingle; no words, an empty set.  All texts are hashed at once: a
    word's bytes are a polynomial summed by segment, its neighbours a second one.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    data = np.where((data >= 65) & (data <= 90), data + 32, data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
    first, stop = edge[::2], edge[1::2]
    if not len(first):
        return [np.zeros(0, np.uint64) for _ in texts]
    length = stop - first
    offset = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(offset, length)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(length.max()), _GOLD)]), dtype=np.uint64)
    letters = _mix(data[inside].astype(np.uint64) + np.uint64(1))
    word = _mix(np.add.reduceat(letters * power[place], offset) + length.astype(np.uint64))
    bounds = np.concatenate([[0], np.searchsorted(first, ends)])
    run = word.copy()
    for i in range(1, k):
        run[: len(word) - i] = _mix(run[: len(word) - i] * _GOLD + word[i:])
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(run[a : b - k + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for w in word[a:b]:
                whole = _mix(np.array([whole * _GOLD + w], dtype=np.uint64))[0]
            out.append(np.array([whole], dtype=np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def prefix_length(n: int, percent: int) -> int:
    """So many first shingles, in any order all sets share, meet those of every set linked to this one."""
    return n - -(-percent * n // 100) + 1


def frequent_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """Sorted slots (low 32 bits) of shingles that ``FREQUENT`` of ``FREQUENT_OF`` documents hold, and as many documents at least.

    All documents are counted: a batch sends the slots it holds with their counts, cut into pieces of the slots' range, and each
    piece is summed as a whole.  Frequent shingles move to the end of the shared order, which bears on speed, never on results.
    """
    size = docs.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("chars")).first()
    least = max(FREQUENT, -(-FREQUENT * size["rows"] // FREQUENT_OF))
    pieces = min(PIECES, 1 + (size["chars"] or 0) // PIECE_CHARS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.concatenate(shingle_sets(_texts(batch, 0), k)).astype(np.uint32)
            slots, times = np.unique(slots, return_counts=True)
            times = times.astype(np.uint32)
            ends = np.searchsorted(slots.astype(np.uint64) * np.uint64(pieces) >> np.uint64(32), np.arange(pieces + 1))
            full = np.flatnonzero(np.diff(ends))
            parts = [[a[ends[i] : ends[i + 1]].tobytes() for i in full] for a in (slots, times)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), *[pa.array(p, pa.binary()) for p in parts]], ["piece", "slots", "times"]
            )

    def most(held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        slots, times = (np.frombuffer(b"".join(p), np.uint32) for p in zip(*held, strict=True))
        order = np.argsort(slots, kind="stable")
        slots, first = np.unique(slots[order], return_index=True)
        found = slots[np.add.reduceat(times[order].astype(np.int64), first) >= least]
        return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64))], ["s"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            for piece, *part in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if piece != at and held:
                    yield most(held)
                    held = []
                at = piece
                held.append(tuple(part))
        if held:
            yield most(held)

    dealt = docs.select("text").mapInArrow(deal, "piece int, slots binary, times binary")
    dealt = dealt.repartition(pieces, "piece").sortWithinPartitions("piece")
    found = dealt.mapInArrow(count, "s long").toPandas()["s"].to_numpy(np.int64)
    return np.sort(found.astype(np.uint32))


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """row, doc_id, t (hash of the text), n, digest of the set (d1, d2), anchors and sketch of every document, written once."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            sets = shingle_sets(_texts(batch, 1), k)
            d1, d2, anchors, sketches = [], [], [], []
            for s in sets:
                d1.append(int(_mix(s).sum(dtype=np.uint64).astype(np.int64)))
                d2.append(int(_mix(s ^ _GOLD).sum(dtype=np.uint64).astype(np.int64)))
                if len(frequent) and len(s):
                    slots = s.astype(np.uint32)
                    at = np.minimum(np.searchsorted(frequent, slots), len(frequent) - 1)
                    late = frequent[at] == slots
                    order = np.concatenate([s[~late], s[late]])
                else:
                    order = s
                anchors.append(order[: prefix_length(len(s), percent)].astype(np.int64) if len(s) else s.astype(np.int64))
                sketches.append(parity_sketch(s))
            starts = np.concatenate([[0], np.cumsum([len(a) for a in anchors])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(d1, pa.int64()),
                    pa.array(d2, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate(anchors), pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                ["doc_id", "t", "n", "d1", "d2", "anchors", "sketch"],
            )

    schema = "doc_id long, t long, n long, d1 long, d2 long, anchors array<long>, sketch binary"
    made = docs.select("doc_id", "text", F.xxhash64("text").alias("t")).mapInArrow(run, schema)
    return settle(made.withColumn("row", F.monotonically_increasing_id()), "signatures")


def parity_sketch(shingles: np.ndarray) -> bytes:
    """Bits that tell whether an odd number of shingles fell on them; as many bits as shingles, about.

    A shingle that only one of two sets has flips one bit, so sketches differ in at most as many bits as
    the sets differ in shingles.  Halves of a sketch combined by xor are the sketch of half the size.
    """
    bits = max(LEAST_BITS, 1 << (max(len(shingles), 1).bit_length() - 1))
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(sketch: bytes, size: int) -> np.ndarray:
    parts = np.frombuffer(sketch, dtype=np.uint64).reshape(-1, size // 8)
    return np.bitwise_xor.reduce(parts, axis=0)


def _may_link(n: np.ndarray, sketch: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """False where lengths or sketches rule out a link of rows ``x`` with rows ``y``.

    A link leaves 100 * difference <= (100 - percent) * union and 2 * union = n_x + n_y + difference.
    """
    ok = percent * np.maximum(n[x], n[y]) <= 100 * np.minimum(n[x], n[y])
    inside = np.flatnonzero(ok)
    if not len(inside):
        return ok
    size = np.array([len(s) for s in sketch])
    common = np.minimum(size[x[inside]], size[y[inside]])
    for bits in np.unique(common):
        pair = inside[common == bits]
        rows, at = np.unique(np.concatenate([x[pair], y[pair]]), return_inverse=True)
        table = np.stack([_folded(sketch[r], int(bits)) for r in rows])
        step = max(1, (1 << 22) // int(bits))
        for k in range(0, len(pair), step):
            a, b = at[: len(pair)][k : k + step], at[len(pair) :][k : k + step]
            apart = np.bitwise_count(table[a] ^ table[b]).sum(axis=1, dtype=np.int64)
            p = pair[k : k + step]
            ok[p] = (100 + percent) * apart <= (100 - percent) * (n[x[p]] + n[y[p]])
    return ok


def exact_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, name: str) -> DataFrame:
    """node and its set, hashed again from the texts of just the ``wanted`` nodes, written once."""
    wanted = settle(wanted.distinct().join(nodes.select("node", "doc_id", "d1"), "node"), "wanted")
    if wanted.count() <= BROADCAST_NODES:  # else all texts would be shuffled
        wanted = F.broadcast(wanted)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(_texts(batch, 1), k)
            digest = batch.column(2).to_pylist()
            same = [int(_mix(s).sum(dtype=np.uint64).astype(np.int64)) == d for s, d in zip(sets, digest, strict=True)]
            keep = np.flatnonzero(same)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep)), pa.array([sets[i].tobytes() for i in keep], pa.binary())],
                ["node", "shingles"],
            )

    texts = docs.join(wanted, "doc_id").select("node", "text", "d1")
    return settle(texts.mapInArrow(gather, "node long, shingles binary").dropDuplicates(["node"]), name)


def _shared(x: bytes, y: bytes) -> tuple[int, int]:
    """Size of the intersection and of the union of two sets."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared, len(x) + len(y) - shared


def distances(pairs: DataFrame, pivots: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """a, b, exact Jaccard distance and whether they link, of distinct ``pairs``; written once.

    ``pivots`` holds the sets of a, ``sets`` those of b; Spark broadcasts the former while its file is small.
    """
    a, b = (t.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}")) for t, x in ((pivots, "a"), (sets, "b")))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            found = [_shared(x, y) for x, y in zip(p["set_a"], p["set_b"], strict=True)]
            yield pd.DataFrame(
                {
                    "a": p["a"],
                    "b": p["b"],
                    "distance": [1 - shared / union for shared, union in found],
                    "linked": [100 * shared >= percent * union for shared, union in found],
                }
            )

    schema = "a long, b long, distance double, linked boolean"
    met = pairs.join(b, "b").join(a, "a").select("a", "b", "set_a", "set_b")
    return settle(met.mapInPandas(measure, schema), name)


def pivot_links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) of a region's pivot and its documents that link, written once.

    Windows on lengths and sketches discard pairs before sets are made.
    """
    facts = nodes.select("node", "n", "sketch")
    a, b = (facts.select(*[F.col(c).alias(f"{c}_{x}") for c in facts.columns]) for x in "ab")
    near = pairs.join(a, F.col("a") == F.col("node_a")).join(b, F.col("b") == F.col("node_b"))

    def window(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            n, sketch = (np.concatenate([p[f"{c}_a"].to_numpy(), p[f"{c}_b"].to_numpy()]) for c in ("n", "sketch"))
            first = np.arange(len(p))
            yield p.loc[_may_link(n, sketch, first, first + len(p), percent), ["a", "b"]]

    near = settle(
        near.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInPandas(window, "a long, b long"), "pairs"
    )
    sets = exact_sets(near.select(F.col("a").alias("node")).union(near.select("b")), nodes, docs, k, "sets")
    return distances(near, sets, sets, percent, "links").where("linked").select("a", "b")


def _open(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """cell, node, label, m and main (the commonest label) of cells whose documents are in several components."""
    held = cells.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    held = settle(held.select("cell", "node", "label"), "held")
    by_label = held.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("m"))
    state = by_label.groupBy("cell").agg(
        F.sum("m").alias("m"), F.max_by("label", F.struct("m", "label")).alias("main"), F.count(F.lit(1)).alias("labels")
    )
    return settle(held.join(state.where("labels > 1").drop("labels"), "cell"), "open")


def _split_pivots(large: DataFrame) -> DataFrame:
    """cell and pivot: documents of ``PIVOTS`` different components of each cell, chosen by hash."""
    spread = F.xxhash64("label", F.lit(2))
    one = large.groupBy("cell", "label").agg(F.min_by("node", F.xxhash64("node", F.lit(3))).alias("pivot"))
    first = Window.partitionBy("cell").orderBy(spread, "label")
    return one.withColumn("at", F.row_number().over(first)).where(F.col("at") <= PIVOTS).select("cell", "pivot")


def _children(large: DataFrame, pivots: DataFrame, met: DataFrame, radius: float) -> DataFrame:
    """cell, node, child and m: the cells of a split with their replicated documents.

    Let x be linked to y, and q its nearest pivot at distance a < 1 - radius: then y is nearer than 1 to q, and at
    most 2 * radius farther from q than from its own nearest pivot.  Otherwise y is at 1 - 2 * radius or more from
    all pivots.  So y is in the cell of each pivot of the first kind, and in the far cell in the second case.
    """
    near = large.select("cell", "node", "m").join(pivots, "cell")
    near = near.join(met.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "distance"), ["pivot", "node"], "left")
    near = near.withColumn("distance", F.when(F.col("pivot") == F.col("node"), 0.0).otherwise(F.col("distance")))
    by_node = near.groupBy("cell", "node").agg(
        F.max("m").alias("m"),
        F.min("distance").alias("least"),
        F.collect_list(F.struct("pivot", "distance")).alias("seen"),
    )
    within = F.filter(
        "seen",
        lambda s: (s["distance"] <= F.col("least") + 2 * radius + _SLACK) & (s["distance"] < 1),
    )
    far = F.when(F.col("least") >= 1 - 2 * radius - _SLACK, F.array(F.lit(-1).cast("long"))).otherwise(
        F.expr("cast(array() as array<bigint>)")
    )
    cells = F.concat(F.transform(within, lambda s: s["pivot"]), far)
    return by_node.select("cell", "node", "m", F.explode(cells).alias("child"))


def _blocks(cells: DataFrame) -> DataFrame:
    """Documents outside the commonest component (side 1) dealt out to meet all documents of the cell (side 0) by blocks."""
    rest = cells.withColumn("stray", F.col("label") != F.col("main"))
    strays = rest.groupBy("cell").agg(F.sum(F.col("stray").cast("long")).alias("strays"))
    rest = rest.join(strays, "cell")
    blocks, folds = F.ceil(F.col("m") / BLOCK), F.ceil(F.col("strays") / BLOCK)
    spread = F.xxhash64("node")
    columns = ["cell", "node", "label", "stray", (F.col("m") <= BLOCK).alias("whole")]
    one = rest.select(
        *columns, F.lit(0).alias("side"),
        F.pmod(spread, blocks).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), folds - 1)).alias("fold"),
    )
    two = rest.where("stray").select(
        *columns, F.lit(1).alias("side"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), F.pmod(spread, folds).alias("fold"),
    )
    return one.union(two)


_KEYS = ["cell", "block", "fold"]


def _by_group(rows: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``work`` on the rows of whole groups; a group has about a block of each side, a task one batch and one group at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            last = (rows[_KEYS] == rows[_KEYS].iloc[-1]).all(axis=1).to_numpy() if len(rows) else np.zeros(0, bool)
            kept = rows[last]
            if not last.all():
                yield work(rows[~last].reset_index(drop=True))
        if kept is not None and len(kept):
            yield work(kept.reset_index(drop=True))

    return rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS, "side").mapInPandas(run, schema)


def _candidates(rows: pd.DataFrame, percent: int, chunk: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of side 0 and of side 1 that may link, in each group of sorted rows; all groups at once, in chunks of pairs."""
    start = (rows[_KEYS] != rows[_KEYS].shift()).any(axis=1).to_numpy()
    group = np.cumsum(start) - 1
    side = rows["side"].to_numpy()
    first, n_left = np.flatnonzero(start), np.bincount(group[side == 0], minlength=group[-1] + 1)
    node, label, n = (rows[c].to_numpy() for c in ("node", "label", "n"))
    stray, sketch = rows["stray"].to_numpy(), rows["sketch"].to_numpy()
    right = np.flatnonzero(side == 1)
    ends = np.cumsum(n_left[group[right]])
    at = 0
    while at < len(right):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + chunk, "right")))
        y = right[at:stop]
        counts = n_left[group[y]]
        begin = np.cumsum(counts) - counts
        x = np.repeat(first[group[y]] - begin, counts) + np.arange(int(counts.sum()))
        y = np.repeat(y, counts)
        ok = (label[x] != label[y]) & (~stray[x] | (node[x] < node[y]))
        x, y = x[ok], y[ok]
        ok = _may_link(n, sketch, x, y, percent)
        yield x[ok], y[ok]
        at = stop


def _joined(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``root``, the least place of each place's component, after the pairs of places ``x``, ``y`` are joined."""
    while True:
        a, b = root[x], root[y]
        if (a == b).all():
            return root
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _within_windows(cells: DataFrame, nodes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Documents that have a possible partner in their cell, by cell and node, and distinct possible pairs a, b.

    Lengths and sketches rule out the others.  Possible partners share most of their anchors, so they meet in many cells: a cell
    of one block is cut into the components of its possible pairs.  Those with few pairs for their documents end as pairs, each of
    which is compared once; the others are named by their documents, so the same documents from many cells are one cell.
    """

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        place = rows.groupby([*_KEYS, "node"], sort=False).ngroup().to_numpy()  # one of both sides
        first = np.unique(place, return_index=True)[1]
        cell, node, whole = (rows[c].to_numpy()[first] for c in ("cell", "node", "whole"))
        root, near, others = np.arange(len(first)), [], []
        seen = np.zeros(len(first), bool)
        for x, y in _candidates(rows, percent):
            x, y = place[x], place[y]
            seen[x] = seen[y] = True
            root = _joined(root, x, y)
            near.append(x[whole[x]])
            others.append(y[whole[x]])
        x, y = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (near, others))
        few = np.bincount(root[x], minlength=len(root)) <= FEW_PAIRS * np.bincount(root[seen], minlength=len(root))
        name = np.zeros(len(root), np.uint64)
        np.add.at(name, root, _mix(node.astype(np.uint64) + np.uint64(1)))
        pairs, held = few[root[x]], np.flatnonzero(seen & ~(whole & few[root]))
        a, b = node[x[pairs]], node[y[pairs]]
        dense = pd.DataFrame({"cell": np.where(whole, name[root].astype(np.int64), cell)[held], "node": node[held]})
        sparse = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
        return pd.concat([dense, sparse]).astype("Int64").drop_duplicates()[["cell", "node", "a", "b"]]

    facts = nodes.select("node", "n", "sketch")
    picked = _by_group(_blocks(cells).join(facts, "node"), pick, "cell long, node long, a long, b long")
    picked = settle(picked.distinct(), "within")
    return picked.where("a is null").select("cell", "node"), picked.where("a is not null").select("a", "b")


def _leaf_links(cells: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """A spanning forest of the links of each leaf; leaves beyond ``BLOCK`` documents meet block by block."""

    def forest(rows: pd.DataFrame) -> pd.DataFrame:
        node, held = rows["node"].to_numpy(), rows.groupby([*_KEYS, "node"], sort=False)["shingles"].transform("first").to_numpy()
        # Components inside each group: documents of one label are joined from the start.
        root, found = rows.groupby([*_KEYS, "label"], sort=False).ngroup().to_numpy().copy(), []
        for near, others in _candidates(rows, percent):
            for x, y in zip(near.tolist(), others.tolist(), strict=True):
                if root[x] == root[y]:
                    continue
                shared, union = _shared(held[x], held[y])
                if 100 * shared >= percent * union:
                    found.append((min(node[x], node[y]), max(node[x], node[y])))
                    root[root == root[x]] = root[y]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    facts = nodes.select("node", "n", "sketch").join(sets, "node")
    # In a cell of one block both sides are in one group, and one of them brings the set.
    once = F.when(~F.col("whole") | (F.col("side") == 0), F.col("shingles"))
    met = _blocks(cells).join(facts, "node").withColumn("shingles", once)
    return settle(_by_group(met, forest, "a long, b long"), "links")


def _open_links(regions: DataFrame, labels: DataFrame, links: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """All links that regions with several components lack, up to a spanning forest."""
    radius = 1 - percent / 100
    cells = _open(regions.select(F.col("region").alias("cell"), "node"), labels)
    cells, pairs = _within_windows(cells, nodes, percent)
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    sets = exact_sets(cells.select("node").union(ends), nodes, docs, k, "open-sets")
    found = distances(pairs, sets, sets, percent, "distances").where("linked").select("a", "b")
    if not found.isEmpty():
        links = links.union(found)
        labels = components(links)
    cells = _open(cells, labels)
    before = None
    for depth in range(DEPTH):
        strays = cells.where("label <> main").count()
        if not strays or (before is not None and strays > before / 2):
            break
        before = strays
        pivots = settle(_split_pivots(cells), "pivots")
        ends = settle(pivots.select(F.col("pivot").alias("node")).distinct().join(sets, "node"), "pivot-sets")
        # Small cells need no cells of their own, only the links that join their components.
        large = F.col("m") > BLOCK
        own = labels.select(F.col("node").alias("pivot"), F.col("label").alias("own")).join(pivots, "pivot", "right")
        pairs = cells.join(own, "cell").where(
            (F.col("node") != F.col("pivot")) & (large | (F.col("label") != F.coalesce("own", "pivot")))
        )
        pairs = settle(pairs.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
        met = distances(pairs, ends, sets, percent, "distances")
        links = links.union(met.where("linked").select("a", "b"))
        labels = components(links)
        split = settle(_children(cells.where(large), pivots, met, radius), "split")
        sizes = split.groupBy("cell", "child").agg(F.count(F.lit(1)).alias("child_m"), F.max("m").alias("m"))
        # A cell that would not shrink stays as it is; its new labels close it or leave fewer strays.
        whole = sizes.groupBy("cell").agg((F.max("child_m") > SHRINK * F.max("m")).alias("whole"))
        whole = settle(whole, "whole")
        parts = split.join(whole.where("not whole"), "cell").select(
            F.xxhash64("cell", "child", F.lit(depth)).alias("cell"), "node"
        )
        kept = cells.join(whole.where("not whole"), "cell", "left_anti").select("cell", "node")
        cells = _open(kept.union(parts), labels)
    cells, pairs = _within_windows(cells, nodes, percent)
    links = links.union(distances(pairs, sets, sets, percent, "distances").where("linked").select("a", "b"))
    cells = _open(cells, labels)
    return links.union(_leaf_links(cells, nodes, sets, percent))


def joined_rows(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, t, n, label and component_id of every row; rows of one component share ``label``, null where it is none."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    rows = signatures(docs, k, percent)
    able = rows.where("n > 0 and doc_id is not null")
    classes = settle(able.groupBy("d1", "d2").agg(F.min("row").alias("node"), F.min("doc_id").alias("smallest")), "classes")
    picked = rows.select(F.col("row").alias("node"), "doc_id", "n", "anchors", "sketch")
    nodes = settle(picked.join(classes, "node"), "nodes")

    held = nodes.select("node", F.explode("anchors").alias("region"))
    regions = held.groupBy("region").agg(
        F.count(F.lit(1)).alias("m"),
        F.bit_xor(F.xxhash64("node")).alias("s1"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("s2"),
        F.min("node").alias("pivot"),
    )
    # Regions of the same documents are one.
    regions = regions.where("m > 1").groupBy("m", "s1", "s2").agg(F.min("region").alias("region"), F.min("pivot").alias("pivot"))
    regions = settle(regions.select("region", "pivot"), "regions")
    regions = settle(held.join(regions, "region"), "members")

    pivots = regions.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = pivot_links(pivots, nodes, docs, k, percent)
    links = _open_links(regions, components(links), links, nodes, docs, k, percent)
    labels = components(links)

    labelled = nodes.select("node", "smallest", "d1", "d2").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    labelled = settle(labelled, "labelled")
    smallest = settle(labelled.groupBy("label").agg(F.min("smallest").alias("component_id")), "smallest")
    sets = settle(labelled.join(smallest, "label").select("d1", "d2", "label", "component_id"), "sets")
    known = able.select("doc_id", "t", "n", "d1", "d2").join(sets, ["d1", "d2"]).drop("d1", "d2")
    alone = rows.where("n = 0 or doc_id is null").select(
        "doc_id", "t", "n", F.lit(None).cast("long").alias("label"), F.col("doc_id").alias("component_id")
    )
    return known.unionByName(alone)


def jaccard_join(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: components of 100 * intersection >= percent * union.

    ``component_id`` is the smallest doc_id of the component.  A null or empty text, or one without
    words, has no shingles and is its own component; so is a row without id, whose component is null.
    Equal sets, also of repeated rows, are one node.  Only doc_id and text are read; an empty table gives
    no rows.  Sets are compared as 64-bit hashes; no pair of documents is left out.
    """
    return joined_rows(docs, k, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text, lang, source and n_chars of one document of each component: the least id, then the least text hash.

    Documents without shingles and rows without id stay; rows with the same id and text count once (the least by
    the other columns), different texts under one id are told apart.
    """
    columns = ["text", "lang", "source", "n_chars"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)
    rows = joined_rows(docs, k, percent).where("doc_id is not null")
    chosen = rows.where("label is not null").groupBy("label").agg(F.min(F.struct("doc_id", "t")).alias("k"))
    kept = chosen.select("k.doc_id", "k.t").union(rows.where("label is null").select("doc_id", "t")).distinct()
    hashed = docs.withColumn("t", F.xxhash64(whole_text(F.col("text"))))
    first = hashed.join(kept, ["doc_id", "t"], "left_semi").groupBy("doc_id", "t").agg(F.min(F.struct(*columns)).alias("d"))
    return first.select("doc_id", *[f"d.{c}" for c in columns]).unionByName(docs.where("doc_id is null"))
