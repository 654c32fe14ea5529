"""Document fingerprints: every shingle hash below a fixed fraction of the hash space is kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm.common import ascii_lower, whole_text, words

SHINGLE = 3
FRACTION = 0.25
_BITS = 32  # hashes are kept as the upper half of 64 bits, 0 to 2**32 - 1


def with_sketch(
    rows: DataFrame, text_col: str, name: str, shingle: int = SHINGLE, fraction: float = FRACTION
) -> DataFrame:
    """Adds ``name``, the sorted hashes (bigint) of the text's distinct word shingles that are below ``fraction``.

    Words are lower-cased in A-Z; fewer words than a shingle make one shingle of all of them.  If no hash
    is low enough the smallest one is kept, so only a text without words has an empty sketch.  A sketch
    of a union is the ``merge`` of sketches.  Each step is a column of its own, so none is evaluated twice.
    """
    tokens, low = F.col(f"{name}_w"), F.col(f"{name}_low")

    def upper(h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - _BITS)

    many = F.transform(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - (shingle - 1), F.lit(0))),
        lambda w, i: upper(F.xxhash64(w, *[F.get(tokens, i + k) for k in range(1, shingle)])),
    )
    hashes = F.when(F.size(tokens) >= shingle, many).when(
        F.size(tokens) > 0, F.array(upper(F.xxhash64(F.array_join(tokens, " "))))
    )
    limit = int(fraction * (1 << _BITS))
    staged = (
        rows.withColumn(f"{name}_w", words(ascii_lower(F.col(text_col))))
        .withColumn(f"{name}_all", hashes)
        .withColumn(f"{name}_low", F.array_distinct(F.filter(f"{name}_all", lambda h: h < limit)))
    )
    kept = F.when(F.size(low) > 0, F.array_sort(low)).otherwise(
        F.filter(F.array(F.array_min(f"{name}_all")), lambda h: h.isNotNull())
    )
    return staged.withColumn(name, kept).drop(f"{name}_w", f"{name}_all", f"{name}_low")


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Sketch of the union of two shingle sets."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda h: h < int(fraction * (1 << _BITS)))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity; 1 for two empty sketches, 0 for one."""
    shared, total = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; 1 for an empty ``a``."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def fingerprint_string(kept: Column) -> Column:
    """Hexadecimal hashes, 8 digits each, in ascending order."""
    return F.array_join(F.transform(kept, lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))), "")


def with_next(
    docs: DataFrame,
    columns: list[str],
    prepare: Callable[[DataFrame], DataFrame],
    rows_per_bucket: int = 512,
    max_buckets: int = 10_000,
) -> DataFrame:
    """Adds ``next_<column>`` of the row that follows in descending ``doc_id``; the last row gets the first one's.

    Ids are cut into buckets at approximate quantiles, so that no task orders all rows; the first row of
    each bucket is also sent, as a guest, to the end of the bucket before.  ``prepare`` adds columns to
    the rows before they are ordered.  The order is total: null ids come last, equal ids go by text.
    A single row follows itself.
    """
    buckets = max(1, min(max_buckets, docs.count() // rows_per_bucket))
    cuts: list[int] = []
    if buckets > 1:
        shares = F.split(F.lit(",".join(str(i / buckets) for i in range(1, buckets))), ",").cast("array<double>")
        cuts = docs.select(F.percentile_approx("doc_id", shares, 20 * buckets)).first()[0] or []
    placed = docs.withColumn("_tie", F.xxhash64("text")).withColumn("_bucket", _rank(sorted(set(cuts))))
    me = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "_tie")
    heads = placed.groupBy("_bucket").agg(F.max(me).alias("_head"))
    # One row a bucket: max_buckets rows at most in these windows and in the broadcast below.
    everywhere = Window.partitionBy(F.lit(0))
    guests = heads.select(
        "_head",
        F.coalesce(
            F.lag("_bucket").over(everywhere.orderBy(F.desc("_bucket"))), F.min("_bucket").over(everywhere)
        ).alias("_to"),
    )
    guest_rows = (
        placed.withColumn("_me", me)
        .join(F.broadcast(guests), F.col("_me").eqNullSafe(F.col("_head")))
        .drop("_bucket", "_head", "_me")
        .dropDuplicates(["_to"])
        .withColumnRenamed("_to", "_bucket")
        .withColumn("_guest", F.lit(1))
    )
    everyone = prepare(placed.withColumn("_guest", F.lit(0)).unionByName(guest_rows))
    order = Window.partitionBy("_bucket").orderBy("_guest", F.col("doc_id").desc_nulls_last(), F.desc("_tie"))
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    return everyone.select("*", *following).where("_guest = 0").drop("_guest", "_bucket", "_tie")


def _rank(cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` are at or below ``doc_id`` (0 for null), by halving steps."""
    if not cuts:
        return F.lit(0)
    n = len(cuts)
    low = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")  # one folded constant
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= n) & (F.get(low, at + step - 1) <= F.col("doc_id")), at + step
        ).otherwise(at),
    )


def fingerprint_documents(docs: DataFrame, shingle: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """Fingerprint of each text and of its edited text, whose last third is the next document's beginning.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, kept
    (hashes in the fingerprint), within_edited, within_next (shares of this text's shingles that the other has)
    and holds_next (the reverse), one row for each row.  A null text counts as empty; null ids come
    last in the order; repeated ids are ordered by text; a lone row follows itself.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    pairs = with_next(
        rows, ["text", "_kept"], lambda part: with_sketch(part, "text", "_kept", shingle, fraction)
    )
    third = F.floor(F.length("text") / 3).cast("int")
    pairs = pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.concat(
            F.substring("text", F.lit(1), F.length("text") - third), F.substring("next_text", F.lit(1), third)
        ).alias("_edited"),
        "_kept",
        "next__kept",
    )
    pairs = with_sketch(pairs, "_edited", "_edited_kept", shingle, fraction)
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        fingerprint_string(F.col("_kept")).alias("fingerprint"),
        fingerprint_string(F.col("_edited_kept")).alias("edited_fingerprint"),
        likeness(F.col("_kept"), F.col("_edited_kept")).alias("near_edited"),
        likeness(F.col("_kept"), F.col("next__kept")).alias("near_next"),
        F.size("_kept").alias("kept"),
        containment(F.col("_kept"), F.col("_edited_kept")).alias("within_edited"),
        containment(F.col("_kept"), F.col("next__kept")).alias("within_next"),
        containment(F.col("next__kept"), F.col("_kept")).alias("holds_next"),
    )
