"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import functools
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package()
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: Column) -> Column:
    """A missing text counts as an empty one."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D, in order."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def hash_sample(docs: DataFrame, key: Column, bound: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by the hash of ``key``: the same rows on every run.

    The expected size is min(rows, bound); no row moves.
    """
    rows = docs.count()
    if rows <= bound:
        return docs
    scale = 1 << 40
    return docs.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(scale)) < int(scale * bound / rows))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(items: Column, n: Column) -> Column:
    """``n`` > 0 items in slices of about the square root of their number."""
    size = F.ceil(F.sqrt(n)).cast("int")
    return F.transform(F.sequence(F.lit(1), n, size), lambda i: F.slice(items, i, F.least(size, n - i + 1)))


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start, end, value>>`` in code points.

    The pieces between matches and the matches themselves alternate, so positions are running sums of
    their lengths: within slices first, then over the slices.  Work is linear in the text, and in the number
    of matches to the power of one and a half.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # One gap more than matches: the last piece has no value.
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        found,
        lambda gap, value: F.struct(F.length(gap).alias("gap"), F.length(value).alias("n"), value.alias("value")),
    )
    none = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")

    def step(seen: Column, piece: Column) -> Column:
        start = seen["at"] + piece["gap"]
        end = start + piece["n"]
        one = F.struct(start.alias("start"), end.alias("end"), piece["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(seen["out"], F.array(one)).alias("out"))

    def moved(block: Column, by: Column) -> Column:
        return F.transform(
            block["out"],
            lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["value"].alias("value")),
        )

    def joined(blocks: Column) -> Column:
        before = F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("starts")),
            lambda seen, block: F.struct(
                (seen["at"] + block["at"]).alias("at"), F.concat(seen["starts"], F.array(seen["at"])).alias("starts")
            ),
            lambda seen: seen["starts"],
        )
        return F.flatten(F.zip_with(blocks, before, moved))

    def placed(pieces: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return once(F.transform(_blocks(pieces, F.size(pieces) - 1), lambda block: F.aggregate(block, empty, step)), joined)

    return F.when(text.rlike(pattern), once(pieces, placed)).otherwise(none)


def named_spans(spans: Column, kind: str, rank: int, score: Column | None = None) -> Column:
    """Spans with their kind; the field order is the sort order."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            s["value"].alias("value"),
        ),
    )


def span_string(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def apart(spans: Column, others: Column) -> Column:
    """Those spans that overlap none of ``others``, which are sorted by start: slices out of reach are passed over."""

    def outside(blocks: Column) -> Column:
        return F.filter(
            spans,
            lambda s: ~F.exists(
                blocks,
                lambda b: (b["low"] < s["end"])
                & (s["start"] < b["high"])
                & F.exists(b["held"], lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])),
            ),
        )

    def bounded(block: Column) -> Column:
        return F.struct(
            F.array_min(F.transform(block, lambda o: o["start"])).alias("low"),
            F.array_max(F.transform(block, lambda o: o["end"])).alias("high"),
            block.alias("held"),
        )

    def cut(held: Column) -> Column:
        return once(F.transform(_blocks(held, F.size(held)), bounded), outside)

    return F.when(F.size(others) == 0, spans).otherwise(once(others, cut))


def every(columns: list[Column]) -> Column:
    return functools.reduce(lambda a, b: a & b, columns)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lower the rows of an Arrow batch, so that a Python worker holds few whole texts at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))
