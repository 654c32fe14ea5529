"""Quotation linking: quoted passages are hashed, joined to the messages they come from, and taken out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm.common import ascii_lower, whole_text
from tidebook.session import settle

LEVELS = r"^(?:[\x20\t]*>)+"
WINDOW = 4
_KEY = ["conv_id", "turn"]
_ONE = [*_KEY, "tie"]


def parsed_lines(messages: DataFrame) -> DataFrame:
    """conv_id, turn, tie, role, own, quoted, said, passages and told of every message.

    A line's level is the number of > signs that lead it, blanks between them allowed; ``quoted`` has level
    and hash of each quoted line, ``said`` the hashes of own lines.  Neighbouring lines of one level are one
    passage; ``passages`` has level and hashes of the windows of ``WINDOW`` words (of all, if fewer) of the
    quoted ones, ``told`` the hashes of own ones, wherever lines end.  Lines of fewer words are windows too.  ``own`` joins the lines of level 0.
    """
    text = whole_text(F.col("text"))
    rows = messages.select(*_ONE, "role", F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n", -1).alias("_lines"))
    line = F.transform(
        "_lines",
        lambda t: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(t, LEVELS, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(t, LEVELS + r"[\x20]?", "").alias("body"),
        ),
    )
    rows = rows.withColumn("_levels", line)
    own = F.array_join(F.transform(F.filter("_levels", lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    first = F.filter(
        F.sequence(F.lit(0), F.size("_levels") - 1),
        lambda i: (i == 0) | (F.get("_levels", i)["level"] != F.get("_levels", i - 1)["level"]),
    )
    rows = rows.withColumn("_first", first)

    def passage(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("_first", k + 1), F.size("_levels"))
        lines = F.transform(F.slice("_levels", start + 1, end - start), lambda x: normal(x["body"]))
        lines = F.filter(lines, lambda t: t != "")
        short = F.filter(lines, lambda t: F.size(F.split(t, " ")) < WINDOW)
        words = F.split(F.array_join(lines, " "), " ")
        return F.struct(F.get("_levels", start)["level"].alias("level"), words.alias("words"), short.alias("short"))

    rows = rows.withColumn(
        "_passages", F.filter(F.transform("_first", passage), lambda x: F.get(x["words"], F.lit(0)) != "")
    )

    def windows(x: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(x["words"]) - (WINDOW - 1), F.lit(1)))
        cut = F.transform(starts, lambda i: F.array_join(F.slice(x["words"], i, F.lit(WINDOW)), " "))
        return F.array_distinct(F.transform(F.concat(cut, x["short"]), lambda t: F.xxhash64(t)))

    return rows.select(
        *_ONE,
        "role",
        F.transform(
            F.filter("_passages", lambda x: x["level"] > 0),
            lambda x: F.struct(x["level"].alias("level"), windows(x).alias("hashes")),
        ).alias("passages"),
        F.array_distinct(
            F.flatten(F.transform(F.filter("_passages", lambda x: x["level"] == 0), lambda x: windows(x)))
        ).alias("told"),
        F.regexp_replace(F.trim(own), r"\n{3,}", "\n\n").alias("own"),
        F.transform(
            F.filter("_levels", lambda x: (x["level"] > 0) & (normal(x["body"]) != "")),
            lambda x: F.struct(x["level"].alias("level"), F.xxhash64(normal(x["body"])).alias("hash")),
        ).alias("quoted"),
        F.array_distinct(
            F.transform(
                F.filter("_levels", lambda x: (x["level"] == 0) & (normal(x["body"]) != "")),
                lambda x: F.xxhash64(normal(x["body"])),
            )
        ).alias("said"),
    )


def normal(text: Column) -> Column:
    """Lower case in A-Z, runs of anything but letters and digits as one space."""
    return F.trim(F.regexp_replace(ascii_lower(text), r"[^\p{L}\p{N}]+", " "))


def link_quotes(messages: DataFrame, deepest: int | None = 1) -> DataFrame:
    """Every message with the message it replies to and its place in the reply order, without quotes.

    Returns conv_id, turn, tie, role, text (own lines), parent_turn, root_turn, depth, quote_levels, n_quoted,
    n_linked, links, passages and origin_conv.  A quoted line of a level up to ``deepest`` (None: any level)
    links to the latest earlier message of the same conversation that says it; ``links`` has level,
    origin_turn and n_lines of these, sorted.  ``passages`` has, for each quoted passage of these levels of
    which a window of words is found, level, number, n_windows, n_found and the origin's conversation and turn: the earlier message
    of the same conversation that most windows come from (the latest of equals), or else of another one.
    The parent is the message that most lines of the shallowest level with links link to, the latest of
    equals; at a level where no line links, windows do instead.  Without a parent, ``origin_conv`` is the
    smallest conversation that a passage comes from.  Sorting a conversation by root_turn, depth, turn puts
    every reply after its parent.

    Rows with the same conversation and turn are numbered by ``tie`` from 0, the greatest (role, text)
    first; replies go on from tie 0.  Null texts are empty messages; rows with a null conversation or turn
    link to nothing; other columns are not read; an empty table gives no rows.
    """
    whole = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    # A group has as many rows as messages claim one turn.
    same = Window.partitionBy(*_KEY).orderBy(F.struct("role", "text").desc())
    placed = whole.where("conv_id is not null and turn is not null").withColumn("tie", (F.row_number().over(same) - 1).cast("long"))
    placed = settle(parsed_lines(placed), "messages")
    near = F.lit(True) if deepest is None else F.col("level") <= deepest
    quotes = placed.select(*_ONE, F.explode("quoted").alias("q")).select(*_ONE, "q.level", "q.hash").where(near).distinct()
    said = placed.select(*_KEY, F.explode("said").alias("hash"))
    linked = quotes.join(_latest_before(quotes.select(*_KEY, "hash").distinct(), said), [*_KEY, "hash"])
    votes = settle(linked.groupBy(*_ONE, "level", "origin").agg(F.count(F.lit(1)).alias("n")), "links")

    number = [*_ONE, "level", "number"]
    quoted = placed.select(*_ONE, F.posexplode("passages").alias("number", "p")).where(
        F.lit(True) if deepest is None else F.col("p.level") <= deepest
    )
    asked = settle(
        quoted.select(*_ONE, "p.level", "number", F.size("p.hashes").alias("n_windows"), F.explode("p.hashes").alias("hash")), "asked"
    )
    told = placed.select(*_KEY, F.explode("told").alias("hash"))
    inside = asked.join(_latest_before(asked.select(*_KEY, "hash").distinct(), told), [*_KEY, "hash"])
    # Elsewhere: the first and the last message that tell a window; one of them is of another conversation, if any is.
    ends = told.groupBy("hash").agg(F.min(F.struct(*_KEY)).alias("low"), F.max(F.struct(*_KEY)).alias("high"))
    other = F.when(F.col("low.conv_id") != F.col("conv_id"), F.col("low")).when(F.col("high.conv_id") != F.col("conv_id"), F.col("high"))
    outside = asked.join(settle(ends, "origins"), "hash").withColumn("o", other).where("o is not null")
    found = (
        inside.select(*number, "n_windows", F.lit(0).alias("far"), F.col("conv_id").alias("from_conv"), F.col("origin").alias("from_turn"))
        .unionByName(
            outside.select(*number, "n_windows", F.lit(1).alias("far"), F.col("o.conv_id").alias("from_conv"), F.col("o.turn").alias("from_turn"))
        )
        .groupBy(*number, "n_windows", "far", "from_conv", "from_turn")
        .agg(F.count(F.lit(1)).alias("n_found"))
    )
    # The same conversation first, then the most windows, then the latest turn, or the smallest conversation elsewhere.
    late = F.when(F.col("far") == 0, -F.col("from_turn")).otherwise(F.lit(0))
    first = F.min(F.struct("far", (-F.col("n_found")).alias("fewer"), late.alias("late"), "from_conv", "from_turn"))
    passages = settle(found.groupBy(*number, "n_windows").agg(first.alias("b")), "passages")

    # The shallowest level first, lines before windows, then the most of them, then the latest turn.
    by_line = votes.select(*_ONE, "level", F.lit(0).alias("kind"), "n", "origin")
    by_window = passages.where("b.far = 0").select(
        *_ONE, "level", F.lit(1).alias("kind"), (-F.col("b.fewer")).alias("n"), F.col("b.from_turn").alias("origin")
    ).groupBy(*_ONE, "level", "kind", "origin").agg(F.sum("n").alias("n"))
    best = F.min(F.struct("level", "kind", (-F.col("n")).alias("fewer"), (-F.col("origin")).alias("behind")))["behind"]
    parents = by_line.unionByName(by_window).groupBy(*_ONE).agg((-best).alias("parent_turn"))
    # As many links and passages as the message has quoted lines, at most.
    link = F.struct("level", F.col("origin").alias("origin_turn"), F.col("n").alias("n_lines"))
    links = votes.groupBy(*_ONE).agg(F.sum("n").alias("n_linked"), F.sort_array(F.collect_list(link)).alias("links"))
    one = F.struct(
        "level", "number", "n_windows", (-F.col("b.fewer")).alias("n_found"), F.col("b.from_conv").alias("origin_conv"),
        F.col("b.from_turn").alias("origin_turn"),
    )
    traced = passages.groupBy(*_ONE).agg(F.sort_array(F.collect_list(one)).alias("passages"), F.min("b.from_conv").alias("origin_conv"))
    replies = settle(placed.select(*_ONE).join(parents, _ONE, "left").join(links.select(*_ONE, "n_linked"), _ONE, "left"), "parents")
    order = settle(reply_order(replies.where("tie = 0").drop("tie")), "order")
    above = order.select("conv_id", F.col("turn").alias("parent_turn"), F.col("root_turn").alias("up"), F.col("depth").alias("more"))
    others = replies.where("tie > 0").join(above, ["conv_id", "parent_turn"], "left").select(
        *_ONE, "parent_turn", F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.coalesce("up", "turn").alias("root_turn"),
        F.coalesce(F.col("more") + 1, F.lit(0)).alias("depth"),
    )
    order = order.withColumn("tie", F.lit(0).cast("long")).unionByName(others)
    nothing = F.lit(None).cast("long")
    no_links = F.expr("cast(array() as array<struct<level: int, origin_turn: bigint, n_lines: bigint>>)")
    no_passages = F.expr(
        "cast(array() as array<struct<level: int, number: int, n_windows: int, n_found: bigint, origin_conv: bigint, origin_turn: bigint>>)"
    )
    counted = [
        "role",
        F.col("own").alias("text"),
        F.coalesce(F.array_max(F.transform("quoted", lambda q: q["level"])), F.lit(0)).alias("quote_levels"),
        F.size("quoted").alias("n_quoted"),
    ]
    columns = [
        *_ONE, "role", "text", "parent_turn", "root_turn", "depth", "quote_levels", "n_quoted", "n_linked", "links", "passages",
        "origin_conv",
    ]
    done = placed.select(*_ONE, *counted).join(order, _ONE).join(links.drop("n_linked"), _ONE, "left").join(traced, _ONE, "left")
    done = done.withColumns(
        {
            "links": F.coalesce("links", no_links),
            "passages": F.coalesce("passages", no_passages),
            "origin_conv": F.when(F.col("parent_turn").isNull(), F.col("origin_conv")),
        }
    )
    loose = parsed_lines(whole.where("conv_id is null or turn is null").withColumn("tie", F.lit(0).cast("long")))
    rest = loose.select(
        *_ONE, *counted, nothing.alias("parent_turn"), F.col("turn").alias("root_turn"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("n_linked"), no_links.alias("links"), no_passages.alias("passages"), nothing.alias("origin_conv"),
    )
    return done.select(*columns).unionByName(rest.select(*columns))


def _latest_before(asked: DataFrame, said: DataFrame, fold: int = 64) -> DataFrame:
    """conv_id, turn, hash of ``asked`` with ``origin``, the latest earlier turn that said the line.

    Turns form a tree of ``fold`` branches.  At each level a turn looks at its earlier siblings only, so
    no group has more than two rows a branch, however long a conversation or frequent a line is.
    """
    span = said.agg(F.min("turn").alias("low"), F.max("turn").alias("high")).first()
    low, high = span["low"] or 0, span["high"] or 0
    found, size = None, 1
    while True:
        child, parent = F.floor((F.col("turn") - low) / size), F.floor((F.col("turn") - low) / (size * fold))
        where = ["conv_id", "hash", child.alias("child"), parent.alias("parent")]
        ask = asked.select("turn", *where)
        line = (
            said.select("turn", *where)
            .groupBy("conv_id", "hash", "child", "parent")
            .agg(F.max("turn").alias("last"))
            .withColumn("said", F.lit(True))
            .unionByName(
                ask.select("conv_id", "hash", "child", "parent")
                .distinct()
                .withColumns({"last": F.lit(None).cast("long"), "said": F.lit(False)})
            )
        )
        order = Window.partitionBy("conv_id", "hash", "parent").orderBy("child", "said")
        before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
        line = line.withColumn("origin", before).where("not said and origin is not null")
        level = ask.join(line.drop("last", "said", "parent"), ["conv_id", "hash", "child"]).select(*_KEY, "hash", "origin")
        found = level if found is None else found.unionByName(level)
        size *= fold
        if size > high - low:
            return found.groupBy(*_KEY, "hash").agg(F.max("origin").alias("origin"))


def reply_order(messages: DataFrame) -> DataFrame:
    """Adds root_turn and depth to conv_id, turn, parent_turn, n_linked by doubling jumps along parents."""
    jump = messages.withColumn("root_turn", F.coalesce("parent_turn", "turn")).withColumn(
        "depth", F.when(F.col("parent_turn").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long")
    )
    while True:
        above = jump.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("up"), F.col("depth").alias("more"))
        jump = settle(
            jump.join(above, ["conv_id", "root_turn"]).select(
                *_KEY, "parent_turn", "n_linked", F.col("up").alias("root_turn"), (F.col("depth") + F.col("more")).alias("depth"), "more"
            ),
            "replies",
        )
        if jump.where("more > 0").isEmpty():
            return jump.select(*_KEY, "parent_turn", F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "root_turn", "depth")
        jump = jump.drop("more")
