"""Conversation structure repair: weighted LR parsing of role sequences with a graph-structured stack.

Grammar of a whole conversation, by role initials::

    conversation -> (empty) | turns | s turns        turns -> u a | turns u a

Rows are parsed with edits: keep, rerole, delete, insert.  All stacks with the same top state go on alike
(``turns`` is left-recursive, so what lies below a top never changes what may follow), hence equal tops are
merged and keep only the least (cost, audit).  Six tops are left, so the parse of a stretch of rows is a
table from entry top to exit top, and stretches combine in any grouping.  A conversation of any length is
therefore cut into stretches by a range sort, parsed in parallel from every entry, and only one small table
a stretch passes through the task that follows a conversation from end to end.

Audits are never compared as long texts: after the same rows two audits are equal or differ before either
ends (each row adds one letter, inserts stand before it), so ranks decide, and letters only within a row.

Rows: a null role or text is one space; a null conv_id is a conversation of its own; null turns come first.
Rows of one turn are ordered by role, then by digest of the text; rows equal in all of that are counted, not
repeated.  Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import every
from tidebook.session import settle

SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}

# The automaton of the grammar: shifts by (state, initial), reductions as symbols popped, gotos of ``turns``.
_SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (4, "u"): 6, (5, "u"): 6, (6, "a"): 7}
_REDUCE = {3: 2, 7: 3}
_GOTO = {0: 4, 1: 5}
_ACCEPT = {0, 4, 5}
# One stack for each top, as (state, stack below): the nodes of the shared stack.
_START = (0, None)
_STACKS = {0: _START, 1: (1, _START), 2: (2, _START), 4: (4, _START), 5: (5, (1, _START)), 6: (6, (4, _START))}
_RUN_ROWS = 4096
KEY = ["conv_id", "turn", "role", "digest"]


def _shifted(stack: tuple, initial: str) -> tuple | None:
    """The stack after a symbol and the reductions that it completes; None where it can't follow."""
    state = _SHIFT.get((stack[0], initial))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in _REDUCE:
        for _ in range(_REDUCE[stack[0]]):
            stack = stack[1]
        stack = (_GOTO[stack[0]], stack)
    return stack


def _inserted(stack: tuple) -> Iterator[tuple[int, tuple]]:
    """The stack itself, then with one and two inserted rows; more would only go round in the grammar."""
    yield 0, stack
    for count in (1, 2):
        stack = next(after for i in "ua" if (after := _shifted(stack, i)))
        yield count, stack


def _edits(top: int, initial: str) -> list[tuple[str, int, int]]:
    """Ways to take a row from a top: letters, cost, next top."""
    out = [("D", DELETE, top)]
    for count, stack in _inserted(_STACKS[top]):
        for letter, cost, target in (("K", 0, initial), ("R", REROLE, "u"), ("R", REROLE, "a")):
            after = _shifted(stack, target)
            if after:
                out.append(("I" * count + letter, count * INSERT + cost, after[0]))
    return out


_EDITS = {(top, initial): _edits(top, initial) for top in _STACKS for initial in "sua"}
_OTHER = {top: _edits(top, "") for top in _STACKS}


def _closing(top: int) -> int:
    """Rows to insert at the end so that the conversation is complete."""
    return next(count for count, stack in _inserted(_STACKS[top]) if stack[0] in _ACCEPT)


def parse_run(rows: list[tuple[str, int, bool, bool]], entry: int) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) of each exit top.

    ``rows`` are (initial, deletions, taken, truncated): rows that must go after (or instead of) the one taken.
    """
    frontier = {entry: (0, 0)}
    steps: list[tuple[dict[int, tuple[int, str]], int]] = []
    for initial, deletions, taken, truncated in rows:
        back: dict[int, tuple[int, str]] = {}
        if taken:
            best: dict[int, tuple[int, int, str, int]] = {}
            for top, (cost, rank) in frontier.items():
                for letters, extra, after in _EDITS.get((top, initial), _OTHER[top]):
                    late = CUT_SHORT if truncated and letters != "D" else 0
                    found = (cost + extra + late, rank, letters, top)
                    if after not in best or found < best[after]:
                        best[after] = found
            order = {audit: n for n, audit in enumerate(sorted({(b[1], b[2]) for b in best.values()}))}
            frontier = {top: (b[0], order[b[1], b[2]]) for top, b in best.items()}
            back = {top: (b[3], b[2]) for top, b in best.items()}
        if deletions:
            frontier = {top: (cost + DELETE * deletions, rank) for top, (cost, rank) in frontier.items()}
        steps.append((back, deletions))
    out = {}
    for top, (cost, _) in frontier.items():
        letters, at = [], top
        for back, deletions in reversed(steps):
            letters.append("D" * deletions)
            if back:
                at, taken_letters = back[at]
                letters.append(taken_letters)
        out[top] = (cost, "".join(reversed(letters)))
    return out


# Rows and their faults


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage by the checksum of ``conv_id:turn``, with ``copies`` for a repeated row."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        spaced("role").alias("role"),
        spaced("text").alias("text"),
        fate.alias("fate"),
    ).where("fate <> 0")
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("fate") == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"),
    )


def _with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.unhex(F.md5("text")))


def fault_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts: ``copies``, ``first`` (not seen in an earlier row), ``blank``, ``truncated``.

    Equal rows combine before any shuffle.  The first of equal (role, text) is the one with the least turn, so
    it comes from an aggregate whose result is united with the rows again: no join, no window over a hot key.
    """
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    distinct = (
        _with_digest(rows)
        .withColumns({"blank": solid == "", "truncated": ~F.right(solid, F.lit(1)).isin(".", "!", "?")})
        .groupBy(*KEY)
        .agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    )
    nulls_first = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = distinct.groupBy("conv_id", "role", "digest").agg(F.min(nulls_first)["turn"].alias("turn"))
    both = distinct.withColumn("first", F.lit(False)).unionByName(
        firsts.withColumn("first", F.lit(True)), allowMissingColumns=True
    )
    return both.groupBy(*KEY).agg(
        F.max("copies").alias("copies"),
        F.max("blank").alias("blank"),
        F.max("truncated").alias("truncated"),
        F.max("first").alias("first"),
    )


# Stretches of rows, parsed in parallel

_KEYS = "array<struct<turn:long,role:string,digest:binary,copies:long,taken:boolean>>"
_PARSE = "array<struct<entry:int,exit:int,cost:long,rank:int,audit:string>>"
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
_RUN = (
    f"conv_id long, run long, rows {_KEYS}, parse {_PARSE}, blank long, duplicate long, truncated long, illegal long, "
    "turns long, first_turn long, last_turn long, first_initial string, last_initial string"
)


def _pairs_illegal(initials: Iterable[tuple[str, int]]) -> int:
    """Neighbours that may not follow each other; a row of n copies is its own neighbour n - 1 times."""
    bad, last = 0, None
    for initial, copies in initials:
        bad += copies - 1 if initial + initial not in LEGAL else 0
        bad += last is not None and last + initial not in LEGAL
        last = initial
    return bad


def _run_record(conv_id: int | None, run: int, rows: list[dict], entries: Iterable[int]) -> dict:
    lines, counts = [], dict.fromkeys(_COUNTS, 0)
    for r in rows:
        r["taken"] = r["first"] and not r["blank"]
        lines.append((r["role"][:1], r["copies"] - r["taken"], r["taken"], r["truncated"]))
        counts["blank"] += r["copies"] if r["blank"] else 0
        counts["duplicate"] += 0 if r["blank"] else r["copies"] - r["taken"]
        counts["truncated"] += r["taken"] and r["truncated"]
    counts["illegal"] = _pairs_illegal((r["role"][:1], r["copies"]) for r in rows)
    known = [r["turn"] for r in rows if r["turn"] is not None]
    counts["turns"] = len(set(known))
    parses = {(e, x): found for e in entries for x, found in parse_run(lines, e).items()}
    rank = {audit: n for n, audit in enumerate(sorted({audit for _, audit in parses.values()}))}
    return {
        "conv_id": conv_id,
        "run": run,
        "rows": [{k: r[k] for k in ("turn", "role", "digest", "copies", "taken")} for r in rows],
        "parse": [
            {"entry": e, "exit": x, "cost": cost, "rank": rank[audit], "audit": audit}
            for (e, x), (cost, audit) in parses.items()
        ],
        **counts,
        "first_turn": known[0] if known else None,
        "last_turn": known[-1] if known else None,
        "first_initial": rows[0]["role"][:1],
        "last_initial": rows[-1]["role"][:1],
    }


def _batches(records: Iterator[dict], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for record in records:
        held.append(record)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def parsed_runs(faults: DataFrame) -> DataFrame:
    """Stretches of at most ``_RUN_ROWS`` rows in order, each parsed from the tops that it may be entered with.

    Rows are dealt by range, so a conversation may lie in many tasks; ``run`` rises with the order of its rows.
    """
    schema = _arrow(_RUN)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        task = TaskContext.get().partitionId() << 32
        rows: list[dict] = []
        at, number, entries = None, 0, tuple(_STACKS)
        for batch in batches:
            for row in batch.to_pylist():
                full = len(rows) == _RUN_ROWS
                if rows and (full or row["conv_id"] != at):
                    yield _run_record(at, task + number, rows, entries)
                    # Only the first stretch of a task, or one after a cut, can be entered midway.
                    entries = tuple(_STACKS) if row["conv_id"] == at else (0,)
                    rows, number = [], number + 1
                at = row["conv_id"]
                rows.append(row)
        if rows:
            yield _run_record(at, task + number, rows, entries)

    ordered = faults.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    return ordered.mapInArrow(lambda batches: _batches(records(batches), schema), _RUN)


# Whole conversations

_PATH = (
    "run long, entry int, exit int, closing int, last boolean, cost long, gaps long, blank long, duplicate long, "
    "truncated long, illegal long"
)


class _Thread:
    """Follows one conversation over its stretches by their tables."""

    def __init__(self) -> None:
        self.frontier = {0: (0, 0)}
        self.back: list[tuple[int, dict[int, int]]] = []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.least = self.most = self.initial = None

    def add(self, run: dict) -> None:
        best: dict[int, tuple[int, int, int, int]] = {}
        for p in run["parse"]:
            if p["entry"] in self.frontier:
                cost, rank = self.frontier[p["entry"]]
                found = (cost + p["cost"], rank, p["rank"], p["entry"])
                if p["exit"] not in best or found < best[p["exit"]]:
                    best[p["exit"]] = found
        order = {audit: n for n, audit in enumerate(sorted({b[1:3] for b in best.values()}))}
        self.frontier = {top: (b[0], order[b[1:3]]) for top, b in best.items()}
        self.back.append((run["run"], {top: b[3] for top, b in best.items()}))
        for name in _COUNTS:
            self.counts[name] += run[name]
        if self.initial is not None:
            self.counts["illegal"] += self.initial + run["first_initial"] not in LEGAL
        self.initial = run["last_initial"]
        if run["first_turn"] is not None:
            self.counts["turns"] -= self.most == run["first_turn"]
            self.least = run["first_turn"] if self.least is None else self.least
            self.most = run["last_turn"]

    def path(self) -> Iterator[dict]:
        """Entry and exit of each stretch, last one first; the counts stand with the last."""
        ends = [(c + INSERT * (n := _closing(t)), rank, "I" * n, t) for t, (c, rank) in self.frontier.items()]
        cost, _, closing, top = min(ends)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.counts["turns"]
        whole = {"last": True, "cost": cost, "gaps": gaps, **{k: self.counts[k] for k in _COUNTS[:-1]}}
        for run, back in reversed(self.back):
            yield {"run": run, "entry": back[top], "exit": top, "closing": len(closing), "last": False} | whole
            top, closing, whole = back[top], "", {}


def best_paths(runs: DataFrame) -> DataFrame:
    """The way of the cheapest repair through the stretches, and the counts of each conversation."""
    schema = _arrow(_PATH)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at, thread = None, None
        for batch in batches:
            for run in batch.to_pylist():
                if thread is None or run["conv_id"] != at:
                    if thread:
                        yield from thread.path()
                    at, thread = run["conv_id"], _Thread()
                thread.add(run)
        if thread:
            yield from thread.path()

    slim = F.transform("parse", lambda p: F.struct(*[p[k].alias(k) for k in ("entry", "exit", "cost", "rank")]))
    tables = runs.select("conv_id", "run", slim.alias("parse"), *[c for c in runs.columns if c not in ("conv_id", "run", "rows", "parse")])
    ordered = tables.repartition("conv_id").sortWithinPartitions("conv_id", "run")
    return ordered.mapInArrow(lambda batches: _batches(records(batches), schema), _PATH)


def _chosen(runs: DataFrame, paths: DataFrame) -> DataFrame:
    """Stretches with the audit of the way that is taken through them."""
    taken = F.filter("parse", lambda p: every([p["entry"] == F.col("entry"), p["exit"] == F.col("exit")]))
    audit = F.concat(F.get(taken, F.lit(0))["audit"], F.repeat(F.lit("I"), F.col("closing")))
    return runs.select("conv_id", "run", "rows", "parse").join(paths, "run").withColumn("audit", audit).drop("parse")


_EDIT = "conv_id long, run long, place long, edit string, role_to string, turn long, role string, digest binary"


def _edit_records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of the repaired conversation: what is kept, reroled or inserted, in order."""
    for batch in batches:
        for run in batch.to_pylist():
            stack, place, letters = _STACKS[run["entry"]], 0, iter(run["audit"])

            def row(edit: str, initial: str, source: dict) -> dict:
                nonlocal stack, place
                stack, place = _shifted(stack, initial), place + 1
                told = source.get("role") if edit == "K" else NAMES[initial]
                one = {"conv_id": run["conv_id"], "run": run["run"], "place": place, "edit": edit, "role_to": told}
                return one | {k: source.get(k) for k in ("turn", "role", "digest")}

            def wanted() -> str:
                return "a" if stack[0] in (2, 6) else "u"

            for source in run["rows"]:
                for copy in range(source["copies"]):
                    while (edit := next(letters)) == "I":
                        yield row("I", wanted(), {})
                    if edit != "D":
                        yield row(edit, source["role"][:1] if edit == "K" else wanted(), source)
            for _ in letters:
                yield row("I", wanted(), {})


def _repaired_rows(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    schema = _arrow(_EDIT)
    edits = chosen.select("conv_id", "run", "rows", "entry", "audit").mapInArrow(
        lambda batches: _batches(_edit_records(batches), schema, 4096), _EDIT
    )
    # Each text meets its one edit by key; nearly all keys are single rows, and equal rows combine first.
    sources = _with_digest(rows).select(*KEY, "text")
    kept = edits.where("edit <> 'I'").unionByName(sources, allowMissingColumns=True)
    named = ["run", "place", "edit", "role_to"]
    met = kept.groupBy(*KEY).agg(
        F.first("text", ignorenulls=True).alias("text"), *[F.first(c, ignorenulls=True).alias(c) for c in named]
    )
    new = edits.where("edit = 'I'").withColumn("text", F.lit(""))
    columns = ["conv_id", "run", "place", "edit", F.col("role_to").alias("role"), "text"]
    return met.where("run is not null").select(*columns).unionByName(new.select(*columns))


def _summaries(chosen: DataFrame) -> DataFrame:
    pieces = F.sort_array(F.collect_list(F.struct("run", "audit")))
    sums = ["cost", "gaps", "blank", "duplicate", "truncated", "illegal"]
    return chosen.groupBy("conv_id").agg(
        F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"), *[F.max(c).alias(c) for c in sums]
    )


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired messages (conv_id, run, place, edit, role, text; ordered by run and place) and one summary a conversation.

    ``rows`` have conv_id, turn, role, text and copies; no role or text is null.
    """
    runs = settle(parsed_runs(fault_rows(rows)), "role-runs")
    chosen = settle(_chosen(runs, best_paths(runs)), "role-paths")
    return _repaired_rows(rows, chosen), _summaries(chosen)


def text_digests(messages: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text``, newline-joined, of each conversation.

    A hash of one text has to see it in order, so the rows of a conversation stream through one task, which
    holds one batch of them at a time.
    """
    schema = _arrow("conv_id long, repaired_sha256 string")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        at, state = None, None
        for batch in batches:
            for conv_id, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")], strict=True):
                if state is None or conv_id != at:
                    if state is not None:
                        yield {"conv_id": at, "repaired_sha256": state.hexdigest()}
                    at, state = conv_id, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode("utf-8", "replace"))
        if state is not None:
            yield {"conv_id": at, "repaired_sha256": state.hexdigest()}

    ordered = messages.repartition("conv_id").sortWithinPartitions("conv_id", "run", "place").select("conv_id", "role", "text")
    return ordered.mapInArrow(lambda batches: _batches(records(batches), schema), "conv_id long, repaired_sha256 string")


def repair_digest(conversations: DataFrame) -> DataFrame:
    """The contract's row for every conv_id, from the repair of the damaged rows."""
    messages, summaries = repair(damaged(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id"))
    parts = ids.unionByName(summaries, allowMissingColumns=True).unionByName(
        text_digests(messages), allowMissingColumns=True
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    known = lambda c, other: F.coalesce(F.max(c), F.lit(other))
    return parts.groupBy("conv_id").agg(
        *[known(c, 0).cast("long").alias(c) for c in counts],
        known("audit", "").alias("audit"),
        known("repaired_sha256", hashlib.sha256().hexdigest()).alias("repaired_sha256"),
    )

