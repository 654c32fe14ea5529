"""Changelog of a change stream from keyed state: old images come from the state, not from the envelope.

The last image and log position of every symbol are kept.  An event at or before that position, one that
repeats the image, an update without a new image and a deletion of an unknown symbol give nothing; an
insert of a known symbol is an update, an update of an unknown one an insert.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidebook.operators.changes import DELETE, LOG_ORDER

OUTPUT = "symbol string, source_lsn long, kafka_offset long, row_kind string, image_json string"
_COLUMNS = ["symbol", "source_lsn", "kafka_offset", "row_kind", "image_json"]


def normalized(old: str | None, op: str, new: str | None) -> tuple[str | None, list[tuple[str, str]]]:
    """The image after an event, and its changelog rows (kind, image)."""
    if op == DELETE:
        return None, [("DELETE", old)] if old is not None else []
    if new is None or new == old:
        return old, []
    if old is None:
        return new, [("INSERT", new)]
    return new, [("UPDATE_BEFORE", old), ("UPDATE_AFTER", new)]


class ChangelogProcessor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "image string, source_lsn long, kafka_offset long")

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows), ignore_index=True).sort_values(LOG_ORDER, kind="stable")
        image, *place = self.last.get() if self.last.exists() else (None, None, None)
        place, out = tuple(place), []
        columns = [batch[c].tolist() for c in (*LOG_ORDER, "op", "after_json")]
        for lsn, offset, op, after in zip(*columns, strict=True):
            if place[0] is not None and (lsn, offset) <= place:
                continue
            place = (lsn, offset)
            image, found = normalized(image, op, after)
            out += [(key[0], lsn, offset, kind, body) for kind, body in found]
        self.last.update((image, *place))
        if out:
            yield pd.DataFrame(out, columns=_COLUMNS)

    def close(self) -> None:
        pass


def changelog_rows(audit: DataFrame) -> DataFrame:
    """Changelog rows of a stream of audit rows; a deletion is remembered by its position."""
    return (
        audit.select("symbol", "op", "after_json", *LOG_ORDER)
        .groupBy("symbol")
        .transformWithStateInPandas(
            statefulProcessor=ChangelogProcessor(), outputStructType=OUTPUT, outputMode="Append", timeMode="None"
        )
    )
