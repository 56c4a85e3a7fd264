"""The last N rows of every key as stream state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class Ring(StatefulProcessor):
    """A map from slot to row, slot = ordinal modulo N: a new row takes the place of the oldest one.

    A micro-batch touches at most N slots of a key, whatever it brings: rows beyond the last N never reach the state. Output is
    the key's ring after the batch.
    """

    def __init__(self, n: int, key: str, order: str, columns: list[str], schema: str):
        self.n, self.key, self.order, self.columns, self.schema = n, key, order, columns, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getMapState("rows", "slot int", self.schema)
        self.next = handle.getValueState("next", "ordinal long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, came = None, 0
        for pdf in rows:  # never more than N and one frame at a time
            came += len(pdf)
            pdf = pdf if last is None else pd.concat([last, pdf])
            last = pdf.nlargest(self.n, self.order) if len(pdf) > self.n else pdf
        last = last.sort_values(self.order, kind="stable")
        first = self.next.get()[0] if self.next.exists() else 0
        ordinal = first + came - len(last)
        for row in last[self.columns].itertuples(index=False):
            self.rows.updateValue((ordinal % self.n,), tuple(v.item() if hasattr(v, "item") else v for v in row))
            ordinal += 1
        self.next.update((ordinal,))
        held = [tuple(v) for _, v in self.rows.iterator()]
        yield pd.DataFrame(held, columns=self.columns).assign(**{self.key: key[0]})[[self.key, *self.columns]]

    def close(self) -> None:
        pass


def last_rows_stream(stream: DataFrame, n: int, key: str, order: str) -> DataFrame:
    """The ring of every key that a micro-batch touches: its last ``n`` rows in order of ``order``, a column that grows from
    batch to batch. The newest output of a key replaces the ones before it."""
    if n < 1:
        raise ValueError("a ring holds one row at least")
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    fields = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    columns = [c for c in fields if c != key]
    schema = ", ".join(f"`{c}` {fields[c]}" for c in columns)
    return stream.groupBy(key).transformWithStateInPandas(
        Ring(n, key, order, columns, schema), outputStructType=f"`{key}` {fields[key]}, {schema}", outputMode="Update", timeMode="None")
