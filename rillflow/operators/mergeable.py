"""Users' own aggregates as mergeable states: only states travel, one per group and task, never a group's values."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups whose states a task holds before it hands them over.
GROUPS = 10_000


class Mergeable(NamedTuple):
    """start() is the empty state, update(state, values) takes a Series of valid values in, merge(a, b) joins two states,
    and finish(state) is the result, a number or None. States are pickled; merge must not depend on the order."""

    start: Callable[[], Any]
    update: Callable[[Any, pd.Series], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], float | None]


def aggregate(df: DataFrame, keys: list[str], value: str, functions: dict[str, Mergeable]) -> DataFrame:
    """keys and a double per function. Nulls are left out; a group without valid values has finish(start()). Each task
    turns its rows to a state per group; states of a group are then merged in one place."""
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_value"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def handed() -> pa.RecordBatch:
            columns = [pa.array(c, rows_schema.field(k).type) for k, c in zip(keys, zip(*held, strict=True), strict=True)]
            out = pa.RecordBatch.from_arrays([*columns, pa.array([pickle.dumps(s) for s in held.values()], pa.binary())], names=[*keys, "_state"])
            held.clear()
            return out

        rows_schema = None
        for batch in batches:
            rows_schema = batch.schema
            # Groups by number, so that nulls and any kind of key stay as they are.
            named = pa.Table.from_batches([batch]).append_column("_row", pa.array(range(batch.num_rows)))
            for key in named.group_by(keys, use_threads=False).aggregate([("_row", "list")]).to_pylist():
                at = tuple(key[k] for k in keys)
                values = batch.column("_value").take(pa.array(key["_row_list"])).drop_null().to_pandas()
                old = held.get(at) or [f.start() for f in functions.values()]
                held[at] = [f.update(s, values) if len(values) else s for f, s in zip(functions.values(), old, strict=True)]
            if len(held) >= GROUPS:
                yield handed()
        if held:
            yield handed()

    def merged(part: pd.DataFrame) -> pd.DataFrame:
        states = None
        for blob in part["_state"]:
            new = pickle.loads(blob)  # written by this job's own tasks
            states = new if states is None else [f.merge(a, b) for f, a, b in zip(functions.values(), states, new, strict=True)]
        made = {k: [f.finish(s)] for (k, f), s in zip(functions.items(), states, strict=True)}
        return part[keys].head(1).assign(**made)

    states = rows.mapInArrow(partial, f"{kinds}, _state binary")
    return states.groupBy(*keys).applyInPandas(merged, f"{kinds}, " + ", ".join(f"`{k}` double" for k in functions))
