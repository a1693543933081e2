"""Sorting rows that are nearly in order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Rows that wait to be sorted; rows that leave, oldest first, when that many wait.
BUFFER, EMIT = 1000, 500


def bounded_sort(df: DataFrame, keys: Sequence[str], arrival: Sequence[str], time: Sequence[str], buffer: int = BUFFER, emit: int = EMIT) -> DataFrame:
    """df with place (from 1): the order in which a group's rows leave a buffer that they enter in order of arrival.

    When buffer rows wait, the emit oldest by time leave; the rest follows at the end. A row that comes later than the buffer reaches
    leaves late, as in a feed that cannot wait for it; where nothing comes that late, the order is that of time. A group streams through its
    task, buffer rows at a time. Ties keep the order of arrival; null times come first.
    """
    rows = df.repartition(*keys).sortWithinPartitions(*keys, *arrival)
    by = [(t, "ascending") for t in time]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, place = None, None, 0

        def leave(n: int) -> pa.Table:
            nonlocal waiting, place
            # A stable order: the number of arrival breaks ties.
            numbered = waiting.append_column("_n", pa.array(range(len(waiting))))
            at = pc.sort_indices(numbered, sort_keys=[*by, ("_n", "ascending")], null_placement="at_start")
            out, waiting = waiting.take(at[:n]), waiting.take(at[n:].take(pc.sort_indices(at[n:])))
            out = out.append_column("place", pa.array(range(place + 1, place + 1 + len(out)), pa.int64()))
            place += len(out)
            return out

        for b in batches:
            table = pa.Table.from_batches([b])
            names = list(zip(*(table[k].to_pylist() for k in keys), strict=True))
            start = 0
            while start < len(table):
                stop = start
                if names[start] != key:
                    if waiting is not None and len(waiting):
                        yield from leave(len(waiting)).to_batches()
                    key, waiting, place = names[start], table.slice(0, 0), 0
                while stop < len(table) and names[stop] == key and len(waiting) + stop - start < buffer:
                    stop += 1
                waiting = pa.concat_tables([waiting, table.slice(start, stop - start)])
                start = stop
                if len(waiting) >= buffer:
                    yield from leave(emit).to_batches()
        if waiting is not None and len(waiting):
            yield from leave(len(waiting)).to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return rows.mapInArrow(sort, f"{fields}, place long")
