"""Arrow batches through a vectorised Python function, for what no built-in expresses."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Columns = Sequence[list]


def map_columns(
    df: DataFrame,
    columns: Sequence[str],
    make: Callable[[], Callable[..., Columns]],
    schema: str | StructType,
) -> DataFrame:
    """Rows made from ``columns`` of ``df``, batch by batch, without a shuffle.

    ``make`` runs once per task and gives the function that turns the columns of a batch (lists of
    Python values) into the columns of the result, which may have another number of rows. Only the
    named columns are read, so further columns with any name do no harm. Empty batches are skipped.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    picked = df.select(*[df[c] for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            out = work(*[column.to_pylist() for column in batch.columns])
            arrays = [
                values if isinstance(values, pa.Array) else pa.array(values, type=field.type)
                for values, field in zip(out, arrow, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return picked.mapInArrow(run, schema)
