"""User functions over rows: the escape hatch for per-element code.

``map_rows`` is the analogue of a per-element function that emits zero or
more outputs.  It runs the user's function over Arrow batches as pandas
frames (``mapInPandas``), so Python is called once per batch, never per row.
Use it only for logic that Spark's built-in expressions cannot state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from tallyloom.session import ship_package

BatchFn = Callable[[pd.DataFrame], pd.DataFrame]
OutputsFn = Callable[[pd.DataFrame], Mapping[str, pd.DataFrame]]


def map_rows(df: DataFrame, fn: BatchFn, schema: StructType | str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of ``df``.

    ``fn`` receives a pandas frame holding some rows and returns a frame with
    the columns of ``schema``; it may return more or fewer rows than it got
    (0..n outputs per input).  It must not depend on batch boundaries.
    Executors need no installed copy of this package.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = fn(batch)
            if out is not None and len(out):
                yield out

    return df.mapInPandas(run, schema)


def outputs_schema(schemas: Mapping[str, StructType | str], tag: str = "tag") -> StructType:
    """``(tag, <output>, ...)``: one struct column per output."""
    if tag in schemas:
        raise ValueError(f"an output cannot be named like the tag column, {tag}")
    each = {name: StructType.fromDDL(s) if isinstance(s, str) else s for name, s in schemas.items()}
    return StructType([StructField(tag, StringType(), False), *[StructField(name, s) for name, s in each.items()]])


def map_outputs(df: DataFrame, fn: OutputsFn, schemas: Mapping[str, StructType | str], tag: str = "tag") -> DataFrame:
    """Apply a user function with several outputs to every Arrow batch of ``df``.

    ``fn`` receives a pandas frame and returns a frame per output, by name,
    each with the columns of its own schema and any number of rows; outputs
    left out get none, a name that ``schemas`` lacks fails the job.  The result
    has one row per emitted row, tagged with its output: its values are in the
    struct column of that name, the other structs are null.  So one pass over
    the input, and one write partitioned by the tag (``sinks.write_branches``),
    gives every output; ``output`` takes one of them.
    """
    ship_package(df.sparkSession)
    schema = outputs_schema(schemas, tag)
    whole = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            emitted = fn(batch.to_pandas(date_as_object=True))
            unknown = set(emitted) - set(whole.names[1:])
            if unknown:
                raise ValueError(f"no output is named {sorted(unknown)}")
            for name, rows in emitted.items():
                if rows is None or not len(rows):
                    continue
                own = whole.field(name).type
                values = [pa.array(rows[f.name], f.type, from_pandas=True) for f in own]
                columns = {
                    tag: pa.array([name] * len(rows), pa.string()),
                    name: pa.StructArray.from_arrays([v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v for v in values], fields=list(own)),
                }
                yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(rows), f.type)) for f in whole], schema=whole)

    return df.mapInArrow(run, schema)


def output(tagged: DataFrame, name: str, tag: str = "tag") -> DataFrame:
    """The rows of one output of ``map_outputs``, with the output's own columns."""
    return tagged.filter(tagged[tag] == name).select(f"`{name}`.*")
