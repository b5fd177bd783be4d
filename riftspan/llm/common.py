"""What the operators of this subpackage share."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riftspan.session import reliable_checkpoint

#: Held-out fold: rows whose crc32(id as text) leaves no remainder are never learned from.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared checkpoint folder; cuts the lineage and survives lost executors."""
    return reliable_checkpoint(df)


def held_out(doc_id: str | Column) -> Column:
    """Whether a row belongs to the held-out fold; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % FOLDS == 0


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns; other columns, whatever their names, play no part."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def bounded_sample(rows: DataFrame, id_column: str, size: int) -> DataFrame:
    """About ``size`` rows chosen by a hash of their id, never more than twice as many; all rows if there are fewer."""
    every = max(1, rows.count() // size)
    return rows.filter(F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit(7)), F.lit(every)) == 0).limit(2 * size)


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int, *columns: str) -> DataFrame:
    """Rows of ``docs`` (the named columns) with the columns of ``labels``, about ``size`` of them, as a written table.

    The sample is drawn from the labels, so that no texts but its own are moved: at most ``2 * size`` ids are broadcast.
    """
    chosen = bounded_sample(labels, "doc_id", size)
    return stored(only(docs, "doc_id", *columns).join(F.broadcast(chosen), "doc_id"))


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def batch_of(schema: pa.Schema, **columns: Any) -> pa.RecordBatch:
    """A batch from columns given by name."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in schema], schema=schema)


def slices(texts: list[str], characters: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of about so many characters; a single longer text is a range of its own."""
    yield from ranges([len(t) for t in texts], characters)


def characters(batch: pa.RecordBatch, column: str) -> list[int]:
    """Code points of each text of a batch, without unpacking the texts; null counts as empty."""
    return pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_pylist()


def ranges(lengths: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose lengths add up to ``limit`` at most; a single longer row is a range of its own."""
    begin = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(lengths):
        yield begin, len(lengths)


def shared(spark: SparkSession, value: Any) -> Broadcast:
    """A broadcast of an object whose class executors need not be able to import; see :func:`opened`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(box: Broadcast) -> Any:
    """What :func:`shared` sent."""
    return pickle.loads(box.value)
