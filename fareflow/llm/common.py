"""What the operators share: words, columns, batches and written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fareflow.session import new_folder

#: The white space that separates words; bytes.split() splits at exactly these.
BLANKS = "\t\n\x0b\x0c\r "
#: A word, as a pattern of Spark and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts of a batch are handled in slices of about this many bytes.
SLICE_BYTES = 2 * 1024**2


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again: an executor lost later costs nothing."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(taken: Iterable[str], wanted: str) -> str:
    """A column name that no column has yet, whatever the case of its letters."""
    names = {x.lower() for x in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def slices(batch: pa.RecordBatch, text_column: str) -> Iterator[pa.RecordBatch]:
    """The batch in parts that hold few bytes of text, each row whole."""
    sizes = pc.binary_length(batch.column(text_column)).fill_null(0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, Sequence]]],
    added: str,
    drop: Sequence[str] = (),
    text: str = "text",
) -> DataFrame:
    """Adds the columns ``added`` (DDL) and drops ``drop``.

    ``make`` runs once in each task and returns the function that computes the new columns of a
    batch. Columns of the input that have a new column's name are replaced.
    """
    new = T.StructType.fromDDL(added)
    taken = {f.name.lower() for f in new} | {x.lower() for x in drop}
    kept = [f for f in df.schema if f.name.lower() not in taken]
    schema = T.StructType(kept + list(new))
    arrow = to_arrow_schema(new)
    names = [f.name for f in kept]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part in slices(batch, text):
                got = compute(part)
                columns = [part.column(n) for n in names]
                columns += [x if isinstance(x := got[f.name], pa.Array) else pa.array(x, f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, names + arrow.names)

    return df.mapInArrow(run, schema)


def struct(**columns: T.DataType) -> T.StructType:
    """A schema of nullable columns that needs no session."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def emit(schema: T.StructType, rows: dict[str, Sequence]) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in arrow], schema=arrow)
