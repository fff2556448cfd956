"""Helpers that several training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from opinion_spark.session import checkpoint_dir
from opinion_spark.tables import Scratch, attach  # noqa: F401

#: ASCII white space; everything between it is a word.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder (nothing is created)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there; the table goes when the driver ends."""
    return Scratch(df.sparkSession, label).written(df, "table")


def crc_mod(key: str, n: int) -> Column:
    """Remainder of crc32 of the id's decimal text (null id: remainder of the empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


#: Bits of the hash by which rows are sampled.
SAMPLE_BITS = 62


def sample_hash(*columns: str) -> Column:
    """A whole number under 2**SAMPLE_BITS from a row's columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - SAMPLE_BITS)


def sample_cut(sample: int, n: int) -> int:
    """The bound under which about ``sample`` of ``n`` evenly spread hashes lie (all, if there are fewer)."""
    return (1 << SAMPLE_BITS) if n <= sample else max(1, (sample << SAMPLE_BITS) // n)


def map_text(rows: DataFrame, keep: list[str], text: Column, make, schema: str, at_once: int | None = None) -> DataFrame:
    """Columns ``keep`` of every row, unchanged, and what a function of its text returns.

    ``make()`` runs once a task and gives that function, which returns a tuple in
    the order of ``schema``. Kept columns pass through as Arrow data of any type.
    ``at_once``: rows held as Python objects at a time, where results are large (all of a batch by default).
    """
    body = "_text"
    while body in keep:
        body += "_"
    packed = rows.select(*keep, text.alias(body))
    new = StructType.fromDDL(schema)
    types = [(f.name, f.type) for f in to_arrow_schema(new)]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        of = make()
        parts = (b.slice(k, at_once or b.num_rows) for b in batches for k in range(0, b.num_rows, at_once or b.num_rows))
        for b in parts:
            got = [of(x) for x in b.column(b.num_columns - 1).to_pylist()]
            made = [pa.array([g[k] for g in got], kind) for k, (_, kind) in enumerate(types)]
            yield pa.RecordBatch.from_arrays(b.columns[:-1] + made, names=b.schema.names[:-1] + [n for n, _ in types])

    return packed.mapInArrow(run, StructType(packed.schema.fields[:-1] + new.fields))
