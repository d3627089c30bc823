"""Shared readers and small helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII blanks: a word is a run of anything else.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table, read by Spark from any store it can reach."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only, so that other columns never clash with results."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


#: Rows that Python holds as objects at a time; Spark's own batches are larger.
SLICE = 512


def slices(batch: pa.RecordBatch, rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def map_texts(
    docs: DataFrame, work: Callable[[list, list], dict[str, list]], schema: str
) -> DataFrame:
    """Apply ``work(doc_ids, texts)`` to every Arrow batch; it returns columns by name.

    ``work`` sees whole texts, ``SLICE`` rows at a time; a missing text stays ``None``.
    """
    names = [part.split()[0] for part in schema.split(",")]
    types = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
        "string": pa.string(), "binary": pa.binary(),
    }
    fields = [(p.split()[0], types[p.split()[1]]) for p in schema.split(",")]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema(fields)
        for batch in stream:
            for part in slices(batch):
                made = work(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[n], type=arrow.field(n).type) for n in names], schema=arrow
                )

    return keyed_texts(docs).mapInArrow(batches, schema)


#: Pieces of the bitmap of ``perhaps_among``; each has 32,768 bits in 4 KB.
BITMAPS = 1024


def perhaps_among(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` (a fingerprint) is not in ``wanted``.

    A bitmap of BITMAPS * 4 KB, whatever the size of the data, is broadcast, so the rows
    are spared a shuffle; a join with ``wanted`` has to decide on what is left. Uses
    DataFrame functions only. Rows without a key are left out.
    """
    slots = BITMAPS * 32_768
    piece = F.expr(f"pmod({key}, {BITMAPS})").alias("piece_")
    bit = F.expr(f"bitmap_bit_position(pmod({key}, {slots}) div {BITMAPS} + 1)").alias("bit_")
    bitmaps = wanted.select(piece, bit).groupBy("piece_").agg(F.expr("bitmap_construct_agg(bit_)").alias("bits_"))
    at = F.expr(f"pmod({key}, {slots}) div {BITMAPS}").alias("at_")
    held = "cast(conv(hex(substring(bits_, cast(at_ div 8 as int) + 1, 1)), 16, 10) as bigint)"
    met = rows.select("*", piece, at).join(F.broadcast(bitmaps), "piece_")
    return met.where(F.expr(f"(shiftright({held}, cast(at_ % 8 as int)) & 1) = 1")).select(rows.columns)
