"""Token ids in files, coded by a static range asymmetric numeral system.

Layout of a folder (parquet as the container, so any store and a lost task are
Spark's business):

* ``frequencies``  token, frequency; the frequencies sum to 2 ** SCALE
* ``blocks``       part, block, first (tokens before it in the part), doc_ids,
  lengths, lanes, payload, checkpoints, payload_crc32, ids_crc32

Parts are ascending ranges of doc_id, blocks ascend in a part, and a block holds
whole documents. Token i of a block belongs to lane i mod lanes; each lane is a coder
of its own with 64-bit state, and all lanes share one stream of 32-bit words. A step
codes one token in every lane, as numpy operations over the lanes. The decoder's
states and its place in the words are kept every CHECK_STEPS steps, so the parts of
a block between checkpoints can be decoded independently; a checksum guards each
block's payload and its ids.

A first pass encodes all documents, writes their ids to the work area and counts them
there; a second orders them by range partitioning and codes each part in one stream of
rows. A task holds one batch of documents and one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinia.llm.common import map_texts, slices
from affinia.llm.words import load, specification, word_ids
from affinia.sources.workspace import fresh_path

SCALE = 20
LOWEST = np.uint64(1 << 31)
LANES = 2048
CHECK_STEPS = 256
BLOCK_TOKENS = 1 << 19

BLOCKS = (
    "part int, block int, first long, doc_ids array<bigint>, lengths array<bigint>, lanes int, "
    "payload binary, checkpoints array<struct<step:bigint,words:bigint,states:binary>>, "
    "payload_crc32 long, ids_crc32 long"
)
ROWS = "doc_id long, part int, start long, n_tokens long, ids_crc32 long"


def quantised(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies that sum to 2 ** scale, at least 1 for every counted token."""
    counts = counts.astype(np.float64)
    seen = counts > 0
    if not seen.any():
        return np.zeros(len(counts), np.int64)
    room = (1 << scale) - int(seen.sum())
    shares = counts * (room / counts.sum())
    made = np.where(seen, 1 + np.floor(shares), 0).astype(np.int64)
    rest = (1 << scale) - int(made.sum())
    order = np.argsort(-(shares - np.floor(shares)), kind="stable")[:rest]
    made[order] += 1
    return made


class Coder:
    """Encode and decode arrays of token numbers with one frequency table."""

    def __init__(self, frequencies: np.ndarray, scale: int = SCALE):
        self.scale = np.uint64(scale)
        self.mask = np.uint64((1 << scale) - 1)
        self.frequency = frequencies.astype(np.uint64)
        self.below = np.concatenate([[0], np.cumsum(frequencies)[:-1]]).astype(np.uint64)
        self.highest = self.frequency << np.uint64(63 - scale)
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)

    def encode(self, ids: np.ndarray, lanes: int) -> tuple[bytes, list[dict]]:
        """Payload (first states, then words in reading order) and checkpoints."""
        steps = -(-len(ids) // lanes)
        states = np.full(lanes, LOWEST, np.uint64)
        words: list[np.ndarray] = []
        marks: list[tuple[int, int, bytes]] = []
        written = 0
        for step in range(steps - 1, -1, -1):
            now = ids[step * lanes : (step + 1) * lanes]
            frequency = self.frequency[now]
            state = states[: len(now)]
            full = state >= self.highest[now]
            words.append(state[full].astype("<u4"))
            written += len(words[-1])
            state = np.where(full, state >> np.uint64(32), state)
            whole = state // frequency
            states[: len(now)] = (whole << self.scale) + (state - whole * frequency) + self.below[now]
            if step and step % CHECK_STEPS == 0:
                marks.append((step, written, states.astype("<u8").tobytes()))
        payload = states.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))
        checkpoints = [
            {"step": step, "words": written - after, "states": kept} for step, after, kept in reversed(marks)
        ]
        return payload, checkpoints

    def decode(self, payload: bytes, count: int, lanes: int, start: dict | None = None, stop: int | None = None) -> np.ndarray:
        """Ids of steps from a checkpoint (or the first) up to step ``stop`` (or the last)."""
        words = np.frombuffer(payload, "<u4", offset=8 * lanes)
        states = np.frombuffer(start["states"] if start else payload, "<u8", count=lanes).copy()
        place = start["words"] if start else 0
        first = start["step"] if start else 0
        steps = -(-count // lanes) if stop is None else stop
        made = np.empty(max(0, min(count, steps * lanes) - first * lanes), np.uint32)
        for step in range(first, steps):
            here = min(lanes, count - step * lanes)
            state = states[:here]
            slot = state & self.mask
            now = self.symbol[slot]
            state = self.frequency[now] * (state >> self.scale) + slot - self.below[now]
            low = np.flatnonzero(state < LOWEST)
            state[low] = (state[low] << np.uint64(32)) | words[place : place + len(low)]
            place += len(low)
            states[:here] = state
            made[(step - first) * lanes : (step - first) * lanes + here] = now
        return made


def packed_documents(docs: DataFrame, spec: str, end_id: int) -> DataFrame:
    """doc_id and ids (little-endian, as wide as the vocabulary needs) of every text."""

    def work(ids: list, texts: list) -> dict[str, list]:
        memo = word_ids(spec)
        end = np.array([end_id], memo.kind).tobytes()
        return {"doc_id": ids, "ids": [p + end for p in memo.packed([(t or "").encode() for t in texts])]}

    return map_texts(docs, work, "doc_id long, ids binary")


def count_tokens(packed: DataFrame, size: int, kind: str) -> DataFrame:
    """token, count over all documents; a task sends one row per token at most."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in (part for whole in stream for part in slices(whole)):
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["token", "count"]
        )

    counted = packed.select("ids").mapInArrow(count, "token int, count long")
    return counted.groupBy("token").agg(F.sum("count").alias("count"))


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Write the ids of every text, each followed by ``end_id``, in ascending doc_id order.

    A missing or empty text is its end id alone. Rows without a doc_id come first,
    rows of one doc_id in the order of their ids. An empty table writes no block;
    other columns are not looked at.
    """
    spec = specification(tokenizer_path)
    size = load(spec).get_vocab_size()
    kind = "<u2" if size <= 1 << 16 else "<u4"
    spark = docs.sparkSession
    place = fresh_path(spark, "packed")
    packed_documents(docs, spec, end_id).write.option("compression", "zstd").parquet(place)
    packed = spark.read.schema("doc_id long, ids binary").parquet(place)
    counts = np.zeros(size, np.int64)
    for row in count_tokens(packed, size, kind).collect():  # one row per token of the vocabulary
        counts[row["token"]] = row["count"]
    frequencies = quantised(counts)
    table = [(int(t), int(frequencies[t])) for t in np.flatnonzero(frequencies)]
    spark.createDataFrame(table, "token int, frequency int").coalesce(1).write.parquet(
        f"{path}/frequencies"
    )

    def code(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(frequencies)
        part = TaskContext.get().partitionId()
        block, first = 0, 0
        ids, parts, held = [], [], 0

        def close() -> pa.RecordBatch:
            tokens = np.concatenate(parts)
            lanes = max(1, min(LANES, len(tokens) // 64))
            payload, checkpoints = coder.encode(tokens, lanes)
            row = {
                "part": part, "block": block, "first": first, "doc_ids": ids,
                "lengths": [len(p) for p in parts], "lanes": lanes, "payload": payload,
                "checkpoints": checkpoints, "payload_crc32": crc32(payload),
                "ids_crc32": crc32(tokens.astype("<u4").tobytes()),
            }
            return pa.RecordBatch.from_pylist([row], schema=block_schema())

        for batch in (part for whole in stream for part in slices(whole)):
            for doc_id, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(doc_id)
                parts.append(np.frombuffer(data, kind))
                held += len(parts[-1])
                if held >= BLOCK_TOKENS:
                    yield close()
                    block, first = block + 1, first + held
                    ids, parts, held = [], [], 0
        if parts:
            yield close()

    ordered = packed.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(code, BLOCKS).write.parquet(f"{path}/blocks")


def block_schema() -> pa.Schema:
    mark = pa.struct([("step", pa.int64()), ("words", pa.int64()), ("states", pa.binary())])
    return pa.schema(
        [
            ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("lanes", pa.int32()),
            ("payload", pa.binary()), ("checkpoints", pa.list_(mark)),
            ("payload_crc32", pa.int64()), ("ids_crc32", pa.int64()),
        ]
    )


def read_coder(spark: SparkSession, path: str) -> Coder:
    rows = spark.read.parquet(f"{path}/frequencies").collect()  # bounded by the vocabulary
    frequencies = np.zeros(1 + max((r["token"] for r in rows), default=0), np.int64)
    for row in rows:
        frequencies[row["token"]] = row["frequency"]
    return Coder(frequencies)


def _decoded(row: dict, coder: Coder) -> np.ndarray:
    """Ids of one block, checked; the stretches between checkpoints are independent."""
    if crc32(row["payload"]) != row["payload_crc32"]:
        raise ValueError(f"payload of block {row['part']}/{row['block']} is damaged")
    count = sum(row["lengths"])
    stops = [c["step"] for c in row["checkpoints"]]
    starts = [None, *row["checkpoints"]]
    ids = np.concatenate(
        [coder.decode(row["payload"], count, row["lanes"], a, b) for a, b in zip(starts, [*stops, None], strict=True)]
    )
    if crc32(ids.astype("<u4").tobytes()) != row["ids_crc32"]:
        raise ValueError(f"ids of block {row['part']}/{row['block']} are damaged")
    return ids


def read_ids(spark: SparkSession, path: str, *, with_ids: bool = True) -> DataFrame:
    """Documents of a folder: doc_id, start, n_tokens, ids_crc32 and the ids themselves.

    ``start`` counts the ids of all documents before. ``with_ids=False`` leaves the
    ids out of the result; they are decoded and checked all the same.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    coder = read_coder(spark, path)
    schema = ROWS + (", ids binary" if with_ids else "")

    def decode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = _decoded(row, coder).astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                data = [ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array([row["part"]] * len(data), pa.int32()),
                    pa.array(starts + row["first"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array([crc32(d) for d in data], pa.int64()),
                ]
                names = ["doc_id", "part", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(data, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    # One row per part, so that both the ordering and the broadcast are bounded by
    # the number of tasks that wrote the folder.
    sizes = blocks.groupBy("part").agg(
        F.sum(F.expr("aggregate(lengths, 0L, (a, b) -> a + b)")).alias("size")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"))
    documents = blocks.mapInArrow(decode, schema).join(F.broadcast(offsets), "part")
    kept = [c for c in ("ids",) if with_ids]
    return documents.select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *kept
    )
