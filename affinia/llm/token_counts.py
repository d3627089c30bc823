"""Token counts, with huge documents encoded in overlapping chunks.

A document of up to ``chunk`` characters is counted where it is. A longer one is
cut into chunks that overlap; the chunks are dealt over the cluster, each is
encoded with offsets, and each reports the starts of its pre-tokens inside the two
overlaps with the number of tokens before them. Neighbours are spliced at the first
start that both report.

Why such a start is stable: the pre-tokenizer reads from left to right and looks at
nothing before its position, so from a common start on both chunks read the same;
and the left chunk goes on beyond the start, so what ends there did not end for
want of text. Where two neighbours share no start (one unbroken word fills the
overlap), the document is encoded again with an overlap four times as wide; at last
one chunk is the whole document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import keyed_texts, map_texts
from affinia.llm.words import load, specification, word_ids
from affinia.sources.workspace import staged

CHUNK = 16_384
OVERLAP = 256
LIMIT = 2048

COUNTS = "doc_id long, n_bytes long, n_tokens long"
PIECES = "doc_id long, mark string, n_bytes long, place long, last boolean, start long, body string"
STARTS = "array<struct<at:bigint,before:bigint>>"


def pre_token_starts(encoding, whole: bool) -> list[tuple[int, int]]:
    """(offset, tokens before it) of every pre-token, without the last where text goes on."""
    marks, offsets = encoding.word_ids, encoding.offsets
    found = [
        (offsets[i][0], i)
        for i in range(len(marks))
        if marks[i] is None or i == 0 or marks[i] != marks[i - 1]
    ]
    return found if whole else found[:-1]


def splice(pieces: list[dict]) -> int | None:
    """Tokens of a document from its pieces in order; None where neighbours do not meet."""
    total, skipped = 0, 0
    for here, following in zip(pieces, pieces[1:], strict=False):
        head = {s["at"]: s["before"] for s in following["head"]}
        meeting = next((s for s in here["tail"] if s["at"] in head), None)
        if meeting is None or meeting["before"] < skipped:
            return None
        total += meeting["before"] - skipped
        skipped = head[meeting["at"]]
    return total + pieces[-1]["tokens"] - skipped


def _cut(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Overlapping pieces of every text (doc_id, text, mark), one row each."""
    kinds = pa.schema(
        [("doc_id", pa.int64()), ("mark", pa.string()), ("n_bytes", pa.int64()), ("place", pa.int64()),
         ("last", pa.bool_()), ("start", pa.int64()), ("body", pa.string())]
    )

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for doc_id, text, mark in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size = len(text.encode())
                # A piece whose overlap reaches the end is the last.
                starts = range(0, max(1, len(text) - overlap), chunk)
                rows = [
                    (doc_id, mark, size, k, s == starts[-1], s, text[s : s + chunk + overlap])
                    for k, s in enumerate(starts)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t.type) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                    schema=kinds,
                )

    return docs.mapInArrow(cut, PIECES)


def _encode(pieces: DataFrame, spec: str, chunk: int, overlap: int) -> DataFrame:
    schema = (
        f"doc_id long, mark string, n_bytes long, place long, tokens long, head {STARTS}, tail {STARTS}"
    )
    spot = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(spec)
        for batch in stream:
            counts, heads, tails = [], [], []
            for row in batch.to_pylist():
                made = tokenizer.encode(row["body"], add_special_tokens=False)
                starts = [(row["start"] + at, before) for at, before in pre_token_starts(made, row["last"])]
                end = row["start"] + chunk
                counts.append(len(made.ids))
                heads.append(
                    [dict(at=a, before=b) for a, b in starts if a < row["start"] + overlap]
                    if row["place"]
                    else []
                )
                tails.append([] if row["last"] else [dict(at=a, before=b) for a, b in starts if a >= end])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(counts, pa.int64()), pa.array(heads, spot), pa.array(tails, spot)],
                ["doc_id", "mark", "n_bytes", "place", "tokens", "head", "tail"],
            )

    return pieces.mapInArrow(encode, schema)


def _spliced(encoded: DataFrame) -> DataFrame:
    """Counts of documents; n_tokens is null where neighbours do not meet.

    Rows with the same id and text share their pieces and give one row each.
    """
    grouped = encoded.groupBy("doc_id", "mark", "n_bytes").agg(
        F.collect_list(F.struct("place", "tokens", "head", "tail")).alias("pieces")
    )

    def join(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            ids, marks, sizes, counts = [], [], [], []
            for row in batch.to_pylist():
                by_place = {p["place"]: p for p in row["pieces"]}
                times = len(row["pieces"]) // len(by_place)
                count = splice([by_place[k] for k in sorted(by_place)])
                ids += [row["doc_id"]] * times
                marks += [row["mark"]] * times
                sizes += [row["n_bytes"]] * times
                counts += [count] * times
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(marks, pa.string()), pa.array(sizes, pa.int64()),
                 pa.array(counts, pa.int64())],
                ["doc_id", "mark", "n_bytes", "n_tokens"],
            )

    return grouped.mapInArrow(join, "doc_id long, mark string, n_bytes long, n_tokens long")


def long_counts(docs: DataFrame, spec: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Counts of long texts by overlapping chunks, widened until all neighbours meet."""
    done = None
    waiting = keyed_texts(docs).withColumn("mark", F.sha2("text", 256))
    while True:
        pieces = _cut(waiting, chunk, overlap).repartition("doc_id", "place")
        counted = staged(_spliced(_encode(pieces, spec, chunk, overlap)), "counts")
        met = counted.where(F.col("n_tokens").isNotNull()).drop("mark")
        done = met if done is None else done.unionByName(met)
        apart = counted.where(F.col("n_tokens").isNull()).select(
            F.col("doc_id").alias("apart_id"), F.col("mark").alias("apart_mark")
        )
        if apart.isEmpty():
            return done
        overlap *= 4
        chunk = max(chunk, 2 * overlap)
        same = F.col("doc_id").eqNullSafe(F.col("apart_id")) & (F.col("mark") == F.col("apart_mark"))
        waiting = waiting.join(apart, same, "left_semi")


def token_counts(docs: DataFrame, tokenizer_path: str, *, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row, as the tokenizer counts the whole text.

    A missing text counts as empty and has no tokens. Repeated rows give one row
    each; an empty table gives an empty result; other columns are not looked at.
    The tokenizer must drop white space (see ``WordIds``).
    """
    spec = specification(tokenizer_path)
    plain = keyed_texts(docs)
    is_long = F.coalesce(F.char_length("text") > chunk, F.lit(False))

    def work(ids: list, texts: list) -> dict[str, list]:
        memo = word_ids(spec)
        data = [(t or "").encode() for t in texts]
        packed = memo.packed(data)
        return {
            "doc_id": ids,
            "n_bytes": [len(d) for d in data],
            "n_tokens": [len(p) // memo.kind.itemsize for p in packed],
        }

    short = map_texts(plain.where(~is_long), work, COUNTS)
    return short.unionByName(long_counts(plain.where(is_long), spec, chunk, overlap))
