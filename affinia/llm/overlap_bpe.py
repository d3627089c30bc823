"""Byte-level BPE by ranks, with long texts pre-tokenised in overlapping chunks.

A text of up to ``chunk`` characters is encoded where it is. A longer one is cut into
chunks that overlap and are dealt over the cluster. Each chunk is pre-tokenised on its
own and reports the starts of pre-tokens inside its two overlaps. Neighbours are stitched
at the first start that both report, so each chunk owns the text between two stitches;
these pieces are encoded in parallel and their ids put in order. Where neighbours share no
start (an unbroken run fills the overlap), their pieces become one.

A start is reported only where it is one in every text that holds the two characters
around it: no match of the pattern goes from a letter or a number to another kind of
character, or from a sign to a number or a blank, and what ends at such a place has no
blank before it, so the pattern's look ahead at blanks stays inside. A piece therefore
splits as it does in the whole text. Characters whose kind the two pattern libraries see
differently are found by asking both for every character; no start is reported beside one.

Ids are joined per row of the table, not per doc_id, so repeated rows do not meet.
Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.common import keyed_texts, map_texts, slices
from affinia.sources.workspace import staged

CHUNK = 16_384
OVERLAP = 256

CHUNKS = "row long, doc_id long, place long, last boolean, start long, body string"
MARKS = "row long, place long, start long, last boolean, head array<long>, tail array<long>"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
KINDS = (r"\p{L}", r"\p{N}", r"\s")


def every_character() -> str:
    return "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))


@cache
def disputed() -> str:
    """Characters that the library's patterns and ours do not see as the same kind."""
    every, bytes_only = every_character(), {bytes([b]): b for b in range(256)}
    found: set[str] = set()
    for kind in KINDS:
        library = tiktoken.Encoding("kind", pat_str=kind, mergeable_ranks=bytes_only, special_tokens={})
        theirs = library.decode_bytes(library.encode_ordinary(every)).decode()
        found |= set(theirs) ^ set(regex.findall(kind, every))
    return "".join(sorted(found))


def character_class(characters: str) -> str:
    """A pattern for any one of ``characters`` (ascending), as ranges."""
    if not characters:
        return r"[^\s\S]"
    codes = np.array([ord(c) for c in characters])
    runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1)
    return "[" + "".join(rf"\U{r[0]:08x}-\U{r[-1]:08x}" for r in runs) + "]"


class RankCodec:
    """Encode and decode by a file of ranks (lines of base64 and rank) and a pattern.

    ``avoided`` are the characters of ``disputed``.
    """

    def __init__(self, ranks: str, pattern: str, avoided: str):
        merges = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines())}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.pre_tokens = regex.compile(pattern, regex.V1)
        beside = character_class(avoided)
        self.certain = regex.compile(
            rf"(?<!{beside})(?!{beside})(?:(?<=\p{{L}})(?=\P{{L}})|(?<=\p{{N}})(?=\P{{N}})"
            r"|(?<=[^\s\p{L}\p{N}])(?=[\s\p{N}]))"
        )

    def encode(self, text: str) -> np.ndarray:
        return self.library.encode_to_numpy(text, disallowed_special=())

    def decode(self, ids: np.ndarray) -> bytes:
        return self.library.decode_bytes(ids.tolist())

    def starts(self, text: str, head: int, tail: int) -> tuple[list[int], list[int]]:
        """Starts of pre-tokens before ``head`` and from ``tail`` on that are starts in any text around."""
        found = np.array([m.start() for m in self.pre_tokens.finditer(text)], np.int64)
        certain = self.certain.match
        ends = found[(found > 0) & (found < head)], found[found >= tail]
        return tuple([p for p in part.tolist() if certain(text, p)] for part in ends)


_codecs: dict[int, RankCodec] = {}


def rank_codec(files: tuple[str, str, str]) -> RankCodec:
    key = hash(files)
    if key not in _codecs:
        _codecs[key] = RankCodec(*files)
    return _codecs[key]


def rank_files(ranks_path: str, pattern: str) -> tuple[str, str, str]:
    """What a codec is made of, as text that travels with the tasks."""
    return Path(ranks_path).read_text(), pattern, disputed()


def chunks_of(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Overlapping chunks of every text, a row each, written once; ``row`` names the text."""
    kinds = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("last", pa.bool_()),
         ("start", pa.int64()), ("body", pa.string())]
    )

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # A chunk whose overlap reaches the end is the last.
                starts = range(0, max(1, len(text) - overlap), chunk)
                columns = (
                    [row] * len(starts), [doc_id] * len(starts), range(len(starts)),
                    [s == starts[-1] for s in starts], starts, [text[s : s + chunk + overlap] for s in starts],
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds
                )

    keyed = keyed_texts(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return staged(keyed.mapInArrow(cut, CHUNKS).repartition("row", "place"), "chunks")


def marks_of(chunks: DataFrame, files: tuple[str, str, str], chunk: int, overlap: int) -> DataFrame:
    """Starts of pre-tokens in the two overlaps of every chunk, counted from the text's begin."""

    def mark(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = rank_codec(files)
        for batch in (part for whole in stream for part in slices(whole)):
            heads, tails = [], []
            for start, body in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                head, tail = codec.starts(body, overlap, chunk)
                heads.append([start + p for p in head])
                tails.append([start + p for p in tail])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(4), batch.column(3),
                 pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                ["row", "place", "start", "last", "head", "tail"],
            )

    return chunks.mapInArrow(mark, MARKS)


def spans_of(marks: DataFrame, chunk: int) -> DataFrame:
    """(row, place, piece, lone, first, past): what every chunk owns of its body, and of which piece."""
    order = Window.partitionBy("row").orderBy("place")
    met = marks.withColumn("meet", F.array_min(F.array_intersect("tail", F.lead("head").over(order))))
    told = met.select(
        "row", "place",
        F.coalesce(F.lag("meet").over(order) - F.col("start"), F.lit(0)).alias("first"),
        # The last chunk owns all to its end; one without a meeting stops where the next begins.
        F.when(~F.col("last"), F.coalesce(F.col("meet") - F.col("start"), F.lit(chunk))).alias("past"),
        F.lag("meet").over(order).isNotNull().cast("long").alias("opens"),
    )
    pieces = told.withColumn("piece", F.sum("opens").over(order)).drop("opens")
    whole = Window.partitionBy("row", "piece")
    return pieces.withColumn("lone", F.count("*").over(whole) == 1)


def _encoded(pieces: DataFrame, files: tuple[str, str, str]) -> DataFrame:
    """(row, doc_id, piece, ids) of (row, doc_id, piece, text)."""

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = rank_codec(files)
        for batch in (part for whole in stream for part in slices(whole)):
            made = [codec.encode(t).astype("<u4").tobytes() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(made, pa.binary())], ["row", "doc_id", "piece", "ids"]
            )

    return pieces.select("row", "doc_id", "piece", "text").mapInArrow(
        encode, "row long, doc_id long, piece long, ids binary"
    )


def _long_ids(docs: DataFrame, files: tuple[str, str, str], chunk: int, overlap: int) -> DataFrame:
    """``doc_id`` and ``ids`` of long texts, through pieces dealt over the cluster."""
    chunks = chunks_of(docs, chunk, overlap)
    spans = spans_of(marks_of(chunks, files, chunk, overlap), chunk)
    own = chunks.join(spans, ["row", "place"]).select(
        "row", "doc_id", "place", "piece", "lone",
        F.expr("substring(body, int(first) + 1, int(coalesce(past, char_length(body)) - first))").alias("text"),
    )
    owned = staged(own, "owned")
    runs = (
        owned.where("not lone").groupBy("row", "piece")
        .agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("place", "text"))).alias("parts"))
        .withColumn("text", F.array_join(F.col("parts")["text"], ""))
    )
    columns = ["row", "doc_id", "piece", "text"]
    encoded = _encoded(owned.where("lone").select(columns), files).unionByName(_encoded(runs.select(columns), files))

    def concatenate(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in stream for part in slices(whole, 16)):
            made = [
                b"".join(p["ids"] for p in sorted(parts, key=lambda p: p["piece"]))
                for parts in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["doc_id", "ids"])

    grouped = encoded.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.collect_list(F.struct("piece", "ids")).alias("pieces")
    )
    return grouped.select("doc_id", "pieces").mapInArrow(concatenate, "doc_id long, ids binary")


def encode_by_ranks(
    docs: DataFrame, files: tuple[str, str, str], *, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of every row's whole text.

    A missing text counts as empty and has no ids. Repeated rows and rows without a
    doc_id give one row each; an empty table gives an empty result; other columns are not
    looked at. Special strings inside a text are plain text.
    """
    plain = keyed_texts(docs)
    is_long = F.coalesce(F.char_length("text") > chunk, F.lit(False))

    def work(ids: list, texts: list) -> dict[str, list]:
        codec = rank_codec(files)
        return {"doc_id": ids, "ids": [codec.encode(t or "").astype("<u4").tobytes() for t in texts]}

    short = map_texts(plain.where(~is_long), work, "doc_id long, ids binary")
    return short.unionByName(_long_ids(plain.where(is_long), files, chunk, overlap))


def decode_by_ranks(encoded: DataFrame, files: tuple[str, str, str]) -> DataFrame:
    """``doc_id`` and ``body``, the bytes of the ids in order; missing ids count as none."""

    def decode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = rank_codec(files)
        for batch in (part for whole in stream for part in slices(whole)):
            made = [codec.decode(np.frombuffer(d or b"", "<u4")) for d in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["doc_id", "body"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, body binary")


def rank_digests(encoded: DataFrame, files: tuple[str, str, str]) -> DataFrame:
    """Counts and hashes of ids and of the bytes they decode to, one row each."""

    def digest(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = rank_codec(files)
        for batch in (part for whole in stream for part in slices(whole)):
            packed = [d or b"" for d in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(d) // 4 for d in packed], pa.int64()),
                    pa.array([sha256(d).hexdigest() for d in packed], pa.string()),
                    pa.array([sha256(codec.decode(np.frombuffer(d, "<u4"))).hexdigest() for d in packed], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(digest, DIGEST)
