"""Byte-level BPE with long texts encoded as a tree of halves.

A long text is cut into leaves that the cluster encodes in parallel. Two encoded
halves are joined by encoding a window around the join again, and letting the window
grow until it agrees with both halves: a run of tokens before the join must be the
same in the left half and in the window, and a run after it the same in the window
and in the right half. The ids are then those of the whole text, for two reasons.
Pre-tokens are read from left to right without a look behind, so from an agreed
token on, equal text is read alike. And inside one pre-token a sequence of tokens is
the encoding of its text exactly where every two neighbours are the encoding of
their own text; every two neighbours of the result stand together in one of the
three encodings. A special string may lie across the join, so runs count only
farther from it than such a string is long. Where nothing agrees the window becomes both halves.

A window is taken from the ids, whose bytes give the text back, so a join needs no
text and costs what its window costs.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import keyed_texts, map_texts, slices
from affinia.llm.words import load, specification

LEAF = 16_384
#: Leaves, or long texts, that a task holds as Python objects at a time.
LEAVES = 32
WINDOW = 32
AGREE = 2

#: Characters on which both libraries agree, by a test over each of them. Texts with
#: any other character are encoded by the library the file belongs to.
COMMON = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]")

DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Codec:
    """Encode and decode with a byte-level BPE file, by its ranks where that is the same.

    ``spec`` is the tokenizer file as text, ``ranks`` the same vocabulary as lines of
    base64 and rank, ``pattern`` its pre-token pattern.
    """

    def __init__(self, spec: str, ranks: str, pattern: str):
        self.tokenizer = load(spec)
        merges = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines())}
        special = {
            token.content: number
            for number, token in self.tokenizer.get_added_tokens_decoder().items()
        }
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens=special
        )
        self.bytes = {number: piece for piece, number in merges.items()}
        self.bytes |= {number: text.encode() for text, number in special.items()}
        #: A special string across a join begins less than this many bytes before it.
        self.reach = max([4, *(len(text.encode()) for text in special)])

    def encode(self, text: str) -> list[int]:
        if COMMON.search(text) is None:
            return self.fast.encode(text, allowed_special="all")
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return self.fast.decode_bytes(ids).decode("utf-8", errors="replace")

    def text(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def ends(self, ids: list[int]) -> np.ndarray:
        return np.cumsum([len(self.bytes[i]) for i in ids], dtype=np.int64)


def _inside(byte: int) -> bool:
    """Whether a UTF-8 byte continues a character."""
    return byte & 0xC0 == 0x80


def agreed(left: list, right: list, run: int) -> list[tuple[int, int]]:
    """Index pairs of the last of ``run`` tokens in a row that two encodings share.

    Each token is (start, end, id) on one scale, ascending.
    """
    places = {token: i for i, token in enumerate(right)}
    found, length, before = [], 0, None
    for i, token in enumerate(left):
        j = places.get(token)
        length = length + 1 if j is not None and before is not None and j == before + 1 else int(j is not None)
        before = j
        if length >= run:
            found.append((i, j))
    return found


def join(codec: Codec, left: list[int], right: list[int], window: int = WINDOW, run: int = AGREE) -> list[int]:
    """Ids of the text of ``left`` followed by that of ``right``."""
    if not left or not right:
        return left + right
    size = window
    while True:
        a, b = min(size, len(left)), min(size, len(right))
        while a < len(left) and _inside(codec.bytes[left[-a]][0]):
            a += 1
        while b < len(right) and _inside(codec.bytes[right[b]][0]):
            b += 1
        near, far = left[len(left) - a :], right[:b]
        made = codec.encode(codec.text(near + far).decode("utf-8", errors="replace"))
        if a == len(left) and b == len(right):
            return made
        cut = len(codec.text(near))
        near_ends, far_ends, made_ends = codec.ends(near), codec.ends(far) + cut, codec.ends(made)

        def spots(ids, ends, first):
            return list(zip([first, *ends[:-1].tolist()], ends.tolist(), ids, strict=True))

        middle = spots(made, made_ends, 0)
        start, stop = None, None
        if a == len(left):
            start = (-1, -1)
        else:
            before = [
                (i, j)
                for i, j in agreed(spots(near, near_ends, 0), middle, run)
                if near_ends[i] <= cut - codec.reach
            ]
            start = before[0] if before else None
        if b == len(right):
            stop = (b, len(made))
        else:
            after = [
                (i, j)
                for i, j in agreed(spots(far, far_ends, cut), middle, run)
                if made_ends[j] - cut >= codec.reach + sum(len(codec.bytes[x]) for x in made[j - run + 1 : j + 1])
            ]
            stop = after[-1] if after else None
        if start is not None and stop is not None and start[1] < stop[1]:
            return left[: len(left) - a + start[0] + 1] + made[start[1] + 1 : stop[1]] + right[stop[0] :]
        size *= 2


def concatenate(codec: Codec, leaves: list[list[int]], window: int = WINDOW) -> list[int]:
    """Ids of a text from those of its leaves, halves before wholes."""
    while len(leaves) > 1:
        leaves = [
            join(codec, leaves[k], leaves[k + 1], window) if k + 1 < len(leaves) else leaves[k]
            for k in range(0, len(leaves), 2)
        ]
    return leaves[0] if leaves else []


_codecs: dict[int, Codec] = {}


def codec_of(files: tuple[str, str, str]) -> Codec:
    key = hash(files)
    if key not in _codecs:
        _codecs[key] = Codec(*files)
    return _codecs[key]


def tokenizer_files(json_path: str, ranks_path: str, pattern: str) -> tuple[str, str, str]:
    """What a codec is made of, as text that travels with the tasks."""
    return specification(json_path), Path(ranks_path).read_text(), pattern


def encoding_leaves(files: tuple[str, str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function that encodes leaves, ``LEAVES`` at a time: a batch may hold 160 MB of them."""

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(files)
        for batch in (part for whole in stream for part in slices(whole, LEAVES)):
            ids = [np.array(codec.encode(t), "<u4").tobytes() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(ids, pa.binary())], ["doc_id", "mark", "place", "ids"]
            )

    return encode


def _long_ids(docs: DataFrame, files: tuple[str, str, str], leaf: int) -> DataFrame:
    """doc_id and ids of long texts, through leaves dealt over the cluster."""
    leaf_kinds = pa.schema(
        [("doc_id", pa.int64()), ("mark", pa.string()), ("place", pa.int64()), ("body", pa.string())]
    )

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in stream for part in slices(whole, LEAVES)):
            for doc_id, text, mark in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = [text[s : s + leaf] for s in range(0, len(text), leaf)]
                columns = ([doc_id] * len(parts), [mark] * len(parts), range(len(parts)), parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=k.type) for c, k in zip(columns, leaf_kinds, strict=True)],
                    schema=leaf_kinds,
                )

    def whole(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(files)
        for batch in (part for whole in stream for part in slices(whole, 1)):
            for doc_id, leaves in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by_place = {x["place"]: x["ids"] for x in leaves}
                ids = concatenate(
                    codec, [np.frombuffer(by_place[k], "<u4").tolist() for k in sorted(by_place)]
                )
                data = np.array(ids, "<u4").tobytes()
                for _ in range(len(leaves) // len(by_place)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id], pa.int64()), pa.array([data], pa.binary())], ["doc_id", "ids"]
                    )

    marked = keyed_texts(docs).withColumn("mark", F.sha2("text", 256))
    leaves = marked.mapInArrow(cut, "doc_id long, mark string, place long, body string")
    encoded = leaves.repartition("doc_id", "place").mapInArrow(
        encoding_leaves(files), "doc_id long, mark string, place long, ids binary"
    )
    grouped = encoded.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("place", "ids")).alias("leaves"))
    return grouped.drop("mark").mapInArrow(whole, "doc_id long, ids binary")


def encode_documents(docs: DataFrame, files: tuple[str, str, str], *, leaf: int = LEAF) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of every row's whole text.

    A missing text counts as empty and has no ids. Repeated rows give one row each;
    an empty table gives an empty result; other columns are not looked at. Texts of
    more than two leaves go through the tree, others are encoded where they are.
    """
    plain = keyed_texts(docs)
    is_long = F.coalesce(F.char_length("text") > 2 * leaf, F.lit(False))

    def work(ids: list, texts: list) -> dict[str, list]:
        codec = codec_of(files)
        made = [np.array(codec.encode(t or ""), "<u4").tobytes() for t in texts]
        return {"doc_id": ids, "ids": made}

    short = map_texts(plain.where(~is_long), work, "doc_id long, ids binary")
    return short.unionByName(_long_ids(plain.where(is_long), files, leaf))


def decode_documents(encoded: DataFrame, files: tuple[str, str, str]) -> DataFrame:
    """``doc_id`` and ``text`` from ``doc_id`` and ``ids``."""

    def decode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(files)
        for batch in (part for whole in stream for part in slices(whole)):
            found = [codec.decode(np.frombuffer(d, "<u4").tolist()) for d in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string())], ["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def digests(encoded: DataFrame, files: tuple[str, str, str]) -> DataFrame:
    """Counts and hashes of ids and of the text they decode to, one row each."""

    def digest(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(files)
        for batch in (part for whole in stream for part in slices(whole)):
            counts, of_ids, of_text = [], [], []
            for data in batch.column(1).to_pylist():
                ids = np.frombuffer(data, "<u4").tolist()
                counts.append(len(ids))
                of_ids.append(sha256(",".join(map(str, ids)).encode()).hexdigest())
                of_text.append(sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded.select("doc_id", "ids").mapInArrow(digest, DIGEST)
