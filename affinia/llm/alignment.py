"""Alignment of the tokens of two tokenizers by divide and conquer at shared cuts.

Both tokenizers write the same bytes, so their tokens are two ways to cut them. In an
interval that ends with a token of both, a cut near the middle is looked for: the end of
a token of A at the middle, then of those beside it in turn, each by bisection among the
ends of B. Where one is found the interval falls into two that are searched in the same
way; an interval without a cut is a group. All intervals of a level are searched
together, as numpy operations over the documents of a batch.

Tokens that end a group on both sides are linked. The bytes of one of them are the end of
the other's, so the linked id pairs of any corpus are among those where one token ends with
the other: a list that the two vocabularies fix (``VocabularyPairs``), some hundred
thousand pairs for vocabularies of 50,000 and 32,000. A first pass over the texts writes
each document's measures and its links as numbers in that list. The links are counted
over the corpus with one row per pair, and a second pass reads the counts. So the list is
all that reaches the driver or every task, whatever the size of the corpus.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import cached_property
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from affinia.llm.common import keyed_texts, slices
from affinia.llm.tree_bpe import COMMON
from affinia.llm.words import byte_letters, specification
from affinia.sources.workspace import fresh_path

#: Ends beside the middle that are tried in turn before the rest of an interval at once.
BESIDE = 8
#: Documents aligned at a time.
TOGETHER = 128
#: Tokens turned to text at a time.
STRETCH = 1 << 16

ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs binary, times binary, cut_bytes binary, groups string"
)


def _apart(a: np.ndarray, b: np.ndarray, a0, a1, b0, b1) -> tuple[np.ndarray, np.ndarray]:
    """A shared end near the middle of every interval, as places in a and b; -1 where there is none."""
    middle = (a0 + a1 - 2) // 2
    at_a, at_b = np.full(len(a0), -1), np.full(len(a0), -1)
    waiting = np.arange(len(a0))
    for step in range(2 * BESIDE):
        probe = middle[waiting] + ((step + 1) // 2 if step % 2 else -(step // 2))
        inside = (probe >= a0[waiting]) & (probe < a1[waiting] - 1)
        end = a[np.where(inside, probe, a0[waiting])]
        spot = np.searchsorted(b, end)
        hit = inside & (b[spot] == end)
        at_a[waiting[hit]], at_b[waiting[hit]] = probe[hit], spot[hit]
        # Both sides are used up once the farther one is.
        farthest = np.maximum(middle[waiting] - a0[waiting], a1[waiting] - 2 - middle[waiting])
        waiting = waiting[~hit & (farthest > step // 2)]
        if not len(waiting):
            return at_a, at_b
    for i in waiting.tolist():
        ends = a[a0[i] : a1[i] - 1]
        spots = b0[i] + np.searchsorted(b[b0[i] : b1[i]], ends)
        shared = np.flatnonzero(b[spots] == ends)
        if len(shared):
            k = shared[np.argmin(np.abs(shared + a0[i] - middle[i]))]
            at_a[i], at_b[i] = a0[i] + k, spots[k]
    return at_a, at_b


def shared_cuts(
    a: np.ndarray, b: np.ndarray, a_stops: np.ndarray, b_stops: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of a and b that end together, ascending.

    ``a`` and ``b`` are ascending ends of tokens. The stops are the places behind the last
    tokens of each text, whose ends are the same on both sides.
    """
    found_a, found_b = [a_stops - 1], [b_stops - 1]
    a0, b0 = np.append(0, a_stops[:-1]), np.append(0, b_stops[:-1])
    a1, b1 = a_stops, b_stops
    while True:
        open_ = (a1 - a0 > 1) & (b1 - b0 > 1)
        a0, a1, b0, b1 = a0[open_], a1[open_], b0[open_], b1[open_]
        if not len(a0):
            return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))
        at_a, at_b = _apart(a, b, a0, a1, b0, b1)
        cut = at_a >= 0
        at_a, at_b = at_a[cut] + 1, at_b[cut] + 1
        found_a.append(at_a - 1)
        found_b.append(at_b - 1)
        a0, a1 = np.concatenate([a0[cut], at_a]), np.concatenate([at_a, a1[cut]])
        b0, b1 = np.concatenate([b0[cut], at_b]), np.concatenate([at_b, b1[cut]])


class VocabularyPairs:
    """Two tokenizers, the bytes of their tokens, and the id pairs that can end together.

    ``spec`` is A's tokenizer file as text and ``ranks`` its vocabulary as lines of base64
    and rank; ``model`` is B's file. ``pattern`` splits texts for A.
    """

    def __init__(self, spec: str, ranks: str, pattern: str, model: bytes):
        self.slow = Tokenizer.from_str(spec)
        self.slow.encode_special_tokens = True
        self.slow.no_truncation()
        self.slow.no_padding()
        merges = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines())}
        self.fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = {c: b for b, c in byte_letters().items()}
        special = {token["content"] for token in json.loads(spec).get("added_tokens", [])}
        vocabulary = self.slow.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (1 + max(vocabulary.values()))
        for piece, number in vocabulary.items():
            self.a_bytes[number] = piece.encode() if piece in special else bytes(letters[c] for c in piece)
        self.b_bytes = [
            bytes([int(piece[3:-1], 16)]) if self.pieces.is_byte(number) else piece.replace("▁", " ").encode()
            for number in range(self.pieces.get_piece_size())
            for piece in [self.pieces.id_to_piece(number)]
        ]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)

    @cached_property
    def pairs(self) -> np.ndarray:
        """Id pairs (a * size of B + b) where one token's bytes end with the other's, ascending."""
        found = set()
        width = len(self.b_bytes)
        by_bytes: tuple[dict, dict] = ({}, {})
        for held, tokens in zip(by_bytes, (self.a_bytes, self.b_bytes), strict=True):
            for number, body in enumerate(tokens):
                held.setdefault(body, []).append(number)
        for a, body in enumerate(self.a_bytes):
            for k in range(len(body)):
                found.update(a * width + b for b in by_bytes[1].get(body[k:], ()))
        for b, body in enumerate(self.b_bytes):
            for k in range(1, len(body)):
                found.update(a * width + b for a in by_bytes[0].get(body[k:], ()))
        return np.array(sorted(found), np.int64)

    @cached_property
    def said(self) -> list[bytes]:
        """Every id of A followed by a comma and by a bar, then every id of B by a comma and a semicolon."""
        return [
            b"%d%s" % (n, mark)
            for size, marks in ((len(self.a_bytes), (b",", b"|")), (len(self.b_bytes), (b",", b";")))
            for n in range(size)
            for mark in marks
        ]

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both tokenizers for every text; none where the two do not write the same bytes."""
        whole = [" " + (t or "") for t in texts]
        of_b = self.pieces.encode([t or "" for t in texts], num_threads=1)
        a_ids, b_ids = [], []
        nothing = np.zeros(0, np.int64)
        for text, full, b in zip(texts, whole, of_b, strict=True):
            if not text:
                a_ids.append(nothing)
                b_ids.append(nothing)
                continue
            usual = COMMON.search(full) is None
            a = self.fast.encode_ordinary(full) if usual else self.slow.encode(full, add_special_tokens=False).ids
            data = full.encode()
            same = data == b"".join(map(self.a_bytes.__getitem__, a)) == b"".join(map(self.b_bytes.__getitem__, b))
            a_ids.append(np.array(a, np.int64) if same else nothing)
            b_ids.append(np.array(b, np.int64) if same else nothing)
        return a_ids, b_ids


_loaded: dict[int, VocabularyPairs] = {}


def vocabulary_pairs(files: tuple[str, str, str, bytes]) -> VocabularyPairs:
    key = hash(files)
    if key not in _loaded:
        _loaded[key] = VocabularyPairs(*files)
    return _loaded[key]


def tokenizer_pair(json_path: str, ranks_path: str, pattern: str, model_path: str) -> tuple[str, str, str, bytes]:
    """What both tokenizers are made of; it travels with the tasks."""
    return specification(json_path), Path(ranks_path).read_text(), pattern, Path(model_path).read_bytes()


def _stops(parts: list[np.ndarray]) -> np.ndarray:
    return np.cumsum([len(p) for p in parts], dtype=np.int64)


def align_batch(known: VocabularyPairs, texts: list[str | None], with_groups: bool) -> dict[str, list]:
    """Columns of ``ALIGNED`` but doc_id, for some texts."""
    a_parts, b_parts = known.tokens(texts)
    a_ids, b_ids = np.concatenate(a_parts), np.concatenate(b_parts)
    a_stops, b_stops = _stops(a_parts), _stops(b_parts)
    filled = np.diff(a_stops, prepend=0) > 0
    a_ends, b_ends = np.cumsum(known.a_sizes[a_ids]), np.cumsum(known.b_sizes[b_ids])
    if len(a_ids):
        at_a, at_b = shared_cuts(a_ends, b_ends, a_stops[filled], b_stops[filled])
    else:
        at_a = at_b = np.zeros(0, np.int64)
    # Groups of a document are those that end before its stop.
    ends = np.searchsorted(at_a, a_stops)
    counts = np.diff(ends, prepend=0)

    links = np.searchsorted(known.pairs, a_ids[at_a] * len(known.b_bytes) + b_ids[at_b])
    size = max(1, len(known.pairs))
    owner = np.repeat(np.arange(len(texts)), counts)
    keys, times = np.unique(owner * size + links, return_counts=True)
    bounds = np.searchsorted(keys, np.arange(len(texts) + 1) * size)

    # Ids with their marks, in the order of the text form: a group's of A, then its of B.
    a_group, b_group = np.searchsorted(at_a, np.arange(len(a_ids))), np.searchsorted(at_b, np.arange(len(b_ids)))
    b_before, a_through = np.append(0, at_b + 1), at_a + 1
    codes = np.empty(len(a_ids) + len(b_ids), np.int64)
    is_cut = np.zeros(len(a_ids), np.int64)
    is_cut[at_a] = 1
    codes[np.arange(len(a_ids)) + b_before[a_group]] = 2 * a_ids + is_cut
    is_cut = np.zeros(len(b_ids), np.int64)
    is_cut[at_b] = 1
    codes[np.arange(len(b_ids)) + a_through[b_group]] = 2 * (len(known.a_bytes) + b_ids) + is_cut

    digests, pairs, spelled, cuts, told = [], [], [], [], []
    first, cut, base = 0, 0, 0
    for k, (past, end) in enumerate(zip((a_stops + b_stops).tolist(), ends.tolist(), strict=True)):
        parts = []
        digest = sha256()
        for s in range(first, past, STRETCH):
            body = b"".join(map(known.said.__getitem__, codes[s : min(past, s + STRETCH)].tolist()))
            body = body[:-1] if s + STRETCH >= past else body
            digest.update(body)
            if with_groups:
                parts.append(body)
        digests.append(digest.hexdigest() if past > first else "")
        told.append(b"".join(parts).decode() if with_groups else None)
        cuts.append((a_ends[at_a[cut:end]] - base).astype("<u8").tobytes() if with_groups else None)
        held = slice(bounds[k], bounds[k + 1])
        # Differences are small numbers, which the file format packs well.
        pairs.append(np.diff(keys[held] - k * size, prepend=0).astype("<u4").tobytes())
        spelled.append(times[held].astype("<u4").tobytes())
        base = int(a_ends[at_a[end - 1]]) if end > cut else base
        first, cut = past, end
    return {
        "n_a": np.diff(a_stops, prepend=0), "n_b": np.diff(b_stops, prepend=0), "n_groups": counts, "n_links": counts,
        "groups_sha256": digests, "pairs": pairs, "times": spelled, "cut_bytes": cuts, "groups": told,
    }


def align_documents(docs: DataFrame, files: tuple[str, str, str, bytes], *, with_groups: bool = True) -> DataFrame:
    """Groups and links of every row's whole text: the columns of ``ALIGNED``.

    ``groups`` is the text ``a1,a2|b1;a3|b2,b3`` of the ids, ``cut_bytes`` the byte offsets
    where groups end (little-endian unsigned 64-bit, the blank in front counted);
    ``with_groups=False`` leaves both null. ``pairs`` are differences of ascending places in
    ``VocabularyPairs.pairs`` and ``times`` how many links hold each, both little-endian
    unsigned 32-bit. Missing and empty texts, and those that the tokenizers do not write
    with the same bytes, have zeros, no pairs and '' as digest. Rows are not merged: repeats
    and rows without a doc_id give a row each. Other columns are not looked at.
    """
    names = [part.split()[0] for part in ALIGNED.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[part.split()[1]] for part in ALIGNED.split(", ")]

    def align(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary_pairs(files)
        for batch in (part for whole in stream for part in slices(whole, TOGETHER)):
            made = align_batch(known, batch.column(1).to_pylist(), with_groups)
            columns = [batch.column(0), *(pa.array(made[n], t) for n, t in zip(names[1:], types[1:], strict=True))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return keyed_texts(docs).mapInArrow(align, ALIGNED)


def link_counts(aligned: DataFrame, size: int) -> DataFrame:
    """``pair, links`` over all documents, a row for each of the ``size`` pairs that is linked."""

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in stream:
            for pairs, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[np.cumsum(np.frombuffer(pairs, "<u4"), dtype=np.int64)] += np.frombuffer(times, "<u4")
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["pair", "links"])

    partial = aligned.select("pairs", "times").mapInArrow(count, "pair long, links long")
    return partial.groupBy("pair").agg(F.sum("links").alias("links"))


def alignment_report(docs: DataFrame, files: tuple[str, str, str, bytes]) -> DataFrame:
    """Measures of every document's alignment, with those that need the whole corpus.

    ``n_best`` counts links whose pair is linked as often as any with the same id of B;
    ``count_sum`` adds up the corpus-wide counts of the links. Odd rows are as in
    ``align_documents``; an empty table gives an empty result.
    """
    known = vocabulary_pairs(files)
    size = len(known.pairs)
    spark = docs.sparkSession
    path = fresh_path(spark, "aligned")
    align_documents(docs, files, with_groups=False).drop("cut_bytes", "groups").write.option(
        "compression", "zstd"
    ).parquet(path)
    aligned = spark.read.parquet(path)
    counts = np.zeros(size, np.int64)
    for row in link_counts(aligned, size).toLocalIterator():  # at most one row per pair of the vocabularies
        counts[row["pair"]] = row["links"]
    of_b = known.pairs % len(known.b_bytes)
    highest = np.zeros(len(known.b_bytes), np.int64)
    np.maximum.at(highest, of_b, counts)
    is_best = counts == highest[of_b]

    def score(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            best, sums = [], []
            for pairs, times in zip(batch.column(6).to_pylist(), batch.column(7).to_pylist(), strict=True):
                places = np.cumsum(np.frombuffer(pairs, "<u4"), dtype=np.int64)
                held = np.frombuffer(times, "<u4").astype(np.int64)
                best.append(int(held[is_best[places]].sum()))
                sums.append(int((held * counts[places]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array(best, pa.int64()), pa.array(sums, pa.int64())],
                [*batch.schema.names[:6], "n_best", "count_sum"],
            )

    named = aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")
    return named.mapInArrow(
        score,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "n_best long, count_sum long",
    )
