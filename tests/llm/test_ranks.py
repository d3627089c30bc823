"""Encoding by ranks against the library, at several chunk sizes."""

from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
import public_tokenizers as public
import pytest

from affinia.llm import overlap_bpe


@pytest.fixture(scope="module")
def files():
    return overlap_bpe.rank_files(public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)


@pytest.fixture(scope="module")
def library(files):
    return overlap_bpe.rank_codec(files).library


def key(row):
    return tuple((v is None, v) for v in row)


MORE = [
    (20, "x!!'s" * 300), (21, "日本語、テキスト。" * 80), (22, "12ab" * 300), (23, " " * 900 + "x"), (24, "\n \n" * 200 + "b"),
    (25, "'ll've" * 200), (26, "é́ ü" * 300), (27, "😀👍🏽 " * 100), (28, "<|endoftext|>" * 50), (29, "a" * 64 + "b"),
    (30, "　全角 行" * 100),
]


@pytest.mark.parametrize(("chunk", "overlap"), [(16_384, 256), (100, 16), (7, 3), (3, 2)])
def test_ids_are_the_librarys(frame, odd, files, library, chunk, overlap):
    rows = [(i, t) for i, t in [*odd, *MORE] if chunk > 50 or len(t or "") < 3_000]
    encoded = overlap_bpe.encode_by_ranks(frame(rows), files, chunk=chunk, overlap=overlap)
    made = [(i, library.encode_ordinary(t or "")) for i, t in rows]
    got = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in encoded.collect()]
    assert sorted(got, key=key) == sorted(made, key=key)


def test_digests_and_round_trip(frame, odd, files, library):
    encoded = overlap_bpe.encode_by_ranks(frame(odd), files, chunk=500, overlap=32)
    decoded = [(r.doc_id, bytes(r.body).decode()) for r in overlap_bpe.decode_by_ranks(encoded, files).collect()]
    assert sorted(decoded, key=key) == sorted(((i, t or "") for i, t in odd), key=key)
    told = []
    for i, t in odd:
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        told.append((i, len(ids), sha256(ids.tobytes()).hexdigest(), sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, overlap_bpe.rank_digests(encoded, files).collect()), key=key) == sorted(told, key=key)


def test_given_documents(small, files, library):
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in overlap_bpe.encode_by_ranks(small, files).collect()}
    rows = small.select("doc_id", "text").collect()
    assert got == {r.doc_id: library.encode_ordinary(r.text or "") for r in rows}


def test_no_rows(frame, files):
    assert overlap_bpe.encode_by_ranks(frame([]), files).collect() == []


def test_certain_starts_split_any_text(files, library):
    codec = overlap_bpe.rank_codec(files)
    draw = random.Random(3)
    letters = ["a", "Z", " ", "  ", "\n", "\t", "'", "'s", "1", "²", "!", "é", "日", "。", "　", "́", "𞤀", "😀"]
    for _ in range(600):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(2, 60)))
        head, _ = codec.starts(text, len(text), len(text) + 1)
        for at in head:
            assert library.encode_ordinary(text[:at]) + library.encode_ordinary(text[at:]) == library.encode_ordinary(text)


def test_disputed_characters_are_no_place_to_split(files):
    codec = overlap_bpe.rank_codec(files)
    for c in files[2][:: max(1, len(files[2]) // 200)]:
        assert codec.starts(f"a{c} b", 4, 9)[0] in ([], [2]) or c.isspace()
        assert codec.certain.match(f"a{c} b", 1) is None and codec.certain.match(f"a{c} b", 2) is None
