"""Token operators against the tokenizers library and exact round trips."""

from __future__ import annotations

import random
from zlib import crc32

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from affinia.llm import ans_files, tree_bpe
from affinia.llm.queries import byte_bpe_files
from affinia.llm.token_counts import token_counts
from affinia.llm.words import EndedWords, load, specification

WORD, BYTE = public.path("word_bpe_49k.json"), public.path("byte_bpe_50k.json")
PIECES = ["a", "b", " ", "  ", "\n", "'s", "'", "1", "22", "!", "é", "日", "<|endoftext|>", "hello", " world", "aaaa", "́"]


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


def key(row):
    return tuple((v is None, v) for v in row)


def test_every_usual_character_of_ended_words(word_library):
    words = []
    for code in [*range(0x21, 0x7F), *range(0xA1, 0x250)]:
        c = chr(code)
        words += [c, "a" + c, c + "b", "1" + c + "2", c * 3, "'" + c, c + "'s"]
    words += ["<|endoftext|>", "a<|startoftext|>b", "日本", "é"]
    made = EndedWords(load(specification(WORD))).encode(words)
    for word, ids in zip(words, made, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == word_library.encode(word, add_special_tokens=False).ids


@pytest.mark.parametrize(("chunk", "overlap"), [(16_384, 256), (1000, 16), (64, 8)])
def test_counts_are_the_librarys(frame, odd, word_library, chunk, overlap):
    rows = [*odd, (11, "a" * 5000), (12, "x!!'s" * 1000), (13, "日本語" * 900 + " 12ab" * 300), (14, "k" * (chunk + 3))]
    got = token_counts(frame(rows), WORD, chunk=chunk, overlap=overlap).collect()
    expected = [
        (i, len((t or "").encode()), len(word_library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows
    ]
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_counts_of_no_rows(frame):
    assert token_counts(frame([]), WORD).collect() == []


def test_every_common_character_of_the_codec(byte_library):
    codec = tree_bpe.codec_of(byte_bpe_files())
    for code in [9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250)]:
        c = chr(code)
        for text in ("a" + c + "b " + c + " 1" + c + "2" + c + c, c, c + c + " x", "'" + c + "s 's" + c):
            assert codec.fast.encode(text, allowed_special="all") == byte_library.encode(text, add_special_tokens=False).ids


def test_leaves_join_to_the_whole(byte_library):
    codec = tree_bpe.codec_of(byte_bpe_files())
    draw = random.Random(1)
    for _ in range(400):
        letters = draw.choice([PIECES, ["a", "b"], ["a"], ["1", "a", "'"], [" ", "\n", "a"]])
        text = "".join(draw.choice(letters) for _ in range(draw.randint(1, 300)))
        leaf = draw.choice([1, 3, 7, 20])
        leaves = [codec.encode(text[i : i + leaf]) for i in range(0, len(text), leaf)]
        ids = tree_bpe.concatenate(codec, leaves, window=draw.choice([1, 2, 4, 8]))
        assert ids == byte_library.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == text


def test_documents_encode_and_decode(frame, odd, byte_library):
    files = byte_bpe_files()
    encoded = tree_bpe.encode_documents(frame(odd), files, leaf=500)
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in encoded.collect()), key=key)
    expected = sorted(((i, byte_library.encode(t or "", add_special_tokens=False).ids) for i, t in odd), key=key)
    assert got == expected
    decoded = tree_bpe.decode_documents(encoded, files).collect()
    assert sorted(map(tuple, decoded), key=key) == sorted(((i, t or "") for i, t in odd), key=key)


@pytest.mark.parametrize("count", [0, 1, 63, 200, 70_000])
def test_coder_round_trip(count):
    draw = np.random.default_rng(count)
    ids = (draw.zipf(1.3, count) % 40_000).astype(np.uint16)
    coder = ans_files.Coder(ans_files.quantised(np.bincount(ids, minlength=49_408)))
    lanes = max(1, min(64, count // 64))
    payload, marks = coder.encode(ids, lanes)
    assert (coder.decode(payload, count, lanes) == ids).all()
    stops = [m["step"] for m in marks]
    parts = [coder.decode(payload, count, lanes, a, b) for a, b in zip([None, *marks], [*stops, None], strict=True)]
    assert (np.concatenate(parts) == ids).all()


def test_files_hold_all_ids_in_order(spark, frame, odd, tmp_path, word_library):
    ans_files.write_ids(frame(odd), str(tmp_path / "ids"), WORD, end_id=2)
    rows = ans_files.read_ids(spark, str(tmp_path / "ids")).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((i for i, _ in odd), key=lambda i: (i is not None, i))
    start = 0
    texts = {}
    for i, t in odd:
        texts.setdefault(i, []).append(word_library.encode(t or "", add_special_tokens=False).ids + [2])
    for row in rows:
        ids = np.frombuffer(row.ids, "<u4")
        assert ids.tolist() in texts[row.doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc32(ids.tobytes()))
        start += len(ids)


def test_damaged_block_is_noticed(spark, frame, tmp_path):
    path = str(tmp_path / "ids")
    ans_files.write_ids(frame([(1, "some words to keep")]), path, WORD, end_id=2)
    row = spark.read.parquet(f"{path}/blocks").collect()[0].asDict(recursive=True)
    row["payload"] = bytes([row["payload"][0] ^ 1]) + bytes(row["payload"][1:])
    with pytest.raises(ValueError, match="damaged"):
        ans_files._decoded(row, ans_files.read_coder(spark, path))


def test_files_of_no_rows(spark, frame, tmp_path):
    ans_files.write_ids(frame([]), str(tmp_path / "ids"), WORD, end_id=2)
    assert ans_files.read_ids(spark, str(tmp_path / "ids")).collect() == []


def test_leaves_are_encoded_a_few_at_a_time(byte_library):
    """A batch of leaves may be large; what is held as Python objects is not."""
    texts = [f"leaf {i} of a long text" for i in range(100)]
    columns = [pa.array([1] * 100, pa.int64()), pa.array(["m"] * 100), pa.array(range(100), pa.int64()), pa.array(texts)]
    batch = pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "place", "body"])
    made = list(tree_bpe.encoding_leaves(byte_bpe_files())(iter([batch])))
    assert max(b.num_rows for b in made) <= tree_bpe.LEAVES < 100
    ids = [np.frombuffer(r["ids"], "<u4").tolist() for b in made for r in b.to_pylist()]
    assert ids == [byte_library.encode(t, add_special_tokens=False).ids for t in texts]
