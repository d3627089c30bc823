"""Alignment against the shared ends found by plain sets, and counts by a plain loop."""

from __future__ import annotations

from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers as public
import pytest
import sentencepiece
from tokenizers import Tokenizer

from affinia.llm import alignment
from affinia.llm.words import byte_letters


@pytest.fixture(scope="module")
def files():
    return alignment.tokenizer_pair(
        public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN,
        public.path("piece_bpe_32k.model"),
    )


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))


def plain(text, libraries):
    """Groups of ids and their ends, by the sets of ends of both sides."""
    a, b = libraries
    letters = {c: bytes([n]) for n, c in byte_letters().items()}
    sides = []
    if not text:
        return []
    made = a.encode(" " + text, add_special_tokens=False)
    sides.append([(i, b"".join(letters[c] for c in t)) for i, t in zip(made.ids, made.tokens, strict=True)])
    ids = b.encode(text)
    pieces = [b.id_to_piece(i) for i in ids]
    sides.append(
        [
            (i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
            for i, p in zip(ids, pieces, strict=True)
        ]
    )
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
        return []
    ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in sides]
    shared = sorted(set(ends[0]) & set(ends[1]))
    groups, at = [], [0, 0]
    for cut in shared:
        past = [e.index(cut) + 1 for e in ends]
        groups.append((cut, *([i for i, _ in s[x:y]] for s, x, y in zip(sides, at, past, strict=True))))
        at = past
    return groups


def expected(rows, libraries):
    groups = [(i, plain(t, libraries)) for i, t in rows]
    counts = Counter((a[-1], b[-1]) for _, found in groups for _, a, b in found)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for i, found in groups:
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for _, a, b in found)
        links = [(a[-1], b[-1]) for _, a, b in found]
        out.append(
            (i, sum(len(a) for _, a, _ in found), sum(len(b) for _, _, b in found), len(found), len(links),
             sha256(said.encode()).hexdigest() if found else "",
             sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links))
        )
    return out


def key(row):
    return tuple((v is None, v) for v in row)


MORE = [
    (20, "already▁marked"), (21, "<s> <unk> <|endoftext|> <0x41>"), (22, "zero\x00byte"), (23, "日本語のテキスト 漢字"),
    (24, "á é 😀👍🏽 ​ x"), (25, "  two  blanks \n\n"), (26, "xyz" * 500), (27, "ﬁ ½ ①"), (28, "\r\n\t end "),
]


def test_report_is_the_plain_one(frame, odd, files, libraries):
    rows = [(i, t) for i, t in [*odd, *MORE] if len(t or "") < 20_000] + [(30, "x" * 9_000)]
    got = alignment.alignment_report(frame(rows), files)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected(rows, libraries), key=key)


def test_given_documents(spark, small, files, libraries):
    rows = [(r.doc_id, r.text) for r in small.collect() if len(r.text or "") < 30_000]
    got = alignment.alignment_report(spark.createDataFrame(rows, "doc_id long, text string"), files).collect()
    assert sorted(map(tuple, got), key=key) == sorted(expected(rows, libraries), key=key)


def test_groups_and_cuts(frame, files, libraries):
    rows = [(1, "some words, aligned"), (2, None)]
    made = {r.doc_id: r for r in alignment.align_documents(frame(rows), files).collect()}
    groups = plain(rows[0][1], libraries)
    assert made[1].groups == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for _, a, b in groups)
    assert np.frombuffer(made[1].cut_bytes, "<u8").tolist() == [cut for cut, _, _ in groups]
    assert (made[2].n_a, made[2].groups, made[2].groups_sha256) == (0, "", "")


def test_no_rows(frame, files):
    assert alignment.alignment_report(frame([]), files).collect() == []


@pytest.mark.parametrize("seed", range(40))
def test_divided_cuts_are_the_shared_ends(seed):
    draw = np.random.default_rng(seed)
    parts, base = ([], []), 0
    for _ in range(draw.integers(1, 6)):
        size = int(draw.integers(1, 400))
        few = draw.choice([2, 5, 300])
        for side in range(2):
            inner = draw.choice(np.arange(1, size + 1), min(size, few), replace=False)
            parts[side].append(base + np.unique(np.append(inner, size)))
        if seed % 4 == 0 and size > 3:  # nothing but the end in common
            parts[0][-1] = base + np.append(np.arange(1, size - 1, 2), size)
            parts[1][-1] = base + np.append(np.arange(2, size - 1, 2), size)
        base += size
    ends = [np.concatenate(p) for p in parts]
    stops = [np.cumsum([len(x) for x in p]) for p in parts]
    at_a, at_b = alignment.shared_cuts(*ends, *stops)
    shared = np.intersect1d(*ends)
    assert (ends[0][at_a] == shared).all() and (ends[1][at_b] == shared).all()
    assert len(at_a) == len(at_b) == len(shared)


def test_every_linked_pair_is_listed(files):
    known = alignment.vocabulary_pairs(files)
    width = len(known.b_bytes)
    for pair in known.pairs[:: len(known.pairs) // 500].tolist():
        a, b = known.a_bytes[pair // width], known.b_bytes[pair % width]
        assert a.endswith(b) or b.endswith(a)
    assert len(known.pairs) <= sum(map(len, known.a_bytes)) * 2 + sum(map(len, known.b_bytes)) * 2
