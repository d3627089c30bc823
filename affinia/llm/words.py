"""Tokenizers on executors: loaded once in a worker, with a bounded memo of words."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism

#: Words kept by one worker.
MOST_WORDS = 600_000

_loaded: dict[int, tuple[str, Tokenizer]] = {}


def specification(path: str) -> str:
    """A tokenizer file as text; it travels with the task, so executors need no file."""
    return Path(path).read_text(encoding="utf-8")


def load(spec: str) -> Tokenizer:
    key = hash(spec)
    if key not in _loaded or _loaded[key][0] != spec:
        made = Tokenizer.from_str(spec)
        made.no_truncation()
        made.no_padding()
        _loaded[key] = (spec, made)
    return _loaded[key][1]


class EndedWords:
    """Ids of many words at a time for BPE with an end-of-word suffix.

    The merges run over bytes in a library that takes them by rank: each pre-token is
    followed by MARK, and a byte with MARK behind it is the byte with the suffix, which
    ranks before every merge. That is the same encoding for words of usual characters
    (a test goes over each of them); others go to the tokenizer itself.
    """

    MARK = "\x00"
    USUAL = re.compile("[\n\x21-\x7e\xa1-\u024f]*")

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        described = json.loads(tokenizer.to_str())
        suffix = described["model"]["end_of_word_suffix"]
        pattern = described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pre_tokens = regex.compile(pattern, regex.V1)
        self.specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        letters = {c: b for b, c in byte_letters().items()}
        merges: dict[bytes, int] = {}
        for word, number in tokenizer.get_vocab(with_added_tokens=False).items():
            body, end = (word[: -len(suffix)], b"\x00") if word.endswith(suffix) else (word, b"")
            if all(c in letters for c in body) and word not in self.specials:
                merges[bytes(letters[c] for c in body) + end] = number
        size = tokenizer.get_vocab_size()
        self.gap = size + 1
        merges[b"\x00"], merges[b"\n"] = size, self.gap
        self.library = tiktoken.Encoding(
            "ended", pat_str="[^\x00\n]+\x00|\n", mergeable_ranks=merges, special_tokens={}
        )
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")

    def is_usual(self, text: str) -> bool:
        return self.USUAL.fullmatch(text) is not None and not any(s in text for s in self.specials)

    def encode(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word; no word holds a blank."""
        if not self.is_usual("\n".join(words)):
            made = dict.fromkeys(words, b"")
            rare = [w for w in made if not self.is_usual(w)]
            for word, found in zip(rare, self.tokenizer.encode_batch_fast(rare, add_special_tokens=False), strict=True):
                made[word] = np.array(found.ids, self.kind).tobytes()
            usual = list(made.keys() - set(rare))
            made.update(zip(usual, self.encode(usual), strict=True))
            return [made[w] for w in words]
        if not words:
            return []
        marked = self.pre_tokens.sub(r"\g<0>\x00", "\n".join(words).lower())
        ids = np.array(self.library.encode_ordinary(marked), np.int64)
        gap = ids == self.gap
        data = ids[~gap].astype(self.kind).tobytes()
        width = self.kind.itemsize
        ends = ((np.flatnonzero(gap) - np.arange(gap.sum())) * width).tolist()
        return [data[a:b] for a, b in zip([0, *ends], [*ends, len(data)], strict=True)]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class WordIds:
    """Ids of texts for a tokenizer that drops white space, by a memo of words.

    Such a tokenizer never lets a token, a merge or a special string reach across
    an ASCII blank: its pre-tokens hold none, no character composes with one, and
    the special strings hold none. So the ids of a text are the ids of its words in
    order, and a word met before need not be encoded again. The memo keeps the first
    ``most`` words, among which the frequent ones are.
    """

    def __init__(self, tokenizer: Tokenizer, most: int = MOST_WORDS):
        self.encoder = EndedWords(tokenizer)
        self.kind = self.encoder.kind
        self.most = most
        self.memo: dict[bytes, bytes] = {}

    def packed(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian ids of each UTF-8 text."""
        split = [text.split() for text in texts]
        memo = self.memo
        new = list(set().union(*split).difference(memo)) if split else []
        memo.update(zip(new, self.encoder.encode([w.decode() for w in new]), strict=True))
        packed = [b"".join(map(memo.__getitem__, words)) for words in split]
        if len(memo) > self.most:
            for word in new:
                del memo[word]
        return packed


_memos: dict[int, WordIds] = {}


def word_ids(spec: str) -> WordIds:
    key = hash(spec)
    if key not in _memos:
        _memos[key] = WordIds(load(spec))
    return _memos[key]
