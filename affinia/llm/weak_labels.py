"""Quality by weak labels: heuristic labellers, their accuracies by EM, a hashed scorer.

Each labeller votes good, bad or abstains. The votes of all documents are counted by
pattern, and expectation-maximisation over the counted patterns estimates how often each
labeller votes each way on good and on bad documents, and the share of good ones. There
are at most 3 ** labellers patterns, whatever the number of documents. Posterior labels
of a bounded sample of documents (``SAMPLE`` rows, by a hash of their text) train a
linear scorer over hashed words and word pairs, which then scores every document.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import BLANKS, keyed_texts, map_texts

#: Frequent function words of the languages the texts are in.
FUNCTION_WORDS = frozenset(
    (
        "the of and to in is that it for on with as was be at by this are from or "
        "le la les des et un une est que qui dans pour au pas "
        "der die das und zu von den mit nicht ein eine ist auf im "
        "el los las de y en por con para se del no"
    ).split()
)
END = re.compile(r"[.!?…][\"')\]]?\s*$")
LETTERS = re.compile(r"[^\W\d_]+")
GOOD, BAD, NONE = 1, 0, 2

FEATURES = 1 << 16
SAMPLE = 8000
ROUNDS = 200
STEPS = 250


def votes_of(text: str | None) -> list[int]:
    """One vote per labeller; a text without a word is bad for all that can say so."""
    text = text or ""
    words = text.split()
    count = len(words)
    if not count:
        return [BAD] * len(LABELLERS)
    return [labeller(text, words, count) for labeller in LABELLERS]


def by_share(good: float, bad: float, share: float) -> int:
    """Good at one side of ``good``, bad beyond ``bad``, else no vote."""
    if good < bad:
        return GOOD if share <= good else BAD if share >= bad else NONE
    return GOOD if share >= good else BAD if share <= bad else NONE


def length(text: str, words: list[str], count: int) -> int:
    return by_share(40, 20, count)


def function_words(text: str, words: list[str], count: int) -> int:
    hits = sum(map(FUNCTION_WORDS.__contains__, text.lower().split()))
    return by_share(0.12, 0.03, hits / count) if count >= 10 else NONE


def symbols(text: str, words: list[str], count: int) -> int:
    return by_share(0.02, 0.10, sum(map(text.count, "#*$%&|<>{}[]=_^~\\")) / count)


def letters(text: str, words: list[str], count: int) -> int:
    kept = len(text) - sum(map(text.count, BLANKS))
    return by_share(0.90, 0.72, sum(map(len, LETTERS.findall(text))) / max(1, kept))


def capitals(text: str, words: list[str], count: int) -> int:
    upper = sum(w.isupper() and len(w) > 1 for w in words)
    return by_share(0.05, 0.30, upper / count)


def repeated_words(text: str, words: list[str], count: int) -> int:
    if count < 10:
        return NONE
    pairs = list(zip(words, words[1:], strict=False))
    return by_share(0.10, 0.35, 1 - len(set(pairs)) / len(pairs))


def repeated_lines(text: str, words: list[str], count: int) -> int:
    lines = [line for line in text.split("\n") if line.strip()]
    return by_share(0.10, 0.30, 1 - len(set(lines)) / len(lines)) if len(lines) > 2 else NONE


def sentences(text: str, words: list[str], count: int) -> int:
    lines = [line for line in text.split("\n") if line.strip()]
    return by_share(0.6, 0.2, sum(END.search(line[-8:]) is not None for line in lines) / len(lines))


LABELLERS = (length, function_words, symbols, letters, capitals, repeated_words, repeated_lines, sentences)


def estimate(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """EM: posterior of good per pattern, vote shares (class, labeller, vote), prior.

    Starts from the majority of the votes and keeps a little of every vote possible.
    """
    number = patterns.shape[1] if patterns.size else len(LABELLERS)
    hot = (patterns[:, :, None] == np.arange(3)).astype(float)
    good, bad = hot[:, :, GOOD].sum(axis=1), hot[:, :, BAD].sum(axis=1)
    belief = np.clip((good + 0.5) / (good + bad + 1), 0.05, 0.95)
    shares, prior = np.full((2, number, 3), 1 / 3), 0.5
    for _ in range(ROUNDS):
        before = belief
        for k, weight in ((GOOD, belief * counts), (BAD, (1 - belief) * counts)):
            tally = np.einsum("p,plv->lv", weight, hot) + 1.0
            shares[k] = tally / tally.sum(axis=1, keepdims=True)
        prior = float(np.clip((belief * counts).sum() / max(counts.sum(), 1), 0.02, 0.98))
        odds = np.log(prior) - np.log(1 - prior)
        odds = odds + np.einsum("plv,lv->p", hot, np.log(shares[GOOD]) - np.log(shares[BAD]))
        belief = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if len(belief) == 0 or np.abs(belief - before).max() < 1e-9:
            break
    return belief, shares, prior


class Features(dict):
    """Hashes of a word and of its shape, remembered up to a number of words."""

    def __missing__(self, word: str) -> int:
        shape = SHAPE.sub("w", word)[:8]
        value = crc32(word.encode()) % FEATURES << 32 | crc32(b"~" + shape.encode())
        if len(self) < 400_000:
            self[word] = value
        return value


SHAPE = re.compile(r"\w")
_features = Features()


def hashed(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text with unit length: words, their shapes and shape pairs."""
    words = (text or "").lower().split()
    both = np.fromiter(map(_features.__getitem__, words), np.int64, len(words))
    shapes = both & 0xFFFFFFFF
    pairs = (shapes[:-1] * 31 + shapes[1:] * 17 + 7) % FEATURES
    codes = np.concatenate([both >> 32, shapes % FEATURES, pairs])
    codes.sort()
    edges = np.flatnonzero(np.diff(codes, prepend=-1))
    places = codes[edges]
    values = np.log1p(np.diff(edges, append=len(codes))).astype(np.float32)
    return places, values / max(1e-9, float(np.sqrt((values**2).sum())))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by adaptive gradients, in a fixed order."""
    weights, constant = np.zeros(FEATURES, np.float32), 0.0
    squares, step = np.full(FEATURES, 1e-6, np.float32), 0.4
    if not len(rows):
        return weights, constant
    flat = np.concatenate([p for p, _ in rows])
    values = np.concatenate([v for _, v in rows])
    owner = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    bulk = 1e-6
    for _ in range(STEPS):
        margin = np.bincount(owner, weights[flat] * values, len(rows)) + constant
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels).astype(np.float32)
        slope = np.bincount(flat, error[owner] * values, FEATURES).astype(np.float32) / len(rows) + 1e-7 * weights
        squares += slope * slope
        weights -= step * slope / np.sqrt(squares)
        bulk += float(error.mean()) ** 2
        constant -= 0.1 * float(error.mean()) / np.sqrt(bulk)
    return weights, constant


def quality(docs: DataFrame, *, sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """``doc_id, votes, posterior, score, kept`` of every row.

    ``votes`` has one digit per labeller (1 good, 0 bad, 2 none), ``posterior`` is what
    EM makes of them, ``score`` the linear scorer's chance of good; a row is kept where
    the score reaches ``threshold``. A missing or empty text gets every bad vote, has
    score 0 and is not kept. Long texts are read whole; repeated rows give
    one row each; an empty table gives an empty result; other columns are not looked at.
    """

    def vote(ids: list, texts: list) -> dict[str, list]:
        return {"doc_id": ids, "votes": ["".join(map(str, votes_of(t))) for t in texts]}

    counted = map_texts(docs, vote, "doc_id long, votes string").groupBy("votes").count().collect()
    names = sorted(r["votes"] for r in counted)  # at most 3 ** labellers rows
    number = {r["votes"]: r["count"] for r in counted}
    patterns = np.array([[int(c) for c in n] for n in names], int).reshape(len(names), len(LABELLERS))
    belief, _, _ = estimate(patterns, np.array([number[n] for n in names], float))
    posterior = dict(zip(names, belief.tolist(), strict=True))

    def represent(ids: list, texts: list) -> dict[str, list]:
        made = [hashed(t) for t in texts]
        return {
            "doc_id": ids,
            "places": [p.astype("<i4").tobytes() for p, _ in made],
            "values": [v.astype("<f4").tobytes() for _, v in made],
            "votes": ["".join(map(str, votes_of(t))) for t in texts],
        }

    # The hash first, so that no text goes through the ordering.
    chosen = keyed_texts(docs).select("doc_id", F.xxhash64("text").alias("mark")).orderBy("mark", "doc_id").limit(sample)
    picked = keyed_texts(docs).join(
        F.broadcast(chosen.select("mark").distinct()), F.xxhash64("text") == F.col("mark"), "left_semi"
    )  # at most ``sample`` marks
    rows = map_texts(
        picked.dropDuplicates(["text"]), represent, "doc_id long, places binary, values binary, votes string"
    ).collect()
    rows = sorted(rows, key=lambda r: (r["places"], r["values"]))
    weights, constant = train(
        [(np.frombuffer(r["places"], "<i4"), np.frombuffer(r["values"], "<f4")) for r in rows],
        np.array([posterior[r["votes"]] for r in rows]),
    )

    def score(ids: list, texts: list) -> dict[str, list]:
        votes = ["".join(map(str, votes_of(t))) for t in texts]
        chances = [posterior[v] for v in votes]
        made = [hashed(t) for t in texts]
        scores = [
            float(1 / (1 + np.exp(-np.clip(float(weights[p] @ v) + constant, -30, 30)))) if len(p) else 0.0
            for p, v in made
        ]
        kept = [s >= threshold for s in scores]
        return {"doc_id": ids, "votes": votes, "posterior": chances, "score": scores, "kept": kept}

    return map_texts(docs, score, "doc_id long, votes string, posterior double, score double, kept boolean")
