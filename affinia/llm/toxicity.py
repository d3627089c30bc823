"""Toxicity by a convolutional text classifier trained in numpy.

A word has two rows of hashed embeddings (two halves of its checksum, so that two
words share a vector only where they share both), filters of several widths slide
over the words, each filter keeps its greatest value over the whole text, and a
linear layer gives a logit. Thresholds are calibrated on rows kept from training, one
per language that the text itself shows by its function words; a score of 0.5 is the
threshold.

Where the labelled rows are few (``SAMPLE`` of each class, ``SAMPLE_WORDS`` words
together), one process fits to all of them. Where they are more, that fit, to a part
chosen by a hash of the id, only gives the starting values. Then every labelled row is
learned from: groups of rows each move the values by themselves, and after each of
``ROUNDS`` rounds a value moves by the mean over the groups that moved it. Thresholds come
from the logits of all rows kept for calibration, counted by class in steps of
``1 / STEPS``. No text is cut. Scoring is one pass over all texts without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.common import keyed_texts, map_texts, perhaps_among
from affinia.sources.workspace import staged

ROWS = 1 << 16
DEPTH = 8
FILTERS = 12
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS) - 1
#: Labelled rows of each class that the first fit reads at most, and words of all such rows.
SAMPLE = {1: 2500, 0: 5000}
SAMPLE_WORDS = 24_000_000
#: Words in fewer sampled rows keep a vector of nearly nothing.
LEAST_ROWS = 3
#: Words of one stretch of a long text; greatest values of stretches are combined.
STRETCH = 50_000
#: Calibration rows of a language, of either class, below which the common threshold holds.
LEAST_CALIBRATION = 25

#: Labelled rows, and characters, of a group that learns by itself, over all rounds.
GROUP_ROWS = 4_096
GROUP_CHARS = 24_000_000
#: Rounds of the pass over all labelled rows; each row is in one of them.
ROUNDS = 2
#: First and last rate of a group's learning, and rows of a batch.
RATES = (0.004, 0.001)
BATCH = 48
#: Logits of calibration rows are counted in steps of a part of one, up to a limit.
STEPS = 256
LIMIT = 30
#: Values of one row of the table of moves.
MOVED = 8
#: Moves are shuffled as whole numbers of this part of one.
SCALE = 1 << 30

WORDS = re.compile(r"[^\W_]+")
# Frequent function words, by which a text shows its language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are as with be at by this from",
    "fr": "le la les des du et un une est que qui dans pour au pas",
    "de": "der die das und zu von den mit nicht ein eine ist auf dem im sich",
    "es": "el los las de y en que un una por con para del se",
}
LANGUAGES = (*FUNCTION_WORDS, "other")


class Codes(dict):
    """Checksums of words, remembered up to a number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        code = self[word] = crc32(word.encode())
        return code


_codes = Codes()


def codes_of(text: str | None) -> np.ndarray:
    found = WORDS.findall((text or "").lower())
    return np.fromiter(map(_codes.__getitem__, found), np.uint32, len(found))


def _language_table() -> tuple[np.ndarray, np.ndarray]:
    high, language = np.zeros(ROWS, np.uint16), np.full(ROWS, len(FUNCTION_WORDS), np.int8)
    shared = {w for a in FUNCTION_WORDS for b in FUNCTION_WORDS if a != b
              for w in set(FUNCTION_WORDS[a].split()) & set(FUNCTION_WORDS[b].split())}
    for k, words in enumerate(FUNCTION_WORDS.values()):
        for word in set(words.split()) - shared:
            code = crc32(word.encode())
            high[code & 0xFFFF], language[code & 0xFFFF] = code >> 16, k
    return high, language


_HIGH, _LANGUAGE = _language_table()


def language_of(codes: np.ndarray) -> int:
    """Index in ``LANGUAGES`` of the language whose function words are the most."""
    low = codes & 0xFFFF
    found = _LANGUAGE[low][_HIGH[low] == codes >> 16]
    counts = np.bincount(found, minlength=len(LANGUAGES))[: len(FUNCTION_WORDS)]
    return int(counts.argmax()) if counts.any() else len(FUNCTION_WORDS)


@dataclass
class Model:
    first: np.ndarray
    second: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    output: np.ndarray
    constant: float
    thresholds: np.ndarray

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        return self.first[codes & 0xFFFF] + self.second[codes >> 16]

    def responses(self, vectors: np.ndarray) -> list[np.ndarray]:
        """For each width, what its filters say at every place (rows: places)."""
        made = []
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            places = len(vectors) - width + 1
            made.append(sum(vectors[j : j + places] @ weights[j] for j in range(width)))
        return made

    def peaks(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each width, its filters' greatest responses and the words they start at.

        Any length, in stretches; ``PAD`` empty words stand before and after the text.
        """
        best: list[tuple[np.ndarray, np.ndarray]] = []
        empty = np.zeros((PAD, DEPTH), np.float32)
        for start in range(0, max(1, len(codes)), STRETCH):
            vectors = self.vectors(codes[start : start + STRETCH + PAD])
            replies = self.responses(np.concatenate([empty, vectors, empty]))
            places = [r.argmax(axis=0) for r in replies]
            found = [(r[p, range(FILTERS)], p + start - PAD) for r, p in zip(replies, places, strict=True)]
            if best:
                found = [
                    (np.maximum(old, new), np.where(new > old, place, before))
                    for (old, before), (new, place) in zip(best, found, strict=True)
                ]
            best = found
        return best

    def pooled(self, codes: np.ndarray) -> np.ndarray:
        """Greatest responses over a whole text, after rectifying; places are not asked for."""
        best = None
        empty = np.zeros((PAD, DEPTH), np.float32)
        for start in range(0, max(1, len(codes)), STRETCH):
            vectors = self.vectors(codes[start : start + STRETCH + PAD])
            tops = [r.max(axis=0) for r in self.responses(np.concatenate([empty, vectors, empty]))]
            best = tops if best is None else [np.maximum(a, b) for a, b in zip(best, tops, strict=True)]
        return np.concatenate([np.maximum(t + b, 0) for t, b in zip(best, self.biases, strict=True)])

    def logit(self, codes: np.ndarray) -> float:
        return float(self.pooled(codes) @ self.output + self.constant)

    def score(self, codes: np.ndarray) -> float:
        margin = self.logit(codes) - self.thresholds[language_of(codes)]
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


class Adam:
    def __init__(self, values: list[np.ndarray], rate: float):
        self.values, self.rate, self.step = values, rate, 0
        self.mean = [np.zeros_like(v) for v in values]
        self.square = [np.zeros_like(v) for v in values]

    def move(self, slopes: list[np.ndarray]) -> None:
        self.step += 1
        for v, g, m, s in zip(self.values, slopes, self.mean, self.square, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            v -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(s / (1 - 0.999**self.step)) + 1e-8)


def fresh(draw: np.random.Generator) -> Model:
    """A model that has learned nothing."""
    return Model(
        draw.normal(0, 0.01, (ROWS, DEPTH)).astype(np.float32),
        draw.normal(0, 0.01, (ROWS, DEPTH)).astype(np.float32),
        [draw.normal(0, 0.5, (w, DEPTH, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        np.abs(draw.normal(0, 0.3, FILTERS * len(WIDTHS))).astype(np.float32),
        0.0,
        np.zeros(len(LANGUAGES)),
    )


def add_slopes(slopes: list[np.ndarray], model: Model, constant: np.ndarray, codes: np.ndarray, label: int, weight: float, size: int) -> None:
    """Add the slopes of one text's error in a batch of ``size``, in the order of ``Adam.values``."""
    peaks = model.peaks(codes)
    raw = np.concatenate([top for top, _ in peaks]) + np.concatenate(model.biases)
    active = np.maximum(raw, 0)
    logit = active @ model.output + constant[0]
    error = np.float32((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label) * weight / size)
    slopes[-2] += error * active
    slopes[-1] += error
    back = error * model.output * (raw > 0)
    for k, width in enumerate(WIDTHS):
        share = back[k * FILTERS : (k + 1) * FILTERS]
        slopes[2 + len(WIDTHS) + k] += share
        for j in range(width):
            place = peaks[k][1] + j
            inside = np.flatnonzero((place >= 0) & (place < len(codes)))
            met = codes[place[inside]]
            slopes[2 + k][j][:, inside] += model.vectors(met).T * share[inside]
            pulled = (model.filters[k][j][:, inside] * share[inside]).T
            np.add.at(slopes[0], met & 0xFFFF, pulled)
            np.add.at(slopes[1], met >> 16, pulled)


def train(samples: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, *, steps: int = 700, size: int = 48, seed: int = 7) -> Model:
    """Fit by sampled batches; a batch draws the classes evenly and weights them back."""
    draw = np.random.default_rng(seed)
    seen: dict[int, int] = {}
    for codes in samples:
        for code in np.unique(codes).tolist():
            seen[code] = seen.get(code, 0) + 1
    usual = np.array(sorted(c for c, n in seen.items() if n >= LEAST_ROWS), np.uint32)
    kept = [codes[np.isin(codes, usual)] for codes in samples]
    model = fresh(draw)
    constant = np.zeros(1, np.float32)
    adam = Adam([model.first, model.second, *model.filters, *model.biases, model.output, constant], 0.02)
    classes = [np.flatnonzero(labels == k) for k in (0, 1)]
    for step in range(steps):
        adam.rate = 0.02 * (1 - step / steps) + 0.001
        batch = np.concatenate([draw.choice(c, size // 2) for c in classes])
        slopes = [np.zeros_like(v) for v in adam.values]
        for i in batch:
            codes = kept[i][draw.random(len(kept[i])) > 0.15]
            add_slopes(slopes, model, constant, codes, labels[i], weights[i], len(batch))
        for k in range(2 + len(WIDTHS)):
            slopes[k] += 1e-5 * adam.values[k]
        adam.move(slopes)
    model.constant = float(constant[0])
    return model


def best_threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """Middle of the cut that errs least, errors weighted to the whole labelled table."""
    order = np.argsort(logits, kind="stable")
    logits, gain = logits[order], np.where(labels[order] == 1, weights[order], -weights[order])
    errors = np.concatenate([[0.0], np.cumsum(gain)])
    edges = np.concatenate([[logits[0] - 2], logits, [logits[-1] + 2]])
    ties = np.concatenate([[True], np.diff(logits) > 0, [True]])
    errors[~ties] = np.inf
    k = np.flatnonzero(errors <= errors.min() + 1e-12)
    k = k[len(k) // 2]
    return float((edges[k] + edges[k + 1]) / 2)


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: a checksum of the id divides by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _values(model: Model) -> list[np.ndarray]:
    """The arrays that are learned, in the order of ``Adam.values``; the constant is a copy."""
    constant = np.array([model.constant], np.float32)
    return [model.first, model.second, *model.filters, *model.biases, model.output, constant]


def _flat(values: list[np.ndarray]) -> np.ndarray:
    """All values in rows of ``MOVED``, the last one filled up with zeros."""
    whole = np.concatenate([v.ravel() for v in values])
    return np.concatenate([whole, np.zeros(-len(whole) % MOVED, whole.dtype)]).reshape(-1, MOVED)


def _moved(model: Model, moves: np.ndarray) -> Model:
    """``model`` with ``moves`` (as ``_flat`` has them) added."""
    at, made = 0, []
    for value in _values(model):
        made.append((value + moves.ravel()[at : at + value.size].reshape(value.shape)).astype(np.float32))
        at += value.size
    k = 2 + len(WIDTHS)
    return Model(made[0], made[1], made[2:k], made[k:-2], made[-2], float(made[-1][0]), model.thresholds.copy())


def learned(model: Model, samples: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, seed: int) -> np.ndarray:
    """How one pass over the samples moves the values of ``model``, as ``_flat`` has them."""
    draw = np.random.default_rng(seed)
    own = _moved(model, np.zeros_like(_flat(_values(model))))
    values = _values(own)
    adam = Adam(values, RATES[0])
    order = draw.permutation(len(samples))
    for start in range(0, len(order), BATCH):
        adam.rate = RATES[0] + (RATES[1] - RATES[0]) * start / len(order)
        slopes = [np.zeros_like(v) for v in values]
        for i in order[start : start + BATCH]:
            codes = samples[i][draw.random(len(samples[i])) > 0.15]
            add_slopes(slopes, own, values[-1], codes, labels[i], weights[i], BATCH)
        adam.move(slopes)
    return _flat(values) - _flat(_values(model))


def _moves_of(model: Model, share: np.ndarray, turn: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What a group of rows does to ``model``: place and moves, as whole numbers, of rows of ``_flat``."""

    def learn(coded: pa.Table, known: pa.Table) -> pa.Table:
        toxic = dict(zip(known["doc_id"].to_pylist(), known["toxic"].to_pylist(), strict=True))
        rows = zip(coded["doc_id"].to_pylist(), coded["codes"].to_pylist(), strict=True)
        rows = sorted((i, codes) for i, codes in rows if i in toxic)
        labels = np.array([toxic[i] for i, _ in rows], int)
        samples = [np.frombuffer(codes, np.uint32) for _, codes in rows]
        moves = np.rint(learned(model, samples, labels, share[labels], turn) * SCALE).astype(np.int64)
        place = np.flatnonzero(moves.any(axis=1))
        columns = [pa.array(place, pa.int32()), *[pa.array(moves[place, j]) for j in range(MOVED)]]
        return pa.Table.from_arrays(columns, ["place", *[f"m{j}" for j in range(MOVED)]])

    return learn


def learn_from_all(model: Model, texts: DataFrame, known: DataFrame, totals: dict[int, int], groups: int) -> Model:
    """``model`` after ``ROUNDS`` rounds over the rows of ``texts`` whose class is ``known``.

    A group of rows learns where it lies: each text's codes are shuffled once, in one of
    the rounds. Of what a group learned only the moves are shuffled, as whole numbers, so
    that their sums do not depend on the order. The driver gets one row for each ``MOVED``
    values of the model. ``totals`` counts the known rows of each class.
    """
    share = np.array([sum(totals.values()) / (2 * totals[k]) for k in (0, 1)])
    drawn = F.xxhash64(F.lit("group"), "doc_id")
    part = F.pmod(F.shiftright(drawn, 8), F.lit(groups)).alias("part")
    names = [f"m{j}" for j in range(MOVED)]
    schema = ", ".join(["place int", *[f"{name} long" for name in names]])
    for turn in range(ROUNDS):
        here = F.pmod(drawn, F.lit(ROUNDS)) == turn
        coded = _coded(texts.where(here)).select(part, "doc_id", "codes")
        marks = known.where(here).select(part, "doc_id", "toxic")
        moved = coded.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(_moves_of(model, share, turn), schema)
        found = moved.groupBy("place").agg(F.count("*").alias("n"), *[F.sum(name).alias(name) for name in names]).toArrow()
        moves = np.zeros_like(_flat(_values(model)))
        total = np.stack([found[name].to_numpy() for name in names], axis=1)
        moves[found["place"].to_numpy()] = total / found["n"].to_numpy()[:, None] / SCALE
        model = _moved(model, moves)
    return model


def calibrate(model: Model, texts: DataFrame, known: DataFrame) -> None:
    """Set the thresholds by all rows of ``texts`` whose class is ``known``, counted by step of their logits."""

    def work(ids: list, bodies: list) -> dict[str, list]:
        codes = [codes_of(t) for t in bodies]
        steps = [round(np.clip(model.logit(c), -LIMIT, LIMIT) * STEPS) for c in codes]
        return {"doc_id": ids, "language": [language_of(c) for c in codes], "step": steps}

    told = map_texts(texts, work, "doc_id long, language int, step int").join(known.select("doc_id", "toxic"), "doc_id")
    counted = told.groupBy("language", "step", "toxic").count().collect()
    rows = np.array(sorted((r["language"], r["step"], r["toxic"], r["count"]) for r in counted), np.int64)
    language, logits, marks, counts = rows[:, 0], rows[:, 1] / STEPS, rows[:, 2], rows[:, 3].astype(float)
    model.thresholds[:] = best_threshold(logits, marks, counts)
    for k in range(len(LANGUAGES)):
        own = language == k
        if min(np.bincount(marks[own], counts[own], minlength=2)) >= LEAST_CALIBRATION:
            model.thresholds[k] = best_threshold(logits[own], marks[own], counts[own])


def _coded(texts: DataFrame) -> DataFrame:
    """doc_id, words and codes (checksums of the words) of every text."""

    def work(ids: list, bodies: list) -> dict[str, list]:
        codes = [codes_of(t) for t in bodies]
        return {"doc_id": ids, "words": [len(c) for c in codes], "codes": [c.tobytes() for c in codes]}

    return map_texts(texts, work, "doc_id long, words long, codes binary")


def fit(docs: DataFrame, labels: DataFrame, *, sample: dict[int, int] | None = None) -> Model | None:
    """A model from all labelled rows that are not held out; None where a class has none.

    ``sample`` bounds the rows of each class that the first fit reads.
    """
    sample = sample or SAMPLE
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return None
    chosen = None
    for toxic, most in sample.items():
        part = known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most sum(SAMPLE) ids, so the broadcast has a proven bound.
    texts = keyed_texts(docs).join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    coded = staged(_coded(texts), "codes")
    # Whole rows by a hash of their id while their words fit: of equal ids all or none.
    sizes = coded.groupBy("doc_id").agg(F.sum("words").alias("words")).collect()
    fitting, room = [], SAMPLE_WORDS
    for row in sorted(sizes, key=lambda r: (crc32(f"sample {r['doc_id']}".encode()), r["doc_id"])):
        if row["words"] <= room:
            fitting.append(row["doc_id"])
            room -= row["words"]
    toxic = {r["doc_id"]: r["toxic"] for r in chosen.collect()}
    read = coded.where(F.col("doc_id").isin(fitting)).select("doc_id", "codes")
    rows = sorted((r["doc_id"], bytes(r["codes"])) for r in read.collect())
    few = len(fitting) == len(sizes) and all(totals[k] <= sample.get(k, 0) for k in totals)
    if few and len({toxic[i] for i, _ in rows}) < 2:
        return None
    samples = [np.frombuffer(c, np.uint32) for _, c in rows]
    marks = np.array([toxic[i] for i, _ in rows], int)
    apart = np.array([crc32(f"calibrate {i}".encode()) % 5 == 0 for i, _ in rows], bool)
    if len(set(marks[~apart])) < 2 or len(set(marks[apart])) < 2:
        apart = np.zeros(len(rows), bool)
    learn = np.flatnonzero(~apart)
    if not few:
        return _fit_to_all(docs, known, [samples[i] for i in learn], marks[learn])
    drawn = np.bincount(marks, minlength=2)
    weights = np.array([totals[m] / drawn[m] for m in marks])
    weights /= weights.mean()
    model = train([samples[i] for i in learn], marks[learn], np.ones(len(learn)))
    check = np.flatnonzero(apart) if apart.any() else learn
    logits = np.array([model.logit(samples[i]) for i in check])
    spoken = np.array([language_of(samples[i]) for i in check])
    model.thresholds[:] = best_threshold(logits, marks[check], weights[check])
    for k in range(len(LANGUAGES)):
        own = spoken == k
        if min(np.bincount(marks[check][own], minlength=2)) >= LEAST_CALIBRATION:
            model.thresholds[k] = best_threshold(logits[own], marks[check][own], weights[check][own])
    return model


def _fit_to_all(docs: DataFrame, known: DataFrame, samples: list[np.ndarray], marks: np.ndarray) -> Model | None:
    """A model from all rows of ``known``, started from a fit to some; None where a class has none."""
    known = staged(known, "known")
    texts = perhaps_among(keyed_texts(docs).where("doc_id is not null"), known, "doc_id")
    apart = F.pmod(F.crc32(F.concat(F.lit("calibrate "), F.col("doc_id").cast("string")).cast("binary")), F.lit(5)) == 0
    sizes = texts.select("doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("chars")).join(known, "doc_id")
    counted = sizes.groupBy("toxic", apart.alias("apart")).agg(F.count("*").alias("rows"), F.sum("chars").alias("chars")).collect()
    if len({r["toxic"] for r in counted}) < 2:
        return None
    learning, checking = texts, texts
    if len(counted) == 4:
        learning, checking = texts.where(~apart), texts.where(apart)
        counted = [r for r in counted if not r["apart"]]
    totals = {k: sum(r["rows"] for r in counted if r["toxic"] == k) for k in (0, 1)}
    chars = sum(r["chars"] for r in counted)
    groups = max(-(-sum(totals.values()) // GROUP_ROWS), -(-chars // GROUP_CHARS))
    model = train(samples, marks, np.ones(len(marks))) if len(set(marks)) == 2 else fresh(np.random.default_rng(7))
    model = learn_from_all(model, learning, known, totals, groups)
    calibrate(model, checking, known)
    return model


def score_texts(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row; 0.5 is the threshold.

    A missing text counts as empty and has a score. Without a model every score is
    0. Long texts are read whole; repeated rows give one row each; an empty table
    gives an empty result; other columns are not looked at.
    """

    def work(ids: list, texts: list) -> dict[str, list]:
        scores = [0.0 if model is None else model.score(codes_of(t)) for t in texts]
        return {"doc_id": ids, "score": scores}

    return map_texts(docs, work, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, all columns unchanged.

    One pass: a row is judged where it lies, so nothing is joined or shuffled.
    """
    if model is None:
        return docs
    names = docs.columns

    def keep(stream):
        for batch in stream:
            texts = batch.column(names.index("text")).to_pylist()
            good = pa.array([model.score(codes_of(t)) < 0.5 for t in texts], pa.bool_())
            yield batch.filter(good)

    return docs.mapInArrow(keep, docs.schema)
