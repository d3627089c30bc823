"""Quality rules, weak labels, toxicity, identifiers and the pipeline."""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import partial
from hashlib import sha256
from zlib import crc32

import numpy as np
import zstandard

import corpus_pipeline
from affinia.llm import compression, identifiers, toxicity, weak_labels


def key(row):
    return tuple((v is None, v) for v in row)


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered, seen, repeats = Counter(windows), set(), set(), 0
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered |= set(range(i, i + 8))
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, repeats, len(covered), failed


def test_measures_are_those_of_brute_force(frame, odd, small):
    draw = random.Random(9)
    rows = [*odd, *((r.doc_id + 1000, r.text) for r in small.collect())]
    rows += [(5000 + i, " ".join(draw.choice("ab") for _ in range(draw.randint(0, 60)))) for i in range(60)]
    got = compression.quality_rules(frame(rows)).collect()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = [(i, *plain_measures(t)) for i, t in rows]
    assert sorted((tuple(r[n] for n in names) for r in got), key=key) == sorted(expected, key=key)
    assert not any(r.kept for r in got if r.base_failed)
    assert compression.quality_rules(frame([])).collect() == []


def test_bands_reject_noise_and_repetition(frame, small):
    draw = random.Random(1)
    noise = " ".join("".join(chr(draw.randint(0x21, 0x7E)) for _ in range(9)) for _ in range(900))
    pattern = " ".join(f"row {i % 7} of the same table again" for i in range(3000))
    clean = max((r.text for r in small.where("lang = 'en'").collect()), key=lambda t: len(set(t.split())))
    kept = {r.doc_id: r.kept for r in compression.quality_rules(frame([(1, noise), (2, pattern), (3, clean)])).collect()}
    assert kept == {1: False, 2: False, 3: True}


def test_the_end_of_a_text_is_judged_too():
    draw = random.Random(6)
    vocabulary = ["".join(draw.choice("abcdefghijklmnoprstu") for _ in range(draw.randint(2, 9))) for _ in range(1500)]
    clean = " ".join(draw.choice(vocabulary) for _ in range(2000)).encode()
    noise = bytes(draw.randint(0x21, 0x7E) for _ in range(4004))
    verdict = partial(compression.band_verdict, compressor=zstandard.ZstdCompressor(level=compression.LEVEL))
    ratio, low, high, count, good = verdict(clean[:4096] + noise)
    assert 0.33 <= ratio <= 0.80
    assert (low, high, count, good) == (0, 1, 2, False)
    assert verdict(clean[:8100])[1:] == (0, 0, 2, True)
    assert verdict(clean[:3000])[1:] == (0, 0, 1, True)


def plain_kept(text):
    """The verdict by a loop of its own: base rules, band of the whole, share of bad bytes."""
    data = (text or "").encode()
    if plain_measures(text)[-1]:
        return False
    packed = [len(zstandard.ZstdCompressor(level=3).compress(data))]
    below = [k for k, b in enumerate(compression.BANDS) if b[0] <= len(data)]
    if not below:
        least, most = 0.0, compression.MOST_SHORT
    elif below[-1] + 1 == len(compression.BANDS):
        _, least, most = compression.BANDS[-1]
    else:
        (n, a, b), (m, c, d) = compression.BANDS[below[-1] : below[-1] + 2]
        share = np.log(len(data) / n) / np.log(m / n)
        least, most = a + share * (c - a), b + share * (d - b)
    bad = 0
    if len(data) >= 4096:
        for start in range(0, len(data), 4096):
            end = min(len(data), start + 4096)
            packed.append(len(zstandard.ZstdCompressor(level=3).compress(data[end - 4096 : end])))
            low, high = compression.CHUNK_BAND
            bad += end - start if not low <= packed[-1] / 4096 <= high else 0
    return least <= packed[0] / len(data) <= most and 4 * bad <= len(data)


def test_bands_by_brute_force_and_by_labels(spark, frame, odd):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r.kept for r in compression.quality_rules(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert all(got[i] == plain_kept(t) for i, t in texts.items())
    rows = compression.quality_rules(frame(odd)).select("doc_id", "kept").collect()
    assert sorted(map(tuple, rows), key=key) == sorted(((i, plain_kept(t)) for i, t in odd), key=key)
    held = [
        (got[r.doc_id], r.quality)
        for r in spark.read.parquet(f"{folder}/labels.parquet").collect()
        if r.doc_id in got and crc32(str(r.doc_id).encode()) % 5 == 0 and not plain_measures(texts[r.doc_id])[-1]
    ]
    good, bad = ([kept for kept, quality in held if quality == q] for q in (1, 0))
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.45


def test_em_finds_good_and_bad_labellers():
    draw = np.random.default_rng(3)
    truth = (draw.random(20_000) < 0.7).astype(int)
    accuracy = [0.95, 0.9, 0.8, 0.85, 0.55]
    votes = np.stack([np.where(draw.random(len(truth)) < a, truth, 1 - truth) for a in accuracy], axis=1)
    votes[draw.random(votes.shape) < 0.2] = weak_labels.NONE
    patterns, place, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    belief, shares, prior = weak_labels.estimate(patterns, counts.astype(float))
    assert abs(prior - 0.7) < 0.03
    estimated = shares[1, :, 1] / shares[1, :, :2].sum(axis=1)
    assert np.abs(estimated - accuracy).max() < 0.05
    assert ((belief[place.ravel()] >= 0.5) == truth).mean() > 0.94


def test_weak_labels_agree_with_the_labels(spark, frame, odd):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id: r.kept for r in weak_labels.quality(docs).collect()}
    assert np.mean([kept[i] for i, q in labels.items() if q]) > 0.95
    assert np.mean([not kept[i] for i, q in labels.items() if not q]) > 0.8
    rows = weak_labels.quality(frame(odd)).collect()
    assert sorted((r.doc_id or -1) for r in rows) == sorted((i or -1) for i, _ in odd)
    assert not any(r.kept for r in rows if r.doc_id in (1, 2, 3))
    assert weak_labels.quality(frame([])).collect() == []


def test_peaks_agree_with_pooling_over_stretches(monkeypatch):
    draw = np.random.default_rng(4)
    codes = draw.integers(0, 1 << 32, 900).astype(np.uint32)
    model = toxicity.train([codes[:400], codes[400:]] * 3, np.array([0, 1] * 3), np.ones(6), steps=5)
    whole = model.pooled(codes)
    for stretch in (7, 100, 50_000):
        monkeypatch.setattr(toxicity, "STRETCH", stretch)
        tops = [np.maximum(t + b, 0) for (t, _), b in zip(model.peaks(codes), model.biases, strict=True)]
        assert np.allclose(np.concatenate(tops), whole, atol=1e-6)
        assert np.allclose(model.pooled(codes), whole, atol=1e-6)
        empty = np.zeros((toxicity.PAD, toxicity.DEPTH), np.float32)
        vectors = np.concatenate([empty, model.vectors(codes), empty])
        for reply, (_, places) in zip(model.responses(vectors), model.peaks(codes), strict=True):
            assert (reply.argmax(axis=0) - toxicity.PAD == places).all()


def test_a_text_beyond_the_words_of_the_sample_is_left_out_whole(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 500)
    monkeypatch.setattr(toxicity, "train", lambda samples, *rest: seen.extend(samples) or toxicity.Model(
        np.zeros((toxicity.ROWS, toxicity.DEPTH), np.float32), np.zeros((toxicity.ROWS, toxicity.DEPTH), np.float32),
        [np.zeros((w, toxicity.DEPTH, toxicity.FILTERS), np.float32) for w in toxicity.WIDTHS],
        [np.zeros(toxicity.FILTERS, np.float32) for _ in toxicity.WIDTHS],
        np.zeros(toxicity.FILTERS * len(toxicity.WIDTHS), np.float32), 0.0, np.zeros(len(toxicity.LANGUAGES))))
    rows = [(i, "bad word " * (400 if i == 3 else 4)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is not None
    assert seen and {len(s) for s in seen} == {8}


def test_toxicity_on_rows_held_out(spark, frame, odd):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels, sample={1: 400, 0: 800})
    toxic = {r.doc_id: r.toxic for r in labels.collect() if crc32(str(r.doc_id).encode()) % 5 == 0}
    scores = {r.doc_id: r.score for r in toxicity.score_texts(docs.where("doc_id is not null"), model).collect()}
    held = [(scores[i] >= 0.5, bool(t)) for i, t in toxic.items() if i in scores]
    assert np.mean([p == t for p, t in held]) > 0.95
    assert np.mean([p for p, t in held if t]) > 0.7
    assert np.mean([p for p, t in held if not t]) < 0.02
    rows = toxicity.score_texts(frame(odd), model).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    kept = toxicity.without_toxic(frame(odd), model)
    assert kept.schema == frame(odd).schema
    assert toxicity.score_texts(frame([]), model).collect() == []


def test_every_labelled_row_counts_beyond_the_first_fit(spark, monkeypatch):
    rows = [(i, ("vile " if i % 2 else "kind ") + f"word{i % 7} " * 5) for i in range(400)]
    # Rows of ids from 400 on show a second mark that the first fit hardly sees.
    rows += [(i, ("foul " if i % 2 else "mild ") + f"word{i % 7} " * 5) for i in range(400, 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    seen = {}

    def marked(texts, known):
        return {r.doc_id: r.toxic for r in texts.join(known, "doc_id").select("doc_id", "toxic").collect()}

    def learn(model, texts, known, *rest):
        seen.update(marked(texts, known))
        return learn_from_all(model, texts, known, *rest)

    def calibrate(model, texts, known):
        checked = marked(texts, known)
        assert checked and not set(seen) & set(checked)
        seen.update(checked)
        calibrated(model, texts, known)

    learn_from_all, calibrated = toxicity.learn_from_all, toxicity.calibrate
    monkeypatch.setattr(toxicity, "learn_from_all", learn)
    monkeypatch.setattr(toxicity, "calibrate", calibrate)
    model = toxicity.fit(docs, labels, sample={1: 20, 0: 20})
    assert seen == {i: i % 2 for i, _ in rows if crc32(str(i).encode()) % 5}
    held = docs.where(toxicity.held_out(docs.doc_id))
    judged = [(r.score >= 0.5) == bool(r.doc_id % 2) for r in toxicity.score_texts(held, model).collect()]
    assert np.mean(judged) > 0.95


def test_moves_are_averaged_over_the_groups_that_made_them(spark, monkeypatch):
    model = toxicity.fresh(np.random.default_rng(3))
    rows = [(i, f"a{i % 3} b c d e{i}") for i in range(12)]
    codes = [toxicity.codes_of(text) for _, text in rows]
    texts = spark.createDataFrame([*rows, (99, "not marked")], "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "ROUNDS", 1)
    alone = toxicity._flat(toxicity._values(toxicity.learn_from_all(model, texts, known, {0: 6, 1: 6}, 1)))
    moves = toxicity.learned(model, codes, np.array([i % 2 for i in range(12)]), np.ones(12), 0)
    assert np.abs(moves).max() > 0
    assert np.allclose(alone, toxicity._flat(toxicity._values(model)) + moves, atol=1e-6)
    first, again = (toxicity._values(toxicity.learn_from_all(model, texts, known, {0: 6, 1: 6}, 4)) for _ in range(2))
    assert all((a == b).all() for a, b in zip(first, again, strict=True))


def test_no_labels_give_no_model(spark, frame):
    none = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    assert toxicity.fit(frame([(1, "x")]), none) is None
    assert [r.score for r in toxicity.score_texts(frame([(1, "x")]), None).collect()] == [0.0]
    assert toxicity.without_toxic(frame([(1, "x")]), None).count() == 1


def test_a_long_text_is_pooled_in_stretches(monkeypatch):
    draw = np.random.default_rng(0)
    model = toxicity.Model(
        draw.normal(size=(toxicity.ROWS, toxicity.DEPTH)), draw.normal(size=(toxicity.ROWS, toxicity.DEPTH)),
        [draw.normal(size=(w, toxicity.DEPTH, toxicity.FILTERS)) for w in toxicity.WIDTHS],
        [np.zeros(toxicity.FILTERS) for _ in toxicity.WIDTHS],
        draw.normal(size=toxicity.FILTERS * len(toxicity.WIDTHS)), 0.0, np.zeros(len(toxicity.LANGUAGES)),
    )
    codes = toxicity.codes_of(" ".join(f"w{i}" for i in range(200)))
    whole = model.pooled(codes)
    monkeypatch.setattr(toxicity, "STRETCH", 30)
    assert (model.pooled(codes) >= whole - 1e-9).all()


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text):
    found = [
        (m.start(), k, m.end())
        for k, (kind, rule) in enumerate(RULES.items())
        for m in re.finditer(rule, text or "")
        if holds(kind, m.group())
    ]
    return sorted(found)


def joined(spans):
    return ",".join(f"{list(RULES)[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_are_those_of_the_patterns(frame, odd):
    draw = random.Random(5)
    rows = list(odd) + [
        (20, "a@b.c_d@e.f.g x@y.z@q.r +1 (988) 555-2485 é日 1.2.3.4.5.6.7.8 999.1.1.1 4041894974608795 4041 8949 7460 8795"),
        (21, "1" * 30_000), (22, "a" * 50_000 + "@" + "b." * 20_000 + "c"), (23, "a" * 50_000),
        (24, "000255.1.2.3 +12345678901234567890 +1234567890. 1-1-1"), (25, "𝒳😀 me@x.org 12.12.12.12, " * 400),
    ]
    rows += [(100 + i, "".join(draw.choice("0123456789.@+-() abé😀%_\n") for _ in range(400))) for i in range(200)]
    got = []
    for r in identifiers.span_report(frame(rows)).collect():
        got.append((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256))
    expected = []
    for i, text in rows:
        spans = base_spans(text)
        counts = Counter(k for _, k, _ in spans)
        expected.append((i, *(counts[k] for k in range(4)), sha256(joined(spans).encode()).hexdigest()))
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert identifiers.span_report(frame([])).collect() == []


def test_contexts_of_seeds_find_other_identifiers(frame):
    rows = [
        (i, f"some words customer account: {f'u{i}@x.org' if i < 12 else f'KX{i * 77:05d}Q'} closed today, room {i}12345")
        for i in range(30)
    ]
    spans = {r.doc_id: r.spans for r in identifiers.span_report(frame(rows)).collect()}
    assert all(spans[i].startswith("email:") and "id:" not in spans[i] for i in range(12))
    assert all(spans[i] == "id:29:37" for i in range(12, 30))


def test_contexts_hold_other_identifiers_and_any_digits(frame):
    rows = []
    for i in range(30):
        token = f"u{i}@x.org" if i < 15 else f"KX{i * 77:05d}Q"
        rows.append((i, f"paid 2024-05-{i + 1:02d} account: {token} / 99{i + 10} end"))
    spans = {r.doc_id: r.spans for r in identifiers.span_report(frame(rows)).collect()}
    assert all(spans[i].startswith("email:25:") and "id:" not in spans[i] for i in range(15))
    assert all(spans[i] == "id:25:33" for i in range(15, 30))


def test_accepted_identifiers_open_further_contexts(frame):
    def first(token):
        return f"some words customer account: {token} closed today by us"

    def second(token):
        return f"we shipped parcel number {token} from our depot"

    def third(token):
        return f"please quote reference {token} when you call"

    def name(i):
        return f"KX{i * 77:05d}Q"

    texts = [first(f"u{i}@x.org") for i in range(12)] + [first(name(i)) for i in range(12, 30)]
    texts += [second(name(i)) for i in range(12, 36)]  # six new ones
    texts += [third(name(i)) for i in range(28, 40)]  # four new ones
    texts += [f"page 12345{i} of many here" for i in range(10)]
    spans = {r.doc_id: r.spans for r in identifiers.span_report(frame(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts[12:-10], 12):
        start = text.index("KX")
        assert spans[i] == f"id:{start}:{start + 8}"
    assert not any(spans[len(texts) - 1 - k] for k in range(10))


def test_pipeline_keeps_clean_and_drops_bad(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "n-gram join", "decontamination", "encoding"
    ]
    last = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, last, folder)
        assert made.schema == docs.schema
        last = made
    ids = {r.doc_id for r in docs.collect()}
    result = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in result} <= ids
    assert len(result) > 0.6 * len(ids)
    assert all(r.ids_sha256 and r.decoded_sha256 for r in result)
