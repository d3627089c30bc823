"""N-gram join, line dedup and decontamination against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from affinia.llm import decontamination, line_dedup, ngram_join
from affinia.llm.components import components


class Groups:
    def __init__(self, number):
        self.up = list(range(number))

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)


def similar_groups(sets, percent=75):
    groups, inverted = Groups(len(sets)), defaultdict(list)
    for i, own in enumerate(sets):
        for j, common in Counter(j for x in own for j in inverted[x]).items():
            if 100 * common >= percent * (len(own) + len(sets[j]) - common):
                groups.join(i, j)
        for x in own:
            inverted[x].append(i)
    return groups


def word_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected_components(rows):
    sets = [word_set(t) for _, t in rows]
    groups = similar_groups(sets)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[groups.find(k)] = min(least.get(groups.find(k), i), i)
    return [
        (i, len(s), least.get(groups.find(k), i) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))
    ]


def key(row):
    return tuple((v is None, v) for v in row)


def check_components(frame, rows):
    got = [tuple(r) for r in ngram_join.similar_documents(frame(rows)).collect()]
    assert sorted(got, key=key) == sorted(expected_components(rows), key=key)


def test_join_of_short_and_edited_texts(frame, odd, monkeypatch):
    monkeypatch.setattr(ngram_join, "COMMON", 3)
    monkeypatch.setattr(ngram_join, "COMMON_IN_SLICE", 1)
    draw = random.Random(3)
    rows = list(odd)
    for i in range(100, 350):
        rows.append((i, " ".join(draw.choice("ab") for _ in range(draw.randint(0, 14)))))
    base = [str(draw.randint(0, 9)) for _ in range(40)]
    for i in range(400, 650):
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(40)] = str(draw.randint(0, 9))
        rows.append((i, " ".join(words[: draw.randint(3, 40)])))
    check_components(frame, rows)


def test_join_of_the_smallest_table(frame, small):
    check_components(frame, [(r.doc_id, r.text) for r in small.collect()])


def test_join_of_no_rows(frame):
    assert ngram_join.similar_documents(frame([])).collect() == []


def test_boundary_follows_cost():
    assert ngram_join.boundary_by_cost([], 75) == 0
    assert ngram_join.boundary_by_cost([(3, 10, 500), (4, 10, 500), (30, 10, 0)], 75) == 4
    assert ngram_join.boundary_by_cost([(30, 10, 0)], 75) == 0


def test_components_of_chains_stars_and_loops(spark):
    draw = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(500, j) for j in range(200, 240)] + [(7, 7), (900, 901), (901, 900)]
    links += [(draw.randint(1000, 1200), draw.randint(1000, 1200)) for _ in range(120)]
    nodes = sorted({n for link in links for n in link})
    groups = Groups(max(nodes) + 1)
    for a, b in links:
        groups.join(a, b)
    least = {}
    for n in nodes:
        least.setdefault(groups.find(n), n)
    got = components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == {(n, least[groups.find(n)]) for n in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def expected_drops(rows):
    lines = [
        (i, t, k, line.strip(" \t\r\x0b\f").lower())
        for i, t in rows if i is not None and t is not None
        for k, line in enumerate(t.split("\n"))
    ]
    texts = sorted({line for *_, line in lines if line})
    number = {line: k for k, line in enumerate(texts)}
    groups = similar_groups([{x[i : i + line_dedup.WIDTH] for i in range(len(x) - line_dedup.WIDTH + 1)} or {x} for x in texts])
    first = {}
    for i, _, k, line in lines:
        if line:
            g = groups.find(number[line])
            first[g] = min(first.get(g, (i, k)), (i, k))
    drops = defaultdict(set)
    for i, t, k, line in lines:
        drops[i, t].update({k} if line and first[groups.find(number[line])] != (i, k) else ())
    return drops


def test_lines_of_the_smallest_table(frame, small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    expected = {(i, k) for (i, _), places in expected_drops(rows).items() for k in places}
    got = {(r.doc_id, k) for r in line_dedup.line_report(frame(rows)).collect() for k in r.dropped}
    assert got <= expected
    assert len(got) >= 0.97 * len(expected)


def edited(draw, line):
    words = line.split()
    words[draw.randrange(len(words))] = "edited"
    return " ".join(words)


def test_near_copies_of_lines_in_large_buckets(frame):
    draw = random.Random(2)
    base = " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(40))
    rows = [(i, f"{edited(draw, base)}\nown line number {i} of {draw.random()}") for i in range(60)]
    got = {r.doc_id: list(r.dropped) for r in line_dedup.line_report(frame(rows)).collect()}
    assert got == {i: [0] if i else [] for i in range(60)}


def test_lines_of_odd_rows(frame, odd):
    rows = [*odd, (20, "A line that Repeats here\nanother one"), (21, " a line that repeats here \n\nmine"), (22, "another one")]
    cleaned = line_dedup.without_repeated_lines(frame(rows))
    assert cleaned.schema == frame(rows).schema
    got = [(r.doc_id, r.text) for r in cleaned.collect()]
    assert (20, "A line that Repeats here\nanother one") in got
    assert (21, "\nmine") in got
    assert 22 not in [i for i, _ in got] and 6 not in [i for i, _ in got]
    assert got.count((5, "the same words " * 30)) == 2
    assert (10, "line\n" + "\n".join([""])) in got
    for row in [(1, None), (2, ""), (3, " \t\n"), (None, "a text without an id"), (None, None)]:
        assert row in got
    assert line_dedup.without_repeated_lines(frame([])).collect() == []


WORDS = [f"w{k}" for k in range(400)]


@pytest.fixture(scope="module")
def bench(spark):
    draw = random.Random(11)
    items = [(k, " ".join(draw.choice(WORDS) for _ in range(draw.randint(8, 60)))) for k in range(30)]
    items += [(100, None), (101, ""), (102, "two unseen"), (103, items[0][1]), (None, "no id")]
    return items, spark.createDataFrame(items, "item_id long, text string")


def test_leaks_are_those_of_brute_force(frame, odd, bench):
    items, table = bench
    draw = random.Random(12)
    rows, planted = list(odd), set()
    for i in range(200, 320):
        body = [draw.choice(WORDS) for _ in range(draw.randint(0, 200))]
        if i % 2:
            k = draw.randrange(30)
            words = items[k][1].split()
            if i % 4 == 1 and len(words) > 50:
                words[draw.randrange(len(words))] = "changed"
            at = draw.randint(0, len(body))
            body[at:at] = [w.upper() for w in words]
            planted |= {(i, k)} | ({(i, 103)} if k == 0 else set())
        rows.append((i, " ".join(body)))
    rows += [(400, "these are two UNSEEN words"), (401, "two not unseen")]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.contaminated_documents(frame(rows), table).collect()}
    exact = {(i, k) for i, k in planted if items[k % 103 if k == 103 else k][1].lower() in dict(rows)[i].lower()}
    assert exact <= set(got)
    assert set(got) <= planted | {(400, 102)}
    assert got[400, 102] == 1.0
    left = decontamination.without_leaks(frame(rows), table)
    assert left.schema == frame(rows).schema
    gone = {i for i, _ in got}
    kept = sorted((r.doc_id or -1) for r in left.collect())
    assert kept == sorted((i or -1) for i, _ in rows if i not in gone)


def weighted_similarity(window, item, weights):
    x, y = word_set(window), word_set(item)
    total = lambda grams: sum(weights.get(g, 1.0) for g in grams)
    return total(x & y) / total(x | y)


def test_edited_passages_of_items_with_a_near_copy(spark, frame):
    draw = random.Random(21)
    items, rows = [], []
    for k in range(60):
        words = [f"{draw.choice(WORDS)}{k}" for _ in range(60)]
        items += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:-1], "other"]))]
        words[draw.randrange(5, 50)] = "changed"
        rows.append((k, " ".join(["before", *words, "after"])))
    held = Counter(g for _, text in items for g in word_set(text))
    weights = {g: 1 / n for g, n in held.items()}
    expected = set()
    for k, text in rows:
        words = text.split()
        for i, item in items[2 * k : 2 * k + 2]:
            best = max(weighted_similarity(" ".join(words[at : at + 60]), item, weights) for at in range(3))
            if best >= 0.75:
                expected.add((k, i))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated_documents(frame(rows), table).collect()}
    assert len(expected) >= 60
    assert got <= expected
    assert len(got) >= 0.97 * len(expected)


def test_leaks_of_empty_tables(spark, frame, bench):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contaminated_documents(frame([]), bench[1]).collect() == []
    assert decontamination.contaminated_documents(frame([(1, "a b c d e f")]), none).collect() == []


def test_search_misses_none_within_the_radius(spark):
    draw = random.Random(4)
    items = [(k, 9, draw.getrandbits(63)) for k in range(20)]
    windows = []
    for n in range(200):
        value = items[n % 20][2]
        for bit in draw.sample(range(63), n % 24):
            value ^= 1 << bit
        windows.append((n, 9, value))
    got = decontamination.within_radius(
        spark.createDataFrame(windows, "window long, length int, print long"),
        spark.createDataFrame(items, "item_id long, length int, print long"),
    )
    near = {(n, k) for n, _, x in windows for k, _, y in items if bin(x ^ y).count("1") <= decontamination.RADIUS}
    assert {(r.window, r.item_id) for r in got.collect()} == near
