"""The Merkle manifest against a plain recursive one, and against SQL in test_registered."""

from __future__ import annotations

from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from affinia.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(digests, fanout):
    """Root and the path of every leaf, as (before, after) pairs."""
    paths = [[] for _ in digests]
    owners = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, held = [], []
        for s in range(0, len(digests), fanout):
            run = digests[s : s + fanout]
            for k in range(len(run)):
                for i in owners[s + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h(*run))
            held.append([i for o in owners[s : s + fanout] for i in o])
        digests, owners = above, held
    return digests[0], paths


def expected(rows, fanout):
    order = lambda r: (r[0] is not None, r[0] or 0, leaf(r))
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = [climb([leaf(r) for r in sorted(groups[s], key=order)], fanout) for s in sources]
    if not made:
        return []
    root, tops = climb([m[0] for m in made], fanout)
    out = []
    for s, (subroot, paths), top in zip(sources, made, tops, strict=True):
        for r, path in zip(sorted(groups[s], key=order), paths, strict=True):
            held = (*r[:4], r[4].replace("\n", "") if r[4] and r[0] is not None and crc32(str(r[0]).encode()) % 2 == 0 else r[4])
            folded = leaf(held)
            for before, after in path + top:
                folded = h(before, folded, after)
            proof = h(*(b + a for b, a in path + top))
            out.append((r[0], leaf(r), subroot, root, proof, folded, folded == root))
    return out


def documents(spark, rows):
    """Rows with further columns whose names results and joins use too."""
    full = [(*r, "x", 1, "y", 2) for r in rows]
    return spark.createDataFrame(
        full,
        "doc_id long, source string, lang string, n_chars long, text string, "
        "digest string, tree int, path string, n int",
    )


def key(row):
    return tuple((v is None, v) for v in row)


ROWS = [
    *((i, "big", "en", i * 7, f"line {i}\nand ü {i}\n") for i in range(1, 42)),
    *((i, "four", None, None, "text\n") for i in range(50, 54)),
    (60, "one", "de", 0, ""), (61, None, "de", 3, None), (None, "no id", "en", 1, "a\nb"),
    (None, "no id", "en", 1, "a\nb"), (None, None, None, None, None), (62, "", "fr", 1, "x"),
    (63, "Ünder", "fr", 1, "\n" * 40), (64, "under", "fr", 1, "long " * 20_000),
    (65, "tie", "en", 1, "b"), (65, "tie", "en", 1, "a"), (65, "tie", "en", 1, "a"),
]


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_is_the_plain_one(spark, fanout):
    made = merkle.build_manifest(documents(spark, ROWS), merkle.tampered_text(), fanout)
    found = made.paths()
    got = [
        (r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded, r.folded == r.root)
        for r in found.select(
            "*",
            merkle.siblings_digest(F.col("path")).alias("proof"),
            merkle.fold(F.col("altered"), F.col("path")).alias("folded"),
        ).collect()
    ]
    assert sorted(got, key=key) == sorted(expected(ROWS, fanout), key=key)
    assert made.root() == got[0][3]


def test_query_columns_and_no_rows(spark):
    assert merkle.verified_documents(documents(spark, []), merkle.tampered_text()).collect() == []
    assert merkle.build_manifest(documents(spark, [])).root() is None
    one = merkle.verified_documents(documents(spark, ROWS[:1]), merkle.tampered_text()).collect()
    assert [tuple(r) for r in one] == expected(ROWS[:1], 3)


def test_siblings_are_by_xor_or_slot(spark):
    made = spark.range(9).withColumnRenamed("id", "index").select(
        merkle.sibling_index(1, 2).alias("pair"), merkle.sibling_index(1, 3).alias("next"), merkle.sibling_index(2, 3).alias("third")
    )
    rows = [tuple(r) for r in made.collect()]
    assert [r[0] for r in rows] == [1, 0, 3, 2, 5, 4, 7, 6, 9]
    assert [r[1:] for r in rows[:3]] == [(1, 2), (2, 0), (0, 1)]


def test_levels_are_equijoins(spark):
    nodes = spark.range(20).selectExpr("id % 2 AS tree", "id div 2 AS index", "10L AS n", "string(id) AS digest")
    plan = merkle.sibling_runs(nodes, 3)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
