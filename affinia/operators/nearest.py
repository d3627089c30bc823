"""The k nearest of every dense vector, by cosine, exactly (a nearest-neighbour join).

Unit vectors lie on a sphere, where the cosine c and the distance d say the same:
d = sqrt(2 - 2c). Distances obey the triangle inequality, so for a pivot p a vector v is at
least |d(q, p) - d(v, p)| away from a query q.

1. Copies are folded: equal vectors become one with a count.
2. ``pivots`` vectors are drawn by hash. Each vector goes to the cell of its nearest pivot,
   and in it to a band of distance from the pivot. How many vectors each of the
   pivots x BANDS groups holds is a table of a fixed size; it is all that reaches the driver.
3. Groups in a row make blocks of about the same size; a crowded group is cut by hash.
4. Each block meets itself in the memory of a task, where the k-th best of a vector's own
   group, and then of its block, bounds how far its k nearest are.
5. Every two blocks meet in one task, in both directions. Only groups whose distances from
   their pivot reach into a query's bound are compared, as products of matrices. Of a block
   a query's best leave the task; no other pair is written, and vectors are shuffled once
   for each block.

Nothing nearer than the k-th is missed. (After Lu, Shen, Chen and Ooi, "Efficient Processing
of k Nearest Neighbor Joins using MapReduce", 2012.)
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.functions.vectors import dense_dot
from affinia.operators.neighbours import BEST, items_of_best
from affinia.sources.workspace import staged

PIVOTS = 48
#: Bands of distance from a pivot; distances on the sphere go from 0 to 2.
BANDS = 32
#: Numbers of the vectors of one block at most (64 MB as doubles; a task holds two blocks).
BLOCK_NUMBERS = 1 << 23
#: Vectors of a block at least, where blocks are only made for more tasks.
LEAST_BLOCK_ROWS = 1024
#: Pairs of blocks per core that blocks are made small for.
CELLS_PER_CORE = 2
#: Cosines held at a time.
COSINES = 1 << 22
#: Allowed for rounding of distances: that of a vector from itself may come out as 2e-8.
ROUNDING = 1e-7


def fold_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame]:
    """(vector_id, copies, vector) of distinct vectors, and (item_id, vector_id, copies)."""
    plain = vectors.select(F.col(id_column).alias("item_id"), F.col(vector_column).alias("vector"))
    with_length = plain.where(dense_dot(F.col("vector"), F.col("vector")) > 0)
    # The vector itself is the key: its hash could meet another's.
    folded = staged(
        with_length.groupBy("vector").agg(F.min("item_id").alias("vector_id"), F.count("*").alias("copies"))
        .select("vector_id", "copies", F.xxhash64("vector").alias("sign"), "vector"),
        "directions",
    )
    alone = folded.where("copies = 1").select(F.col("vector_id").alias("item_id"), "vector_id", "copies")
    groups = folded.where("copies > 1").select(
        F.col("vector").alias("same"), F.col("sign").alias("same_sign"), "vector_id", "copies"
    )
    shared = with_length.withColumn("sign", F.xxhash64("vector")).join(
        groups, (F.col("sign") == F.col("same_sign")) & (F.col("vector") == F.col("same"))
    )
    members = staged(alone.unionByName(shared.select("item_id", "vector_id", "copies")), "members")
    return folded.select("vector_id", "copies", "vector"), members


def placing(pivots: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function that adds the nearest pivot and the band to (vector_id, vector)."""
    bands = BANDS

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            vectors = flat.reshape(batch.num_rows, -1)
            with np.errstate(all="ignore"):
                units = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
                away = np.nan_to_num(np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (units @ pivots.T))))
            pivot = away.argmin(axis=1)
            band = np.minimum(away.min(axis=1) * (bands / 2), bands - 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(pivot.astype(np.int32)), pa.array(band.astype(np.int32)),
                    batch.column(1),
                ],
                ["vector_id", "pivot", "band", "vector"],
            )

    return place


def ranking(
    pivots: np.ndarray, k: int, digits: int, most: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function that finds the best of each vector of a cell.

    A cell holds one block, which meets itself, or two (``side`` 0 and 1), which meet each
    other. As in ``pairs.multiplying``, its parts are inside, and travel with it. ``most``
    bounds the cosines held at a time.
    """
    rows, slack, rounding, bands = k + 1, 10.0**-digits, ROUNDING, BANDS

    class Block:
        """Vectors of one block by pivot and band, and how far each group is from its pivot."""

        def __init__(self, parts: list[tuple[np.ndarray, ...]]):
            ids, pivot, band, floors, vectors = (np.concatenate(x) for x in zip(*parts, strict=True))
            group = pivot.astype(np.int64) * bands + band
            order = np.lexsort((ids, group))
            self.ids, self.floors, group = ids[order], floors[order], group[order]
            units = vectors[order].astype(np.float64)
            units /= np.sqrt((units * units).sum(axis=1))[:, None]
            self.units = units
            self.away = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (units @ pivots.T)))
            # A vector with values that are not finite has cosines that are not: see ``cosines``.
            self.odd = not np.isfinite(units).all()
            self.first = np.flatnonzero(np.diff(group, prepend=-1))
            self.sizes = np.diff(self.first, append=len(group))
            self.pivots = group[self.first] // bands
            own = self.away[np.arange(len(group)), group // bands]
            self.low, self.high = np.minimum.reduceat(own, self.first), np.maximum.reduceat(own, self.first)

    def cosines(asking: Block, span: slice, held: Block, kept: np.ndarray | slice) -> np.ndarray:
        found = asking.units[span] @ held.units[kept].T
        if asking.odd or held.odd:
            # Cosines that are no numbers come first, as in descending order in SQL.
            found = np.where(np.isnan(found), np.inf, found)
        same = np.isin(held.ids[kept], asking.ids[span])
        if same.any():
            places = np.flatnonzero(same)
            own = asking.ids[span][:, None] == held.ids[kept][places][None, :]
            row, at = np.nonzero(own)
            found[row, places[at]] = -np.inf
        return found

    def seed(block: Block) -> None:
        """Floors from each vector's own group."""
        for first, size in zip(block.first.tolist(), block.sizes.tolist(), strict=True):
            if size <= k:
                continue
            step = max(1, most // size)
            for low in range(first, first + size, step):
                span = slice(low, min(first + size, low + step))
                found = cosines(block, span, block, slice(first, first + size))
                block.floors[span] = np.partition(found, size - k, axis=1)[:, size - k] - slack

    def answer(asking: Block, held: Block) -> Iterator[pa.RecordBatch]:
        step = max(1, most // len(held.ids))
        for start in range(0, len(asking.ids), step):
            span = slice(start, min(len(asking.ids), start + step))
            least = asking.floors[span] - slack
            bound = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * least))[:, None] + rounding
            away = asking.away[span][:, held.pivots]
            outside = ((away - bound > held.high) | (away + bound < held.low)).all(axis=0)
            if outside.all():
                continue
            kept = np.flatnonzero(np.repeat(~outside, held.sizes)) if outside.any() else slice(None)
            found = cosines(asking, span, held, kept)
            row, place = np.nonzero((found >= least[:, None]) & (found > -np.inf))
            score, other = found[row, place], held.ids[kept][place]
            # Half away from zero, as Spark rounds; no negative zero.
            score = np.copysign(np.floor(np.abs(score) * 10.0**digits + 0.5) / 10.0**digits, score) + 0.0
            order = np.lexsort((other, -score, row))
            row, score, other = row[order], score[order], other[order]
            begin = np.searchsorted(row, row)
            best = np.arange(len(row)) - begin < rows
            if best.any():
                score = np.where(np.isinf(score), np.nan, score)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(asking.ids[span][row[best]]), pa.array(other[best]),
                        pa.array(score[best], from_pandas=False),
                    ],
                    ["vector_id", "other_vector", "similarity"],
                )

    def close(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            blocks = [Block(held[side]) for side in sorted(held)]
            if len(blocks) == 2:
                yield from answer(*blocks)
                yield from answer(*blocks[::-1])
            elif (held.keys() == {0}) and blocks:
                seed(blocks[0])
                yield from answer(blocks[0], blocks[0])

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}
        for batch in batches:
            found = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            cells, sides = found["cell"].to_numpy(), found["side"].to_numpy()
            cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(sides) != 0)) + 1
            bounds = [0, *cuts.tolist(), len(cells)]
            for start, stop in zip(bounds, bounds[1:], strict=False):
                if start == stop:
                    continue
                if cells[start] != cell:
                    yield from close(held)
                    cell, held = cells[start], {}
                vectors = found["vector"].slice(start, stop - start).flatten().to_numpy(zero_copy_only=False)
                part = [found[name].to_numpy()[start:stop] for name in ("vector_id", "pivot", "band", "floor")]
                held.setdefault(int(sides[start]), []).append((*part, vectors.reshape(stop - start, -1)))
        yield from close(held)

    return ranked


def nearest_of_all(
    vectors: DataFrame,
    k: int = BEST,
    *,
    id_column: str = "item_id",
    vector_column: str = "vector",
    digits: int = 6,
    pivots: int = PIVOTS,
    block_rows: int | None = None,
) -> DataFrame:
    """(item_id, position, other_id, similarity): the k nearest of every vector by cosine.

    Cosines are rounded to ``digits``; equal ones go by id. Vectors without length have no
    direction: they are not ranked and are nobody's neighbours. Fewer than k others give
    fewer rows; an empty table gives none. ``block_rows`` fixes how many vectors a block
    holds, about.
    """
    folded, members = fold_vectors(vectors, id_column, vector_column)
    drawn = folded.orderBy(F.xxhash64("vector_id"), "vector_id").limit(pivots).select("vector").collect()
    if not drawn:
        return members.select(
            "item_id", F.lit(1).alias("position"), F.col("item_id").alias("other_id"), F.lit(0.0).alias("similarity")
        ).limit(0)
    centres = np.array([row["vector"] for row in drawn], np.float64)
    centres /= np.sqrt((centres * centres).sum(axis=1))[:, None]
    width = centres.shape[1]
    kind = "float" if folded.schema["vector"].dataType.simpleString() == "array<float>" else "double"
    plain = folded.where((F.col("vector_id").isNotNull()) & (F.size("vector") == width)).select(
        F.col("vector_id").cast("long"), F.col("vector").cast(f"array<{kind}>")
    )
    placed = staged(
        plain.mapInArrow(placing(centres), f"vector_id long, pivot int, band int, vector array<{kind}>"), "placed"
    )
    counted = placed.groupBy("pivot", "band").agg(F.count("*").alias("rows")).orderBy("pivot", "band").collect()
    sizes = np.zeros(len(centres) * BANDS, np.int64)  # pivots x BANDS
    for row in counted:
        sizes[row["pivot"] * BANDS + row["band"]] = row["rows"]
    total = int(sizes.sum())
    cores = placed.sparkSession.sparkContext.defaultParallelism
    wanted = ceil((2 * CELLS_PER_CORE * cores) ** 0.5)
    blocks = max(1, ceil(total * width / BLOCK_NUMBERS), min(wanted, total // LEAST_BLOCK_ROWS))
    if block_rows is not None:
        blocks = max(1, ceil(total / block_rows))

    # Places of a group's vectors, in any order, among all: groups in a row make blocks.
    group = F.col("pivot") * BANDS + F.col("band")
    place = F.get(F.lit(np.cumsum(sizes) - sizes), group) + F.pmod(
        F.xxhash64("vector_id"), F.get(F.lit(sizes), group)
    )
    laid = placed.withColumn("block", F.floor(place * F.lit(blocks) / F.lit(max(1, total))).cast("int"))
    own = laid.select(
        (F.col("block") * F.lit(blocks) + F.col("block")).alias("cell"), F.lit(0).alias("side"),
        "vector_id", "pivot", "band", F.lit(float("-inf")).alias("floor"), "vector",
    )
    schema = "vector_id long, other_vector long, similarity double"

    def met(dealt: DataFrame, cells: int) -> DataFrame:
        # By ranges: a hash would deal several of so few cells to one task.
        ordered = dealt.repartitionByRange(cells, "cell").sortWithinPartitions("cell", "side")
        return ordered.mapInArrow(ranking(centres, k, digits, COSINES), schema)

    order = Window.partitionBy("vector_id").orderBy(F.desc("similarity"), "other_vector")
    near = staged(met(own, blocks), "near")
    found = near
    if blocks > 1:
        known = (
            near.withColumn("position", F.row_number().over(order))
            .where(F.col("position") == k)
            .select("vector_id", F.col("similarity").alias("seen"))
        )
        # A cosine that is no number is as good as any bound.
        seen = F.when(F.isnan("seen"), F.lit(float("inf"))).otherwise(F.col("seen"))
        others = F.filter(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda x: x != F.col("block"))
        asking = laid.join(known, "vector_id", "left").select("*", F.explode(others).alias("partner"))
        pairs = asking.select(
            (F.least("block", "partner") * F.lit(blocks) + F.greatest("block", "partner")).alias("cell"),
            (F.col("block") > F.col("partner")).cast("int").alias("side"),
            "vector_id", "pivot", "band", F.coalesce(seen, F.lit(float("-inf"))).alias("floor"), "vector",
        )
        found = near.unionByName(staged(met(pairs, blocks * (blocks - 1) // 2), "far"))
    copies = folded.where("copies > 1").select(
        "vector_id", F.col("vector_id").alias("other_vector"), F.lit(1.0).alias("similarity")
    )
    ranked = found.unionByName(copies)
    kept = ranked.withColumn("position", F.row_number().over(order)).where(F.col("position") <= k + 1)
    return items_of_best(kept.drop("position"), members, k)
