"""Pairs of similar items, exact, without writing out the pairs that are compared.

Method: an inverted-index join with a prefix filter on frequent tokens
(Chaudhuri, Ganti and Kaushik 2006; Bayardo, Ma and Srikant 2007), over pairs of blocks.

Vectors are cut into blocks by a hash of their id, and every two blocks meet in one cell.
The right block of a cell becomes an inverted index in the memory of its task, the left
block's vectors go through it some at a time. So what is shuffled are the vectors,
once for every block, and no meeting of two vectors in a token is ever written. Of the
sums of a vector with a block only those that are met are touched: the work follows the
meetings, not the vectors times the vectors.

Tokens of a vector run from rare to frequent. From a token on, a vector can add at most
its remaining length to a score, times the length of the other vector's part there. A
vector first sums its usual tokens, and frequent ones while its remaining length reaches
the threshold: no pair that meets later can still get there. The rest is added, exactly,
only for vectors with a sum that the rest may lift to the threshold, and tokens of very
long lists only for those pairs.

Nothing at or above the threshold is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinia.functions.vectors import sparse_dot
from affinia.operators.edge_store import write_edge_store
from affinia.operators.features import FEATURE_COLUMNS, Vectors, build_vectors
from affinia.operators.layout import order_edges
from affinia.sources.sinks import path_exists, write_new
from affinia.sources.workspace import staged

# Decimals kept of a score. Float sums depend on the order of adding in the last
# digits; rounding makes equal scores equal, so ties break the same on every run.
DIGITS = 9
# Tokens held by more vectors than this are always frequent: the vectors of a usual
# token make one list.
FREQUENT_ROWS = 8192
# Scoring a pair from two remainders costs about as much as this many meetings.
SCORING_COST = 25
# Vectors, and entries of vectors, of one block at most: a block's index lies in the memory
# of a task (4 million entries: about 200 MB while it is sorted). Every vector is written to
# disk once for each block, so blocks are as few as memory and cores allow.
CELL_ROWS = 1 << 18
CELL_ENTRIES = 6_000_000
# Vectors of a block at least, where there are enough; smaller blocks are only made for
# more tasks.
LEAST_CELL_ROWS = 1024
# Cells per core that blocks are made small for.
CELLS_PER_CORE = 2
# Sums held at a time, and meetings added at a time.
SUMS = 1 << 21
# Remaining-length bands of a frequent token.
BANDS = 8
# Meetings per task while lists are sent and while pairs are summed.
MEETINGS_PER_LIST_TASK = 5_000_000
MEETINGS_PER_TASK = 1_500_000
# Entries of a tail that one row holds: ten thousand rows, a batch, stay below 130 MB.
PIECE = 512
# Copies per slot when copies are written out.
COPIES_PER_SLOT = 10_000
# Key of the score column's metadata: the threshold that the pairs were found with.
LEAST = "least_similarity"


@dataclass(frozen=True)
class SimilarityIndex:
    """Similar pairs between vectors, and the items behind the vectors.

    links    vector_id, other_vector, similarity, with vector_id < other_vector, or
             equal for a vector with copies
    members  item_id, vector_id, copies; None where no two items are copies
    """

    links: DataFrame
    members: DataFrame | None
    threshold: float

    def edges(self) -> DataFrame:
        """(item_id, other_id, similarity) with item_id < other_id, for every pair.

        Lazy: a filter on an id reaches the members before they are joined. The
        threshold goes with the score column, into stored tables too.
        """
        if self.members is None:
            found = self.links.select(
                F.col("vector_id").alias("item_id"), F.col("other_vector").alias("other_id"),
                "similarity",
            )
        else:
            found = _write_out_copies(self.links, self.members)
        return found.withMetadata("similarity", {LEAST: self.threshold})


def _slack(digits: int) -> float:
    """Rounding allowance of the bounds: one unit of the last decimal kept."""
    return 10.0**-digits


@dataclass(frozen=True)
class _Effort:
    """Which tokens are usual, and what joining them costs."""

    frequent_rows: int
    meetings: float
    any_frequent: bool


def _postings(vectors: Vectors) -> DataFrame:
    """(vector_id, rows, token_id, weight, head), one row per vector and token."""
    return vectors.frame.select("vector_id", F.inline("entries"))


def _last_band(floor: float) -> int:
    return BANDS if floor < 0.99 else 0


def _band(floor: float) -> Column:
    """How a remaining length compares with the threshold: 0 for 1, the last band for ``floor``.

    Lengths of two bands whose numbers add up to more than the last band have a
    product below ``floor``.
    """
    last = _last_band(floor)
    if last == 0:
        return F.lit(0)
    depth = F.ln(F.least(F.col("head"), F.lit(1.0))) / F.lit(log(floor))
    return F.least(F.greatest(F.floor(depth * last), F.lit(0)), F.lit(last)).cast("int")


def _reach(vectors: Vectors, floor: float) -> DataFrame:
    """(token_id, rows, band_0, ...): postings per band that can still reach ``floor``."""
    reaching = _postings(vectors).where(F.col("head") >= F.lit(floor))
    banded = reaching.select("token_id", "rows", _band(floor).alias("band"))
    counts = [
        F.sum(F.when(F.col("band") == b, 1).otherwise(0)).alias(f"band_{b}")
        for b in range(_last_band(floor) + 1)
    ]
    return staged(
        banded.groupBy("token_id").agg(F.max("rows").alias("rows"), *counts), "reach"
    )


def _plan_effort(
    vocabulary: DataFrame, reach: DataFrame, frequent_rows: int | None
) -> _Effort:
    """Choose the limit between usual and frequent tokens, or take the given one.

    A usual token costs a meeting per pair of its vectors; a frequent one costs
    the scoring of each pair that may reach the threshold. Both are counted per
    power of two of the token counts, which makes at most 64 rows, and the limit
    with the least total is taken.
    """
    count = F.col("rows").cast("double")
    level = F.ceil(F.log2(count)).cast("int")
    if frequent_rows is not None:
        level = (F.col("rows") > F.lit(frequent_rows)).cast("int")
    last = sum(1 for name in reach.columns if name.startswith("band_")) - 1
    partners = sum(
        F.col(f"band_{i}").cast("double") * sum(F.col(f"band_{j}") for j in range(last - i + 1))
        for i in range(last + 1)
    )
    scored = reach.groupBy(level.alias("level")).agg(F.sum(partners / 2).alias("scored"))
    levels = (
        vocabulary.groupBy(level.alias("level"))
        .agg(F.sum(count * (count - 1) / 2).alias("meetings"))
        .join(scored, "level", "left")
        .orderBy("level")
        .collect()
    )

    def cost(usual: int) -> float:
        met = sum(found["meetings"] for found in levels[:usual])
        return met + SCORING_COST * sum(found["scored"] or 0.0 for found in levels[usual:])

    if frequent_rows is not None:
        limit = frequent_rows
        usual = sum(1 for found in levels if found["level"] == 0)
    else:
        allowed = sum(1 for found in levels if 2 ** found["level"] <= FREQUENT_ROWS)
        usual = min(range(allowed, -1, -1), key=cost)
        limit = 2 ** levels[usual - 1]["level"] if usual else 0
    return _Effort(
        frequent_rows=limit,
        meetings=sum(found["meetings"] for found in levels[:usual]),
        any_frequent=usual < len(levels),
    )


def _usual_parts(
    vectors: Vectors,
    effort: _Effort,
    rest: DataFrame | None,
    floor: float,
    floors: DataFrame | None = None,
) -> DataFrame:
    """(vector_id, other_vector, part) of pairs that share a usual token and may reach ``floor``.

    ``part`` is the exact sum over usual tokens; a pair is kept where it and the most
    that the ``rest`` (vector_id, length) can add reach ``floor``. With ``floors``
    (vector_id, floor) the lower floor of the two vectors counts instead.

    The vectors of a token make one list, at most FREQUENT_ROWS long. Each vector of
    the list is sent once, with the tail of the list behind it, to the task that sums
    its pairs. So what is shuffled are arrays, not a row per meeting, there is no
    self join, and the sums need no further shuffle. A vector's tails are summed as
    arrays (``_summed``), because a row per meeting in a hash table costs about
    twenty times as much.
    """
    # Tasks follow the counted meetings: input bytes say nothing about rows that each
    # meet thousands of others.
    least = vectors.frame.sparkSession.sparkContext.defaultParallelism
    def tasks(meetings_per_task: int) -> int:
        return max(least, ceil(effort.meetings / meetings_per_task))

    values = ["weight"]
    postings = _postings(vectors).where(
        (F.col("rows") > F.lit(1)) & (F.col("rows") <= F.lit(effort.frequent_rows))
    )
    for name, frame in (("length", rest), ("floor", floors)):
        if frame is not None:
            values.append(name)
            postings = postings.join(frame.select("vector_id", name), "vector_id", "left")
            postings = postings.withColumn(name, F.coalesce(name, F.lit(0.0)))
    lists = (
        postings.select("token_id", F.struct("vector_id", *values).alias("posting"))
        .repartition(tasks(MEETINGS_PER_LIST_TASK), "token_id")
        .groupBy("token_id")
        .agg(F.sort_array(F.collect_list("posting")).alias("list"))
        .select(*[F.col(f"list.{name}").alias(f"{name}s") for name in ("vector_id", *values)])
    )

    def tail(name: str) -> Column:
        return F.slice(F.col(name), F.col("begin"), F.lit(PIECE)).alias(name)

    # Long tails go in pieces, so that a batch of rows has a bounded size.
    pieces = F.sequence(F.col("at") + 2, F.size("vector_ids"), F.lit(PIECE))
    sent = (
        lists.select("*", F.posexplode("vector_ids").alias("at", "vector_id"))
        .where(F.col("at") + 1 < F.size("vector_ids"))
        .select("*", F.explode(pieces).alias("begin"))
        .select(
            "vector_id",
            tail("vector_ids"),
            *[F.get(f"{name}s", F.col("at")).alias(name) for name in values],
            *[tail(f"{name}s") for name in values],
        )
        .repartition(tasks(MEETINGS_PER_TASK), "vector_id")
        .sortWithinPartitions("vector_id")
    )

    return sent.mapInArrow(summing(floor), "vector_id long, other_vector long, part double")


def summing(
    floor: float,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function that sums batches of ``sent``.

    Its parts are inside, so that they travel with the task and workers need no package
    but numpy and pyarrow.
    """

    def lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """The values of an array column in a row, and where each row's end."""
        return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().to_numpy())

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs and their parts from rows of ``sent``, which come sorted by vector.

        One vector's tails are held at a time, besides the batch they are in.
        """
        vector, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            others, parts, missing, least = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(others, kind="stable")
            others = others[order]
            first = np.flatnonzero(np.diff(others, prepend=others[0] - 1))
            sums = np.add.reduceat(parts[order], first)
            kept = sums + missing[order][first] >= least[order][first]
            if kept.any():
                others = others[first][kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(others), vector, np.int64)), pa.array(others), pa.array(sums[kept])],
                    ["vector_id", "other_vector", "part"],
                )

        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            ids = columns["vector_id"].to_numpy()
            others, ends = lists(columns["vector_ids"])
            size = np.diff(ends, prepend=0)

            def product(name: str, default: float) -> np.ndarray:
                if name not in columns:
                    return np.full(len(others), default)
                return np.repeat(columns[name].to_numpy(), size) * lists(columns[f"{name}s"])[0]

            parts, missing = product("weight", 0.0), product("length", 0.0)
            if "floor" in columns:
                least = np.minimum(np.repeat(columns["floor"].to_numpy(), size), lists(columns["floors"])[0])
            else:
                least = np.full(len(others), floor)
            # Runs of rows of one vector; the last may go on in the next batch.
            bounds = np.flatnonzero(np.diff(ids)) + 1
            starts, stops = [0, *bounds.tolist()], [*bounds.tolist(), len(ids)]
            for start, stop in zip(starts, stops, strict=True):
                if stop == start:
                    continue
                if held and ids[start] != vector:
                    yield from close()
                    held = []
                vector = ids[start]
                span = slice(ends[start] - size[start], ends[stop - 1])
                held.append((others[span], parts[span], missing[span], least[span]))
        if held:
            yield from close()

    return summed


def score_in_blocks(
    vectors: Vectors,
    floor: float,
    frequent_rows: int,
    *,
    best: int | None = None,
    floors: DataFrame | None = None,
    digits: int = DIGITS,
) -> DataFrame:
    """(vector_id, other_vector, part): pairs with a score of at least ``floor``, each once.

    With ``best`` both directions are met and each vector keeps its best others that reach
    ``floor``, or its own in ``floors`` (vector_id, floor) where that is higher; scores are
    compared as rounded to ``digits``, equal ones by id.
    """
    size = vectors.frame.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(F.size("entries")), F.lit(0)).alias("entries")
    ).first()
    cores = vectors.frame.sparkSession.sparkContext.defaultParallelism
    wanted = ceil((CELLS_PER_CORE * cores * 2) ** 0.5) if best is None else cores
    blocks = max(
        1,
        ceil(size["rows"] / CELL_ROWS),
        ceil(size["entries"] / CELL_ENTRIES),
        min(wanted, size["rows"] // LEAST_CELL_ROWS),
    )
    last = F.lit(blocks - 1)
    block = F.pmod(F.xxhash64("vector_id"), F.lit(blocks)).cast("int")
    frame, least = vectors.frame, F.lit(floor)
    if floors is not None:
        known = floors.select("vector_id", F.col("floor").alias("own_floor"))
        frame = frame.join(known, "vector_id", "left")
        least = F.greatest(least, F.coalesce("own_floor", least))
    # Tokens that are summed by their lists wherever a pair is open; others pair by pair.
    listed = frequent_rows if best else max(frequent_rows, FREQUENT_ROWS)

    def leading(kept: Callable[[Column], Column]) -> Column:
        return F.size(F.filter("entries", kept))

    def early(entry: Column) -> Column:
        usual = entry["rows"] <= F.lit(frequent_rows)
        return usual if best else usual | (entry["head"] >= F.col("floor"))

    placed = (
        frame.withColumn("floor", least)
        .withColumn("block", block)
        .select(
            "vector_id", "block", "floor",
            leading(early).alias("first"),
            leading(lambda entry: entry["rows"] <= F.lit(frequent_rows)).alias("rare"),
            leading(lambda entry: entry["rows"] <= F.lit(listed)).alias("usual"),
            F.col("entries.token_id").alias("tokens"), F.col("entries.weight").alias("weights"),
        )
    )

    def side(number: int, met: DataFrame, row: str, column: str) -> DataFrame:
        """Vectors in each cell of their block, as rows (``row`` is the block) or in the index."""
        cell = F.col(row) if best else F.col(row) * F.lit(blocks) + F.col(column)
        return met.select(
            cell.alias("cell"), F.lit(number).alias("side"), (F.col(row) == F.col(column)).alias("own"),
            "vector_id", "floor", "first", "rare", "usual", "tokens", "weights",
        )

    def partners(begin: Column, end: Column) -> DataFrame:
        return placed.select("*", F.explode(F.sequence(begin, end)).alias("partner"))

    if best:
        # A block of rows keeps its best in one task while all vectors go by.
        cells = blocks
        met = side(0, placed, "block", "block").unionByName(side(1, partners(F.lit(0), last), "partner", "block"))
        task = F.col("cell")
    else:
        cells = blocks * (blocks + 1) // 2
        met = side(1, partners(F.col("block"), last), "block", "partner").unionByName(
            side(0, partners(F.lit(0), F.col("block")), "partner", "block")
        )
        # Cells above the diagonal, numbered without gaps.
        row, column = F.floor(F.col("cell") / F.lit(blocks)), F.pmod("cell", F.lit(blocks))
        task = row * F.lit(blocks) - row * (row - 1) / 2 + column - row
    # By number: a hash would deal several of so few cells to one task, and so may ranges.
    dealt = met.repartitionById(cells, task.cast("int")).sortWithinPartitions("cell", "side", "vector_id")
    return dealt.mapInArrow(
        multiplying(best, digits, SUMS, CELL_ROWS, CELL_ENTRIES), "vector_id long, other_vector long, part double"
    )


def multiplying(
    best: int | None, digits: int, most: int, most_rows: int, most_entries: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function that scores cells.

    As in ``summing``, its parts are inside, and travel with it. ``most`` bounds the sums
    held and the meetings added at a time; ``most_rows`` and ``most_entries`` an index.

    A few rows at a time have a sum for each vector of the index, but only the sums that are
    met are looked at, and set back: the work follows the meetings, not the rows times the
    vectors. What a row's remaining tokens can add to a sum is bounded by the row's remaining
    length times the length of the other vector's frequent part; where that may reach the
    row's floor, the rest is added from the two vectors.
    """
    # Sums of the same products in another order differ by less.
    error = 1e-12
    # Meetings of the rows summed at a time: their arrays stay in a processor's cache.
    cached = 1 << 16

    def spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The numbers from each begin on, as many as its size, in a row."""
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)

    def lengths(rows: np.ndarray, weights: np.ndarray, count: int) -> np.ndarray:
        """The length of each row's entries (row, weight), never too low."""
        return np.sqrt(np.bincount(rows, weights**2, count)) * (1 + error)

    class Index:
        """Postings of vectors by token, and their frequent entries by vector."""

        def __init__(self, ids, sizes, rare, usual, tokens, weights):
            order = np.argsort(tokens, kind="stable")
            self.ids = ids
            self.tokens, self.starts, self.sizes = np.unique(tokens[order], return_index=True, return_counts=True)
            owner = np.repeat(np.arange(len(ids)), sizes)
            self.places = owner[order].astype(np.int32)
            self.weights = weights[order]
            # Frequent entries, which come last in a vector, by vector.
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            late = place >= np.repeat(rare, sizes)
            self.longest_but_rare = lengths(owner[late], weights[late], len(ids)).max(initial=0.0)
            late = place >= np.repeat(usual, sizes)
            frequent, self.late_tokens = np.unique(tokens[late], return_inverse=True)
            self.late_weights = weights[late]
            self.late_sizes = sizes - usual
            self.late_begins = np.cumsum(self.late_sizes) - self.late_sizes
            self.frequent = len(frequent)
            self.numbers = np.full(len(self.tokens), -1)
            self.numbers[np.searchsorted(self.tokens, frequent)] = np.arange(len(frequent))
            self.lengths = lengths(owner[late], self.late_weights, len(ids))
            self.longest = self.lengths.max(initial=0.0)

        def find(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The place of each token's list, and whether there is one."""
            at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
            return at, self.tokens[at] == tokens

    class Sums:
        """Sums of some rows with all vectors of an index; ``close`` sets them back."""

        def __init__(self, index: Index, held: np.ndarray, marks: np.ndarray, rows: int):
            self.index, self.width, self.rows = index, len(index.ids), rows
            self.held, self.marks, self.met, self.meetings = held, marks, [], 0

        @property
        def dense(self) -> bool:
            """So many meetings that they are not remembered."""
            return self.meetings > most

        def add(self, rows: np.ndarray, at: np.ndarray, weights: np.ndarray) -> None:
            """Adds the products of entries (row, list, weight), which go by row, with their lists."""
            index = self.index
            sizes = index.sizes[at]
            ends = np.cumsum(sizes)
            if not len(at):
                return
            self.meetings += int(ends[-1])
            if self.dense:
                self.met = []
            begin = 0
            while begin < len(at):
                done = ends[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
                size, row = sizes[begin:stop], rows[begin:stop]
                spots = spread(index.starts[at[begin:stop]], size)
                keys = np.repeat(row * self.width, size) + index.places[spots]
                np.add.at(self.held, keys, np.repeat(weights[begin:stop], size) * index.weights[spots])
                if not self.dense:
                    self.met.append((row, size, keys))
                begin = stop

        def reaching(self, least: np.ndarray) -> Iterator[np.ndarray]:
            """Keys of sums of at least ``least`` of their row; some come several times."""
            if self.dense:
                grid = self.held[: self.rows * self.width].reshape(self.rows, self.width)
                yield np.flatnonzero(grid >= least[:, None])
                return
            for rows, sizes, keys in self.met:
                yield keys[self.held.take(keys) >= np.repeat(least[rows], sizes)]

        def kth(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
            """The sum of each row at a place, from the highest (1); 0 where fewer are met."""
            if self.dense:
                of_row = np.repeat(np.arange(self.rows), self.width)
                sums = self.held[: self.rows * self.width]
            elif self.met:
                keys = np.concatenate([keys for _, _, keys in self.met])
                # Of a key that comes several times the last one counts.
                numbers = np.arange(len(keys), dtype=np.int32)
                self.marks[keys] = numbers
                once = self.marks.take(keys) == numbers
                of_row = np.concatenate([np.repeat(row, sizes) for row, sizes, _ in self.met])[once]
                sums = self.held.take(keys[once])
            else:
                return np.zeros(len(rows))
            lows, highs = np.searchsorted(of_row, rows), np.searchsorted(of_row, rows, side="right")
            found = np.zeros(len(rows))
            for i, (low, high, nth) in enumerate(zip(lows, highs, places, strict=True)):
                if high - low >= nth:
                    found[i] = np.partition(sums[low:high], high - low - nth)[high - low - nth]
            return found

        def with_rest(self, keys: np.ndarray, rows: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
            """Sums of keys with the products of entries (row, list, weight) of frequent tokens."""
            index, sums = self.index, self.held.take(keys)
            number = index.numbers[at]
            rows, number, weights = rows[number >= 0], number[number >= 0], weights[number >= 0]
            if not len(rows):
                return sums
            table = np.zeros(self.rows * index.frequent)
            table[rows * index.frequent + number] = weights
            row = keys // self.width
            places = keys - row * self.width
            sizes = index.late_sizes[places]
            ends = np.cumsum(sizes)
            begin = 0
            while begin < len(keys):
                done = ends[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
                size = sizes[begin:stop]
                spots = spread(index.late_begins[places[begin:stop]], size)
                other = table[np.repeat(row[begin:stop] * index.frequent, size) + index.late_tokens[spots]]
                pair = np.repeat(np.arange(stop - begin), size)
                sums[begin:stop] += np.bincount(pair, other * index.late_weights[spots], stop - begin)
                begin = stop
            return sums

        def close(self) -> None:
            if self.dense:
                self.held[: self.rows * self.width] = 0.0
            for _, _, keys in self.met:
                self.held[keys] = 0.0

    def lists(column: pa.ListArray) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False)

    def parts_of(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        found = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        made = {name: lists(found[name]) for name in ("tokens", "weights")}
        made["sizes"] = found["tokens"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        made["own"] = found["own"].to_numpy(zero_copy_only=False)
        for name in ("cell", "side", "vector_id", "floor", "first", "rare", "usual"):
            made[name] = found[name].to_numpy()
        made["floor"] = made["floor"].copy()
        return made

    def indexed(held: list[dict[str, np.ndarray]]) -> Index:
        names = ("vector_id", "sizes", "rare", "usual", "tokens", "weights")
        return Index(*(np.concatenate([part[name] for part in held]) for name in names))

    def score(index: Index, part: dict[str, np.ndarray], buffers: list[np.ndarray]) -> Iterator[tuple]:
        """(first row, rows, places, scores) of the pairs that reach their row's floor."""
        width = len(index.ids)
        ends = np.cumsum(part["sizes"])
        # Tokens that no vector of the index holds add nothing, so they count in no length.
        all_at, hit = index.find(part["tokens"])
        early = hit & (spread(np.zeros(len(ends), np.int64), part["sizes"]) < np.repeat(part["first"], part["sizes"]))
        step = max(1, min(most // width, len(ends) * cached // max(1, int(index.sizes[all_at[early]].sum()))))
        if len(buffers[0]) < step * width:
            buffers[:] = np.zeros(step * width), np.zeros(step * width if best else 0, np.int32)
        for low in range(0, len(ends), step):
            high = min(len(ends), low + step)
            span = slice(ends[low] - part["sizes"][low], ends[high - 1])
            sizes, ids, floor, first, usual = (
                part[name][low:high] for name in ("sizes", "vector_id", "floor", "first", "usual")
            )
            rows = high - low
            number = np.repeat(np.arange(rows), sizes)
            place = np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            known = hit[span]
            number, place, at, weights = number[known], place[known], all_at[span][known], part["weights"][span][known]

            def rest(begin: np.ndarray, of: tuple = (number, place, weights, rows)) -> np.ndarray:
                """The length of each row from an entry on."""
                number, place, weights, rows = of
                left = place >= begin[number]
                return lengths(number[left], weights[left], rows)

            sums = Sums(index, *buffers, rows)
            early = place < first[number]
            sums.add(number[early], at[early], weights[early])
            if best:
                floor = known_floors(sums, ids, floor)
                # Frequent tokens that vectors met in no usual one need to reach the floor.
                reverse = np.append(np.cumsum((weights**2)[::-1])[::-1], 0.0)
                after = reverse[np.searchsorted(number, np.arange(rows), side="right")]
                head = np.sqrt(np.maximum(reverse[:-1] - after[number], 0.0) + 1e-11)
                more = ~early & (head * index.longest >= floor[number] - error)
                begin = first.astype(np.int64)
                np.maximum.at(begin, number[more], place[more] + 1)
            else:
                # Rows where what is left may lift some sum to the floor.
                begin = np.maximum(first, usual)
                more = ~early & (place < begin[number])
                if more.any():
                    still = np.zeros(rows, bool)
                    for keys in sums.reaching(floor - rest(first) * index.longest_but_rare - error):
                        still[keys // width] = True
                    if not still.any():
                        sums.close()
                        continue
                    more &= still[number]
                    floor = np.where(still, floor, np.inf)
            sums.add(number[more], at[more], weights[more])
            left = rest(begin)
            found = []
            for keys in sums.reaching(floor - left * index.longest - error):
                row = keys // width
                places = keys - row * width
                open_ = sums.held.take(keys) + left[row] * index.lengths[places] >= floor[row] - error
                if best:
                    open_ &= ids[row] != index.ids[places]
                elif part["own"][low]:
                    open_ &= ids[row] < index.ids[places]
                found.append(keys[open_])
            keys = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
            if len(keys):
                late = place >= begin[number]
                scores = sums.with_rest(keys, number[late], at[late], weights[late])
                row = keys // width
                reached = scores >= floor[row]
                if reached.any():
                    yield low, row[reached], (keys - row * width)[reached], scores[reached]
            sums.close()

    def known_floors(sums: Sums, ids: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Floors with those of rows that had none yet: no score is below its sum so far."""
        unknown = np.flatnonzero(floor < 10.0**-digits)
        if not len(unknown):
            return floor
        # A row is not among its own others.
        all_ids, own = sums.index.ids, ids[unknown]
        places = best + np.searchsorted(all_ids, own, side="right") - np.searchsorted(all_ids, own)
        floor = floor.copy()
        floor[unknown] = np.maximum(floor[unknown], sums.kth(unknown, places) - 10.0**-digits)
        return floor

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells of an index, which comes first, and rows that go through it."""
        index, held, buffers = None, [], [np.zeros(0), None]
        for part in pieces(batches):
            if part["side"][0] == 0:
                if index is not None or (held and held[0]["cell"][0] != part["cell"][0]):
                    index, held = None, []
                held.append(part)
                continue
            if held and held[0]["cell"][0] == part["cell"][0]:
                index, held, cell = indexed(held), [], part["cell"][0]
            if index is None or cell != part["cell"][0]:
                continue
            for low, row, place, scores in score(index, part, buffers):
                left, right = part["vector_id"][low + row], index.ids[place]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right)), pa.array(scores)],
                    ["vector_id", "other_vector", "part"],
                )

    class Best:
        """Rows of a cell with the best others found so far, highest first, equal ones by id."""

        def __init__(self, part: dict[str, np.ndarray]):
            self.part = part
            rows = len(part["vector_id"])
            self.others = np.zeros((rows, best), np.int64)
            self.scores = np.full((rows, best), -1.0)

        def meet(self, index: Index, buffers: list[np.ndarray]) -> None:
            unit = 10.0**digits
            for low, row, place, scores in score(index, self.part, buffers):
                row = low + row
                touched = np.unique(row)
                rows = np.concatenate([np.repeat(touched, best), row])
                others = np.concatenate([self.others[touched].ravel(), index.ids[place]])
                scores = np.concatenate([self.scores[touched].ravel(), scores])
                rounded = np.floor(scores * unit + 0.5)
                order = np.lexsort((others, -rounded, rows))
                rows = rows[order]
                rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
                order, rows, rank = order[rank < best], rows[rank < best], rank[rank < best]
                self.others[rows, rank], self.scores[rows, rank] = others[order], scores[order]
                # The last one held is a floor; equal scores may still come.
                floor = (np.floor(self.scores[touched, best - 1] * unit + 0.5) - 1) / unit
                self.part["floor"][touched] = np.maximum(self.part["floor"][touched], floor)

        def batch(self) -> pa.RecordBatch:
            row, rank = np.nonzero(self.scores > 0)
            found = self.part["vector_id"][row], self.others[row, rank], self.scores[row, rank]
            return pa.RecordBatch.from_arrays([*map(pa.array, found)], ["vector_id", "other_vector", "part"])

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells of rows, which come first, and vectors they meet an index after the other."""
        cell, rows, held, buffers = None, [], [], [np.zeros(0), None]

        def meet() -> None:
            if held:
                index = indexed(held)
                for some in rows:
                    some.meet(index, buffers)

        for part in pieces(batches):
            if part["cell"][0] != cell:
                meet()
                yield from (some.batch() for some in rows)
                cell, rows, held = part["cell"][0], [], []
            if part["side"][0] == 0:
                rows.append(Best(part))
                continue
            if held and (
                sum(len(p["tokens"]) for p in held) + len(part["tokens"]) > most_entries
                or sum(len(p["sizes"]) for p in held) + len(part["sizes"]) > most_rows
            ):
                meet()
                held = []
            held.append(part)
        meet()
        yield from (some.batch() for some in rows)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        """Batches cut where the cell or the side changes."""
        for batch in batches:
            key = batch.column(batch.schema.get_field_index("cell")).to_numpy().astype(np.int64) * 2
            key += batch.column(batch.schema.get_field_index("side")).to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for start, stop in zip(bounds, bounds[1:], strict=False):
                if start < stop:
                    yield parts_of(batch.slice(start, stop - start))

    return ranked if best else scored


def similar_vectors(
    vectors: Vectors,
    threshold: float,
    *,
    digits: int = DIGITS,
    frequent_rows: int | None = None,
) -> DataFrame:
    """Every pair of vectors with a cosine of at least ``threshold``; see SimilarityIndex.links."""
    if not 0 < threshold <= 1:
        raise ValueError(
            "threshold must be above 0 and at most 1: pairs that share nothing score 0 and are "
            "not stored; ask score_pairs for given pairs, or similar_items with threshold 0"
        )
    floor = max(threshold - _slack(digits), 0.0) or threshold / 2
    reach = _reach(vectors, floor)
    effort = _plan_effort(vectors.vocabulary, reach, frequent_rows)
    parts = score_in_blocks(vectors, floor, effort.frequent_rows)
    links = parts.select(
        "vector_id", "other_vector", F.round("part", digits).alias("similarity")
    ).where(F.col("similarity") >= F.lit(float(threshold)))
    if vectors.members is None:
        return links
    return links.unionByName(
        vectors.frame.where("copies > 1").select(
            "vector_id", F.col("vector_id").alias("other_vector"), F.lit(1.0).alias("similarity")
        )
    )


def score_pairs(vectors: Vectors, pairs: DataFrame, *, digits: int = DIGITS) -> DataFrame:
    """The cosine of each asked pair of items, 0 where they share nothing.

    ``pairs`` holds (item_id, other_id) in any order. A pair with an item whose
    weights are all zero scores 0; one with an item that ``vectors`` was not built
    from has no score (null).
    """
    sides = vectors.frame.select(
        "vector_id",
        F.col("entries.token_id").alias("tokens"),
        F.col("entries.weight").alias("weights"),
    )
    # Every item is a vector here, those without weights too.
    sides = vectors.known.select("item_id", "vector_id").join(sides, "vector_id", "left")
    left = sides.select(
        "item_id", F.col("vector_id").alias("lv"), F.col("tokens").alias("lt"), F.col("weights").alias("lw")
    )
    right = sides.select(
        F.col("item_id").alias("other_id"),
        F.col("vector_id").alias("rv"),
        F.col("tokens").alias("rt"),
        F.col("weights").alias("rw"),
    )
    score = sparse_dot(F.col("lt"), F.col("lw"), F.col("rt"), F.col("rw"))
    both_known = F.col("lv").isNotNull() & F.col("rv").isNotNull()
    return (
        pairs.join(left, "item_id", "left")
        .join(right, "other_id", "left")
        .select(
            "item_id",
            "other_id",
            F.when(both_known, F.round(F.coalesce(score, F.lit(0.0)), digits)).alias("similarity"),
        )
    )


def score_item(vectors: Vectors, item_id: int, *, digits: int = DIGITS) -> DataFrame:
    """(other_id, similarity) of one item with every item that shares a token with it.

    The tokens of one item meet the postings of all vectors: one pass over the
    vectors, no pair table. The side sent to every task is one item's tokens.
    """
    wanted = F.lit(item_id)
    frame = vectors.frame
    if vectors.members is None:
        own = frame.where(F.col("vector_id") == wanted)
    else:
        own = vectors.members.where(F.col("item_id") == wanted).join(
            frame.drop("copies"), "vector_id"
        )
    asked = own.select(F.inline("entries")).select("token_id", F.col("weight").alias("asked"))
    score = F.round(F.sum(F.col("weight") * F.col("asked")), digits).alias("similarity")
    scored = _postings(vectors).join(F.broadcast(asked), "token_id").groupBy("vector_id").agg(score)
    return members_of_scores(scored, vectors.members, item_id)


def members_of_scores(scored: DataFrame, members: DataFrame | None, item_id: int) -> DataFrame:
    """(other_id, similarity) of all items but one from (vector_id, similarity)."""
    if members is None:
        found = scored.withColumnRenamed("vector_id", "other_id")
    else:
        # As in ``_write_out_copies``, a large group of copies is met in slots.
        slots = _slots(F.col("copies"))
        heads = members.where("item_id = vector_id").select("vector_id", "copies")
        spread = scored.join(heads, "vector_id").select(
            "vector_id", "similarity", F.explode(F.sequence(F.lit(0), slots - 1)).alias("slot")
        )
        found = members.select(
            F.col("item_id").alias("other_id"),
            "vector_id",
            F.pmod(F.xxhash64("item_id"), slots).cast("int").alias("slot"),
        ).join(spread, ["vector_id", "slot"])
    return found.where(F.col("other_id") != F.lit(item_id)).select("other_id", "similarity")


def build_index(
    vectors: Vectors,
    threshold: float,
    *,
    digits: int = DIGITS,
    frequent_rows: int | None = None,
) -> SimilarityIndex:
    """Find and store the similar pairs of vectors."""
    links = similar_vectors(vectors, threshold, digits=digits, frequent_rows=frequent_rows)
    return SimilarityIndex(staged(links, "links"), vectors.members, threshold)


def _slots(copies: Column) -> Column:
    return F.ceil(copies / F.lit(COPIES_PER_SLOT)).cast("int")


def _write_out_copies(links: DataFrame, members: DataFrame) -> DataFrame:
    """Item pairs from vector pairs. Large groups of copies are cut into slots and
    a link visits each pair of slots, so no task holds a whole group."""
    slots = _slots(F.col("copies"))
    slotted = members.select(
        "item_id", "vector_id", F.pmod(F.xxhash64("item_id"), slots).cast("int").alias("slot")
    )
    sizes = members.where("item_id = vector_id").select("vector_id", slots.alias("slots"))
    each = F.explode(F.sequence(F.lit(0), F.col("slots") - 1))
    visits = (
        links.join(sizes, "vector_id")
        .select("vector_id", "other_vector", "similarity", each.alias("left_slot"))
        .join(sizes.withColumnRenamed("vector_id", "other_vector"), "other_vector")
        .select("vector_id", "other_vector", "similarity", "left_slot", each.alias("right_slot"))
    )
    left = slotted.toDF("a", "vector_id", "left_slot")
    right = slotted.toDF("b", "other_vector", "right_slot")
    met = visits.join(left, ["vector_id", "left_slot"]).join(right, ["other_vector", "right_slot"])
    return met.where(
        (F.col("vector_id") != F.col("other_vector")) | (F.col("a") < F.col("b"))
    ).select(
        F.least("a", "b").alias("item_id"), F.greatest("a", "b").alias("other_id"), "similarity"
    )


def pairs_by_score(index: SimilarityIndex) -> DataFrame:
    """(similarity, n, first_item, last_other): how many pairs of items have each score.

    The same as counting the rows of ``SimilarityIndex.edges`` by score, with their least
    item_id and their greatest other_id, but from the links and the sizes of the groups of
    copies: a link stands for all pairs of the two groups, and none of them is written out.
    """
    if index.members is None:
        return index.edges().groupBy("similarity").agg(
            F.count("*").alias("n"), F.min("item_id").alias("first_item"), F.max("other_id").alias("last_other")
        )
    # Rows of an id that comes more than once are no pairs with each other; and a group's
    # links are visited once for each row of its first id, as in ``_write_out_copies``.
    once = index.members.groupBy("vector_id", "item_id").agg(F.count("*").alias("rows"))
    groups = staged(
        once.groupBy("vector_id").agg(
            F.sum("rows").alias("held"),
            F.sum(F.col("rows") * F.col("rows")).alias("same"),
            F.sum(F.when(F.col("item_id") == F.col("vector_id"), F.col("rows")).otherwise(0)).alias("heads"),
            F.min("item_id").alias("low"),
            F.max("item_id").alias("high"),
        ),
        "groups",
    )
    names = ("vector_id", "held", "same", "heads", "low", "high")
    left = groups.select(*[F.col(name).alias(name if name == "vector_id" else f"l_{name}") for name in names])
    right = groups.select(
        *[F.col(name).alias("other_vector" if name == "vector_id" else f"r_{name}") for name in names]
    )
    within = F.col("vector_id") == F.col("other_vector")
    pairs = F.when(
        within, ((F.col("l_held") * F.col("l_held") - F.col("l_same")) / F.lit(2)).cast("long")
    ).otherwise(F.col("l_held") * F.col("r_held"))
    met = (
        index.links.join(left, "vector_id")
        .join(right, "other_vector")
        .select(
            "similarity",
            (pairs * F.col("l_heads") * F.col("r_heads")).alias("pairs"),
            F.least("l_low", "r_low").alias("low"),
            F.greatest("l_high", "r_high").alias("high"),
        )
        .where("pairs > 0")
    )
    return met.groupBy("similarity").agg(
        F.sum("pairs").alias("n"), F.min("low").alias("first_item"), F.max("high").alias("last_other")
    )


def similar_pairs(
    items: DataFrame,
    threshold: float,
    *,
    columns: tuple[str, ...] = FEATURE_COLUMNS,
    digits: int = DIGITS,
    frequent_rows: int | None = None,
) -> DataFrame:
    """(item_id, other_id, similarity) of every pair at or above the threshold."""
    vectors = build_vectors(items, columns)
    return build_index(vectors, threshold, digits=digits, frequent_rows=frequent_rows).edges()


def write_similar_pairs(
    items: DataFrame,
    path: str,
    threshold: float,
    *,
    columns: tuple[str, ...] = FEATURE_COLUMNS,
    both_ways: bool = False,
) -> bool:
    """Compute the pair table and write it, ordered by item and score.

    With ``both_ways`` each pair is stored in both directions (see ``edge_store``).
    Returns False, having done nothing, where ``path`` exists already.
    """
    if path_exists(items.sparkSession, path):
        return False
    # Staged, because ordering reads its input twice: for the ranges and for the rows.
    edges = staged(similar_pairs(items, threshold, columns=columns), "edges")
    if both_ways:
        write_edge_store(edges, path)
        return True
    return write_new(order_edges(edges), path)


def best_links(links: DataFrame, k: int) -> DataFrame:
    """(vector_id, other_vector, similarity): the k best per vector, both directions.

    Row-number limits are applied before the shuffle too, so a vector with very
    many links sends at most k rows per task.
    """
    mirrored = links.select("vector_id", "other_vector", "similarity").unionByName(
        links.where("vector_id != other_vector").select(
            F.col("other_vector").alias("vector_id"),
            F.col("vector_id").alias("other_vector"),
            "similarity",
        )
    )
    best = Window.partitionBy("vector_id").orderBy(F.desc("similarity"), "other_vector")
    return mirrored.withColumn("position", F.row_number().over(best)).where(
        F.col("position") <= F.lit(k)
    )
