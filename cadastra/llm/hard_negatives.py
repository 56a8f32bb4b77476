"""Hard negatives of anchors among labelled vectors, by exact integer scores from float32 matrix products.

Components are whole numbers. Matrices of their residues modulo a few small primes are multiplied in float32: a sum of 64
products of residues stays under 2^24, so every product of matrices is exact in whatever order it is summed. Mixed-radix
digits (Chinese remaindering with balanced residues) give the signed scores back. The largest vector norm bounds them and
decides how many primes are needed.

Anchors meet all rows in blocks: anchors are dealt into groups that a task can hold, rows into groups that stream past
them, and a cell is one group of each. A cell keeps the best few of each anchor, and a window over these small rows selects
the final ones. Two rounds: the best rows of the same label are an anchor's positives; their scores set the windows in
which the best rows of other labels are its negatives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.tables import record, slices
from cadastra.session import written

#: Inner dimension of one exact product, and the limit of the primes that allows it: 64 * 510 * 510 < 2^24.
INNER, PRIMES_UNDER = 64, 1024
#: Scores at a time, rows of a group, and numbers of an anchor group that a task holds.
TILE, GROUP_ROWS, GROUP_NUMBERS = 1024, 1 << 18, 1 << 24

STORED = pa.schema(
    [("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary()), ("width", pa.int32()), ("norm", pa.float64()), ("anchor", pa.bool_())]
    + [("shard", pa.int32()), ("nth", pa.int64())]
)
STORED_SQL = "vec_id long, label long, vector binary, width int, norm double, anchor boolean, shard int, nth long"


def primes_for(bound: float) -> list[int]:
    """The greatest primes under ``PRIMES_UNDER``, as many as it takes to tell signed numbers of up to ``bound`` apart."""
    sieve = [p for p in range(3, PRIMES_UNDER) if all(p % q for q in range(2, int(p**0.5) + 1))]
    product, chosen = 1, []
    while product <= 4 * bound or not chosen:
        chosen.append(sieve.pop())
        product *= chosen[-1]
    return chosen


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` modulo ``p``, near zero; ``x`` holds whole numbers in float32 and is overwritten."""
    x -= p * np.rint(x * np.float32(1 / p))
    return x


def residues(vectors: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Balanced residues of whole numbers modulo each prime, as float32 matrices."""
    found = []
    for p in primes:
        r = vectors % p
        found.append((r - p * (r > p // 2)).astype(np.float32))
    return found


def _product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    total = _balanced(a[:, :INNER] @ b[:, :INNER].T, p)
    for at in range(INNER, a.shape[1], INNER):
        total += _balanced(a[:, at : at + INNER] @ b[:, at : at + INNER].T, p)
        _balanced(total, p)
    return total


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """All inner products of the rows of ``a`` and ``b`` from their residues; exact, in the narrowest type that holds them."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        digit = _product(a[k], b[k], p)
        if digits:
            known = digits[-1].copy()
            for j in range(k - 2, -1, -1):
                known *= np.float32((primes[j] + p // 2) % p - p // 2)
                known += digits[j]
                _balanced(known, p)
            digit -= known
            radix = int(np.prod([q % p for q in primes[:k]], dtype=object)) % p
            inverse = pow(radix, -1, p)
            _balanced(digit, p)
            digit *= np.float32(inverse - p * (inverse > p // 2))
            _balanced(digit, p)
        digits.append(digit)
    span = float(np.prod(primes, dtype=np.float64))
    kind = np.float32 if span < 2**24 else np.float64 if span < 2**53 else np.int64
    total = digits.pop().astype(kind, copy=False)
    while digits:
        total *= kind(primes[len(digits) - 1])
        total += digits.pop().astype(kind, copy=False)
    return total


def lowest(kind: np.dtype):
    return -np.inf if kind.kind == "f" else np.iinfo(kind).min


class Best:
    """The ``k`` best (score, id) of each slot: higher scores first, then smaller ids, which must come in ascending order.

    ``cut`` is what a later score has to exceed.
    """

    def __init__(self, slots: int, k: int, cut: np.ndarray):
        self.k, self.cut = k, cut
        self.slot, self.score, self.id = np.empty(0, np.int64), np.empty(0, cut.dtype), np.empty(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = np.concatenate([self.slot, slot]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = order[rank < self.k]
        last = rank == self.k - 1
        self.cut[slot[last]] = score[order[last]]
        self.slot, self.score, self.id = slot[rank < self.k], score[kept], ids[kept]


def packed(vectors: np.ndarray) -> tuple[list[bytes], int]:
    """Rows as little-endian whole numbers of 2 bytes where all fit, else of 8."""
    width = 2 if not vectors.size or np.abs(vectors).max() < 1 << 15 else 8
    return [row.tobytes() for row in vectors.astype(f"<i{width}")], width


def unpacked(blobs: list[bytes], widths: list[int], dimension: int) -> np.ndarray:
    """Matrix of whole numbers; shorter vectors end in zeros."""
    found = np.zeros((len(blobs), dimension), np.int64)
    kinds: dict[tuple[int, int], list[int]] = {}
    for k, blob in enumerate(blobs):
        kinds.setdefault((len(blob), widths[k]), []).append(k)
    for (size, width), at in kinds.items():
        if size:
            found[at, : size // width] = np.frombuffer(b"".join([blobs[k] for k in at]), f"<i{width}").reshape(len(at), -1)
    return found


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label: Column, scale: int, every: int) -> DataFrame:
    """Rows that take part, with whole components, norms and a number in their task."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, nth = TaskContext.get().partitionId(), 0
        for batch in slices(batches, TILE):
            owners, labels, column = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls are NaN here
            ends = np.cumsum(pc.list_value_length(column).to_numpy())
            rows = []
            for owner, own, part in zip(owners, labels, np.split(values, ends[:-1]), strict=True):
                whole = np.floor(scale * part)
                norm = float(whole @ whole)
                if norm < 2.0**62:  # also false for NaN
                    (blob,), width = packed(whole.astype(np.int64)[None])
                    rows.append((owner, own, blob, width, norm, owner % every == 0, shard, nth))
                    nth += 1
            if rows:
                yield record(STORED, *zip(*rows, strict=True))

    wanted = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    return wanted.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").mapInArrow(store, STORED_SQL)


@dataclass(frozen=True)
class Plan:
    """How anchors and rows are dealt: groups of each, and what scores need."""

    dimension: int
    primes: list[int]
    anchor_groups: int
    row_groups: int


def plan_for(rows: DataFrame) -> Plan:
    norm, n, anchors, size = rows.agg(F.max("norm"), F.count("*"), F.count_if("anchor"), F.max(F.length("vector") / F.col("width"))).first()
    primes, dimension = primes_for(1.001 * (norm or 0.0)), max(1, int(size or 1))
    held = max(TILE, GROUP_NUMBERS // (dimension * len(primes)))
    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return Plan(dimension, primes, max(1, -(-(anchors or 0) // held)), max(1, -(-(n or 0) // GROUP_ROWS), min(tasks, (n or 0) // TILE)))


CELL = ["cell", "is_row", "vec_id", "label", "key", "vector", "width", "positives"]


def in_cells(plan: Plan, anchors: DataFrame, rows: DataFrame, order: list[str]) -> DataFrame:
    """Every group of anchors with every group of rows; in a cell the anchors come first, then the rows in ``order``."""
    cell = lambda a, r: (a * plan.row_groups + r).cast("int").alias("cell")
    group_a, group_r = F.pmod("key", F.lit(plan.anchor_groups)), F.pmod(F.col("nth") + F.col("shard"), F.lit(plan.row_groups))
    left = anchors.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(plan.row_groups - 1))))
    left = left.select(cell(group_a, F.col("_r")), F.lit(0).alias("is_row"), "vec_id", "label", "key", "vector", "width", "positives")
    right = rows.withColumn("_a", F.explode(F.sequence(F.lit(0), F.lit(plan.anchor_groups - 1))))
    nothing = F.lit(None)
    right = right.select(
        cell(F.col("_a"), group_r), F.lit(1).alias("is_row"), "vec_id", "label", nothing.cast("long").alias("key"), "vector", "width", nothing.cast("array<long>").alias("positives")
    )
    return left.unionByName(right).repartition(plan.anchor_groups * plan.row_groups, "cell").sortWithinPartitions("cell", "is_row", *order)


class Anchors:
    """The anchors of one cell, sorted by label."""

    def __init__(self, plan: Plan, parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts).combine_chunks()
        self.label, self.id, self.key = (table.column(n).to_numpy() for n in ("label", "vec_id", "key"))
        order = np.argsort(self.label, kind="stable")
        self.label, self.id, self.key = self.label[order], self.id[order], self.key[order]
        vectors = unpacked(table.column("vector").to_pylist(), table.column("width").to_pylist(), plan.dimension)[order]
        self.residues = residues(vectors, plan.primes)
        positives = table.column("positives").to_pylist()
        self.positives = [positives[k] or [] for k in order.tolist()]

    def tiles(self, first: int = 0, end: int | None = None) -> Iterator[slice]:
        end = len(self.id) if end is None else end
        return (slice(at, min(at + TILE, end)) for at in range(first, end, TILE))


def each_cell(plan: Plan, batches: Iterator[pa.RecordBatch], search: Callable) -> Iterator:
    """``search(anchors, tiles of rows)`` for every cell of a sorted partition; a row tile is (ids, labels, residues)."""
    cut = _runs(batches)
    ahead = next(cut, None)
    while ahead is not None:
        cell, parts = ahead[0], []
        while ahead is not None and ahead[:2] == (cell, 0):
            parts.append(ahead[2])
            ahead = next(cut, None)

        def rows() -> Iterator[tuple]:
            nonlocal ahead
            while ahead is not None and ahead[0] == cell:
                part = ahead[2]
                vectors = unpacked(part.column("vector").to_pylist(), part.column("width").to_pylist(), plan.dimension)
                yield part.column("vec_id").to_numpy(), part.column("label").to_numpy(), residues(vectors, plan.primes)
                ahead = next(cut, None)

        tiles = rows()
        if parts:
            yield from search(Anchors(plan, parts), tiles)
        for _ in tiles:  # rows that no anchor asks for
            pass


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(cell, is_row, part of at most a tile of rows) in the order of the partition."""
    for batch in slices(batches, TILE):
        place = batch.column("cell").to_numpy().astype(np.int64) * 2 + batch.column("is_row").to_numpy()
        borders = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(place)]
        for a, b in zip(borders, borders[1:], strict=False):
            if b > a:
                yield int(place[a]) // 2, int(place[a]) % 2, batch.slice(a, b - a)


def find_positives(plan: Plan, k: int) -> Callable:
    """The ``k`` best other rows of an anchor's label; rows come by label, then id."""

    def search(anchors: Anchors, rows: Iterator[tuple]) -> Iterator[tuple]:
        best: dict[int, Best] = {}
        for ids, labels, vectors in rows:
            borders = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
            for a, b in zip(borders, borders[1:], strict=False):
                first, end = np.searchsorted(anchors.label, [labels[a], labels[a] + 1])
                for tile in anchors.tiles(first, end):
                    found = scores([r[tile] for r in anchors.residues], [r[a:b] for r in vectors], plan.primes)
                    none = lowest(found.dtype)
                    own = np.searchsorted(ids[a:b], anchors.id[tile]), np.searchsorted(ids[a:b], anchors.id[tile], "right")
                    for row in np.flatnonzero(own[1] > own[0]).tolist():
                        found[row, own[0][row] : own[1][row]] = none
                    if tile.start not in best:
                        best[tile.start] = Best(len(found), k, np.full(len(found), none, found.dtype))
                    kept = best[tile.start]
                    cut = kept.cut
                    if b - a > k and (cut == none).any():  # not full yet: the k-th best of this tile bounds the rest
                        least = np.partition(found, b - a - k, axis=1)[:, b - a - k]
                        cut = np.maximum(cut, np.where(least > none, least - 1, none))
                    at, row = np.nonzero(found > cut[:, None])
                    kept.add(at, found[at, row], ids[a:b][row])
        for start, kept in best.items():
            at = kept.slot + start
            yield anchors.key[at], anchors.id[at], kept.score.astype(np.int64), kept.id

    return search


def find_negatives(plan: Plan, k: int, window: Callable[[int], tuple[int, int]]) -> Callable:
    """For each positive the ``k`` best rows of other labels in the window of its score; rows come by id."""

    def search(anchors: Anchors, rows: Iterator[tuple]) -> Iterator[tuple]:
        places = max(map(len, anchors.positives), default=0)
        if not places:
            return
        best: dict[int, tuple] = {}
        for ids, labels, vectors in rows:
            for tile in anchors.tiles():
                found = scores([r[tile] for r in anchors.residues], vectors, plan.primes)
                if tile.start not in best:
                    low, high = _bounds(anchors.positives[tile], places, window, found.dtype)
                    best[tile.start] = Best(low.size, k, low.reshape(-1)), high, high.max(axis=1)
                kept, high, top = best[tile.start]
                cut = kept.cut.reshape(-1, places)
                least = np.where(cut < high, cut, top[:, None]).min(axis=1)  # a full or empty window asks for nothing
                at, row = np.nonzero((found > least[:, None]) & (found <= top[:, None]))
                other = labels[row] != anchors.label[tile][at]
                at, row = at[other], row[other]
                score = found[at, row]
                inside = (score[:, None] > cut[at]) & (score[:, None] <= high[at])
                which, place = np.nonzero(inside)
                kept.add(at[which] * places + place, score[which], ids[row[which]])
        for start, (kept, *_) in best.items():
            at, place = kept.slot // places + start, kept.slot % places
            yield anchors.key[at], place, kept.score.astype(np.int64), kept.id

    return search


def _bounds(positives: list[list[int]], places: int, window: Callable, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """What scores must exceed and may reach at each place; empty windows exceed what they may reach."""
    low, high = np.ones((len(positives), places), kind), np.zeros((len(positives), places), kind)
    for k, own in enumerate(positives):
        for place, score in enumerate(own):
            least, most = window(score)
            if least <= most:
                low[k, place], high[k, place] = least - 1, most
            else:
                low[k, place], high[k, place] = 1, 0
    return low, high


def share_window(low: int, high: int) -> Callable[[int], tuple[int, int]]:
    """Scores from ``low`` to ``high`` hundredths of the positive's score."""
    return lambda score: (-(-low * score // 100), high * score // 100)


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    scale: int = 256,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of all anchors.

    Anchors are the rows whose id is divisible by ``every``; components are ``floor(scale * x)``. Rows with a null id, label
    or vector, or with a null or non-finite component take no part, nor do vectors whose scores might not fit into a long
    (squared norm of 2^62 or more). Of vectors of unequal length the shorter one counts as ending in zeros; an empty one
    scores 0. Every row stands for itself: an anchor that is there twice answers twice, copies of another row each take a
    place. Rows of the anchor's own id are none of its positives. An empty table gives no row; other columns are ignored.
    """
    rows = written(prepared(vectors, id_col, vector_col, F.col("label").cast("long") if label is None else label, scale, every))
    plan = plan_for(rows)
    key = (F.col("shard").cast("long") * F.lit(1 << 40) + F.col("nth")).alias("key")
    anchors = rows.where("anchor").select("vec_id", "label", key, "vector", "width")

    def positives_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in each_cell(plan, batches, find_positives(plan, positives)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in part], names=["key", "anchor_id", "score", "vec_id"])

    cells = in_cells(plan, anchors.withColumn("positives", F.lit(None).cast("array<long>")), rows, ["label", "vec_id"])
    found = cells.mapInArrow(positives_of, "key long, anchor_id long, score long, vec_id long")
    ranked = found.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")) - 1).where(F.col("place") < positives)
    chosen = written(ranked)

    own = chosen.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda x: x["score"]).alias("positives"))

    def negatives_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in each_cell(plan, batches, find_negatives(plan, negatives, share_window(low, high))):
            key, place, score, ids = part
            arrays = [pa.array(key, pa.int64()), pa.array(place, pa.int32()), pa.array(score, pa.int64()), pa.array(ids, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "place", "negative_score", "negative_id"])

    cells = in_cells(plan, anchors.join(own, "key"), rows, ["vec_id"])
    found = cells.mapInArrow(negatives_of, "key long, place int, negative_score long, negative_id long")
    window = Window.partitionBy("key", "place").orderBy(F.desc("negative_score"), "negative_id")
    best = found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= negatives)
    named = chosen.select("key", "place", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return best.join(named, ["key", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
