"""Hard negatives from Hilbert-ordered candidate blocks, read by interval bounds.

Vectors become whole numbers. The candidates are dealt by label and Hilbert key and written as
Parquet blocks, one row each: up to BLOCK_ROWS neighbours on the curve that share a label, their
vectors, and a zone map, the smallest and largest value of every dimension. For an anchor and a
block, interval arithmetic over the zone map bounds all scores of the block from both sides. A
block is read for an anchor only if its label can take part and its bounds meet one of the anchor's windows: for the positives the scores that the anchor's own block already reaches,
for the negatives of a positive the given share of its score. While a task reads, windows narrow
to the best rows that it has found, so later blocks are left out for more anchors. Both decisions
are exact: a block that is left out holds no row of the result.

Anchors are taken in bounded batches along the curve; a batch first asks the zone maps alone
which parts of the table it needs, and reads only those. Every task returns the best rows of a
window, which Spark merges in two salted steps. Nothing else is brought together.

A vector, its label and its components must not be null, and the components finite; other rows take
no part. Shorter vectors count as filled up with zeros. Components beyond LARGEST after scaling
count as LARGEST, so that scores are exact. A null id is no anchor and comes last among ties.
Repeated rows are rows of their own. Equal rows in any number are spread over blocks and tasks.
An empty table, or one without anchors, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakepnl.llm.text import saved
from lakepnl.session import new_folder, ship_package

#: Rows of a block: small, as bounds over few neighbours are tight.
BLOCK_ROWS = 64
#: Rows of a part of the table, one file: at least so many while tasks are few, and no more at any size.
PART_ROWS = (1 << 13, 1 << 20)
#: Anchors that are searched at a time.
ANCHORS = 4096
#: Bits of the Hilbert curve for each dimension.
BITS = 4
LARGEST = 1 << 24
#: Found rows that a task holds before it keeps the best of each window only.
HELD = 200_000
BATCH_BYTES = 8 << 20
#: Tasks whose rows are merged in the first step.
TASKS_PER_SALT = 256

_BLOCK = (
    "part int, block long, label long, n int, n_null int, vec_ids binary, vectors binary, "
    "low array<int>, high array<int>"
)
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


@dataclass(frozen=True)
class Space:
    """What all vectors have in common: dimensions, their ranges, and the dimension order of the curve."""

    dims: int
    low: np.ndarray
    high: np.ndarray
    order: np.ndarray

    @property
    def stored(self) -> type:
        """Type of a stored component."""
        return np.int16 if max(-int(self.low.min()), int(self.high.max())) < 1 << 15 else np.int32

    @property
    def exact(self) -> type:
        """Type in which sums of products are exact: floating point, which is faster, if they fit."""
        largest = max(-int(self.low.min()), int(self.high.max()))
        return np.float64 if largest**2 * self.dims < 1 << 53 else np.int64


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Bytes of the Hilbert index of whole points with values below 2^bits, one row each.

    The curve is walked from the highest bit: at each level a point is mirrored and turned into
    the frame of the cell that it lies in, for all points at once.
    """
    x = points.T.astype(np.uint8 if bits <= 8 else np.int64, copy=True)
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        below = x.dtype.type((1 << level) - 1)
        for d in range(dims):
            inside = (x[d] >> level) & 1 == 1
            turned = np.where(inside, 0, (x[0] ^ x[d]) & below).astype(x.dtype)
            x[0] ^= np.where(inside, below, turned).astype(x.dtype)
            x[d] ^= turned
    # Gray decoding across the dimensions.
    x = np.bitwise_xor.accumulate(x, axis=0)
    flips = np.zeros_like(x[-1])
    for level in range(bits - 1, 0, -1):
        flips ^= ((x[-1] >> level) & 1) * x.dtype.type((1 << level) - 1)
    x ^= flips
    levels = np.arange(bits - 1, -1, -1).astype(x.dtype)
    return np.packbits(((x[None] >> levels[:, None, None]) & 1).reshape(bits * dims, -1).T.astype(np.uint8), axis=1)


def _vectors(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that take part, then their scaled components laid end to end and the size of each."""
    lists = batch.column(2).cast(pa.large_list(pa.float64()))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    with np.errstate(all="ignore"):
        values = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale)
    ends = np.cumsum(sizes)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    taken = (bad[ends] == bad[ends - sizes]) & lists.is_valid().to_numpy(zero_copy_only=False)
    taken &= batch.column(1).is_valid().to_numpy(zero_copy_only=False)
    kept = np.clip(values[np.repeat(taken, sizes)], -LARGEST, LARGEST).astype(np.int64)
    return np.flatnonzero(taken), kept, sizes[taken]


def _space(rows: DataFrame, scale: int) -> Space | None:
    """Ranges and spread of every dimension, over all rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, values, sizes = _vectors(batch, scale)
            at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            order = np.argsort(at, kind="stable")
            dims, first = np.unique(at[order], return_index=True)
            v = values[order].astype(np.float64)
            found = [f.reduceat(x, first) if len(v) else v for f, x in ((np.minimum, v), (np.maximum, v), (np.add, v), (np.add, v * v))]
            n = np.diff(np.append(first, len(v)))
            columns = [dims, n, found[0].astype(np.int64), found[1].astype(np.int64), *found[2:]]
            types = [pa.int64()] * 4 + [pa.float64()] * 2
            if not len(v) and len(sizes):  # empty vectors alone still are a space
                columns, types = [[0], [0], [0], [0], [0.0], [0.0]], types
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["dim", "n", "low", "high", "total", "squares"]
            )

    parts = rows.mapInArrow(run, "dim long, n long, low long, high long, total double, squares double")
    found = sorted(
        parts.groupBy("dim")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"), F.sum("total").alias("t"), F.sum("squares").alias("s"))
        .collect()
    )
    if not found:
        return None
    spread = [r["s"] / r["n"] - (r["t"] / r["n"]) ** 2 if r["n"] else 0.0 for r in found]
    # Zeros may stand in for missing components.
    low = np.array([min(0, r["low"]) for r in found], np.int64)
    high = np.array([max(0, r["high"]) for r in found], np.int64)
    return Space(len(found), low, high, np.argsort(-np.array(spread), kind="stable"))


def _keyed(rows: DataFrame, space: Space, scale: int) -> DataFrame:
    """vec_id, label, vector and Hilbert key of every row that takes part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = np.maximum(space.high - space.low, 1)
        for batch in batches:
            taken, values, sizes = _vectors(batch, scale)
            x = np.zeros((len(taken), space.dims), np.int64)
            x[np.arange(space.dims) < sizes[:, None]] = values
            cells = (x - space.low) * ((1 << BITS) - 1) // span
            keys = hilbert_keys(cells[:, space.order]) if len(taken) else np.zeros((0, 1), np.uint8)
            whole = [r.tobytes() for r in x.astype(space.stored)], [k.tobytes() for k in keys]
            picked = [batch.column(i).take(pa.array(taken, pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*picked, *[pa.array(c, pa.binary()) for c in whole]], ["vec_id", "label", "vector", "key"]
            )

    return rows.mapInArrow(run, "vec_id long, label long, vector binary, key binary")


def _matrix(column: pa.Array, dims: int, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, dims)


def build_blocks(rows: DataFrame, space: Space, scale: int, part_rows: tuple[int, int] = PART_ROWS) -> DataFrame:
    """The candidates as blocks along label and curve, one folder for each range of it."""
    spark = rows.sparkSession
    keyed = saved(_keyed(rows, space, scale), "keyed")
    n, least, most = keyed.count(), *part_rows
    parts = max(min(n // least + 1, 4 * spark.sparkContext.defaultParallelism), n // most + 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        rest = None
        for batch in _with_end(batches):
            parts = [b for b in (rest, batch) if b is not None and b.num_rows]
            if not parts:
                continue
            table = pa.Table.from_batches(parts).combine_chunks()
            labels = table.column("label").to_numpy()
            edges = np.flatnonzero(np.diff(labels)) + 1
            runs = np.concatenate(([0], edges, [len(labels)]))
            starts = np.concatenate([np.arange(a, b, BLOCK_ROWS) for a, b in zip(runs, runs[1:], strict=False)])
            ends = np.append(starts[1:], len(labels))
            # The last block may go on in the next batch.
            whole = len(starts) if batch is None else len(starts) - 1
            rest = None if batch is None else table.slice(starts[-1]).combine_chunks().to_batches()[0]
            ids = table.column("vec_id").fill_null(0).to_numpy()
            null = table.column("vec_id").is_null().to_numpy()
            x = _matrix(table.column("vector"), space.dims, space.stored)
            out = []
            for a, b in zip(starts[:whole], ends[:whole], strict=True):
                order = a + np.lexsort((ids[a:b], null[a:b]))
                own = x[order]
                out.append(
                    (part, (part << 32) + made, int(labels[a]), int(b - a), int(null[a:b].sum()),
                     ids[order].astype(np.int64).tobytes(), own.tobytes(), own.min(0), own.max(0))
                )
                made += 1
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            types += [pa.list_(pa.int32())] * 2
            columns = [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in types]
            names = ["part", "block", "label", "n", "n_null", "vec_ids", "vectors", "low", "high"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    # The id and a salt spread equal vectors, however many there are.
    along = ["label", "key", "vec_id", "_salt"]
    dealt = keyed.withColumn("_salt", F.rand(7)).repartitionByRange(parts, *along).sortWithinPartitions(*along)
    path = new_folder(spark, "blocks")
    dealt.drop("key", "_salt").mapInArrow(cut, _BLOCK).write.partitionBy("part").parquet(path)
    return spark.read.schema(_BLOCK).parquet(path)


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


@dataclass
class Anchors:
    """Some anchors: ids, labels, vectors, own places, and windows of scores (one row each, from low to high)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    block: np.ndarray
    pos: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def bounds(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that any row of each block can have, by interval arithmetic."""
        up, down = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        return up @ low.T + down @ high.T, up @ high.T + down @ low.T

    def may_hold(self, least: np.ndarray, most: np.ndarray, labels: np.ndarray, same: bool) -> np.ndarray:
        """For anchors and blocks, whether a block's bounds meet a window of the anchor."""
        found = np.zeros(least.shape, bool)
        for j in range(self.low.shape[1]):
            found |= (most >= self.low[:, j, None]) & (least <= self.high[:, j, None])
        return found & ((self.labels[:, None] == labels) == same)


def _zones(batch: pa.RecordBatch, dims: int, dtype: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    labels = batch.column("label").to_numpy(zero_copy_only=False)
    return labels, *[batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(dtype) for c in ("low", "high")]


def _needed(blocks: DataFrame, anchors: Anchors, space: Space, same: bool) -> DataFrame:
    """The parts of the table that hold a needed block, found from the zone maps alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, low, high = _zones(batch, space.dims, space.exact)
            wanted = anchors.may_hold(*anchors.bounds(low, high), labels, same).any(0)
            parts = np.unique(batch.column("part").to_numpy(zero_copy_only=False)[wanted])
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32())], ["part"])

    zones = blocks.select("part", "label", "low", "high")
    parts = [r["part"] for r in zones.mapInArrow(run, "part int").distinct().collect()]
    return blocks.where(F.col("part").isin(parts))


class _Best:
    """The best rows of every window, of those that a task has seen."""

    def __init__(self, windows: np.ndarray, keep: int):
        self.low, self.keep = windows, keep
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, *columns: np.ndarray) -> None:
        """Columns: window, score, id, whether it is null, block and row."""
        self.parts.append(columns)
        self.held += len(columns[0])

    def shrink(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.zeros(0, np.int64) for _ in range(6))
        window, score, ids, null, block, row = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((row, block, ids, null, -score, window))
        columns = [c[order] for c in (window, score, ids, null, block, row)]
        window, score = columns[:2]
        first = np.flatnonzero(np.diff(window, prepend=-1))
        rank = np.arange(len(window)) - np.repeat(first, np.diff(np.append(first, len(window))))
        best = tuple(c[rank < self.keep] for c in columns)
        full = rank == self.keep - 1
        # Rows below the last kept one of a full window can no longer count.
        flat = self.low.reshape(-1)
        flat[window[full]] = np.maximum(flat[window[full]], score[full])
        self.parts, self.held = [best], len(best[0])
        return best


def _search(blocks: DataFrame, anchors: Anchors, space: Space, same: bool, keep: int) -> DataFrame:
    """The first rows of each window: by score from high to low, then by id."""
    n_windows = anchors.low.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors.low = anchors.low.copy()
        best = _Best(anchors.low, keep)
        for batch in batches:
            labels, low, high = _zones(batch, space.dims, space.exact)
            bounds = anchors.bounds(low, high)
            block_ids = batch.column("block").to_numpy(zero_copy_only=False)
            for k in np.flatnonzero(anchors.may_hold(*bounds, labels, same).any(0)):
                one = slice(k, k + 1)
                who = np.flatnonzero(anchors.may_hold(bounds[0][:, one], bounds[1][:, one], labels[one], same)[:, 0])
                x = np.frombuffer(batch.column("vectors")[k].as_py(), space.stored).reshape(-1, space.dims)
                scores = (anchors.vectors[who] @ x.astype(space.exact).T)[:, None, :]
                hit = (scores >= anchors.low[who][:, :, None]) & (scores <= anchors.high[who][:, :, None])
                if same:
                    own = np.flatnonzero(anchors.block[who] == block_ids[k])
                    hit[own, :, anchors.pos[who][own]] = False
                i, j, row = np.nonzero(hit)
                ids = np.frombuffer(batch.column("vec_ids")[k].as_py(), np.int64)[row]
                null = row >= len(x) - batch.column("n_null")[k].as_py()
                score = scores[i, 0, row].astype(np.int64)
                best.add(who[i] * n_windows + j, score, ids, null, np.full(len(i), block_ids[k]), row)
                if best.held > HELD:
                    best.shrink()
            best.shrink()
        window, score, ids, null, block, row = best.shrink()
        task = np.full(len(window), TaskContext.get().partitionId() // TASKS_PER_SALT)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (window, task, score)]
            + [pa.array(ids, pa.int64(), mask=null.astype(bool))]
            + [pa.array(c, pa.int64()) for c in (block, row)],
            ["window", "salt", "score", "vec_id", "block", "row"],
        )

    columns = "window long, salt long, score long, vec_id long, block long, row long"
    found = blocks.drop("part").mapInArrow(run, columns)
    ranked = [F.desc("score"), F.col("vec_id").asc_nulls_last(), F.col("block"), F.col("row")]
    for keys in (["window", "salt"], ["window"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked))
        found = found.withColumn("rank", rank).where(F.col("rank") <= keep)
    return found


def _anchors(blocks: DataFrame, space: Space, every: int, n_positives: int) -> DataFrame:
    """Rows whose id is divisible by `every`, with the score that their own block vouches for.

    That many other rows of the block, all of the anchor's label, reach it; so the best of all do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                block, label, null, ids, data = (batch.column(c)[k].as_py() for c in ("block", "label", "n_null", "vec_ids", "vectors"))
                ids = np.frombuffer(ids, np.int64)
                chosen = np.flatnonzero(ids[: len(ids) - null] % every == 0)
                if not len(chosen):
                    continue
                x = np.frombuffer(data, space.stored).reshape(-1, space.dims).astype(space.exact)
                for pos, scores in zip(chosen.tolist(), x[chosen] @ x.T, strict=True):
                    others = np.sort(np.delete(scores, pos))
                    reached = int(others[-n_positives]) if len(others) >= n_positives else None
                    out.append((int(ids[pos]), label, block, pos, x[pos].astype(space.stored).tobytes(), reached))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            columns = list(zip(*out, strict=True)) if out else [[] for _ in types]
            names = ["vec_id", "label", "block", "pos", "vector", "reached"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return blocks.mapInArrow(run, "vec_id long, label long, block long, pos long, vector binary, reached long")


def _batches(anchors: DataFrame, size: int) -> Iterator[DataFrame]:
    """The anchors in runs along the curve, of about `size` each."""
    n = anchors.count()
    if not n:
        return
    parts = -(-n // size)
    cuts: list[int] = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        cuts = sorted(set(anchors.select(F.percentile_approx("block", shares, 100 * parts)).first()[0]))
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        here = anchors if low is None else anchors.where(F.col("block") > low)
        yield here if high is None else here.where(F.col("block") <= high)


def hard_negatives(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = 100,
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    batch: int = ANCHORS,
) -> DataFrame:
    """For every anchor and each of its positives, its first negatives in the positive's window.

    Anchors are the rows whose id is divisible by `every`; positives the best other rows of
    the anchor's label; negatives rows of other labels with
    low_percent * positive <= 100 * negative <= high_percent * positive.
    """
    spark = rows.sparkSession
    ship_package(spark)
    picked = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    _batch_rows(spark, 2_000)
    space = _space(picked, scale)
    if space is None:
        return spark.createDataFrame([], RESULT)
    blocks = build_blocks(picked, space, scale)
    width = space.dims * np.dtype(space.stored).itemsize
    _batch_rows(spark, max(1, BATCH_BYTES // (BLOCK_ROWS * width)))
    anchors = saved(_anchors(blocks, space, every, n_positives), "anchors")
    least, most = -(1 << 62), 1 << 62
    path = new_folder(spark, "negatives")
    done = []
    for here in _batches(anchors, max(1, min(batch, (4 * BATCH_BYTES) // width))):
        got = here.orderBy("block", "pos").toArrow()
        if not got.num_rows:
            continue
        some = Anchors(
            *[got.column(c).to_numpy() for c in ("vec_id", "label")],
            _matrix(got.column("vector"), space.dims, space.stored).astype(space.exact),
            *[got.column(c).to_numpy() for c in ("block", "pos")],
            got.column("reached").fill_null(least).to_numpy().astype(np.int64)[:, None].copy(),
            np.full((got.num_rows, 1), most, np.int64),
        )
        near = _search(_needed(blocks, some, space, True), some, space, True, n_positives)
        found = near.select("window", "rank", "score", "vec_id").toArrow()
        shape = (got.num_rows, n_positives)
        score, known = np.zeros(shape, np.int64), np.zeros(shape, bool)
        ids, null = np.zeros(shape, np.int64), np.zeros(shape, bool)
        at = found.column("window").to_numpy(), found.column("rank").to_numpy() - 1
        score[at], known[at] = found.column("score").to_numpy(), True
        ids[at], null[at] = found.column("vec_id").fill_null(0).to_numpy(), found.column("vec_id").is_null().to_numpy()
        # A score is whole, so shares of it round inwards; a window without a positive holds nothing.
        some.low = np.where(known, -_share(-score, low_percent), most)
        some.high = np.where(known, _share(score, high_percent), least)
        best = _search(_needed(blocks, some, space, False), some, space, False, n_negatives)
        folder = f"{path}/batch={len(done)}"
        _named(best, some, ids, null, score).write.parquet(folder)
        done.append(folder)
    if not done:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(*done)


def _share(score: np.ndarray, percent: int) -> np.ndarray:
    """Percent of whole numbers, rounded down, without a product beyond their size."""
    whole, rest = np.divmod(score, 100)
    return percent * whole + percent * rest // 100


def _named(best: DataFrame, anchors: Anchors, ids: np.ndarray, null: np.ndarray, score: np.ndarray) -> DataFrame:
    """Numbers of windows turned into anchors and positives."""
    n = ids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            window = b.column("window").to_numpy(zero_copy_only=False)
            at = window // n, window % n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors.ids[at[0]], pa.int64()),
                    pa.array(ids[at], pa.int64(), mask=null[at]),
                    b.column("rank"),
                    b.column("vec_id"),
                    pa.array(score[at], pa.int64()),
                    b.column("score"),
                ],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
            )

    return best.select("window", "rank", "vec_id", "score").mapInArrow(run, RESULT)


def _batch_rows(spark: SparkSession, rows: int) -> None:
    """Rows of a batch between the JVM and Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
