"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint of 64 bits is mapped to the bit counts of its segments. Two fingerprints with
at most k different bits have bit counts at a Manhattan distance of at most k, so the
distance of the counts is a lower bound and a grid join on them misses nothing. Each
different fingerprint is sent to the cells at distance 0 to k in one half of the space
(every pair meets once), joined with the fingerprints that live there, and the pair is kept
if bit_count(a ^ b) <= k. Copies share one fingerprint and never form pairs.

More segments make cells smaller and neighbourhoods larger; the number is taken from the
count of different fingerprints and does not change the result.

Components grow by alternating large-star and small-star steps (Kiveris et al. 2014), with
every step written to the shared folder.

Null and empty texts have no words and get fingerprint zero, which links like any other. Rows without
an id link their neighbours too; a component of such rows only has a null component_id.
Fewer words than a shingle are one shingle. Repeated rows get the same component. Only the
document id and text are read, so extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepnl.llm.text import LOWER_TABLE, saved, small_batches

SEED = 42
BITS = 64


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """A bit is set if it is set in over half of the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_TABLE).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    ends = ends[len(words) - n :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for k in range(0, n, 100_000):
        spans = zip(starts[k : min(n, k + 100_000)].tolist(), ends[k : k + 100_000].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += set_bits(hashes)
    return int(((2 * counts > n).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum())


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    total = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 255):
        bits = np.unpackbits(hashes[k : k + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return total


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and simhash (the 64 bits as a signed long)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(bits.view(np.int64))], ["doc_id", "simhash"]
            )

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, simhash long")


def _segments(n: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of n segments of nearly equal width."""
    edges = [round(k * BITS / n) for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def segments_for(n_fingerprints: int) -> int:
    """Segments that keep the cells small: more beyond 16 million different fingerprints."""
    return 8 if n_fingerprints <= 1 << 24 else 12


def cell(bits: Column, segments: int) -> Column:
    """The bit counts of all segments in one number; a field of 4 or 5 bits each."""
    field = 60 // segments
    total = F.lit(0).cast("long")
    for k, (low, width) in enumerate(_segments(segments)):
        part = F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        total = total + F.shiftleft(F.bit_count(part).cast("long"), k * field)
    return total


def half_ball(segments: int, radius: int) -> list[int]:
    """Differences of cells at Manhattan distance 0 to radius, one of each pair of opposites.

    A difference that leaves the counts' range gives a cell in which nothing lives: fields are
    wider than the largest count plus the radius, and a borrow leaves a value above it.
    """
    field = 60 // segments
    found = set()

    def extend(at: int, left: int, code: int, first: int) -> None:
        if first >= 0:
            found.add(code)
        for k in range(at, segments):
            for step in range(-left, left + 1):
                if step and (first or step > 0):
                    extend(k + 1, left - abs(step), code + (step << (k * field)), first or 1)

    extend(0, radius, 0, 0)
    return sorted(found)


def links(prints: DataFrame, max_distance: int = 2, segments: int | None = None) -> DataFrame:
    """Pairs (a, b) of different fingerprints of the column simhash with few different bits."""
    segments = segments or segments_for(prints.count())
    if max(w for _, w in _segments(segments)) + max_distance >= 1 << (60 // segments):
        raise ValueError("too few segments for this distance")
    home = prints.select(F.col("simhash").alias("a"), cell(F.col("simhash"), segments).alias("cell"))
    steps = F.array(*[F.lit(x).cast("long") for x in half_ball(segments, max_distance)])
    out = prints.select(F.col("simhash").alias("b"), cell(F.col("simhash"), segments).alias("own"))
    out = out.select("b", F.explode(F.transform(steps, lambda d: F.col("own") + d)).alias("cell"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    return home.hint("shuffle_hash").join(out, "cell").where(near & (F.col("a") != F.col("b"))).select("a", "b")


def components(edges: DataFrame, label: str = "component") -> DataFrame:
    """node and root (its smallest reachable node) for every node of the edges (u, v)."""

    def both(pairs: DataFrame) -> DataFrame:
        return pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = saved(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label
    )
    now = state(edges)
    while now[0]:
        seen = both(edges)
        low = seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = seen.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = saved(small, label)
        before, now = now, state(edges)
        if before == now:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_distance: int = 2, segments: int | None = None, doc_id: str = "doc_id"
) -> DataFrame:
    """doc_id, simhash and component_id (smallest document id reachable over links)."""
    prints = saved(fingerprints(docs, shingle, doc_id), "simhash")
    groups = saved(prints.groupBy("simhash").agg(F.min("doc_id").alias("node")), "simhash-groups")
    pairs = saved(links(groups, max_distance, segments), "simhash-links")
    # Links are between fingerprints, so one that only rows without an id have still links its neighbours.
    roots = components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))
    rooted = groups.join(roots.withColumnRenamed("node", "simhash"), "simhash", "left")
    rooted = saved(rooted.select("simhash", "node", F.coalesce("root", "simhash").alias("root")), "simhash-roots")
    least = saved(rooted.groupBy("root").agg(F.min("node").alias("component_id")), "simhash-least")
    known = rooted.join(least, "root").select("simhash", "component_id")
    return prints.join(saved(known, "simhash-known"), "simhash", "left").select("doc_id", "simhash", "component_id")
