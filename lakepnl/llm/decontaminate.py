"""Benchmark decontamination by winnowing.

Of every WINDOW consecutive k-gram hashes the smallest is kept, for documents and benchmark
items alike. A span shared by both sides that is WINDOW + GRAM - 1 words long holds one
whole window, so both sides keep the same hash from it: with 9 and 5 no shared span of 13
words is missed. A kept hash found on both sides is a seed; it is extended word by word,
on the words themselves, to the longest common span. Spans of at least `span` words count;
an item of fewer words counts as a whole (for it every gram of its length is kept, which is
winnowing with a window of one).

The benchmark is a stated query set. It is collected in blocks of at most BLOCK_BYTES of
text, which bounds the broadcast; each block passes over all documents in narrow tasks, and
a document carries its spans from one block to the next. No document is shuffled.

A gram that stands on more than PLACES places of an item, as in a text of one word over and over, says
nothing about where; such an item is compared by the set of its windows, in work that grows with the
lengths of both texts and not with their product.

Null and empty texts, of documents and items, have no words. Repeated items are all named; a null
item id is an id like any other, and is last among those of a document. Repeated documents are judged alike. Columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepnl.llm.text import ALNUM, mix, saved, slices, small_batches, words

GRAM, WINDOW = 5, 9
PLACES = 16
BLOCK_BYTES = 16 << 20
_HIT = T.StructType().add("item_id", "string").add("first", "long").add("last", "long")
ADDED = T.StructType().add("n_words", "long").add("n_hit", "long").add("hits", T.ArrayType(_HIT)).fields
_HITS = pa.list_(pa.struct([("item_id", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def gram_hashes(hashes: np.ndarray, document: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; all ones where they pass the document's end."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    made = np.zeros(n, np.uint64)
    for j in range(k):
        made = made * np.uint64(0x100000001B3) + hashes[j : j + n]
    made = mix(made)
    made[document[:n] != document[k - 1 : k - 1 + n]] = _NONE
    return made


def winnowed(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of grams that are the smallest of some window (all of them at a tie)."""
    if len(grams) <= window:
        return np.flatnonzero((grams == grams.min()) & (grams != _NONE)) if len(grams) else np.zeros(0, np.int64)
    low = grams[: len(grams) - window + 1].copy()
    for j in range(1, window):
        np.minimum(low, grams[j : j + len(low)], out=low)
    high = np.zeros(len(grams), np.uint64)
    for j in range(window):
        part = high[j : j + len(low)]
        np.maximum(part, low, out=part)
    return np.flatnonzero((grams == high) & (grams != _NONE))


class Index:
    """Kept hashes of a block of items: by length of the gram, sorted, with item and position."""

    def __init__(self, items: list[tuple[str, str]], span: int) -> None:
        self.span, self.items = span, []
        seeds: dict[tuple[int, bool], list[tuple[int, int, int]]] = defaultdict(list)
        for item_id, text in items:
            data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
            found = words(data, np.array([0, len(data)]), ALNUM)
            n = len(found.start)
            if not n:
                continue
            own = [found.data[a:b].tobytes() for a, b in zip(found.start, found.end, strict=True)]
            k = GRAM if n >= span else n
            grams = gram_hashes(found.hashes(), np.zeros(n, np.int64), k)
            kept = winnowed(grams, WINDOW) if n >= span else [0]
            by_gram = defaultdict(list)
            for p in kept:
                by_gram[int(grams[p])].append(int(p))
            for gram, places in by_gram.items():
                # A gram on many places of an item gives no place: its windows are looked up instead.
                places = places if len(places) <= PLACES else [-1]
                seeds[k, n >= span] += [(gram, len(self.items), p) for p in places]
            self.items.append((item_id, own))
        self.by_length = {}
        for key, rows in seeds.items():
            rows.sort()
            self.by_length[key] = (np.array([r[0] for r in rows], np.uint64), [r[1:] for r in rows])

    def seeds(self, hashes: np.ndarray, document: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(word, item, word of the item) for each kept hash of the documents that an item has too."""
        for (k, long), (known, places) in self.by_length.items():
            grams = gram_hashes(hashes, document, k)
            at = winnowed(grams, WINDOW) if long else np.flatnonzero(grams != _NONE)
            low = np.searchsorted(known, grams[at])
            hit = known[np.minimum(low, len(known) - 1)] == grams[at]
            high = np.searchsorted(known, grams[at[hit]], "right")
            for p, a, b in zip(at[hit].tolist(), low[hit].tolist(), high.tolist(), strict=True):
                for item, q in places[a:b]:
                    yield p, item, q

    def matches(self, own: list[bytes], seeds: list[tuple[int, int, int]]) -> set[tuple[str, int, int]]:
        """Seeds of one document, extended: (item, first word, word after the last)."""
        found, reached = set(), {}
        repeated = {item for _, item, q in seeds if q < 0}
        for item in repeated:
            item_id, theirs = self.items[item]
            found |= {(item_id, a, b) for a, b in shared_windows(own, theirs, min(self.span, len(theirs)))}
        for p, item, q in sorted(s for s in seeds if s[1] not in repeated):
            item_id, theirs = self.items[item]
            if reached.get((item, p - q), -1) > p or own[p] != theirs[q]:
                continue
            a, b = 0, 1
            while p - a > 0 and q - a > 0 and own[p - a - 1] == theirs[q - a - 1]:
                a += 1
            while p + b < len(own) and q + b < len(theirs) and own[p + b] == theirs[q + b]:
                b += 1
            reached[item, p - q] = p + b
            if a + b >= min(self.span, len(theirs)):
                found.add((item_id, p - a, p + b))
        return found


def _in_order(span: tuple[str | None, int, int]) -> tuple:
    return span[0] is None, span[0] or "", *span[1:]


def shared_windows(own: list[bytes], theirs: list[bytes], k: int) -> list[tuple[int, int]]:
    """Runs of words that lie in windows of k words which both have, in work that grows with their lengths."""
    known = {b" ".join(theirs[q : q + k]) for q in range(len(theirs) - k + 1)}
    runs: list[tuple[int, int]] = []
    for p in range(len(own) - k + 1):
        if b" ".join(own[p : p + k]) in known:
            if runs and p <= runs[-1][1] - k + 1:
                runs[-1] = (runs[-1][0], p + k)
            else:
                runs.append((p, p + k))
    return runs


def _block(docs: DataFrame, shared, keep: list[str], text: str) -> DataFrame:
    """One block of items against all documents; hits found before stay."""
    first = [f for f in docs.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            before = batch.column(batch.schema.get_field_index("hits")) if "hits" in batch.schema.names else None
            n_words, n_hit, hits = [], [], []
            for row, stop, data, offsets in slices(batch, text):
                found = words(data, offsets, ALNUM)
                n_words += found.counts().tolist()
                document = np.repeat(np.arange(stop - row), found.counts())
                seeds = defaultdict(list)
                for p, item, q in index.seeds(found.hashes(), document):
                    d = int(document[p])
                    seeds[d].append((p - int(found.first[d]), item, q))
                for d in range(stop - row):
                    old = (before[row + d].as_py() or []) if before is not None else []
                    spans = {(x["item_id"], x["first"], x["last"]) for x in old}
                    if d in seeds:
                        a, b = found.first[d], found.first[d + 1]
                        own = [found.data[x:y].tobytes() for x, y in zip(found.start[a:b], found.end[a:b], strict=True)]
                        spans |= index.matches(own, seeds[d])
                    marked = np.zeros(n_words[row + d] if spans else 0, bool)
                    for _, x, y in spans:
                        marked[x:y] = True
                    n_hit.append(int(marked.sum()))
                    hits.append([dict(zip(("item_id", "first", "last"), s, strict=True)) for s in sorted(spans, key=_in_order)])
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in first]
            made = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(hits, _HITS)]
            names = [f.name for f in first] + ["n_words", "n_hit", "hits"]
            yield pa.RecordBatch.from_arrays(columns + made, names)

    return docs.mapInArrow(run, T.StructType(first + ADDED))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, span: int = GRAM + WINDOW - 1, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """The kept columns of every document with n_words, n_hit (words inside shared spans) and hits.

    hits: item_id as text, first word and word after the last of each longest shared span.
    """
    if span < GRAM + WINDOW - 1:
        raise ValueError("winnowing guarantees spans of GRAM + WINDOW - 1 words")
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("n_words", "n_hit", "hits")
    keep = [c for c in (keep or docs.columns) if c in docs.columns]
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        shared = spark.sparkContext.broadcast(Index([tuple(r) for r in part.collect()], span))
        last = k == blocks - 1
        docs = _block(docs, shared, keep if last else list(dict.fromkeys([*keep, text])), text)
        if not last:
            docs = saved(docs, "overlaps")
    return docs


def contaminated(share: int = 20):
    """A hit, and at least one word in `share` inside shared spans."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def item_ids(hits: str = "hits"):
    """The items with shared spans, once each, sorted as text."""
    return F.array_sort(F.array_distinct(F.transform(F.col(hits), lambda h: h["item_id"])))
