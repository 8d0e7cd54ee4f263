"""Token counts that follow edits.

A document is kept as a segment tree over its units of text (see tokens.py): leaves are blocks
of units with their bytes and tokens, inner nodes are the sums of two nodes below. An edit
goes down the tree to the unit before its first byte, cuts and encodes again only the units
that it touches, with a few bytes of context on both sides, and carries the new sums up the
path. The count of the edited document is the root's. The documents of a batch are edited side by
side, so that the tokenizer's store is asked once for the next edit of all of them.

The borders of units depend on the three bytes before them at most, so units that end before
the edit, or begin three bytes after it, stay as they are.

Trees are a column (bytes and tokens of the units); edits are rows of code point ranges of
the document as it was, not overlapping. Null and empty texts have no units and count 0.
Null edits and documents without edits keep their counts; edits beyond the end are cut to
it, and null replacements are empty. Repeated rows count alike. Extra columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepnl.llm.text import SLICE, Words, slices, small_batches
from lakepnl.llm.tokens import Encoder, encoder, units

BLOCK = 64
CONTEXT = 3
ADDED = ("n_tokens", "units")


class Tree:
    """Sums of bytes and tokens over the units of a document."""

    def __init__(self, sizes: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves = [
            (sizes[k : k + BLOCK], tokens[k : k + BLOCK]) for k in range(0, max(1, len(sizes)), BLOCK)
        ]
        self._grow()

    def _grow(self) -> None:
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        lengths = np.fromiter((len(sizes) for sizes, _ in self.leaves), np.int64, len(self.leaves))
        for k in (0, 1):
            ends = np.concatenate(([0], np.cumsum(np.concatenate([leaf[k] for leaf in self.leaves]))))
            at = np.concatenate(([0], np.cumsum(lengths)))
            self.sums[self.width : self.width + len(lengths), k] = np.diff(ends[at])
        level = self.width
        while level > 1:
            level //= 2
            self.sums[level : 2 * level] = self.sums[2 * level : 4 * level].reshape(-1, 2, 2).sum(1)

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, byte: int) -> tuple[int, int, int]:
        """(leaf, unit in the leaf, first byte of the unit) of the unit that holds a byte, else of the last."""
        node, first = 1, 0
        byte = min(byte, int(self.sums[1, 0]) - 1)
        while node < self.width:
            node *= 2
            if byte >= first + self.sums[node, 0] and self.sums[node + 1, 0]:
                first += int(self.sums[node, 0])
                node += 1
        sizes = self.leaves[node - self.width][0]
        ends = first + np.cumsum(sizes)
        k = min(int(np.searchsorted(ends, byte, "right")), max(0, len(sizes) - 1))
        return node - self.width, k, int(ends[k] - sizes[k]) if len(sizes) else first

    def replace(self, low: tuple[int, int], high: tuple[int, int], sizes: np.ndarray, tokens: np.ndarray) -> None:
        """Puts units in the place of those from (leaf, unit) to (leaf, unit), the last one included."""
        (a, i), (b, j) = low, high
        head, tail = [x[:i] for x in self.leaves[a]], [x[j + 1 :] for x in self.leaves[b]]
        merged = [np.concatenate(x) for x in zip(head, (sizes, tokens), tail, strict=True)]
        none = np.zeros(0, np.int64)
        if len(merged[0]) > 4 * BLOCK:
            blocks = [(merged[0][k : k + BLOCK], merged[1][k : k + BLOCK]) for k in range(0, len(merged[0]), BLOCK)]
            self.leaves[a : b + 1] = blocks
            self._grow()
            return
        self.leaves[a] = (merged[0], merged[1])
        for k in range(a + 1, b + 1):
            self.leaves[k] = (none, none)
        for k in range(a, b + 1):
            node = self.width + k
            self.sums[node] = self.leaves[k][0].sum(), self.leaves[k][1].sum()
            while node > 1:
                node //= 2
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def touch(self, data: bytes, first: int, last: int, new: bytes) -> Touch:
        """What has to be encoded when data[first:last] is replaced."""
        if not data:
            return Touch(None, None, 0, new)
        leaf, unit, begin = self.find(max(0, first - 1))
        far_leaf, far_unit, far = self.find(min(len(data) - 1, last + CONTEXT - 1))
        end = far + int(self.leaves[far_leaf][0][far_unit])
        context = max(0, begin - CONTEXT)
        return Touch((leaf, unit), (far_leaf, far_unit), begin - context, data[context:first] + new + data[last:end])

    def put(self, touch: Touch, sizes: np.ndarray, tokens: np.ndarray) -> None:
        """Puts the units of a touch in their place."""
        if touch.low is None:
            self.leaves = Tree(sizes, tokens).leaves
            self._grow()
        else:
            self.replace(touch.low, touch.high, sizes, tokens)


class Touch(NamedTuple):
    """Units that an edit touches, as (leaf, unit) of the first and last, none in an empty text, and their
    bytes after the edit; the first skip bytes are context and belong to the units before."""

    low: tuple[int, int] | None
    high: tuple[int, int] | None
    skip: int
    data: bytes


def _encoded(touches: list[Touch], model: Encoder) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and tokens of the units of each touch, which meet the tokenizer about SLICE bytes at once."""
    ends = np.cumsum([len(t.data) for t in touches])
    for own in np.split(np.arange(len(touches)), np.flatnonzero(np.diff(ends // SLICE)) + 1):
        group = [touches[k] for k in own]
        offsets = np.concatenate(([0], np.cumsum([len(t.data) for t in group])))
        found = units(np.frombuffer(b"".join(t.data for t in group), np.uint8), offsets)
        begin = offsets[:-1] + [t.skip for t in group]
        inner = found.start > np.repeat(begin, found.counts())
        start = np.sort(np.concatenate((begin[begin < offsets[1:]], found.start[inner])))
        first = np.searchsorted(start, offsets)
        end = np.minimum(np.append(start[1:], offsets[-1])[: len(start)], np.repeat(offsets[1:], np.diff(first)))
        tokens = model.counts(Words(found.data, start, end, first))
        for a, b in zip(first, first[1:], strict=False):
            yield end[a:b] - start[a:b], tokens[a:b]


_UNITS = T.StructType().add("bytes", "binary").add("tokens", "binary")


def build(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Adds n_tokens and units (bytes and tokens of every unit, four bytes each) to the documents."""
    small_batches(docs.sparkSession)
    docs = docs.drop(*ADDED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer)
        for batch in batches:
            total, sizes, tokens = [], [], []
            for _, _, data, offsets in slices(batch, text):
                found = units(data, offsets) if len(data) else None
                counts = model.counts(found) if found else np.zeros(0, np.int64)
                widths = (found.end - found.start) if found else counts
                at = found.first if found else np.zeros(len(offsets), np.int64)
                for a, b in zip(at, at[1:], strict=False):
                    total.append(int(counts[a:b].sum()))
                    sizes.append(widths[a:b].astype("<u4").tobytes())
                    tokens.append(counts[a:b].astype("<u4").tobytes())
            tree = pa.StructArray.from_arrays(
                [pa.array(sizes, pa.binary()), pa.array(tokens, pa.binary())], ["bytes", "tokens"]
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(total, pa.int64()), tree], [*batch.schema.names, *ADDED]
            )

    schema = T.StructType([*docs.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("units", _UNITS)])
    return docs.mapInArrow(run, schema)


def apply_edits(trees: DataFrame, tokenizer: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """Edits the text of rows with n_tokens, units and edits (array of first, last, new).

    text, units and n_tokens become those of the edited document; n_before, n_units and n_encoded
    (units encoded again) are added, and the edits go.
    """
    kept = [f for f in trees.schema.fields if f.name not in (text, edits, *ADDED, "n_before", "n_units", "n_encoded")]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer)
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            columns = (column[text], column["n_tokens"], column["units"], column[edits])
            rows = _edited_rows([tuple(x.as_py() for x in row) for row in zip(*columns, strict=True)], model)
            made = list(zip(*rows, strict=True)) if rows else [[]] * 7
            tree = pa.StructArray.from_arrays(
                [pa.array(made[1], pa.binary()), pa.array(made[2], pa.binary())], ["bytes", "tokens"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *[column[n] for n in names],
                    pa.array(made[0], pa.string()),
                    tree,
                    *[pa.array(made[k], pa.int64()) for k in (3, 4, 5, 6)],
                ],
                [*names, text, "units", "n_before", "n_tokens", "n_units", "n_encoded"],
            )

    schema = T.StructType([*kept, T.StructField(text, T.StringType()), T.StructField("units", _UNITS)])
    for name in ("n_before", "n_tokens", "n_units", "n_encoded"):
        schema = schema.add(name, "long")
    return trees.mapInArrow(run, schema)


class _Document:
    """A text under edit, the edits still to be made, next one last, and its tree."""

    def __init__(self, whole: str | None, before: int, stored: dict, changes: list[dict] | None) -> None:
        sizes, tokens = (np.frombuffer(stored[k], "<u4").astype(np.int64) for k in ("bytes", "tokens"))
        self.whole, self.before, self.changed, self.encoded = whole, before, bool(changes), 0
        self.tree, self.changes = Tree(sizes, tokens), []
        self.data = (whole or "").encode("utf-8", "surrogatepass")
        if changes:
            starts = np.flatnonzero((np.frombuffer(self.data, np.uint8) & 0xC0) != 0x80)
            byte_of = np.append(starts, len(self.data))
            for change in sorted(changes, key=lambda c: -c["first"]):
                first, last = (int(byte_of[min(max(0, change[k]), len(byte_of) - 1)]) for k in ("first", "last"))
                new = (change["new"] or "").encode("utf-8", "surrogatepass")
                self.changes.append((first, max(first, last), new))
            self.changes.reverse()

    def next(self) -> Touch:
        first, last, new = self.changes.pop()
        touch = self.tree.touch(self.data, first, last, new)
        self.data = self.data[:first] + new + self.data[last:]
        return touch

    def row(self) -> tuple:
        whole = self.data.decode("utf-8", "surrogatepass") if self.changed else self.whole
        sizes, tokens = (np.concatenate([leaf[k] for leaf in self.tree.leaves]) for k in (0, 1))
        return (
            whole,
            sizes.astype("<u4").tobytes(),
            tokens.astype("<u4").tobytes(),
            self.before,
            self.tree.n_tokens,
            len(sizes),
            self.encoded,
        )


def _edited_rows(rows: list[tuple], model: Encoder) -> list[tuple]:
    """Edits all documents of a batch side by side: the next edit of each, encoded together, until none is left."""
    documents = [_Document(*row) for row in rows]
    while left := [d for d in documents if d.changes]:
        touches = [d.next() for d in left]
        for document, touch, (sizes, tokens) in zip(left, touches, _encoded(touches, model), strict=True):
            document.tree.put(touch, sizes, tokens)
            document.encoded += len(sizes)
    return [d.row() for d in documents]


def _edited(whole: str | None, before: int, stored: dict, changes: list[dict], model: Encoder) -> tuple:
    return _edited_rows([(whole, before, stored, changes)], model)[0]


def sample_edits(text: str = "text", new: str = "source") -> Column:
    """Three edits of a text that come from the row itself: a cut, an insertion and a replacement."""
    n = F.char_length(F.coalesce(F.col(text), F.lit("")))
    name = F.coalesce(F.col(new).cast("string"), F.lit(""))

    def change(first: Column, last: Column, text: Column) -> Column:
        return F.struct(first.cast("long").alias("first"), last.cast("long").alias("last"), text.alias("new"))

    quarter, half, rest = F.floor(n / 4), F.floor(n / 2), F.floor(3 * n / 4)
    return F.array(
        change(quarter, F.least(quarter + 7, half), F.lit("")),
        change(half, half, F.concat(F.lit(" "), name, F.lit("'s "))),
        change(rest, F.least(rest + 5, n), name),
    )
