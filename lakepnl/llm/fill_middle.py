"""Fill-in-middle examples by rotating blocks of a buffer in place, and back again.

A text is cut into units, runs of letters or single other characters, of which two cuts that
follow from a hash of the id make prefix, middle and suffix. Sentinels go in front of the three
parts while they still stand in their order; then two neighbouring blocks of the buffer change
places by three reversals. One rotation gives either form:

    psm  <P>prefix <M>middle <S>suffix   ->   <P>prefix | <S>suffix <M>middle
    spm  <P>prefix <M>middle <S>suffix   ->   <S>suffix | <P>prefix <M>middle

restore finds the sentinels of an output, undoes the rotation and takes the sentinels out, which
gives back the exact text from the output and its form alone. A text that has a sentinel in it stays
plain, so sentinels are never ambiguous; so does an empty one.

Everything works on whole texts as UTF-8 bytes, in slices of about one MB or one longer text. A null
text counts as empty, a null id as no digits. Repeated rows give equal rows; an empty table stays
empty. All other columns are kept, and those of the names that are made are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepnl.llm.text import slices, small_batches

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Shape:
    """Seed of the cuts, shares of the forms in percent, and the three sentinels."""

    seed: int = 1
    plain_percent: int = 10
    spm_percent: int = 20
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def sentinels(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


DEFAULT = Shape()


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Where each unit of a text begins: a run of A-Z and a-z, or any other single character."""
    lower = data | 0x20
    letter = (lower >= 0x61) & (lower <= 0x7A) & (data < 0x80)
    start = ~letter & ((data & 0xC0) != 0x80)
    start[:1] |= letter[:1]
    start[1:] |= letter[1:] & ~letter[:-1]
    return np.flatnonzero(start)


def characters(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def reverse(view: np.ndarray, first: int, last: int) -> None:
    """Reverses view[first:last] in place by exchanging its halves."""
    half = (last - first) // 2
    if half:
        left, right = view[first : first + half], view[last - half : last]
        kept = left[::-1].copy()
        left[:] = right[::-1]
        right[:] = kept


def rotate(view: np.ndarray, first: int, border: int, last: int) -> None:
    """Exchanges the neighbours view[first:border] and view[border:last] by three reversals."""
    reverse(view, first, border)
    reverse(view, border, last)
    reverse(view, first, last)


def numbers(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2^32 that follow from an id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return np.frombuffer(digest[:16], ">u4").tolist()


def transform(text: bytes, doc_id: int | None, shape: Shape = DEFAULT) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, characters of prefix and middle, and the output of one text."""
    data = np.frombuffer(text, np.uint8)
    starts = unit_starts(data)
    n = len(starts)
    h = numbers(doc_id, shape.seed)
    if not n or any(s in text for s in shape.sentinels) or h[2] % 100 >= 100 - shape.plain_percent:
        return n, PLAIN, None, None, text
    cuts = sorted(x % (n + 1) for x in h[:2])
    a, b = (int(starts[c]) if c < n else len(data) for c in cuts)
    before, after, between = shape.sentinels
    buffer = bytearray(text)
    # From the right, so that positions to the left stay as they are.
    buffer[b:b] = after
    buffer[a:a] = between
    buffer[0:0] = before
    middle_at = len(before) + a
    suffix_at = middle_at + len(between) + b - a
    form = SPM if h[3] % 100 < shape.spm_percent else PSM
    rotate(np.frombuffer(buffer, np.uint8), middle_at if form == PSM else 0, suffix_at, len(buffer))
    return n, form, characters(data[:a]), characters(data[a:b]), bytes(buffer)


def invert(output: bytes, form: str, shape: Shape = DEFAULT) -> bytes:
    """The text of an output: rotated back, then without its sentinels."""
    if form == PLAIN:
        return output
    before, after, between = shape.sentinels
    buffer = bytearray(output)
    view = np.frombuffer(buffer, np.uint8)
    suffix_at, moved_at = output.index(after), output.index(between if form == PSM else before)
    # What the rotation brought to the front is len(buffer) - moved_at long at the end again.
    rotate(view, suffix_at, moved_at, len(buffer))
    del view
    suffix_at += len(buffer) - moved_at
    middle_at = buffer.index(between)
    del buffer[suffix_at : suffix_at + len(after)]
    del buffer[middle_at : middle_at + len(between)]
    del buffer[: len(before)]
    return bytes(buffer)


def _added(df: DataFrame, made: T.StructType) -> tuple[DataFrame, T.StructType]:
    """The columns that stay, and the schema with those that are made after them."""
    kept = df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in made.names])
    return kept, T.StructType([*kept.schema.fields, *made.fields])


def fill_in_middle(docs: DataFrame, shape: Shape = DEFAULT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Adds n (long), form, prefix_chars, middle_chars (long, null where plain) and output."""
    small_batches(docs.sparkSession)
    made = T._parse_datatype_string("n long, form string, prefix_chars long, middle_chars long, output string, _text string, _id long")
    named = docs.withColumns({"_text": F.coalesce(F.col(text).cast("string"), F.lit("")), "_id": F.col(doc_id).cast("long")})
    own = T.StructType(made.fields[:5])
    kept, schema = _added(named, own)
    out = T.StructType([f for f in schema.fields if f.name not in ("_text", "_id")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("_id").to_pylist()
            for row, stop, data, offsets in slices(batch, "_text"):
                whole = data.tobytes()
                rows = [
                    transform(whole[a:b], i, shape)
                    for i, a, b in zip(ids[row:stop], offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                ]
                yield _with(batch, row, stop, rows, own, ("_text", "_id"))

    return kept.mapInArrow(run, out)


def restore(df: DataFrame, output: str = "output", form: str = "form", shape: Shape = DEFAULT) -> DataFrame:
    """Adds restored, the text that an output was made from."""
    small_batches(df.sparkSession)
    own = T.StructType([T.StructField("restored", T.StringType())])
    kept, schema = _added(df, own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column(form).to_pylist()
            for row, stop, data, offsets in slices(batch, output):
                whole = data.tobytes()
                rows = [
                    (invert(whole[a:b], f, shape),)
                    for f, a, b in zip(forms[row:stop], offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                ]
                yield _with(batch, row, stop, rows, own, ())

    return kept.mapInArrow(run, schema)


_ARROW = {"bigint": pa.int64(), "string": pa.large_string()}


def _with(batch: pa.RecordBatch, row: int, stop: int, rows: list[tuple], made: T.StructType, without: tuple[str, ...]) -> pa.RecordBatch:
    """Some rows of a batch with new columns."""
    part = batch.slice(row, stop - row)
    names = [n for n in part.schema.names if n not in without]
    columns = [part.column(n) for n in names]
    for field, values in zip(made.fields, zip(*rows, strict=True), strict=True):
        kind = _ARROW[field.dataType.simpleString()]
        if pa.types.is_large_string(kind):
            values = [v.decode() if isinstance(v, bytes) else v for v in values]
        columns.append(pa.array(values, kind))
    return pa.RecordBatch.from_arrays(columns, [*names, *made.names])
