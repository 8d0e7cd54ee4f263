"""Tables that change at once: data folders, and one small version file that says which of them count.

    <table>/version=<id>/<partition columns>/part-*.parquet    written by one load, never changed
    <table>/_versions/<number>.json                             columns, schema, and the folders of the table

A load writes its rows to a folder of its own, which no reader looks at, and then adds the next
version file, which names all folders of the table from now on. A load that stops before that
leaves the table as it was; what it has written is never read. Readers resolve the newest
version, so they see all of a load or nothing of it, whichever partitions it touches. A version
file appears by a rename, so it is there as a whole or not at all; two writers of the same version
are told apart where the store refuses to rename onto a file, and the later one starts over
from the other's version.

A version names one folder for each partition and load, so it grows with their number, not with
rows or files. Old versions and folders that only they name go KEPT versions later, so that a query
that has begun can end. Spark tables and queries know nothing of this: a version is
read as plain Parquet with its partition columns, and partition filters prune as ever.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepnl.session import FREES_SHUFFLES, settings, stored

#: Versions that stay readable, the newest among them.
KEPT = 2
VERSIONS = "_versions"
#: Files that a task of a partitioned write holds open at most; a scan task reads no more than that (of 4 MB and more).
OPEN_FILES = 32
#: Rows are written where they lie if they have at most so many partition values, of so many rows on average.
FEW_VALUES, MANY_ROWS = 16, 1_000_000
#: So are rows of at most so many values that are so many in all; a task then holds a file open for each of the values.
MORE_VALUES, HUGE_ROWS = 100, 50_000_000
#: What keeps that many open Parquet files small in memory: row groups of 8 MB and short dictionaries.
SMALL_BUFFERS = {"parquet.block.size": 8 << 20, "parquet.dictionary.page.size": 64 << 10}
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class PublishConflict(RuntimeError):
    """Another load has changed a part that this one was made from."""


@dataclass(frozen=True)
class Part:
    """One folder: the values of its partition columns as in folder names, and the load that wrote it."""

    values: tuple[str | None, ...]
    load: str
    folder: str


@dataclass(frozen=True)
class Version:
    number: int
    columns: tuple[str, ...]
    schema: T.StructType | None
    parts: tuple[Part, ...]


def _fs(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, folder = _fs(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(folder)) if fs.exists(folder) else []


def find_folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """What lies below a folder by a pattern of names, as paths from there."""
    fs, folder = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    depth = pattern.count("/") + 1
    # The folder itself may have signs that a pattern would take for its own.
    plain = re.sub(r"([\\*?\[\]{}])", r"\\\1", folder.toString())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{plain}/{pattern}")) or []
    return ["/".join(x.getPath().toString().split("/")[-depth:]) for x in found]


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder or file if it is there."""
    fs, folder = _fs(spark, path)
    fs.delete(folder, True)


def delete_if_empty(spark: SparkSession, path: str) -> None:
    fs, folder = _fs(spark, path)
    if fs.exists(folder) and not fs.listStatus(folder):
        fs.delete(folder, False)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a file or folder, making the folder above; False if the target is there already."""
    fs, old = _fs(spark, source)
    new = _fs(spark, target)[1]
    fs.mkdirs(new.getParent())
    return not fs.exists(new) and fs.rename(old, new)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = [re.fullmatch(r"(\d+)\.json", n) for n in list_names(spark, f"{path}/{VERSIONS}")]
    return sorted(int(m.group(1)) for m in found if m)


def _file(path: str, number: int) -> str:
    return f"{path}/{VERSIONS}/{number:010d}.json"


def _read(spark: SparkSession, path: str, number: int) -> Version:
    fs, file = _fs(spark, _file(path, number))
    stream = fs.open(file)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    doc = json.loads(text)
    schema = doc["schema"] and T.StructType.fromJson(doc["schema"])
    parts = tuple(Part(tuple(p["values"]), p["load"], p["folder"]) for p in doc["parts"])
    return Version(number, tuple(doc["columns"]), schema, parts)


def current(spark: SparkSession, path: str) -> Version:
    """The newest version; number 0 has no parts, and belongs to a table that is not there."""
    numbers = _numbers(spark, path)
    return _read(spark, path, numbers[-1]) if numbers else Version(0, (), None, ())


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def _commit(spark: SparkSession, path: str, version: Version) -> bool:
    """Adds a version file; False if another writer has added that number."""
    doc = {"columns": version.columns, "schema": version.schema and version.schema.jsonValue(), "parts": [asdict(p) for p in version.parts]}
    fs, draft = _fs(spark, f"{path}/{VERSIONS}/.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(doc).encode()))
    finally:
        out.close()
    if move(spark, draft.toString(), _file(path, version.number)):
        return True
    fs.delete(draft, False)
    return False


def look(rows: DataFrame, *columns: str) -> str:
    """How rows of a plain scan are best dealt by their partition values, after a count that reads no other columns."""
    return judge(rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")))


def judge(counts: DataFrame) -> str:
    """The same from counts that are known: a row for each value, with `n` rows.

    `never` for a few values of many rows and `open` for more values of very many rows in all, as every task then
    fills its files anyway; `always` for others.
    """
    found = counts.agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows")).first()
    values, size = found["values"], found["rows"] or 0
    if 0 < values <= FEW_VALUES and size >= values * MANY_ROWS:
        return "never"
    return "open" if 0 < values <= MORE_VALUES and size >= HUGE_ROWS else "always"


def dealt(rows: DataFrame, *columns: str, deal: str = "always") -> DataFrame:
    """Rows dealt by their partition values, for few files of each; AQE splits a value that is too large for one task.

    Dealing sends every row through a shuffle. `deal="never"` leaves out what brings nothing: rows that are read from
    a table with the same partition columns, whose tasks have few values each as it is. `deal="open"` is for
    tasks with more values (`open_files`). `deal="look"` is one of the three, by `look`.
    """
    if deal == "look":
        deal = look(rows, *columns)
    return rows.hint("rebalance", *columns) if deal == "always" else rows


@contextmanager
def open_files(spark: SparkSession, deal: str = "always") -> Iterator[None]:
    """Partitioned writes that keep a file open for each value, and so need not sort; a task with more values sorts the rest.

    Rows that are written where they lie with more values than usual (`deal="open"`) have a file open for each of them.
    Shuffle files of the write go when it ends.
    """
    more = deal == "open"
    most = {"spark.sql.maxConcurrentOutputFileWriters": MORE_VALUES if more else OPEN_FILES}
    with settings(spark, {**FREES_SHUFFLES, **most, **(SMALL_BUFFERS if more else {})}):
        yield


def stage(
    rows: DataFrame, path: str, columns: Iterable[str], load: str = "", deal: str = "always"
) -> tuple[T.StructType, list[Part]]:
    """Writes rows to a folder of their own, where nobody reads them yet; `deal` as in `dealt`."""
    spark, columns = rows.sparkSession, list(columns)
    folder = f"version={uuid.uuid4().hex}"
    deal = look(rows, *columns) if deal == "look" else deal
    with open_files(spark, deal):
        dealt(rows, *columns, deal=deal).write.partitionBy(*columns).parquet(f"{path}/{folder}")
    found = [((), folder)]
    for column in columns:
        found = [
            ((*values, _value(name, column)), f"{above}/{name}")
            for values, above in found
            for name in list_names(spark, f"{path}/{above}")
            if name.startswith(f"{column}=")
        ]
    return rows.schema, [Part(values, load, name) for values, name in found]


def folder_name(column: str, value: str | None) -> str:
    """The folder of a partition value, as Spark names it; an empty text counts as none."""
    signs = "[\\x01-\\x1f\\x7f\"#%'*/:=?\\\\{\\[\\]^]"
    text = re.sub(signs, lambda m: f"%{ord(m.group()):02X}", value or "")
    return f"{column}={text or NULL_FOLDER}"


def _value(name: str, column: str) -> str | None:
    text = re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m.group(1), 16)), name[len(column) + 1 :])
    return None if text == NULL_FOLDER else text


def _merged(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """The columns of a load, then those that only older loads have."""
    fields = {f.name: f for f in new.fields}
    for field in old.fields if old else []:
        same = fields.setdefault(field.name, field)
        if same.dataType.simpleString() != field.dataType.simpleString():
            raise ValueError(f"column {field.name} is {field.dataType.simpleString()}, not {same.dataType.simpleString()}")
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields.values()])


def publish(
    spark: SparkSession,
    path: str,
    columns: Iterable[str],
    schema: T.StructType,
    parts: Iterable[Part],
    replaces: Callable[[Part], bool],
    made_from: Version | None = None,
    whole: bool = False,
) -> Version:
    """One step: the parts that `replaces` names go, the new ones come.

    With `made_from`, parts that went into the new ones have to be those of that version still; else
    PublishConflict is raised, and the load has to be made again. `whole` replaces the schema too.
    """
    parts = tuple(parts)
    while True:
        before = current(spark, path)
        gone = [p for p in before.parts if replaces(p)]
        if made_from is not None and set(gone) != {p for p in made_from.parts if replaces(p)}:
            raise PublishConflict(path)
        kept = tuple(p for p in before.parts if p not in set(gone))
        merged = _merged(None if whole else before.schema, schema)
        after = Version(before.number + 1, tuple(columns), merged, (*kept, *parts))
        if _commit(spark, path, after):
            retire(spark, path)
            return after


def retire(spark: SparkSession, path: str, keep: int = KEPT) -> None:
    """Removes versions beyond the newest `keep`, with the folders that no newer one names.

    Folders of a load that has not been published are in no version, so they are left alone.
    """
    numbers = _numbers(spark, path)
    if len(numbers) <= keep:
        return
    named = {p.folder for n in numbers[-keep:] for p in _read(spark, path, n).parts}
    loads = {folder.partition("/")[0] for folder in named}
    for number in numbers[:-keep]:
        for folder in {p.folder for p in _read(spark, path, number).parts} - named:
            own = folder.partition("/")[0]
            delete(spark, f"{path}/{folder if own in loads else own}")
        delete(spark, _file(path, number))


def read_published(
    spark: SparkSession, path: str, keep: Callable[[Part], bool] | None = None, version: Version | None = None
) -> DataFrame:
    """The newest version of a table, or some parts of it."""
    version = version or current(spark, path)
    if version.schema is None:
        raise FileNotFoundError(f"no published table at {path}")
    folders = [f"{path}/{p.folder}" for p in version.parts if keep is None or keep(p)]
    if not folders:
        return spark.createDataFrame([], version.schema)
    with_version = T.StructType([*version.schema.fields, T.StructField("version", T.StringType())])
    rows = spark.read.schema(with_version).option("basePath", path).parquet(*folders)
    return rows.select(*[F.col(f"`{name}`") for name in version.schema.names])


def upsert(rows: DataFrame, path: str, keys: list[str], columns: list[str], tries: int = 5) -> Version:
    """Puts rows in the place of stored ones with the same keys, in one step.

    Only parts that hold one of the rows are read and written again, and keys must not move between
    parts. Rows have one row for each key. If another load changes such a part meanwhile, the
    merge is made again.
    """
    spark = rows.sparkSession
    fresh = stored(rows, "fresh")
    named = fresh.select(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in columns]).distinct()
    touched = {tuple(r) for r in named.collect()}
    while True:
        before, together = current(spark, path), fresh
        _merged(before.schema, fresh.schema)
        if any(p.values in touched for p in before.parts):
            old = read_published(spark, path, lambda p: p.values in touched, before)
            same = [old[k].eqNullSafe(fresh[k]) for k in keys]
            together = old.join(fresh, same, "left_anti").unionByName(fresh, allowMissingColumns=True)
        schema, parts = stage(together, path, columns)
        try:
            return publish(spark, path, columns, schema, parts, lambda p: p.values in touched, before)
        except PublishConflict:
            for folder in {p.folder.partition("/")[0] for p in parts}:
                delete(spark, f"{path}/{folder}")
            tries -= 1
            if not tries:
                raise
