"""Tables that change at once: stops at every step, two writers, readers, removal of what is old."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakepnl.session import new_folder
from lakepnl.sources import layers, published


class Stop(Exception):
    pass


def rows_of(spark, *rows):
    data = [(i, dt.date.fromisoformat(d) if d else None) for i, d in rows]
    return spark.createDataFrame(data, "id int, session_date date")


def ids(spark, path):
    return sorted((r["id"], str(r["session_date"])) for r in layers.read_loaded(spark, path).collect())


@pytest.fixture
def table(spark):
    path = new_folder(spark, "published")
    layers.replace_load(rows_of(spark, (1, "2020-01-01"), (2, "2020-01-02"), (3, None)), path, "", "full")
    return path


OLD = [(1, "2020-01-01"), (2, "2020-01-02"), (3, "None")]


@pytest.mark.parametrize("step", ["stage", "current", "_commit", "move"])
@pytest.mark.parametrize("mode", ["full", "incremental"])
def test_a_load_that_stops_leaves_the_old_table(spark, table, monkeypatch, step, mode):
    whole = getattr(published, step)

    def stop(*args, **kwargs):
        if step == "stage":  # the rows are there, what they mean is not
            whole(*args, **kwargs)
        raise Stop

    load = rows_of(spark, (8, "2020-01-02"), (9, "2020-01-01"))
    with monkeypatch.context() as patched:
        patched.setattr(published, step, stop)
        patched.setattr(layers, "stage", published.stage)
        with pytest.raises(Stop):
            layers.replace_load(load, table, "2020-01-02", mode)
    assert ids(spark, table) == OLD
    # Done again, it does what it would have done.
    layers.replace_load(load, table, "2020-01-02", mode)
    late = [] if mode == "full" else [(1, "2020-01-01"), (3, "None")]
    assert ids(spark, table) == sorted([*late, (8, "2020-01-02"), (9, "2020-01-01")])


def test_a_load_that_fails_in_its_rows_leaves_the_old_table(spark, table):
    bad = rows_of(spark, (8, "2020-01-02")).withColumn("id", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        layers.replace_load(bad, table, "2020-01-02")
    assert ids(spark, table) == OLD


def test_a_reader_sees_one_version(spark, table):
    before = layers.read_loaded(spark, table)
    layers.replace_load(rows_of(spark, (8, "2020-01-02")), table, "2020-01-02")
    assert before.count() == 3  # begun before, it ends on what it began with
    assert ids(spark, table) == [(1, "2020-01-01"), (3, "None"), (8, "2020-01-02")]


def test_two_writers_of_one_version(spark, table, monkeypatch):
    """The other load comes in between; both stay, and an upsert merges with what the other left."""
    commit, other = published._commit, [rows_of(spark, (20, "2020-01-05")), rows_of(spark, (2, "2020-01-02"), (21, "2020-01-02"))]

    def slow(spark, path, version):
        if other:
            rows = other.pop(0)
            schema, parts = published.stage(rows, path, ["session_date"])
            values = {p.values for p in parts}
            published.publish(spark, path, ["session_date"], schema, parts, lambda p: p.values in values)
        return commit(spark, path, version)

    monkeypatch.setattr(published, "_commit", slow)
    other_session, same_session = other
    other[:] = [other_session]
    layers.replace_load(rows_of(spark, (8, "2020-01-01")), table, "2020-01-01")
    assert ids(spark, table) == [(2, "2020-01-02"), (3, "None"), (8, "2020-01-01"), (20, "2020-01-05")]
    other[:] = [same_session]
    published.upsert(rows_of(spark, (2, "2020-01-02"), (22, "2020-01-02")), table, ["id"], ["session_date"])
    assert [i for i, _ in ids(spark, table)] == [2, 3, 8, 20, 21, 22]


def test_old_folders_go_and_strays_are_left(spark, table):
    stray, _ = published.stage(rows_of(spark, (99, "2020-01-01")), table, ["session_date"])
    for i in range(5):
        layers.replace_load(rows_of(spark, (10 + i, "2020-01-02")), table, "2020-01-02")
    folders = [n for n in published.list_names(spark, table) if n.startswith("version=")]
    # The first load's two sessions, the last two of the replaced one, and the stray.
    assert len(folders) == 4 and len(published.list_names(spark, f"{table}/_versions")) == 2
    assert ids(spark, table) == [(1, "2020-01-01"), (3, "None"), (14, "2020-01-02")]


def test_columns_of_older_loads_and_names_with_signs(spark):
    path = new_folder(spark, "t")
    first = spark.createDataFrame([(1, "a/b=c %"), (2, "é")], "id int, place string")
    published.upsert(first, path, ["id"], ["place"])
    published.upsert(first.where("id = 1").withColumn("more", F.lit("x")), path, ["id"], ["place"])
    got = sorted((r["id"], r["place"], r["more"]) for r in published.read_published(spark, path).collect())
    assert got == [(1, "a/b=c %", "x"), (2, "é", None)]
    with pytest.raises(ValueError, match="column id"):
        published.upsert(first.withColumn("id", F.col("place")), path, ["id"], ["place"])
    none = published.read_published(spark, path, lambda p: False)
    assert none.count() == 0 and none.columns == ["id", "place", "more"]
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, new_folder(spark, "none"))


def test_session_filter_prunes_published_parts(spark, table):
    df = layers.read_loaded(spark, table).where("session_date = '2020-01-02'")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_date" in text and df.count() == 1
