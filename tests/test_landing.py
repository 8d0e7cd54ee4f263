"""Landed batches: one lane at any time, files moved whole, ingests that stop at every step."""

import pytest
from pyspark.sql import functions as F

from lakepnl.operators import run_state as rs
from lakepnl.plans import jobs
from lakepnl.plans.datasets import PRICE_HISTORY, TRADE_EVENT, lake_config
from lakepnl.queries.landing import CONFIG
from lakepnl.schemas import PRICE_HISTORY_CONTRACT
from lakepnl.session import new_folder
from lakepnl.sources import landing, published
from lakepnl.sources.raw import scan_csv

HEADER = ",".join(PRICE_HISTORY_CONTRACT.columns)
GOOD = "1998-06-01,INS-1,1998-06-01 00:00:00,2.5,usd,SRC1,true,false,1998-06-01 00:00:00"
BAD = GOOD.replace("2.5", "n/a")


class Stop(Exception):
    pass


def records(spark, *rows):
    """(batch, lane, text) of one day and hour."""
    return spark.createDataFrame(list(rows), "batch_id string, lane string, record string").selectExpr(
        "*", "'d' AS dataset", "'1998-06-01' AS ingestion_date", "'05' AS ingestion_hour"
    )


def landed(spark, raw, dataset="d"):
    """Texts by lane, as readers find them."""
    found = {}
    for lane in landing.LANES:
        folders = landing.landed_folders(spark, raw, dataset, lane)
        found[lane] = sorted(r["value"] for r in spark.read.option("recursiveFileLookup", True).text(folders).collect()) if folders else []
    return found["validated"], found["rejected"]


def everything(spark, raw):
    return sorted(r["value"] for r in spark.read.option("recursiveFileLookup", True).text(f"{raw}/lane=*").collect())


def test_a_batch_is_in_one_lane(spark):
    raw = new_folder(spark, "raw")
    landing.write_lanes(records(spark, ("b1", "validated", "one"), ("b/2 [x]", "validated", "two")), raw)
    assert landed(spark, raw) == (["one", "two"], [])
    landing.write_lanes(records(spark, ("b1", "rejected", "bad")), raw)
    assert landed(spark, raw) == (["two"], ["bad"]) and everything(spark, raw) == ["bad", "two"]
    landing.write_lanes(records(spark, ("b1", "validated", "good"), ("b/2 [x]", "rejected", "2")), raw)
    assert landed(spark, raw) == (["good"], ["2"]) and everything(spark, raw) == ["2", "good"]
    # Another hour of the same day is the same batch.
    later = records(spark, ("b1", "validated", "later")).withColumn("ingestion_hour", F.lit("06"))
    landing.write_lanes(later, raw)
    assert landed(spark, raw) == (["later"], ["2"]) and everything(spark, raw) == ["2", "later"]
    some = spark.createDataFrame([("b1", "1998-06-01")], "batch_id string, business_date string")
    assert len(landing.landed_folders(spark, raw, "d", "validated", some)) == 1
    assert landing.landed_folders(spark, raw, "d", "rejected", some) == []
    assert landing.landed_folders(spark, raw, "other") is None


@pytest.mark.parametrize("step", ["upsert", "_sweep"])
def test_a_landing_that_stops(spark, monkeypatch, step):
    raw = new_folder(spark, "raw")
    landing.write_lanes(records(spark, ("b1", "validated", "one")), raw)

    def stop(*args):
        raise Stop

    again = records(spark, ("b1", "rejected", "bad"))
    with monkeypatch.context() as patched:
        patched.setattr(landing, step, stop)
        with pytest.raises(Stop):
            landing.write_lanes(again, raw)
    # Before the record changes readers see the old landing, from then on the new one.
    assert landed(spark, raw) == ((["one"], []) if step == "upsert" else ([], ["bad"]))
    landing.write_lanes(again, raw)
    assert landed(spark, raw) == ([], ["bad"]) and everything(spark, raw) == ["bad"]


def deliver(tmp_path, **files):
    for name, text in files.items():
        folder = tmp_path / "in" / "ingestion_date=1998-06-01" / f"batch_id={name.partition('_')[0]}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name} +1.csv").write_text(text)
    return str(tmp_path / "in")


def test_csv_files_keep_every_byte(spark, tmp_path):
    raw, state = new_folder(spark, "raw"), new_folder(spark, "state")
    odd = f"note,{HEADER}\r\n\"a, \"\"b\"\"\",{GOOD}\r\n\r\nz,{GOOD}\r\n"
    incoming = deliver(
        tmp_path, good=odd, two_a=f"{HEADER}\n{GOOD}\n", two_b=f"{HEADER}\n{GOOD}\n{BAD}\n{BAD}\n", head=HEADER + "\n",
        names=HEADER.replace("price,", "prices,") + f"\n{GOOD}\n", empty="",
    )
    got = {r["batch_id"]: (r["lane"], r["records"], r["bad_records"], r["reason"]) for r in jobs.ingest_csv(spark, incoming, PRICE_HISTORY, raw, state).collect()}
    assert got == {
        "good": ("validated", 2, 0, None),
        "two": ("rejected", 4, 2, "[3] price must be a number, got 'n/a'"),
        "head": ("validated", 0, 0, None),
        "names": ("rejected", 1, 1, "missing column price"),
        "empty": ("rejected", 0, 0, "no header"),
    }
    (moved,) = [f for f in (landing.landed_folders(spark, raw, "price_history") or []) if "batch_id=good" in f]
    with open(f"{moved}/good +1.csv", newline="") as file:
        assert file.read() == odd
    assert [p for p in (tmp_path / "in").rglob("*") if p.is_file()] == []
    prices = scan_csv(spark, landing.landed_folders(spark, raw, "price_history"), ["price", "instrument_id"])
    assert [tuple(r) for r in prices.collect()] == [("2.5", "INS-1")] * 2
    items = {r["sk"]: r["tables"]["price_history"]["status"] for r in rs.read_items(spark, state).collect()}
    assert items == {f"RUN#{b}": lane for b, (lane, *_) in got.items()}
    assert jobs.ingest_csv(spark, incoming, PRICE_HISTORY, raw, state).collect() == []
    # The same batch again, now good.
    again = jobs.ingest_csv(spark, deliver(tmp_path, names=f"{HEADER}\n{GOOD}\n"), PRICE_HISTORY, raw, state).collect()
    assert [(r["batch_id"], r["lane"]) for r in again] == [("names", "validated")]
    assert not any("names" in f for f in landing.landed_folders(spark, raw, "price_history", "rejected"))
    with pytest.raises(ValueError, match="no ingestion date"):
        (tmp_path / "in" / "x.csv").write_text(HEADER)
        jobs.ingest_csv(spark, incoming, PRICE_HISTORY, raw, state)


@pytest.mark.parametrize("step", ["move_file", "record_landings", "record_tables", "delete"])
def test_a_csv_ingest_that_stops(spark, tmp_path, monkeypatch, step):
    raw, state = new_folder(spark, "raw"), new_folder(spark, "state")
    incoming = deliver(tmp_path, a=f"{HEADER}\n{GOOD}\n", b=f"{HEADER}\n{BAD}\n", c=f"{HEADER}\n{GOOD}\n")
    whole, calls = getattr(jobs, step), []

    def stop(*args):
        calls.append(args)
        if step == "move_file" and len(calls) < 3:  # two files are there, one is not
            return whole(*args)
        raise Stop

    with monkeypatch.context() as patched:
        patched.setattr(jobs, step, stop)
        with pytest.raises(Stop):
            jobs.ingest_csv(spark, incoming, PRICE_HISTORY, raw, state)
    deliver(tmp_path, d=f"{HEADER}\n{GOOD}\n")
    jobs.ingest_csv(spark, incoming, PRICE_HISTORY, raw, state)
    names = {lane: sorted(f.split("batch_id=")[1][0] for f in landing.landed_folders(spark, raw, "price_history", lane)) for lane in landing.LANES}
    assert names == {"validated": ["a", "c", "d"], "rejected": ["b"]}
    items = {r["sk"][-1]: r["tables"]["price_history"]["lane"] for r in rs.read_items(spark, state).collect()}
    assert items == {"a": "validated", "b": "rejected", "c": "validated", "d": "validated"}
    assert published.list_names(spark, f"{raw}/{jobs.JOURNAL}") == []


def test_a_layer_runs_for_open_batches_only(spark, tmp_path):
    """A batch whose other table is rejected, or missing, does not reach the lake; a failure is recorded."""
    raw, state, std = (new_folder(spark, n) for n in ("raw", "state", "std"))
    text = ",".join(f'"{n}":' + ('"1998-06-01 00:00:00"' if k == "string" else "1.5") for n, k in TRADE_EVENT.contract.fields.items())
    rows = [("a", "{%s}" % text), ("b", "{%s}" % text), ("c", "{}"), ("e", "{%s}" % text)]
    trades = spark.createDataFrame([(b, i, r) for i, (b, r) in enumerate(rows)], "batch_id string, pos long, record string")
    jobs.ingest_json(spark, trades.withColumn("ingestion_date", F.lit("1998-06-01").cast("date")), TRADE_EVENT, raw, state)
    layer = "lake_validated_to_standardized"
    with pytest.raises(jobs.GateClosed):
        jobs.run_layer(spark, layer, state, lambda batches: pytest.fail("no batch is open"))
    prices = {n: f"{HEADER}\n{GOOD.replace('INS-1', 'INS-' + n)}\n" for n in "ace"}
    incoming = deliver(tmp_path, b=f"{HEADER}\n{BAD}\n", **prices)
    jobs.ingest_csv(spark, incoming, PRICE_HISTORY, raw, state)
    config, seen = lake_config(CONFIG), []

    def job(batches):
        seen.append(sorted(r["batch_id"] for r in batches.collect()))
        return jobs.validated_to_standardized(spark, config, raw, std, documents=False, batches=batches)

    assert jobs.run_layer(spark, layer, state, job) == {"trade_event": "READ", "price_history": "READ"}
    assert seen == [["a", "e"]]
    assert sorted(r["instrument_id"] for r in spark.read.parquet(f"{std}/price_history").collect()) == ["INS-a", "INS-e"]
    assert spark.read.parquet(f"{std}/trade_event").count() == 2

    def status(name):
        return {r["sk"][-1]: r["layers"][name]["status"] for r in rs.read_items(spark, state).collect() if name in r["layers"]}

    assert status(layer) == {"a": "SUCCEEDED", "e": "SUCCEEDED"}
    assert status("raw") == {"a": "SUCCEEDED", "b": "PENDING", "c": "PENDING", "e": "SUCCEEDED"}

    def failing(batches):
        raise RuntimeError("x" * 3000)

    one = spark.createDataFrame([("a", "1998-06-01"), ("b", "1998-06-01")], "batch_id string, business_date string")
    with pytest.raises(RuntimeError, match="xxx"):
        jobs.run_layer(spark, "lake_standardized_to_silver", state, failing, batches=one)
    assert status("lake_standardized_to_silver") == {"a": "FAILED"}
    (item,) = rs.read_items(spark, state).where("sk = 'RUN#a'").collect()
    assert len(item["layers"]["lake_standardized_to_silver"]["full_error"]) == 3000
    with pytest.raises(jobs.GateClosed):
        jobs.run_layer(spark, "redshift_silver", state, failing)
    assert jobs.run_layer(spark, "lake_standardized_to_silver", state, lambda _: 7) == 7
    assert status("lake_standardized_to_silver") == {"a": "SUCCEEDED", "e": "SUCCEEDED"}
