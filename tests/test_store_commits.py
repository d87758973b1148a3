"""Concurrent writers, touched buckets and interrupted pushes of the stores."""

import datetime as dt
import threading

import pytest

from fleetcast.sources import events as src
from fleetcast.sources import online_store as store
from fleetcast.sources.manifest import Manifest, ManifestLog
from fleetcast.specs import DRIVER_AGG

SCHEMA = "driver_id string, lat double, event_ts timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def snap(spark, ids, lat=1.0, hour=1):
    return spark.createDataFrame([(f"d{i}", lat, T0 + dt.timedelta(hours=hour)) for i in ids], SCHEMA)


@pytest.mark.parametrize("linked", [True, False])
def test_a_version_is_taken_once(spark, tmp_dir, monkeypatch, linked):
    """By link on a local disk, by a rename that never replaces elsewhere."""
    if not linked:
        monkeypatch.setattr("fleetcast.sources.manifest.LINKING", ())
    log = ManifestLog(spark, f"{tmp_dir}/t")
    assert log.publish(Manifest(1, {"a": "x"})) and not log.publish(Manifest(1, {"a": "y"}))
    assert log.latest().live == {"a": "x"} and log.versions() == [1]
    assert [st.getPath().getName() for st in log.fs.listStatus(log.folder)] == ["v=0000000001"]


def test_writers_that_read_one_version_lose_no_row(spark, tmp_dir, monkeypatch):
    """Three writers merge into the version that all of them read; two have to merge again."""
    root, keys = f"{tmp_dir}/online", ["driver_id"]
    store.upsert_online(snap(spark, range(5)), root, "v", keys, buckets=3)
    barrier, tries = threading.Barrier(3), []
    real = ManifestLog.publish

    def publish(self, manifest):
        tries.append(manifest.version)
        if manifest.version == 2:
            barrier.wait(timeout=120)   # all have read version 1 and written their rows
        return real(self, manifest)

    monkeypatch.setattr(ManifestLog, "publish", publish)
    errors = []

    def write(n):
        try:
            store.upsert_online(snap(spark, [0, *range(10 * n, 10 * n + 10)], float(n), n + 1), root, "v", keys, (f"w{n}", 7))
        except Exception as e:  # noqa: BLE001 - shown by the assertion below
            errors.append(e)

    threads = [threading.Thread(target=write, args=(n,)) for n in (1, 2, 3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and sorted(tries)[:3] == [2, 2, 2] and len(tries) > 4
    got = {r["driver_id"]: r["lat"] for r in store.read_online(spark, root, "v").collect()}
    assert set(got) == {f"d{i}" for i in [*range(5), *range(10, 40)]} and got["d0"] == 3.0
    assert {w: store.last_commit(spark, f"{root}/v", w) for w in ("w1", "w2", "w3")} == {"w1": 7, "w2": 7, "w3": 7}


def test_an_upsert_rewrites_the_touched_buckets_only(spark, tmp_dir):
    root, keys = f"{tmp_dir}/online", ["driver_id"]
    store.upsert_online(snap(spark, range(200)), root, "v", keys, buckets=8)
    log = ManifestLog(spark, f"{root}/v")
    before = log.latest()
    store.upsert_online(snap(spark, [3], 9.0, 5), root, "v", keys)
    after = log.latest()
    changed = [b for b in after.live if after.live[b] != before.live.get(b)]
    assert len(before.live) == 8 and len(changed) == 1
    key = spark.createDataFrame([("d3",)], "driver_id string")
    part = store.read_online(spark, root, "v", keys=key)
    assert part.count() < 60 and part.where("driver_id = 'd3'").first()["lat"] == 9.0
    assert store.read_online(spark, root, "v").count() == 200
    for n in range(5):   # older versions go, and with them the folders that only they hold
        store.upsert_online(snap(spark, [3], float(n), 6 + n), root, "v", keys)
    assert log.versions() == [5, 6, 7]
    folders = {f.split("/")[1] for v in log.versions() for f in log.read(v).live.values()}
    assert {st.getPath().getName() for st in log.fs.listStatus(log.path(f"{root}/v/data"))} == folders


def test_empty_and_replaced_snapshots(spark, tmp_dir):
    root = f"{tmp_dir}/online"
    assert store.read_online(spark, root, "v") is None
    assert store.upsert_online(snap(spark, []), root, "v", ["driver_id"]) == 1
    assert store.read_online(spark, root, "v").count() == 0
    assert store.write_online(snap(spark, range(3)), root, "v") == 2
    assert store.upsert_online(snap(spark, [7]), root, "v", ["driver_id"], ("s", 0)) == 3
    assert store.write_online(snap(spark, [1]), root, "v") == 4
    assert [r["driver_id"] for r in store.read_online(spark, root, "v").collect()] == ["d1"]
    assert store.last_commit(spark, f"{root}/v", "s") == 0


class Stop(Exception):
    pass


@pytest.mark.parametrize("where", ["staged", "half moved", "moved", "offline only"])
def test_an_interrupted_push_shows_each_row_once(spark, tmp_dir, monkeypatch, where):
    rows = spark.createDataFrame(
        [(f"e{i}", f"d{i}", T0 + dt.timedelta(days=i), 5.0, 1.0, "idle", 0.5, 9.0) for i in range(4)],
        "event_id string, driver_id string, event_ts timestamp_ntz, lat double, lon double, status string, "
        "accept_rate_7d double, avg_response_ms double")
    off, on = f"{tmp_dir}/off", f"{tmp_dir}/on"

    def push(n, part):
        store.push_features(part, off, on, [DRIVER_AGG], ["driver_id"], commit=("p", n))

    push(0, rows.where("event_id = 'e0'"))
    with monkeypatch.context() as m:
        def stop(*_, **__):
            raise Stop
        real = store._files
        if where == "staged":
            m.setattr(store, "_publish_staged", stop)
        elif where == "half moved":
            def some(log, folder):
                files, done = real(log, folder)
                return ([*files[:1], None], done) if len(files) > 1 and done else (files, done)
            m.setattr(store, "_files", some)
        elif where == "moved":
            m.setattr(ManifestLog, "publish", stop)
        else:
            m.setattr(store, "upsert_online", stop)
        with pytest.raises((Stop, AttributeError)):
            push(1, rows.where("event_id <> 'e0'"))
    for _ in range(2):
        push(1, rows.where("event_id <> 'e0'"))
    got = src.read_offline_events(spark, off, ["driver_id"], T0, T0 + dt.timedelta(days=9))
    assert sorted(r["driver_id"] for r in got.collect()) == ["d0", "d1", "d2", "d3"]
    assert spark.read.parquet(off).count() == 4
    assert store.read_online(spark, on, "driver_agg").count() == 4
    log = ManifestLog(spark, off)
    assert not log.fs.exists(log.path(f"{off}/_staged/p-1")) and log.latest().marks == {"p": 1}
