"""The keyed table of the streams: restarts, replays, lost batches, many batches, removals, versions."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.streaming import store
from sluice.streaming.store import KeyedTable, stream_name

SCHEMA = "k long, v string"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "table"), SCHEMA, ["k"])


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def held(t, **how):
    return dict(map(tuple, t.state(**how).collect()))


def test_replay_restart_and_fresh_checkpoint(spark, table):
    put = lambda stream, batch, *pairs: sorted(map(tuple, table.put(rows(spark, *pairs), stream, batch).collect()))
    assert put("a", 0, (1, "x"), (2, "y")) == [(1, "x"), (2, "y")]
    assert put("a", 0, (1, "other")) == [(1, "x"), (2, "y")]  # the batch was committed: what comes again changes nothing
    assert put("b", 0, (3, "z")) == [(3, "z")]  # a new stream starts at batch 0 and loses nothing
    assert put("a", 1, (2, "new")) == [(2, "new")] and put("a", 2) == []
    assert held(table) == {1: "x", 2: "new", 3: "z"}
    assert put("a", 2, (9, "x")) == [] and held(table) == {1: "x", 2: "new", 3: "z"}


def test_a_batch_lost_before_its_manifest_leaves_nothing(spark, table, monkeypatch):
    table.put(rows(spark, (1, "x")), "a", 0)
    monkeypatch.setattr(table, "_commit", lambda m: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.put(rows(spark, (1, "half"), (2, "half")), "a", 1)
    monkeypatch.undo()
    assert held(table) == {1: "x"}
    table.put(rows(spark, (2, "y")), "a", 1)
    assert held(table) == {1: "x", 2: "y"}


def test_two_writers_cannot_commit_one_version(spark, table):
    table.put(rows(spark, (1, "x")), "a", 0)
    with pytest.raises(RuntimeError):
        table._commit(table.manifest())


def test_many_batches_against_a_dictionary(spark, table, monkeypatch):
    monkeypatch.setattr(store, "FAN", 4)
    rng, model, written = random.Random(1), {}, 0
    for batch in range(100):
        keys = rng.sample(range(60), 3)
        gone = [k for k in keys[:1] if k in model]
        put = [(k, f"{batch}.{k}") for k in keys if k not in gone]
        table.put(rows(spark, *put), "s", batch, removed=rows(spark, *((k, None) for k in gone)) if gone else None)
        model |= dict(put)
        for k in gone:
            del model[k]
        written += len(put) + len(gone)
        if batch % 45 == 0:
            assert held(table) == model
            near = rows(spark, *((k, None) for k in keys))
            some = held(table, near=near)
            assert {k: v for k, v in model.items() if k in keys}.items() <= some.items() <= model.items()
            version = table.manifest()["version"]
            assert held(table, version=version) == model
    m = table.manifest()
    assert held(table) == model
    assert len(m["runs"]) <= 4 * 4  # three or four sizes of run, at most FAN of each
    files = table.files.names(f"{table.path}/runs")
    assert len(files) <= 3 * 4 * 4 and len([n for n in table.files.names(f"{table.path}/manifests") if n.endswith(".json")]) <= store.KEPT_VERSIONS + 2
    with pytest.raises(ValueError):
        table.state(version=1)


def test_a_batch_reads_the_folders_of_its_keys(spark, table):
    table.put(spark.range(2000).select(F.col("id").alias("k"), F.lit("v").alias("v")), "s", 0)
    near = rows(spark, (5, None))
    plan = table.state(near)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert 0 < table.state(near).count() < 400 and held(table, near=near)[5] == "v"


def test_names_of_streams(spark, tmp_path):
    one = stream_name(spark, str(tmp_path / "cp"))
    assert stream_name(spark, str(tmp_path / "cp")) == one != stream_name(spark, str(tmp_path / "cp2"))


def test_null_keys_empty_tables_and_removals_at_the_oldest_run(spark, table, monkeypatch):
    monkeypatch.setattr(store, "FAN", 2)
    assert held(table) == {} and table.state(rows(spark, (1, None))).count() == 0
    table.put(rows(spark, (None, "n"), (1, "x")), "s", 0)
    table.put(rows(spark), "s", 1, removed=rows(spark, (None, None), (7, None)))
    assert held(table) == {1: "x"}
    assert table._rows(table.manifest()["runs"]).count() == 1  # merged, removals gone
