"""Versions of a keyed table: what readers see while it is written and folded."""

from __future__ import annotations

import os

import pytest

from aerolap.streaming import upsert as U


def batch(spark, rows):
    return spark.createDataFrame(rows, "key string, v int")


def table(spark, out, pinned=None):
    return {r.key: r.v for r in U.latest_per_key(spark, out, ["key"], pinned=pinned).collect()}


def write(spark, out, batch_id, rows, **kw):
    U.batch_writer(out, lambda df, _: df, **kw)(batch(spark, rows), batch_id)


def test_a_half_written_batch_is_not_seen(spark, tmp_dir):
    out = f"{tmp_dir}/t"
    write(spark, out, 0, [("a", 1), ("b", 1)])
    seen = []

    def build(df, _):
        # as a task that fails after some files: rows in the folder, no commit
        df.write.mode("overwrite").parquet(f"{out}/batch_id=1")
        os.remove(f"{out}/batch_id=1/_SUCCESS")
        seen.append((table(spark, out), U.newest_batch(spark, out).count(), U.read_batches(spark, out).count()))
        raise OSError("lost")

    with pytest.raises(OSError):
        U.batch_writer(out, build)(batch(spark, [("a", 2)]), 1)
    assert seen == [({"a": 1, "b": 1}, 2, 2)] and table(spark, out) == {"a": 1, "b": 1}
    write(spark, out, 1, [("a", 3)])                             # written again, whole
    assert table(spark, out) == {"a": 3, "b": 1}


def test_a_pinned_version_outlives_a_fold(spark, tmp_dir):
    out = f"{tmp_dir}/t"
    for n in range(4):
        write(spark, out, n, [("a", n), (f"k{n}", n)])
    pinned = U.version(spark, out)
    lazy = U.latest_per_key(spark, out, ["key"], pinned=pinned)
    before = table(spark, out)
    assert U.fold_batches(spark, out, ["key"], retain_s=3600) == 2
    write(spark, out, 4, [("a", 9)])
    assert {r.key: r.v for r in lazy.collect()} == before == table(spark, out, pinned)
    assert table(spark, out) == before | {"a": 9}
    U.remove_retired(spark, out, retain_s=3600)                  # too young
    assert table(spark, out, pinned) == before
    U.remove_retired(spark, out, retain_s=0)
    assert sorted(f for f in os.listdir(out) if f.startswith("batch_id=")) == ["batch_id=3", "batch_id=4"]
    assert table(spark, out) == before | {"a": 9}


def test_a_fold_that_dies_before_its_commit_changes_nothing(spark, tmp_dir, monkeypatch):
    out = f"{tmp_dir}/t"
    for n in range(3):
        write(spark, out, n, [("a", n)])
    with monkeypatch.context() as m:
        m.setattr(U, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            U.fold_batches(spark, out, ["key"])
    assert table(spark, out) == {"a": 2} and U.version(spark, out)["snapshot"] is None
    assert U.fold_batches(spark, out, ["key"]) == 1 and table(spark, out) == {"a": 2}


def test_folding_runs_by_itself(spark, tmp_dir):
    out, sizes = f"{tmp_dir}/t", []
    for n in range(12):
        write(spark, out, n, [("a", n), (f"k{n % 3}", n)], keys=["key"], fold_every=3, retain_s=0)
        sizes.append(len(U.version(spark, out)["batches"]))
    assert max(sizes) <= 3 and U.version(spark, out)["snapshot"]["upto"] >= 8
    assert table(spark, out) == {"a": 11, "k0": 9, "k1": 10, "k2": 11}
    assert len(os.listdir(f"{out}/_snapshot")) == 1


def test_batches_in_the_table_belong_to_one_query(spark, tmp_dir, monkeypatch):
    out = f"{tmp_dir}/t"
    sc = spark.sparkContext
    sc.setLocalProperty("sql.streaming.queryId", "one")
    try:
        write(spark, out, 0, [("a", 1)])
        write(spark, out, 0, [("a", 2)])                         # a replay: already published
        assert table(spark, out) == {"a": 1}
        sc.setLocalProperty("sql.streaming.queryId", "two")
        with pytest.raises(ValueError, match="another query"):
            write(spark, out, 0, [("a", 3)])
    finally:
        sc.setLocalProperty("sql.streaming.queryId", None)
