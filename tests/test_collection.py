"""Collections with a commit log: few files, each micro-batch once, whatever fails."""

import pytest

from precinct.plans import folders
from precinct.sinks.collection import Collection, Part


def files(tmp_path):
    return list(tmp_path.rglob("*.parquet"))


def rows(spark, batch_id, n=3):
    made = spark.range(batch_id * 10, batch_id * 10 + n, 1, 2)
    return made.withColumnRenamed("id", "x")


def ids(collection, spark):
    return sorted(r["x"] for r in collection.read(spark).select("x").collect())


def wanted(batches, n=3):
    return [b * 10 + i for b in batches for i in range(n)]


def test_many_batches_give_few_files(spark, tmp_path):
    target = Collection(str(tmp_path / "c"), "s", pack=8, kept=4)
    most = 0
    for batch_id in range(200):
        target.write(rows(spark, batch_id), batch_id)
        if batch_id % 20 == 0:
            target.write(rows(spark, batch_id), batch_id)
            most = max(most, len(files(tmp_path)))
    assert ids(target, spark) == wanted(range(200))
    parts = target.version(spark).parts
    # 200 = 3 * 64 + 1 * 8 + 0: packs of packs of batches.
    assert [(p.first, p.last, p.level) for p in parts] == [
        (0, 63, 2), (64, 127, 2), (128, 191, 2), (192, 199, 1)
    ]
    assert max(most, len(files(tmp_path))) < 100
    assert len(folders.names(spark, f"{tmp_path}/c/_log")) <= 4 + 4
    assert target.read(spark).filter("_session_id = 's' AND _inserted_at IS NOT NULL").count() == 600


def test_full_folders_are_left_alone(spark, tmp_path):
    target = Collection(str(tmp_path / "c"), "s", pack=2, full=1)
    for batch_id in range(8):
        target.write(rows(spark, batch_id), batch_id)
    assert [p.level for p in target.version(spark).parts] == [1] * 4
    assert ids(target, spark) == wanted(range(8))


@pytest.mark.parametrize("step", ["write_text", "remove", "move"])
def test_failures_lose_and_repeat_nothing(spark, tmp_path, monkeypatch, step):
    target = Collection(str(tmp_path / "c"), "s", pack=3, kept=2)
    real = getattr(folders, step)
    calls = []

    def breaks(*args):
        calls.append(args)
        if len(calls) % 3 == 0:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(folders, step, breaks)
    for batch_id in range(12):
        for _ in range(10):  # a stream repeats a batch until it went well
            try:
                target.write(rows(spark, batch_id), batch_id)
                break
            except RuntimeError:
                assert ids(target, spark) if target.version(spark).parts else True
    monkeypatch.setattr(folders, step, real)
    assert len(calls) > 6
    assert ids(target, spark) == wanted(range(12))


def test_a_second_writer_is_noticed(spark, tmp_path):
    """Another process packs, or commits the same batch, between our write and our commit."""
    mine = Collection(str(tmp_path / "c"), "s", pack=4)
    other = Collection(str(tmp_path / "c"), "s", pack=4)
    for batch_id in range(3):
        mine.write(rows(spark, batch_id), batch_id)
    before = mine.version(spark).parts
    own = mine._save(rows(spark, 3), "batch-000000000003")
    other.write(rows(spark, 3), 3)
    assert not mine._commit(spark, [], Part(own, 3, 3, 0))
    late = mine._save(rows(spark, 0), "pack-000000000000")
    assert not mine._commit(spark, before, Part(late, 0, 2, 1))
    assert ids(mine, spark) == wanted(range(4))
    assert {own, late}.isdisjoint(folders.names(spark, f"{tmp_path}/c/data"))


def test_readers_of_an_older_version_go_on(spark, tmp_path):
    target = Collection(str(tmp_path / "c"), "s", pack=2, kept=50)
    for batch_id in range(3):
        target.write(rows(spark, batch_id), batch_id)
    reader = target.read(spark).select("x")
    for batch_id in range(3, 9):
        target.write(rows(spark, batch_id), batch_id)
    assert sorted(r["x"] for r in reader.collect()) == wanted(range(3))
    assert ids(target, spark) == wanted(range(9))


def test_empty_collections_and_batches(spark, tmp_path):
    target = Collection(str(tmp_path / "c"), "s", pack=2)
    assert target.read(spark, rows(spark, 0).schema).count() == 0
    for batch_id in range(4):
        target.write(rows(spark, batch_id, 0), batch_id)
    assert ids(target, spark) == []
