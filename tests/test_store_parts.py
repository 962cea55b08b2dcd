"""Parts of the record store's buckets: small batches stay apart, large or many ones are merged."""

from pyspark.sql import functions as F
from tests.test_stores import files, found, stubs

from profileloom.sources import record_store


def numbered(spark, names, city):
    """Stubs that bring their places."""
    return stubs(spark, names, city).withColumn("ord", F.substring("university_name", 2, 9).cast("bigint"))


def test_a_small_batch_leaves_full_buckets_alone(spark, tmp_path):
    root, names = str(tmp_path / "store"), [f"U{i:03d}" for i in range(400)]
    record_store.put_records(numbered(spark, names, "one"), root, buckets=2)
    before = files(root)
    record_store.put_records(stubs(spark, names[::50], "two"), root)
    written = [f for f in files(root) if f not in before]
    assert set(before) <= set(files(root)) and spark.read.parquet(*written).count() == 8
    assert found(spark, root) == {n: (i, "one" if i % 50 else "two") for i, n in enumerate(names)}
    own = record_store.lookup_entity(spark, root, "u050").collect()
    assert [(r.ord, r.data.about.location.city) for r in own] == [(50, "two")]
    record_store.put_records(stubs(spark, names[::2], "three"), root)  # half of all: merged
    assert found(spark, root) == {n: (i, "one" if i % 2 else "three") for i, n in enumerate(names)}
    assert {len(parts) for parts in record_store._manifest(spark, root).values()} == {1}
    record_store.drop_old_versions(spark, root)
    assert found(spark, root) == {n: (i, "one" if i % 2 else "three") for i, n in enumerate(names)}


def test_many_batches_keep_the_newest_of_a_name(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(record_store, "MAX_PARTS", 3)
    monkeypatch.setattr(record_store, "BROADCAST_NAMES", 1)
    root, names = str(tmp_path / "store"), [f"U{i:03d}" for i in range(100)]
    record_store.put_records(numbered(spark, names, "0"), root, buckets=1)
    expected = {n: (i, "0") for i, n in enumerate(names)}
    parts = []
    for batch in range(1, 5):
        changed = [names[7], names[10 + batch]]
        record_store.put_records(stubs(spark, changed, str(batch)), root)
        expected |= {n: (expected[n][0], str(batch)) for n in changed}
        assert found(spark, root) == expected
        parts.append(len(record_store._manifest(spark, root)[0]))
    assert parts == [2, 3, 1, 2]
    assert record_store.lookup_field(spark, root, "U007", "about").count() == 1


def test_a_first_load_is_written_once(spark, tmp_path, monkeypatch):
    paths, write = [], record_store._write_parts
    monkeypatch.setattr(record_store, "_write_parts", lambda rows, path: (paths.append(path), write(rows, path)))
    root = str(tmp_path / "store")
    record_store.put_records(numbered(spark, ["U1", "U2"], "one"), root)
    assert [path.split("/")[-2] for path in paths] == ["staged"] and files(root)
    assert record_store.lookup_field(spark, root, "u2", "about").count() == 1


def test_small_tasks_write_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(record_store, "MOST_FILES", 2)
    root, names = str(tmp_path / "store"), [f"U{i:03d}" for i in range(200)]
    tasks = 4 * spark.sparkContext.defaultParallelism
    record_store.put_records(numbered(spark, names, "one").repartition(tasks), root, buckets=1)
    assert len(files(root)) <= tasks / 4
    assert found(spark, root) == {n: (i, "one") for i, n in enumerate(names)}
