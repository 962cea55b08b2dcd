"""A store of records that a batch changes without rewriting what it leaves alone.

Records lie in buckets by a hash of their lower-cased name. A bucket is a base part and the
parts of later batches; of a name the newest part counts. A batch is written once, and again
only if it repeats names, needs places or makes its bucket's later parts outgrow ``MERGE_SHARE``
of the base: then that bucket is merged into one part. A manifest says which parts count. A
reader follows the newest complete one, so it sees a batch whole or not at all, and a repeated
or broken batch is harmless. Files are sorted by name and carry a Parquet bloom filter, so that
a lookup reads one bucket's matching pages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profileloom.functions.joins import copied_if_few, shuffled
from profileloom.operators.incremental import last_per_key
from profileloom.operators.records import find_entity, find_field
from profileloom.schemas import RECORD_TYPE
from profileloom.sources.storage import delete_path, move_path, read_latest, versions, write_version

BUCKETS = 64
#: A bucket is merged when the rows of its later parts exceed this share of its base's, or
#: when it would have more parts than ``MAX_PARTS``.
MERGE_SHARE, MAX_PARTS = 0.2, 8
#: Up to so many names of later parts are broadcast to the readers of older ones.
BROADCAST_NAMES = 250_000
#: Names a file's bloom filter is made for; without it each filter takes 1 MB.
_BLOOM_NAMES = 5_000
#: Files a batch is written as at most, unless a cluster has more cores than that: each costs about
#: 30 ms besides its rows, so many small tasks are joined first.
MOST_FILES = 4_096
_MANIFEST = "bucket int, version bigint, buckets int, last_ord bigint, rows bigint"
_STORED = f"ord bigint, {', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in RECORD_TYPE.fields)}, name_key string"


def _key(name: Column) -> Column:
    return F.lower(name)


def _bucket(name: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(_key(name)), F.lit(buckets)).cast("int")


Manifest = dict[int, list[tuple]]


def _manifest(spark: SparkSession, root: str) -> Manifest:
    """The parts of every bucket by the newest manifest, oldest first: at most ``MAX_PARTS`` each."""
    out: Manifest = {}
    for row in sorted(read_latest(spark, f"{root}/manifest", _MANIFEST).collect(), key=lambda r: r["version"]):
        out.setdefault(row["bucket"], []).append(row)
    return out


def _read(spark: SparkSession, root: str, manifest: Manifest, only: set[int] | None = None) -> DataFrame:
    """Stored rows: those of a part whose name no later part of the bucket holds."""
    chosen = {b: parts for b, parts in manifest.items() if only is None or b in only}
    layers = []
    for level in range(max(map(len, chosen.values()), default=0)):
        at = {b: parts[level] for b, parts in chosen.items() if level < len(parts)}
        paths = [f"{root}/data/version={r['version']:08d}/bucket={b}" for b, r in at.items()]
        layers.append((spark.read.schema(_STORED).parquet(*paths), sum(r["rows"] or 0 for r in at.values())))
    if not layers:
        return spark.createDataFrame([], _STORED)
    rows, names, n = [layers[-1][0]], layers[-1][0].select("university_name"), layers[-1][1]
    for layer, size in reversed(layers[:-1]):
        later = copied_if_few(names, n, BROADCAST_NAMES)
        rows.append(layer.join(later, "university_name", "left_anti").select(*layer.columns))
        names, n = names.unionByName(layer.select("university_name")), n + size
    return reduce(DataFrame.unionByName, reversed(rows))


def _write_parts(rows: DataFrame, path: str) -> None:
    """Rows with their ``bucket``, each task's sorted by bucket and name."""
    writer = rows.sortWithinPartitions("bucket", "name_key").write.mode("overwrite").partitionBy("bucket")
    bloom = {"parquet.bloom.filter.enabled#name_key": "true", "parquet.bloom.filter.expected.ndv#name_key": _BLOOM_NAMES}
    # Tasks move their own files, not the driver all of them: nobody reads any before the manifest is there.
    commit = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
    writer.options(compression="zstd", **bloom, **commit).parquet(path)


def _few_tasks(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows in tasks that write ``MOST_FILES`` at most, if each has rows of all ``buckets``."""
    return rows.coalesce(max(MOST_FILES // buckets, rows.sparkSession.sparkContext.defaultParallelism))


def put_records(records: DataFrame, root: str, buckets: int = BUCKETS, version: int | None = None) -> int:
    """Puts a batch of ``records`` into the store and returns the version it made.

    Stored records of the same names are replaced and keep their place ``ord``; new names
    keep the ``ord`` they bring, and without one follow all others by name. Of rows with
    one name the last by ``ord`` counts, or else any one; rows without a name stay out.
    The work follows the batch: it is computed once and written as new parts of its buckets,
    of which only names and places are read unless a bucket is merged. ``buckets`` counts when
    the store is made. A ``version`` that is complete already is left alone.
    """
    spark = records.sparkSession
    known = versions(spark, f"{root}/manifest")
    if version is None:
        version = (known[-1] if known else 0) + 1
    if version in known:
        return version
    manifest = _manifest(spark, root)
    some = next(iter(manifest.values()), [None])[0]
    buckets, last = (some["buckets"], some["last_ord"]) if some else (buckets, -1)
    staged, data = f"{root}/staged/version={version:08d}", f"{root}/data/version={version:08d}"
    named = records.filter("university_name is not null")
    placed = named if "ord" in records.columns else named.withColumn("ord", F.lit(None).cast("bigint"))
    layout = placed.select("ord", *RECORD_TYPE.fieldNames(), _key(F.col("university_name")).alias("name_key"))
    layout = layout.withColumn("bucket", _bucket(F.col("university_name"), buckets))
    whole = not manifest and "ord" in records.columns
    if whole:  # written as parts at once: nothing is stored yet and places are there
        _write_parts(_few_tasks(layout, buckets), staged)
    else:
        layout.write.mode("overwrite").option("compression", "zstd").parquet(staged)
    if not _has_rows(spark, staged):
        delete_path(spark, staged)
        return known[-1] if known else write_version(spark.createDataFrame([], _MANIFEST), f"{root}/manifest", version)
    batch = spark.read.schema(f"{_STORED}, bucket int").parquet(staged)
    counts = batch.groupBy("bucket", "university_name").agg(
        F.count(F.lit(1)).alias("n"), F.count("ord").alias("n_ord"), F.max("ord").alias("last")
    )
    facts = counts.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("names"), F.sum("n").alias("rows"), F.sum("n_ord").alias("n_ord"), F.max("last").alias("last")
    ).collect()  # at most ``buckets``
    touched = {r["bucket"]: r["names"] for r in facts}
    old_parts = {b: manifest[b] for b in touched if b in manifest}
    merged = {b for b, parts in old_parts.items() if _to_merge(parts, touched[b])}
    if whole and all(r["names"] == r["rows"] == r["n_ord"] for r in facts):
        delete_path(spark, data)  # a broken batch's
        move_path(spark, staged, data)
        highest = max(r["last"] for r in facts)
    else:
        batch = last_per_key(batch, ["university_name"], ["ord"])
        places = _read(spark, root, old_parts).select("university_name", F.col("ord").alias("_place"))
        fresh = batch.join(shuffled(places), "university_name", "left").withColumn("ord", F.coalesce("_place", "ord")).drop("_place")
        behind = fresh.filter("ord is null").select("university_name").orderBy("university_name")
        behind = behind.select("university_name", (F.monotonically_increasing_id() + F.lit(last + 1)).alias("_behind"))
        fresh = fresh.join(shuffled(behind), "university_name", "left").withColumn("ord", F.coalesce("ord", "_behind")).drop("_behind")
        if merged:
            gone = copied_if_few(batch.select("university_name"), sum(touched.values()), BROADCAST_NAMES)
            stay = _read(spark, root, manifest, merged).join(gone, "university_name", "left_anti")
            fresh = stay.withColumn("bucket", _bucket(F.col("university_name"), buckets)).unionByName(fresh)
        _write_parts(_few_tasks(fresh, buckets), data)
        delete_path(spark, staged)
        highest = spark.read.schema("ord bigint").parquet(data).agg(F.max("ord")).first()[0]
    last = max(last, -1 if highest is None else highest)
    parts = [(b, r["version"], buckets, last, r["rows"]) for b, own in manifest.items() if b not in merged for r in own]
    # Rows bound how much a bucket holds: of replaced ones both count until the next merge.
    parts += [(b, version, buckets, last, touched[b] + (sum(r["rows"] or 0 for r in old_parts[b]) if b in merged else 0)) for b in sorted(touched)]
    write_version(spark.createDataFrame(parts, _MANIFEST).coalesce(1), f"{root}/manifest", version)
    return version


def _to_merge(parts: list[tuple], fresh: int) -> bool:
    """Whether a bucket is merged when a batch adds so many rows; one without counts always is."""
    if any(r["rows"] is None for r in parts):
        return True
    later = fresh + sum(r["rows"] for r in parts[1:])
    return later > MERGE_SHARE * parts[0]["rows"] or len(parts) >= MAX_PARTS


def _has_rows(spark: SparkSession, path: str) -> bool:
    return not spark.read.schema("university_name string").parquet(path).isEmpty()


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """All stored records with their places; none where there is no store."""
    return _read(spark, root, _manifest(spark, root)).drop("name_key")


def _bucket_of(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The stored records of a name, ignoring case: one bucket's row groups that may hold it."""
    manifest = _manifest(spark, root)
    some = next(iter(manifest.values()), [None])[0]
    if some is None:
        return _read(spark, root, manifest)
    own = spark.range(1).select(_bucket(F.lit(name), some["buckets"])).first()[0]
    return _read(spark, root, manifest, {own}).filter(F.col("name_key") == _key(F.lit(name)))


def lookup_entity(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Like ``find_entity``, from the store: reads one bucket, and of it what may match."""
    return find_entity(_bucket_of(spark, root, name), name).drop("name_key")


def lookup_field(spark: SparkSession, root: str, name: str, field: str) -> DataFrame:
    """Like ``find_field``, from the store: reads one bucket, and of it one field."""
    return find_field(_bucket_of(spark, root, name), name, field)


def drop_old_versions(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Deletes what none of the newest ``keep`` manifests needs; no reader of older ones may be left."""
    known = versions(spark, f"{root}/manifest")
    stay, go = known[-keep:], known[:-keep]
    needed = set()
    for number in stay:
        manifest = spark.read.schema(_MANIFEST).parquet(f"{root}/manifest/version={number:08d}")
        needed |= {(r["version"], r["bucket"]) for r in manifest.collect()}
    for number in known:
        if number in go:
            delete_path(spark, f"{root}/manifest/version={number:08d}")
        for bucket in range(BUCKETS if not needed else max(b for _, b in needed) + 1):
            if (number, bucket) not in needed:
                delete_path(spark, f"{root}/data/version={number:08d}/bucket={bucket}")
