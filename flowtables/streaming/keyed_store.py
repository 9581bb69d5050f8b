"""Keyed table kept by a stream: hash-bucketed base and delta runs under a manifest.

A micro-batch adds a run with the last change per key, in files by bucket of
the key. A fold merges base and runs of the buckets that runs have touched and
leaves the other buckets where they are; a manifest names the base version of every
bucket and the last run that is in it. So a batch costs what it brings, a fold what
was touched, and a lookup reads the buckets of the keys it asks for.

Folders below ``<root>/buckets=<n>``: ``runs/batch=<id>/bucket=<k>``, ``base/batch=<version>/bucket=<k>``
and ``manifest/batch=<version>`` (one row per bucket). All are overwritten on repeat.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from flowtables.operators.snapshot import KEYS, is_delete
from flowtables.streaming.versions import batch_path, complete_batches, remove_batches

_MANIFEST = "bucket int, version long, upto long"


@dataclass(frozen=True)
class Store:
    """Where a keyed table is and how its changes are told apart.

    ``schema`` is that of the changes. Of a key's changes the greatest in ``order`` counts, then the
    one of the later batch; changes alike in both are decided by a hash, the same way each time. Parts of keys may be null.
    ``op`` says which change deletes; any other, null too, sets the row. A column of ``schema`` may
    not be called ``bucket`` or begin with an underscore. A bucket is written by ``parts`` tasks.

    Deleted keys stay as marks, so that a late change does not bring them back, until
    a fold is told up to where the stream is settled.
    """

    root: str
    schema: StructType
    keys: Sequence[str] = KEYS
    order: Sequence[str] = ("seq",)
    op: str | None = "operation"
    buckets: int = 64
    parts: int = 1

    def __post_init__(self):
        taken = [n for n in self.schema.names if n.lower() == "bucket" or n.startswith("_")]
        if taken:
            raise ValueError(f"names kept for the store: {taken}")

    def folder(self, kind: str) -> str:
        return f"{self.root}/buckets={self.buckets}/{kind}"

    @property
    def stored_schema(self) -> StructType:
        own = [StructField("_batch", LongType()), StructField("_gone", BooleanType()), StructField("bucket", IntegerType())]
        return StructType([*self.schema.fields, *own])

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def last(self, rows: DataFrame, *clustered: str) -> DataFrame:
        """The row of each key that counts. ``clustered``: columns the keys decide and by which the rows are already dealt."""
        ranks = [F.col(c).desc_nulls_last() for c in (*self.order, "_batch")]
        w = Window.partitionBy(*clustered, *self.keys).orderBy(*ranks, F.xxhash64(*self.schema.names))
        return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")

    def _spread(self, rows: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64(F.lit(7), *self.keys), F.lit(self.parts)).cast("int")
        return rows.withColumn("_part", part).repartition("bucket", "_part")


def _write(rows: DataFrame, root: str, batch_id: int) -> None:
    rows.drop("_part").write.mode("overwrite").partitionBy("bucket").parquet(batch_path(root, batch_id))


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in (found or []))


def _number(path: str, name: str) -> int:
    return int(path.split(f"/{name}=")[-1].split("/")[0])


def write_run(store: Store, changes: DataFrame, batch_id: int) -> None:
    """Add the changes of one batch: one row per key, by bucket. A hot key sends one row per task."""
    spark = changes.sparkSession
    others = [p for p in _folders(spark, f"{store.root}/buckets=*") if _number(p, "buckets") != store.buckets]
    if others:
        raise ValueError(f"the store is kept in another number of buckets: {others}")
    gone = F.coalesce(is_delete(store.op), F.lit(False)) if store.op else F.lit(False)
    own = {"_batch": F.lit(batch_id).cast("long"), "_gone": gone, "bucket": store.bucket_of()}
    _write(store._spread(store.last(changes.select(*store.schema.names).withColumns(own))), store.folder("runs"), batch_id)


def start_store(store: Store, changes: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return (
        changes.writeStream.foreachBatch(lambda rows, batch_id: write_run(store, rows, batch_id))
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def _manifest(spark: SparkSession, store: Store, version: int | None = None) -> dict[int, tuple[int, int]]:
    """Bucket to (base version, last run in it); no more rows than buckets."""
    versions = complete_batches(spark, store.folder("manifest"))
    if not versions:
        return {}
    path = batch_path(store.folder("manifest"), versions[-1] if version is None else version)
    return {r["bucket"]: (r["version"], r["upto"]) for r in spark.read.schema(_MANIFEST).parquet(path).collect()}


def _open_runs(spark: SparkSession, store: Store, held: dict, before: int | None = None) -> dict[int, list[tuple[int, str]]]:
    """Bucket to (batch, folder) of the runs that its base lacks."""
    batches = [b for b in complete_batches(spark, store.folder("runs")) if before is None or b < before]
    out: dict[int, list[tuple[int, str]]] = {}
    least = min((held.get(k, (-1, -1))[1] for k in range(store.buckets)), default=-1)
    for batch in (b for b in batches if b > least):
        for path in _folders(spark, f"{batch_path(store.folder('runs'), batch)}/bucket=*"):
            bucket = _number(path, "bucket")
            if batch > held.get(bucket, (-1, -1))[1]:
                out.setdefault(bucket, []).append((batch, path))
    return out


def _read(spark: SparkSession, store: Store, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], store.stored_schema)
    stored = StructType([f for f in store.stored_schema if f.name != "bucket"])
    # the folder's number is read off the keys again: paths of several batches have no common base
    return spark.read.schema(stored).parquet(*paths).withColumn("bucket", store.bucket_of())


def _rows(spark: SparkSession, store: Store, held: dict, runs: dict, buckets: list[int] | None = None) -> DataFrame:
    wanted = set(range(store.buckets)) if buckets is None else set(buckets)
    base = [f"{batch_path(store.folder('base'), v)}/bucket={k}" for k, (v, _) in sorted(held.items()) if k in wanted and v >= 0]
    later = [p for k in sorted(wanted & set(runs)) for _, p in runs[k]]
    return _read(spark, store, [*base, *later])


def read_store(spark: SparkSession, store: Store, before: int | None = None) -> DataFrame:
    """Current rows, in the columns of the schema. ``before``: without the runs of that batch and later ones, unless a fold took them."""
    held = _manifest(spark, store)
    rows = _rows(spark, store, held, _open_runs(spark, store, held, before))
    return store.last(rows).where("not _gone").select(*store.schema.names)


def lookup(store: Store, wanted: DataFrame, before: int | None = None) -> DataFrame:
    """Current rows of the keys in ``wanted``; reads their buckets only. Null parts of keys are equal to nulls."""
    spark = wanted.sparkSession
    held = _manifest(spark, store)
    asked = wanted.select(*store.keys).distinct()
    buckets = [r[0] for r in asked.select(store.bucket_of().alias("bucket")).distinct().collect()]  # no more than there are
    rows = _rows(spark, store, held, _open_runs(spark, store, held, before), buckets).alias("r")
    same = F.lit(True)
    for k in store.keys:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"a.{k}"))
    return store.last(rows.join(asked.alias("a"), same, "left_semi")).where("not _gone").select(*store.schema.names)


def fold(spark: SparkSession, store: Store, settled=None, whole: bool = False, expired: Column | None = None) -> list[int]:
    """Merge the touched buckets into a new base version; returns the buckets it wrote.

    The newest run stays out unless ``whole``, so a batch that a restart repeats still
    finds the table as it was before it: take ``whole`` only when the stream has ended. ``settled`` is a value of the
    first ``order`` column: marks of deleted keys at or below it are dropped, as
    no change that low will come. Rows for which ``expired`` holds are dropped, for
    which all buckets are written. The manifest is written last, so readers see the old base or the new one.
    """
    held = _manifest(spark, store)
    batches = complete_batches(spark, store.folder("runs"))
    if not batches or (len(batches) < 2 and not whole):
        return []
    upto = batches[-1] if whole else batches[-2]
    runs = _open_runs(spark, store, held, before=upto + 1)
    touched = sorted(runs if expired is None else {*runs, *(k for k, (v, _) in held.items() if v >= 0)})
    if not touched:
        return []
    version = max([*complete_batches(spark, store.folder("manifest")), -1]) + 1
    rows = store._spread(_rows(spark, store, held, runs, touched))
    kept = store.last(rows, "bucket", "_part")  # dealt by bucket already: no second shuffle
    if settled is not None:
        kept = kept.where(~(F.col("_gone") & F.coalesce(F.col(store.order[0]) <= F.lit(settled), F.lit(True))))
    if expired is not None:
        kept = kept.where(~F.coalesce(expired, F.lit(False)))
    _write(kept, store.folder("base"), version)
    there = {_number(p, "bucket") for p in _folders(spark, f"{batch_path(store.folder('base'), version)}/bucket=*")}
    held |= {k: (version if k in there else -1, upto) for k in touched}  # -1: all its rows are gone
    rows = [(k, v, max(u, upto)) for k, (v, u) in ((k, held.get(k, (-1, -1))) for k in range(store.buckets))]
    listed = spark.createDataFrame(rows, _MANIFEST).coalesce(1)
    listed.write.mode("overwrite").parquet(batch_path(store.folder("manifest"), version))
    return touched


def clean(spark: SparkSession, store: Store, keep: int = 1) -> None:
    """Remove runs, base buckets and manifests that none of the newest ``keep`` versions needs.

    For readers still at an older version keep as many as they may lag behind.
    """
    versions = complete_batches(spark, store.folder("manifest"))
    if not versions:
        return
    live = versions[-max(1, keep):]
    manifests = [_manifest(spark, store, v) for v in live]
    remove_batches(spark, store.folder("manifest"), [v for v in versions if v not in live])
    needed = {(v, k) for m in manifests for k, (v, _) in m.items()}
    for version in complete_batches(spark, store.folder("base")):
        paths = _folders(spark, f"{batch_path(store.folder('base'), version)}/bucket=*")
        unused = [p for p in paths if (version, _number(p, "bucket")) not in needed]
        if len(unused) == len(paths) and version < live[0]:
            remove_batches(spark, store.folder("base"), [version])
            continue
        for p in unused if version <= live[-1] else []:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    folded = min(u for m in manifests for _, u in m.values())
    remove_batches(spark, store.folder("runs"), [b for b in complete_batches(spark, store.folder("runs")) if b <= folded])


def tidy(spark: SparkSession, store: Store, batch_id: int, every: int) -> None:
    """Fold and clean after each ``every`` batches; for the end of a batch."""
    if batch_id % every == every - 1:
        fold(spark, store)
        clean(spark, store)
