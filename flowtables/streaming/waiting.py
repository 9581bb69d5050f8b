"""Commit gate on a stream whose cost follows each batch, not what is open.

Undecided changes are written once, in the batch that brings them, to hash buckets of
their transaction id; what decides them is written as a delta beside them. A commit
reads back only the buckets of the transactions that end in its batch. So a transaction that
stays open costs nothing until it ends, however large it is. ``fold`` drops what
has been decided.

Folders below ``waiting``: ``rows/batch=<id>/bucket=<k>``, ``decided/batch=<id>`` and, after a fold,
``base/batch=<id>/bucket=<k>``. All are written by batch id and overwritten on repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from flowtables.operators.gate import decide
from flowtables.sources.changelog import COMMIT_CODE, ROLLBACK_CODE
from flowtables.streaming.versions import batch_path, complete_batches, read_batches, remove_batches, write_batch

BUCKETS = 16
PARTS = 4  # a bucket is written by so many tasks, a large transaction too


def _ends() -> Column:
    return F.col("operation_code").isin(COMMIT_CODE, ROLLBACK_CODE)


def _write_rows(rows: DataFrame, root: str, batch_id: int, pos: str) -> None:
    spread = rows.repartition("bucket", F.pmod(F.xxhash64(pos), F.lit(PARTS)))
    spread.write.mode("overwrite").partitionBy("bucket").parquet(batch_path(root, batch_id))


def undecided(spark: SparkSession, waiting: str, schema: StructType, before: int | None = None, xid: str = "xid", pos: str = "scn", only: DataFrame | None = None) -> DataFrame:
    """Changes of batches below ``before`` (all) that no later row has decided, with their ``bucket``; ``only``: those of its ``xid``."""
    live = lambda kind, above: [b for b in complete_batches(spark, f"{waiting}/{kind}") if b > above and (before is None or b < before)]
    base = live("base", -1)[-1:]
    above = base[0] if base else -1
    full = schema.names + ["bucket"]
    wanted = StructType([*schema.fields, StructField("bucket", IntegerType())])
    rows = read_batches(spark, f"{waiting}/base", base, wanted).select(*full).unionByName(read_batches(spark, f"{waiting}/rows", live("rows", above), wanted).select(*full))
    if only is not None:
        buckets = [r["bucket"] for r in only.select("bucket").distinct().collect()]  # no more than there are buckets
        rows = rows.where(F.col("bucket").isin(buckets)).alias("r").join(only.alias("o"), F.col(f"r.{xid}").eqNullSafe(F.col(f"o.{xid}")), "left_semi")
    kinds = StructType([StructField("of", schema[xid].dataType), StructField("upto", schema[pos].dataType)])
    decided = read_batches(spark, f"{waiting}/decided", live("decided", above), kinds).groupBy("of").agg(F.max("upto").alias("upto"))
    return rows.alias("r").join(decided.alias("d"), F.col(f"r.{xid}").eqNullSafe(F.col("d.of")) & (F.col(f"r.{pos}") <= F.col("d.upto")), "left_anti")


def start_committed_deltas(
    stream: DataFrame, out: str, waiting: str, checkpoint: str, trigger: dict | None = None,
    xid: str = "xid", pos: str = "scn", buckets: int = BUCKETS, **options,
) -> StreamingQuery:
    """Release committed changes batch by batch into ``out/batch=<id>``; the log arrives in order of ``pos``.

    Of the columns that are added, ``commit_scn`` is released. Options are those of :func:`decide`.
    """
    schema = stream.schema

    def step(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        new = rows.withColumn("bucket", F.pmod(F.xxhash64(xid), F.lit(buckets)).cast("int")).persist()
        ends = new.where(_ends())
        closing = ends.select(xid, "bucket").distinct()
        old = undecided(spark, waiting, schema, batch_id, xid, pos, only=closing)
        marked = old.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
        decided = decide(marked, xid=xid, pos=pos, **options).where(~_ends()).persist()
        try:
            released = decided.where(F.col("decision.code") == COMMIT_CODE).withColumn("commit_scn", F.col("decision.scn"))
            write_batch(released.drop("decision", "_new", "bucket"), out, batch_id)
            write_batch(ends.groupBy(F.col(xid).alias("of")).agg(F.max(pos).alias("upto")), f"{waiting}/decided", batch_id)
            _write_rows(decided.where(F.col("decision").isNull() & F.col("_new")).drop("decision", "_new"), f"{waiting}/rows", batch_id, pos)
        finally:
            decided.unpersist()
            new.unpersist()

    return (
        stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def fold(spark: SparkSession, waiting: str, schema: StructType, xid: str = "xid", pos: str = "scn") -> int | None:
    """Keep only undecided changes, as a new base; removes what that replaces and returns its batch id.

    Call it between runs of the stream. After a failure on the way run it again: the old parts go once the base is complete.
    """
    done = complete_batches(spark, f"{waiting}/rows")
    bases = complete_batches(spark, f"{waiting}/base")
    upto = max([*done[-1:], *bases[-1:]], default=None)
    if upto is None:
        return None
    if upto not in bases:
        _write_rows(undecided(spark, waiting, schema, xid=xid, pos=pos), f"{waiting}/base", upto, pos)
    remove_batches(spark, f"{waiting}/rows", [b for b in done if b <= upto])
    remove_batches(spark, f"{waiting}/decided", [b for b in complete_batches(spark, f"{waiting}/decided") if b <= upto])
    remove_batches(spark, f"{waiting}/base", [b for b in bases if b < upto])
    return upto
