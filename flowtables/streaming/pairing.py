"""Row changes from a streamed change table: images of one update that come in different batches are paired."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from flowtables.operators.row_changes import BEFORE_IMAGE, row_changes
from flowtables.streaming.keyed_store import Store, lookup, tidy, write_run
from flowtables.streaming.versions import write_batch

PAIR = ("start_lsn", "seqval")
AFTER_IMAGE = 4


def waiting_images(images: StructType, state: str, buckets: int = 64) -> Store:
    """Store of before images whose after images have not come; ``images`` is the schema of the change table."""
    pair = [images[c] for c in PAIR]
    row = StructField("row", images)
    return Store(state, StructType([*pair, row, StructField("state", StringType())]), keys=PAIR, order=("start_lsn",), op="state", buckets=buckets)


def start_row_changes(
    images: DataFrame, out: str, state: str, checkpoint: str, data_columns: Sequence[tuple[str, str]],
    key_columns: Sequence[str], schema: str, table: str, buckets: int = 64, fold_every: int = 20, trigger: dict | None = None, **options,
) -> StreamingQuery:
    """As ``row_changes``, per batch into ``out/batch=<id>``.

    A before image (or several alike, which count as one) waits in a store below ``state`` until its after image comes, in its batch or any later one;
    a batch reads only the buckets of after images that lack theirs. An after image is released in its
    own batch, with a null ``before`` if no before image has come up to then. Images that wait in vain are
    dropped by ``fold`` with ``expired``, for example below a start LSN.
    """
    store = waiting_images(images.schema, state, buckets)

    def step(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        new = rows.persist()
        before, after = new.where(F.col("operation") == BEFORE_IMAGE), new.where(F.col("operation") == AFTER_IMAGE).select(*PAIR)
        try:
            old = lookup(store, after.join(before.select(*PAIR), list(PAIR), "left_anti"), before=batch_id).persist()
            found = row_changes(new.unionByName(old.select("row.*")), data_columns, key_columns, schema, table, **options)
            write_batch(found, out, batch_id)
            left = before.select(*PAIR, F.struct(*before.columns).alias("row")).join(after, list(PAIR), "left_anti")
            done = old.select(*PAIR, F.lit(None).cast(store.schema["row"].dataType).alias("row"), F.lit("delete").alias("state"))
            write_run(store, left.withColumn("state", F.lit("insert")).unionByName(done), batch_id)
            tidy(spark, store, batch_id, fold_every)
            old.unpersist()
        finally:
            new.unpersist()

    return (
        images.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
