"""Incremental ingest: a stream's rows put into a keyed table, batch by batch, so that a restart loses and repeats nothing.

The table is dealt into buckets by key. A batch rewrites the buckets that it touches, as new folders, and then writes a list of the folders
that make up the table: that list is the commit. A batch that was committed is passed over when it comes again, one that wasn't is done
again from the table before it. Rows later than the watermark go to a table of their own.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _names(spark: SparkSession, path: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


class Store:
    """A keyed table at path: keys tell rows apart, of rows of a key the last by order stays (the given one, where orders are equal, over the stored one)."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.order, self.buckets = spark, path.rstrip("/"), keys, order, buckets

    def commits(self) -> list[int]:
        """Numbers of the batches whose lists are whole."""
        folder = f"{self.path}/commits"
        return sorted(int(n) for n in _names(self.spark, folder) if n.isdigit() and _exists(self.spark, f"{folder}/{n}/_SUCCESS"))

    def state(self) -> dict:
        """The last commit: batch, folders by bucket, newest time, schema."""
        known = self.commits()
        if not known:
            return {"batch": -1, "folders": {}, "newest": None, "schema": None}
        return json.loads(self.spark.read.text(f"{self.path}/commits/{known[-1]:012d}").first()[0])

    def rows(self, state: dict | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """The table, or some buckets of it; None before the first commit."""
        state = self.state() if state is None else state
        if state["schema"] is None:
            return None
        chosen = [f for b, f in state["folders"].items() if buckets is None or int(b) in buckets]
        reader = self.spark.read.schema(state["schema"])
        return reader.parquet(*chosen) if chosen else self.spark.createDataFrame([], state["schema"])

    def late(self) -> DataFrame | None:
        names = [n for n in _names(self.spark, f"{self.path}/late")]
        return self.spark.read.parquet(*(f"{self.path}/late/{n}" for n in names)) if names else None

    def apply(self, batch: DataFrame, number: int, time: str | None = None, delay: int = 0) -> bool:
        """Put a batch into the table, unless it is there; time, delay: rows whose time (in seconds) is delay or more before the newest of earlier batches are late. Whether it was put in."""
        state = self.state()
        if number <= state["batch"]:
            return False
        newest = state["newest"]
        if time is not None:
            seconds = F.unix_timestamp(time)
            if newest is not None:
                due = F.coalesce(seconds >= newest - delay, F.lit(True))
                batch.where(~due).write.mode("overwrite").parquet(f"{self.path}/late/{number:012d}")
                on_time = batch.where(due)
            else:
                on_time = batch
            last = batch.agg(F.max(seconds)).first()[0]
            newest = last if newest is None else max(newest, last or newest)
        else:
            on_time = batch
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))
        rows = on_time.withColumn("_bucket", bucket)
        touched = [r[0] for r in rows.select("_bucket").distinct().collect()]  # as many as there are buckets, at most
        if touched:
            rows = rows.withColumn("_given", F.lit(1))
            old = self.rows(state, touched)
            if old is not None:
                rows = rows.unionByName(old.withColumn("_bucket", bucket).withColumn("_given", F.lit(0)))
            best = Window.partitionBy("_bucket", *self.keys).orderBy(*(F.col(c).desc_nulls_last() for c in self.order), F.desc("_given"), F.xxhash64(*batch.columns))
            kept = rows.withColumn("_nth", F.row_number().over(best)).where("_nth = 1").select(*batch.columns, "_bucket")
            folder = f"{self.path}/data/{number:012d}-{uuid.uuid4().hex}"
            kept.write.partitionBy("_bucket").parquet(folder)
            state["folders"] |= {str(b): f"{folder}/_bucket={b}" for b in touched}
        state |= {"batch": number, "newest": newest, "schema": state["schema"] or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema)}
        self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/commits/{number:012d}")
        return True


def upserted(stream: DataFrame, store: Store, checkpoint: str, time: str | None = None, delay: int = 0):
    """Put what has come so far into the store and stop; a restart with the same checkpoint goes on from there, and does a batch again that wasn't committed."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, number: store.apply(batch, number, time, delay) and None).trigger(availableNow=True).start()
