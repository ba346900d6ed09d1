"""A keyed shuffle that is written once and read by many jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.binary import decode_integer, encode_integer
from tidelog.functions.headers import header
from tidelog.functions.partitioners import by_key
from tidelog.operators.small import checked_broadcast
from tidelog.sources import files
from tidelog.sources.topiclog import TopicLog

_RECORD_TIME = "record.timestamp"
#: A key is hot from this part of an even bucket on.
SHARE = 4
MARKS_DDL = "partition INT, producer INT, watermark TIMESTAMP, txn STRING"


def write_key_by(
    df: DataFrame, log: TopicLog, topic_uri: str, key: Column, value: Column, n: int, txn: str, order: list[str],
    record_time: Column | None = None, published: Column | None = None, producer: int = 0,
    watermark: Column | None = None,
) -> bool:
    """Write rows to partition `hash(key) mod n`. A row carries its own time when it has one.

    The watermark is written for every partition, next to the rows and under the same marker.
    """
    if log.is_committed(txn):
        return False
    spark = log.spark
    time = record_time if record_time is not None else F.lit(None).cast("timestamp")
    headers = F.when(time.isNotNull(), F.create_map(F.lit(_RECORD_TIME), encode_integer(F.unix_micros(time), 8)))
    rows = df.select(
        F.lit(topic_uri).alias("topic_uri"), (published if published is not None else F.current_timestamp()).alias("timestamp"),
        key.alias("key"), value.alias("value"), headers.alias("headers"), *order).withColumn("partition", by_key(F.col("key"), n))
    log.stage(rows, txn, order)
    if watermark is not None:
        marks = spark.range(n).select(
            F.col("id").cast("int").alias("partition"), F.lit(producer).alias("producer"), watermark.alias("watermark"))
        marks.coalesce(1).write.mode("overwrite").parquet(f"{log.root}/marks/txn={txn}")
    return log.commit(txn)


def read_key_by(log: TopicLog, topic_uri: str) -> DataFrame:
    """Rows with their record time, or the publish time when they carry none."""
    micros = decode_integer(header(F.col("headers"), _RECORD_TIME), 8)
    rows = log.read().where(F.col("topic_uri") == topic_uri)
    return rows.withColumn("record_time", F.coalesce(F.timestamp_micros(micros), F.col("timestamp")))


def watermarks(log: TopicLog) -> DataFrame:
    """All watermarks written with committed transactions."""
    marked = {n.removeprefix("txn=") for n in files.names(log.spark, f"{log.root}/marks")}
    return log._load("marks", MARKS_DDL, [t for t in log.committed() if t in marked])


def persistent_key_by(
    df: DataFrame, log: TopicLog, topic_uri: str, key: Column, value: Column, n: int, txn: str, order: list[str],
    **how,
) -> DataFrame:
    """Write and read back, partitioned by key."""
    write_key_by(df, log, topic_uri, key, value, n, txn, order, **how)
    return read_key_by(log, topic_uri)


def keys_in_several_partitions(rows: DataFrame) -> DataFrame:
    """Keys found in more than one partition; empty for a sound shuffle."""
    per_key = rows.where(F.col("key").isNotNull()).groupBy("topic_uri", "key").agg(
        F.countDistinct("partition").alias("n_partitions"))
    return per_key.where("n_partitions > 1")


def write_bucketed(df: DataFrame, table: str, path: str, key: str, n: int) -> DataFrame:
    """The batch form: a table bucketed by key, which joins and groups on the key without another shuffle.

    Rows are dealt to their buckets before the write, so there is one file a bucket whatever the number of tasks.
    Buckets hold whole keys; where one key may dominate, use `write_skewed`.
    """
    dealt = df.repartition(n, key)
    dealt.write.mode("overwrite").bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


@dataclass
class SkewedBuckets:
    """A keyed table whose hot keys lie apart from its buckets. No key is in both `cold` and `hot`.

    `cold` is bucketed by `key`. `hot` keeps the rows of the hot keys as the writing tasks had them, in files that Spark
    splits by size. `keys` maps each hot key to its number of rows; there are fewer than SHARE times as many as buckets.
    """

    key: str
    cold: DataFrame
    hot: DataFrame
    keys: DataFrame

    def rows(self) -> DataFrame:
        return self.cold.unionByName(self.hot)

    def aggregate(self, *aggregates: Column) -> DataFrame:
        """One row per key, null included. Cold keys are grouped where they lie; of hot ones each task sends one row
        per key, as long as the aggregates combine before the shuffle."""
        cold, hot = (side.groupBy(self.key).agg(*aggregates) for side in (self.cold, self.hot))
        return cold.unionByName(hot)

    def join(self, other: DataFrame, how: str = "inner") -> DataFrame:
        """Inner, left, semi or anti join with `other`, which has the key under the same name and otherwise other names.
        Null keys match nothing.

        Buckets stay where they are, and `other` is shuffled to them, unless it is bucketed alike. Rows of hot keys stay
        as well: what `other` has of hot keys is sent to all of them if its size allows, and joined by shuffle if not.
        """
        if how not in ("inner", "left", "left_semi", "left_anti"):
            raise ValueError(f"rows without a partner in the buckets cannot be told here: {how}")
        wanted = other.join(F.broadcast(self.keys.select(self.key)), self.key, "left_semi")
        return self.cold.join(other, self.key, how).unionByName(self.hot.join(checked_broadcast(wanted).df, self.key, how))


def write_skewed(df: DataFrame, table: str, path: str, key: str, n: int) -> SkewedBuckets:
    """`write_bucketed` for keys of any frequency: a key with more than 1 / (SHARE * n) of the rows is hot.

    Keys are counted first, on the key column alone. Hot rows are written without a shuffle, by the tasks that read
    them. Null is a key like any other. `df` is read up to three times, so it has to give the same rows each time.
    An empty table gives empty parts.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    total = df.count()
    # fewer than SHARE * n rows by the threshold itself, so they are broadcast below
    counted.where(F.col("n_rows") > total / (SHARE * n)).coalesce(1).write.mode("overwrite").parquet(f"{path}/keys")
    hot = F.broadcast(df.sparkSession.read.parquet(f"{path}/keys").select(F.col(key).alias("_hot_key")))
    is_hot = df[key].eqNullSafe(hot["_hot_key"])
    write_bucketed(df.join(hot, is_hot, "left_anti"), table, f"{path}/cold", key, n)
    df.join(hot, is_hot, "left_semi").write.mode("overwrite").parquet(f"{path}/hot")
    return read_skewed(df.sparkSession, table, path, key)


def read_skewed(spark: SparkSession, table: str, path: str, key: str) -> SkewedBuckets:
    """What `write_skewed` wrote, for any later job."""
    return SkewedBuckets(key, spark.table(table), spark.read.parquet(f"{path}/hot"), spark.read.parquet(f"{path}/keys"))
