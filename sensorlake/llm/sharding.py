"""Two-pass external shuffle of records into shards of equal row counts.

Pass 1 scatters records by a seeded hash over buckets that fit in memory.
Pass 2 shuffles every bucket (Spark's ``shuffle`` is a Fisher-Yates shuffle)
and writes it. The buckets one after the other are a random order of all
records; a shard is an equal cut of that order, so it needs no further pass.

Defined cases: rows are kept as they are, repeated rows, NULL keys and NULL
texts included; the place of a row in its input file enters the hash, so a key
that holds a third of all rows is scattered like any other. An empty table
gives no rows. Columns of any name may be present, they are kept in the struct
``record``; their types must be sortable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, no_null, shuffle_partitions, table

BUCKET_BYTES = 64 << 20


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (none if it is NULL) plus 16 for its key and length."""
    return F.octet_length(no_null(text)).cast("long") + 16


def write_shuffled(records: DataFrame, path: str, key: str = "doc_id", text: str = "text", seed: int = 42,
                   bucket_bytes: int = BUCKET_BYTES) -> None:
    """Write ``records`` to ``path`` in random order as (bucket, pos, record).

    A bucket holds about ``bucket_bytes``; there are at least four per shuffle
    partition, so small inputs also use all tasks. Buckets are hashed evenly:
    none is larger than its share, whatever the keys are.
    """
    total = records.agg(F.coalesce(F.sum(record_bytes(F.col(text))), F.lit(0))).first()[0]
    buckets = max(-(-total // bucket_bytes), 4 * shuffle_partitions(records.sparkSession))
    place = F.xxhash64(F.lit(seed), F.col(key), F.monotonically_increasing_id())
    scattered = records.select(
        F.pmod(place, F.lit(buckets)).cast("int").alias("bucket"),
        F.struct(place.alias("place"), F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record")).alias("r"))
    # the order in a bucket, and of the buckets in a task, must not depend on the order in
    # which blocks arrive: then the seeded shuffle gives a task that runs again the same result
    gathered = scattered.groupBy("bucket").agg(F.array_sort(F.collect_list("r")).alias("rows"))
    shuffled = gathered.sortWithinPartitions("bucket").select("bucket", F.shuffle("rows", seed).alias("rows"))
    (shuffled.select("bucket", F.posexplode("rows").alias("pos", "r"))
     .select("bucket", "pos", "r.record").write.parquet(path))


def read_shards(spark: SparkSession, path: str, n_shards: int) -> DataFrame:
    """The written records with their ``shard`` and ``slot``; counts of shards differ by one at most."""
    rows = spark.read.parquet(path)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # one row per bucket: its start in the order of all records. 100 TB in buckets of
    # 64 MB are 1.6 million rows of 20 bytes, a bound that allows the broadcast
    starts = rows.groupBy("bucket").agg(F.count("*").alias("n")).select(
        "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(everything).alias("total"))
    place = F.col("start") + F.col("pos")
    short = F.floor(F.col("total") / n_shards)  # rows of a short shard; the first ``longer`` shards have one more
    longer = F.col("total") % n_shards
    in_long = place < longer * (short + 1)
    rest = place - longer * (short + 1)
    shard = F.when(in_long, F.floor(place / (short + 1))).otherwise(longer + F.floor(rest / short))
    slot = F.when(in_long, place % (short + 1)).otherwise(rest % short)
    return rows.join(F.broadcast(starts), "bucket").select(
        "record", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39, by the law ``rows``: written in random order, then read back."""
    path = new_path(spark, "shards")
    write_shuffled(table(spark, sf_dir, "documents"), path)
    text = no_null(F.col("record.text"))
    return read_shards(spark, path, 40).select(
        "record.doc_id", record_bytes(text).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
