"""Load modes, staging, streaming loads and column encryption; each returns its table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import security
from tidemark.operators import loads, validation
from tidemark.session import fresh_path
from tidemark.sources import jdbc, staging
from tidemark.streaming import micro_batch
from tidemark.workload import views

_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "load_ts"]
KEYS = ["o_orderkey"]


def _name(what: str) -> str:
    return f"tidemark_{what}_{uuid.uuid4().hex[:12]}"


def _orders(spark: SparkSession, sf_dir: str, load_ts: str) -> DataFrame:
    return views.table(spark, sf_dir, "orders").withColumn("load_ts", F.lit(load_ts)).select(
        *_COLUMNS, "o_orderdate"
    )


def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished and open orders, as loaded earlier."""
    return _orders(spark, sf_dir, "old").filter("o_orderstatus <> 'P'").select(*_COLUMNS)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open and pending orders at a new price; open ones update, pending ones are new."""
    return _orders(spark, sf_dir, "new").filter("o_orderstatus <> 'F'").select(*_COLUMNS).withColumns(
        {"o_totalprice": F.col("o_totalprice") + 1, "o_orderpriority": F.lower("o_orderpriority")}
    )


def _taken(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows, off the catalog: a query leaves no table behind, its files are scratch."""
    rows = spark.read.schema(spark.table(table).schema).parquet(loads.location(spark, table))
    spark.sql(f"DROP TABLE {table}")
    return rows


def _shown(spark: SparkSession, table: str, *extra: str) -> DataFrame:
    return _taken(spark, table).select(
        "o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("o_totalprice"),
        "o_orderstatus", "o_orderpriority", "load_ts", *extra,
    )


def _loaded(mode: str, **options):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = _name(mode)
        loads.create_table(_target(spark, sf_dir), table)
        loads.load(_staged(spark, sf_dir), table, mode, **options)
        return _shown(spark, table)

    return query


def load_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month; the staged year replaces its twelve months only."""
    table = _name("partition")
    month = F.date_format("o_orderdate", "yyyyMM").alias("month")
    loads.create_table(_orders(spark, sf_dir, "old").select(*_COLUMNS, month), table, ["month"])
    staged = _orders(spark, sf_dir, "new").filter("year(o_orderdate) = 1997 AND o_orderstatus = 'O'")
    loads.load(staged.select(month, *_COLUMNS), table, "OVERWRITE", partition_by=["month"])
    return _shown(spark, table, "month")


def load_feed_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds by status and year; the staged feed replaces its own partitions."""
    table = _name("feed")
    feed = [F.col("o_orderstatus").alias("feed_ind"), F.date_format("o_orderdate", "yyyy").alias("ictrl_dt")]
    loads.overwrite_feed_partitions(_orders(spark, sf_dir, "old").select(*_COLUMNS, *feed), table)
    staged = _orders(spark, sf_dir, "new").filter("o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
    loads.overwrite_feed_partitions(staged.select(*feed, *_COLUMNS), table)
    return _shown(spark, table, "feed_ind", F.col("ictrl_dt").cast("string").alias("ictrl_dt"))


def load_upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert that moves open orders to another partition."""
    table = _name("moved")
    loads.create_table(_target(spark, sf_dir), table, ["o_orderstatus"])
    staged = _staged(spark, sf_dir).withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "O", "X").otherwise(F.col("o_orderstatus"))
    )
    loads.load(staged, table, "upsert", keys=KEYS)
    return _shown(spark, table)


def load_dup_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items staged by order: orders that several staged rows would update."""
    staged = views.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return loads.duplicate_sources(views.table(spark, sf_dir, "orders"), staged, KEYS)


def staging_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One staged table under its job's name, one under its target's (older) name."""
    job, table = _name("job"), _name("table")
    loads.create_table(_staged(spark, sf_dir), f"{job}_tmp_validation")
    loads.create_table(_target(spark, sf_dir), f"{table}_tmp_validation")
    by_job = staging.staged_table(spark, job, table)
    by_table = staging.staged_table(spark, "no_such_job", table)
    by_job, by_table = (
        spark.read.schema(df.schema).parquet(loads.location(spark, f"{name}_tmp_validation"))
        for df, name in ((by_job, job), (by_table, table))
    )
    for name in (job, table):
        spark.sql(f"DROP TABLE {name}_tmp_validation")
    return by_job.withColumn("found", F.lit("job")).unionByName(
        by_table.withColumn("found", F.lit("table"))
    ).select("found", "o_orderkey", "load_ts")


def staged_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.staged_row_counts(
        {"staged": _staged(spark, sf_dir), "target": _target(spark, sf_dir)}
    )


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """The events as several files, for a stream to pick up one at a time."""
    path = fresh_path(spark, "event-files")
    views.table(spark, sf_dir, "events").repartitionByRange(3, "event_id").write.parquet(path)
    return path


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended from a file stream, counted in the target."""
    table, files = _name("ingest"), _event_files(spark, sf_dir)
    schema = views.SCHEMAS["events"]
    empty = spark.createDataFrame([], schema + ", batch_id bigint")
    loads.create_table(empty, table, [micro_batch.BATCH_COLUMN])
    stream = micro_batch.file_stream(spark, files, schema)
    micro_batch.start(
        stream, table, "append", fresh_path(spark, "ingest-state"), available_now=True
    ).awaitTermination()
    spark.catalog.refreshTable(table)  # the stream loads in a session of its own
    return _taken(spark, table).groupBy("event_type").agg(
        F.count("*").alias("events"), F.countDistinct("event_id").alias("event_ids")
    )


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user, kept by upserting micro-batches."""
    table, files = _name("latest"), _event_files(spark, sf_dir)
    schema = views.SCHEMAS["events"]
    loads.create_table(spark.createDataFrame([], schema), table)
    stream = micro_batch.file_stream(spark, files, schema)
    micro_batch.start(
        stream, table, "upsert", fresh_path(spark, "upsert-state"), available_now=True,
        keys=["user_id"], order_by="event_id",
    ).awaitTermination()
    spark.catalog.refreshTable(table)  # the stream loads in a session of its own
    return _taken(spark, table).select("user_id", "event_id", "event_type")


_RESULT_TYPES = {
    "c_custkey": ("BIGINT", 0, 0), "c_nationkey": ("SMALLINT", 0, 0), "c_acctbal": ("DECIMAL", 12, 2),
    "balance": ("REAL", 0, 0), "opened": ("TIME", 0, 0), "c_mktsegment": ("CHAR", 0, 0),
}


def jdbc_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a driver may type them, brought to the fixed types."""
    driver_types = views.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("smallint"), F.col("c_acctbal").cast("decimal(20,4)"),
        F.col("c_nationkey").cast("float").alias("balance"),
        F.date_format(F.timestamp_seconds(F.col("c_custkey") % 86400), "HH:mm:ss").alias("opened"),
        "c_mktsegment",
    )
    types = {c: jdbc.spark_type(*spec) for c, spec in _RESULT_TYPES.items()}
    return jdbc.typed(driver_types, types).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


# A key made up for the round trip below; real keys come from Spark conf.
_TEST_KEY_HEX = "00112233445566778899aabbccddeeff" * 2
_TEST_IV_HEX = "0f0e0d0c0b0a09080706050403020100"


def _sealed(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, iv = F.unhex(F.lit(_TEST_KEY_HEX)), F.unhex(F.lit(_TEST_IV_HEX))
    document = F.to_json(F.struct(F.col("c_name").alias("value")))
    return views.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        security.encrypt(document, key, iv).alias("fixed_iv"),
        security.encrypt(F.col("c_name"), key).alias("random_iv"),
    )


def column_encrypt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cipher text lengths: a fixed vector is not stored, a random one is."""
    return _sealed(spark, sf_dir).select(
        "c_custkey", (F.col("fixed_iv") != F.col("c_name")).alias("is_sealed"),
        F.octet_length(F.unbase64("fixed_iv")).alias("fixed_bytes"),
        F.octet_length(F.unbase64("random_iv")).alias("random_bytes"),
    )


def column_decrypt(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, iv = F.unhex(F.lit(_TEST_KEY_HEX)), F.unhex(F.lit(_TEST_IV_HEX))
    wrong = F.unhex(F.lit("ff" * 32))
    return _sealed(spark, sf_dir).select(
        "c_custkey",
        security.decrypt_value(F.col("fixed_iv"), key, iv).alias("from_json"),
        security.decrypt(F.col("random_iv"), key).alias("plain"),
        (F.coalesce(security.decrypt(F.col("random_iv"), wrong), F.lit("")) == F.col("c_name"))
        .alias("by_wrong_key"),
    )


_CONDITION = "src.o_totalprice > 250000"
_UPDATE_WHEN = "trg.o_totalprice < src.o_totalprice AND trg.o_orderpriority = '1-URGENT'"
def load_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into a target bucketed by the order; its rows are not moved."""
    table = _name("bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    loads.create_table(_target(spark, sf_dir), table, buckets=buckets, bucket_by=KEYS)
    loads.load(_staged(spark, sf_dir), table, "upsert", keys=KEYS)
    return _shown(spark, table)


QUERIES = {
    "load_full": _loaded("Full_Load"),
    "load_partition": load_partition,
    "load_append": _loaded("append"),
    "load_upsert": _loaded("upsert", keys=KEYS),
    "load_upsert_cond": _loaded("upsert", keys=KEYS, condition=_CONDITION),
    "load_upsert_cols": _loaded("upsert", keys=KEYS, update_columns=["o_orderpriority", "load_ts"]),
    "load_upsert_partitioned": load_upsert_partitioned,
    "load_upsert_bucketed": load_upsert_bucketed,
    "load_update": _loaded("update", keys=KEYS, update_columns=["o_totalprice"], condition=_UPDATE_WHEN),
    "load_feed_partition": load_feed_partition,
    "load_dup_source": load_dup_source,
    "staging_scan": staging_scan,
    "staged_row_count": staged_row_count,
    "stream_ingest": stream_ingest,
    "stream_upsert": stream_upsert,
    "jdbc_typed_scan": jdbc_typed_scan,
    "column_encrypt": column_encrypt,
    "column_decrypt": column_decrypt,
}

# --- the same in SQL -----------------------------------------------------------------

_BOTH = """WITH trg AS (SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS o_totalprice,
      o_orderstatus, o_orderpriority, 'old' AS load_ts FROM orders WHERE o_orderstatus <> 'P'
    ), src AS (SELECT o_orderkey, o_custkey, round(o_totalprice + 1, 2) AS o_totalprice, o_orderstatus,
      lower(o_orderpriority) AS o_orderpriority, 'new' AS load_ts FROM orders WHERE o_orderstatus <> 'F') """
_PART = """SELECT o_orderkey, o_custkey, round(o_totalprice, 2) AS o_totalprice, o_orderstatus,
      o_orderpriority, '{ts}' AS load_ts, {extra} FROM orders WHERE {where}"""
_UPSERTED = """SELECT * REPLACE ('old' AS load_ts) FROM src WHERE o_orderstatus = 'O'
      UNION ALL SELECT * FROM trg WHERE o_orderstatus = 'F'
      UNION ALL SELECT * FROM src WHERE o_orderstatus = 'P'"""
_MONTH = "strftime(o_orderdate, '%Y%m') AS month"
_FEED = "o_orderstatus AS feed_ind, strftime(o_orderdate, '%Y') AS ictrl_dt"

ORACLES = {
    "load_full": _BOTH + "SELECT * FROM src",
    "load_append": _BOTH + "SELECT * FROM trg UNION ALL SELECT * FROM src",
    "load_partition": _PART.format(ts="old", extra=_MONTH, where="year(o_orderdate) <> 1997 OR NOT EXISTS "
        "(SELECT 1 FROM orders s WHERE s.o_orderstatus = 'O' AND date_trunc('month', s.o_orderdate) "
        "= date_trunc('month', orders.o_orderdate))")
      + " UNION ALL " + _PART.format(ts="new", extra=_MONTH,
                                     where="year(o_orderdate) = 1997 AND o_orderstatus = 'O'"),
    "load_upsert": _BOTH + _UPSERTED,
    "load_upsert_bucketed": _BOTH + _UPSERTED,
    "load_upsert_cond": _BOTH + """SELECT t.* REPLACE (CASE WHEN s.o_totalprice > 250000
        THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice, CASE WHEN s.o_totalprice > 250000
        THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority)
      FROM trg t LEFT JOIN src s USING (o_orderkey)
      UNION ALL SELECT * FROM src WHERE o_orderstatus = 'P' OR o_totalprice <= 250000""",
    "load_upsert_cols": _BOTH + """SELECT t.* REPLACE (CASE WHEN o_orderstatus = 'O'
        THEN lower(o_orderpriority) ELSE o_orderpriority END AS o_orderpriority) FROM trg t
      UNION ALL SELECT * FROM src WHERE o_orderstatus = 'P'""",
    "load_upsert_partitioned": _BOTH + """SELECT * REPLACE ('X' AS o_orderstatus, 'old' AS load_ts)
      FROM src WHERE o_orderstatus = 'O'
      UNION ALL SELECT * FROM trg WHERE o_orderstatus = 'F'
      UNION ALL SELECT * FROM src WHERE o_orderstatus = 'P'""",
    "load_update": _BOTH + """SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' AND
      o_orderpriority = '1-URGENT' THEN round(o_totalprice + 1, 2) ELSE o_totalprice END AS o_totalprice)
      FROM trg""",
    "load_feed_partition": _PART.format(ts="old", extra=_FEED, where="""o_orderstatus <> 'O' OR NOT EXISTS
        (SELECT 1 FROM orders s WHERE s.o_orderstatus = 'O' AND s.o_orderpriority = '1-URGENT'
         AND year(s.o_orderdate) = year(orders.o_orderdate))""")
      + " UNION ALL " + _PART.format(ts="new", extra=_FEED,
                                     where="o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'"),
    "load_dup_source": """SELECT l_orderkey AS o_orderkey, count(*) AS matches FROM lineitem
      WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey HAVING count(*) > 1""",
    "staging_scan": """SELECT 'job' AS found, o_orderkey, 'new' AS load_ts FROM orders WHERE o_orderstatus <> 'F'
      UNION ALL SELECT 'table', o_orderkey, 'old' FROM orders WHERE o_orderstatus <> 'P'""",
    "staged_row_count": """SELECT 'staged' AS staged, count(*) AS row_cnt FROM orders WHERE o_orderstatus <> 'F'
      UNION ALL SELECT 'target', count(*) FROM orders WHERE o_orderstatus <> 'P'""",
    "stream_ingest": """SELECT event_type, count(*) AS events, count(DISTINCT event_id) AS event_ids
      FROM events GROUP BY event_type""",
    "stream_upsert": """SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type
      FROM events GROUP BY user_id""",
    "jdbc_typed_scan": """SELECT c_custkey, c_nationkey, c_acctbal, CAST(c_nationkey AS DOUBLE) AS balance,
      strftime(make_timestamp(c_custkey % 86400 * 1000000), '%H:%M:%S') AS opened, c_mktsegment FROM customer""",
    "column_encrypt": """SELECT c_custkey, true AS is_sealed,
      CAST(16 * ((strlen(c_name) + 12) // 16 + 1) AS INTEGER) AS fixed_bytes,
      CAST(16 * (strlen(c_name) // 16 + 2) AS INTEGER) AS random_bytes FROM customer""",
    "column_decrypt": """SELECT c_custkey, c_name AS from_json, c_name AS plain, false AS by_wrong_key
      FROM customer""",
}
