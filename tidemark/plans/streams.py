"""Queries that run a file stream to its end and return what it has come to."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ledgers
from tidemark.plans.base import query, table, titles
from tidemark.plans.scoring import _MATCH_SQL
from tidemark.plans.watching import _RUNS_SQL, STATUS
from tidemark.shared import shared_dir
from tidemark.streaming import attach, state


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # a file source reads folders: the glob finds the table both as one file and as a folder of files
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/[e]vents.parquet")


def _finish(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """What the stream has written when it has read all there is, in files of the shared folder, with each batch's number.

    A batch that is repeated replaces its own files.
    """
    at = f"{shared_dir(spark)}/{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out/batch={number}")

    # a stream without rows has no batch
    spark.createDataFrame([], stream.schema).write.parquet(f"{at}/out/batch=-1")
    run = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{at}/log").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{at}/out").select(*stream.columns, "batch")


#: Later than all rows of the tables: it moves the watermark past them.
END = "2100-01-01"


def _replayed(spark: SparkSession, rows: DataFrame, cuts: tuple[str, ...], end: bool = False) -> DataFrame:
    """rows (with at, or null) as a stream that comes slice by slice, cut at these times, a slice a batch.

    end: a row of null values but its time comes last, so that what waits for the watermark is told.
    """
    to = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    edges = [F.lit("1900-01-01").cast("timestamp"), *[F.lit(c).cast("timestamp") for c in cuts], F.lit(END).cast("timestamp")]
    for low, high in zip(edges, edges[1:], strict=False):
        # a slice is one file: the source takes one at a time, in the order in which they were written
        inside = (F.col("at") >= low) & (F.col("at") < high)
        rows.filter(inside).coalesce(1).write.mode("append").parquet(to)
    if end:
        last = [F.lit(END).cast("timestamp").alias(c) if c == "at" else F.lit(None).cast(t).alias(c) for c, t in rows.dtypes]
        spark.range(1).select(*last).coalesce(1).write.mode("append").parquet(to)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(to)


@query("SELECT user_id, event_type, min(ts) AS first_observed_at, count(*) AS observations FROM events GROUP BY user_id, event_type")
def s01_stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = _finish(spark, state.first_seen(_stream(spark, sf_dir), ["user_id", "event_type"], "ts"), "update")
    return state.latest(told, ["user_id", "event_type"])


@query(f"WITH {_RUNS_SQL} SELECT * FROM h")
def s02_stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q26 as a stream of three batches, kept in a table of versions."""
    status = F.lit("404")
    for kind, code in STATUS:
        status = F.when(F.col("event_type") == kind, code).otherwise(status)
    told = ledgers.outcome(F.when(F.col("event_id") % 13 == 0, "404").otherwise(status))
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), F.col("ts").cast("timestamp").alias("at"), "event_id", told.alias("outcome"))
    at = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    sink = state.merge_into(f"{at}/table", ["source"], state.courses, "health")
    ordered = lambda df: df.select("source", F.struct("at", "event_id").alias("seq"), "outcome")
    # a table without rows has a version too
    state.merge_into(f"{at}/table", ["source"], state.courses)(ordered(rows.limit(0)), 0)
    stream = ordered(_replayed(spark, rows, _CUTS))
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{at}/log").trigger(availableNow=True).start().awaitTermination()
    return ledgers.health_of(state.current(spark, f"{at}/table"))


@query("SELECT event_id, user_id FROM events WHERE CAST(floor((epoch_us(TIMESTAMP '2024-01-20') - epoch_us(ts)) / 86400000000.0) AS INT) <= 7")
def s03_stream_lead_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = _stream(spark, sf_dir).withColumn("seen", F.lit("2024-01-20").cast("timestamp"))
    return _finish(spark, state.recent_only(seen, "ts", "seen").select("event_id", "user_id"), "append").drop("batch")


#: Days at which the streams of titles, orders and fetches are cut.
_CUTS = ("2024-01-10", "2024-01-25")


@query(f"""WITH {_MATCH_SQL}, p AS (SELECT *, rank() OVER (PARTITION BY signal ORDER BY same_fp DESC, same_bucket DESC, similarity DESC) AS place FROM m)
SELECT signal, any_value(event) AS event, any_value(similarity) AS similarity FROM p WHERE place = 1 GROUP BY signal HAVING count(*) = 1""")
def s04_stream_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q14 as two streams: events that opened in the first hours stay open until no signal can come."""
    made = titles(spark, sf_dir).select(F.col("p_partkey").alias("id"), "title", F.col("at").cast("timestamp").alias("at"))
    known = F.col("at") < F.lit("2024-01-01 09:00:00").cast("timestamp")
    signals, events = (_replayed(spark, made.filter(side), _CUTS, end=True) for side in (~known, known))
    told = _finish(spark, attach.attach_stream(signals, events, ascii_only=True), "append")
    return told.filter("event is not null").select("signal", "event", "similarity")


@query("""WITH o AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) + 2 AS edition, o_orderstatus = 'O' AS open FROM orders WHERE o_orderkey % 10 > 0)
SELECT CAST(edition AS DATE) AS edition, count(*) AS n, count(*) FILTER (open) AS open FROM o GROUP BY 1""")
def s05_edition_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q42 as a stream in which a third of the events is delivered twice; those without a day of passing are in no edition."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(k.alias("id"), F.when(k % 10 > 0, F.expr("cast(o_orderdate + INTERVAL 2 DAY as timestamp)")).alias("at"), (F.col("o_orderstatus") == "O").alias("open"))
    passed = _replayed(spark, o.unionByName(o.filter("id % 3 = 0")), ("1994-01-01", "1997-01-01", "2000-01-01"), end=True)
    return _finish(spark, attach.edition_days(passed, "2 days"), "append").drop("batch")


_FAILED = ("error", "purchase")


@query(f"SELECT user_id AS source, max(ts) FILTER (event_type NOT IN {_FAILED}) AS cursor, count(*) FILTER (event_type IN {_FAILED}) AS failures FROM events GROUP BY user_id")
def s06_fetch_cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cursors in a table of versions; the writer dies before a commit, and later another one with its own log goes on."""
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), F.col("ts").cast("timestamp").alias("at"), (~F.col("event_type").isin(*_FAILED)).alias("ok"))
    at = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    # an empty table has no commit
    state.merge_into(f"{at}/table", ["source"], state.cursors)(rows.limit(0).withColumnRenamed("at", "ts"), 0)
    died: list[int] = []

    def die_once(number: int) -> None:
        if number == 1 and not died:
            died.append(number)
            raise RuntimeError("the writer died between data and commit")

    half = F.lit(_CUTS[0]).cast("timestamp")
    for run, part in (("first", rows.filter(F.col("at") < half)), ("second", rows.filter(F.col("at") >= half))):
        stream = _replayed(spark, part, ("2024-01-05", "2024-01-15")).withColumnRenamed("at", "ts")
        sink = state.merge_into(f"{at}/table", ["source"], state.cursors, run, die_once)
        for _ in range(2):
            # the second start repeats what the first one didn't commit, or finds nothing to do
            query_ = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{at}/log-{run}").trigger(availableNow=True).start()
            try:
                query_.awaitTermination()
            except StreamingQueryException:
                if not died:
                    raise
    return state.current(spark, f"{at}/table")
