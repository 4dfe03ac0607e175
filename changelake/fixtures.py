"""The relations of FIXTURES.md over the `events` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.plans.ordered import number_rows
from changelake.schema import CHANGES, DELETE, INDEX, SHARD_KEY


def raw_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document operations as the engine reports them, `op_no` giving their order."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return (
        events.withColumn("k", F.expr("CAST(get_json_object(props, '$.k') AS INT)"))
        .selectExpr(
            "CASE WHEN event_id % 97 = 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS result_type",
            """CASE event_type WHEN 'error' THEN '.sys-error' WHEN 'click' THEN 'logs-click'
                    WHEN 'view' THEN 'logs-view' WHEN 'purchase' THEN 'shop-purchase'
                    ELSE 'shop-signup' END AS `index`""",
            "concat('u', CAST(user_id AS STRING)) AS id",
            """CASE WHEN k % 10 <> 0 THEN
                    concat('{"n":', CAST(event_id AS STRING), ',"k":', CAST(k AS STRING), '}') END AS source""",
            "CAST(CASE WHEN ts < TIMESTAMP_NTZ'2024-01-16 00:00:00' THEN 1 ELSE 2 END AS BIGINT) AS primary_term",
            "CASE WHEN k % 10 = 0 THEN 'DELETE' ELSE 'INDEX' END AS op_type",
            "CASE WHEN event_id % 5 = 0 THEN concat('r', CAST(event_id % 7 AS STRING)) END AS routing",
            "CAST(user_id % 3 AS INT) AS shard_id",
            "unix_millis(CAST(ts AS TIMESTAMP)) AS timestamp_ms",
            "event_id AS op_no",
        )
    )


def engine_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`raw_ops` with sequence numbers on the operations that took effect, dense per shard."""
    ops = raw_ops(spark, sf_dir)
    done = number_rows(
        ops.filter(F.col("result_type") == "SUCCESS"),
        SHARD_KEY,
        ["op_no"],
        "op_no",
        "seq_no",
        unique_lead=True,
    )
    return done.unionByName(
        ops.filter(F.col("result_type") != "SUCCESS"), allowMissingColumns=True
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All successful operations as changes; deletes have no routing yet."""
    ops = raw_ops(spark, sf_dir).filter(F.col("result_type") == "SUCCESS")
    numbered = number_rows(ops, SHARD_KEY, ["op_no"], "op_no", "seq_no", unique_lead=True)
    routing = F.when(F.col("op_type") == INDEX, F.col("routing"))
    return numbered.withColumn("routing", routing).select(*CHANGES.fieldNames(), "op_no")


def delete_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = raw_ops(spark, sf_dir)
    wanted = (F.col("op_type") == DELETE) & F.col("routing").isNotNull()
    return ops.filter(wanted).select("index", "id", "op_no", "routing")


def captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer output under the default filter."""
    return change_log(spark, sf_dir).filter(~F.col("index").startswith("."))


# Fixed values of the delivery order: an odd multiplier makes `arrival` a permutation of up to `SPAN` operation numbers.
STEP, SPAN = 2654435761, 1 << 32
BATCH_EVENTS = 50


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumer input: shuffled, a tenth of the events delivered twice, in batches of about `BATCH_EVENTS` operations."""
    times = "CASE WHEN op_no % 10 = 3 THEN array(0, 1) ELSE array(0) END"
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    width = events.agg(F.expr(f"greatest(1L, {SPAN * BATCH_EVENTS}L div count(1))")).scalar()
    return (
        captured(spark, sf_dir)
        .selectExpr("*", f"explode({times}) AS again")
        .selectExpr("*", f"(op_no * {STEP}L) % {SPAN}L + again * {SPAN}L AS arrival")
        .withColumn("batch_key", F.concat(F.lit("b"), F.call_function("div", F.col("arrival"), width).cast("string")))
        .withColumn("line_no", F.col("op_no"))
        .drop("again")
    )


def before(share: float) -> Column:
    """The deliveries that arrive in the first `share` of the time; repeats come after all of it."""
    return F.col("arrival") < int(SPAN * share)


def lagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the deliveries a passive copy that is behind has seen."""
    return deliveries(spark, sf_dir).filter(before(0.6))


def snapshot_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = captured(spark, sf_dir).filter(F.col("op_no") % 4 == 0)
    return rows.select("index", "shard_id", "id", F.lit('{"seed":true}').alias("source")).distinct()


# Which delivered events the target turns down, so that failures occur.
def rejected():
    return F.col("op_no") % 211 == 0
