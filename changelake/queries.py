"""One query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake import fixtures as fx
from changelake.functions import columns
from changelake.operators import batching, capture, checkpoint, digests, metrics, reconcile, replay
from changelake.schema import APPLIED, CHANGES, DELETE, INDEX, NOTIFICATION, REPLICA
from changelake.sources import changelog, epochs, replica
from changelake.sources.files import read_lines
from changelake.sources.storage import remove, scratch_dir
from changelake.streaming import capture_stream, replay_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Limits small enough to cut batches in the test tables.
COUNT = 25
PACK = {"max_events": 10, "age_ms": 86_400_000, "max_bytes": 1024}
SLICE = 5
DAY_MS = 86_400_000


def query(fn: Query) -> Query:
    def named(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.withColumnRenamed("index", "idx") if "index" in df.columns else df

    QUERIES[fn.__name__] = named
    return fn


# --- capture ---------------------------------------------------------------------------


@query
def successful_ops(spark, sf_dir):
    return capture.successful_ops(fx.raw_ops(spark, sf_dir)).select("op_no", "index", "op_type")


@query
def index_filter(spark, sf_dir):
    ops = capture.replicated(fx.raw_ops(spark, sf_dir), "logs-*, shop-signup, .sys-error", "logs-view")
    return ops.select("op_no", "index")


@query
def to_change_event(spark, sf_dir):
    return capture.to_change_event(fx.change_log(spark, sf_dir))


@query
def event_size(spark, sf_dir):
    size = columns.event_size().alias("size")
    return fx.captured(spark, sf_dir).select("index", "shard_id", "seq_no", size)


@query
def delete_routing(spark, sf_dir):
    deletes = fx.captured(spark, sf_dir).filter(F.col("op_type") == DELETE)
    routed = capture.delete_routing(fx.delete_requests(spark, sf_dir), deletes)
    return routed.select("index", "shard_id", "id", "seq_no", "op_no", "routing")


@query
def capture_changes(spark, sf_dir):
    return capture.capture_changes(fx.engine_ops(spark, sf_dir))


@query
def capture_metrics(spark, sf_dir):
    return capture.capture_metrics(fx.raw_ops(spark, sf_dir), exclude="shop-signup")


@query
def op_mix(spark, sf_dir):
    return capture.op_mix(fx.captured(spark, sf_dir))


# --- batching --------------------------------------------------------------------------


def _counted(spark, sf_dir):
    return batching.batch_by_count(fx.captured(spark, sf_dir), COUNT)


@query
def batch_by_count(spark, sf_dir):
    return _counted(spark, sf_dir).select("index", "shard_id", "seq_no", "batch_no")


@query
def batch_by_age(spark, sf_dir):
    rows = batching.batch_by_age(fx.captured(spark, sf_dir), DAY_MS)
    return rows.select("index", "shard_id", "seq_no", "age_window")


@query
def pack_batches(spark, sf_dir):
    rows = batching.pack_batches(fx.captured(spark, sf_dir), **PACK)
    return rows.select("index", "shard_id", "seq_no", "age_window", "batch_no")


@query
def bulk_sub_batches(spark, sf_dir):
    rows = batching.bulk_sub_batches(fx.deliveries(spark, sf_dir), SLICE)
    return rows.select("batch_key", "arrival", "index", "shard_id", "seq_no", "slice_no")


@query
def batch_ranges(spark, sf_dir):
    return batching.batch_ranges(_counted(spark, sf_dir))


def _manifest(spark, sf_dir):
    return batching.batch_manifest(_counted(spark, sf_dir), base="/cdc/log")


@query
def batch_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir)


@query
def ship_metrics(spark, sf_dir):
    wanted = _manifest(spark, sf_dir)
    shipped = wanted.filter(F.col("from_seq_no") % 4 != 3)
    return batching.ship_metrics(shipped, wanted)


@query
def backlog(spark, sf_dir):
    return batching.backlog(fx.captured(spark, sf_dir), fx.lagging(spark, sf_dir))


# --- replay ----------------------------------------------------------------------------


@query
def latest_state(spark, sf_dir):
    return replay.latest_state(fx.deliveries(spark, sf_dir))


@query
def live_docs(spark, sf_dir):
    state = replay.live_docs(replay.latest_state(fx.deliveries(spark, sf_dir)))
    return state.select("index", "shard_id", "id", "version", "source")


@query
def apply_changes(spark, sf_dir):
    late = fx.deliveries(spark, sf_dir).filter(~fx.before(0.6))
    return replay.apply_changes(replay.latest_state(fx.lagging(spark, sf_dir)), late)


@query
def bootstrap(spark, sf_dir):
    return replay.bootstrap(fx.snapshot_docs(spark, sf_dir), fx.captured(spark, sf_dir))


def _verdicts(spark, sf_dir):
    return replay.replay_verdicts(fx.deliveries(spark, sf_dir), rejected=fx.rejected())


@query
def replay_verdicts(spark, sf_dir):
    rows = _verdicts(spark, sf_dir)
    return rows.select("index", "shard_id", "id", "seq_no", "arrival", "verdict")


@query
def replay_verdicts_on_state(spark, sf_dir):
    stored = replay.latest_state(fx.captured(spark, sf_dir).filter(F.col("op_no") % 3 == 0))
    rows = replay.replay_verdicts(fx.deliveries(spark, sf_dir), stored)
    return rows.select("index", "shard_id", "id", "seq_no", "arrival", "verdict")


@query
def replay_summary(spark, sf_dir):
    return replay.replay_summary(_verdicts(spark, sf_dir))


@query
def arrival_order(spark, sf_dir):
    rows = batching.bulk_sub_batches(fx.deliveries(spark, sf_dir), 1).withColumnRenamed("slice_no", "place")
    return replay.arrival_order(rows).select("batch_key", "arrival", "place", "index", "id")


@query
def redelivered(spark, sf_dir):
    once = fx.captured(spark, sf_dir)
    again = once.filter(F.col("op_no") % 10 == 3)
    rows = replay.redelivered(once, again)
    return rows.groupBy("index", "shard_id", "id").agg(
        F.count(F.lit(1)).alias("deliveries"), F.max("seq_no").alias("last_seq_no")
    )


@query
def render_bulk_actions(spark, sf_dir):
    return replay.render_bulk_actions(fx.captured(spark, sf_dir)).select("index", "shard_id", "seq_no", "bulk")


# --- checkpoints -----------------------------------------------------------------------


@query
def checkpoint_update(spark, sf_dir):
    return checkpoint.checkpoint_update(_verdicts(spark, sf_dir))


def _merged(spark, sf_dir):
    rows = _verdicts(spark, sf_dir)
    first = checkpoint.checkpoint_update(rows.filter(fx.before(0.6)))
    later = checkpoint.checkpoint_update(rows.filter(~fx.before(0.6)))
    return checkpoint.merge_checkpoints(first, later)


@query
def merge_checkpoints(spark, sf_dir):
    return _merged(spark, sf_dir)


@query
def load_checkpoints(spark, sf_dir):
    path = scratch_dir(spark, "checkpoints")
    rows = _verdicts(spark, sf_dir)
    epochs.save_checkpoints(
        checkpoint.checkpoint_update(rows.filter(fx.before(0.6))), path, 0
    )
    later = checkpoint.checkpoint_update(rows.filter(~fx.before(0.6)))
    before = epochs.load_checkpoints(spark, path, 0)
    epochs.save_checkpoints(checkpoint.merge_checkpoints(before, later), path, 1)
    return epochs.load_checkpoints(spark, path, 1)


def _summaries(spark, sf_dir):
    return replay.replay_summary(_verdicts(spark, sf_dir))


@query
def pending_batches(spark, sf_dir):
    announced = fx.deliveries(spark, sf_dir).select(F.col("batch_key").alias("s3_key")).distinct()
    processed = _summaries(spark, sf_dir).select(F.col("batch_key").alias("s3_key"), "failed")
    return checkpoint.pending_batches(announced, processed)


@query
def consumer_metrics(spark, sf_dir):
    rows = _verdicts(spark, sf_dir).groupBy("batch_key").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("verdict") == "FAILED").alias("failed"),
        F.max("arrival").alias("polled_ms"),
    )
    # Batches below number 20 cannot be read, the next 20 are empty.
    number = F.substring("batch_key", 2, 20).cast("long")
    events = F.when(number < 20, F.lit(None)).when(number < 40, F.lit(0)).otherwise(F.col("events"))
    failed = F.when(number >= 40, F.col("failed"))
    return metrics.consumer_metrics(rows.withColumn("events", events).withColumn("failed", failed))


# --- files -----------------------------------------------------------------------------


def _written(spark, sf_dir):
    path = scratch_dir(spark, "log")
    changelog.write_change_log(_counted(spark, sf_dir), path)
    return path


_FILE_COLUMNS = [*CHANGES.fieldNames(), "batch_key"]


@query
def read_change_log(spark, sf_dir):
    return changelog.read_change_log(spark, _written(spark, sf_dir)).select(*_FILE_COLUMNS, "line_no")


@query
def write_change_log(spark, sf_dir):
    return read_lines(spark, _written(spark, sf_dir))


@query
def split_bad_files(spark, sf_dir):
    """Files in which some line lost its operation type contribute nothing."""
    path = scratch_dir(spark, "bad")
    rows = _counted(spark, sf_dir)
    spoilt = F.when(F.col("op_no") % 500 == 1, "UPSERT").otherwise(F.col("op_type"))
    changelog.write_change_log(rows.withColumn("op_type", spoilt), path)
    good, bad = changelog.split_bad_files(spark, path)
    kept = good.groupBy("batch_key").agg(
        F.count(F.lit(1)).alias("events"), F.lit(0).cast("long").alias("bad_lines")
    )
    lost = bad.select("batch_key", F.lit(0).cast("long").alias("events"), "bad_lines")
    return kept.unionByName(lost)


@query
def stream_change_log(spark, sf_dir):
    path, out = scratch_dir(spark, "log"), scratch_dir(spark, "stream")
    changelog.write_change_log(batching.batch_by_count(fx.captured(spark, sf_dir), 200), path)
    parsed = changelog.stream_change_log(spark, path)

    def keep(micro, epoch):
        epochs.write_epoch(changelog.events_of(micro).select(*_FILE_COLUMNS), f"{out}/rows", epoch)

    run = parsed.writeStream.foreachBatch(keep).option("checkpointLocation", f"{out}/progress")
    run.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/rows").drop("epoch", "batch_key")


@query
def load_notifications(spark, sf_dir):
    """Bodies of the manifest; every fifth is plain text and some lack a number."""
    manifest = _manifest(spark, sf_dir)
    number = F.col("from_seq_no") % 5
    body = (
        F.when(number == 4, F.concat(F.lit("test message "), F.col("s3_key")))
        .when(number == 3, F.to_json(F.struct("s3_key", "index", "shard_id", "to_seq_no")))
        .otherwise(changelog.notification_body())
    )
    return changelog.load_notifications(manifest.select(body.alias("body")))


def _log_without_a_shard(spark, sf_dir):
    """A written log from which the files of shard 1 were removed."""
    log = _written(spark, sf_dir)
    for row in fx.captured(spark, sf_dir).select("index").distinct().toLocalIterator():
        remove(spark, f"{log}/index={row['index']}/shard_id=1")
    return log


@query
def resolve_batches(spark, sf_dir):
    """Notifications against written files of which one shard was lost."""
    found = changelog.resolve_batches(_manifest(spark, sf_dir), _log_without_a_shard(spark, sf_dir), base="/cdc/log")
    status = F.when(F.col("status") == changelog.MISSING, "MISSING").otherwise("FOUND")
    return found.select("s3_key", "event_count", "file_events", status.alias("status"))


@query
def resolved_events(spark, sf_dir):
    """The content of the files that notifications name."""
    found = changelog.resolve_batches(_manifest(spark, sf_dir), _log_without_a_shard(spark, sf_dir), base="/cdc/log")
    return found.select("s3_key", F.posexplode("events").alias("line_no", "e")).select("s3_key", "line_no", "e.*")


# Small buckets, so that the test tables make the replica split and merge.
SAVES = {"fan": 2, "bucket_rows": 200}


def _saved(spark, sf_dir):
    """A replica saved in four parts of the deliveries, each the newest state of its documents so far."""
    path = scratch_dir(spark, "replica")
    rows = fx.deliveries(spark, sf_dir)
    for part in range(4):
        replica.save_replica(replay.latest_state(rows.filter(F.col("op_no") % 4 == part)), path, part, **SAVES)
    return path


@query
def save_replica(spark, sf_dir):
    return replica.load_replica(spark, _saved(spark, sf_dir), 3)


@query
def stored_versions(spark, sf_dir):
    """Versions of some documents, looked up in the saved replica."""
    docs = fx.captured(spark, sf_dir).filter(F.col("op_no") % 300 == 7)
    return replica.stored_versions(spark, _saved(spark, sf_dir), 3, docs)


# --- reconciliation ----------------------------------------------------------------------


def _copies(spark, sf_dir):
    active = replay.live_docs(replay.latest_state(fx.captured(spark, sf_dir)))
    passive = replay.live_docs(replay.latest_state(fx.lagging(spark, sf_dir)))
    return active, passive


@query
def reconcile_docs(spark, sf_dir):
    return reconcile.reconcile_docs(*_copies(spark, sf_dir))


@query
def reconcile_by_digest(spark, sf_dir):
    return digests.reconcile_by_digest(*_copies(spark, sf_dir), bits=8, step=3)


@query
def reconcile_counts(spark, sf_dir):
    return reconcile.reconcile_counts(*_copies(spark, sf_dir))


@query
def spot_check(spark, sf_dir):
    return reconcile.spot_check(*_copies(spark, sf_dir), n=10)


def _lagging_checkpoint(spark, sf_dir):
    return checkpoint.checkpoint_update(replay.replay_verdicts(fx.lagging(spark, sf_dir)))


@query
def replication_lag(spark, sf_dir):
    return reconcile.replication_lag(fx.captured(spark, sf_dir), _lagging_checkpoint(spark, sf_dir))


@query
def sequence_gaps(spark, sf_dir):
    return reconcile.sequence_gaps(fx.lagging(spark, sf_dir))


# --- streams and status --------------------------------------------------------------------


@query
def replication_status(spark, sf_dir):
    producer = [
        capture.capture_metrics(fx.raw_ops(spark, sf_dir)),
        batching.backlog(fx.captured(spark, sf_dir), fx.lagging(spark, sf_dir)),
        batching.ship_metrics(_manifest(spark, sf_dir)),
    ]
    batches = _verdicts(spark, sf_dir).groupBy("batch_key").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("verdict") == "FAILED").alias("failed"),
        F.max("arrival").alias("polled_ms"),
    )
    return metrics.replication_status(spark, "producer", True, producer).unionByName(
        metrics.replication_status(spark, "consumer", True, [metrics.consumer_metrics(batches)])
    )


def _capturing(spark, sf_dir, root):
    """Run the capture stream over the operations and drain it."""
    fx.engine_ops(spark, sf_dir).write.parquet(f"{root}/ops")
    ops = spark.readStream.schema(spark.read.parquet(f"{root}/ops").schema).parquet(f"{root}/ops")
    run = capture_stream.run_capture_stream(
        ops, f"{root}/out", f"{root}/progress", age_ms=30 * DAY_MS, drain=True
    )
    run.awaitTermination()
    return run, f"{root}/out"


def _captured_by_stream(spark, sf_dir, root):
    return _capturing(spark, sf_dir, root)[1]


@query
def run_capture_stream(spark, sf_dir):
    out = _captured_by_stream(spark, sf_dir, scratch_dir(spark, "capture"))
    return changelog.read_change_log(spark, f"{out}/log").select(*CHANGES.fieldNames())


@query
def drain_on_stop(spark, sf_dir):
    """Batches announced by the time the drained stream has ended."""
    out = _captured_by_stream(spark, sf_dir, scratch_dir(spark, "drain"))
    manifest = spark.read.schema(NOTIFICATION).option("recursiveFileLookup", "true").json(f"{out}/manifest")
    return manifest.groupBy("index", "shard_id").agg(
        F.sum("event_count").alias("events"), F.max("to_seq_no").alias("last_seq_no")
    )


def _replayed(spark, sf_dir, root, rejected=None):
    """Capture a log and its manifest, and replay the batches the manifest announces."""
    out = _captured_by_stream(spark, sf_dir, root)
    reader = spark.readStream.option("recursiveFileLookup", "true")
    notes = reader.text(f"{out}/manifest").withColumnRenamed("value", "body")
    replay_stream.run_replay_stream(
        spark, f"{out}/log", f"{root}/passive", f"{root}/followed", 100, rejected, drain=True, notifications=notes
    ).awaitTermination()
    return f"{out}/log", f"{root}/passive"


@query
def run_replay_stream(spark, sf_dir):
    """Replica of a stream over files of up to 1,000 events per shard."""
    root = scratch_dir(spark, "replay")
    changelog.write_change_log(batching.batch_by_count(fx.captured(spark, sf_dir), 1000), f"{root}/log")
    replay_stream.run_replay_stream(
        spark, f"{root}/log", f"{root}/out", f"{root}/progress", drain=True
    ).awaitTermination()
    return replay_stream.read_replica(spark, f"{root}/out")


@query
def run_notified_replay(spark, sf_dir):
    """Replica of a stream of notifications; files are read by the names they give."""
    _, passive = _replayed(spark, sf_dir, scratch_dir(spark, "replay"))
    return replay_stream.read_replica(spark, passive)


@query
def retry_pending(spark, sf_dir):
    """A target that turns events down at first: in the end every batch is acknowledged and counted."""
    log, passive = _replayed(spark, sf_dir, scratch_dir(spark, "retry"), F.col("seq_no") % 41 == 5)
    replay_stream.retry_pending(spark, log, passive, max_files=100)
    done = replay_stream.read_batches(spark, passive)
    rows = [
        metrics.consumer_metrics(done).drop("last_poll_ms"),
        done.agg(F.sum("events").alias("events"), F.sum("failed").alias("failed")),
        replay_stream.read_pending(spark, passive).agg(F.count(F.lit(1)).alias("pending")),
    ]
    return metrics.metric_rows("consumer", rows)


@query
def safe_positions(spark, sf_dir):
    """Progress of a copy that is behind, kept as ranges over two parts of the deliveries."""
    rows = fx.lagging(spark, sf_dir)
    halves = [rows.filter(fx.before(0.3)), rows.filter(~fx.before(0.3))]
    seen = checkpoint.merge_ranges(*[checkpoint.sequence_ranges(h) for h in halves])
    return checkpoint.safe_positions(_lagging_checkpoint(spark, sf_dir), seen).select("index", "shard_id", "last_seq_no", "safe_seq_no")


@query
def gaps_between(spark, sf_dir):
    """The gaps of the running state, equal to those found in the events."""
    rows = fx.lagging(spark, sf_dir)
    halves = [rows.filter(fx.before(0.3)), rows.filter(~fx.before(0.3))]
    return checkpoint.gaps_between(checkpoint.merge_ranges(*[checkpoint.sequence_ranges(h) for h in halves]))


@query
def live_status(spark, sf_dir):
    """What a producer and a consumer that have run report of themselves."""
    root = scratch_dir(spark, "status")
    producer, out = _capturing(spark, sf_dir, root)
    notes = spark.readStream.option("recursiveFileLookup", "true").text(f"{out}/manifest").withColumnRenamed("value", "body")
    consumer = replay_stream.run_replay_stream(
        spark, f"{out}/log", f"{root}/passive", f"{root}/followed", 100, drain=True, notifications=notes
    )
    consumer.awaitTermination()
    rows = metrics.live_status(spark, "producer", producer, capture_stream.read_metrics(spark, out)).unionByName(
        metrics.live_status(spark, "consumer", consumer, replay_stream.read_metrics(spark, f"{root}/passive"))
    )
    return rows.filter(~F.col("metric").isin("last_poll_ms", "bytes_shipped", "last_trigger_ms"))
