"""Column sets and fixed schemas shared by every job."""

from pyspark.sql import types as T

INDEX, DELETE = "INDEX", "DELETE"
APPLIED, CONFLICT, FAILED = "APPLIED", "CONFLICT", "FAILED"

SHARD_KEY = ["index", "shard_id"]
# Sequence numbers are assigned per shard, so versions compare only inside one.
# The document id leads because it tells rows apart soonest when they are sorted by key.
DOC_KEY = ["id", "index", "shard_id"]

CHANGES = T.StructType(
    [
        T.StructField("index", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("seq_no", T.LongType()),
        T.StructField("primary_term", T.LongType()),
        T.StructField("op_type", T.StringType()),
        T.StructField("routing", T.StringType()),
        T.StructField("shard_id", T.IntegerType()),
        T.StructField("timestamp_ms", T.LongType()),
    ]
)

# Where a delivered change came from; together these give the arrival order.
ARRIVAL = ["arrival", "batch_key", "line_no"]
DELIVERIES = T.StructType(
    CHANGES.fields
    + [
        T.StructField("batch_key", T.StringType()),
        T.StructField("arrival", T.LongType()),
        T.StructField("line_no", T.LongType()),
    ]
)

REPLICA = T.StructType(
    [
        T.StructField("index", T.StringType()),
        T.StructField("shard_id", T.IntegerType()),
        T.StructField("id", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("seq_no", T.LongType()),
        T.StructField("primary_term", T.LongType()),
        T.StructField("op_type", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("routing", T.StringType()),
        T.StructField("timestamp_ms", T.LongType()),
    ]
)

NOTIFICATION = T.StructType(
    [
        T.StructField("s3_key", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("from_seq_no", T.LongType()),
        T.StructField("to_seq_no", T.LongType()),
        T.StructField("primary_term", T.LongType()),
        T.StructField("index", T.StringType()),
        T.StructField("shard_id", T.IntegerType()),
        T.StructField("payload_bytes", T.LongType()),
    ]
)

CHECKPOINTS = T.StructType(
    [
        T.StructField("index", T.StringType()),
        T.StructField("shard_id", T.IntegerType()),
        T.StructField("last_seq_no", T.LongType()),
        T.StructField("last_primary_term", T.LongType()),
        T.StructField("events_replayed", T.LongType()),
        T.StructField("last_updated_ms", T.LongType()),
    ]
)

# Delivered sequence numbers first .. last of a shard.
RANGES = T.StructType(
    [
        T.StructField("index", T.StringType()),
        T.StructField("shard_id", T.IntegerType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
    ]
)
