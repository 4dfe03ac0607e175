"""Small frames by hand."""

from pyspark.sql import types as T

from changelake.schema import CHANGES, DELIVERIES

OPS = T.StructType(
    [
        T.StructField("result_type", T.StringType()),
        *CHANGES.fields,
        T.StructField("op_no", T.LongType()),
    ]
)


def change(id="d1", seq=0, op="INDEX", source='{"a":1}', index="logs", shard=0, term=1, routing=None, ts=0):
    return {
        "index": index,
        "id": id,
        "source": source if op == "INDEX" else None,
        "seq_no": seq,
        "primary_term": term,
        "op_type": op,
        "routing": routing,
        "shard_id": shard,
        "timestamp_ms": ts,
    }


def delivery(arrival, batch="b0", line=0, **kw):
    return change(**kw) | {"arrival": arrival, "batch_key": batch, "line_no": line}


def changes(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in CHANGES.fieldNames()) for r in rows], CHANGES)


def deliveries(spark, rows):
    names = DELIVERIES.fieldNames()
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], DELIVERIES)


def ops(spark, rows):
    """Rows (op_no, result, change)."""
    names = CHANGES.fieldNames()
    return spark.createDataFrame(
        [(result, *(c[n] for n in names), op_no) for op_no, result, c in rows], OPS
    )


def tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
