"""Column expressions over change events: filters, sizes, versions and line formats."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from changelake.schema import INDEX

# Characters every event adds on top of its own strings.
EVENT_OVERHEAD = 100


def name_list(names: str | Iterable[str] | None) -> list[str]:
    """'a, b,,c ' or any iterable of names -> distinct, trimmed, non-blank names."""
    if names is None:
        return []
    parts = names.split(",") if isinstance(names, str) else names
    return sorted({p.strip() for p in parts if p and p.strip()})


def index_filter(
    include: str | Iterable[str] | None = None,
    exclude: str | Iterable[str] | None = None,
    index: str | Column = "index",
) -> Column:
    """True for collections to replicate.

    Dot-prefixed names never are, even when included. Exclusion is by exact name. A
    non-empty include list admits exact names and prefixes written as `prefix*`.
    """
    col = F.col(index) if isinstance(index, str) else index
    included, excluded = name_list(include), name_list(exclude)
    keep = ~col.startswith(".")
    if excluded:
        keep = keep & ~col.isin(excluded)
    if included:
        wanted = col.isin(included)
        for pattern in included:
            if pattern.endswith("*"):
                wanted = wanted | col.startswith(pattern[:-1])
        keep = keep & wanted
    return keep


def event_size() -> Column:
    """Estimated size of an event, as used to bound batches."""
    parts = [F.coalesce(F.length(c), F.lit(0)) for c in ("index", "id", "source", "routing")]
    return (F.lit(EVENT_OVERHEAD) + parts[0] + parts[1] + parts[2] + parts[3]).cast("long")


def version() -> Column:
    """External version of an event: sequence numbers start at 0, versions at 1."""
    return F.col("seq_no") + F.lit(1)


def batch_key(term: str | Column, first: str | Column, last: str | Column) -> Column:
    """`{index}/{shard}/{term}_{first}_{last}`."""
    span = F.concat_ws("_", *[F.col(c) if isinstance(c, str) else c for c in (term, first, last)])
    return F.concat_ws("/", F.col("index"), F.col("shard_id").cast("string"), span)


def base_path(path: str | None) -> str:
    """Key prefix: ends in one slash, does not start with one."""
    if not path:
        return ""
    path = path if path.endswith("/") else path + "/"
    return path[1:] if path.startswith("/") else path


def compact_json(col: Column) -> Column:
    """Drop whitespace between JSON tokens and leave string values as they are."""
    # A string literal is matched whole and put back; a whitespace run is dropped.
    tokens = r'(?s)("[^"\\]*+(?:\\.[^"\\]*+)*+")|[ \n\r\t]+'
    return F.when(col.rlike(r"[ \n\r\t]"), F.regexp_replace(col, tokens, "$1")).otherwise(col)


# Null fields are left out whatever the session says.
_NO_NULLS = {"ignoreNullFields": "true"}


def change_line() -> Column:
    """One change as a JSON line: fixed field order, body embedded raw, nulls left out."""
    head = F.to_json(F.struct("index", "id"), _NO_NULLS)
    tail = F.to_json(
        F.struct("seq_no", "primary_term", "op_type", "routing", "shard_id", "timestamp_ms"), _NO_NULLS
    )
    body = F.coalesce(F.concat(F.lit(',"source":'), compact_json(F.col("source"))), F.lit(""))
    return F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1), body, F.lit(","), F.substring(tail, F.lit(2), F.length(tail))
    )


def bulk_action() -> Column:
    """One change as bulk text: an action line and, for INDEX, the body on a second line, without line breaks."""
    action = F.to_json(
        F.struct(
            F.col("index").alias("_index"),
            F.col("id").alias("_id"),
            version().alias("version"),
            F.lit("external").alias("version_type"),
            F.col("routing"),
        ),
        _NO_NULLS,
    )
    verb = F.when(F.col("op_type") == INDEX, F.lit("index")).otherwise(F.lit("delete"))
    body = F.when(F.col("op_type") == INDEX, F.col("source"))
    return F.concat_ws("\n", F.concat(F.lit('{"'), verb, F.lit('":'), action, F.lit("}")), compact_json(body))
