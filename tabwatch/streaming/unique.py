"""Key uniqueness on a stream (B6 on the J2 path).

A batch marks every row of a repeated key; a stream can't, since the first row is gone when the
second comes. Here the first row of a key passes and each later one is marked, across micro-batches
and restarts, as long as the key's state is kept: ``within`` after its last row. The clock is the
arrival time that Spark logs for each micro-batch, with a watermark ``within`` behind it. So
no row is late, whatever its own times, unless that clock goes back by more than ``within``, and
a stream that runs until its source is empty ends (a processing-time timer would keep it going)."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StructField, StructType

from tabwatch.operators.contracts import VIOLATIONS, Contract, _no_null, _unique_keys, with_violations

NULL_GROUPS = 1024  # groups that rows with a NULL in their key are dealt to


def _nested(t: DataType) -> bool:
    return isinstance(t, (ArrayType, MapType, StructType))


def _text(f: StructField) -> Column:
    """A value as text that gives it back: rows pass Python as they are, whatever their types."""
    col = F.col(f"`{f.name}`")
    if _nested(f.dataType):
        return F.when(col.isNotNull(), F.to_json(F.struct(col.alias("v")), {"ignoreNullFields": "false"}))
    return F.base64(col) if isinstance(f.dataType, BinaryType) else col.cast("string")


def _value(text: Column, f: StructField) -> Column:
    if _nested(f.dataType):
        return F.from_json(text, StructType([StructField("v", f.dataType)]))["v"]
    return F.unbase64(text) if isinstance(f.dataType, BinaryType) else text.cast(f.dataType)


def _mark(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    keyed, seen, arrived = group[0] is not None, state.exists, None
    for part in parts:
        repeated = [keyed] * len(part)
        if len(part):
            repeated[0], seen, arrived = keyed and seen, True, int(part["ms"].iloc[0])
        yield pd.DataFrame({"row": part["row"], "repeated": repeated})
    if keyed and arrived is not None:
        state.update((True,))
        state.setTimeoutTimestamp(arrived)  # the watermark reaches it ``within`` later


def mark_repeats(stream: DataFrame, key: Sequence[str], name: str, within: str) -> DataFrame:
    """``stream`` with a boolean column ``name``: whether an earlier row had the same key (compared by
    its text). Rows with a NULL in the key are never marked and keep no state. Of rows of one key in one
    micro-batch any one is the first. ``within`` is an interval text of a second at least. The stream may
    hold no other stateful step after this one."""
    fields = stream.schema.fields
    if pd.Timedelta(within) < pd.Timedelta("1 second"):
        raise ValueError(f"within must be a second or more; got {within!r}")
    whole = F.array(*[_text(f) for f in fields])
    has_key = _no_null(key)
    packed = stream.select(
        F.current_timestamp().alias("at"), F.unix_millis(F.current_timestamp()).alias("ms"),
        F.when(has_key, F.to_json(F.array(*[F.col(k).cast("string") for k in key]))).alias("k"),
        F.when(~has_key, F.pmod(F.xxhash64(whole), F.lit(NULL_GROUPS))).alias("part"), whole.alias("row"))
    marked = packed.withWatermark("at", within).groupBy("k", "part").applyInPandasWithState(
        _mark, "row array<string>, repeated boolean", "seen boolean", "append", GroupStateTimeout.EventTimeTimeout)
    return marked.select(*[_value(F.col("row")[i], f).alias(f.name) for i, f in enumerate(fields)],
                         F.col("repeated").alias(name))


def stream_violations(stream: DataFrame, contract: Contract, within: str | None) -> DataFrame:
    """``with_violations`` for a stream: row rules as there, uniqueness by ``mark_repeats``. A contract
    with a unique rule needs ``within``; one with several is refused (a stream holds one such state)."""
    unique = _unique_keys(contract)
    if not unique:
        return with_violations(stream, contract)
    if not within:
        raise ValueError(f"contract {contract.name} has unique keys; give unique_within, the time a key is remembered")
    if len(unique) > 1:
        raise ValueError(f"contract {contract.name} has {len(unique)} unique keys; a stream checks one")
    rows_only = dataclasses.replace(contract, unique=(), columns=tuple(
        dataclasses.replace(c, unique=False) for c in contract.columns))
    out = with_violations(stream, rows_only)
    rule, _, key = unique[0]
    return mark_repeats(out, key, "_dup_0", within).withColumn(
        VIOLATIONS, F.concat(VIOLATIONS, F.when(F.col("_dup_0"), F.array(F.lit(rule))).otherwise(F.array()))).drop("_dup_0")
