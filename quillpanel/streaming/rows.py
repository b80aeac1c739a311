"""Row-local operators on streams: what needs no other row runs unchanged on a streaming table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillpanel.operators.clean import clear_artifacts, strip_missing_code
from quillpanel.operators.packed import PackedField, unpack_values
from quillpanel.session import qcol


def clean_rows(df: DataFrame) -> DataFrame:
    """Artifacts and missing codes of all text columns off; no profiling, so types stay."""
    return df.select(*((strip_missing_code(clear_artifacts(qcol(c))).alias(c) if k == "string" else qcol(c)) for c, k in df.dtypes))


def unpack_stream(df: DataFrame, key: str, fields: Mapping[str, PackedField]) -> DataFrame:
    return unpack_values(df, key, fields)


def late_duplicates(df: DataFrame, keys: list[str], arrived: str, delay: str) -> DataFrame:
    """Each key once, among rows that come within ``delay`` of the newest; state is dropped behind the watermark."""
    return df.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(keys)


def write_table(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def with_arrival(df: DataFrame, name: str = "arrived") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())
