"""Image bytes. The codec itself is the caller's: none is part of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def transcoded(df: DataFrame, content: str, make_codec: Callable[[], Callable[[bytes], tuple[bytes, int, int] | None]]) -> DataFrame:
    """df with the encoded bytes in place of the content, and width, height and reason.

    make_codec gives a task its function of bytes, which returns the encoded bytes with width and height, or
    None for what it can't decode; then reason says not_decodable. Null or empty content is empty_body.
    """
    import pyarrow as pa

    place = df.columns.index(content)

    def run(batches):
        codec = make_codec()
        for batch in batches:
            found, reasons = [], []
            for data in batch.column(place).to_pylist():
                made = codec(data) if data else None
                found.append(made or (None, None, None))
                reasons.append(None if made else "not_decodable" if data else "empty_body")
            columns = list(batch.columns)
            columns[place] = pa.array([x[0] for x in found], pa.binary())
            added = [pa.array([x[1] for x in found], pa.int32()), pa.array([x[2] for x in found], pa.int32()), pa.array(reasons, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *added], [*batch.schema.names, "width", "height", "reason"])

    added = [T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("reason", T.StringType())]
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *added]))
