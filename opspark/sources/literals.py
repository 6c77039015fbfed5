"""Small fixed tables as local relations of known size."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows written in code, as a local relation: Spark knows its size and broadcasts it by itself."""
    struct = T.StructType.fromDDL(schema)
    names = struct.fieldNames()
    arrow = pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=to_arrow_schema(struct))
    return spark.createDataFrame(arrow, struct)
