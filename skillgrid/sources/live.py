"""Live sample (S8): landed search responses -> flat ``job_ads`` rows.

The HTTP fetch itself is outside Spark; responses are landed as JSON files
(one response object with a ``hits`` array per file). Nested objects are
flattened with ``__`` separators (``description.text`` -> ``description__text``).
All landed hits are kept unless a sample size is asked for; then the first hits
in the order of file and position form the sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_structs(df: DataFrame, sep: str = "__") -> DataFrame:
    """Expand struct columns recursively into ``parent{sep}child`` columns."""

    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for field in dtype.fields:
                yield from walk(field.dataType, path + [field.name])
        else:
            yield F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))

    cols = [c for f in df.schema.fields for c in walk(f.dataType, [f.name])]
    return df.select(*cols)


def landed_hits(
    spark: SparkSession,
    path: str,
    limit: int | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Hits of landed search responses, flattened; ``limit`` keeps the first N by file and position."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    hits = reader.json(path).select(F.col("_metadata.file_path").alias("file"), F.posexplode("hits").alias("at", "hit"))
    if limit is not None:
        hits = hits.orderBy("file", "at").limit(limit)
    return flatten_structs(hits.select("hit.*"))
