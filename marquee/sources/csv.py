"""Raw CSV source: every column as text, null tokens applied."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from marquee.functions.text import PANDAS_NULL_TOKENS, nullify_tokens


def read_raw_csv(spark: SparkSession, path: str | Sequence[str],
                 columns: Sequence[str] | None = None, multi_line: bool = True,
                 null_tokens: Iterable[str] | None = PANDAS_NULL_TOKENS,
                 encoding: str = "UTF-8") -> DataFrame:
    """Headered CSV (one file, a folder or a glob) read as all-string columns.

    * no ``inferSchema``: it costs a full extra pass; typing happens in the
      tolerant casts of the cleaning step instead.
    * ``escape='"'`` parses doubled quotes; ``multi_line`` keeps newlines in
      quoted fields but makes each file one split, so large inputs should
      arrive as many files (or pass ``multi_line=False``).
    * every file's header is held against the expected columns
      (``enforceSchema=false``): a file with another order or another set of
      columns fails the read instead of landing in the wrong columns. Without
      ``columns`` the first file's header is the expectation.
    * exact null tokens (pandas defaults) become NULL in every column.
    """
    reader = (spark.read.option("header", True).option("escape", '"')
              .option("multiLine", multi_line).option("encoding", encoding)
              .option("mode", "PERMISSIVE"))
    path = list(path) if not isinstance(path, str) else path
    if not columns:
        columns = reader.option("inferSchema", False).csv(path).columns     # reads one header line
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return nullify_tokens(reader.schema(schema).option("enforceSchema", False).csv(path), null_tokens)


def extract_csv(spark: SparkSession, location: str, key: str = "movies.csv", **kw) -> DataFrame:
    """The extract step: ``{location}/{key}`` on any Hadoop file system
    (``s3a://bucket``, ``hdfs://…``, a local folder). Credentials come from
    the cluster's file-system configuration, not from the job."""
    return read_raw_csv(spark, f"{location.rstrip('/')}/{key}", **kw)
