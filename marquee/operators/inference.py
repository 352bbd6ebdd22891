"""Column types from one pass over text columns.

Each value belongs to one class (null word, integer, long, number, date, truth
value, text). Counting the classes of every column is one aggregate over one
read, whatever the number of columns, and the counts of files, batches or
partitions add up; the column's type follows from the counts alone:

    int < bigint < double < string        date < string        boolean < string

The narrowest type that holds every value is the least upper bound of the
classes present; a column of null words only is ``void``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from marquee.functions.numeric import tolerant_double
from marquee.functions.text import PANDAS_NULL_TOKENS, nullify_tokens, quoted

CLASSES = ("null", "int", "bigint", "double", "date", "boolean", "string")
WHOLE = r"^\s*[+-]?\d+\s*$"
DATE = r"^\d{4}-\d{2}-\d{2}$"
# The words that pandas reads as truth values.
TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")


def value_class(c: Column) -> Column:
    """The class of a text value whose null words are nulls already."""
    whole = c.rlike(WHOLE)
    plain = F.trim(c)
    return (F.when(c.isNull(), "null")
            .when(whole & plain.try_cast("int").isNotNull(), "int")
            .when(whole & plain.try_cast("bigint").isNotNull(), "bigint")
            .when(tolerant_double(c).isNotNull(), "double")
            .when(c.rlike(DATE) & c.try_cast("date").isNotNull(), "date")
            .when(c.isin(*TRUTH), "boolean")
            .otherwise("string"))


def class_counts(raw: DataFrame, columns: Sequence[str] | None = None, null_tokens: Iterable[str] | None = PANDAS_NULL_TOKENS) -> DataFrame:
    """(column, n_null, n_int, ... n_string): one row a text column, one pass."""
    names = [f.name for f in raw.schema.fields if isinstance(f.dataType, StringType) and (columns is None or f.name in columns)]
    df = nullify_tokens(raw.select(*map(quoted, names)), null_tokens)
    classes = df.select(*[value_class(F.col(quoted(c))).alias(f"c{i}") for i, c in enumerate(names)])
    counts = classes.agg(*[F.struct(F.lit(c).alias("column"), *[F.count_if(F.col(f"c{i}") == k).alias(f"n_{k}") for k in CLASSES]).alias(f"c{i}")
                           for i, c in enumerate(names)])
    return counts.select(F.inline(F.array(*[f"c{i}" for i in range(len(names))])))


def merge_counts(counts: Iterable[DataFrame]) -> DataFrame:
    """Counts of several files or batches added up."""
    out = None
    for df in counts:
        out = df if out is None else out.unionByName(df)
    return out.groupBy("column").agg(*[F.sum(f"n_{k}").alias(f"n_{k}") for k in CLASSES])


def narrowest(with_text: bool = True) -> Column:
    """The least upper bound of the classes that occur; ``with_text=False``
    leaves out what is no number, as a tolerant cast would."""
    n = {k: F.col(f"n_{k}") > 0 for k in CLASSES}
    number = F.when(n["double"], "double").when(n["bigint"], "bigint").when(n["int"], "int")
    if not with_text:
        return number
    numbers = n["int"] | n["bigint"] | n["double"]
    several = (numbers.cast("int") + n["date"].cast("int") + n["boolean"].cast("int")) > 1
    return (F.when(n["string"] | several, "string").when(numbers, number)
            .when(n["date"], "date").when(n["boolean"], "boolean").otherwise("void"))


def inferred_types(counts: DataFrame) -> DataFrame:
    """(column, type, n_null, n_bad, clean_type): ``n_bad`` are the values that
    keep a column from being numeric although most of its values are numbers,
    ``clean_type`` its type without them."""
    numbers = F.col("n_int") + F.col("n_bigint") + F.col("n_double")
    others = F.col("n_date") + F.col("n_boolean") + F.col("n_string")
    mostly = numbers > others
    return counts.select("column", narrowest().alias("type"), "n_null", F.when(mostly, others).otherwise(F.lit(0)).cast("long").alias("n_bad"),
                         F.when(mostly, narrowest(False)).otherwise(narrowest()).alias("clean_type"))


def typed(raw: DataFrame, types: DataFrame, clean: bool = True, null_tokens: Iterable[str] | None = PANDAS_NULL_TOKENS) -> DataFrame:
    """``raw`` cast to the inferred types (one row a column comes to the
    driver); with ``clean``, bad values become nulls."""
    chosen = {r["column"]: r["clean_type" if clean else "type"] for r in types.collect()}
    df = nullify_tokens(raw, null_tokens)

    def cast(c: str) -> Column:
        col = F.col(quoted(c))
        to = chosen.get(c, "string")
        if to == "double":
            return tolerant_double(col)
        return col if to in ("string", "void") else F.trim(col).try_cast(to)

    return df.select(*[cast(c).alias(c) for c in df.columns])
