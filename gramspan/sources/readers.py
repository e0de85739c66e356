"""Readers: CSV with a trailing target column, literal rows, parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramspan.sources.dataset import TabularDataset


def read_csv(spark: SparkSession, path: str, order_by=()) -> TabularDataset:
    """Read an all-numeric CSV with a header; the last column is the target.

    A field that is missing or not a number stops the query, whichever columns
    it selects; surplus fields at the end of a line are ignored.
    """
    options = dict(
        header=True,
        sep=",",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
        positiveInf="inf",
        negativeInf="-inf",
    )
    names = [c.strip() for c in spark.read.csv(path, **options).columns]
    if len(names) < 2:
        raise ValueError("a CSV needs at least one feature and the target")
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in names])
    raw = spark.read.csv(path, schema=schema, mode="PERMISSIVE", enforceSchema=True, **options)
    complete = F.lit(True)
    for c in names:
        complete = complete & F.col(c).isNotNull()
    broken = F.raise_error(F.lit(f"not a complete numeric row in {path}")).cast("double")
    df = raw.select(*[F.when(complete, F.col(c)).otherwise(broken).alias(c) for c in names])
    if raw.limit(1).count() == 0:
        raise ValueError(f"no data rows in {path}")
    return TabularDataset(df, names[:-1], label=names[-1], order_by=order_by)


def from_rows(
    spark: SparkSession, rows: Sequence[Sequence[float]], labels: Sequence[float] | None = None
) -> TabularDataset:
    """A dataset from literal rows: ``row_idx, x0..x{d-1}[, y]``."""
    if not len(rows):
        raise ValueError("input must have at least one sample")
    if labels is not None and len(labels) != len(rows):
        raise ValueError("features and labels must have the same length")
    d = len(rows[0])
    names = [f"x{j}" for j in range(d)]
    fields = [T.StructField("row_idx", T.LongType(), False)]
    fields += [T.StructField(c, T.DoubleType()) for c in names]
    data = [[i, *map(float, r)] for i, r in enumerate(rows)]
    if labels is not None:
        fields.append(T.StructField("y", T.DoubleType()))
        data = [[*r, float(v)] for r, v in zip(data, labels, strict=True)]
    df = spark.createDataFrame([tuple(r) for r in data], T.StructType(fields))
    return TabularDataset(df, names, "y" if labels is not None else None, ("row_idx",))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
