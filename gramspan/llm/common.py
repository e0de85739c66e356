"""What the operators of this package share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramspan.session import ensure_checkpoint_dir

# A word: a maximal run of anything but ASCII white space, as a pattern of the JVM.
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession) -> str:
    """The shared folder for tables between the steps of an operator."""
    return ensure_checkpoint_dir(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several steps read the same rows: they are computed once, and a
    lost executor costs no more than reading a file again. Spark frees the
    shuffle files of a finished write when the driver collects its garbage,
    which a driver that does little seldom does by itself.
    """
    path = f"{scratch(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    df.sparkSession._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` as long and the text as UTF-8 bytes; a null text is empty."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.select(F.col(key).cast("long").alias(key), body.alias(text))
