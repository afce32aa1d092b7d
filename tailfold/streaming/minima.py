"""Gathering carrier minima while chromosome results are still arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailfold import vocab
from tailfold.functions.values import strip, to_long
from tailfold.operators.carriers import minimum_distances


def arriving_minima(spark: SparkSession, folder, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of carrier rows from the TSV files dropped into ``folder``.

    Fields are split as the batch reader splits them, and a row that breaks one of its rules
    ends the stream.  Lines equal to the header are taken as the headers of their files.
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    header = "\t".join(vocab.MINIMA_COLUMNS)
    rows = reader.text(str(folder)).where(F.col("value") != header).select(
        "value", F.split("value", "\t").alias("f"))
    keys = [F.get("f", F.lit(i)).alias(n) for i, n in enumerate(vocab.MINIMA_KEYS)]
    distance = to_long(F.get("f", F.lit(5)))
    problem = F.coalesce(
        F.when(strip(F.col("value")) == "", "no content"),
        F.when(F.size("f") != 6, "not six columns"),
        F.when(F.exists(F.slice("f", 1, 5), lambda k: k == ""), "empty key fields"),
        F.when(distance.isNull() | (distance < 0),
               "a minimum_distance_bp that is not a non-negative integer"))
    stop = F.raise_error(F.concat(F.lit("carrier TSV line has "), problem, F.lit(": "), F.col("value")))
    return rows.select(*keys, F.when(problem.isNotNull(), stop.cast("bigint")).otherwise(distance)
                       .alias("minimum_distance_bp"))


def gathered_minima(stream: DataFrame) -> DataFrame:
    """The batch reduction on a stream; use output mode ``update`` or ``complete``.

    The minimum is idempotent, so a file that is delivered twice changes nothing.  The state holds
    one number per carrier key, for as long as the query runs: as many as the batch result has.
    """
    return minimum_distances(stream)
