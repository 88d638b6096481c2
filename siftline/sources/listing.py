"""Files by what Spark's own listing says of them, on any storage that Spark reads. Contents are not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as listings spell it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString().rstrip("/")


def files(spark: SparkSession, folder: str) -> DataFrame:
    """path, length (bytes) and modified (time) of every file below the folder. Hidden names (_x, .x) and empty files
    are left out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def spelled(spark: SparkSession, path: Column) -> Column:
    """A column of paths as listings spell them: those without a scheme get the default one."""
    default = spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).toString().rstrip("/")
    default = "file:" if default.startswith("file:") else default
    plain = F.regexp_replace(path, "^file://+", "file:/")
    return F.when(plain.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), plain).otherwise(F.concat(F.lit(default), plain))


def identities(df: DataFrame, listed: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds a struct(path, length, modified) for each named column of paths; a file that is not listed has no length and
    no time."""
    spark = df.sparkSession
    for name, path in columns.items():
        own = listed.select(F.col("path").alias(f"_path_{name}"), F.col("length").alias(f"_length_{name}"), F.col("modified").alias(f"_modified_{name}"))
        df = df.withColumn(f"_at_{name}", spelled(spark, path)).join(own, F.col(f"_at_{name}") == F.col(f"_path_{name}"), "left")
        what = F.struct(F.col(f"_at_{name}").alias("path"), F.col(f"_length_{name}").alias("length"), F.unix_micros(f"_modified_{name}").alias("modified"))
        df = df.withColumn(name, what).drop(*[f"_{part}_{name}" for part in ("at", "path", "length", "modified")])
    return df
