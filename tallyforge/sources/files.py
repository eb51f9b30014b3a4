"""Text-table sources and sinks that refuse to overwrite, with manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Every value a string, blanks for missing ones; nothing is inferred, so the file is read once."""
    reader = spark.read.option("header", True).option("encoding", encoding).option("multiLine", True).option("escape", '"')
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = reader.csv(path)
    return df.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns))


def read_probed(spark: SparkSession, path: str, columns: list[str] | None = None, fallback: str = "ISO-8859-1") -> DataFrame:
    """A CSV table as UTF-8, or in the fallback's encoding if some line isn't UTF-8."""
    broken = spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).count()
    return read_csv(spark, path, columns, fallback if broken else "UTF-8")


def read_optional(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A table that may be missing: then empty, with the declared columns.  The file system of the path is asked, not the driver's."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return read_csv(spark, path, columns)
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def read_unique(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A table whose key must be there, filled and unique; the check runs with the query that uses it."""
    df = read_csv(spark, path)
    if key not in df.columns:
        raise ValueError(f"no column {key}")
    df = df.select(*(F.trim(f"`{c}`").alias(c) for c in df.columns))
    bad = df.groupBy(key).count().where((F.col("count") > 1) | (F.col(key) == ""))
    fault = bad.agg(F.when(F.count("*") > 0, F.raise_error(F.concat(F.lit("blank or repeated key: "), F.min(key)))).alias("_fault"))
    return df.join(fault).where("_fault IS NULL").drop("_fault")


def last_row_wins(df: DataFrame, key: str, order: str, fold: bool = False) -> DataFrame:
    """Each key's last row; fold takes keys that differ in case or blanks for one."""
    df = df.withColumn(key, F.lower(F.trim(key))) if fold else df
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def write_once(df: DataFrame, path: str, form: str = "csv") -> None:
    """Fails if anything is there already."""
    flat = df.select(*(F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes)) if form == "csv" else df
    flat.write.mode("errorifexists").option("header", True).format(form).save(path)


def write_artifact(df: DataFrame, path: str) -> DataFrame:
    """Rows as JSON lines in a folder that must not exist yet, and the manifest of what was written."""
    write_once(df, path, "json")
    return manifest(df.sparkSession, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes and SHA-256 of each file below a folder, hashed where the files are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """Files that are missing, new or changed against a manifest."""
    now = manifest(spark, path).select("path", F.col("sha256").alias("now"))
    both = expected.select("path", "sha256").join(now, "path", "full")
    state = F.when(F.col("now").isNull(), "missing").when(F.col("sha256").isNull(), "new").when(F.col("now") != F.col("sha256"), "changed")
    return both.select("path", state.alias("state")).where("state IS NOT NULL")
