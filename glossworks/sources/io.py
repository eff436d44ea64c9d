"""Readers and writers of the file formats; every table has an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossworks.functions.common import file_name, materialize, small, stem, sum_before


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """rows and bad_rows (line) of JSON lines; blank lines are left out; a missing file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema), spark.createDataFrame([], "line string")
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"), "value")
    good = lines.where(F.col("r._corrupt_record").isNull()).select("r.*").drop("_corrupt_record")
    return good, lines.where(F.col("r._corrupt_record").isNotNull()).select(F.col("value").alias("line"))


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath)
    return bool(found) and len(found) > 0


def json_entries(spark: SparkSession, path: str) -> DataFrame:
    """file, entry (from 0) and text of the top-level entries of JSON arrays or objects, one of them to a file of any size.

    Files are read in splits, cut at every comma. How many quotes and brackets a
    piece has tells, with the sums of the pieces before it, whether it begins
    within a string and how deep; pieces that begin outside strings at the first
    level begin an entry. Sums are made within splits and carried between them, so
    that no task sees more than a split, or an entry. A file whose brackets or
    quotes don't close fails.
    """
    raw = spark.read.option("lineSep", ",").text(path)
    pieces = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("seq"), "value")
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    outside = lambda text: F.regexp_replace(text, r"\"[^\"]*(\"|$)", "")
    count = lambda text, chars: (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")
    deeper = lambda text: count(text, "[{") - count(text, "]}")
    pieces = pieces.withColumns({"quotes": count(plain, '"'), "out": deeper(outside(plain)), "in": deeper(outside(F.concat(F.lit('"'), plain)))})
    pieces = materialize(pieces, "pieces")
    pieces = sum_before(pieces, "file", F.col("split"), "seq", "quotes", "quoted").withColumn("within", F.col("quoted") % 2 == 1)
    pieces = materialize(pieces.withColumn("delta", F.when(F.col("within"), F.col("in")).otherwise(F.col("out"))).drop("in", "out", "quoted"), "pieces")
    pieces = sum_before(pieces, "file", F.col("split"), "seq", "delta", "depth")
    pieces = materialize(pieces.withColumn("begins", ((F.col("depth") == 1) & ~F.col("within")).cast("long")), "pieces")
    whole = pieces.groupBy("file").agg(F.sum("begins").alias("last"), F.sum("delta").alias("open"), (F.sum("quotes") % 2).alias("odd"))
    whole = whole.withColumn("last", F.when((F.col("open") == 0) & (F.col("odd") == 0), F.col("last")).otherwise(F.raise_error(F.concat("file", F.lit(": brackets or quotes are left open"))).cast("long")))
    placed = sum_before(pieces, "file", F.col("split"), "seq", "begins").withColumn("entry", F.col("before") + F.col("begins"))
    texts = placed.groupBy("file", "entry").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "seq", "value"))), lambda x: x["value"]), ",").alias("text"))
    joined = texts.join(small(materialize(whole.select("file", "last"), "files")), "file")
    text = F.when(F.col("entry") == 0, F.regexp_replace("text", r"^\s*[\[{]", "")).otherwise(F.col("text"))
    text = F.when(F.col("entry") == F.col("last"), F.regexp_replace(text, r"[\]}]\s*$", "")).otherwise(text)
    return joined.select("file", "entry", text.alias("text")).where(F.trim(F.regexp_replace("text", r"\s", "")) != "")


def read_json_map(spark: SparkSession, path: str, value_type: str) -> DataFrame:
    """key, value of the entries of JSON objects, one object to a file. A malformed entry or file fails."""
    entries = json_entries(spark, path).select(F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), f"map<string,{value_type}>", {"mode": "FAILFAST"}).alias("m"))
    return entries.select(F.explode("m").alias("key", "value"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of JSON arrays, one array to a file. A malformed entry or file fails."""
    return json_entries(spark, path).select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, sep=sep, enforceSchema=False, multiLine=False)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Tab-separated whatever the file is called."""
    return read_csv(spark, path, schema, sep="\t")


def file_inventory(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """path, name, stem, dir, length, mtime of files that match and aren't empty; contents aren't read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    found = (reader.option("recursiveFileLookup", "true") if recursive else reader).load(root).where("length > 0")
    return found.select("path", file_name(F.col("path")).alias("name"), stem(F.col("path")).alias("stem"), F.regexp_extract("path", r"([^/]*)/[^/]*$", 1).alias("dir"), "length", F.col("modificationTime").alias("mtime"))


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.mode("overwrite").csv(path, header=True)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_lines(df: DataFrame, path: str, column: str) -> None:
    """One line for each row: line breaks within become spaces."""
    df.select(F.regexp_replace(F.col(column), r"[\r\n]+", " ").alias("value")).write.mode("overwrite").text(path)
