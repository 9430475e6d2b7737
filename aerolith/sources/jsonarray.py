"""JSON array files read by many tasks.

A file that holds one top-level array of records is read as text that ends at
every closing brace, which Spark splits by bytes like lines. Where the records
begin and end follows from running sums over these pieces, in built-in functions
only:

1. *Strings.* A piece's quotes that are not escaped are counted. The sum over all
   pieces before says whether a piece begins inside a string. (An escape cannot
   reach over a border: a backslash before a brace is no JSON.)
2. *Depth.* With that known, strings are cut out of the piece and its brackets
   and braces are summed to the depth after it.
3. *Records.* A record ends with the brace that leads back to depth 1. The pieces
   between two such ends are one record, put together again.

Each running sum has two levels, inside a split and over the splits before, so a
file's splits are worked on side by side; what meets in one task is a split, one
number per split, or a record.

A file that is not one whole array of objects fails the job, naming the file:
text before or after the array, an array, string or record that does not end, a
missing comma, an element that is no object, an object that is no JSON. A file of
no bytes holds no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.operators.validation import RECORD_REF
from aerolith.session import materialize
from aerolith.sources.raw import read_json_array_file, require_path

SPLIT = ["file", "split"]


def _occurrences(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _with_running(table: DataFrame, value: str, out: str, upto: int) -> DataFrame:
    """``out``: the sum of ``value`` over all pieces of the file up to this one
    (``upto`` 0) or before it (-1)."""
    per_split = table.groupBy(*SPLIT).agg(F.sum(value).alias("_split_sum"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_split.select(*SPLIT, F.coalesce(F.sum("_split_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*SPLIT).orderBy("seq").rowsBetween(Window.unboundedPreceding, upto)
    here = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return table.withColumn(out, here).join(starts, SPLIT).withColumn(out, F.col(out) + F.col("_start")).drop("_start")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, seq, text, bare (without escapes), quotes``."""
    text = spark.read.option("lineSep", "}").text(path)
    rows = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("text"),
    )
    bare = F.regexp_replace("text", r"(?s)\\.", "")
    return rows.withColumn("bare", bare).withColumn("quotes", _occurrences(F.col("bare"), '"'))


def _ends(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ends``: 1 where the brace after a piece ends a record."""
    known = _with_running(pieces, "quotes", "_quotes", -1)
    begins_inside = F.col("_quotes") % 2 == 1
    ends_inside = (F.col("_quotes") + F.col("quotes")) % 2 == 1
    whole = F.concat(F.when(begins_inside, F.lit('"')).otherwise(F.lit("")), F.col("bare"), F.when(ends_inside, F.lit('"')).otherwise(F.lit("")))
    outside = F.regexp_replace(whole, '"[^"]*+"', "")
    change = sum(_occurrences(F.col("outside"), c) for c in "{[") - sum(_occurrences(F.col("outside"), c) for c in "]")
    after = F.when(F.col("inside"), F.lit(0)).otherwise(F.lit(-1))  # the closing brace itself
    stepped = known.withColumn("outside", outside).withColumn("inside", ends_inside)
    stepped = materialize(stepped.select(*SPLIT, "seq", "text", "inside", (change + after).alias("change")), "array-pieces")
    deep = _with_running(stepped, "change", "depth", 0)
    return deep.select(*SPLIT, "seq", "text", ((F.col("depth") == 1) & ~F.col("inside")).cast("long").alias("ends"))


def read_json_array_splits(spark: SparkSession, path: str) -> DataFrame:
    """The records of ``read_json_array_file``, each file cut into as many
    splits as ``spark.sql.files.maxPartitionBytes`` makes."""
    require_path(spark, path, "raw")
    pieces = materialize(_ends(_pieces(spark, path)), "array-ends")
    last = pieces.groupBy("file").agg(F.max(F.struct("split", "seq")).alias("_last"))
    marked = pieces.join(last, "file").withColumn("tail", F.struct("split", "seq") == F.col("_last")).drop("_last")
    # What follows the last brace of a file ends no record, whatever its depth.
    marked = marked.withColumn("ends", F.when(F.col("tail"), F.lit(0).cast("long")).otherwise(F.col("ends")))
    numbered = _with_running(marked, "ends", "number", -1)
    piece = F.struct("split", "seq", F.concat("text", F.when(F.col("tail"), F.lit("")).otherwise(F.lit("}"))).alias("text"))
    whole = numbered.groupBy("file", "number").agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.max("ends").alias("ends"))
    text = F.array_join(F.transform("pieces", lambda p: p["text"]), "")
    first, later = (F.regexp_extract("whole", rf"(?s)\A\s*{c}\s*(\{{.*)\z", 1) for c in (r"\[", ","))
    record = F.when(F.col("number") == 0, first).otherwise(later)
    finishes = F.when(F.col("number") == 0, F.lit(r"\A\s*\[\s*\]\s*\z")).otherwise(F.lit(r"\A\s*\]\s*\z"))
    sound = F.when(F.col("ends") == 1, (record != "") & F.try_parse_json(record).isNotNull()).otherwise(F.rlike("whole", finishes))
    broken = F.raise_error(F.concat(F.lit("Not a JSON array of records: "), F.col("file")))
    kept = F.when(F.coalesce(sound, F.lit(False)), F.col("ends") == 1).otherwise(broken.cast("boolean"))
    return whole.withColumn("whole", text).where(kept).select(
        record.alias("value"), F.col("number").cast("string").alias(RECORD_REF), F.col("file").alias("_source_file")
    )


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """S1 for array files of any size: files of one split each are read whole,
    larger ones by all their splits."""
    require_path(spark, path, "raw")
    largest = spark.read.format("binaryFile").load(path).select("length").agg(F.max("length")).first()[0] or 0
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    split = as_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return read_json_array_file(spark, path) if largest <= split else read_json_array_splits(spark, path)
