"""Searching folders in whatever store Spark reaches: which files there are, which of them count, and in what order.

The listing is a table (path, folder, name, modified, bytes, is_folder), taken from Hadoop's file system as Spark's own
readers take theirs, without opening any file; searches are filters and groupings of it. Only names pass through the
driver, as they do in any read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import records

LISTED = "path string, folder string, name string, modified timestamp, bytes long, is_folder boolean"
# Where generated statements lie in a mapping folder; names of reports, the first one there counts.
GENERATED = "sql_generation"
REPORTS = ("statistics_summary.json", "evaluation_summary.json")
COMPARISONS = ("comparative_results.json",)


def listing(spark: SparkSession, folder: str, deep: bool = True) -> DataFrame:
    """All files and folders below a folder, hidden ones (._) aside; none if it isn't there."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    todo, rows = [top] if system.exists(top) else [], []
    while todo:
        for status in system.listStatus(todo.pop()):
            at, inner = status.getPath(), status.isDirectory()
            if at.getName()[:1] in "._":
                continue
            rows.append((at.toString(), at.getParent().toString(), at.getName(), status.getModificationTime(), status.getLen(), inner))
            if inner and deep:
                todo.append(at)
    found = spark.createDataFrame(rows, LISTED.replace("timestamp", "long"))
    return found.withColumn("modified", F.timestamp_millis("modified"))


def inside(files: DataFrame, root: str) -> DataFrame:
    """Adds ``rest``: the path from the named root on, without a slash in front; other files go."""
    at = F.instr("path", F.lit(root.rstrip("/") + "/"))
    return files.where(at > 0).withColumn("rest", F.substring("path", at + len(root.rstrip("/")) + 1, F.length("path")))


def mapping_files(files: DataFrame, root: str) -> DataFrame:
    """The JSON files of each mapping folder right below ``root``: those of its sub-folder of generated statements if it has one, else its own. Deeper ones don't count."""
    own = inside(files, root).withColumn("mapping", F.regexp_extract("rest", "^([^/]+)/", 1)).withColumn("inner", F.regexp_extract("rest", "^[^/]+/(.*)$", 1)).where("mapping <> ''")
    there = F.max(F.col("is_folder") & (F.col("inner") == GENERATED)).over(Window.partitionBy("mapping"))
    wanted = F.when(there, F.col("inner").rlike(f"^{GENERATED}/[^/]+$")).otherwise(F.col("inner").rlike("^[^/]+$"))
    return own.withColumn("wanted", wanted).where("wanted and not is_folder and name like '%.json'").select("mapping", *files.columns)


def reports(files: DataFrame, root: str, names: tuple[str, ...] = REPORTS) -> DataFrame:
    """(place, run, path): the report of each run folder right below ``root``, the run changed last first; of several names the first that is there.

    Of runs changed at the same time the last by name comes first.
    """
    own = inside(files, root).withColumn("run", F.regexp_extract("rest", "^([^/]+)", 1))
    rank = F.when(~F.col("is_folder") & F.col("rest").rlike("^[^/]+/[^/]+$"), F.array_position(F.array(*map(F.lit, names)), F.col("name")))
    best = own.groupBy("run").agg(F.max(F.when(F.col("is_folder") & (F.col("rest") == F.col("run")), F.col("modified"))).alias("modified"), F.min_by("path", F.when(rank > 0, rank)).alias("path"))
    return best.where("path is not null").withColumn("place", F.row_number().over(Window.orderBy(F.desc("modified"), F.desc("run")))).select("place", "run", "path")  # a row a run


def logs(files: DataFrame, suffix: str = ".jsonl") -> DataFrame:
    """(place, run, path): log files, the newest first, named after themselves."""
    own = files.where(~F.col("is_folder") & F.endswith("name", F.lit(suffix))).withColumn("run", F.regexp_replace("name", r"\.[^.]*$", ""))
    return own.withColumn("place", F.row_number().over(Window.orderBy(F.desc("modified"), F.desc("run")))).select("place", "run", "path")


def first_named(files: DataFrame, names: list[str]) -> str | None:
    """The path of the first of several names that is there."""
    place = F.array_position(F.array(*map(F.lit, names)), F.col("name"))
    found = files.where((place > 0) & ~F.col("is_folder")).agg(F.min_by("path", F.struct(place, "path")).alias("path")).first()
    return found.path if found else None


def read(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(source, content) of the listed files."""
    paths = [r.path for r in files.select("path").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], "source string, content string")
    return spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("source"), F.col("value").alias("content"))


def in_order(rows: DataFrame, n: int | None = None) -> DataFrame:
    """Rows (source, pos, ...) numbered from 0 over all files in the order of their paths; the first ``n`` if given.

    Files are counted first and the counts added up, so a row's number is its
    place in its file plus the rows before that file: nothing is sorted but a row a file.
    """
    counts = rows.groupBy("source").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumn("__before", before).drop("__n")
    if n is not None:
        starts = starts.where(F.col("__before") < n)
    met = rows.join(starts, "source").withColumn("number", F.col("__before") + F.col("pos")).drop("__before")
    return met if n is None else met.where(F.col("number") < n)


def load(spark: SparkSession, folder: str, head: int | None = None) -> DataFrame:
    """(source, pos, row, number): the records of the lists in the JSON files right in a folder, in file order; files that hold no list are left out."""
    own = listing(spark, folder, deep=False).where("not is_folder and name like '%.json'")
    files = read(spark, own)
    listed = files.where(F.schema_of_variant(F.try_parse_json("content")).startswith("ARRAY"))
    return in_order(records.rows_of(listed), head)
