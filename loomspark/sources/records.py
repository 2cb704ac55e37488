"""Reading and writing record files.

Record files are JSON arrays. A file is read whole, parsed into a VARIANT and
exploded; malformed files give no rows, malformed records go to a quarantine
with a reason. The heterogeneous statement list becomes one row per statement.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

META = "array<struct<code_file:string,code_start_line:int,code_end_line:int,code_key:string,code_value:string,code_label:int,code_type:int,code_version:string>>"
META_REQUIRED = ("code_file", "code_start_line", "code_end_line", "code_key", "code_value")
META_KNOWN = (*META_REQUIRED, "code_label", "code_type", "code_version")
ROOTS = ("records", "data", "items", "results")
SCALARS = ("function_name", "orm_code", "caller", "source_file")


def read_files(spark: SparkSession, path, pattern: str = "*.json") -> DataFrame:
    """(source, content) of each file."""
    return spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.input_file_name().alias("source"), F.col("value").alias("content"))


def rows_of(files: DataFrame) -> DataFrame:
    """(source, pos, row variant): the root may be a list, an object holding one under a known name, or one object."""
    root = F.try_parse_json("content")
    as_list = lambda v: F.try_variant_get(v, "$", "array<variant>")
    named = [F.try_variant_get(root, f"$.{r}", "array<variant>") for r in ROOTS]
    found = F.coalesce(as_list(root), *named, F.when(F.schema_of_variant(root).startswith("OBJECT"), F.array(root)))
    return files.select("source", F.posexplode(found).alias("pos", "row"))


def map_rows(files: DataFrame) -> DataFrame:
    """(sample_id, row): a root that maps identifiers to rows; the last of a repeated one wins."""
    return files.select("source", F.expr("try_parse_json(content)").alias("v")).select("source", F.expr("try_variant_get(v, '$', 'map<string,variant>')").alias("m")).select("source", F.explode("m").alias("sample_id", "row"))


def _text(path: str, default: str = "") -> Column:
    return F.coalesce(F.try_variant_get("row", f"$.{path}", "string"), F.lit(default))


def align(rows: DataFrame) -> DataFrame:
    """The canonical eight fields with defaults, a list state, and why a record is rejected (null if it isn't)."""
    listed = F.try_variant_get("row", "$.sql_statement_list", "array<variant>")
    as_text = F.try_variant_get("row", "$.sql_statement_list", "string")
    meta = F.coalesce(F.try_variant_get("row", "$.code_meta_data", "array<variant>"), F.array().cast("array<variant>"))
    keys = lambda v: F.coalesce(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), F.array().cast("array<string>"))
    bad = F.exists(meta, lambda v: (F.size(F.array_except(F.array(*map(F.lit, META_REQUIRED)), keys(v))) > 0) | (F.size(F.array_except(keys(v), F.array(*map(F.lit, META_KNOWN)))) > 0))
    state = (
        F.when(listed.isNotNull() & (F.size(listed) == 0), "EMPTY")
        .when(listed.isNotNull() & (F.size(listed) == 1) & (F.try_variant_get("row", "$.sql_statement_list[0]", "string") == text.NO_SQL), "NO_SQL")
        .when(listed.isNotNull(), "LIST")
        .when(as_text == text.NO_SQL, "NO_SQL")
        .when(as_text == text.LACK_INFO, "LACK_INFO")
        .when(as_text.isNotNull() & ~F.schema_of_variant("row").rlike("sql_statement_list: OBJECT"), "STRING")
        .otherwise("OTHER")
    )
    return rows.select(
        F.concat_ws("#", "source", "pos").alias("record_id"), *[_text(c).alias(c) for c in SCALARS],
        F.coalesce(F.try_variant_get("row", "$.sql_types", "array<string>"), F.array().cast("array<string>")).alias("sql_types"),
        F.coalesce(F.try_variant_get("row", "$.sql_pattern_cnt", "int"), F.lit(0)).alias("sql_pattern_cnt"),
        F.coalesce(F.try_variant_get("row", "$.code_meta_data", META), F.array().cast(META)).alias("code_meta_data"),
        state.alias("list_state"), F.when(bad, "code_meta_data").alias("rejected"), F.col("row"),
    )


def items_of(aligned: DataFrame) -> DataFrame:
    """One row per statement text; nested lists are flattened one level, left to right."""
    whole = F.coalesce(F.try_variant_get("row", "$.sql_statement_list", "array<variant>"), F.array(F.try_variant_get("row", "$.sql_statement_list", "variant")))
    outer = aligned.where("rejected is null and list_state in ('LIST', 'STRING')").select("record_id", F.posexplode(whole).alias("item_pos", "item"))
    nested = F.coalesce(F.try_variant_get("item", "$", "array<variant>"), F.array("item"))
    flat = outer.select("record_id", "item_pos", F.posexplode(nested).alias("sub_pos", "item"))
    kind = F.upper(F.coalesce(F.try_variant_get("item", "$.type", "string"), F.lit("STRING")))
    variants = F.coalesce(F.try_variant_get("item", "$.variants", "array<variant>"), F.array("item"))
    opened = flat.withColumn("item_kind", kind).select("record_id", "item_pos", "sub_pos", "item_kind", F.posexplode(variants).alias("variant_pos", "v"))
    sql = F.coalesce(F.try_variant_get("v", "$.sql", "array<string>"), F.array(F.coalesce(F.try_variant_get("v", "$.sql", "string"), F.try_variant_get("v", "$", "string"))))
    return opened.select("record_id", "item_pos", "sub_pos", "item_kind", "variant_pos", F.try_variant_get("v", "$.scenario", "string").alias("scenario"), F.posexplode(sql).alias("sql_pos", "sql_text"))


def file_stats(aligned: DataFrame) -> DataFrame:
    return aligned.groupBy("source_file").agg(F.count("*").alias("n"), F.count_if(F.col("list_state").isin("LIST", "STRING")).alias("n_with_sql"), F.count("rejected").alias("n_rejected"))


def export_projection(records: DataFrame) -> DataFrame:
    """The CSV layout: code cut to 200 characters, types joined by bars, counts."""
    cut = lambda c: F.when(F.length(c) > 200, F.concat(F.left(c, F.lit(200)), F.lit("..."))).otherwise(F.col(c))
    return records.select("function_name", cut("orm_code").alias("orm_code"), "caller", F.array_join("sql_types", "|").alias("sql_types"), "n_statements", "source_file")


def write(df: DataFrame, path: str, kind: str) -> None:
    if kind == "json" or kind == "jsonl":
        df.write.json(path)
    elif kind == "csv":
        df.write.option("header", True).csv(path)
    elif kind == "parquet":
        df.write.parquet(path)
    else:
        raise ValueError(f"unknown format {kind!r}")


def write_by_keyword(tagged: DataFrame, path: str) -> None:
    """A folder per keyword; a record with several is in each."""
    tagged.withColumn("keyword", F.explode("matched_keywords")).write.partitionBy("keyword").json(path)


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """A folder per split, train and val, as Parquet."""
    df.write.partitionBy(split).parquet(path)


def write_dataset_info(spark: SparkSession, path: str, name: str, entry: dict) -> dict:
    """Adds an entry to the folder's dataset_info.json, a small file that names the datasets beside it; the other entries stay."""
    found = {}
    if any(True for _ in _existing(spark, f"{path}/dataset_info")):
        found = json.loads(spark.read.text(f"{path}/dataset_info", wholetext=True).first()["value"])
    whole = found | {name: entry}
    spark.createDataFrame([(json.dumps(whole, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/dataset_info")
    return whole


def input_warnings(files: DataFrame) -> DataFrame:
    """(source, item, problem) of generation inputs: a root of another kind, items that are no objects, items without code."""
    root = F.try_parse_json("content")
    kind = F.regexp_extract(F.schema_of_variant(root), r"^(\w+)", 1)
    named = F.transform(F.map_entries(F.try_variant_get(root, "$", "map<string,variant>")), lambda e: F.struct(e["key"].alias("item"), e["value"].alias("v"), F.lit(True).alias("named")))
    listed = F.transform(F.try_variant_get(root, "$", "array<variant>"), lambda v, i: F.struct(i.cast("string").alias("item"), v.alias("v"), F.lit(False).alias("named")))
    items = files.select("source", kind.alias("kind"), F.explode_outer(F.when(kind == "OBJECT", named).when(kind == "ARRAY", listed)).alias("e"))
    has_code = F.array_contains(F.map_keys(F.try_variant_get("e.v", "$", "map<string,variant>")), "code_value")
    is_object = F.schema_of_variant("e.v").startswith("OBJECT")
    problem = F.when(F.col("kind").isNull(), "unreadable").when(~F.col("kind").isin("OBJECT", "ARRAY"), "wrong_root").when(F.col("e").isNull(), None).when(~is_object, F.when(F.col("e.named"), "no_code").otherwise("not_an_object")).when(~F.coalesce(has_code, F.lit(False)), "no_code")
    return items.select("source", "e.item", problem.alias("problem")).where("problem is not null")


def write_sft(samples: DataFrame, folder: str, name: str) -> dict:
    """Writes samples (instruction, input, output, ...) as JSON lines below a folder and names them in its list of data sets."""
    write(samples, f"{folder}/{name}", "json")
    return write_dataset_info(samples.sparkSession, folder, name, {"file_name": name, "columns": {"prompt": "instruction", "query": "input", "response": "output"}})


def write_documents(docs: DataFrame, folder: str) -> str:
    """Writes (name, content) rows as files of these names below a folder, and gives the folder.

    Spark writes a part file a document into a folder of its own; the driver only
    renames these files. Names may have sub-folders; of equal names one document wins.
    """
    spark = docs.sparkSession
    once = docs.groupBy("name").agg(F.min("content").alias("content")).withColumn("slot", F.sha2("name", 256))
    made = f"{folder.rstrip('/')}/_made"
    once.repartition("slot").select("slot", "content").write.partitionBy("slot").option("lineSep", "\n").text(made)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    system = hadoop.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for r in once.select("name", "slot").collect():  # names alone
        to = hadoop.Path(f"{folder}/{r.name}")
        system.mkdirs(to.getParent())
        for status in system.listStatus(hadoop.Path(f"{made}/slot={r.slot}")):
            if status.getPath().getName().startswith("part-"):
                system.rename(status.getPath(), to)
    system.delete(hadoop.Path(made), True)
    return folder


def write_summary(df: DataFrame, path: str) -> None:
    """CSV with a header that begins with the byte order mark, as spreadsheet programs want it."""
    df.toDF("\ufeff" + df.columns[0], *df.columns[1:]).write.option("header", True).csv(path)


def field_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """(field, side): which top-level fields the rows (row variant) of two tables have: left, right, both."""
    names = lambda d, side: d.select(F.explode(F.map_keys(F.try_variant_get("row", "$", "map<string,variant>"))).alias("field")).distinct().withColumn(side, F.lit(True))
    met = names(left, "__l").join(names(right, "__r"), "field", "full")
    return met.select("field", F.when(F.col("__r").isNull(), "left").when(F.col("__l").isNull(), "right").otherwise("both").alias("side"))


def _existing(spark: SparkSession, path: str) -> list[str]:
    """The files below a path; none if it isn't there."""
    try:
        return spark.read.format("binaryFile").load(path).select("path").take(1)
    except AnalysisException:
        return []


def read_named(spark: SparkSession, folder: str, names: list[str]) -> tuple[DataFrame, list[str]]:
    """(source, content) of the named files of a folder, and the names that aren't there."""
    there = [n for n in names if _existing(spark, f"{folder}/{n}")]
    found = spark.read.text([f"{folder}/{n}" for n in there], wholetext=True) if there else spark.createDataFrame([], "value string")
    files = found.select(F.input_file_name().alias("source"), F.col("value").alias("content"))
    return files, sorted(set(names) - set(there))


def removed_fields(rows: DataFrame, known: tuple[str, ...]) -> DataFrame:
    """(field, n): how many records have each field that the canonical ones lack."""
    keys = F.explode(F.map_keys(F.try_variant_get("row", "$", "map<string,variant>"))).alias("field")
    return rows.select(keys).where(~F.col("field").isin(*known)).groupBy("field").agg(F.count("*").alias("n"))
