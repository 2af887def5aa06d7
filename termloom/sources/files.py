"""Plain sources: metadata CSV, retry lists, configuration, documents in JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The columns of the metadata CSV, which has no header.
CSV_COLUMNS = ("name", "profile_url", "date", "description", "system", "terminal", "shell", "title", "url", "views")


def read_metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows as records: author nested, dates without T and Z, views as a number."""
    schema = ", ".join(f"{c} string" for c in CSV_COLUMNS)
    rows = spark.read.csv(path, schema=schema, header=False, multiLine=True, quote='"', escape='"')
    filled = rows.select([F.coalesce(c, F.lit("")).alias(c) for c in CSV_COLUMNS])
    return filled.select("url", "title", F.struct("name", "profile_url").alias("author"), F.regexp_replace("date", "[TZ]", "").alias("date"), "system", "terminal", "shell", F.regexp_replace("views", "[^0-9]", "").try_cast("long").alias("views"), "description")


def retry_urls(lines: DataFrame) -> DataFrame:
    """lines: value. `#` lines and blank ones are comments; JSON lines give their url (bad JSON nothing), others are urls."""
    v = F.trim("value")
    url = F.when(v.startswith("{"), F.get_json_object(v, "$.url")).otherwise(v)
    return lines.where((v != "") & ~v.startswith("#")).select(url.alias("url")).where("url is not null")


def read_config(lines: DataFrame, delimiter: str = "=") -> DataFrame:
    """lines: value. key=value rows without comments and quotes."""
    bare = F.trim(F.regexp_replace("value", "#.*$", ""))
    at = F.locate(delimiter, bare)
    value = F.regexp_replace(F.trim(bare.substr(at + len(delimiter), F.length(bare))), "^[\"']|[\"']$", "")
    return lines.where(at > 0).select(F.trim(bare.substr(F.lit(1), at - 1)).alias("key"), value.alias("setting"))


TURNS = "file_id string, version int, initial_output string, turns array<struct<turn_id:int,timestamp:double,action:struct<type:string,content:string>,observation:struct<content:string>>>"


def read_turn_documents(spark: SparkSession, path: str, schema: str = TURNS, glob: str = "*.json") -> DataFrame:
    """Turn-based or event-stream documents in JSON, one a file or one a line, in whatever folder below path; file_id from the
    file's name where the document has none."""
    from ..functions.text import file_id

    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True).select("value", F.col("_metadata.file_path").alias("path"))
    one = F.from_json("value", schema, {"mode": "PERMISSIVE"})
    lines = F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")
    whole = F.forall(lines, lambda x: F.ltrim(x).startswith("{") & F.rtrim(x).endswith("}") & F.try_parse_json(x).isNotNull())
    rows = files.select("path", F.explode(F.when(whole, F.transform(lines, lambda x: F.from_json(x, schema))).otherwise(F.array(one))).alias("d")).select("path", "d.*")
    return rows.withColumn("file_id", F.coalesce("file_id", file_id(F.col("path")))).drop("path")


def read_progress(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What earlier runs wrote, or no rows where there is nothing or it can't be read."""
    try:
        found = spark.read.schema(schema).parquet(path)
        found.limit(1).count()
        return found
    except Exception:
        return spark.createDataFrame([], schema)


JUDGED = "success boolean, winner string, winner_model string, judgment struct<reason:string,confidence:double,suitable_for_training:boolean,rejection_type:string,rejection_reason:string>, input_file string, models map<string,string>, all_results map<string,struct<initial_output:string,turns:array<struct<turn_id:int,prompt:string,input:struct<content:string>,output:struct<content:string>>>>>"


def read_judged(spark: SparkSession, path: str) -> DataFrame:
    """Judge documents (*_multi.json) with their defaults, and the file's id."""
    from ..functions.text import file_id

    raw = spark.read.schema(JUDGED).option("multiLine", "true").option("pathGlobFilter", "*_multi.json").option("recursiveFileLookup", "true").json(path)
    return raw.withColumns({"success": F.coalesce("success", F.lit(True)), "suitable": F.coalesce("judgment.suitable_for_training", F.lit(True)), "file_id": file_id(F.col("_metadata.file_path"))})


def model_rows(judged: DataFrame) -> DataFrame:
    """file_id, model, initial_output, turns (turn_id, prompt, input, output) from judge documents."""
    each = judged.select("file_id", F.explode("all_results").alias("model", "r"))
    turns = F.transform("r.turns", lambda t: F.struct(t["turn_id"].alias("turn_id"), t["prompt"].alias("prompt"), t["input"]["content"].alias("input"), t["output"]["content"].alias("output")))
    return each.select("file_id", "model", "r.initial_output", F.coalesce(turns, F.array().cast("array<struct<turn_id:int,prompt:string,input:string,output:string>>")).alias("turns"))
