"""Small files at the edges: JSON arrays, checkpoint logs, cases, sheets, CSV results, prompts."""

from __future__ import annotations

import json
import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CASE_SCHEMA = "case_id int, drug_focus string, question_text string, gold_answer string, error_category string"
SHEET_SCHEMA = "sheet_row int, question string, label string"


def read_json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A file with one JSON array of objects; an empty table if there is no such file."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=True)


def write_json_array(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """An export for people: one JSON array, nulls kept, replaced as a whole or not at all, in any file system that
    the session knows. Rows are streamed through the driver one partition at a time, so only the file's size is a bound."""
    rows = (df.orderBy(*order) if order else df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j"))
    spark = df.sparkSession
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    made = target.suffix("." + uuid.uuid4().hex + ".tmp")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = jvm.java.io.OutputStreamWriter(fs.create(made, True), "UTF-8")
        out.write("[")
        for i, r in enumerate(rows.toLocalIterator()):
            out.write((",\n" if i else "\n") + json.dumps(json.loads(r["j"]), ensure_ascii=False, indent=2))
        out.write("\n]\n")
        out.close()
        replace = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
        option = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        option[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        replace.rename(made, target, option)
    finally:
        if fs.exists(made):
            fs.delete(made, False)


def append_log(df: DataFrame, path: str, key: str = "key", record: str = "record", seq: str = "seq") -> None:
    """Append lines ``{key, record, seq}`` to a checkpoint log (a folder of JSON lines)."""
    df.select(F.col(key).alias("key"), F.col(record).alias("record"), F.col(seq).alias("seq")).write.mode("append").option("ignoreNullFields", "false").json(path)


def read_log(spark: SparkSession, path: str, record_schema: str) -> DataFrame:
    """(key, record, seq): the last record of each key; torn and invalid lines are passed over; no log is an empty one."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], f"key string, record {record_schema}, seq bigint")
    rows = spark.read.schema(f"key string, record {record_schema}, seq bigint, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)
    return latest(rows.where("_bad is null and key is not null and record is not null").drop("_bad"), "key", ["seq"])


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key by ``order``; rows with a null key are dropped."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.where(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    return read_json_array(spark, path, CASE_SCHEMA)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A worksheet as (sheet_row, question, label) from CSV, JSON lines or Parquet; rows are numbered
    from 1 in the sheet, of which the first is the header."""
    if path.endswith(".csv"):
        return spark.read.schema(SHEET_SCHEMA).option("header", True).csv(path)
    return spark.read.schema(SHEET_SCHEMA).json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path).select("sheet_row", "question", "label")


def sheet_range(df: DataFrame, first: int, last: int) -> DataFrame:
    return df.where(F.col("sheet_row").between(first, last))


def model_suffix(model: str) -> str:
    """A model's name in file names."""
    return re.sub(r"[-.]", "_", model)


def write_csv(df: DataFrame, folder: str, stem: str, model: str) -> str:
    path = f"{folder}/{stem}_{model_suffix(model)}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def load_prompt(text: str | None = None, path: str | None = None, variable: str = "ANNOTATION_PROMPT_FILE") -> str:
    """A prompt given as text, else from a file, else from the file that the environment names."""
    if text is None:
        path = path or os.environ.get(variable)
        if not path:
            raise ValueError("no prompt: give a text, a path or set " + variable)
        with open(path, encoding="utf-8") as f:
            text = f.read()
    if not text.strip():
        raise ValueError("the prompt is empty")
    return text.strip()
