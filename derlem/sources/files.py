"""Readers and writers of the pipeline's file forms.

Schemas are given, never inferred; a path that does not exist reads as an empty table.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE = "struct<role:string,content:string>"
META = (
    "struct<source_pdf:string,grup:string,question_no:string,pages:array<int>,blocks:array<int>,exam:string,anahtar_id:string,cevap_adaylari:array<string>,pipeline:string,"
    "quality:struct<cop:double,tr:double,aciklama_uz:int,hece:double>,duplicate_count:int,kullanim:string,not_:string>"
)
RECORD = f"id string, messages array<{MESSAGE}>, meta {META}"
FLAGGED = f"id string, soru string, siklar string, aciklama string, cevap string, meta {META}, sorunlar array<string>, messages array<{MESSAGE}>, kaynaklar array<string>"
DECISION = "id string, karar string, neden string, not_ string, govde string, siklar map<string,string>, cevap string, aciklama string, aciklama_kes string, aciklama_paragraf string, soru string, zaman string"
BLOCK = "type string, text string, table_body string, page_idx int"
IMAGES = "id string, src string, gorsel array<array<string>>"


def _empty_if_missing(spark: SparkSession, schema: str, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return spark.createDataFrame([], schema)


def jsonl(spark: SparkSession, path: str, schema: str, tolerant: bool = False) -> DataFrame:
    """One JSON object per line; blank lines are skipped. tolerant: so are lines that are no JSON, such as a half-written last one."""
    mode = "DROPMALFORMED" if tolerant else "FAILFAST"
    return _empty_if_missing(spark, schema, lambda: spark.read.schema(schema).option("mode", mode).json(path))


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON array of objects."""
    return _empty_if_missing(spark, schema, lambda: spark.read.schema(schema).option("multiLine", True).json(path))


def _log_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """(dosya, satir, value) of the non-blank lines of logs. A log is written by hand, so a file is read whole, which keeps its lines' order."""

    def read() -> DataFrame:
        files = spark.read.text(pattern, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("dosya"), F.posexplode(F.split("value", "\n")).alias("satir", "value"))
        return files.filter("trim(value) <> ''")

    return _empty_if_missing(spark, "dosya string, satir int, value string", read)


def decision_logs(spark: SparkSession, pattern: str) -> DataFrame:
    """All decision logs with `dosya` and `satir`, the place of each decision: later files and lines come later. `kayit_no` orders them for
    operators.decisions.latest: the rank of the file by name, then the line."""
    rows = _log_lines(spark, pattern)
    ranks = rows.select("dosya").distinct().select("dosya", F.row_number().over(Window.orderBy("dosya")).cast("long").alias("_f"))  # one row per file
    fields = F.from_json("value", DECISION.replace(" string", ":string").replace(" map", ":map").join(("struct<", ",`not`:string>")))
    d = rows.select("dosya", "satir", fields.alias("d")).join(F.broadcast(ranks), "dosya").select("d.*", "dosya", "satir", (F.col("_f") * (1 << 32) + F.col("satir")).alias("kayit_no"))
    return d.withColumn("not_", F.coalesce("not_", "not")).drop("not")


def unknown_fields(spark: SparkSession, pattern: str) -> DataFrame:
    """(dosya, satir, alan): fields of decision logs that no decision has."""
    known = {c.split()[0] for c in DECISION.split(", ")} | {"not"}
    return _log_lines(spark, pattern).select("dosya", "satir", F.explode(F.json_object_keys("value")).alias("alan")).filter(~F.col("alan").isin(*known))


def wait_for_ids(read: Callable[[], DataFrame], wanted: DataFrame, key: str = "id", tries: int = 4, pause: float = 20.0) -> DataFrame:
    """read() once it holds every id of wanted(id): a table that is being written anew is read again after a pause, up to `tries` times;
    then a LookupError names some of the ids that are missing."""
    for attempt in range(tries):
        df = read()
        missing = [r[0] for r in wanted.select(key).join(df.select(key), key, "left_anti").distinct().limit(3).collect()]
        if not missing:
            return df
        if attempt + 1 < tries:
            time.sleep(pause)
    raise LookupError(f"ids that never came: {missing}")


def request_batch(spark: SparkSession, text: str) -> DataFrame:
    """Repair requests handed over as one JSON array."""
    request = "array<struct<id:string,cevap:string,gerekce:string,soru:string,cekince:string>>"
    return spark.createDataFrame([(text,)], "t string").select(F.inline(F.from_json("t", request)))


def block_files(spark: SparkSession, root: str) -> DataFrame:
    """Layout blocks of all *content_list.json below root: (yol, grup, doc, block_idx, type, text, table_body, page_idx).

    A file is one array, whose order is the block order; it is read whole and exploded with its positions.
    """
    array = T._parse_datatype_string(f"array<struct<{BLOCK.replace(' string', ':string').replace(' int', ':int').replace(', ', ',')}>>")
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*content_list.json").text(root, wholetext=True).select(F.col("_metadata.file_path").alias("yol"), "value")
    parts = F.split("yol", "/")
    return files.select(
        "yol",
        F.element_at(F.split(F.regexp_replace("yol", f"^.*?{root.rstrip('/').split('://')[-1]}/", ""), "/"), 1).alias("grup"),
        F.get(parts, F.size(parts) - 3).alias("doc"),
        F.posexplode(F.from_json("value", array)).alias("block_idx", "b"),
    ).select("yol", "grup", "doc", "block_idx", "b.*")


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id per line, trimmed, blank lines dropped."""
    return _empty_if_missing(spark, "id string", lambda: spark.read.text(path).select(F.trim("value").alias("id")).filter("id <> ''"))


def line_count(spark: SparkSession, path: str) -> int:
    """Non-blank lines; 0 for a path that does not exist."""
    return id_list(spark, path).count()


def image_table(spark: SparkSession, path: str) -> DataFrame:
    """(id, src, block_idx, kind, path): one row per image of a question."""
    rows = json_document(spark, path, IMAGES)
    return rows.select("id", "src", F.explode("gorsel").alias("g")).select("id", "src", F.col("g")[0].try_cast("int").alias("block_idx"), F.col("g")[1].alias("kind"), F.col("g")[2].alias("path"))


def run_log_hours(spark: SparkSession, path: str) -> DataFrame:
    """Hours of the successful runs of a CSV log with columns saniye and sonuc; 0 without one."""
    rows = _empty_if_missing(spark, "saniye string, sonuc string", lambda: spark.read.csv(path, header=True).select("saniye", "sonuc"))
    return rows.filter("sonuc = 'ok'").agg((F.coalesce(F.sum(F.col("saniye").try_cast("double")), F.lit(0.0)) / 3600).alias("saat"))


def source_texts(spark: SparkSession, root: str, pattern: str = "*.md") -> DataFrame:
    """(source, text): whole texts below root, source being the path of their folder's parent."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    return files.select(F.regexp_extract(F.col("_metadata.file_path"), f"{root.rstrip('/').split('://')[-1]}/(.*)/[^/]*/[^/]*$", 1).alias("source"), F.col("value").alias("text"))


def file_digests(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length, md5) of the files below root."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "length", F.md5("content").alias("md5"))


def file_sizes(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(n, bytes) of the files below root; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """JSON lines, nulls written out, letters unescaped."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def write_split(df: DataFrame, accepted: str, rejected: str, problems: str = "sorunlar") -> None:
    """Records without problems to one place, the others to another."""
    write_jsonl(df.filter(F.size(problems) == 0).drop(problems), accepted)
    write_jsonl(df.filter(F.size(problems) > 0), rejected)


def write_by(df: DataFrame, column: str, path: str) -> None:
    """One folder per value of a column; only the folders written are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False).partitionBy(column).json(path)


def write_list(df: DataFrame, column: str, order: list, path: str) -> None:
    """An ordered list, one value per line. Range-sorted parts in order; the file names carry the order."""
    df.orderBy(*order).select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, columns: list[str], path: str) -> None:
    """CSV with a header, each file beginning with a byte-order mark; other columns are left out."""
    first, *rest = columns
    df.select(F.col(first).alias("\ufeff" + first), *rest).write.mode("overwrite").csv(path, header=True)
