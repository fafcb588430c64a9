"""Scans and sinks of extracted documents, chunks and generated records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


TEXT = T.StringType()
SECTION = _fields(title=TEXT, text=TEXT, metadata=T.MapType(TEXT, TEXT))
MESSAGE = _fields(role=TEXT, content=TEXT)
DOCUMENT = _fields(source_id=TEXT, source_type=TEXT, content_type=TEXT, sections=T.ArrayType(SECTION))
CHUNK = _fields(chunk_id=TEXT, source_id=TEXT, content_type=TEXT, section_title=TEXT, text=TEXT, token_count=T.LongType(), topics=T.ArrayType(TEXT))
ORIGIN = {"source_id": TEXT, "chunk_id": TEXT, "content_type": TEXT}
RECORDS = {
    "qa": _fields(instruction=TEXT, response=TEXT, **ORIGIN),
    "conversations": _fields(messages=T.ArrayType(MESSAGE), **ORIGIN),
    "completions": _fields(prompt=TEXT, completion=TEXT, **ORIGIN),
    "classification": _fields(text=TEXT, label=TEXT, **ORIGIN),
}
CORRUPT = "__corrupt"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_documents(spark: SparkSession, *paths: str, one_per_file: bool = False) -> DataFrame:
    """Exploded sections: source_id, doc_type, section_pos, title, text, metadata, content_type.

    Documents stand one on a line, as `write_documents` writes them, or one in a file, on any number of lines.
    """
    docs = spark.read.schema(DOCUMENT).json(list(paths), multiLine=one_per_file, mode="FAILFAST")
    rows = docs.select("source_id", F.coalesce("content_type", F.lit("prose")).alias("doc_type"), F.posexplode("sections").alias("section_pos", "s"))
    return rows.select("source_id", "doc_type", "section_pos", F.coalesce("s.title", F.lit("")).alias("title"), F.coalesce("s.text", F.lit("")).alias("text"), "s.metadata", F.coalesce(F.try_element_at("s.metadata", F.lit("content_type")), F.lit("prose")).alias("content_type"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Strict: a malformed line fails the job; blank lines are skipped."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def parse_lines(lines: DataFrame, schema: T.StructType, line_col: str = "value") -> DataFrame:
    """Tolerant: columns of `schema` plus __corrupt, the line where it isn't JSON; blank lines are skipped."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = lines.filter(F.trim(line_col) != "").withColumn("__r", F.from_json(line_col, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    return rows.select(*[c for c in lines.columns if c != line_col], "__r.*")


def read_tolerant(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Records in file and line order (`pos`) and malformed lines."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    rows = parse_lines(lines, schema)
    return rows.filter(f"{CORRUPT} IS NULL").drop(CORRUPT), rows.filter(f"{CORRUPT} IS NOT NULL").select("file", "line", CORRUPT)


def write_documents(sections: DataFrame, path: str) -> None:
    """Extracted documents as JSON in a folder per kind of source (`folder`)."""
    order = F.struct("section_pos", "title", "text", F.map_entries("metadata").alias("metadata"))  # maps have no order
    docs = sections.groupBy("folder", "source_id", "source_type", "doc_type").agg(F.array_sort(F.collect_list(order)).alias("s"))
    sections_ = F.transform("s", lambda x: F.struct(x["title"].alias("title"), x["text"].alias("text"), F.map_from_entries(x["metadata"]).alias("metadata")))
    docs.select("folder", "source_id", "source_type", F.col("doc_type").alias("content_type"), sections_.alias("sections")).write.mode("overwrite").partitionBy("folder").json(path)


def write_records(df: DataFrame, path: str, resume: bool = False, format: str = "json") -> None:
    """One policy for every kind: append when a run is resumed, else overwrite."""
    df.write.mode("append" if resume else "overwrite").format(format).save(path)


def read_samples(spark: SparkSession, schema: T.StructType, lines: str | None = None, whole: str | None = None) -> DataFrame:
    """Records of JSON-lines files and of JSON files that hold a list or one object."""
    parts = []
    if lines:
        parts.append(read_jsonl(spark, lines, schema))
    if whole:
        parts.append(spark.read.schema(schema).json(whole, multiLine=True))
    if not parts:
        raise ValueError("no files given")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def file_counts(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines per file, and their total in a row of null."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value").filter(F.trim("value") != "")
    return lines.rollup("file").agg(F.count("*").alias("records"))
