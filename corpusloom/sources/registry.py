"""The source registry: YAML on the driver, a table in Spark."""

from __future__ import annotations

from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Source type -> extractor; fixed values.
EXTRACTORS = {
    "epub": "extract_epub",
    "pdf": "extract_pdf",
    "html": "extract_html",
    "image_ocr": "extract_ocr",
    "spreadsheet": "extract_spreadsheet",
    "csv": "extract_spreadsheet",
    "xlsx": "extract_spreadsheet",
    "tsv": "extract_spreadsheet",
    "database": "extract_database",
    "sqlite": "extract_database",
    "json_db": "extract_database",
}
#: Where a type's extracted documents go; types not listed go to the last. Fixed values.
FOLDERS = {"epub": "textbooks", "pdf": "textbooks", "html": "articles"}
OTHER_FOLDER = "training_logs"

SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("id", "type", "path", "title")]
    + [T.StructField("topics", T.ArrayType(T.StringType()))]
    + [T.StructField(c, T.StringType()) for c in ("priority", "notes", "format_notes")]
)
#: Values of keys that an entry leaves out; fixed values.
DEFAULTS = {"title": "", "topics": [], "priority": "normal", "notes": "", "format_notes": ""}
REQUIRED = ("id", "type", "path")


def entries(text: str) -> list[dict]:
    """Registry rows with defaults; a missing or unknown key is a TypeError."""
    out = []
    for entry in (yaml.safe_load(text) or {}).get("sources") or []:
        unknown = set(entry) - set(SCHEMA.names)
        missing = [k for k in REQUIRED if k not in entry]
        if unknown or missing:
            raise TypeError(f"source {entry.get('id')}: unknown keys {sorted(unknown)}, missing keys {missing}")
        out.append(DEFAULTS | entry)
    return out


def load(spark: SparkSession, path: str) -> DataFrame:
    """An empty table if the file is missing."""
    rows = entries(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else []
    return spark.createDataFrame([tuple(r[c] for c in SCHEMA.names) for r in rows], SCHEMA)


def with_presence(registry: DataFrame, base: str) -> DataFrame:
    """`missing`: whether a source's file is absent; a registry is small and its paths are looked up on the driver."""
    rows = [(*r, not (Path(base) / (r["path"] or "")).exists()) for r in registry.collect()]
    return registry.sparkSession.createDataFrame(rows, T.StructType([*registry.schema.fields, T.StructField("missing", T.BooleanType())]))
