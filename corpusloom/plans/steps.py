"""The steps from sources to splits, and their command line.

    python -m corpusloom.plans.steps --base DATA --steps extract,chunk,generate,validate,prepare

Steps meet in files below the base folder, so each can be run alone or again.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import export, generate, quality, sampling
from corpusloom.operators.chunk import BpeCount, chunk_documents, estimate
from corpusloom.operators.lineage import cut, sums_before
from corpusloom.session import local_session
from corpusloom.sources import markup, paged, records, registry, tabular
from corpusloom.sources.config import TYPES, Settings

log = logging.getLogger("corpusloom")
Extractor = Callable[[SparkSession, str, "Engines"], DataFrame]


def _order(df: DataFrame, *columns: str) -> DataFrame:
    """A document's sections with the columns that order them."""
    return df.select(*[F.col(c).alias(f"o{i}") for i, c in enumerate(columns)], "title", "text", "content_type")


@dataclass
class Engines:
    """What reads the formats that Spark and the standard library can't: see sources.paged and sources.tabular."""

    pdf: Callable[[bytes], list[str]] | None = None
    pdf_ocr: Callable[[bytes, int], str] | None = None
    ocr: Callable[[bytes], str] | None = None
    xls: Callable[[str], dict[str, list[list]]] | None = None

    @classmethod
    def named(cls, given: list[str]) -> Engines:
        """From `kind=module:attribute` items of a command line."""
        out = cls()
        for item in given:
            kind, _, name = item.partition("=")
            if kind not in vars(out):
                raise ValueError(f"unknown engine: {kind}")
            setattr(out, kind, generate.named_factory(name))
        return out


#: Extractor name -> (source type, document type, columns of the order, extractor). New source types are added here.
EXTRACTORS: dict[str, tuple[str, str, tuple[str, ...], Extractor]] = {
    "extract_html": ("html", "prose", ("source_file",), lambda s, p, e: markup.read_html(s, p)),
    "extract_epub": ("epub", "prose", ("item_pos", "section_pos"), lambda s, p, e: markup.read_epub(s, p)),
    "extract_pdf": ("pdf", "prose", ("source_file", "section_pos"), lambda s, p, e: paged.read_pdf(s, p, e.pdf, e.pdf_ocr)),
    "extract_ocr": ("image_ocr", "prose", ("source_file",), lambda s, p, e: paged.read_images(s, p, e.ocr)),
    "extract_spreadsheet": ("spreadsheet", "tabular", ("part", "section_order"), lambda s, p, e: tabular.spreadsheet_sections(s, p, None, e.xls)),
    "extract_database": ("database", "tabular", ("part", "section_order"), lambda s, p, e: tabular.database_sections(s, p)),
}
#: Extractors that need an engine, and which.
NEEDS = {"extract_pdf": "pdf", "extract_ocr": "ocr"}


def extract_one(spark: SparkSession, name: str, path: str, source_id: str, folder: str, engines: Engines) -> DataFrame:
    """The sections of one source, numbered in order by narrow rows."""
    kind, doc_type, order, run = EXTRACTORS[name]
    doc_type = "mixed" if path.endswith(".json") else doc_type
    made = cut(_order(run(spark, path, engines), *order).withColumn("row", F.monotonically_increasing_id()))
    keys = [f"o{i}" for i in range(len(order))]
    places = sums_before(made.select("row", F.lit(source_id).alias("source"), *keys), "source", [*keys, "row"], F.lit(1), "section_pos").select("row", "section_pos")
    return made.join(places, "row").select(
        F.lit(source_id).alias("source_id"), F.lit(kind).alias("source_type"), F.lit(doc_type).alias("doc_type"), F.lit(folder).alias("folder"),
        F.col("section_pos").cast("int").alias("section_pos"), "title", "text", F.create_map(F.lit("content_type"), F.col("content_type")).alias("metadata"),
    )


def extract(spark: SparkSession, base: str, source: str | None = None, engines: Engines | None = None) -> DataFrame:
    """Extract every source of the registry at hand, or one. Sources without file, known type or the engine that they
    need are skipped, each with a warning."""
    engines = engines or Engines()
    rows = registry.with_presence(registry.load(spark, f"{base}/registry.yaml"), base)
    for e in sampling.registry_errors(rows).collect():  # a registry is small
        log.warning("%s: %s", e["id"], e["error"])
    out = None
    for r in rows.collect():
        name = registry.EXTRACTORS.get(r["type"])
        if r["missing"] or name is None or source not in (None, r["id"]):
            continue
        if name in NEEDS and getattr(engines, NEEDS[name]) is None:
            log.warning("%s: no engine for %s (--engine %s=module:attribute)", r["id"], r["type"], NEEDS[name])
            continue
        made = extract_one(spark, name, f"{base}/{r['path']}", r["id"], registry.FOLDERS.get(r["type"], registry.OTHER_FOLDER), engines)
        out = made if out is None else out.unionByName(made)
    if out is not None:
        records.write_documents(out, f"{base}/extracted")
    return out


def chunk(spark: SparkSession, base: str, tokenizer: str | None = None) -> DataFrame:
    """Chunks within a budget of estimated tokens, or of those of a tokenizer file."""
    count = BpeCount(tokenizer) if tokenizer else estimate
    chunks = chunk_documents(records.read_documents(spark, f"{base}/extracted"), count=count)
    records.write_records(chunks, f"{base}/chunks")
    return records.read_jsonl(spark, f"{base}/chunks", records.CHUNK)


def generate_all(spark: SparkSession, base: str, settings: Settings, factory=generate.echo_factory, sample: int | None = None, resume: bool = False, pause: float = 0.0) -> None:
    chunks = records.read_jsonl(spark, f"{base}/chunks", records.CHUNK)
    for kind, (_, _, _, folder) in TYPES.items():
        todo = chunks
        if resume and records.exists(spark, f"{base}/generated/{folder}"):
            todo = sampling.resume(todo, records.read_jsonl(spark, f"{base}/generated/{folder}", records.RECORDS[folder]))
        if sample is not None:
            todo = sampling.head(todo, "chunk_id", sample)
        prompts = generate.with_prompts(todo, kind, settings).select("chunk_id", "source_id", "content_type", "text", "system_prompt", "user_prompt")
        records.write_records(generate.records(generate.call_model(prompts, factory, pause), kind), f"{base}/generated/{folder}", resume)


def validate(spark: SparkSession, base: str) -> DataFrame:
    """Each kind by itself; kinds without output are skipped. Returns a row of counters per kind."""
    stats = None
    for kind, schema in records.RECORDS.items():
        if not records.exists(spark, f"{base}/generated/{kind}"):
            continue
        good, bad = records.read_tolerant(spark, f"{base}/generated/{kind}", schema)
        passed, row = quality.validate_dataset(good.withColumn("__pos", F.monotonically_increasing_id()).drop("file", "line"), kind, "__pos", bad.count())
        records.write_records(passed.drop("__pos"), f"{base}/validated/{kind}")
        stats = row if stats is None else stats.unionByName(row)
    return stats


def prepare(spark: SparkSession, base: str, settings: Settings) -> DataFrame:
    kinds = [k for k in export.FORMATTERS if records.exists(spark, f"{base}/validated/{k}")]
    examples = export.union_formats({k: records.read_jsonl(spark, f"{base}/validated/{k}", records.RECORDS[k]) for k in kinds})
    split = export.stratified_split(examples, *settings.split)
    export.save_splits(split, f"{base}/final")
    return split


STEPS = ("extract", "chunk", "generate", "validate", "prepare")


def run_steps(spark: SparkSession, base: str, steps: list[str], settings: Settings, **options) -> None:
    for step in steps:
        if step == "extract":
            extract(spark, base, options.get("source"), options.get("engines"))
        elif step == "chunk":
            chunk(spark, base, options.get("tokenizer"))
        elif step == "generate":
            factory = options.get("factory") or generate.echo_factory
            generate_all(spark, base, settings, factory, options.get("sample"), options.get("resume", False), options.get("pause", 0.0))
        elif step == "validate":
            validate(spark, base)
        elif step == "prepare":
            prepare(spark, base, settings)
        else:
            log.warning("unknown step: %s", step)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run steps from sources to splits")
    parser.add_argument("--base", default=".")
    parser.add_argument("--steps", default=",".join(STEPS))
    parser.add_argument("--list-steps", action="store_true")
    parser.add_argument("--source")
    parser.add_argument("--sample", type=int)
    parser.add_argument("--resume", action="store_true")
    parser.add_argument("--model", help="module:attribute of a model factory; without it an offline stand-in answers")
    parser.add_argument("--pause", type=float, default=0.0, help="seconds between two calls of a task")
    parser.add_argument("--engine", action="append", default=[], help="pdf, pdf_ocr, ocr or xls, as kind=module:attribute")
    parser.add_argument("--tokenizer", help="a tokenizer file to count tokens with")
    parser.add_argument("--extract", nargs=3, metavar=("EXTRACTOR", "PATH", "ID"), help="extract one file and print its sections as JSON lines")
    given = parser.parse_args(args)
    if given.list_steps:
        print("\n".join(STEPS))
        return
    engines = Engines.named(given.engine)
    if given.extract:
        name, path, source_id = given.extract
        made = extract_one(local_session(), name, path, source_id, registry.OTHER_FOLDER, engines).drop("folder")
        for line in made.orderBy("section_pos").toJSON().toLocalIterator():
            print(line)
        return
    settings, factory = Settings.load(f"{given.base}/config.yaml"), generate.named_factory(given.model) if given.model else None
    run_steps(
        local_session(), given.base, given.steps.split(","), settings, source=given.source, sample=given.sample, resume=given.resume,
        engines=engines, factory=factory, pause=given.pause, tokenizer=given.tokenizer,
    )


if __name__ == "__main__":
    main()
