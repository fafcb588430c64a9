"""Trying prompts before a full run: preview, test, compare two prompts, estimate the cost.

    python -m corpusloom.plans.toolkit --base DATA preview|test|compare|estimate --type qa [--n 3] [--prompt FILE]
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import generate, profile, sampling
from corpusloom.session import local_session
from corpusloom.sources import records
from corpusloom.sources.config import TYPES, Settings

COLUMNS = ["chunk_id", "source_id", "content_type", "text", "system_prompt", "user_prompt"]
#: Chunks that an estimate is based on.
ESTIMATE_FROM = 3
Factory = Callable[[], generate.Generator]


def preview(chunks: DataFrame, kind: str, settings: Settings, n: int = 1, seed: int = 42, instruction: str | None = None) -> DataFrame:
    """The prompts of a random sample of chunks; no call is made."""
    return generate.with_prompts(sampling.random_sample(chunks, "chunk_id", n, seed), kind, settings, instruction).select(*COLUMNS)


def test(chunks: DataFrame, kind: str, settings: Settings, factory: Factory, n: int = 3, seed: int = 42, instruction: str | None = None, pause: float = 0.0) -> DataFrame:
    """Results of a random sample of chunks; see profile.results_summary for their totals."""
    return generate.run_results(generate.call_model(preview(chunks, kind, settings, n, seed, instruction), factory, pause))


def compare(chunks: DataFrame, kind: str, settings: Settings, factory: Factory, other: str, n: int = 3, seed: int = 42, pause: float = 0.0) -> DataFrame:
    """Totals of the same chunks under the configured prompt (A) and another instruction (B)."""
    a = test(chunks, kind, settings, factory, n, seed, None, pause).withColumn("variant", F.lit("A"))
    b = test(chunks, kind, settings, factory, n, seed, other, pause).withColumn("variant", F.lit("B"))
    return profile.compare_prompts(a.unionByName(b))


def estimate(chunks: DataFrame, kind: str, settings: Settings, factory: Factory, seed: int = 42, pause: float = 0.0) -> DataFrame:
    """Cost and time of a full run, from a few calls; fails if all of them failed."""
    good = test(chunks, kind, settings, factory, ESTIMATE_FROM, seed, None, pause).filter("error IS NULL")
    if good.limit(1).count() == 0:
        raise RuntimeError("all sample calls failed")
    return profile.cost_estimate(good, chunks.count())


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Try prompts before a full run")
    parser.add_argument("command", choices=["preview", "test", "compare", "estimate"])
    parser.add_argument("--base", default=".")
    parser.add_argument("--type", choices=list(TYPES), default="qa")
    parser.add_argument("--n", type=int, default=3)
    parser.add_argument("--prompt", help="a file with another instruction")
    parser.add_argument("--model", help="module:attribute of a model factory; without it an offline stand-in answers")
    given = parser.parse_args(args)
    settings, spark = Settings.load(f"{given.base}/config.yaml"), local_session()
    chunks = records.read_jsonl(spark, f"{given.base}/chunks", records.CHUNK)
    own = Path(given.prompt).read_text(encoding="utf-8") if given.prompt else None
    factory = generate.named_factory(given.model) if given.model else generate.echo_factory
    if given.command == "preview":
        out = preview(chunks, given.type, settings, given.n, instruction=own)
    elif given.command == "test":
        out = profile.results_summary(test(chunks, given.type, settings, factory, given.n, instruction=own))
    elif given.command == "compare":
        out = compare(chunks, given.type, settings, factory, own or "", given.n)
    else:
        out = estimate(chunks, given.type, settings, factory)
    out.show(truncate=False)


if __name__ == "__main__":
    main()
