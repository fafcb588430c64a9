"""The registered queries of the engine's own operators, each over whole driver tables.

`documents` stands for extracted sections (source = source id, doc_id = position), `events` for a training log,
`conversations` for generated conversations, `pages` for HTML files. Cleaning rules get text with artefacts put in.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import narrative, similarity, text
from corpusloom.operators import chunk, export, generate, narrate, profile, quality, sampling, sections
from corpusloom.operators.lineage import cut
from corpusloom.sources import markup, records, registry, tabular
from corpusloom.sources.config import Settings
from corpusloom.streaming import incremental


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def big(*columns: str) -> list[Column]:
    return [F.col(c).cast("long").alias(c) for c in columns]


# --- shared inputs ---------------------------------------------------------------------------------------------


def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` with alias column names: a day, a movement, sets, reps, a load, an intensity and remarks."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("pos"),
        F.date_format("ts", "yyyy-MM-dd").alias("workout_date"),
        F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("movement"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 4 + 1).alias("num_sets"),
        F.when(F.col("event_id") % 3 != 0, F.col("user_id") % 12 + 1).alias("repetitions"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("load"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id") % 11).cast("double").alias("effort"),
        F.col("props").alias("remarks"),
        "user_id",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id and messages in turn order; a conversation's turns are one record."""
    c = table(spark, sf_dir, "conversations")
    rows = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("m"))
    return rows.select("conv_id", F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn right after it."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations").withColumns({"next_role": F.lead("role").over(w), "response": F.lead("text").over(w)})
    pairs = c.filter("role = 'user' AND next_role = 'assistant'")
    return pairs.select((F.col("conv_id") * 100 + F.col("turn")).alias("pos"), F.col("text").alias("instruction"), "response", F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("source_id"))


def completion_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of a document and the rest."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("pos"), F.substring_index("text", "\n", 1).alias("prompt"), F.expr("substr(text, length(substring_index(text, '\n', 1)) + 2)").alias("completion"), F.col("source").alias("source_id"))


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("pos"), "text", F.col("lang").alias("label"), F.col("source").alias("source_id"))


def training_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = messages(spark, sf_dir).withColumn("source_id", F.concat(F.lit("conv"), F.col("conv_id").cast("string")))
    return export.union_formats(
        {
            "qa": qa_pairs(spark, sf_dir).filter(quality.valid_qa()),
            "conversations": conversations.filter(quality.valid_conversation()),
            "completions": completion_pairs(spark, sf_dir).filter(quality.valid_completion()),
            "classification": labelled_texts(spark, sf_dir).filter(quality.valid_classification()),
        }
    )


def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry made of the documents' sources: types, some of them unknown, topics and a missing flag."""
    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("lang")).alias("topics"))
    n = F.substring("source", 4, 9).cast("int")
    kinds = [*registry.EXTRACTORS, "floppy_disk"]
    return d.select(F.col("source").alias("id"), F.get(F.array(*[F.lit(k) for k in kinds]), n % len(kinds)).alias("type"), F.concat(F.lit("data/"), F.col("source")).alias("path"), "topics", (n % 7 == 3).alias("missing"), "n")


# --- text ------------------------------------------------------------------------------------------------------


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def clean_whitespace(spark, sf_dir):
    raw = F.concat(F.lit("  \t"), F.replace("text", F.lit(". "), F.lit(".\t  ")), F.lit("\n\n\n\n end \n"))
    return _docs(spark, sf_dir).select("doc_id", text.clean_whitespace(raw).alias("cleaned"))


def page_artifacts(spark, sf_dir):
    raw = F.concat(F.lit("Chapter 3\n"), F.replace("text", F.lit("\n"), F.lit("\n 42 \n")), F.lit("\nCHAPTER 12  \nrest of 7 pages"))
    return _docs(spark, sf_dir).select("doc_id", text.remove_page_artifacts(raw).alias("cleaned"))


def references_removed(spark, sf_dir):
    raw = F.concat("text", F.lit("\nReferences \n[1] one\n"), F.when(F.col("doc_id") % 2 == 0, F.lit("\nWorks Cited\n two")).otherwise(F.lit("")))
    return _docs(spark, sf_dir).select("doc_id", text.remove_references_section(raw).alias("cleaned"))


def html_residue(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.clean_html_residue(F.concat("html", F.lit("&#169;&frac12;&eacute;"))).alias("cleaned"))


def full_clean(spark, sf_dir):
    raw = F.concat(F.lit("<p>"), F.replace("text", F.lit("\n"), F.lit("&nbsp;<br>\n\n\n\n 17 \n")), F.lit("\nChapter 9\n</p>"))
    return _docs(spark, sf_dir).select("doc_id", text.full_clean(raw).alias("cleaned"))


def normalize_unicode(spark, sf_dir):
    raw = F.concat(F.lit("“ﬁne” – it’s…"), "text")
    return _docs(spark, sf_dir).select("doc_id", text.normalize_unicode(raw).alias("cleaned"))


def meaningful_text(spark, sf_dir):
    """Whole texts; numbers between the words of every third one make most of its words hold no letter."""
    raw = F.when(F.col("doc_id") % 3 == 0, F.replace("text", F.lit(" "), F.lit(" 7 7 "))).otherwise(F.col("text"))
    marked = _docs(spark, sf_dir).select("doc_id", F.explode(F.array(text.marked_words(raw))).alias("marks"))  # made once
    return marked.select("doc_id", F.length("marks").cast("long").alias("words"), *[text.meaningful_marks(F.col("marks"), least).cast("long").alias(n) for n, least in (("meaningful", 10), ("meaningful_5", 5))])


def sentence_split(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", F.posexplode(text.sentences(F.col("text"))).alias("pos", "sentence"))
    return rows.select("doc_id", *big("pos"), "sentence")


def token_estimates(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.token_count(F.col("text")).cast("long").alias("tokens"), text.char_token_estimate(F.col("text")).cast("long").alias("char_tokens"), text.preview(F.col("text"), 120, "...").alias("preview"), text.chunk_id(F.col("source"), F.col("doc_id")).alias("chunk_id"))


def indel_similarity(spark, sf_dir):
    """Each benchmark item against the one after it, on whole texts."""
    b = table(spark, sf_dir, "benchmark")
    pairs = b.select("item_id", F.col("text").alias("a")).join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("b")), "item_id")
    return pairs.select("item_id", F.round(similarity.indel_ratio(F.col("a"), F.col("b")), 6).alias("ratio"))


# --- sections, narration, chunks -------------------------------------------------------------------------------


def heading_lines(spark, sf_dir):
    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("doc_id", *big("pos"), sections.is_book_heading(F.col("line")).cast("long").alias("book"), sections.is_page_heading(text.strip(F.col("line"))).cast("long").alias("page"))


def split_by_headings(spark, sf_dir):
    made = sections.split_by_headings(_docs(spark, sf_dir).select("doc_id", "text"))
    return made.select("doc_id", *big("section_pos"), "title", "section_text")


def pdf_sections(spark, sf_dir):
    """Documents of a source as its pages, ten to a book."""
    pages = _docs(spark, sf_dir).select(F.floor(F.col("doc_id") / 10).cast("long").alias("book"), (F.col("doc_id") % 10 + 1).alias("page"), "text")
    made = sections.page_sections(pages, "book", "page", "text")
    return made.select("book", *big("section_pos"), "title", "section_text", *big("start_page"))


def effort_bands(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", narrative.effort_band((F.col("event_id") % 21).cast("double") / 2).alias("band"))


def narrate_rows(spark, sf_dir):
    made = narrate.narrate_rows(training_log(spark, sf_dir), "pos")
    return made.select("section_pos", "title", "text")


def narrate_sessions(spark, sf_dir):
    return narrate.narrate_sessions(training_log(spark, sf_dir), "pos").select("date", "title", "text", *big("num_exercises"))


def describe_table(spark, sf_dir):
    return narrate.describe_table(table(spark, sf_dir, "nation").withColumn("pos", F.col("n_nationkey")), "pos", "nation")


def describe_frame(spark, sf_dir):
    return narrate.describe_frame(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos"), "c_name", F.when(F.col("c_nationkey") % 3 != 0, F.col("c_nationkey")).alias("c_nationkey"), "c_mktsegment"), "pos")


def chunk_prose(spark, sf_dir):
    docs = _docs(spark, sf_dir).select(F.col("source").alias("source_id"), F.col("doc_id").alias("section_pos"), "text")
    made = chunk.chunk_prose(docs)
    return made.select("source_id", "section_pos", "chunk_index", "chunk_id", "text", "token_count")


def chunk_tabular(spark, sf_dir):
    made = chunk.chunk_tabular(_docs(spark, sf_dir).select(F.col("source").alias("source_id"), F.col("doc_id").alias("section_pos"), "text"))
    return made.select("source_id", "chunk_index", "chunk_id", "text", "token_count")


# --- profile ---------------------------------------------------------------------------------------------------


def chunk_stats(spark, sf_dir):
    out = profile.describe_number(_docs(spark, sf_dir), "n_chars")
    return out.select(*big("count"), *[F.round(F.col(c).cast("double"), 6).alias(c) for c in out.columns if c != "count"])


def extraction_summary(spark, sf_dir):
    return profile.extraction_summary(_docs(spark, sf_dir), ["lang", "source"])


def length_histogram(spark, sf_dir):
    return profile.length_histogram(_docs(spark, sf_dir), F.length("text"))


def extremes(spark, sf_dir):
    return profile.extremes(_docs(spark, sf_dir), F.length("text"), "doc_id")


def value_counts(spark, sf_dir):
    return profile.value_counts(_docs(spark, sf_dir), "source", "lang")


def describe_strings(spark, sf_dir):
    return profile.describe_strings(_docs(spark, sf_dir), ["lang", "source", "text"])


def longest_per_source(spark, sf_dir):
    rows = profile.top_by(_docs(spark, sf_dir), "source", [F.desc("n_chars"), F.col("doc_id")], 3)
    return rows.select("source", "doc_id", "n_chars")


# --- filters and samples ---------------------------------------------------------------------------------------


def sample_head(spark, sf_dir):
    return sampling.head(_docs(spark, sf_dir).select("doc_id", "source"), "doc_id", 25)


def random_sample(spark, sf_dir):
    return sampling.random_sample(_docs(spark, sf_dir).select("doc_id", "source"), "doc_id", 30)


def resume_anti(spark, sf_dir):
    return sampling.resume(_docs(spark, sf_dir).select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


def resume_then_head(spark, sf_dir):
    return sampling.head(sampling.resume(_docs(spark, sf_dir).select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id"), "doc_id", 20)


def registry_filter(spark, sf_dir):
    rows = sampling.by_topic(sampling.with_extractor(source_registry(spark, sf_dir)), "es")
    return rows.select("id", "type", "extractor")


def registry_validate(spark, sf_dir):
    return sampling.registry_errors(source_registry(spark, sf_dir))


def validate_qa(spark, sf_dir):
    return qa_pairs(spark, sf_dir).select("pos", quality.valid_qa().cast("long").alias("valid"))


def validate_conversation(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", quality.valid_conversation().cast("long").alias("valid"))


def validate_completion(spark, sf_dir):
    return completion_pairs(spark, sf_dir).select("pos", quality.valid_completion().cast("long").alias("valid"))


def validate_classification(spark, sf_dir):
    return labelled_texts(spark, sf_dir).select("pos", quality.valid_classification().cast("long").alias("valid"))


def varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations and, a million on, the same with a word more after their first message."""
    items = messages(spark, sf_dir)
    more = F.transform("messages", lambda m, i: F.struct(m["role"].alias("role"), F.when(i == 0, F.concat(m["content"], F.lit(" indeed"))).otherwise(m["content"]).alias("content")))
    return items.unionByName(items.select((F.col("conv_id") + 1_000_000).alias("conv_id"), more.alias("messages")))


def fuzzy_dedup(spark, sf_dir):
    """Conversations by their first message."""
    items = varied(spark, sf_dir)
    return quality.fuzzy_dedup(items, quality.dedup_key("conversations"), "conv_id").select("conv_id")


def near_dup_pairs(spark, sf_dir):
    """Question pairs over 85 alike, on the distinct instructions."""
    keys = qa_pairs(spark, sf_dir).groupBy(F.col("instruction").alias("key")).agg(F.min("pos").alias("pos")).filter("key <> ''")
    keys = keys.unionByName(keys.select(F.concat("key", F.lit(" indeed")).alias("key"), (F.col("pos") + 1_000_000).alias("pos")))
    return quality.similar_pairs(keys)


def validation_stats(spark, sf_dir):
    return quality.validate_dataset(varied(spark, sf_dir), "conversations", "conv_id")[1]


def dedup_keys(spark, sf_dir):
    c = messages(spark, sf_dir).select(F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("id"), quality.dedup_key("conversations").alias("key"))
    return c.unionByName(_docs(spark, sf_dir).select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), quality.dedup_key("classification").alias("key")))


def registry_lookup(spark, sf_dir):
    rows = source_registry(spark, sf_dir)
    first = _docs(spark, sf_dir).agg(F.min("source")).first()[0]
    one = sampling.by_id(rows, first or "").select(F.lit("id").alias("by"), "id", "type")
    return one.unionByName(sampling.by_type(rows, "csv").select(F.lit("type").alias("by"), "id", "type"))


# --- files: written by the sinks and read back -------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    cut(spark.range(0))
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def records_round_trip(spark, sf_dir):
    """Chunks as JSON lines, the second half appended as a resumed run does."""
    at, d = _folder(spark, "records"), _docs(spark, sf_dir)
    chunks = d.select("doc_id", text.chunk_id(F.col("source"), F.col("doc_id")).alias("chunk_id"), F.col("source").alias("source_id"), "text", text.char_token_estimate(F.col("text")).alias("token_count"))
    records.write_records(chunks.filter("doc_id % 2 = 0").drop("doc_id"), at)
    records.write_records(chunks.filter("doc_id % 2 <> 0").drop("doc_id"), at, resume=True)
    return records.read_jsonl(spark, at, records.CHUNK).select("chunk_id", "source_id", "text", "token_count")


def tolerant_lines(spark, sf_dir):
    """JSON lines of which every fifth is broken, with blank lines between."""
    at = _folder(spark, "lines")
    whole = F.to_json(F.struct("text", F.col("lang").alias("label")))
    line = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit('{"text": broken '), F.col("doc_id").cast("string"))).otherwise(F.concat(whole, F.lit("\n")))
    _docs(spark, sf_dir).select(line.alias("value")).write.text(at)
    good, bad = records.read_tolerant(spark, at, records.RECORDS["classification"])
    return good.select(F.lit(True).alias("good"), "text", "label").unionByName(bad.select(F.lit(False).alias("good"), F.lit(None).cast("string").alias("text"), F.col(records.CORRUPT).alias("label")))


def sample_files(spark, sf_dir):
    """Records of JSON lines and of a file that holds one list."""
    lines, whole = _folder(spark, "lines"), _folder(spark, "list")
    records.write_records(_docs(spark, sf_dir).select("text", F.col("lang").alias("label")), lines)
    items = table(spark, sf_dir, "benchmark").agg(F.to_json(F.collect_list(F.struct("text", F.lit("item").alias("label")))).alias("value"))  # one small file
    items.coalesce(1).write.text(whole)
    return records.read_samples(spark, records.RECORDS["classification"], lines, whole).select("text", "label")


def line_counts(spark, sf_dir):
    at = _folder(spark, "counts")
    records.write_records(_docs(spark, sf_dir).select("doc_id", "text"), at)
    return records.file_counts(spark, at).filter("file IS NULL").select("records")


def documents_round_trip(spark, sf_dir):
    """Documents of many sections, several of a folder, written and read as sections."""
    d = _docs(spark, sf_dir)
    kind = F.when(F.col("lang") == "en", "prose").otherwise("tabular")
    made = d.select(
        F.when(F.col("lang") == "en", "articles").otherwise("training_logs").alias("folder"), F.col("source").alias("source_id"), F.lit("html").alias("source_type"), kind.alias("doc_type"),
        F.col("doc_id").cast("int").alias("section_pos"), F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"), "text", F.create_map(F.lit("content_type"), F.col("lang")).alias("metadata"),
    )
    at = _folder(spark, "documents")
    records.write_documents(made, at)
    return records.read_documents(spark, at).select("source_id", "doc_type", *big("section_pos"), "title", "text", "content_type")


def splits_round_trip(spark, sf_dir):
    at = _folder(spark, "splits")
    export.save_splits(export.stratified_split(training_union(spark, sf_dir)), at)
    return spark.read.json(at).filter("format <> 'classification'").select(F.md5("text").alias("text_md5"), "format", "split")


def csv_sessions(spark, sf_dir):
    """A training log as one CSV file, read with inferred types and narrated by day."""
    at = _folder(spark, "log") + ".csv"
    training_log(spark, sf_dir).orderBy("pos").drop("pos", "user_id", "remarks").coalesce(1).write.csv(at, header=True)
    made = tabular.spreadsheet_sections(spark, at)
    return made.select(F.col("section_order").alias("date"), "title", "num_exercises", "text")


def chunk_totals(spark, sf_dir):
    chunks = _docs(spark, sf_dir).select(text.token_count(F.col("text")).cast("long").alias("token_count"))
    return chunk.chunk_totals(chunks).select(*big("chunks", "total_tokens"), F.round("avg_tokens", 6).alias("avg_tokens"))


# --- generation ------------------------------------------------------------------------------------------------


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    return d.select(text.chunk_id(F.col("source"), F.col("doc_id")).alias("chunk_id"), F.col("source").alias("source_id"), F.when(F.col("doc_id") % 3 == 0, "tabular").otherwise("prose").alias("content_type"), "text")


SETTINGS = Settings(topics=["en", "fr", "de", "es"])


def prompt_render(spark, sf_dir):
    qa = generate.with_prompts(_chunks(spark, sf_dir), "qa", SETTINGS).withColumn("kind", F.lit("qa"))
    labels = generate.with_prompts(_chunks(spark, sf_dir), "classification", SETTINGS).withColumn("kind", F.lit("classification"))
    return qa.unionByName(labels).select("chunk_id", "kind", "user_prompt")


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model responses made of conversation turns: fenced, bare, broken and with a stray brace."""
    c = table(spark, sf_dir, "conversations").withColumn("n", (F.col("conv_id") + F.col("turn")) % 4)
    obj = F.to_json(F.struct(F.col("role").alias("instruction"), F.col("text").alias("response")))
    raw = (
        F.when(F.col("n") == 0, F.concat(F.lit("```json\n["), obj, F.lit("]\n```")))
        .when(F.col("n") == 1, obj)
        .when(F.col("n") == 2, F.concat(F.lit("Here: "), obj, F.lit(" and "), obj))
        .otherwise(F.concat(F.lit("} "), obj))
    )
    return c.select(F.format_string("%d-%d", "conv_id", "turn").alias("chunk_id"), F.lit("s").alias("source_id"), F.lit("prose").alias("content_type"), "text", raw.alias("raw_response"), F.lit(None).cast("string").alias("error"))


def parse_responses(spark, sf_dir):
    return generate.records(_responses(spark, sf_dir), "qa").select("chunk_id", "instruction", "response")


def run_model(spark, sf_dir):
    """The offline stand-in over all chunks of the benchmark, through the same call path as a model."""
    b = table(spark, sf_dir, "benchmark").select(F.format_string("b_%d", "item_id").alias("chunk_id"), F.lit("b").alias("source_id"), F.lit("prose").alias("content_type"), "text")
    prompts = generate.with_prompts(b, "qa", SETTINGS).select("chunk_id", "source_id", "content_type", "text", "system_prompt", "user_prompt")
    return generate.run_results(generate.call_model(prompts, generate.echo_factory)).select("chunk_id", "chunk_preview", *big("n_examples", "input_tokens_est", "output_tokens_est"), "error")


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of a run without a model: sizes from documents, every thirteenth an error."""
    d = _docs(spark, sf_dir)
    return d.select(
        F.when(F.col("doc_id") % 2 == 0, "A").otherwise("B").alias("variant"),
        (F.col("doc_id") % 6).alias("n_examples"),
        F.length("text").alias("response_length"),
        F.when(F.col("doc_id") % 13 == 0, "failed").alias("error"),
        text.char_token_estimate(F.col("text")).alias("input_tokens_est"),
        (F.col("doc_id") % 500).alias("output_tokens_est"),
        ((F.col("doc_id") % 7).cast("double") / 4).alias("elapsed"),
    )


def results_summary(spark, sf_dir):
    out = profile.results_summary(_results(spark, sf_dir))
    return out.select(*big("chunks", "successful", "examples"), *[F.round(c, 6).alias(c) for c in ("avg_examples", "avg_response_length")])


def compare_prompts(spark, sf_dir):
    out = profile.compare_prompts(_results(spark, sf_dir))
    return out.select("variant", *big("examples", "errors"), F.round("avg_response_length", 6).alias("avg_response_length"))


def cost_estimate(spark, sf_dir):
    rows = _results(spark, sf_dir)
    out = profile.cost_estimate(rows, rows.count())
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])


def perplexity(spark, sf_dir):
    losses = _docs(spark, sf_dir).select((F.col("doc_id") % 40 / 10.0).alias("loss"), (F.col("n_chars") % 50 + 1).alias("n_tokens"))
    return profile.perplexity(losses).select(F.round("perplexity", 6).alias("perplexity"))


# --- formats and splits ----------------------------------------------------------------------------------------


def format_qa(spark, sf_dir):
    return qa_pairs(spark, sf_dir).select("pos", export.qa_text().alias("text"))


def format_conversation(spark, sf_dir):
    return messages(spark, sf_dir).select("conv_id", export.conversation_text().alias("text"))


def format_completion(spark, sf_dir):
    return completion_pairs(spark, sf_dir).select("pos", export.completion_text().alias("text"))


def format_classification(spark, sf_dir):
    return labelled_texts(spark, sf_dir).select("pos", export.classification_text().alias("text"))


def inference_prompt(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", export.inference_prompt(F.col("text")).alias("text"))


def format_counts(spark, sf_dir):
    return profile.value_counts(training_union(spark, sf_dir), "format")


def stratified_split(spark, sf_dir):
    rows = export.stratified_split(training_union(spark, sf_dir))
    return rows.select(F.md5("text").alias("text_md5"), "format", "source_id", "split")


def split_summary(spark, sf_dir):
    return profile.split_profile(export.stratified_split(training_union(spark, sf_dir)))


# --- pages -----------------------------------------------------------------------------------------------------


def html_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    made = markup.html_sections(pages, "html", F.col("url"), main=False)
    return made.select("page_id", "title", "text")


def html_article_text(spark, sf_dir):
    """The main-text path."""
    made = markup.html_sections(table(spark, sf_dir, "pages"), "html", F.col("url"))
    return made.select("page_id", "text")


# --- streams ---------------------------------------------------------------------------------------------------


def _arriving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files; the pattern serves tables of one file and of a folder alike."""
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _drain(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Run a stream over what is there, into the shared checkpoint folder, and read what it wrote last."""
    spark = stream.sparkSession
    cut(spark.range(0))
    base = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{name}-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out" if mode == "complete" else f"{base}/out/batch={batch_id}")

    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


def stream_windowed_counts(spark, sf_dir):
    """Events per type and day, as a stream with a watermark."""
    events = _arriving(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    counted = _drain(incremental.windowed_counts(events, "ts", "event_type", "1 day"), "complete", "counts")
    return counted.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "count")


def stream_clean(spark, sf_dir):
    """Documents cleaned as they arrive; row-local, so batches don't matter."""
    docs = _arriving(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit("\n 42 \n")).alias("text"))
    cleaned = docs.withColumn("text", text.full_clean(F.col("text"))).filter(text.is_meaningful(F.col("text")))
    return _drain(cleaned, "append", "clean").select("doc_id", "text")


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    clean_whitespace, page_artifacts, references_removed, html_residue, full_clean, normalize_unicode, meaningful_text, sentence_split, token_estimates, indel_similarity,
    heading_lines, split_by_headings, pdf_sections, effort_bands, narrate_rows, narrate_sessions, describe_table, describe_frame, chunk_prose, chunk_tabular,
    chunk_stats, extraction_summary, length_histogram, extremes, value_counts, describe_strings, longest_per_source,
    sample_head, random_sample, resume_anti, resume_then_head, registry_filter, registry_validate,
    validate_qa, validate_conversation, validate_completion, validate_classification, fuzzy_dedup, near_dup_pairs, validation_stats,
    prompt_render, parse_responses, run_model, results_summary, compare_prompts, cost_estimate, perplexity,
    format_qa, format_conversation, format_completion, format_classification, inference_prompt, format_counts, stratified_split, split_summary, html_main_text, html_article_text,
    dedup_keys, registry_lookup, records_round_trip, tolerant_lines, sample_files, line_counts, documents_round_trip, splits_round_trip, csv_sessions, chunk_totals, stream_windowed_counts, stream_clean,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}
