"""Source rows to tasks: id, prompt, context and metadata (JSON text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gristmill.functions import parse as P
from gristmill.functions import tools
from gristmill.functions.text import file_name
from gristmill.operators.chunks import chunked
from gristmill.session import cut


def _filled(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with a running index (from 0) in a declared order, nulls last. Sorted and counted by range partitions, so no single task
    sorts all rows. They are kept once with their places: read again, rows may be dealt to other partitions than were counted."""
    keys = [F.col(c).asc_nulls_last() for c in order]
    ranged = cut(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()))
    placed = ranged.withColumn("__p", F.shiftright("__at", 33))  # the id holds the partition above 33 bits, below them the row's place in it
    per = placed.groupBy("__p").agg(F.count("*").alias("n"))
    before = per.select("__p", F.coalesce(F.sum("n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # a row a partition
    index = F.col("__before") + F.col("__at").bitwiseAND(F.lit(2**33 - 1))
    return placed.join(F.broadcast(before), "__p").withColumn("index", index).drop("__p", "__at", "__before")


def instructions(rows: DataFrame, order: list[str]) -> DataFrame:
    """Instruction rows (messages, ground_truth JSON, constraint, constraint_type): the first message is the prompt, blank ones
    are left out, bad JSON is an empty object, ids are running numbers."""
    prompt = _filled(F.get("messages", F.lit(0))["content"])
    kept = rows.withColumn("prompt", prompt).filter("prompt IS NOT NULL")
    truth = F.coalesce(F.to_json(F.try_parse_json("ground_truth")), F.lit("{}"))
    return numbered(kept, order).select(F.col("index").cast("string").alias("id"), "prompt", truth.alias("ground_truth"), "constraint", "constraint_type")


def long_context(rows: DataFrame, id_col: str, prompt_col: str, context_col: str) -> DataFrame:
    """Rows with a long context; other columns go to metadata with the context's length."""
    rest = [c for c in rows.columns if c not in (id_col, prompt_col, context_col)]
    meta = F.to_json(F.struct(*rest, F.length(context_col).alias("context_length")))
    return rows.select(F.col(id_col).cast("string").alias("id"), F.col(prompt_col).alias("prompt"), F.col(context_col).alias("context"), meta.alias("metadata"))


def documents_of(context: Column) -> Column:
    """Files of a struct of titles and sentence arrays: array of (filename, title, content)."""
    pairs = F.arrays_zip(context["title"].alias("title"), context["sentences"].alias("sentences"))
    return F.transform(pairs, lambda p, i: F.struct(file_name(i, p["title"]).alias("filename"), p["title"].alias("title"), F.array_join(p["sentences"], "\n").alias("content")))


def multi_hop(rows: DataFrame) -> DataFrame:
    """(id, question, answer, context struct) rows with their documents as JSON context."""
    return rows.select(F.col("id").cast("string").alias("id"), F.col("question").alias("prompt"), F.to_json(documents_of(F.col("context"))).alias("context"), F.col("answer").alias("expected_answer"))


def code_repair(rows: DataFrame) -> DataFrame:
    """Repair rows; an image or hints under either of their names."""
    some = lambda *names: F.coalesce(*(_filled(F.col(n)) for n in names if n in rows.columns), F.lit(None).cast("string"))
    return rows.select(F.col("instance_id").alias("id"), F.col("problem_statement").alias("prompt"), "repo", "base_commit", some("docker_image", "image_name").alias("docker_image"), some("hints_text", "hints").alias("hints"))


def function_calls(rows: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """Rows with query, tools and answers (JSON text); rows that lack one are left out before the limit counts."""
    whole = rows.filter(_filled(F.col("query")).isNotNull() & F.try_parse_json("tools").isNotNull() & F.try_parse_json("answers").isNotNull())
    whole = whole.orderBy(*order).limit(limit) if limit is not None else whole
    return whole.select(F.col("id").cast("string").alias("id"), F.col("query").alias("prompt"), tools.openai_tools("tools").alias("tools"), P.native_tool_calls("answers").alias("expected"))


def math_rows(rows: DataFrame, order: list[str], id_col: str | None = None, prompt_col: str = "prompt", answer_col: str | None = None, context_col: str | None = None) -> DataFrame:
    """Problems as tasks; rows without a prompt are left out, and tasks without an id get their running number among the others.
    Other columns go to metadata, with the answer under expected_answer."""
    kept = numbered(rows.filter(F.coalesce(F.col(prompt_col), F.lit("")) != ""), order)
    number = F.col("index").cast("string")
    ids = F.coalesce(F.col(id_col).cast("string"), number) if id_col else number
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    rest = [c for c in rows.columns if c not in (id_col, prompt_col, context_col, "expected_answer")]
    context = F.col(context_col).cast("string") if context_col else F.lit(None).cast("string")
    return kept.select(ids.alias("id"), F.col(prompt_col).alias("prompt"), context.alias("context"), F.to_json(F.struct(*rest, answer.alias("expected_answer"))).alias("metadata"))


def of_repositories(rows: DataFrame, names: list[str] | None) -> DataFrame:
    """Repair rows of some repositories; all without names."""
    return rows.filter(F.col("repo").isin(names)) if names else rows


def conversation_calls(rows: DataFrame) -> DataFrame:
    """Conversations (id, conversation array of from and value): the first human message, and the calls of the first gpt one."""
    first = lambda who: F.get(F.filter("conversation", lambda m: m["from"] == who), F.lit(0))["value"]
    return rows.select(F.col("id").cast("string").alias("id"), first("human").alias("prompt"), P.tool_calls(first("gpt")).alias("expected")).filter("prompt IS NOT NULL")


def source_chunks(rows: DataFrame, id_col: str, text_col: str, size: int, overlap: int, least: int = 0, most: int | None = None) -> DataFrame:
    """Documents of at least so many characters as tasks, one a chunk, at most so many a document."""
    parts = chunked(rows.filter(F.length(text_col) >= least), id_col, text_col, size, overlap, most)
    return parts.select(F.concat(F.col(id_col).cast("string"), F.lit("-"), F.col("chunk").cast("string")).alias("id"), F.col("text").alias("context"))


def workspace(name: Column, kind: Column, title: Column) -> Column:
    """A file as a block of a prompt."""
    return F.concat(F.lit('<file name="'), name, F.lit('" type="'), kind, F.lit('" title="'), title, F.lit('"/>'))


def system_prompt(*parts: Column) -> Column:
    """Parts that aren't null or blank, with blank lines between."""
    return F.concat_ws("\n\n", *(_filled(p) for p in parts))
