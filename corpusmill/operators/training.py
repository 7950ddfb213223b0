"""Article mapping, question and answer records, and training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import drop_boilerplate, rstrip, strip

#: A mapping is broadcast up to this many rows and joined by shuffle beyond.
MAX_BROADCAST_MAP = 200_000


def joined(title: Column, summary: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit("")))


def map_table(spark, groups: dict[str, list[str]]) -> DataFrame:
    """(asis, clean) of canonical names and their variants."""
    return spark.createDataFrame([(v, k) for k, variants in groups.items() for v in variants], "asis string, clean string")


def mapped(rows: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """``column`` replaced by its canonical name where the mapping has one."""
    small = mapping.limit(MAX_BROADCAST_MAP + 1).count() <= MAX_BROADCAST_MAP
    found = rows.join(F.broadcast(mapping) if small else mapping, F.col(column) == F.col("asis"), "left")
    return found.withColumn(column, F.coalesce("clean", column)).drop("asis", "clean")


def title_and_body(text: Column, fallback: Column) -> list[Column]:
    """The first line and the rest; an empty title falls back to the file's."""
    parts = F.split(text, "\n", 2)
    return [F.coalesce(F.nullif(strip(F.element_at(parts, 1)), F.lit("")), fallback).alias("title"), strip(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))).alias("body")]


def blocks(text: Column) -> Column:
    """Stretches of text between blank lines."""
    return F.filter(F.transform(F.split(text, r"\n[ \t]*(?:\n[ \t]*)+"), strip), lambda b: b != "")


def monolith(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, title, body) of blocks with both."""
    rows = docs.select(key, F.explode(blocks(F.col("text"))).alias("block"))
    return rows.select(key, *title_and_body(F.col("block"), F.lit(""))).where("title <> '' AND body <> ''")


def line_questions(docs: DataFrame, template: str, key: str = "doc_id", longest: int = 120) -> DataFrame:
    """One article in each line: a question from its first sentence."""
    rows = docs.select(key, F.explode(F.split("text", "\n")).alias("answer")).withColumn("answer", strip(F.col("answer"))).where("answer <> ''")
    hint = F.substring(F.element_at(F.split("answer", r"(?<=[.!?])\s+", 2), 1), 1, longest)
    return rows.select(key, F.replace(F.lit(template), F.lit("{title_hint}"), hint).alias("question"), "answer")


def turns(conversations: DataFrame) -> DataFrame:
    """Every turn with the one after it; a window inside each conversation."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    return conversations.select("conv_id", "turn", "role", F.col("text").alias("question"), F.lead("role").over(w).alias("next_role"), F.lead("text").over(w).alias("answer"))


def chat_pairs(conversations: DataFrame) -> DataFrame:
    return turns(conversations).where("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", "question", "answer")


def chat_record(question: Column, answer: Column) -> Column:
    """struct<messages, text>: both roles, and the flat form."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    flat = F.concat(F.lit("<|user|>\n"), question, F.lit("\n<|assistant|>\n"), answer)
    return F.struct(F.array(message("user", question), message("assistant", answer)).alias("messages"), flat.alias("text"))


def chat_rows(pairs: DataFrame, max_answer: int | None = None) -> DataFrame:
    """Pairs cleaned of boilerplate, empty ones left out, answers cut to a length."""
    rows = pairs.withColumn("question", drop_boilerplate(F.col("question"))).withColumn("answer", drop_boilerplate(F.col("answer"))).where("question <> '' AND answer <> ''")
    return rows.withColumn("answer", rstrip(F.substring("answer", 1, max_answer))) if max_answer else rows


def stop_lines(docs: DataFrame, stop: str = "</s>", key: str = "doc_id") -> DataFrame:
    rows = docs.select(key, F.explode(F.split("text", "\n")).alias("line")).withColumn("line", strip(F.col("line"))).where("line <> ''")
    return rows.withColumn("line", F.concat("line", F.lit(" " + stop)))


def instruction(question: Column, answer: Column) -> Column:
    return F.concat(F.lit("### Instruction:\n"), question, F.lit("\n\n### Response:\n"), answer)


def request(body: Column) -> list[Column]:
    """Parameters with their defaults, and the prompt of whichever form the request has."""
    p = F.from_json(body, "struct<inputs:string,input:string,messages:array<struct<role:string,content:string>>,parameters:struct<max_new_tokens:bigint,max_tokens:bigint,temperature:double,top_p:double>>")
    args = p["parameters"]
    said = F.array_join(F.transform(p["messages"], lambda m: m["content"]), "\n")
    return [
        F.coalesce(args["max_new_tokens"], args["max_tokens"], F.lit(256)).alias("max_new_tokens"), F.coalesce(args["temperature"], F.lit(0.7)).alias("temperature"),
        F.coalesce(args["top_p"], F.lit(0.9)).alias("top_p"), F.coalesce(said, F.nullif(p["inputs"], F.lit("")), p["input"], F.lit("")).alias("prompt"),
    ]


def until(ids: Column, end: int) -> Column:
    """The ids before the first end token."""
    at = F.array_position(ids, F.lit(end).cast("long")).cast("int")
    return F.when(at > 0, F.slice(ids, F.lit(1), at - 1)).otherwise(ids)


def without_pipes(rows: DataFrame, columns: tuple[str, ...] = ("targets", "chunk_text", "title", "section")) -> DataFrame:
    """Rows for a pipe-separated file: the separator is deleted from text columns."""
    return rows.withColumns({c: F.replace(F.col(c), F.lit("|"), F.lit("")) for c in rows.columns if c in columns})


def text_files(rows: DataFrame) -> DataFrame:
    """Title, a blank line and the content; nothing for empty contents."""
    return rows.where(F.length("content") > 0).withColumn("content", F.concat_ws("\n\n", strip(F.col("title")), F.col("content"))).drop("title")


def some_title(title: Column) -> Column:
    return F.coalesce(F.nullif(title, F.lit("")), F.lit("no_title"))
