"""Answers to problems, responses and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import answer_group_key, hidden_answer
from .outline import DELETED, DELIMITER

#: Response types whose answers are counted.
RESPONSES = ("choiceresponse", "optionresponse", "multiplechoiceresponse", "numericalresponse", "stringresponse", "formularesponse")
PART = ("answer_id", "value", "variant", "correct", "response_type", "question")


def first_and_last_answers(checks: DataFrame) -> DataFrame:
    """Answer parts of each user's first and last check of a problem; a single check is both.

    checks: course_id, problem_id, username, ts, answers (map of answer id to struct of value, variant, correct, ...).
    """
    ends = checks.groupBy("course_id", "problem_id", "username").agg(F.min(F.struct("ts", F.to_json("answers").alias("a"), F.map_entries("answers").alias("e"))).alias("first"), F.max(F.struct("ts", F.to_json("answers").alias("a"), F.map_entries("answers").alias("e"))).alias("last"), F.count("*").alias("n"))
    both = F.array_compact(F.array(
        F.struct(F.col("first.ts").alias("ts"), F.col("first.e").alias("e"), F.lit(True).alias("is_first"), (F.col("n") == 1).alias("is_last")),
        F.when(F.col("n") > 1, F.struct(F.col("last.ts").alias("ts"), F.col("last.e").alias("e"), F.lit(False).alias("is_first"), F.lit(True).alias("is_last"))),
    ))
    df = ends.withColumn("s", F.explode(both)).withColumn("part", F.explode("s.e"))
    return df.select("course_id", "problem_id", "username", "s.ts", "s.is_first", "s.is_last", F.col("part.key").alias("answer_id"), "part.value.*").where(~hidden_answer(F.col("answer_id")))


#: The response types whose answers are choices, and the facts that metadata may add.
CHOICES = ("choiceresponse", "multiplechoiceresponse")
FACTS = ("question", "response_type", "input_type", "problem_display_name")


def with_metadata(parts: DataFrame, metadata: DataFrame) -> DataFrame:
    """Answer parts with the facts that they lack from metadata by answer_id, and with answers named.

    parts: answer_id, answer and answer_value_id (lists), and some of the facts. A part of choices without an answer gets
    the names of its choices, '' for those unknown; other parts without one take the value as their answer.
    """
    known = [c for c in FACTS if c in parts.columns]
    facts = metadata.select("answer_id", F.struct(*known, "answer_value_id_map").alias("_meta")).dropDuplicates(["answer_id"])
    df = parts.join(facts, "answer_id", "left").withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_meta.{c}"), F.col(c)) for c in known})
    named = F.transform("answer_value_id", lambda v: F.coalesce(F.try_element_at("_meta.answer_value_id_map", v), F.lit("")))
    lacks, choice = F.col("_meta").isNotNull() & F.col("answer").isNull(), F.coalesce(F.col("response_type").isin(*CHOICES), F.lit(False))
    answer = F.when(lacks & choice & F.col("_meta.answer_value_id_map").isNotNull(), named).when(lacks & ~choice, F.col("answer_value_id")).otherwise(F.col("answer"))
    value = F.when(~(lacks & ~choice), F.col("answer_value_id"))
    return df.withColumns({"answer": answer, "answer_value_id": value}).drop("_meta")


def fill_facts(parts: DataFrame, metadata: DataFrame) -> DataFrame:
    """Answer parts whose empty facts are those that metadata has of their answer_id; answers stay as they are."""
    known = [c for c in FACTS if c in parts.columns]
    facts = metadata.select("answer_id", F.struct(*known).alias("_meta")).dropDuplicates(["answer_id"])
    df = parts.join(facts, "answer_id", "left")
    return df.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_meta.{c}"), F.col(c)) for c in known}).drop("_meta").select(*parts.columns)


def answer_distribution(answers: DataFrame) -> DataFrame:
    """Counts of first and last answers by course, part, value and variant, with the facts of the newest answer."""
    df = answers.where(F.col("response_type").isin(*RESPONSES)).withColumn("group", answer_group_key(F.col("value"), F.col("variant")))
    newest = F.max(F.struct("ts", "username", "question", "problem_id", "correct", "value", "variant"))
    df = df.groupBy("course_id", "answer_id", "group").agg(F.count_if("is_first").alias("first_count"), F.count_if("is_last").alias("last_count"), newest.alias("x"))
    return df.select("course_id", F.col("x.problem_id").alias("problem_id"), "answer_id", F.col("x.value").alias("value"), F.col("x.variant").alias("variant"), F.col("x.correct").alias("correct"), F.col("x.question").alias("question"), "first_count", "last_count")


def latest_responses(checks: DataFrame) -> DataFrame:
    """Each user's last response to a problem by part, with attempts, first and last date."""
    df = checks.groupBy("course_id", "problem_id", "username").agg(
        F.max(F.struct("ts", F.map_entries("answers").alias("e"))).alias("x"), F.count("*").alias("total_attempts"), F.min("ts").alias("first_attempt_date"), F.max("ts").alias("last_attempt_date"),
    ).withColumn("part", F.explode("x.e"))
    return df.select("course_id", "problem_id", "username", F.col("part.key").alias("answer_id"), F.col("part.value.value").alias("answer"), F.col("part.value.correct").alias("was_correct"), "total_attempts", "first_attempt_date", "last_attempt_date")


def response_location(responses: DataFrame, outline: DataFrame, problem: str = "problem") -> DataFrame:
    """Responses with location (the path of their block and the problem's name) and order of their block, by course,
    place and first attempt; problems whose block isn't in the outline are marked and, at -1, come first."""
    blocks = outline.select(F.col("block_id").alias("problem_id"), "course_path", "sort_idx")
    df = responses.join(blocks, "problem_id", "left")
    location = F.concat(F.coalesce("course_path", F.lit(DELETED)), F.lit(DELIMITER), F.col(problem))
    return df.withColumns({"location": location, "sort_idx": F.coalesce("sort_idx", F.lit(-1))}).drop("course_path").orderBy("course_id", "sort_idx", "first_attempt_date")


def tags_distribution(checks: DataFrame) -> DataFrame:
    """Total and correct submissions of each problem, for each value of its newest tags."""
    df = checks.groupBy("course_id", "problem_id").agg(F.count("*").alias("total_submissions"), F.count_if("is_correct").alias("correct_submissions"), F.max(F.struct("ts", F.map_entries("tags").alias("e")))["e"].alias("tags"))
    df = df.select("*", F.explode("tags").alias("t")).select("course_id", "problem_id", "total_submissions", "correct_submissions", F.col("t.key").alias("tag_name"), F.explode("t.value").alias("tag_value"))
    return df.drop("tags")
