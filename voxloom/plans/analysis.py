"""Analysis per topic by a model the user supplies: prompt, answer, stricter retry, fallback, resume."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions import analysis_texts as X
from voxloom.functions import answers as A
from voxloom.operators.lookup import settled
from voxloom.session import cut_lineage
from voxloom.settings import Settings

# prompts (topic_id, attempt, prompt) -> answers (topic_id, attempt, answer)
Answerer = Callable[[DataFrame], DataFrame]


def _filled(template: str, *values):
    """A %s template as a column."""
    pieces = [F.lit(p.replace("%%", "%")) for p in template.split("%s")]
    parts = [pieces[0]]
    for value, piece in zip(values, pieces[1:]):
        parts += [value.cast("string"), piece]
    return F.concat(*parts)


def duplicated_members(comments: DataFrame) -> DataFrame:
    """topic_id, duplicated: comments of a topic whose text occurs more than once anywhere."""
    return comments.groupBy("topic_id").agg(F.count_if(F.col("frequency") > 1).alias("duplicated"))


def topic_payloads(
    topics: DataFrame, comments: DataFrame, samples: DataFrame, settings: Settings
) -> DataFrame:
    """What the model gets per topic: eight columns, ``prompt`` last.

    topics: topic_id, topic_size, keywords, auto_name. samples: topic_id, samples.
    """
    topics = settled(topics)
    n = topics.agg(F.greatest(F.sum("topic_size"), F.lit(1))).scalar()
    none = F.array().cast("array<string>")
    rows = (
        topics.filter("topic_id <> -1")
        .join(duplicated_members(comments), "topic_id", "left")
        .join(samples, "topic_id", "left")
        .select(
            "topic_id",
            F.coalesce("auto_name", F.lit("")).alias("auto_name"),
            "topic_size",
            F.round(100 * F.col("topic_size") / n, 1).alias("topic_percentage"),
            "keywords",
            F.slice(F.coalesce("samples", none), 1, settings.samples_per_topic).alias("samples"),
            F.when(F.col("duplicated") > 0, _filled(X.DUPLICATE_NOTE, F.col("duplicated")))
            .otherwise("")
            .alias("duplicate_note"),
        )
    )
    return rows.withColumn("prompt", topic_prompt())


def topic_prompt():
    note = F.when(F.col("duplicate_note") != "", F.concat("duplicate_note", F.lit("\n"))).otherwise("")
    sample_lines = F.transform("samples", lambda s: F.concat(F.lit("- "), s))
    return F.concat(
        F.lit(X.TOPIC_PROMPT_HEAD),
        _filled(X.SIZE_LINE, F.col("topic_size"), F.col("topic_percentage")),
        note,
        F.lit(X.KEYWORD_LINE),
        F.array_join(F.slice("keywords", 1, 10), X.LIST_COMMA),
        F.lit("\n" + X.SAMPLES_LINE),
        F.array_join(sample_lines, "\n"),
        F.lit(X.TOPIC_PROMPT_TAIL),
    )


def retry_prompt(prompt, errors):
    return F.concat(
        prompt, F.lit(X.RETRY_HEAD), F.array_join(errors, X.RETRY_SEPARATOR), F.lit(X.RETRY_TAIL)
    )


def answers_from_table(table: DataFrame) -> Answerer:
    """Answers made elsewhere: topic_id, attempt, answer."""

    def answer(prompts: DataFrame) -> DataFrame:
        asked = prompts.select("topic_id", "attempt")
        return asked.join(table.select("topic_id", "attempt", "answer"), ["topic_id", "attempt"], "left")

    return answer


def answers_from_model(chat: Callable[[list[str]], list[str | None]], tasks: int | None = None) -> Answerer:
    """Answers from a function of a list of prompts, called inside the tasks.

    One prompt per topic, spread over ``tasks`` (as many as the session has slots); a failing call counts as no answer.
    """

    def answer(prompts: DataFrame) -> DataFrame:
        def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                replies = []
                for prompt in batch["prompt"]:
                    try:
                        replies.append(chat([prompt])[0])
                    except Exception:  # a model failure is an invalid answer, handled by the retry
                        replies.append(None)
                yield pd.DataFrame(
                    {"topic_id": batch["topic_id"], "attempt": batch["attempt"], "answer": replies}
                )

        slots = tasks or prompts.sparkSession.sparkContext.defaultParallelism
        return prompts.repartition(slots, "topic_id").mapInPandas(
            call, "topic_id int, attempt int, answer string"
        )

    return answer


def checked(answers: DataFrame) -> DataFrame:
    """answers plus fields, actions and errors; a missing answer fails every check."""
    text = F.coalesce("answer", F.lit(""))
    return (
        answers.withColumn("fields", A.parse_fields(text))
        .withColumn("actions", A.parse_actions(text, F.col("fields")))
        .withColumn("errors", A.contract_errors(F.col("fields"), F.col("actions")))
    )


def _output(rows: DataFrame, source: str) -> DataFrame:
    return rows.select(
        "topic_id",
        F.lit(source).alias("source"),
        *[A.field(F.col("fields"), key).alias(key) for key in A.ANSWER_FIELDS],
        F.col("actions").alias("recommended_actions"),
    )


def fallback_output(payloads: DataFrame) -> DataFrame:
    return payloads.select(
        "topic_id",
        F.lit("fallback").alias("source"),
        A.fallback_name(F.col("keywords")).alias("business_name"),
        F.lit(X.FALLBACK_DESCRIPTION).alias("description"),
        F.lit(X.FALLBACK_ROOT_CAUSE).alias("root_cause"),
        F.lit(X.FALLBACK_SEVERITY).alias("severity"),
        F.lit(X.FALLBACK_SENTIMENT).alias("sentiment"),
        F.array(*[F.lit(a) for a in X.FALLBACK_ACTIONS]).alias("recommended_actions"),
    )


def analysed(
    payloads: DataFrame,
    answer: Answerer,
    settings: Settings,
    on_stage: Callable[[DataFrame], None] = lambda finished: None,
) -> DataFrame:
    """topic_id, source, business_name .. sentiment, recommended_actions; one row per payload.

    Answers are checkpointed, so that no model is asked twice. ``on_stage`` gets the finished rows of
    every stage as soon as they are known.
    """
    payloads = settled(payloads)
    finished = []

    def done(rows: DataFrame) -> None:
        finished.append(rows)
        on_stage(rows)

    open_prompts = payloads.select("topic_id", F.lit(0).alias("attempt"), "prompt")
    for attempt in range(settings.max_retries + 1):
        replies = cut_lineage(checked(answer(open_prompts)))
        done(_output(replies.filter(F.size("errors") == 0), "llm" if attempt == 0 else "llm_retry"))
        refused = replies.filter(F.size("errors") > 0).select("topic_id", "errors")
        open_prompts = refused.join(payloads.select("topic_id", "prompt"), "topic_id").select(
            "topic_id", F.lit(attempt + 1).alias("attempt"), retry_prompt(F.col("prompt"), F.col("errors")).alias("prompt")
        )
    done(fallback_output(payloads.join(open_prompts.select("topic_id"), "topic_id", "left_semi")))
    result = finished[0]
    for rows in finished[1:]:
        result = result.unionByName(rows)
    return result


def resumed(payloads: DataFrame, done: DataFrame, answer: Answerer, settings: Settings, **stages) -> DataFrame:
    """Outputs of an earlier run plus those of the topics it had not finished."""
    remaining = payloads.join(done.select("topic_id"), "topic_id", "left_anti")
    return done.unionByName(analysed(remaining, answer, settings, **stages))


def analysed_in_batches(
    payloads: DataFrame,
    done: DataFrame | None,
    answer: Answerer,
    settings: Settings,
    keep: Callable[[DataFrame], None],
) -> None:
    """Analyse the topics that are not ``done`` a few at a time; ``keep`` gets what is finished at once.

    A run that breaks off loses the answers of one batch at most.
    """
    if done is not None:
        payloads = payloads.join(done.select("topic_id"), "topic_id", "left_anti")
    payloads = settled(payloads)
    ids = sorted(r.topic_id for r in payloads.select("topic_id").collect())  # one number per topic
    for at in range(0, max(len(ids), 1), settings.analysis_batch):
        some = payloads.filter(F.col("topic_id").isin(ids[at : at + settings.analysis_batch]))
        analysed(some, answer, settings, on_stage=keep)


def topic_attributes(outputs: DataFrame) -> DataFrame:
    """topic_id and the seven attributes the reports join, actions flattened."""
    return outputs.select(
        "topic_id",
        *A.ANSWER_FIELDS,
        F.array_join("recommended_actions", " | ").alias("recommended_actions"),
    )


def executive_prompt(named_topics: DataFrame) -> DataFrame:
    """One row: the prompt with one line per topic.

    named_topics: topic_id, topic_name, topic_size, keywords, description (nullable).
    """
    detail = F.coalesce(
        F.nullif("description", F.lit("")), F.array_join(F.slice("keywords", 1, 6), X.LIST_COMMA)
    )
    line = _filled(X.EXECUTIVE_LINE, F.col("topic_name"), F.col("topic_size"), detail)
    lines = F.array_sort(F.collect_list(F.struct("topic_id", line.alias("line"))))
    block = F.array_join(F.transform(lines, lambda x: x["line"]), "\n")
    return named_topics.filter("topic_id <> -1").agg(
        F.concat(F.lit(X.EXECUTIVE_HEAD), block, F.lit(X.EXECUTIVE_TAIL)).alias("prompt")
    )


def executive_report(named_topics: DataFrame, chat: Callable[[list[str]], list[str]]) -> str:
    """The model's executive text; the reason instead of it when the call fails."""
    try:
        return chat([executive_prompt(named_topics).first()["prompt"]])[0]
    except Exception as reason:
        return X.EXECUTIVE_FAILED % reason
