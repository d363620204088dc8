"""Chat-record operators on ``messages: array<struct<role, content>>``.

Covers assembling turn tables into records (S3), appending the answer turn
(P4), ChatML rendering of training text and prompts (P5, P6), three-field form
(P7), thinking control and splitting (P8, P9), response cleanup (P12) and the
running context length / ``/clear`` segments of a chat (W2, W3).

All work is higher-order array functions on one row, or windows partitioned
by conversation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomis.functions.plan import pin_columns
from loomis.functions.text import chatml_turn, render_messages, strip_ws, token_count
from loomis.schemas import (CLEAR_COMMAND, EMPTY_THINK_BLOCK, IM_START, NO_THINK_SUFFIX,
                            PLAIN_ANSWER_PREFIX, PLAIN_USER_PREFIX, SPECIAL_TOKENS, THINK_SUFFIX)


# ---------------------------------------------------------------- S3
def assemble_conversations(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                           role: str = "role", text: str = "text") -> DataFrame:
    """Turn table → one ordered ``messages`` array per conversation.

    ``collect_list`` is partially aggregated per task; the group is one
    conversation, whose size the chat context itself bounds."""
    agg = turns.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct(F.col(order).alias("o"), F.col(role).alias("role"), F.col(text).alias("content")))).alias("_m"))
    return agg.select(key, F.transform("_m", lambda m: F.struct(m["role"].alias("role"),
                                                                m["content"].alias("content"))).alias("messages"))


def last_role_index(messages, role: str = "assistant") -> Column:
    """1-based index of the last message with ``role`` (0 when absent)."""
    m = F.col(messages) if isinstance(messages, str) else messages
    pos = F.array_position(F.reverse(F.transform(m, lambda x: x["role"])), role)
    return F.when(pos > 0, F.size(m) - pos + 1).otherwise(F.lit(0)).cast("int")


def split_answer(df: DataFrame, messages: str = "messages") -> DataFrame:
    """messages → (context, answer): the last assistant turn is the answer and
    the turns before it the context; without one the context is everything."""
    idx = last_role_index(messages)
    return df.withColumn("_i", idx).select(
        "*",
        F.when(F.col("_i") > 0, F.slice(messages, F.lit(1), F.col("_i") - 1)).otherwise(F.col(messages)).alias("context"),
        F.when(F.col("_i") > 0, F.element_at(messages, F.col("_i"))["content"]).alias("answer")).drop("_i")


# ---------------------------------------------------------------- P4
def append_answer_turn(df: DataFrame, messages: str = "context", answer: str = "answer",
                       out: str = "messages") -> DataFrame:
    """Append ``{"role": "assistant", "content": answer}``; rows without a
    non-empty answer are dropped (``quarantine_rejects`` reports them)."""
    turn = F.struct(F.lit("assistant").alias("role"), F.col(answer).alias("content"))
    return df.filter(F.col(answer).isNotNull() & (F.length(answer) > 0)) \
             .withColumn(out, F.array_append(F.col(messages), turn))


# ---------------------------------------------------------------- P5 / P6
def render_training_text(df: DataFrame, messages: str = "messages", out: str = "text") -> DataFrame:
    return df.withColumn(out, render_messages(messages))


def render_prompt(messages, enable_thinking: bool | None = None) -> Column:
    """ChatML prompt ending in the generation header; thinking disabled adds
    the empty think block."""
    p = F.concat(render_messages(messages), F.lit(IM_START + "assistant\n"))
    if enable_thinking is False:
        p = F.concat(p, F.lit(EMPTY_THINK_BLOCK))
    return p


def render_plain_prompt(messages) -> Column:
    """Fallback without a chat template: system text, ``用户：`` user lines,
    ``回答：`` assistant lines, closed by an open ``回答：``."""
    m = F.col(messages) if isinstance(messages, str) else messages
    lines = F.transform(m, lambda x: F.when(x["role"] == "user", F.concat(F.lit(PLAIN_USER_PREFIX), x["content"]))
                        .when(x["role"] == "assistant", F.concat(F.lit(PLAIN_ANSWER_PREFIX), x["content"]))
                        .otherwise(x["content"]))
    return F.array_join(F.array_append(lines, F.lit(PLAIN_ANSWER_PREFIX)), "\n")


def render_prompts(df: DataFrame, messages: str = "context", template_present: Column | bool = True) -> DataFrame:
    tp = template_present if isinstance(template_present, Column) else F.lit(bool(template_present))
    return df.select("*",
                     F.when(tp, render_prompt(messages)).otherwise(render_plain_prompt(messages)).alias("prompt"),
                     F.when(tp, render_prompt(messages, enable_thinking=False))
                      .otherwise(render_plain_prompt(messages)).alias("prompt_no_think"),
                     render_plain_prompt(messages).alias("prompt_plain"))


# ---------------------------------------------------------------- P7
def to_three_field(df: DataFrame, messages: str = "messages") -> DataFrame:
    """messages → (system, prompt, response): the first system turn, the
    non-system context before the last assistant turn (contents joined by a
    newline) and that assistant turn's content."""
    s = split_answer(df, messages)
    rest = F.filter("context", lambda x: x["role"] != "system")
    first_system = F.try_element_at(F.transform(F.filter(messages, lambda x: x["role"] == "system"),
                                                lambda x: x["content"]), F.lit(1))
    return s.select("*", F.coalesce(first_system, F.lit("")).alias("system"),
                    F.array_join(F.transform(rest, lambda x: x["content"]), "\n").alias("prompt"),
                    F.col("answer").alias("response")).drop("context", "answer")


def from_three_field(df: DataFrame, system: str = "system", prompt: str = "prompt",
                     response: str = "response", out: str = "messages") -> DataFrame:
    """Inverse of ``to_three_field``: [system?] + user(prompt) + assistant(response)."""
    sys_turn = F.when(F.length(F.coalesce(F.col(system), F.lit(""))) > 0,
                      F.array(F.struct(F.lit("system").alias("role"), F.col(system).alias("content"))))
    body = F.array(F.struct(F.lit("user").alias("role"), F.col(prompt).alias("content")),
                   F.struct(F.lit("assistant").alias("role"), F.col(response).alias("content")))
    return df.withColumn(out, F.concat(F.coalesce(sys_turn, F.array().cast("array<struct<role:string,content:string>>")), body))


# ---------------------------------------------------------------- P8
def thinking_control(df: DataFrame, messages: str = "messages", mode: str = "mode") -> DataFrame:
    """Append `` /think`` (thinking) or `` /no_think`` to the last user turn."""
    idx = last_role_index(messages, "user")
    suffix = F.when(F.col(mode) == "thinking", F.lit(" " + THINK_SUFFIX)).otherwise(F.lit(" " + NO_THINK_SUFFIX))
    return pin_columns(df.withColumn("_u", idx).withColumn("_sfx", suffix)).withColumn(
        messages, F.transform(messages, lambda x, i: F.when(
            i + 1 == F.col("_u"), F.struct(x["role"].alias("role"), F.concat(x["content"], F.col("_sfx")).alias("content")))
            .otherwise(x))).drop("_u", "_sfx")


# ---------------------------------------------------------------- P9
THINK_BLOCK = r"(?s)<think>(.*?)</think>"


def split_thinking(df: DataFrame, response: str = "response") -> DataFrame:
    """response → (mode, think_text, final_text).  A closed block with text is
    thinking; an empty or absent block is non-thinking; an unclosed block (cut
    generation) is thinking with an empty final answer."""
    r = F.col(response)
    closed = r.rlike(THINK_BLOCK)
    unclosed = (F.locate("<think>", r) > 0) & ~closed
    think = F.when(closed, strip_ws(F.regexp_extract(r, THINK_BLOCK, 1))) \
             .when(unclosed, strip_ws(F.substring_index(r, "<think>", -1))).otherwise(F.lit(""))
    final = F.when(unclosed, F.lit("")).otherwise(strip_ws(F.regexp_replace(r, THINK_BLOCK, "")))
    return df.select("*", F.when(closed & (think != "") | unclosed, F.lit("thinking"))
                     .otherwise(F.lit("non_thinking")).alias("mode"),
                     think.alias("think_text"), final.alias("final_text"))


# ---------------------------------------------------------------- P12
SPECIAL_RE = "|".join(t.replace("|", r"\|") for t in SPECIAL_TOKENS)


def clean_response(c, max_chars: int = 80) -> Column:
    """Drop special tokens, strip, keep the first line, cut to ``max_chars``."""
    x = strip_ws(F.regexp_replace(F.col(c) if isinstance(c, str) else c, SPECIAL_RE, ""))
    return F.substring(F.split_part(x, F.lit("\n"), F.lit(1)), 1, max_chars)


# ---------------------------------------------------------------- W2
def context_length(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """Running token count of the ChatML context after each turn."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return turns.withColumn("turn_tokens", token_count(chatml_turn(role, text)).cast("long")) \
                .withColumn("context_tokens", F.sum("turn_tokens").over(w))


# ---------------------------------------------------------------- W3
def context_segments(turns: DataFrame, key: str = "conv_id", order: str = "turn",
                     role: str = "role", text: str = "text") -> DataFrame:
    """``/clear`` from the user starts a new segment (the command itself is
    dropped); the conversation's first system turn is carried into every segment."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    is_clear = F.coalesce((F.col(role) == "user") & (strip_ws(text) == CLEAR_COMMAND), F.lit(False)).cast("int")
    t = turns.withColumn("segment", F.sum(is_clear).over(w).cast("long")).withColumn("_clr", is_clear)
    sys_turn = t.filter(F.col(role) == "system").groupBy(key).agg(
        F.min_by(F.col(text), F.col(order)).alias("_sys"))
    seg = t.filter((F.col("_clr") == 0) & (F.col(role) != "system")).groupBy(key, "segment").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(token_count(chatml_turn(role, text))).alias("_tok"))
    out = seg.join(sys_turn, key, "left")
    return out.select(key, "segment",
                      (F.col("_n") + F.when(F.col("_sys").isNotNull(), 1).otherwise(0)).cast("long").alias("n_turns"),
                      F.col("_sys").isNotNull().alias("has_system"),
                      (F.col("_tok") + F.coalesce(token_count(chatml_turn(F.lit("system"), F.col("_sys"))),
                                                  F.lit(0))).cast("long").alias("context_tokens"))
