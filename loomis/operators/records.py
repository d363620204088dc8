"""Record operators: normalizing polymorphic raw records (VARIANT), answer
extraction, quarantine, validation rules, profiling, task selection, material
prompts, choice options and category / task reports.

Raw records keep the polymorphic parts as VARIANT (type tests with
``schema_of_variant``) plus their raw JSON text (``from_json`` with string
fields keeps nested answers byte-for-byte, key order included).  After
``normalize_messages`` every record has the fixed ``CHAT_RECORD`` shape.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomis.functions.plan import pin_columns
from loomis.functions.text import preview, render_messages, strip_ws, token_count
from loomis.operators.chatml import last_role_index
from loomis.schemas import DEFAULT_MAX_LEN, MATERIAL_SYSTEM_PROMPT, MATERIAL_USER_PREFIX


def _vtype(v: Column) -> Column:
    """Coarse VARIANT type: string / array / object / null / scalar."""
    t = F.schema_of_variant(v)
    return (F.when(v.isNull(), F.lit(None))
            .when(t == "STRING", F.lit("string"))
            .when(t.startswith("ARRAY"), F.lit("array"))
            .when(t.startswith("OBJECT"), F.lit("object"))
            .when(t == "VOID", F.lit("null"))
            .otherwise(F.lit("scalar")))


# ---------------------------------------------------------------- P1
def content_text(c: Column) -> Column:
    """VARIANT content → text: a string as is; a block list → its ``text``
    blocks joined by newline (other blocks dropped); missing → ''; anything
    else → its JSON text."""
    blocks = F.try_variant_get(c, "$", "array<variant>")
    texts = F.transform(F.filter(blocks, lambda blk: F.try_variant_get(blk, "$.type", "string") == "text"),
                        lambda blk: F.coalesce(F.try_variant_get(blk, "$.text", "string"), F.lit("")))
    ty = _vtype(c)
    return (F.when(c.isNull() | (ty == "null"), F.lit(""))
            .when(ty == "string", F.try_variant_get(c, "$", "string"))
            .when(ty == "array", F.array_join(texts, "\n"))
            .otherwise(F.to_json(c)))


def normalize_messages(df: DataFrame, body: str = "body") -> DataFrame:
    """Resolve ``body.messages`` (list, or JSON string of a list) into
    ``array<struct<role, content>>`` and record its type.

    Adds ``messages_type`` (list / json_string / absent / other / bad_json),
    ``content_type`` of the first message and ``messages``.  Intermediate
    VARIANT values are pinned once per row instead of being re-parsed by
    every expression that reads them."""
    d = pin_columns(df.withColumn("_raw", F.try_variant_get(F.col(body), "$.messages", "variant")))
    d = pin_columns(d.withColumn("_ty", _vtype(F.col("_raw")))
                     .withColumn("_str", F.try_variant_get(F.col("_raw"), "$", "string")))
    d = pin_columns(d.withColumn("_pj", F.when(F.col("_ty") == "string", F.try_parse_json("_str"))))
    d = pin_columns(d.withColumn("_pty", _vtype(F.col("_pj"))))
    ty, pty = F.col("_ty"), F.col("_pty")
    mtype = (F.when(F.col("_raw").isNull() | (ty == "null"), F.lit("absent"))
             .when((ty == "string") & (pty == "array"), F.lit("json_string"))
             .when(ty == "string", F.lit("bad_json"))
             .when(ty == "array", F.lit("list"))
             .otherwise(F.lit("other")))
    d = pin_columns(d.withColumn("messages_type", mtype)
                     .withColumn("_parsed", F.when(ty == "array", F.col("_raw")).when(pty == "array", F.col("_pj"))))
    elems = F.try_variant_get(F.col("_parsed"), "$", "array<variant>")
    msgs = F.transform(elems, lambda m: F.struct(F.try_variant_get(m, "$.role", "string").alias("role"),
                                                 content_text(F.try_variant_get(m, "$.content", "variant")).alias("content")))
    first_c = F.try_variant_get(F.col("_parsed"), "$[0].content", "variant")
    ctype = F.when(first_c.isNull(), F.lit("string")).when(_vtype(first_c) == "array", F.lit("blocks")) \
             .when(_vtype(first_c) == "string", F.lit("string")).otherwise(F.lit("other"))
    ok = F.col("messages_type").isin("list", "json_string")
    return d.withColumn("messages", F.when(ok, msgs)).withColumn("content_type", F.when(ok, ctype)) \
            .drop("_raw", "_ty", "_str", "_pj", "_pty", "_parsed")


# ---------------------------------------------------------------- P2
def extract_answers(df: DataFrame, body: str = "body", body_text: str = "body_text") -> DataFrame:
    """``metadata`` dict / JSON string / bare string → ``answer`` text and
    ``answer_type`` (string / nested / bare / absent / bad_metadata).

    The answer text is read from the raw JSON with ``from_json(struct<answer:
    string>)`` so nested answers keep their key order; VARIANT is used for the
    type tests only.  Intermediate values are pinned once per row."""
    d = pin_columns(df.withColumn("_meta", F.try_variant_get(F.col(body), "$.metadata", "variant")))
    d = pin_columns(d.withColumn("_mty", _vtype(F.col("_meta")))
                     .withColumn("_mstr", F.try_variant_get(F.col("_meta"), "$", "string")))
    d = pin_columns(d.withColumn("_inner", F.when(F.col("_mty") == "string", F.try_parse_json("_mstr"))))
    d = pin_columns(d.withColumn("_ity", _vtype(F.col("_inner"))))
    mty, ity, meta, inner, meta_str = F.col("_mty"), F.col("_ity"), F.col("_meta"), F.col("_inner"), F.col("_mstr")
    is_obj = (mty == "object") | ((mty == "string") & (ity == "object"))
    obj_text = F.when(mty == "object", F.from_json(F.col(body_text), "struct<metadata:string>")["metadata"]) \
                .when((mty == "string") & (ity == "object"), meta_str)
    d = pin_columns(d.withColumn("_ans_raw", F.from_json(obj_text, "struct<answer:string>")["answer"])
                     .withColumn("_ans_var", F.when(mty == "object", F.try_variant_get(meta, "$.answer", "variant"))
                                 .when((mty == "string") & (ity == "object"),
                                       F.try_variant_get(inner, "$.answer", "variant"))))
    d = pin_columns(d.withColumn("_aty", _vtype(F.col("_ans_var"))))
    aty, ans_var = F.col("_aty"), F.col("_ans_var")
    answer = (F.when(meta.isNull() | (mty == "null"), F.lit(""))
              .when((mty == "string") & inner.isNull(), meta_str)
              .when(is_obj, F.coalesce(F.col("_ans_raw"), F.lit("")))
              .otherwise(F.lit(None)))
    atype = (F.when(meta.isNull() | (mty == "null"), F.lit("absent"))
             .when((mty == "string") & inner.isNull(), F.lit("bare"))
             .when(is_obj, F.when(aty.isin("object", "array"), F.lit("nested")).when(ans_var.isNull(), F.lit("absent"))
                   .otherwise(F.lit("string")))
             .otherwise(F.lit("bad_metadata")))
    d = pin_columns(d.withColumn("answer", answer).withColumn("answer_type", atype))
    # Python truthiness of the answer value: "" / 0 / false / null / {} / [] are empty.
    empty = (F.when(aty.isin("object", "array"), F.size(F.coalesce(
                 F.json_object_keys("answer"), F.from_json("answer", "array<string>"),
                 F.array().cast("array<string>"))) == 0)
             .when(aty == "scalar", F.coalesce(F.try_variant_get(ans_var, "$", "double") == 0,
                                               F.try_variant_get(ans_var, "$", "boolean") == F.lit(False),
                                               F.lit(False)))
             .when(aty == "null", F.lit(True))
             .otherwise(F.coalesce(F.col("answer"), F.lit("")) == ""))
    return d.withColumn("answer_empty", empty) \
            .drop("_meta", "_mty", "_mstr", "_inner", "_ity", "_ans_raw", "_ans_var", "_aty")


# ---------------------------------------------------------------- P3
def reject_reason(df: DataFrame) -> Column:
    """First failing rule, in the order the parser applies them."""
    return (F.when(F.col("section_status") == "missing", F.lit("missing_section"))
            .when(F.col("section_status") == "empty", F.lit("empty_section"))
            .when(F.col("section_status") == "bad_json", F.lit("bad_section_json"))
            .when(F.col("messages_type") == "absent", F.lit("no_messages"))
            .when(F.col("messages_type") == "bad_json", F.lit("bad_messages_json"))
            .when(F.col("messages_type") == "other", F.lit("bad_messages_type"))
            .when(F.col("answer_type") == "bad_metadata", F.lit("bad_metadata"))
            .when(F.col("answer_empty"), F.lit("no_answer")))


def quarantine_rejects(df: DataFrame, reason: Column, materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): one tagged table split by ``reason IS NULL``.

    The tagged rows are written once (reliable checkpoint in the shared
    folder) and both sinks read them: the parse is not repeated per sink, and
    the split predicate cannot be pushed back into the parsing expressions
    (which would inline every VARIANT step into one huge filter)."""
    tagged = df.withColumn("reason", reason)
    if materialize:
        tagged = tagged.checkpoint(eager=True)
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())


# ---------------------------------------------------------------- P10
ROLES = ["system", "user", "assistant"]


def validation_flags(messages: str = "messages", max_tokens: int = DEFAULT_MAX_LEN) -> list[tuple[str, Column]]:
    m = F.col(messages)
    roles = F.transform(m, lambda x: x["role"])
    ns = F.col("_ns")  # non-system roles, pinned by validate_records
    return [
        ("blank_content", F.exists(m, lambda x: F.coalesce(strip_ws(x["content"]), F.lit("")) == "")),
        ("bad_role", F.exists(roles, lambda r: ~F.coalesce(r, F.lit("")).isin(*ROLES))),
        ("system_not_first", F.exists(F.transform(roles, lambda r, i: (r == "system") & (i > 0)), lambda b: b)),
        ("role_order", F.exists(F.transform(ns, lambda r, i: F.when(i > 0, r == F.element_at(ns, i)).otherwise(F.lit(False))),
                                lambda b: b)),
        ("no_assistant_end", (F.size(m) == 0) | (last_role_index(m, "assistant") != F.size(m))),
        ("too_long", token_count(render_messages(m)) > max_tokens),
    ]


def validate_records(df: DataFrame, messages: str = "messages", max_tokens: int = DEFAULT_MAX_LEN) -> DataFrame:
    """Rule table → (rule, n_checked, n_failed); every rule is reported, also
    with zero failures."""
    df = pin_columns(df.withColumn("_ns", F.transform(F.filter(messages, lambda x: x["role"] != "system"),
                                                      lambda x: x["role"])))
    flags = validation_flags(messages, max_tokens)
    per = df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), f.alias("failed")) for n, f in flags])))
    return per.groupBy("rule").agg(F.count(F.lit(1)).alias("n_checked"), F.count_if("failed").alias("n_failed"))


# ---------------------------------------------------------------- P11
def profile_records(df: DataFrame, messages_variant: Column, answer: Column) -> DataFrame:
    """messages type, first content type, turn count, 80-char answer preview."""
    ty = _vtype(messages_variant)
    first_c = F.try_variant_get(messages_variant, "$[0].content", "variant")
    n = F.size(F.try_variant_get(messages_variant, "$", "array<variant>"))
    return df.select("*",
                     F.when(ty == "array", F.lit("list")).when(ty == "string", F.lit("json_string"))
                      .otherwise(F.coalesce(ty, F.lit("absent"))).alias("messages_type"),
                     F.when(_vtype(first_c) == "array", F.lit("blocks")).otherwise(F.lit("string")).alias("content_type"),
                     n.cast("long").alias("n_turns"), preview(answer).alias("answer_preview"))


# ---------------------------------------------------------------- P13
def select_tasks(df: DataFrame, task: str, tasks: Sequence[str], order: str) -> DataFrame:
    """Keep samples whose task is in ``tasks``; the first (by ``order``) per
    task.  An aggregate (``min_by``), so a task holding most rows is
    combined map-side instead of sent whole to one window task."""
    kept = df.filter(F.col(task).isin(list(tasks)))
    others = [c for c in df.columns if c != task]
    return kept.groupBy(task).agg(F.min_by(F.struct(*others), F.col(order)).alias("_f")).select(task, "_f.*")


# ---------------------------------------------------------------- P14
def material_prompts(df: DataFrame, title: str, description: str, tags: Column, duration: Column) -> DataFrame:
    """Catalogue row → material text, user prompt and fixed system instruction."""
    tag_text = F.array_join(F.transform(tags, lambda t: F.concat(F.lit("#"), t)), " ")
    material = F.concat(F.lit("\n视频标题: "), F.col(title), F.lit("\n视频描述: "), F.col(description),
                        F.lit("\n视频标签: "), tag_text, F.lit("\n视频长度: "), duration, F.lit("\n"))
    return df.select("*", F.lit(MATERIAL_SYSTEM_PROMPT).alias("system"),
                     F.concat(F.lit(MATERIAL_USER_PREFIX), material).alias("prompt"))


# ---------------------------------------------------------------- P15
OPTION_HEAD = r"(^|[^A-Za-z0-9])([A-Z])\."


def choice_options(df: DataFrame, key: str, question: str) -> DataFrame:
    """Question → one row per option (key, letter, text, n_options).

    A head is a capital letter and a point that follow no letter or digit.  It
    begins an option if its letter is the next expected one (A first).  Only if
    that letter heads nothing further on, a later letter does, unless the head
    touches another one as in an abbreviation ("U.S.").  All other heads belong to
    the option's text, which runs to the next option, less a control suffix
    (/think, /no_think) at the question's end."""
    q = F.regexp_replace(F.col(question), r"\s*/(no_)?think\s*$", "")
    parts = F.split(F.regexp_replace(q, OPTION_HEAD, "$1\u0001$2"), "\u0001")
    heads = F.transform(F.slice(parts, 2, 1 << 30),
                        lambda p: F.struct(p.substr(1, 1).alias("letter"), p.substr(2, 1 << 30).alias("text")))

    def options(h_all):
        def step(state, i):
            h, rest = F.get(h_all, i), F.slice(h_all, i + 1, F.greatest(F.size(h_all), F.lit(1)))
            after = F.char(F.ascii(state["last"]) + 1)
            touches = h["text"].rlike(r"^[A-Z]\.")
            begins = (h["letter"] == after) | (~F.exists(rest, lambda x: x["letter"] == after)
                                               & (h["letter"] > state["last"]) & ~touches)
            n = F.size(state["opts"])
            open_ = F.get(state["opts"], n - 1)
            longer = F.struct(open_["letter"].alias("letter"),
                              F.concat(open_["text"], h["letter"], F.lit("."), h["text"]).alias("text"))
            return F.when(begins, F.struct(h["letter"].alias("last"), F.array_append(state["opts"], h).alias("opts"))) \
                .when(n == 0, state) \
                .otherwise(F.struct(state["last"].alias("last"), F.concat(F.slice(state["opts"], 1, n - 1), F.array(longer)).alias("opts")))

        start = F.struct(F.lit("@").alias("last"), F.array().cast("array<struct<letter:string,text:string>>").alias("opts"))
        return F.when(F.size(h_all) > 0, F.aggregate(F.sequence(F.lit(0), F.size(h_all) - 1), start, step)["opts"])

    # Heads and options are bound to lambda variables.  As columns they would be
    # put back into every place that reads them, also in the filter that Spark
    # infers from an explode of a column, and split the question again each time.
    opts = F.flatten(F.transform(F.transform(F.array(heads), options), lambda o: F.transform(o, lambda x: F.struct(
        x["letter"].alias("letter"), x["text"].alias("text"), F.size(o).cast("long").alias("n_options")))))
    return df.select(key, F.explode(opts).alias("_o")) \
             .select(key, F.col("_o.letter").alias("letter"), strip_ws(F.col("_o.text")).alias("text"), F.col("_o.n_options"))


# ---------------------------------------------------------------- A1
def category_counts(df: DataFrame, category: str, categories: DataFrame) -> DataFrame:
    """Count per category, zero-filled from the category dimension."""
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    return categories.join(counts, category, "left").select(category, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


# ---------------------------------------------------------------- A2
def task_catalog(df: DataFrame, category: str, task: str) -> DataFrame:
    """Per task: number of categories it occurs in and samples; the number of
    distinct (category, task) pairs is the sum of ``n_categories``."""
    return df.groupBy(task).agg(F.count_distinct(category).alias("n_categories"),
                                F.count(F.lit(1)).alias("n_samples"))
