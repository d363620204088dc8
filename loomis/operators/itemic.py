"""Itemic tokens ``<|{domain}_begin|><s_a_{a}><s_b_{b}><s_c_{c}>``: parsing
occurrences out of text, validating them, building history prompts,
codebook coverage and the catalogue join in both directions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomis.schemas import CODEBOOK_SIZE, ITEMIC_DOMAINS

ITEMIC_RE = r"<\|([a-z]+)_begin\|><s_a_([0-9]+)><s_b_([0-9]+)><s_c_([0-9]+)>"
# Loose form for validation: any begin marker and whatever sub-tokens follow it.
LOOSE_RE = r"<\|([a-z_]+)_begin\|>((?:<s_[a-z]_[0-9]+>)*)"
SUB_RE = r"<s_([a-z])_([0-9]+)>"


def itemic_token(domain, a, b, c):
    return F.concat(F.lit("<|"), domain, F.lit("_begin|><s_a_"), a.cast("string"), F.lit("><s_b_"),
                    b.cast("string"), F.lit("><s_c_"), c.cast("string"), F.lit(">"))


# ---------------------------------------------------------------- X6
def itemic_occurrences(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per well-formed itemic token: (key, pos, domain, a, b, c)."""
    toks = F.regexp_extract_all(F.col(text), F.lit(ITEMIC_RE), 0)
    ex = df.select(key, F.posexplode(toks).alias("pos", "_t"))
    g = [F.regexp_extract("_t", ITEMIC_RE, i) for i in range(1, 5)]
    return ex.select(key, (F.col("pos") + 1).cast("long").alias("pos"), g[0].alias("domain"),
                     g[1].cast("long").alias("a"), g[2].cast("long").alias("b"), g[3].cast("long").alias("c"))


# ---------------------------------------------------------------- X7
def itemic_validate(df: DataFrame, text: str, group: list[str]) -> DataFrame:
    """Per group: loose token count, malformed (levels not exactly a, b, c),
    out-of-range code (not 0..8191) and unknown domain counts."""
    doms = F.regexp_extract_all(F.col(text), F.lit(LOOSE_RE), 1)
    subs = F.regexp_extract_all(F.col(text), F.lit(LOOSE_RE), 2)
    ex = df.select(*group, F.explode(F.arrays_zip(doms.alias("d"), subs.alias("s"))).alias("_z"))
    levels = F.regexp_extract_all(F.col("_z.s"), F.lit(SUB_RE), 1)
    codes = F.transform(F.regexp_extract_all(F.col("_z.s"), F.lit(SUB_RE), 2), lambda x: x.cast("long"))
    flags = ex.select(*group,
                      (F.array_join(levels, ",") != "a,b,c").alias("malformed"),
                      F.exists(codes, lambda x: (x < 0) | (x >= CODEBOOK_SIZE)).alias("out_of_range"),
                      (~F.col("_z.d").isin(*ITEMIC_DOMAINS)).alias("unknown_domain"))
    return flags.groupBy(*group).agg(F.count(F.lit(1)).alias("n_tokens"),
                                     F.count_if("malformed").alias("n_malformed"),
                                     F.count_if("out_of_range").alias("n_out_of_range"),
                                     F.count_if("unknown_domain").alias("n_unknown_domain"))


# ---------------------------------------------------------------- X8
def itemic_history_prompts(history: DataFrame, item_tokens: DataFrame, n: int, key: str = "user_id",
                           seq: str = "seq", item: str = "item") -> DataFrame:
    """(key, n_items, n_unresolved, prompt, target_token): the user's last event
    is the target, whether the catalogue has it or not (then its token is
    null); the ``n`` events before it, as itemic tokens in time order, are the
    prompt, and those without a catalogue row are counted.  One group-limited
    window keeps the newest n + 1 events per user (map-side), one bounded
    ``collect_list`` splits prompt and target; users with a single event have
    no prompt and are left out."""
    w = Window.partitionBy(key).orderBy(F.desc(seq))
    capped = history.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n + 1).drop("_r")
    j = capped.join(item_tokens.select(F.col("item").alias(item), "token"), item, "left")
    g = j.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), "token"))).alias("_p"))
    g = g.filter(F.size("_p") >= 2)
    tokens = F.transform(F.slice("_p", 1, F.size("_p") - 1), lambda x: x["token"])
    return g.select(key, (F.size("_p") - 1).cast("long").alias("n_items"),
                    F.size(F.filter(tokens, lambda t: t.isNull())).cast("long").alias("n_unresolved"),
                    F.array_join(tokens, "").alias("prompt"),
                    F.element_at("_p", -1)["token"].alias("target_token"))


# ---------------------------------------------------------------- A14
def codebook_coverage(items: DataFrame, approx: bool = False) -> DataFrame:
    """Per domain and level: distinct in-range codes, their share of the
    codebook and out-of-range codes (exact, or HyperLogLog when ``approx``)."""
    lv = items.unpivot(["item", "domain"], ["a", "b", "c"], "level", "code")
    in_range = (F.col("code") >= 0) & (F.col("code") < CODEBOOK_SIZE)
    distinct = (F.approx_count_distinct(F.when(in_range, F.col("code"))) if approx
                else F.count_distinct(F.when(in_range, F.col("code"))))
    return lv.groupBy("domain", "level").agg(distinct.alias("n_distinct"),
                                             F.count_if(~in_range).alias("n_out_of_range")) \
             .withColumn("coverage", F.round(F.col("n_distinct") / CODEBOOK_SIZE, 6))


# ---------------------------------------------------------------- J8
def resolve_occurrences(occ: DataFrame, catalog: DataFrame) -> DataFrame:
    """Occurrences left-joined to the catalogue on (domain, a, b, c)."""
    cat = catalog.select("domain", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"),
                         F.col("c").cast("long").alias("c"), "item", "description")
    return occ.join(cat, ["domain", "a", "b", "c"], "left")


def unresolved_rate(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("domain").agg(F.count(F.lit(1)).alias("n_occurrences"),
                                          F.count("item").alias("n_resolved")) \
        .withColumn("unresolved_rate", F.round(1 - F.col("n_resolved") / F.col("n_occurrences"), 6))


def description_to_token(catalog: DataFrame) -> DataFrame:
    """Reverse direction: each description → number of items and the token of
    its smallest item id (an aggregate, partially combined)."""
    return catalog.groupBy("description").agg(F.count(F.lit(1)).alias("n_items"),
                                              F.min_by("token", "item").alias("token"))
