"""Dataset curation: exact and near-duplicate removal, category balancing,
hash-stable splits, system-prompt paraphrase, thinking pairs, weighted mixing,
version diffs, leakage checks, mixture reports and seeded shuffles.

Randomness is always ``md5(id:seed)`` so results do not depend on
partitioning and an oracle can repeat them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomis.functions.plan import pin_columns
from loomis.functions.text import seeded_key
from loomis.operators.chatml import last_role_index
from loomis.plans.sequence import dense_index
from loomis.schemas import EMPTY_THINK_BLOCK, NO_THINK_SUFFIX, THINK_CLOSE, THINK_OPEN, THINK_SUFFIX


# ---------------------------------------------------------------- D1 (exact)
def exact_duplicates(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key kept = smallest id, text_hash, n_copies) per distinct content.
    An aggregate on the hash: a text copied a million times is combined
    map-side, never gathered in one task."""
    h = df.select(key, F.sha2(F.col(text), 256).alias("text_hash"))
    return h.groupBy("text_hash").agg(F.min(key).alias(key), F.count(F.lit(1)).alias("n_copies"))


# ---------------------------------------------------------------- D1 (near)
def with_word_shingles(df: DataFrame, text: str, k: int = 5, out: str = "sh") -> DataFrame:
    """Distinct lower-cased word k-grams of the whole text (a text shorter
    than k words is one shingle).  The word array is materialized as a column
    first: a lambda that referenced the ``split`` expression would re-split
    the text for every k-gram."""
    d = pin_columns(df.withColumn("_w", F.filter(F.split(F.lower(F.col(text)), r"\s+"), lambda w: w != "")))
    n = F.size("_w")
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))),
                        lambda i: F.array_join(F.slice("_w", i, k), " "))
    return d.withColumn(out, F.array_distinct(F.when(n > 0, grams).otherwise(F.array().cast("array<string>")))) \
            .drop("_w")


def shingle_hashes(df: DataFrame, key: str, text: str, k: int = 5) -> DataFrame:
    """(key, h): one row per word k-gram of the whole text, hashed with
    multi-column ``xxhash64`` (a text shorter than k words is one shingle).
    No lambdas: shifted ``slice``s are zipped and exploded, so the whole chain
    stays in generated code."""
    d = pin_columns(df.select(key, F.split(F.lower(F.col(text)), r"\s+").alias("_w")))
    d = pin_columns(d.withColumn("_w", F.array_remove("_w", "")))
    n = F.size("_w")
    z = F.arrays_zip(*[F.slice("_w", j + 1, F.greatest(n, F.lit(1))).alias(f"w{j}") for j in range(k)])
    e = d.select(key, n.alias("_n"), F.posexplode_outer(z).alias("_p", "_z"))
    e = e.filter(F.col(f"_z.w{k - 1}").isNotNull() | ((F.col("_p") == 0) & (F.col("_n") > 0)))
    return e.select(key, F.xxhash64(*[F.col(f"_z.w{j}") for j in range(k)]).alias("h"))


def minhash_signatures(rows: DataFrame, key: str, h: str, num_perm: int) -> DataFrame:
    """(key, sig, shingles): MinHash signature and the distinct shingle-hash
    set of every key in one partially aggregated pass (``num_perm`` seeded
    hashes per shingle, reduced by ``min``)."""
    mins = rows.groupBy(key).agg(F.array_sort(F.collect_set(h)).alias("shingles"),
                                 *[F.min(F.xxhash64(F.col(h), F.lit(i))).alias(f"_h{i}") for i in range(num_perm)])
    return mins.select(key, F.array(*[F.col(f"_h{i}") for i in range(num_perm)]).alias("sig"), "shingles")


def near_duplicates(df: DataFrame, key: str, text: str, num_perm: int = 32, bands: int = 8, k: int = 5,
                    threshold: float = 0.8) -> DataFrame:
    """MinHash-LSH near-duplicate clusters over distinct texts: approximate
    (links are missed; ``similarity.near_groups`` is the exact form, against
    which the tests measure this one's recall).

    Band buckets never emit all pairs: each bucket links its members to the
    bucket's smallest id (star edges, n rows for n members), components are
    found by iterated min-label propagation (aggregates + joins, each round
    checkpointed), and every member is verified by exact Jaccard against its
    component representative only.  Output: (key, cluster_id, jaccard,
    is_duplicate)."""
    rows = num_perm // bands
    # signature + shingle-hash set per text, written once
    sig = minhash_signatures(shingle_hashes(df, key, text, k), key, "h", num_perm) \
        .withColumnRenamed("shingles", "sh").checkpoint(eager=True)
    members = sig.select(key, F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                                                       lambda b: F.xxhash64(F.slice("sig", b * rows + 1, rows))))
                         .alias("band", "bucket"))
    sizes = members.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("_n"))
    members = members.join(sizes.filter(F.col("_n") > 1).drop("_n"), ["band", "bucket"], "left_semi").checkpoint(eager=True)
    label = sig.select(key, F.col(key).alias("label"))
    # iterate to convergence (at most the component diameter rounds)
    while True:
        bmin = members.join(label, key).groupBy("band", "bucket").agg(F.min("label").alias("_m"))
        new = members.join(bmin, ["band", "bucket"]).groupBy(key).agg(F.min("_m").alias("_nl"))
        nxt = label.join(new, key, "left").select(key, F.least("label", F.coalesce("_nl", "label")).alias("label"))
        nxt = nxt.checkpoint(eager=True)
        changed = nxt.join(label.withColumnRenamed("label", "_old"), key).filter(F.col("label") != F.col("_old")).count()
        label = nxt
        if changed == 0:
            break
    reps = sig.select(F.col(key).alias("label"), F.col("sh").alias("_rsh"))
    j = label.join(sig.select(key, "sh"), key).join(reps, "label")
    inter = F.size(F.array_intersect("sh", "_rsh"))
    union = F.size(F.array_union("sh", "_rsh"))
    jac = F.when(union > 0, inter / union).otherwise(F.lit(1.0))
    out = j.select(key, F.col("label").alias("cluster_id"), F.round(jac, 6).alias("jaccard"))
    # texts without words have no shingles: each is a cluster of its own
    rest = df.select(key).join(sig.select(key), key, "left_anti")
    out = out.unionByName(rest.select(key, F.col(key).alias("cluster_id"), F.lit(1.0).alias("jaccard")))
    return out.withColumn("is_duplicate", (F.col(key) != F.col("cluster_id")) & (F.col("jaccard") >= threshold))


# ---------------------------------------------------------------- D2
RADIX = 3       # hex digits per round: histograms of 4,096 counts for each category
DIGITS = 32     # of an md5


def cut_off_keys(rows: DataFrame, category: str, hash_: str, wanted: DataFrame) -> DataFrame:
    """(category, cut): the rows of a category whose hash prefix of ``len(cut)``
    digits is at most ``cut`` are its ``want`` smallest ones (``wanted``:
    category, want; 1 <= want <= rows).  A distributed radix select: each round
    counts, map-side combined, the next digits of the rows in the one digit
    bucket that holds the cut-off, and goes on inside it until the bucket is
    taken whole or, at equal hashes, the digits end.  Nothing is sorted but 4,096
    counts of a category."""
    spark = rows.sparkSession
    open_ = wanted.select(category, F.lit("").alias("prefix"), F.col("want").alias("need"))
    done = None
    for length in range(RADIX, DIGITS + RADIX, RADIX):
        o = open_.select(F.col(category).alias("_c"), "prefix", "need")
        inside = rows.join(o, F.col(category).eqNullSafe(F.col("_c"))) \
            .where(F.col(hash_).startswith(F.col("prefix")))
        counts = inside.groupBy(category, "prefix", "need", F.substring(hash_, 1, length).alias("digits")) \
            .agg(F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy(category).orderBy("digits").rowsBetween(Window.unboundedPreceding, 0)
        at = counts.withColumn("upto", F.sum("n").over(upto)).where("upto >= need and upto - n < need") \
            .select(category, "digits", "n", (F.col("need") - F.col("upto") + F.col("n")).alias("need")).checkpoint()
        whole = (F.col("n") == F.col("need")) | F.lit(length >= DIGITS)
        ended = at.where(whole).select(category, F.col("digits").alias("cut"), "need", "n")
        done = ended if done is None else done.unionByName(ended)
        open_ = at.where(~whole).select(category, F.col("digits").alias("prefix"), "need")
        if open_.isEmpty():
            break
    return done if done is not None else spark.createDataFrame([], wanted.schema)


def balance_categories(df: DataFrame, category: str, key: str, target: int, seed: int | str = 42) -> DataFrame:
    """Exactly ``target`` rows per category: down-sample by ``md5(id:seed)``;
    categories below target are repeated ``ceil(target / n)`` times first
    (``copy`` numbers the repeats).  All copies but the last are taken whole; of
    the last one the rows up to a cut-off hash, found by ``cut_off_keys``, so no
    category is sorted or gathered, whatever its size and the target.  Rows of one
    key are equal to the hash; among them the first ones of an order by all
    columns are taken."""
    d = df.withColumn("_h", seeded_key(key, seed))
    counts = d.groupBy(category).agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn("_copies", F.greatest(F.lit(1), F.ceil(F.lit(target) / F.col("_n"))).cast("long")).checkpoint()
    wanted = counts.select(category, (F.lit(target) - (F.col("_copies") - 1) * F.col("_n")).alias("want"))
    cuts = cut_off_keys(d.select(category, "_h"), category, "_h", wanted)
    plan = counts.select(F.col(category).alias("_c"), "_copies").join(
        cuts.select(F.col(category).alias("_c2"), "cut", "need", "n"), F.col("_c").eqNullSafe(F.col("_c2"))).drop("_c2", "n")
    j = d.join(plan, F.col(category).eqNullSafe(F.col("_c")))
    head = F.substring("_h", 1, F.length("cut"))
    full = j.where(F.col("_copies") > 1).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies") - 1)))
    below = j.where((head < F.col("cut")) | ((head == F.col("cut")) & (F.length("cut") < DIGITS))).withColumn("copy", F.col("_copies"))
    # Equal hashes at the cut-off: rows of one key.
    ties = j.where((head == F.col("cut")) & (F.length("cut") >= DIGITS)).withColumn(
        "_r", F.row_number().over(Window.partitionBy(category, "_h").orderBy(*[c for c in df.columns]))) \
        .where("_r <= need").drop("_r").withColumn("copy", F.col("_copies"))
    return full.unionByName(below).unionByName(ties).select(*df.columns, F.col("copy").cast("long").alias("copy"))


# ---------------------------------------------------------------- D3
def train_val_split(df: DataFrame, key: str, val_fraction: float = 0.1, seed: int | str = 42) -> DataFrame:
    """``validation`` when the first 4 hex digits of ``md5(id:seed)`` fall
    below ``val_fraction``·65536 (string compare of equal-length hex)."""
    thr = format(int(val_fraction * 65536), "04x")
    return df.withColumn("split", F.when(F.substring(seeded_key(key, seed), 1, 4) < F.lit(thr), F.lit("validation"))
                         .otherwise(F.lit("train")))


# ---------------------------------------------------------------- D4
def paraphrase_system(df: DataFrame, templates: DataFrame, category: str = "category",
                      messages: str = "messages") -> DataFrame:
    """One row per (sample, template of its category); the system turn is
    replaced by the template, or prepended when the sample has none."""
    j = df.join(templates, category)
    sys_turn = F.struct(F.lit("system").alias("role"), F.col("system").alias("content"))
    no_sys = F.filter(messages, lambda m: m["role"] != "system")
    return j.withColumn(messages, F.concat(F.array(sys_turn), no_sys))


# ---------------------------------------------------------------- D5
def thinking_pairs(samples: DataFrame, traces: DataFrame, key: str, context: str = "context",
                   answer: str = "answer") -> DataFrame:
    """Per sample a non-thinking variant (``/no_think`` + empty think block)
    and, when a trace is supplied, a thinking variant (``/think`` + trace)."""
    j = samples.join(traces.select(key, "trace"), key, "left")
    variants = F.array(
        F.struct(F.lit("non_thinking").alias("mode"), F.lit(" " + NO_THINK_SUFFIX).alias("sfx"),
                 F.concat(F.lit(EMPTY_THINK_BLOCK), F.col(answer)).alias("response")),
        F.struct(F.lit("thinking").alias("mode"), F.lit(" " + THINK_SUFFIX).alias("sfx"),
                 F.concat(F.lit(THINK_OPEN + "\n"), F.col("trace"), F.lit("\n" + THINK_CLOSE + "\n\n"),
                          F.col(answer)).alias("response")))
    ex = j.select("*", F.inline(variants)).filter(F.col("response").isNotNull())
    ex = pin_columns(ex.withColumn("_u", last_role_index(context, "user")))
    return ex.withColumn(context, F.transform(context, lambda m, i: F.when(
        i + 1 == F.col("_u"), F.struct(m["role"].alias("role"), F.concat(m["content"], F.col("sfx")).alias("content")))
        .otherwise(m))).drop("sfx", "_u")


# ---------------------------------------------------------------- U1
def mix_datasets(parts: Sequence[tuple[str, DataFrame, int]]) -> DataFrame:
    """Union datasets with a ``source`` tag, each row repeated ``weight``
    times (weight 0 drops the dataset)."""
    out = None
    for name, d, w in parts:
        if w <= 0:
            continue
        x = d.withColumn("source", F.lit(name)).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(int(w)))))
        out = x if out is None else out.unionByName(x)
    return out.withColumn("copy", F.col("copy").cast("long"))


# ---------------------------------------------------------------- U3
def diff_versions(old: DataFrame, new: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """added / removed / changed rows between two versions (full outer join
    on the key, content compared by md5 of the columns)."""
    def h(d):
        return d.select(key, F.md5(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in cols])).alias("_h"))
    o, n = h(old).withColumnRenamed("_h", "_o"), h(new).withColumnRenamed("_h", "_n")
    j = o.join(n, key, "full_outer")
    change = (F.when(F.col("_o").isNull(), F.lit("added")).when(F.col("_n").isNull(), F.lit("removed"))
              .when(F.col("_o") != F.col("_n"), F.lit("changed")))
    return j.select(key, change.alias("change")).filter(F.col("change").isNotNull())


# ---------------------------------------------------------------- U4
def common_samples(a: DataFrame, b_: DataFrame, text: str) -> DataFrame:
    """Rows of ``a`` whose content hash also occurs in ``b_`` (left semi join)."""
    ha = a.withColumn("text_hash", F.sha2(F.col(text), 256))
    hb = b_.select(F.sha2(F.col(text), 256).alias("text_hash"))
    return ha.join(hb, "text_hash", "left_semi")


# ---------------------------------------------------------------- A19
def mixture_report(df: DataFrame, category: str, targets: DataFrame) -> DataFrame:
    """Actual vs target share per category.  The share's denominator is a
    scalar subquery (total row count), not a window over all rows."""
    total = df.select(F.count(F.lit(1))).scalar()
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    j = counts.join(targets, category, "full_outer").fillna({"n": 0, "target_share": 0.0})
    return j.select(category, F.col("n").cast("long").alias("n"),
                    F.round(F.col("n") / total, 6).alias("actual_share"),
                    F.round("target_share", 6).alias("target_share"),
                    F.round(F.col("n") / total - F.col("target_share"), 6).alias("gap"))


# ---------------------------------------------------------------- T1
def seeded_shuffle(df: DataFrame, key: str, seed: int | str = 42) -> DataFrame:
    """Deterministic permutation: ``position`` = rank of ``md5(id:seed)``,
    computed by a distributed range sort (no single-partition window)."""
    d = df.withColumn("shuffle_key", seeded_key(key, seed))
    return dense_index(d, ["shuffle_key", key], name="position", start=0)
