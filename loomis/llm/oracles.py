"""DuckDB SQL of the operators whose results SQL can express."""

from __future__ import annotations

from .quality import MIN_ROWS, RULES

# A word separator run and "has a word" in DuckDB's RE2 syntax.
_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"


def quality_ctes(docs: str = "documents") -> str:
    """CTEs ending in ``q_verdict`` (one row per document of ``docs``)."""
    measures = list(dict.fromkeys(r.measure for r in RULES))
    unpivot = " UNION ALL ".join(f"SELECT q_lang, q_source, '{m}' AS measure, {m} AS v FROM q_shares" for m in measures)

    def th(r):
        if r.side == "upper":
            return (f"max(CASE WHEN measure = '{r.measure}' THEN q50 + {r.spread} * greatest(q50 - q10, {r.floor}) "
                    f"END) AS hi_{r.measure}")
        return (f"max(CASE WHEN measure = '{r.measure}' THEN q50 - {r.spread} * greatest(q90 - q50, {r.floor}) "
                f"END) AS lo_{r.measure}")
    ok = " AND ".join(f"{r.measure} <= hi_{r.measure}" if r.side == "upper" else f"{r.measure} >= lo_{r.measure}"
                      for r in RULES)

    def quant(keys: str, src: str) -> str:
        qs = ", ".join(f"min(CASE WHEN upto * 10 >= total * {k} THEN bucket END) AS {n}"
                       for k, n in ((1, "q10"), (5, "q50"), (9, "q90")))
        return (f"SELECT {keys}, measure, max(total) AS q_rows, {qs} FROM (SELECT *, sum(n) OVER (PARTITION BY {keys}, "
                f"measure) AS total, sum(n) OVER (PARTITION BY {keys}, measure ORDER BY bucket ROWS UNBOUNDED "
                f"PRECEDING) AS upto FROM {src}) GROUP BY {keys}, measure")
    return f"""
q_base AS MATERIALIZED (
  SELECT doc_id, lang AS q_lang, source AS q_source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM {docs}),
q_win AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM q_base)),
q_dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM q_win) WHERE c > 1),
q_rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
          FROM q_dup, (SELECT unnest(range(0, 8)) AS k) GROUP BY doc_id),
q_counts AS (
  SELECT b.doc_id, q_lang, q_source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS BIGINT) AS n_bangs,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM q_base b LEFT JOIN q_rep USING (doc_id)),
q_shares AS MATERIALIZED (
  SELECT *, CASE WHEN n_words > 0 THEN n_symbols * 1000 // n_words ELSE 0 END AS symbol_share,
         CASE WHEN n_words > 0 THEN n_bangs * 1000 // n_words ELSE 0 END AS bang_share,
         CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_line_share,
         CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeat_share,
         CASE WHEN n_words > 0 THEN word_chars * 10 // n_words ELSE 0 END AS word_length
  FROM q_counts),
q_long AS (SELECT q_lang, q_source, measure, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0)
                  AS bucket FROM ({unpivot})),
q_fine AS (SELECT q_lang, q_source, measure, bucket, count(*) AS n FROM q_long GROUP BY ALL),
q_coarse AS (SELECT q_lang, measure, bucket, sum(n) AS n FROM q_fine GROUP BY ALL),
q_own AS ({quant("q_lang, q_source", "q_fine")}),
q_lng AS ({quant("q_lang", "q_coarse")}),
q_both AS (
  SELECT o.q_lang, o.q_source, o.measure,
         {", ".join(f"CASE WHEN o.q_rows >= {MIN_ROWS} THEN o.{q} ELSE l.{q} END AS {q}" for q in ("q10", "q50", "q90"))}
  FROM q_own o JOIN q_lng l ON o.q_lang IS NOT DISTINCT FROM l.q_lang AND o.measure = l.measure),
q_th AS (SELECT q_lang, q_source, {", ".join(th(r) for r in RULES)} FROM q_both GROUP BY q_lang, q_source),
q_verdict AS MATERIALIZED (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
         (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
         (NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)) AND {ok} AS kept, {", ".join(measures)}
  FROM q_shares s JOIN q_th t ON s.q_lang IS NOT DISTINCT FROM t.q_lang AND s.q_source IS NOT DISTINCT FROM t.q_source)"""


def quality_sql() -> str:
    return f"WITH {quality_ctes()} SELECT * FROM q_verdict"


def interaction_sql() -> str:
    """All orders are walked document by document: a filter removes what it
    fails and no earlier filter of the order has removed."""
    return rf"""
WITH base AS (
  SELECT d.doc_id, coalesce(d.source, '') AS part, coalesce(d.text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(d.text, ''), '{_SPACE}'), lambda x: x <> '') AS w,
         coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l
    ON d.doc_id = l.doc_id),
fails AS MATERIALIZED (
  SELECT part, good, toxic, len(w) < 200 AS fa, 100 * len(list_distinct(w)) < 50 * len(w) AS fb,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS fc,
         regexp_matches(t, '[#$%&*|]') AS fd,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS fe
  FROM base),
kinds AS (SELECT part, good, toxic, [fa, fb, fc, fd, fe] AS f, count(*) AS n FROM fails GROUP BY ALL),
letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS x),
orders AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o,
         array_to_string([chr(64 + a.x), chr(64 + b.x), chr(64 + c.x), chr(64 + d.x), chr(64 + e.x)], '') AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, o, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
parts AS (SELECT DISTINCT part FROM fails),
counted AS (
  SELECT part, filter_order, step, o[step] AS own,
         sum(CASE WHEN gone THEN 0 WHEN f[o[step]] THEN 0 ELSE n END) AS kept,
         sum(CASE WHEN NOT gone AND f[o[step]] THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND f[o[step]] THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN f[o[step]] AND len(list_filter(f, lambda y: y)) = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND f[o[step]] AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND f[o[step]] AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM (SELECT *, len(list_filter(o[1:step - 1], lambda y: f[y])) > 0 AS gone FROM kinds, steps)
  GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted"""


def _field(name: str, column: str | None = None) -> str:
    column = column or name
    return (f"CASE WHEN {column} IS NULL THEN '-' ELSE CAST(octet_length(encode(CAST({column} AS VARCHAR))) AS VARCHAR) "
            f"|| ':' || CAST({column} AS VARCHAR) END")


def manifest_sql(levels: int = 12) -> str:
    """Trees as lists of digests, one list for each of ``levels`` levels (8 **
    ``levels`` leaves), and every leaf folded upwards level by level.  DuckDB
    has no crc32: it is computed bit by bit."""
    crc = ("xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda b: [ascii(b), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) "
           "ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)")
    fields = ("doc_id", "source", "lang", "n_chars")
    head = " || ".join(_field(f) for f in fields)
    up = lambda k: (f"CASE WHEN len(l{k}) < 2 THEN l{k} ELSE list_transform(range(0, (len(l{k}) + 7) // 8), "  # noqa: E731
                    f"lambda j: sha256(array_to_string(l{k}[j * 8 + 1:j * 8 + 8], ''))) END AS l{k + 1}")
    ctes = [f"""leafs AS (
  SELECT doc_id, lang, sha256({head} || {_field("text")}) AS h,
         CASE WHEN coalesce({crc} % 3 = 0, false) THEN sha256({head} || {_field("text", "lowered")}) ELSE
           sha256({head} || {_field("text")}) END AS th
  FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents))""",
            "a0 AS (SELECT lang, list(h ORDER BY doc_id NULLS FIRST, h) AS l0 FROM leafs GROUP BY lang)"]
    ctes += [f"a{k + 1} AS (SELECT *, {up(k)} FROM a{k})" for k in range(levels)]
    ctes += [f"trees AS (SELECT *, l{levels}[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM a{levels})",
             "b0 AS (SELECT list(subroot ORDER BY g) AS l0 FROM trees)"]
    ctes += [f"b{k + 1} AS (SELECT *, {up(k)} FROM b{k})" for k in range(levels)]
    ctes.append("""s0 AS (
  SELECT doc_id, h, th AS fold, '' AS proof, lang, g, subroot,
         row_number() OVER (PARTITION BY f.lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i
  FROM leafs f JOIN (SELECT lang AS k_lang, g, subroot FROM trees) t ON f.lang IS NOT DISTINCT FROM k_lang)""")
    step, place = 0, "i"
    for tree, join in (("trees", "t.lang IS NOT DISTINCT FROM s.lang"), (f"b{levels}", "true")):
        for k in range(levels):
            lo = f"CAST(s.{place} // 8 * 8 AS BIGINT)"
            before = f"array_to_string(t.l{k}[{lo} + 1:s.{place}], '')"
            after = f"array_to_string(t.l{k}[s.{place} + 2:{lo} + 8], '')"
            on = f"len(t.l{k}) > 1"
            ctes.append(f"""s{step + 1} AS (
  SELECT s.* REPLACE (CASE WHEN {on} THEN sha256({before} || fold || {after}) ELSE fold END AS fold,
                      CASE WHEN {on} THEN proof || {before} || {after} ELSE proof END AS proof,
                      CASE WHEN {on} THEN s.{place} // 8 ELSE s.{place} END AS {place})
  FROM s{step} s JOIN {tree} t ON {join})""")
            step += 1
        place = "g"
    return "WITH " + ", ".join(ctes) + f"""
SELECT doc_id, h AS leaf, subroot, l{levels}[1] AS root, sha256(proof) AS proof_sha256, fold AS folded_root,
       fold = l{levels}[1] AS verified
FROM s{step}, b{levels}"""
