"""DuckDB SQL fragments for the driver-table bindings (the oracle side).

They mirror ``loomis.plans.bindings`` and are composed into the per-query
oracle statements in the ``q_*`` modules.
"""

H = """H AS (
  SELECT o_custkey AS user_id, l_partkey AS item, o_orderdate AS ts,
         row_number() OVER (PARTITION BY o_custkey
                            ORDER BY o_orderdate, o_orderkey, l_linenumber, l_partkey) AS seq
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""

TARGET = """TARGET AS (
  SELECT user_id, arg_max(item, seq) AS target, max(seq) AS n_events FROM H GROUP BY user_id)"""

DOMAINS = "['video','prod','ad','living','sid']"

ITEM = f"""ITEM AS (
  SELECT p_partkey AS item, p_name AS description,
         {DOMAINS}[p_partkey % 5 + 1] AS domain,
         CAST(p_partkey * 7919 % 8192 AS INTEGER) AS a,
         CAST(p_partkey * 104729 % 8192 AS INTEGER) AS b,
         CAST(p_partkey * 1299709 % 8192 AS INTEGER) AS c,
         '<|' || {DOMAINS}[p_partkey % 5 + 1] || '_begin|><s_a_' || (p_partkey * 7919 % 8192)
           || '><s_b_' || (p_partkey * 104729 % 8192) || '><s_c_' || (p_partkey * 1299709 % 8192) || '>' AS token
  FROM part)"""

CAND = f"""CAND AS (
  SELECT user_id AS prompt_id, CAST(attempt AS BIGINT) AS attempt,
         CASE WHEN attempt <= 32 THEN 'thinking' ELSE 'non_thinking' END AS mode,
         (target + CASE WHEN attempt <= 32 THEN (user_id + 7 * attempt) % 60
                        ELSE (user_id + attempt * attempt) % 60 END) % (SELECT count(*) FROM part) AS response,
         target, {DOMAINS}[target % 5 + 1] AS domain
  FROM TARGET CROSS JOIN range(1, 65) r(attempt))"""

CAPPED = """CAPPED AS MATERIALIZED (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prompt_id, mode ORDER BY attempt) AS _rn FROM CAND)
  WHERE _rn <= 32)"""

MATCHED = """MATCHED AS (
  SELECT c.*, ri.token AS response_token, ti.token AS expected,
         coalesce(ri.token = ti.token, false) AS hit
  FROM CAPPED c LEFT JOIN ITEM ri ON c.response = ri.item
                LEFT JOIN ITEM ti ON c.target = ti.item)"""

QA = """QA AS (
  SELECT l.doc_id,
         concat_ws('', CASE WHEN quality = 1 THEN 'A' END, CASE WHEN toxic = 1 THEN 'B' END) AS gold,
         '正确答案是 ' || concat_ws('、', CASE WHEN n_chars > 500 THEN 'A' END,
                                        CASE WHEN lang <> 'en' THEN 'B' END) AS response
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

SUB = """SUB AS (SELECT user_id AS team, event_id AS id, ts, value AS score FROM events)"""

METRIC = """METRIC AS (
  SELECT user_id AS run,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step, ts, value AS loss,
         ntile(5) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch
  FROM events)"""

LOGIT = """LOGIT AS (
  SELECT l_orderkey AS prompt_id, l_partkey AS token, sum(l_extendedprice) / 10000 AS logit
  FROM lineitem GROUP BY 1, 2)"""

# Conversations assembled in turn order (one row per conversation).
CONV = """CONV AS (
  SELECT conv_id, list(struct_pack(turn := turn, role := role, content := text) ORDER BY turn) AS messages
  FROM conversations GROUP BY conv_id)"""


def q(*parts: str) -> str:
    """``q(cte1, cte2, ..., body)``: a WITH statement of the CTEs and the body."""
    *ctes, body = parts
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body


CAND_BASE = (H, TARGET, ITEM, CAND, CAPPED, MATCHED)

# ---- chat corpus / token arrays -------------------------------------------
from loomis.functions.text import TOKEN_PATTERN as _PAT  # noqa: E402
from loomis.schemas import SPECIAL_TOKENS as _SPECIALS  # noqa: E402

PAT = _PAT
NL = "chr(10)"

CRENDER = f"""CRENDER AS (
  SELECT conv_id, string_agg('<|im_start|>' || role || {NL} || text || '<|im_end|>' || {NL}, '' ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id)"""

_SP_VALUES = ", ".join(f"('{t}', {i})" for i, t in enumerate(_SPECIALS))


def vocab(name: str, corpus: str, text: str = "text") -> list[str]:
    """CTEs ``{name}`` (token, freq, id) over ``corpus.text``."""
    return [f"""{name}_VC AS (
  SELECT token, count(*) AS freq FROM (SELECT unnest(regexp_extract_all({text}, '{PAT}')) AS token FROM {corpus})
  GROUP BY token)""", f"""{name}_SP AS (SELECT * FROM (VALUES {_SP_VALUES}) sp(token, id))""", f"""{name} AS (
  SELECT s.token, CAST(coalesce(v.freq, 0) AS BIGINT) AS freq, CAST(s.id AS BIGINT) AS id
  FROM {name}_SP s LEFT JOIN {name}_VC v ON s.token = v.token
  UNION ALL
  SELECT token, freq, CAST({len(_SPECIALS) - 1} + row_number() OVER (ORDER BY freq DESC, token) AS BIGINT) AS id
  FROM {name}_VC WHERE token NOT IN (SELECT token FROM {name}_SP))"""]


def encoded(name: str, corpus: str, key: str, voc: str, text: str = "text") -> str:
    """CTE ``{name}`` (key, ids) — ids in token order, empty list for no tokens."""
    return f"""{name} AS (
  SELECT c.{key}, coalesce(e.ids, []::BIGINT[]) AS ids FROM {corpus} c LEFT JOIN (
    SELECT {key}, list(v.id ORDER BY pos) AS ids FROM (
      SELECT {key}, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos
      FROM (SELECT {key}, regexp_extract_all({text}, '{PAT}') AS toks FROM {corpus})) t
    JOIN {voc} v ON t.token = v.token GROUP BY {key}) e ON c.{key} = e.{key})"""
