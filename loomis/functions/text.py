"""Column-expression helpers shared by the operators.

All helpers return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomis.schemas import IM_END, IM_START, SPECIAL_TOKENS

# Default pre-tokenizer (no external vocabulary file is available): special
# markers and itemic sub-tokens stay atomic, each CJK / kana / hangul character
# is one token, a run of Latin/Greek/Cyrillic letters, digits and "_" is one
# token, and any other non-space character is one token.  The pattern is valid
# both for Java regex (Spark) and RE2 (the DuckDB oracle).
TOKEN_PATTERN = (
    r"<\|[a-z_]+\|>|</?think>|<s_[a-z]_[0-9]+>"
    r"|[\x{3040}-\x{30ff}\x{3400}-\x{9fff}\x{ac00}-\x{d7af}\x{f900}-\x{faff}]"
    r"|[0-9A-Za-z_\x{00c0}-\x{024f}\x{0370}-\x{052f}]+"
    r"|[^\s\x{0b}]"
)

# Special-token alternation used by "skip special tokens" style cleanups.
SPECIAL_PATTERN = r"<\|[a-z_]+\|>|</?think>"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove all leading/trailing whitespace (Spark
    ``trim`` removes only spaces)."""
    return F.regexp_replace(col_(c), r"^\s+|\s+$", "")


def tokens(c) -> Column:
    """Array of token strings of a text column (default pre-tokenizer)."""
    return F.regexp_extract_all(col_(c), F.lit(TOKEN_PATTERN), 0)


def token_count(c) -> Column:
    return F.size(tokens(c))


def word_count(c) -> Column:
    """Python ``len(text.split())``: number of whitespace-separated words."""
    return F.size(F.regexp_extract_all(col_(c), F.lit(r"[^\s\x{0b}]+"), 0))


def chatml_turn(role, content) -> Column:
    return F.concat(F.lit(IM_START), col_(role), F.lit("\n"), col_(content), F.lit(IM_END + "\n"))


def render_messages(messages) -> Column:
    """ChatML text of an ``array<struct<role, content>>`` column."""
    return F.array_join(
        F.transform(col_(messages), lambda m: chatml_turn(m["role"], m["content"])), "")


def seeded_key(id_col, seed) -> Column:
    """Deterministic pseudo-random sort key ``md5(id:seed)`` (engine-portable)."""
    return F.md5(F.concat_ws(":", col_(id_col).cast("string"), F.lit(str(seed))))


def md5_uniform(id_col, seed) -> Column:
    """Uniform double in [0, 1) from the first 13 hex digits of md5(id:seed)."""
    h = F.substring(seeded_key(id_col, seed), 1, 13)
    return F.conv(h, 16, 10).cast("double") / F.lit(float(16 ** 13))


def drop_special_tokens(c) -> Column:
    return F.regexp_replace(col_(c), SPECIAL_PATTERN, "")


def preview(c, n: int = 80) -> Column:
    """First ``n`` characters, newlines then escaped, ``...`` when cut."""
    x = col_(c)
    cut = F.replace(F.substring(x, 1, n), F.lit("\n"), F.lit("\\n"))
    return F.when(F.length(x) > n, F.concat(cut, F.lit("..."))).otherwise(cut)


__all__ = [
    "TOKEN_PATTERN", "SPECIAL_PATTERN", "SPECIAL_TOKENS", "strip_ws", "tokens", "token_count",
    "word_count", "chatml_turn", "render_messages", "seeded_key", "md5_uniform",
    "drop_special_tokens", "preview",
]
