"""Schemas, dimensions and fixed values.

Everything under "FIXED VALUES" must stay exactly as written: these strings and
numbers are the data contract of the task file format, the chat template, the
itemic-token vocabulary and the evaluation protocol.  They are data, not logic.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the task format / protocol exactly)
# ---------------------------------------------------------------------------

# Sectioned task file: category name and heading text (followed by a full-width
# "：" or ASCII ":" colon).  Order is the file order of the four dimensions.
SECTION_HEADINGS = [
    ("物料", "物料数据示例"),
    ("用户", "用户数据示例"),
    ("推荐", "推荐数据示例"),
    ("世界", "世界知识数据示例"),
]
SECTION_COLONS = "[：:]"

# ChatML template pieces.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
ENDOFTEXT = "<|endoftext|>"
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
EMPTY_THINK_BLOCK = "<think>\n\n</think>\n\n"
NO_THINK_SUFFIX = "/no_think"
THINK_SUFFIX = "/think"
SPECIAL_TOKENS = [ENDOFTEXT, IM_START, IM_END, THINK_OPEN, THINK_CLOSE]

# Plain-prompt fallback when no chat template is present.
PLAIN_USER_PREFIX = "用户："
PLAIN_ANSWER_PREFIX = "回答："

# Chat loop command words.
QUIT_WORDS = ["quit", "exit", "q"]
CLEAR_COMMAND = "/clear"
LEN_COMMAND = "/len"
DEFAULT_SYSTEM_PROMPT = "你是一个推荐系统助手。"

# Itemic tokens: <|{domain}_begin|><s_a_{a}><s_b_{b}><s_c_{c}>, codes 0..8191.
ITEMIC_DOMAINS = ["video", "prod", "ad", "living", "sid"]
CODEBOOK_SIZE = 8192
CODEBOOK_LEVELS = ["a", "b", "c"]

# Label value ignored by the loss.
IGNORE_INDEX = -100

# Training defaults (flags of the training entry point).
DEFAULT_MAX_LEN = 2048
DEFAULT_LR = 5e-5
DEFAULT_EPOCHS = 5
DEFAULT_GRAD_ACCUM = 8
DEFAULT_LORA_R = 8
DEFAULT_LORA_ALPHA = 16
DEFAULT_BATCH_SIZE = 1
WARMUP_RATIO = 0.05

# Candidate generation protocol: 64 generations, 32 thinking + 32 non-thinking.
CANDIDATES_PER_MODE = 32
CANDIDATES_TOTAL = 64

# Decoding strategies compared on one prompt (name, do_sample, T, top_p).
DECODING_STRATEGIES = [
    ("greedy", False, None, None),
    ("sample_t0.3", True, 0.3, 0.95),
    ("sample_t0.7", True, 0.7, 0.95),
    ("sample_t1.5", True, 1.5, 0.95),
]
DEFAULT_TEMPERATURE = 0.7

# Material understanding: instruction and prompt of the catalogue rows.
MATERIAL_SYSTEM_PROMPT = (
    "你是一个视频内容理解助手。\n"
    "请分析给定的视频物料，输出：\n"
    "1. 视频类型\n"
    "2. 目标观众\n"
    "3. 3个关键词\n"
    "4. 适合推荐的场景（如：晚饭不知道吃什么、想学做饭等）\n"
    "用简洁的 JSON 格式回复。"
)
MATERIAL_USER_PREFIX = "请分析这个视频物料："

# Evaluation layers and the official daily submission quota.
LAYERS = [("R0", "物料", "item understanding"), ("R2", "用户", "user evolution"),
          ("R3", "推荐", "recommendation"), ("world", "世界", "world knowledge")]
DAILY_SUBMISSION_QUOTA = 3

# ---------------------------------------------------------------------------
# Canonical record shapes
# ---------------------------------------------------------------------------
MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])
MESSAGES = T.ArrayType(MESSAGE)

CHAT_RECORD = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("task", T.StringType()),
    T.StructField("messages", MESSAGES),
])

THREE_FIELD = T.StructType([
    T.StructField("system", T.StringType()),
    T.StructField("prompt", T.StringType()),
    T.StructField("response", T.StringType()),
])

ITEMIC = T.StructType([
    T.StructField("domain", T.StringType()),
    T.StructField("a", T.IntegerType()),
    T.StructField("b", T.IntegerType()),
    T.StructField("c", T.IntegerType()),
])

# Competition calendar (month, day) ranges: registration, preliminary round,
# semifinal (adds LLM-as-judge), code review.
COMPETITION_PHASES = [
    ("registration", (6, 13), (6, 29)),
    ("preliminary", (7, 1), (7, 31)),
    ("semifinal", (8, 1), (8, 31)),
    ("review", (9, 1), (9, 15)),
]
