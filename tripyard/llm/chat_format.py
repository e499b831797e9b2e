"""Chat formatting with Spark expressions only.

A conversation's rows are collected as structs and sorted by turn; adjacent
turns of one role become one block through an array aggregation, and the
blocks are concatenated:

    <|im_start|>ROLE<|im_text|>TEXT<|im_sep|>TEXT ...<|im_end|>

``<|im_sep|>`` separates the turns inside a merged block, so the turns can be
read back. Inside roles and texts every ``<``, ``[`` and ``\\`` gets a
backslash behind it; so neither the marks of this template nor control strings
of others (``</s>``, ``[INST]``, ``<|...|>``) occur unescaped, and removing
the backslash behind each of the three restores the text.

The loss mask is a list of (start, length) spans in code points of the
formatted text, one span for each turn of an assistant.

Defined results: null text or role is empty; rows sort by (turn, role, text)
with nulls first, so ties and repeated rows are kept in a fixed order; a null
conv_id is a conversation of its own; an empty table gives an empty table;
other columns are ignored. One conversation is one output string, so its turns
meet in one row by definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

START, TEXT, SEP, END = "<|im_start|>", "<|im_text|>", "<|im_sep|>", "<|im_end|>"
LEARNED_ROLE = "assistant"


def escape(col):
    return F.regexp_replace(col, r"([<\[\\])", r"$1\\")


def unescape(col):
    return F.regexp_replace(col, r"([<\[\\])\\", "$1")


def _merged(turns):
    """Blocks of adjacent same-role turns: array of (role, texts)."""
    none = F.expr("cast(array() as array<struct<role: string, texts: array<string>>>)")

    def step(blocks, turn):
        n = F.size(blocks)
        last = F.element_at(blocks, F.greatest(n, F.lit(1)))
        alone = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        joined = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        return F.when((n > 0) & (F.get(blocks, n - 1)["role"] == turn["role"]),
                      F.concat(F.slice(blocks, F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(joined))
                      ).otherwise(F.concat(blocks, F.array(alone)))

    return F.aggregate(turns, none, step)


def format_conversations(rows: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """conv_id, formatted, loss_spans (array of (start, length), from 0)."""
    turns = rows.select(
        rows["conv_id"].alias("conv_id"), rows["turn"].alias("turn"),
        escape(F.coalesce(rows["role"].cast("string"), F.lit(""))).alias("role"),
        escape(F.coalesce(rows["text"].cast("string"), F.lit(""))).alias("text"))
    sorted_turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    blocks = turns.groupBy("conv_id").agg(sorted_turns.alias("turns")).select("conv_id", _merged(F.col("turns")).alias("blocks"))
    head = lambda b: F.concat(F.lit(START), b["role"], F.lit(TEXT))
    formatted = F.array_join(F.transform(
        "blocks", lambda b: F.concat(head(b), F.array_join(b["texts"], SEP), F.lit(END))), "")
    return blocks.select("conv_id", formatted.alias("formatted"), _spans(F.col("blocks"), learned_role).alias("loss_spans"))


def _spans(blocks, learned_role: str):
    """Positions of the learned role's turns, from the lengths of what stands
    before them. Pieces are (length, learned) in order of the output."""
    piece = lambda n, on: F.struct(n.cast("long").alias("n"), on.alias("on"))
    off = F.lit(False)

    def pieces(b):
        on = unescape(b["role"]) == F.lit(learned_role)
        texts = F.flatten(F.transform(b["texts"], lambda t: F.array(
            piece(F.length(t), on), piece(F.lit(len(SEP)), off))))
        kept = F.slice(texts, F.lit(1), F.size(texts) - 1)  # no separator behind the last
        lead = F.array(piece(F.length(b["role"]) + len(START) + len(TEXT), off))
        return F.concat(lead, kept, F.array(piece(F.lit(len(END)), off)))

    zero = F.expr("named_struct('at', 0L, 'spans', cast(array() as array<struct<start: bigint, length: bigint>>))")

    def step(acc, p):
        here = F.array(F.struct(acc["at"].alias("start"), p["n"].alias("length")))
        return F.struct((acc["at"] + p["n"]).alias("at"),
                        F.when(p["on"], F.concat(acc["spans"], here)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(F.flatten(F.transform(blocks, pieces)), zero, step, lambda acc: acc["spans"])


def read_back(formatted):
    """The turns of a formatted text: array of (role, text), unescaped."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>"), lambda b: b != F.lit(""))

    def turns(block):
        parts = F.split(F.substring(block, len(START) + 1, 2147483647), r"<\|im_text\|>")
        return F.transform(F.split(F.get(parts, F.lit(1)), r"<\|im_sep\|>"), lambda t: F.struct(
            unescape(F.get(parts, F.lit(0))).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def learned_text(formatted, spans):
    """What the loss mask covers, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digest(formatted: DataFrame) -> DataFrame:
    """Figures of each conversation, all of them read back from the output."""
    turns, learned = read_back(F.col("formatted")), learned_text(F.col("formatted"), F.col("loss_spans"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select("conv_id", "formatted", turns.alias("turns"), learned.alias("learned")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: The added conversation: texts made of other templates' control strings.
CONTROL_CASE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def with_control_case(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    extra = spark.createDataFrame(CONTROL_CASE, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def oracle_sql() -> str:
    escaped = "regexp_replace({}, '([<\\[\\\\])', '\\1\\\\', 'g')"
    return f"""
        WITH c AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
          UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        o AS (
          SELECT *, coalesce(lag(role) OVER w = role, false) AS same FROM c
          WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = '{LEARNED_ROLE}'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = '{LEARNED_ROLE}'), '')) AS loss_sha256,
               sum(length({escaped.format('text')}) + CASE WHEN same THEN {len(SEP)} ELSE
                   length({escaped.format('role')}) + {len(START) + len(TEXT) + len(END)} END)::BIGINT AS formatted_chars
        FROM o GROUP BY conv_id"""
