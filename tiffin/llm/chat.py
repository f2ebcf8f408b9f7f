"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; neighbours of one role are merged
into a block, by slicing the array where the role changes; and the blocks are concatenated:

    <|start|>role<|message|>text<|end|>            one block
    <|start|>role<|message|>text<|next|>text<|end|>   two merged turns

The array is cut and joined, not grown turn by turn, and places are summed up in chunks, so the work is linear in
the conversation (tests/llm/test_chat.py compares 16,000 and 32,000 turns).

Control strings inside texts and roles - these five, other <|names|>, <s>, </s>, [INST], [/INST] -
are escaped by one backslash after their first character. If backslashes follow that character
already, one more is put, so removing one restores the text exactly.

The loss mask is the spans (code points) of the assistant texts in the formatted text.

Defined results: a null text or role counts as empty. Turns of one number are ordered by role, then
text; a null number comes first. Repeated rows are turns of their own. A null conv_id is a
conversation. An empty table gives no rows. Other columns of the input take no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import table

START, MESSAGE, NEXT, END = "<|start|>", "<|message|>", "<|next|>", "<|end|>"
ASSISTANT = "assistant"
#: Pieces that are placed one after another.
_CHUNK = 256
#: First character with its backslashes, and the rest of a control string.
_CONTROL = [r"(<\\*)(\|[A-Za-z_]*\|>|/?s>)", r"(\[\\*)(/?INST\])"]
_ESCAPED = [r"(<\\*)\\(\|[A-Za-z_]*\|>|/?s>)", r"(\[\\*)\\(/?INST\])"]
CONTROL_CASE = "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    for pattern in _CONTROL:
        text = F.regexp_replace(text, pattern, r"$1\\$2")
    return text


def unescape(text: Column) -> Column:
    for pattern in _ESCAPED:
        text = F.regexp_replace(text, pattern, "$1$2")
    return text


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, also where `use` names it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def _merged(turns: Column) -> Column:
    """Blocks (role, texts) of neighbouring turns with one role."""
    n = F.size(turns)
    places = F.sequence(F.lit(0), n - 1)
    starts = F.filter(places, lambda i: (i == 0) | (turns[i]["role"] != F.get(turns, i - 1)["role"]))

    def block(starts: Column, start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(starts, k + 1), n)
        part = F.slice(turns, start + 1, stop - start)
        return F.struct(
            turns[start]["role"].alias("role"), F.transform(part, lambda t: t["text"]).alias("texts")
        )

    return _bound(starts, lambda found: F.transform(found, lambda i, k: block(found, i, k)))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id of `turns` (conv_id, turn, role, text): conv_id, blocks, formatted, loss
    (array of start, end)."""
    text, role = (F.coalesce(turns[c].cast("string"), F.lit("")) for c in ("text", "role"))
    turn = F.struct(turns["turn"].alias("turn"), role.alias("role"), text.alias("text"))
    escaped = F.transform(
        "turns",
        lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")),
    )
    formatted = F.transform(
        "blocks",
        lambda b: F.concat(
            F.lit(START), b["role"], F.lit(MESSAGE), F.array_join(b["texts"], NEXT), F.lit(END)
        ),
    )
    return (
        turns.select(turns["conv_id"], turn.alias("turn"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
        .select("conv_id", escaped.alias("turns"))
        .select("conv_id", _merged(F.col("turns")).alias("blocks"))
        .select("conv_id", "blocks", formatted.alias("parts"))
        .select(
            "conv_id",
            "blocks",
            F.array_join("parts", "").alias("formatted"),
            _loss(F.col("blocks"), F.col("parts")).alias("loss"),
        )
    )


def _grown(lengths: Column, gap: int) -> Column:
    zero = F.lit(0).cast("long")
    start = F.struct(F.array().cast("array<long>").alias("starts"), zero.alias("at"))
    step = lambda s, n: F.struct(
        F.concat(s["starts"], F.array(s["at"])).alias("starts"), (s["at"] + n + gap).alias("at")
    )
    return F.aggregate(lengths, start, step, lambda s: s["starts"])


def _starts(lengths: Column, gap: int) -> Column:
    """Where each piece begins, if `gap` characters stand between pieces.

    An array that grows is copied for each piece, so it grows within chunks, and chunks are shifted.
    """

    def chunked(all_lengths: Column) -> Column:
        last = F.floor(F.greatest(F.size(all_lengths) - 1, F.lit(0)) / _CHUNK).cast("int")
        places = F.sequence(F.lit(0), last)
        return F.transform(places, lambda c: F.slice(all_lengths, c * _CHUNK + 1, _CHUNK))

    def total(chunk: Column) -> Column:
        return F.aggregate(chunk, F.lit(0).cast("long"), lambda a, n: a + n + gap)

    def shifted(chunks: Column) -> Column:
        offsets = _grown(F.transform(chunks, total), 0)
        return F.flatten(
            F.zip_with(chunks, offsets, lambda c, at: F.transform(_grown(c, gap), lambda s: s + at))
        )

    return _bound(_bound(lengths, chunked), shifted)


def _loss(blocks: Column, parts: Column) -> Column:
    """Spans of assistant texts, one list per block, each from its block's place."""
    def length(c: Column) -> Column:
        return F.char_length(c).cast("long")

    block_starts = _starts(F.transform(parts, length), 0)

    def spans(b: Column, at: Column) -> Column:
        first = at + len(START) + length(b["role"]) + len(MESSAGE)
        starts = _starts(F.transform(b["texts"], length), len(NEXT))
        found = F.zip_with(
            b["texts"],
            starts,
            lambda t, s: F.struct((first + s).alias("start"), (first + s + length(t)).alias("end")),
        )
        return F.when(b["role"] == ASSISTANT, found)

    lists = F.zip_with(blocks, block_starts, spans)
    return F.flatten(F.filter(lists, lambda x: x.isNotNull()))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds, in order."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda b: b != "")

    def turns(block: Column) -> Column:
        halves = F.split(F.substr(block, F.lit(len(START) + 1)), r"<\|message\|>")
        return F.transform(
            F.split(halves[1], r"<\|next\|>"),
            lambda t: F.struct(unescape(halves[0]).alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    cut = lambda s: F.substr(
        formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")
    )
    return F.array_join(F.transform(loss, lambda s: unescape(cut(s))), "")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.sql(
        f"SELECT -7L AS conv_id, turn, role, '{CONTROL_CASE}' AS text"
        " FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    found = format_conversations(turns.unionByName(control)).select("conv_id", "formatted", "loss")
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        found.withColumn("turns", read_turns(F.col("formatted")))
        .withColumn("learned", loss_text(F.col("formatted"), F.col("loss")))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
            F.char_length("learned").cast("long").alias("loss_chars"),
            F.sha2("learned", 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def _sql_escape(text: str) -> str:
    for pattern in _CONTROL:
        text = f"regexp_replace({text}, '{pattern}', '\\1\\\\\\2', 'g')"
    return text


OP2_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_CASE}'
  UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_CASE}'
), marked AS (
  SELECT *, length({_sql_escape("role")}) AS role_chars, length({_sql_escape("text")}) AS text_chars,
    coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) = role, false) AS joined
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = '{ASSISTANT}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (WHERE role = '{ASSISTANT}'), '')) AS loss_sha256,
  sum(text_chars + CASE WHEN joined THEN {len(NEXT)}
    ELSE role_chars + {len(START + MESSAGE + END)} END)::BIGINT AS formatted_chars
FROM marked
GROUP BY conv_id
"""
