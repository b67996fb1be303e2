"""Chat formatting with a grammar round trip.

Rendered conversation (deterministic grammar)::

    conversation := turn*
    turn         := "<s>[INST] " role " [/INST]\\n" text "</s>\\n"

The parser cuts at every ``</s>\\n``, takes the role up to the first
`` [/INST]\\n`` and undoes the escapes. A conversation is rendered raw,
parsed again and compared with its source; where they differ, the turns
with conflicting content are escaped and the test is repeated, at last with
every turn escaped. Native column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, HEAD_END, END = "<s>[INST] ", " [/INST]\n", "</s>\n"

# Escapes (fixed values): each control string and the backslash have a
# two-character code. The backslash comes first when escaping and last
# when undoing, so a code can never arise from plain text.
ESCAPES = (
    ("\\", "\\b"),
    ("</s>", "\\e"),
    ("<s>", "\\o"),
    ("[INST]", "\\i"),
    ("[/INST]", "\\c"),
)
CONTROLS = tuple(plain for plain, _ in ESCAPES if plain != "\\")
# What is escaped at each level.
LEVELS = ("control strings", "backslashes too", "everything")


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _holds(text: Column, strings) -> Column:
    hit = F.lit(False)
    for plain in strings:
        hit = hit | F.contains(text, F.lit(plain))
    return hit


def _encode(text: Column, level: int) -> Column:
    if level == 2:
        return escape(text)
    strings = CONTROLS if level == 0 else [plain for plain, _ in ESCAPES]
    return F.when(_holds(text, strings), escape(text)).otherwise(text)


def render(turns: Column, level: int) -> Column:
    """Text of an array<struct<role, text>> at an escape level."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), _encode(t["role"], level), F.lit(HEAD_END), _encode(t["text"], level),
        F.lit(END))), "")


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> read from a rendered conversation."""
    pieces = F.split(formatted, END)
    bodies = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        rest = F.substring(p, F.lit(len(OPEN) + 1), F.length(p))
        at = F.instr(rest, HEAD_END)
        return F.struct(
            unescape(F.substring(rest, F.lit(1), at - 1)).alias("role"),
            unescape(F.substring(rest, at + len(HEAD_END), F.length(rest))).alias("text"))

    return F.transform(bodies, turn)


def mask_runs(turns: Column, level: Column) -> Column:
    """Loss mask over the rendered text as runs (chars, loss): the texts of
    assistant turns count, markup and the other turns do not."""
    def enc(c: Column) -> Column:
        return (F.when(level == 0, _encode(c, 0)).when(level == 1, _encode(c, 1))
                .otherwise(_encode(c, 2)))

    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct((F.length(enc(t["role"])) + len(OPEN) + len(HEAD_END)).alias("chars"),
                 F.lit(False).alias("loss")),
        F.struct(F.length(enc(t["text"])).alias("chars"),
                 (t["role"] == "assistant").alias("loss")),
        F.struct(F.lit(len(END)).alias("chars"), F.lit(False).alias("loss")))))


def masked(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask, cut out of the rendered text and
    unescaped, in order."""
    placed = F.aggregate(
        mask, F.struct(F.lit(1).alias("at"), F.expr("array()").cast("array<struct<at:int,chars:int>>")
                       .alias("runs")),
        lambda acc, r: F.struct(
            (acc["at"] + r["chars"]).alias("at"),
            F.when(r["loss"], F.array_append(acc["runs"], F.struct(
                acc["at"].alias("at"), r["chars"].alias("chars"))))
            .otherwise(acc["runs"]).alias("runs")),
        lambda acc: acc["runs"])
    return F.transform(placed, lambda r: unescape(F.substring(formatted, r["at"], r["chars"])))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id: formatted, level, turns (read back), mask.

    Rows are ordered by turn, ties by role and text (nulls first), repeated
    rows are repeated turns. Null role or text counts as empty; a null
    conv_id is a conversation of its own. Columns other than conv_id, turn,
    role, text are not read; no rows give no rows. A conversation is one
    output row, so its whole text has to fit in one.
    """
    source = (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")))).alias("rows"))
        .select("conv_id", F.transform("rows", lambda r: F.struct(
            r["role"].alias("role"), r["text"].alias("text"))).alias("source")))
    # Each later level only where the round trip still differs.
    out = source.withColumns({"formatted": render(F.col("source"), 0), "level": F.lit(0)})
    for level in range(1, len(LEVELS)):
        out = out.withColumn("same", parse(F.col("formatted")) == F.col("source"))
        out = out.withColumns({
            "formatted": F.when(F.col("same"), F.col("formatted"))
                          .otherwise(render(F.col("source"), level)),
            "level": F.when(F.col("same"), F.col("level")).otherwise(F.lit(level))})
    out = out.withColumn("turns", parse(F.col("formatted")))
    checked = F.when(F.col("turns") == F.col("source"), F.col("formatted")).otherwise(
        F.raise_error(F.lit("a rendered conversation does not parse back to its source")))
    return out.select("conv_id", checked.alias("formatted"), "level", "turns",
                      mask_runs(F.col("source"), F.col("level")).alias("mask"))


# Conversation -1 (contract): its texts carry the template's own markers.
PROBE = "</s>[INST] ok [/INST]"


def op7_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, with digests of what the
    parser reads back from the formatted text."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"))
    out = format_conversations(rows.unionByName(probe))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(masked(F.col("formatted"), F.col("mask")), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


# DuckDB: what the source rows say; the engine's rows are read back from
# the rendered text.
_CHAT_ROWS = f"""
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}'
  UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'"""
def _sql_control(c: str) -> str:
    return "(" + " OR ".join(f"contains({c}, '{plain}')" for plain in CONTROLS) + ")"


def _sql_escape(c: str) -> str:
    for plain, code in ESCAPES:
        c = f"replace({c}, '{plain}', '{code}')"
    return c


_ORDER = "ORDER BY turn NULLS FIRST, role, text"
OP7_SQL = f"""
WITH rows AS ({_CHAT_ROWS}),
enc AS (
  SELECT *, {_sql_escape('role')} AS role1, {_sql_escape('text')} AS text1,
         {_sql_control('role')} AS role_held, {_sql_control('text')} AS text_held FROM rows),
-- a string left raw does not read back if a code stands in it
raw AS (
  SELECT *, (NOT role_held AND regexp_matches(role, '\\\\[beoic]'))
            OR (NOT text_held AND regexp_matches(text, '\\\\[beoic]')) AS bad
  FROM enc),
conv AS (SELECT conv_id, bool_or(bad) AS bad FROM raw GROUP BY conv_id)
SELECT r.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' {_ORDER})) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' {_ORDER}) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(CASE WHEN role_held OR c.bad THEN length(role1) ELSE length(role) END
                + CASE WHEN text_held OR c.bad THEN length(text1) ELSE length(text) END
                + {len(OPEN + HEAD_END + END)}) AS BIGINT) AS formatted_chars
FROM raw r JOIN conv c ON r.conv_id IS NOT DISTINCT FROM c.conv_id
GROUP BY r.conv_id"""
