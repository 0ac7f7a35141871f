r"""Chat formatting by folding an event log (DataFrame functions only).

A log has rows (conv_id, seq, kind, turn, role, text); ``kind`` is ``message`` (begins a turn),
``delta`` (appends streamed text), ``edit`` (replaces the turn's text) or ``regenerate`` (begins
the turn anew and discards what later turns had received before it). Events are folded by turn,
turns are gathered by conversation and rendered as

    <|turn|>role<|text|>text<|end|>

In roles and texts one backslash goes between the first character of a control string and the rest
(``<|`` to ``<\|``, ``</s>`` to ``<\/s>``, ``[INST]`` to ``[\INST]``; backslashes already there stay,
so ``<\|`` becomes ``<\\|``). Taking one backslash away again gives the text back exactly.

Defined results: null text and null role count as empty; rows with equal turn keep both, in order of
role, then text; null ``conv_id`` is one conversation of its own, null turns come first; an empty log
gives no rows. ``loss`` holds for each turn how many code points after its beginning the loss begins
and for how many it lasts (0 for turns of other roles).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: What may follow the first character, with any backslashes between, in a control string.
_CONTROL = r"(?=\||/?s>|/?INST\])"


def escaped(text: Column) -> Column:
    """``text`` without control strings."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1$2\\")


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given."""
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, r"$1$2")


def message_log(messages: DataFrame) -> DataFrame:
    """A log for finished messages (conv_id, turn, role, text): each begins its own turn.

    Messages that share a turn get turns of their own by ``part``.
    """
    tied = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return messages.select(
        "conv_id", F.lit(0).cast("long").alias("seq"), F.lit("message").alias("kind"), "turn",
        F.row_number().over(tied).alias("part"), "role", "text")


def final_messages(log: DataFrame) -> DataFrame:
    """One row (conv_id, turn, part, role, text) for each turn that is left after all events."""
    if "part" not in log.columns:
        log = log.withColumn("part", F.lit(1))
    event = F.struct(F.col("seq"), F.col("kind"), F.col("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = log.groupBy("conv_id", "turn", "part").agg(
        F.array_sort(F.collect_list(event)).alias("events"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("anew"))
    # What an earlier turn's regeneration makes void: events of this turn before it.
    earlier = Window.partitionBy("conv_id").orderBy("turn", "part").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("void", F.max("anew").over(earlier))
    events = F.filter("events", lambda e: F.col("void").isNull() | (e["seq"] > F.col("void")))
    turns = turns.withColumn("events", events).filter(F.size("events") > 0)
    # The text is what came since the last event that sets it.
    last = F.array_max(F.transform(F.col("events"), lambda e: F.when(e["kind"] != "delta", e["seq"])))
    turns = turns.withColumn("last", last)
    live = F.filter("events", lambda e: F.col("last").isNull() | (e["seq"] >= F.col("last")))
    role = F.filter(F.transform(F.col("events"), lambda e: e["role"]), lambda r: r.isNotNull())
    return turns.select("conv_id", "turn", "part", F.try_element_at(role, F.lit(-1)).alias("role"),
                        F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row (conv_id, formatted, loss) for each conversation of ``final_messages``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(TURN), escaped(role), F.lit(TEXT))
    body = escaped(text)
    turns = messages.select(
        "conv_id", "turn", "part", F.concat(head, body, F.lit(END)).alias("piece"),
        F.struct(F.char_length(head).alias("skip"),
                 F.when(role == loss_role, F.char_length(body)).otherwise(0).alias("take")).alias("loss"))
    whole = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "part", "piece", "loss"))).alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform("turns", lambda t: t["loss"]).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text): roles and texts as parsed from ``formatted``, and the unescaped text under the mask."""
    pieces = formatted.select("conv_id", "formatted", "loss",
                              F.split("formatted", F.lit(r"<\|end\|>")).alias("pieces"))
    turns = F.transform(
        F.slice("pieces", 1, F.size("pieces") - 1),
        lambda p: F.struct(
            unescaped(F.substring_index(F.substring_index(p, TEXT, 1), TURN, -1)).alias("role"),
            unescaped(F.substring_index(p, TEXT, -1)).alias("text")))
    under = F.array_join(F.transform(
        F.arrays_zip(F.slice("pieces", 1, F.size("pieces") - 1).alias("p"), F.col("loss").alias("m")),
        lambda z: unescaped(F.substr(z["p"], z["m"]["skip"] + 1, z["m"]["take"]))), "")
    return pieces.select("conv_id", "formatted", turns.alias("turns"), under.alias("loss_text"))


def op8_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, digested from the formatted text."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    table = table.unionByName(spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"))
    back = read_back(render(final_messages(message_log(table))))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(told, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


#: The control strings in a role or text add one backslash each.
OP8_SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(23 + length(role) + length(text)
        + len(regexp_extract_all(role, '[<\[]\\*(\||/?s>|/?INST\])'))
        + len(regexp_extract_all(text, '[<\[]\\*(\||/?s>|/?INST\])'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""
