"""Model-output text helpers.

* ``strip_fences``: drop ```` ```json ```` / ```` ``` ```` markers and trim.
* ``array_slice``: the text from the first ``[`` to the last ``]`` (a nested
  list stays whole; the last-``[`` rule would cut it in half).
* ``parse_repair``: a truncated response is tried with up to two closers, all as
  Spark columns. Differences to a plain JSON parser: an object that repeats a
  key, and ``NaN`` or ``Infinity``, are not accepted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canonix.model import quote


def strip_fences(c: Column) -> Column:
    """Remove fence markers, then surrounding whitespace (newlines included)."""
    return F.regexp_replace(F.regexp_replace(c, r"```(json)?", ""), r"^\s+|\s+$", "")


def array_slice(c: Column) -> Column:
    """First ``[`` to last ``]``; null when there is no such span."""
    start = F.instr(c, "[")
    last = F.length(c) - F.instr(F.reverse(c), "]") + 1
    ok = (start > 0) & (F.instr(F.reverse(c), "]") > 0) & (last > start)
    return F.when(ok, F.substring(c, start, last - start + 1))


def _is_json(c: Column) -> Column:
    """Whether a text is one whole JSON document (null: no).

    The parser stops after the first document, so what follows it shows only inside a list and inside an object.
    """
    inside = [F.concat(F.lit("["), c, F.lit("]")), F.concat(F.lit('{"x":'), c, F.lit("}"))]
    return F.try_parse_json(inside[0]).isNotNull() & F.try_parse_json(inside[1]).isNotNull()


def repair_candidates(c: Column) -> list[Column]:
    """The text as it is, then with one and with two closers, in the order they are tried.

    Only a text that breaks off inside a string or after a value is completed: one that ends in an opening
    bracket, a comma or a colon lacks more than a closer, so its completions are null.
    """
    open_end = c.rlike(r"[^\s{\[,:]\s*$")
    after_brace = F.endswith(c, F.lit("}"))
    one = F.when(open_end, F.concat(c, F.when(after_brace, F.lit("]")).otherwise(F.lit("}"))))
    two = F.when(open_end, F.concat(c, F.when(after_brace, F.lit("]}")).otherwise(F.lit("}]"))))
    return [c, one, two]


def parse_repair_all(df: DataFrame, column: str, schema: T.DataType | str | None = None,
                     strip: bool = True) -> DataFrame:
    """One pass of the repair rule (C11): ``df`` plus ``accepted``, ``json_text``,
    ``error`` and, when ``schema`` is given, ``parsed`` (null unless accepted)."""
    src = F.col(quote(column))
    if strip:
        src = strip_fences(src)
    fixed = F.coalesce(*[F.when(_is_json(c), c) for c in repair_candidates(src)])
    out = df.withColumn("json_text", fixed)
    out = out.withColumns({
        "accepted": F.col("json_text").isNotNull(),
        "error": F.when(src.isNull(), F.lit("null input")).when(F.col("json_text").isNull(), F.lit("not valid JSON")),
    })
    if schema is not None:
        out = out.withColumn("parsed", F.from_json("json_text", schema))
    return out


def parse_repair(df: DataFrame, column: str, schema: T.DataType | str | None = None,
                 strip: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split rows into ``(accepted, quarantine)`` by the repair rule (C11).

    Accepted rows keep ``json_text`` (the repaired text) and ``parsed``;
    quarantined rows keep ``error``. Each side evaluates the rule; use
    :func:`parse_repair_all` when both sides are consumed in one job.
    """
    allrows = parse_repair_all(df, column, schema, strip)
    accepted = allrows.where(F.col("accepted")).drop("accepted", "error")
    quarantine = allrows.where(~F.col("accepted")).drop("accepted", "json_text", *(["parsed"] if schema else []))
    return accepted, quarantine
