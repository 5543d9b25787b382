"""Chat formatting with Spark expressions only: collect and sort turn structs, merge same-role neighbours, concatenate.

A formatted conversation is a row of turns. Each is ``### Role: body</turn>`` and a line end; the bodies of
neighbours of one role are merged into one turn, with ``<next>`` between them. Inside roles and texts every control
string is written as a backslash and a letter, and the backslash itself as ``\\s``, so that the format reads back
exactly. The loss mask is a list of code-point ranges over the formatted text, one per assistant text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END, NEXT, HEAD = "</turn>", "<next>", "### "
#: Control strings and their escapes; the backslash comes first when writing and last when reading.
ESCAPES = (("\\", "\\s"), (END, "\\e"), (NEXT, "\\n"), (HEAD, "\\h"), (": ", "\\c"))


def escape(text: Column, pairs: tuple = ESCAPES[:-1]) -> Column:
    for plain, coded in pairs:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, pairs: tuple = ESCAPES) -> Column:
    for plain, coded in reversed(pairs):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def blocks_of(items: Column) -> Column:
    """An array as an array of arrays of about the square root of its length, so that folds within and over blocks stay short; ``items`` is to be a column, as it is read for every block."""
    size = F.ceil(F.sqrt(F.size(items))).cast("int")
    many = F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), F.ceil(F.size(items) / size).cast("int") - 1), lambda k: F.slice(items, k * size + 1, size)))
    return F.coalesce(many, F.filter(F.array(items), lambda x: F.lit(False)))


def format_conversations(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant") -> DataFrame:
    """(conv id, formatted, mask): one row per conversation; mask is an array of (start, end), code points, end exclusive.

    Turns are ordered by turn number, nulls first; ties by role, then text; repeated rows all stay. A null text or
    role counts as empty, and rows with a null conversation id form one conversation. Roles are kept as
    written. Empty texts of ``learn`` have an empty range. Extra columns are not read; an empty table gives
    an empty result. A conversation is one row of the result, so its turns meet in one task; turns are
    merged by comparing neighbours in the sorted array. Places under the mask are sums over blocks of turns and then within
    them, so that 50,000 turns take no more than a few hundred steps over each.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit("")).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("x")
    ).select("conv", F.struct("t", "r", "x").alias("row"))
    sorted_rows = rows.groupBy("conv").agg(F.array_sort(F.collect_list("row")).alias("rows"))

    def segment(one: Column, i: Column) -> Column:
        """What the row adds: (before its text, text, after it)."""
        same_before = (i > 0) & (F.get("rows", i - 1)["r"] == one["r"])
        same_after = F.coalesce(F.get("rows", i + 1)["r"] == one["r"], F.lit(False))
        head = F.concat(F.lit(HEAD), escape(one["r"], ESCAPES), F.lit(": "))
        return F.struct(
            F.when(same_before, F.lit(NEXT)).otherwise(head).alias("before"),
            escape(one["x"]).alias("body"),
            F.when(same_after, F.lit("")).otherwise(F.lit(END + "\n")).alias("after"),
            (one["r"] == learn).alias("learn"),
        )

    made = sorted_rows.select("conv", F.transform("rows", segment).alias("parts"))
    made = made.select("conv", "parts", F.array_join(F.transform("parts", lambda p: F.concat(p["before"], p["body"], p["after"])), "").alias("formatted"))

    lengths = F.transform("parts", lambda p: F.struct(F.length(p["before"]).alias("before"), F.length(p["body"]).alias("body"), F.length(p["after"]).alias("after"), p["learn"].alias("learn")))
    made = made.select("conv", "formatted", lengths.alias("lengths")).select("conv", "formatted", blocks_of(F.col("lengths")).alias("blocks"))
    made = made.select("conv", "formatted", "blocks", F.transform("blocks", lambda b: F.aggregate(b, F.lit(0), lambda at, p: at + p["before"] + p["body"] + p["after"])).alias("sizes"))

    def start(state: Column, size: Column) -> Column:
        return F.struct((state["at"] + size).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))

    starts = F.aggregate("sizes", F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")), start, lambda state: state["starts"])
    made = made.select("conv", "formatted", F.arrays_zip(F.col("blocks"), starts.alias("start")).alias("blocks"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["before"]
        end = start + part["body"]
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct((end + part["after"]).alias("at"), F.when(part["learn"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    def spans(block: Column) -> Column:
        return F.aggregate(block["blocks"], F.struct(block["start"].alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")), step, lambda state: state["spans"])

    return made.select(F.col("conv").alias(conv_id), "formatted", F.flatten(F.transform("blocks", spans)).alias("mask"))


def read_back(formatted: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(conv id, turns, loss_text, formatted): every row's (role, text) and the text under the mask, from the formatted text and mask alone."""
    pieces = F.filter(F.split("formatted", END + "\n"), lambda p: p != "")

    def parted(piece: Column) -> Column:
        role = unescape(F.substring_index(F.substring(piece, len(HEAD) + 1, 1 << 30), ": ", 1))
        return F.struct(role.alias("role"), F.split(F.substring(piece, F.instr(piece, F.lit(": ")) + 2, F.length(piece)), NEXT).alias("texts"))

    # A merged turn is taken apart once, and then its texts one by one.
    turns = F.flatten(F.transform(F.transform(pieces, parted), lambda t: F.transform(t["texts"], lambda x: F.struct(t["role"].alias("role"), unescape(x).alias("text")))))
    first, last = lambda b: F.get(b, F.lit(0))["start"], lambda b: F.element_at(b, -1)["end"]
    parts = formatted.select(conv_id, "formatted", turns.alias("turns"), blocks_of(F.col("mask")).alias("blocks"))
    # The text of a block of ranges is cut from the whole, and each range from that text.
    parts = parts.select(conv_id, "formatted", "turns", F.transform("blocks", lambda b: F.struct(F.substring(F.col("formatted"), first(b) + 1, last(b) - first(b)).alias("text"), b.alias("ranges"))).alias("blocks"))
    learned = F.flatten(F.transform("blocks", lambda b: F.transform(b["ranges"], lambda m: unescape(F.substring(b["text"], m["start"] - first(b["ranges"]) + 1, m["end"] - m["start"])))))
    return parts.select(conv_id, "turns", F.array_join(learned, "").alias("loss_text"), "formatted")


def digests(formatted: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """Counts and hex SHA-256 digests of what ``read_back`` returns."""
    back = read_back(formatted, conv_id)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        conv_id,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), seen AS (
  SELECT *, coalesce(lag(role) OVER w = role, false) AS follows, coalesce(lead(role) OVER w = role, false) AS goes_on,
    length(replace(replace(replace(replace(text, '\', '\s'), '</turn>', '\e'), '<next>', '\n'), '### ', '\h')) AS body,
    length(replace(replace(replace(replace(replace(role, '\', '\s'), '</turn>', '\e'), '<next>', '\n'), '### ', '\h'), ': ', '\c')) AS head
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(body + CASE WHEN follows THEN 6 ELSE 6 + head END + CASE WHEN goes_on THEN 0 ELSE 8 END)::BIGINT AS formatted_chars
FROM seen GROUP BY conv_id
"""
