"""Chat formatting with typed content parts, in DataFrame functions only.

A turn's content is an array of parts ``struct<kind, text, ref, units>``:

* ``text``: the text itself;
* ``image``: ``ref`` names the attachment, ``units`` its patches;
* ``audio``: ``units`` are seconds;
* ``document``: ``units`` are pages.

The parts of a turn are visited in order. Text is escaped and copied; each
other part becomes the placeholder ``<part KIND K>`` (``K``: its number in the
conversation, from 0) and an entry of ``attachments`` with the reference and
the number of tokens the placeholder expands to.

Template: ``<turn ROLE>CONTENT</turn>\\n`` for every turn, in turn order.
Inside roles and texts a backslash becomes ``\\s`` and the ``<`` of anything
that looks like a mark of the template becomes ``\\l`` (in roles also ``>``
becomes ``\\g``); ``unescape`` undoes it exactly, because after escaping every
backslash is followed by one of these letters.

Defined cases: a null text or role counts as empty; a null or empty parts array
is an empty content; a null part is skipped; an unknown kind is a placeholder
expanding to no token. Turns are ordered by (turn, role, content), nulls
first, so ties and repeated rows have one order. Rows with a null conversation
id form one conversation. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Tokens that one unit (patch, second, page) expands to.
UNIT_TOKENS = {"image": 1, "audio": 25, "document": 600}

PART = "struct<kind:string,text:string,ref:string,units:bigint>"
_MARK = r"<(?=/?turn|part)"


def escape(text: Column) -> Column:
    """Escape control strings of the template inside ``text``."""
    safe = F.replace(text, F.lit("\\"), F.lit("\\s"))
    return F.regexp_replace(safe, _MARK, r"\\l")


def unescape(text: Column) -> Column:
    """The inverse of ``escape`` (and of the escaping of roles)."""
    out = F.replace(text, F.lit("\\l"), F.lit("<"))
    out = F.replace(out, F.lit("\\g"), F.lit(">"))
    return F.replace(out, F.lit("\\s"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A content of one text part."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units")))


def _expanded(kind: Column, units: Column) -> Column:
    rate = F.lit(0)
    for name, tokens in UNIT_TOKENS.items():
        rate = F.when(kind == name, F.lit(tokens)).otherwise(rate)
    return (rate * F.coalesce(units, F.lit(0))).cast("bigint")


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", parts: str = "parts",
                         loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``formatted`` text, ``loss_spans``, ``attachments``.

    ``loss_spans`` holds one entry per turn of ``loss_role``: ``turn_index``,
    ``turn_start`` (where the turn's mark begins), ``start`` and ``length`` of
    its content in code points of ``formatted``. ``attachments`` holds
    ``position`` (order in the conversation), ``kind``, ``ref`` and ``tokens``;
    ``expanded_tokens`` is their sum.

    Offsets are running sums over the conversation's turns, taken in the same
    partitioning that the grouping uses: one shuffle, no quadratic copying.
    """
    content = F.filter(F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")),
                       lambda p: p.isNotNull())
    clean = rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.transform(content, lambda p: F.struct(
            F.coalesce(p["kind"], F.lit("")).alias("kind"),
            F.coalesce(p["text"], F.lit("")).alias("text"),
            p["ref"].alias("ref"), p["units"].alias("units"))).alias("parts"))
    media = F.filter("parts", lambda p: p["kind"] != "text")
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    earlier = by_turn.rowsBetween(Window.unboundedPreceding, -1)
    role_text = F.replace(escape(F.col("role")), F.lit(">"), F.lit("\\g"))
    seen = F.coalesce(F.sum(F.size(media)).over(earlier), F.lit(0))
    numbered = clean.select("*", (F.row_number().over(by_turn) - 1).alias("turn_index"),
                            seen.alias("first_part"))
    # Placeholder numbers: the media parts before this one, in the turn and before it.
    body = F.array_join(F.transform("parts", lambda p, i: F.when(
        p["kind"] == "text", escape(p["text"])).otherwise(F.concat(
            F.lit("<part "), escape(F.replace(p["kind"], F.lit(">"), F.lit("\\g"))), F.lit(" "),
            (F.col("first_part") + F.size(F.filter(
                F.slice("parts", F.lit(1), i), lambda q: q["kind"] != "text"))).cast("string"),
            F.lit(">")))), "")
    pieces = (numbered
              .select("conv_id", "turn", "turn_index", "role", "first_part",
                      media.alias("media"),
                      F.concat(F.lit("<turn "), role_text, F.lit(">")).alias("head"),
                      body.alias("body"))
              .withColumn("piece", F.concat("head", "body", F.lit("</turn>\n"))))
    by_index = Window.partitionBy("conv_id").orderBy("turn_index")
    start = F.coalesce(F.sum(F.length("piece").cast("bigint")).over(
        by_index.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.withColumn("turn_start", start).select(
        "conv_id", "turn_index", "piece",
        F.when(F.col("role") == loss_role, F.struct(
            "turn_index", "turn_start",
            (F.col("turn_start") + F.length("head")).alias("start"),
            F.length("body").cast("bigint").alias("length"))).alias("span"),
        F.transform("media", lambda p, i: F.struct(
            (F.col("first_part") + i).alias("position"), p["kind"].alias("kind"),
            p["ref"].alias("ref"), _expanded(p["kind"], p["units"]).alias("tokens"))
        ).alias("media"))
    grouped = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn_index", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list("span")).alias("loss_spans"),
        F.array_sort(F.flatten(F.collect_list("media"))).alias("attachments"))
    return grouped.select(
        "conv_id", F.array_join(F.col("pieces.piece"), "").alias("formatted"),
        "loss_spans", "attachments",
        F.aggregate("attachments", F.lit(0).cast("bigint"),
                    lambda t, a: t + a["tokens"]).alias("expanded_tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse ``formatted`` again: ``turns`` (role, text) and the ``loss_texts``.

    Both come from the formatted text alone (and its spans); placeholders stay
    in the texts as they are.
    """
    with_turns = formatted.withColumn(
        "marked", F.filter(F.split("formatted", "(?<=</turn>\n)"), lambda t: t != ""))
    # substring_index takes what precedes the first '>': roles hold none.
    turns = F.transform("marked", lambda t: F.struct(
        unescape(F.substr(F.substring_index(t, ">", 1), F.lit(7))).alias("role"),
        unescape(F.replace(F.substr(t, F.length(F.substring_index(t, ">", 1)) + 2),
                           F.lit("</turn>\n"), F.lit(""))).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substr(
        F.get("marked", s["turn_index"]),
        (s["start"] - s["turn_start"] + 1).cast("int"), s["length"].cast("int"))))
    return with_turns.select("*", turns.alias("turns"), loss.alias("loss_texts")).drop("marked")
