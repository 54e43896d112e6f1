"""Chat formatting (built-in functions only): a state machine over roles and a declarative template.

A template names, per role, the text that opens a turn and whether its text counts for the loss, one
text that closes a turn, and the escape sign. Control texts inside a turn are escaped by putting the
sign behind their first character, after doubling every sign, so an escaped text holds no control
text and ``parse_chat`` can cut at them and undo the rest: sign plus character gives the character.

The machine runs along the turns of a conversation (``lag`` of the role): each turn carries ``ok``, true
when its role may follow the one before. A conversation is ``valid`` when all its turns are and it
ends in a final state. Invalid ones are formatted all the same and flagged.

Defined cases: turns come by turn number, null last, then role, then text, so ties have one order and
repeated rows all stay; null text or role is an empty text; a role that the template does not name
opens with ``other`` and its own name, no loss; a null conversation id is one conversation; an empty
table gives no rows; further columns are ignored. A formatted conversation is one value, so one
conversation must fit a row (2 GB), and nothing else has to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

TEMPLATE = {
    "roles": {
        "system": {"open": "### System: ", "loss": False},
        "user": {"open": "### User: ", "loss": False},
        "assistant": {"open": "### Assistant: ", "loss": True},
    },
    "other": "### Role ",
    "other_end": ": ",
    "close": "</turn>\n",
    "escape": "\\",
    "control": ["### ", "</turn>"],
}

#: Which role may follow which; None is the begin.
TRANSITIONS = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
FINAL = ("assistant",)


def escape(text: Column, template: dict = TEMPLATE, also: tuple[str, ...] = ()) -> Column:
    sign = template["escape"]
    out = F.replace(text, F.lit(sign), F.lit(sign * 2))
    for word in [*template["control"], *also]:
        out = F.replace(out, F.lit(word), F.lit(word[0] + sign + word[1:]))
    return out


def unescape(text: Column, template: dict = TEMPLATE) -> Column:
    sign = "\\" + template["escape"]
    return F.regexp_replace(text, f"(?s){sign}(.)", "$1")


def check_turns(rows: DataFrame, transitions: dict = TRANSITIONS) -> DataFrame:
    """Adds ``pos`` (from 1) and ``ok``: whether the role may stand where it does."""
    order = [F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    w = Window.partitionBy("conv_id").orderBy(*order)
    allowed = F.lit(False)
    for before, after in transitions.items():
        came = F.col("_before").isNull() if before is None else F.col("_before") == before
        allowed = allowed | (came & F.col("role").isin(*after))
    return rows.withColumn("_before", F.lag("role").over(w)).withColumn("pos", F.row_number().over(w)).withColumn(
        "ok", F.coalesce(allowed, F.lit(False))
    ).drop("_before")


def format_chat(conversations: DataFrame, template: dict = TEMPLATE, transitions: dict = TRANSITIONS,
                final: tuple[str, ...] = FINAL) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, segments, valid``.

    ``segments`` are the pieces of ``formatted`` in order: ``start`` and ``length`` in code points (from 0), the
    role, and ``loss``. Openings and closings are segments without loss.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    other_end = template["other_end"]
    opening = F.concat(F.lit(template["other"]), escape(F.col("role"), template, (other_end,)), F.lit(other_end))
    loss = F.lit(False)
    for role, rule in template["roles"].items():
        opening = F.when(F.col("role") == role, F.lit(rule["open"])).otherwise(opening)
        loss = F.when(F.col("role") == role, F.lit(rule["loss"])).otherwise(loss)
    close = template["close"]
    checked = check_turns(rows, transitions).withColumns(
        {"loss": loss, "head": opening, "body": escape(F.col("text"), template)}
    ).withColumn("n", F.length("head") + F.length("body") + F.lit(len(close)))
    so_far = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    turns = checked.withColumn("start", (F.sum("n").over(so_far) - F.col("n")).cast("int")).select(
        "conv_id", F.struct("pos", "start", "role", "ok", "loss", "head", "body").alias("t")
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))

    def pieces(x: Column) -> Column:
        def piece(start: Column, length: Column, counts: Column) -> Column:
            return F.struct(start.alias("start"), length.alias("length"), x["role"].alias("role"), counts.alias("loss"))

        head, body = F.length(x["head"]), F.length(x["body"])
        return F.array(
            piece(x["start"], head, F.lit(False)),
            piece(x["start"] + head, body, x["loss"]),
            piece(x["start"] + head + body, F.lit(len(close)), F.lit(False)),
        )

    return grouped.select(
        "conv_id",
        F.concat_ws("", F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(close)))).alias("formatted"),
        F.flatten(F.transform("t", pieces)).alias("segments"),
        (F.forall("t", lambda x: x["ok"]) & F.element_at("t", -1)["role"].isin(*final)).alias("valid"),
    )


def parse_chat(formatted: Column, template: dict = TEMPLATE) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    parts = F.split(formatted, "\\Q" + template["close"] + "\\E")
    parts = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    other, end = template["other"], template["other_end"]

    def turn(x: Column) -> Column:
        rest = F.substring(x, F.lit(len(other) + 1), F.length(x))
        cut = F.locate(end, rest)
        role = F.when(F.startswith(x, F.lit(other)), unescape(F.substring(rest, F.lit(1), cut - 1), template))
        body = F.when(F.startswith(x, F.lit(other)), F.substring(rest, cut + len(end), F.length(rest)))
        for name, rule in template["roles"].items():
            here = F.startswith(x, F.lit(rule["open"]))
            role = F.when(here, F.lit(name)).otherwise(role)
            body = F.when(here, F.substring(x, F.lit(len(rule["open"]) + 1), F.length(x))).otherwise(body)
        return F.struct(role.alias("role"), unescape(body, template).alias("text"))

    return F.transform(parts, turn)


def loss_text(turns: Column, segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between.

    ``turns`` are those of ``parse_chat``; the body of turn i is segment 3 i + 1.
    """
    under = F.filter(turns, lambda t, i: F.get(segments, i * 3 + 1)["loss"])
    return F.concat_ws("", F.transform(under, lambda t: t["text"]))
