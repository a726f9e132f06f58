"""Chat formatting by a declarative template, with a state machine over roles and loss flags.

Everything is built-in column functions. Turns of a conversation become text segments; each segment
says whether it counts for the loss. Control strings inside texts are escaped, so the output can be
cut at control strings without ambiguity and read back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The letters that stand for control strings after the escape sign.
LETTERS = "abcdfghijklm"
ESCAPE, ESCAPED_ESCAPE, ESCAPED_BREAK = "\\", "\\e", "\\n"


@dataclass(frozen=True)
class Template:
    """Control strings, the roles whose texts count for the loss, and the allowed order of roles.

    ``order`` maps a state (the role just read, "" at the start) to the roles that may follow;
    ``final`` are the states in which a conversation may end. ``reserved`` are further strings that
    must not appear unescaped because the model's tokenizer reads them as control strings.
    """

    begin: str = "<s>"
    turn: str = "[TURN]"
    role_end: str = "[/TURN]"
    end: str = "</s>"
    reserved: tuple[str, ...] = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    loss_roles: tuple[str, ...] = ("assistant",)
    order: dict = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant",)})
    final: tuple[str, ...] = ("assistant",)

    def controls(self) -> tuple[str, ...]:
        found = tuple(dict.fromkeys((self.begin, self.turn, self.role_end, self.end, *self.reserved)))
        if len(found) > len(LETTERS) or any(not c or ESCAPE in c for c in found):
            raise ValueError("control strings must be few, not empty and free of the escape sign")
        return found


LLAMA = Template()


def escape(text: Column, template: Template) -> Column:
    """Replace the escape sign and every control string; no control string is left in the result."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPED_ESCAPE))
    for letter, control in zip(LETTERS, template.controls()):
        text = F.replace(text, F.lit(control), F.lit(ESCAPE + letter))
    return text


def unescape(text: Column, template: Template) -> Column:
    """The inverse of ``escape``; every escape sign left stands before the letter of what it replaces."""
    for letter, control in zip(LETTERS, template.controls()):
        text = F.replace(text, F.lit(ESCAPE + letter), F.lit(control))
    return F.replace(text, F.lit(ESCAPED_ESCAPE), F.lit(ESCAPE))


def valid_order(roles: Column, template: Template) -> Column:
    """Run the state machine over an array of roles; true if it ends in a final state."""

    def step(state: Column, role: Column) -> Column:
        allowed = F.lit(False)
        for before, after in template.order.items():
            allowed = allowed | ((state == before) & role.isin(*after))
        return F.when(allowed, role).otherwise("!")  # a null role is never allowed

    return F.aggregate(roles, F.lit(""), step).isin(*template.final)


def format_conversations(turns: DataFrame, template: Template = LLAMA) -> DataFrame:
    """(conv_id, n_turns, valid, segments, formatted) of every conversation.

    ``turns`` has conv_id, turn, role and text. Turns stand in the order of ``turn`` (null first), ties
    by role and text; repeated rows are kept. A null text or role is empty; rows with a null conv_id
    make one conversation. Conversations with a wrong order of roles are formatted too and have
    ``valid`` false. ``segments`` is an array of (text, loss); ``formatted`` is all segments joined. An
    empty table gives no rows; other columns are not read.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.col("role").alias("raw"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    opening = lambda t: F.concat(
        F.lit(template.turn), F.replace(escape(t["role"], template), F.lit("\n"), F.lit(ESCAPED_BREAK)), F.lit(template.role_end))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    pieces = F.flatten(F.transform("turns", lambda t: F.array(
        segment(opening(t), F.lit(False)), segment(escape(t["text"], template), t["role"].isin(*template.loss_roles)),
        segment(F.lit(template.end), F.lit(False)))))
    out = grouped.select(
        "conv_id", F.size("turns").alias("n_turns"), valid_order(F.transform("turns", lambda t: t["raw"]), template).alias("valid"),
        F.concat(F.array(segment(F.lit(template.begin), F.lit(False))), pieces).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: DataFrame, template: Template = LLAMA) -> DataFrame:
    """(conv_id, turns, loss_text) from ``formatted`` and ``segments`` alone.

    ``turns`` is an array of (role, text) found by cutting ``formatted`` at its control strings;
    ``loss_text`` is the unescaped text of the segments under the loss mask.
    """
    quote = lambda s: "\\Q" + s + "\\E"
    body = F.expr(f"substring(formatted, {len(template.begin) + 1})")
    parts = F.filter(F.split(body, quote(template.turn)), lambda p, i: i > 0)

    def turn(part: Column) -> Column:
        halves = F.split(part, quote(template.role_end))
        text = F.element_at(halves, 2)
        role = F.replace(F.element_at(halves, 1), F.lit(ESCAPED_BREAK), F.lit("\n"))
        return F.struct(unescape(role, template).alias("role"), unescape(F.split(text, quote(template.end))[0], template).alias("text"))

    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template))
    return formatted.select("conv_id", F.transform(parts, turn).alias("turns"), F.array_join(loss, "").alias("loss_text"),
                            F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def turn_digest(turns: Column) -> Column:
    """SHA-256 of role, line feed, text, line feed of every turn."""
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return F.sha2(F.array_join(lines, ""), 256)
