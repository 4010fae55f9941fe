"""Chat formatting by prefix-target expansion: every reply becomes an example of its own.

A conversation's turns are written one behind the other between control strings. Each assistant turn makes one example: the
text of all turns up to and with it, of which only the reply lies under the loss mask. Turns behind the last reply (or a
conversation without any) make a last example that has no target, so the examples hold every turn.

The template (its control strings are fixed values):

* system: ``[SYS] text [/SYS]``
* user: ``[INST] text [/INST]``
* assistant: ``<s>text</s>``
* any other role: ``[ROLE] role [SAYS] text [/ROLE]``

A control string inside a text or role gets a backslash behind its first character, and one that already has backslashes
there gets one more. So no text can be taken for a mark, other texts stay as they are, and ``unescape`` restores each.

Turns are dealt out by conversation once; expansion and reading back happen where they lie. An example holds its whole context
by definition, so a conversation is one row. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CONTROL = r"(/?(?:INST|SYS|ROLE|SAYS|s)[\]>])"
#: What stands before and behind the text of a role's turns (fixed values of the template).
TEMPLATE = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE] ", " [SAYS] ", " [/ROLE]")
REPLY = "assistant"
_TURN_ENDS = r"(?<=\[/SYS\]|\[/INST\]|</s>|\[/ROLE\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])(\\*)" + _CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\[<])\\(\\*)" + _CONTROL, "$1$2$3")


def format_turn(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role, F.lit("")), escape(F.coalesce(text, F.lit("")))
    other = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]), text, F.lit(OTHER[2]))
    out = None
    for name, (before, behind) in TEMPLATE.items():
        own = F.concat(F.lit(before), text, F.lit(behind))
        out = F.when(role == name, own) if out is None else out.when(role == name, own)
    return out.otherwise(other)


def _between(piece: Column, before: str, behind: str) -> Column:
    return F.substring(piece, F.lit(len(before) + 1), F.length(piece) - (len(before) + len(behind)))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted text: an array of structs ``role`` and ``text``, unescaped."""
    def turn(piece: Column) -> Column:
        inside = _between(piece, OTHER[0], OTHER[2])
        at = F.instr(inside, OTHER[1])
        role, text = F.substring(inside, F.lit(1), at - 1), F.substring(inside, at + len(OTHER[1]), F.length(inside))
        for name, marks in TEMPLATE.items():
            own = F.startswith(piece, F.lit(marks[0]))
            role, text = F.when(own, F.lit(name)).otherwise(role), F.when(own, _between(piece, *marks)).otherwise(text)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))
    return F.transform(F.filter(F.split(formatted, _TURN_ENDS), lambda p: p != ""), turn)


def _expanded(talks: DataFrame) -> DataFrame:
    """The examples of rows with ``conv_id`` and ``turns``, an array in order."""
    pieces = F.transform("turns", lambda t: format_turn(t["role"], t["text"]))
    replies = F.transform("turns", lambda t: F.coalesce(t["role"], F.lit("")) == REPLY)
    last = F.size("turns")
    numbered = talks.select("conv_id", pieces.alias("pieces"), replies.alias("replies"), last.alias("last"))
    targets = F.filter(F.sequence(F.lit(1), F.col("last")), lambda i: F.element_at("replies", i))
    rest = F.when(F.element_at("replies", -1), F.expr("cast(array() as array<int>)")).otherwise(F.array("last"))
    numbered = numbered.select("conv_id", "pieces", "replies", F.posexplode(F.concat(targets, rest)).alias("example", "n_turns"))
    text = F.array_join(F.slice("pieces", F.lit(1), F.col("n_turns")), "")
    out = numbered.select("conv_id", "example", "n_turns", text.alias("text"), F.element_at("pieces", F.col("n_turns")).alias("piece"),
                          F.element_at("replies", F.col("n_turns")).alias("reply"))
    before, behind = (len(x) for x in TEMPLATE[REPLY])
    chars = F.length("text")
    start = F.when(F.col("reply"), chars - F.length("piece") + before).otherwise(chars)
    end = F.when(F.col("reply"), chars - behind).otherwise(chars)
    return out.select("conv_id", "example", "n_turns", "text", start.alias("loss_start"), end.alias("loss_end"))


def _talks(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Conversations with their turns in order; those of rows without an id, one row each, apart."""
    row = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = turns.select(F.col(conv_col).alias("conv_id"), row.alias("row"))
    known = rows.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    return known, rows.where("conv_id is null").select("conv_id", F.array("row").alias("turns"))


def prefix_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """``conv_id``, ``example`` (from 0), ``n_turns``, ``text`` and the mask ``loss_start`` to ``loss_end`` (code points, from 0; the end is
    outside): one row for each assistant turn, and one with an empty mask for turns behind the last of them.

    Turns follow their number; null numbers come first, equal numbers follow role and text, and repeated rows are turns
    of their own. A null text or role is empty, an empty or unknown role keeps its name. A row without a conversation
    id is a conversation of one turn. An empty table has no examples. Other columns aren't read.
    """
    known, lone = _talks(turns, conv_col, turn_col, role_col, text_col)
    return _expanded(known).unionByName(_expanded(lone))


def _target() -> Column:
    """The text under an example's mask, unescaped."""
    return unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))


def _digested(whole: DataFrame) -> DataFrame:
    """Digests of conversations with ``text`` (all turns), ``loss`` and ``formatted_chars``."""
    read = whole.select("conv_id", parse_turns(F.col("text")).alias("read"), "loss", "formatted_chars")
    lines = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("read").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.col("formatted_chars").cast("long").alias("formatted_chars"))


def read_back(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """What the examples of each conversation hold, read from their texts and masks alone: ``conv_id``, ``n_turns``, ``turns_sha256``
    (of the role, a line feed, the text and a line feed of each turn of the longest example), ``loss_chars`` and ``loss_sha256`` (of
    all text under the masks, in order) and ``formatted_chars`` (of all examples). Cases as in ``prefix_examples``."""
    known, lone = _talks(turns, conv_col, turn_col, role_col, text_col)
    found = _expanded(known).withColumn("target", _target()).withColumn("chars", F.length("text").cast("long"))
    loss = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "target"))), lambda t: t["target"]), "")
    whole = found.groupBy("conv_id").agg(F.max_by("text", "example").alias("text"), loss.alias("loss"), F.sum("chars").alias("formatted_chars"))
    single = _expanded(lone).select("conv_id", "text", _target().alias("loss"), F.length("text").alias("formatted_chars"))
    return _digested(whole).unionByName(_digested(single))
