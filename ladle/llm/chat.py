"""Chat formatting: a state machine over roles and a declarative template, in DataFrame functions only.

Every turn becomes ``open marker, escaped text, close marker``. Escaping replaces the characters that markers are made
of, so a control string inside a text cannot be taken for a marker, and is undone exactly by :func:`read_back`.

Defined cases: a null text or role is empty; turns with equal numbers are ordered by role and text, null numbers come
first; repeated rows are repeated turns; rows without a conversation id form one conversation with a null id; roles the
template does not name get the generic marker; extra columns are ignored; an empty table gives an empty result. An
order the machine does not accept is reported (``valid``, ``first_bad_turn``), never dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Part:
    role: str
    open: str
    close: str
    loss: bool


TEMPLATE = (
    Part("system", "<<SYS>>", "<</SYS>>", False),
    Part("user", "[INST]", "[/INST]", False),
    Part("assistant", "<s>", "</s>", True),
)
#: Any other role: its escaped name stands in the open marker.
OTHER_OPEN, OTHER_END, OTHER_CLOSE = "<turn ", ">", "</turn>"
#: The first pair must be undone last.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lb;"), ("]", "&rb;"))
#: (state, role) -> state; a pair that is missing is an error.
TRANSITIONS = {
    ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
    ("user", "assistant"): "assistant", ("assistant", "user"): "user",
}


def escape(text: Column) -> Column:
    for raw, coded in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for raw, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(raw))
    return text


def _by_role(role: Column, template: tuple[Part, ...], pick, other: Column) -> Column:
    out = None
    for p in template:
        out = F.when(role == p.role, F.lit(pick(p))) if out is None else out.when(role == p.role, F.lit(pick(p)))
    return other if out is None else out.otherwise(other)


def first_bad_turn(roles: Column) -> Column:
    """Index of the first turn the machine rejects, or -1."""
    moves = F.create_map(*[F.lit(x) for (state, role), to in TRANSITIONS.items() for x in (f"{state} {role}", to)])
    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("i"), F.lit(-1).alias("bad"))

    def step(acc, role):
        to = F.element_at(moves, F.concat_ws(" ", acc["state"], role))
        return F.struct(
            F.coalesce(to, F.lit("error")).alias("state"), (acc["i"] + 1).alias("i"),
            F.when((acc["bad"] < 0) & to.isNull(), acc["i"]).otherwise(acc["bad"]).alias("bad"))

    return F.aggregate(roles, start, step, lambda acc: acc["bad"])


def format_conversations(rows: DataFrame, template: tuple[Part, ...] = TEMPLATE) -> DataFrame:
    """conv_id, n_turns, segments array<struct<text, loss>>, formatted, valid, first_bad_turn."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    turns = rows.select("conv_id", F.struct(
        F.col("turn"), role.alias("role"), escape(text).alias("body"),
        _by_role(role, template, lambda p: p.open, F.concat(F.lit(OTHER_OPEN), escape(role), F.lit(OTHER_END))).alias("open"),
        _by_role(role, template, lambda p: p.close, F.lit(OTHER_CLOSE)).alias("close"),
        _by_role(role, template, lambda p: p.loss, F.lit(False)).alias("loss")).alias("t"))
    per = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def segment(text, loss):
        return F.struct(text.alias("text"), loss.alias("loss"))

    per = per.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.flatten(F.transform("turns", lambda t: F.array(
            segment(t["open"], F.lit(False)), segment(t["body"], t["loss"]), segment(t["close"], F.lit(False))))).alias("segments"),
        first_bad_turn(F.transform("turns", lambda t: t["role"])).alias("first_bad_turn"))
    return per.select(
        "conv_id", "n_turns", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("first_bad_turn") < 0).alias("valid"), "first_bad_turn")


def read_back(formatted: Column, template: tuple[Part, ...] = TEMPLATE) -> Column:
    """Parse a formatted conversation into array<struct<role, text, loss>>."""
    marks = [f"\\Q{m}\\E" for p in template for m in (p.open, p.close)]
    pattern = "|".join([*marks, f"\\Q{OTHER_OPEN}\\E[^>]*\\Q{OTHER_END}\\E", f"\\Q{OTHER_CLOSE}\\E"])
    opens = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0))
    bodies = F.slice(F.split(formatted, pattern, -1), 2, 1 << 30)
    pairs = F.filter(F.zip_with(opens, bodies, lambda o, b: F.struct(o.alias("o"), b.alias("b"))), lambda _, i: i % 2 == 0)

    def turn(x):
        mark = x["o"]
        named = unescape(F.substr(mark, F.lit(len(OTHER_OPEN) + 1), F.length(mark) - len(OTHER_OPEN) - len(OTHER_END)))
        role, loss = named, F.lit(False)
        for p in template:
            role = F.when(mark == p.open, F.lit(p.role)).otherwise(role)
            loss = F.when(mark == p.open, F.lit(p.loss)).otherwise(loss)
        return F.struct(role.alias("role"), unescape(x["b"]).alias("text"), loss.alias("loss"))

    return F.transform(pairs, turn)


def digest(formatted: DataFrame, template: tuple[Part, ...] = TEMPLATE) -> DataFrame:
    """Per conversation, what the formatted text says when it is read back."""
    back = formatted.select("conv_id", "formatted", "valid", read_back(F.col("formatted"), template).alias("turns"))
    learn = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), said.alias("said"), learn.alias("learn"),
                       "formatted", "valid").select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("learn").cast("long").alias("loss_chars"),
        F.sha2("learn", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "valid")
