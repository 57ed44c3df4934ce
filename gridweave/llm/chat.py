"""Chat formatting: a finite-state machine over roles, and segments with loss flags from a declarative template."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What stands around a turn, which roles are learnt, and which role may follow which.

    A turn is ``head + role name + colon + text + end``. ``escapes`` maps each control string to its escape, the backslash last: it is
    escaped first and read back last, so every backslash in escaped text begins an escape. ``head`` and ``end`` hold a control string
    and escaped text holds none, so no text can be taken for them. ``names`` gives a role's name in the output; any other role keeps its
    own, escaped, with its colons escaped too, and marked where it is the name of another.
    ``moves`` lists for each state (the role before, empty at the start) the roles that may come next.
    """

    head: str = "### "
    colon: str = ": "
    end: str = " </turn>\n"
    escapes: tuple[tuple[str, str], ...] = (("###", "\\h"), ("</turn>", "\\e"), ("\\", "\\s"))
    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    learnt: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)

    def escape(self, text: Column) -> Column:
        for raw, safe in reversed(self.escapes):
            text = F.replace(text, F.lit(raw), F.lit(safe))
        return text

    def unescape(self, text: Column) -> Column:
        for raw, safe in self.escapes:
            text = F.replace(text, F.lit(safe), F.lit(raw))
        return text

    def name(self, role: Column) -> Column:
        own = F.replace(self.escape(role), F.lit(":"), F.lit("\\c"))
        out = F.when(own.isin(*self.names.values()), F.concat(F.lit("\\r"), own)).otherwise(own) if self.names else own
        for key, value in self.names.items():
            out = F.when(role == key, F.lit(value)).otherwise(out)
        return out

    def role(self, name: Column) -> Column:
        own = F.when(name.startswith("\\r"), F.substr(name, F.lit(3))).otherwise(name)
        out = self.unescape(F.replace(own, F.lit("\\c"), F.lit(":")))
        for key, value in self.names.items():
            out = F.when(name == value, F.lit(key)).otherwise(out)
        return out


def conversations(turns: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: the id and ``turns``, an array of (turn, role, text) in order; null role and text are empty.

    Turns with equal numbers are ordered by role and text, null numbers come first. A conversation is one row of the result, so
    its turns meet in one task; its size, not the table's, bounds the memory.
    """
    turn = F.struct(F.col(order_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    return turns.groupBy(id_col).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def first_fault(turns: Column, template: Template) -> Column:
    """Place of the first turn whose role may not follow the state before it; the number of turns if the end is missing; else null."""
    moves = F.create_map(*[F.lit(x) for state, roles in template.moves.items() for x in (state, ",".join(roles))])
    known = F.array(*[F.lit(x) for x in template.moves])
    allowed = lambda state, role: (F.array_contains(known, state) & (role != "") & F.array_contains(F.split(F.try_element_at(moves, state), ","), role))
    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("fault"))
    step = lambda acc, t: F.struct(
        t["role"].alias("state"),
        (acc["at"] + 1).alias("at"),
        F.coalesce(acc["fault"], F.when(F.coalesce(allowed(acc["state"], t["role"]), F.lit(False)), F.lit(None).cast("int")).otherwise(acc["at"])).alias("fault"),
    )
    finish = lambda acc: F.coalesce(acc["fault"], F.when(~acc["state"].isin(*template.final), acc["at"]))
    return F.aggregate(turns, start, step, finish)


def segments(turns: Column, template: Template) -> Column:
    """Array of (text, loss): for each turn its head, its escaped text, flagged if its role is learnt, and its end."""
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    return F.flatten(
        F.transform(
            turns,
            lambda t: F.array(
                part(F.concat(F.lit(template.head), template.name(t["role"]), F.lit(template.colon)), no),
                part(template.escape(t["text"]), t["role"].isin(*template.learnt)),
                part(F.lit(template.end), no),
            ),
        )
    )


def parsed(formatted: Column, template: Template) -> Column:
    """Array of (role, text) read back from formatted text."""
    turns = F.filter(F.split(formatted, F.lit("\\Q" + template.end + "\\E"), F.lit(-1)), lambda t: t.startswith(template.head))
    body = lambda t: F.substr(t, F.lit(len(template.head) + 1))
    cut = lambda t: F.instr(body(t), template.colon)
    return F.transform(
        turns,
        lambda t: F.struct(
            template.role(F.substr(body(t), F.lit(1), cut(t) - 1)).alias("role"),
            template.unescape(F.substr(body(t), cut(t) + len(template.colon))).alias("text"),
        ),
    )


def formatted(turns: DataFrame, template: Template = Template(), id_col: str = "conv_id", **columns: str) -> DataFrame:
    """One row per conversation: the id, ``formatted`` text, its ``segments`` (text and loss flag), ``valid`` and ``fault``.

    Every conversation is formatted; ``fault`` is the place of the first turn that breaks the order of roles (``valid`` is then false).
    Null roles and texts are empty, an empty role never fits; a null id is one conversation; repeated turns are turns of their
    own; no rows give no rows; other columns are ignored. Only built-in functions are used.
    """
    parts = conversations(turns, id_col, **columns).withColumn("segments", segments(F.col("turns"), template))
    return parts.select(
        id_col,
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        first_fault(F.col("turns"), template).alias("fault"),
    ).withColumn("valid", F.col("fault").isNull())


def digests(out: DataFrame, template: Template = Template(), id_col: str = "conv_id") -> DataFrame:
    """What is read back from ``formatted``'s output: turns, their digest, and the learnt text by the segments' flags."""
    read = out.withColumn("turns", parsed(F.col("formatted"), template)).withColumn(
        "loss", template.unescape(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), ""))
    )
    return read.select(
        id_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )
