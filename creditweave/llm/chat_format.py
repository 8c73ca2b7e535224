"""Chat formatting by a finite-state machine over roles, with DataFrame functions only.

A template declares, for each role, the states it may follow, the header that opens its turns and
whether its text is trained on. The state of the machine is the role of the last turn. A conversation
becomes segments with a loss flag each: header, text and closing mark of every turn.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_
from string import ascii_letters

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = ""


@dataclass(frozen=True)
class Role:
    name: str
    header: str
    #: States in which a turn of this role may come: roles of the turn before, or ``START``.
    after: tuple[str, ...]
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """The marks of a format and its machine. Control strings inside texts are written with ``escape``.

    A role that is not declared is opened by ``other``, its own name and ``other_end``; it breaks the turn
    order but is formatted all the same.
    """

    roles: tuple[Role, ...]
    #: States in which a conversation may end.
    final: tuple[str, ...]
    other: str
    other_end: str
    close: str
    #: Follows ``close`` and is no control string of its own.
    gap: str = "\n"
    escape: str = "\\"

    def __post_init__(self) -> None:
        controls = self.controls
        if len(set(controls)) < len(controls) or any(not c or self.escape in c for c in controls) or len(self.escape) != 1:
            raise ValueError("control strings must differ, be filled and hold no escape character, which is one character")
        if any(b in a for a in controls for b in controls if a != b) or any(a[-n:] == b[:n] for a in controls for b in controls for n in range(1, min(len(a), len(b)))):
            raise ValueError("no control string may hold another one or end as one begins")
        if len(controls) >= len(ascii_letters):
            raise ValueError(f"at most {len(ascii_letters) - 1} control strings")

    @property
    def controls(self) -> tuple[str, ...]:
        return (*[role.header for role in self.roles], self.other, self.other_end, self.close)

    def _codes(self) -> list[tuple[str, str]]:
        """Control string to what stands for it in a text; the escape character itself comes first."""
        codes = [(control, self.escape + code) for control, code in zip(self.controls, ascii_letters[1:], strict=False)]
        return [(self.escape, self.escape + ascii_letters[0]), *codes]

    def escaped(self, text: Column) -> Column:
        """The text without any control string. Every escape character in it begins a code of two."""
        return reduce(lambda t, code: F.replace(t, F.lit(code[0]), F.lit(code[1])), self._codes(), text)

    def unescaped(self, text: Column) -> Column:
        """The inverse of :meth:`escaped`; the escape character's own code goes last."""
        return reduce(lambda t, code: F.replace(t, F.lit(code[1]), F.lit(code[0])), self._codes()[::-1], text)


TEMPLATE = ChatTemplate(
    roles=(
        Role("system", "### System: ", after=(START,)),
        Role("user", "### User: ", after=(START, "system", "assistant")),
        Role("assistant", "### Assistant: ", after=("user",), loss=True),
    ),
    final=("assistant",),
    other="### Role: ",
    other_end="</role> ",
    close="</turn>",
)


def _turn_error(template: ChatTemplate, roles: Column) -> Column:
    """What the machine says of a sequence of roles: NULL, or the first turn that it refuses."""

    def refused(role: Column, k: Column) -> Column:
        state = F.when(k == 0, F.lit(START)).otherwise(F.get(roles, k - 1))
        allowed = [(role == r.name) & state.isin(*r.after) & ((k == 0) == (state == START)) for r in template.roles]
        said = F.concat(F.lit("turn "), (k + 1).cast("string"), F.lit(": "), role, F.lit(" after "), F.when(k == 0, F.lit("start")).otherwise(state))
        return F.when(~reduce(or_, allowed), said)

    last = F.element_at(roles, -1)
    ends = F.when(~last.isin(*template.final), F.concat(F.lit("ends after "), last))
    return F.coalesce(F.get(F.filter(F.transform(roles, refused), lambda said: said.isNotNull()), F.lit(0)), ends)


def _segments(template: ChatTemplate, turns: Column) -> Column:
    def of_turn(turn: Column) -> Column:
        other = F.concat(F.lit(template.other), template.escaped(turn["role"]), F.lit(template.other_end))
        header = reduce(lambda rest, r: F.when(turn["role"] == r.name, F.lit(r.header)).otherwise(rest), template.roles, other)
        loss = turn["role"].isin(*[r.name for r in template.roles if r.loss])
        parts = ((header, F.lit(False)), (template.escaped(turn["text"]), loss), (F.lit(template.close + template.gap), F.lit(False)))
        return F.array(*[F.struct(text.alias("text"), flag.alias("loss")) for text, flag in parts])

    return F.flatten(F.transform(turns, of_turn))


def format_chats(turns: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """``conv_id, formatted, segments, error``: one row for each conversation of ``turns``.

    ``turns`` has ``conv_id, turn, role, text``; other columns, whatever their names, are left out. Turns
    are ordered by ``turn`` (null first), then role, then text; repeated rows are turns of their own. A
    null role or text is the empty one, rows with a null ``conv_id`` form one conversation, an empty table
    gives no rows. ``segments`` is an array of ``text, loss`` whose texts make up ``formatted``. ``error``
    says where the turn order is broken; such a conversation is formatted like any other. All turns of
    one conversation are one row of the result, so they must fit in 2 GB.
    """
    empty = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    grouped = turns.select("conv_id", F.struct("turn", empty("role"), empty("text")).alias("said"))
    grouped = grouped.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    done = grouped.select("conv_id", _segments(template, F.col("said")).alias("segments"), _turn_error(template, F.col("said.role")).alias("error"))
    return done.select("conv_id", F.array_join("segments.text", "").alias("formatted"), "segments", "error")


def read_turns(formatted: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """The turns of a formatted text as an array of ``role, text``, as they were before the escaping."""

    def of_chunk(chunk: Column) -> Column:
        named = F.substring(chunk, len(template.other) + 1, F.length(chunk))
        role = F.substring_index(named, template.other_end, 1)
        text = F.substring(named, F.length(role) + len(template.other_end) + 1, F.length(named))
        read = F.struct(template.unescaped(role).alias("role"), template.unescaped(text).alias("text"))
        for r in template.roles:
            rest = template.unescaped(F.substring(chunk, len(r.header) + 1, F.length(chunk)))
            read = F.when(chunk.startswith(F.lit(r.header)), F.struct(F.lit(r.name).alias("role"), rest.alias("text"))).otherwise(read)
        return read

    mark = "".join(f"\\x{{{ord(c):x}}}" for c in template.close + template.gap)
    chunks = F.split(formatted, mark, -1)
    return F.transform(F.slice(chunks, 1, F.size(chunks) - 1), of_chunk)


def read_loss(segments: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """The text under the loss mask, as it was before the escaping, nothing between its parts."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: template.unescaped(s["text"])), "")


def digests(formatted: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """Counts and digests of what is read back from the output of :func:`format_chats`."""
    read = formatted.select("conv_id", "formatted", "error", read_turns(F.col("formatted"), template).alias("read"), read_loss(F.col("segments"), template).alias("loss"))
    lines = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return read.select(
        "conv_id", F.size("read").cast("long").alias("n_turns"), sha(lines).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "error",
    )
