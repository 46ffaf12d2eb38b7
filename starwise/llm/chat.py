"""Chat formatting: a finite-state machine over roles and a declarative template."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, REFUSED = "start", "!"


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around a turn, the roles whose texts are learned from, and the allowed turn order.

    A turn is written as ``begin`` role ``head_end`` text ``end`` ``turn_end``. Inside of texts
    and roles a backslash is put into every ``<|`` (and one more into ``<\\|``, and so on), so no
    text can hold a mark, and reading back takes that backslash out again.
    """

    begin: str = "<|im_start|>"
    head_end: str = "\n"
    end: str = "<|im_end|>"
    turn_end: str = "\n"
    line_mark: str = "<|nl|>"  # a line end inside of a role
    learned: tuple[str, ...] = ("assistant",)
    order: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")

    def write_role(self, role: Column) -> Column:
        return F.replace(self.escape(role), F.lit("\n"), F.lit(self.line_mark))

    def read_role(self, role: Column) -> Column:
        return self.unescape(F.replace(role, F.lit(self.line_mark), F.lit("\n")))


def _literal_map(pairs: list[tuple[str, str]]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs for x in pair))


def _run_machine(turns: Column, template: ChatTemplate) -> Column:
    """State after the last turn, and ``trace``: what the state after each turn emits, a letter per turn.

    A state is the role of the last turn. A role that the order does not allow there leads to that
    role's refused state (marked ``!``), from which only refused states follow: the flags go on and
    the conversation stays refused. A state emits ``L`` if its text is learned from, else ``-``.
    """
    arcs = _literal_map([(f"{state}>{role}", role) for state, roles in template.order.items() for role in roles])
    emits = _literal_map([(mark + role, "L") for role in template.learned for mark in ("", REFUSED)])

    def step(at: Column, turn: Column) -> Column:
        allowed = F.try_element_at(arcs, F.concat(at["state"], F.lit(">"), turn["role"]))
        state = F.coalesce(allowed, F.concat(F.lit(REFUSED), turn["role"]))
        letter = F.coalesce(F.try_element_at(emits, state), F.lit("-"))
        return F.struct(state.alias("state"), F.concat(at["trace"], letter).alias("trace"))

    return F.aggregate(turns, F.struct(F.lit(START).alias("state"), F.lit("").alias("trace")), step)


def format_chats(rows: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation: ``n_turns``, ``valid``, ``segments`` and ``formatted``.

    ``rows`` has ``conv_id``, ``turn``, ``role`` and ``text``. ``segments`` are (text, loss) pieces
    in order, a text's flag is what the machine emits at its turn; ``formatted`` is their
    concatenation. ``valid`` tells whether the machine accepts the order of the roles; a
    conversation it refuses is formatted all the same, with its flags. Null texts and
    roles are empty, a null turn comes first, equal turns are ordered by role and text, repeated
    rows are repeated turns, rows with a null ``conv_id`` make up one conversation. A conversation
    is one row of the result, so it is brought together whole.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    ran = chats.withColumn("ran", _run_machine(F.col("turns"), template))

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    segments = F.flatten(
        F.transform(
            "turns",
            lambda t, n: F.array(
                piece(F.concat(F.lit(template.begin), template.write_role(t["role"]), F.lit(template.head_end)), F.lit(False)),
                piece(template.escape(t["text"]), F.substring(F.col("ran.trace"), n + 1, F.lit(1)) == "L"),
                piece(F.lit(template.end + template.turn_end), F.lit(False)),
            ),
        )
    )
    valid = ~F.startswith(F.col("ran.state"), F.lit(REFUSED))
    made = ran.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), valid.alias("valid"), segments.alias("segments"))
    return made.withColumn("formatted", F.array_join("segments.text", ""))


def read_back(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """Turns (role, text) of a formatted conversation, escapes undone."""
    parts = F.filter(F.split(formatted, "\\Q" + template.begin + "\\E"), lambda p, n: n > 0)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, template.head_end, 1)
        rest = F.substring(part, F.char_length(role) + 1 + len(template.head_end), F.char_length(part))
        text = F.substring_index(rest, template.end, 1)
        return F.struct(template.read_role(role).alias("role"), template.unescape(text).alias("text"))

    return F.transform(parts, turn)


def loss_text(segments: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """All text under the loss mask, escapes undone segment by segment."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")
