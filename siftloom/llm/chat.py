"""Chat formatting from a declarative template, with a finite-state machine over roles. DataFrame functions only.

A formatted conversation is a list of segments, each with a loss flag; their texts joined are the training string.
Control strings inside texts and roles get one backslash more between ``<`` and ``|``, so that markers only stand
where the template put them, and texts come back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = 0
INVALID = -1


@dataclass(frozen=True)
class Template:
    """Markers around turns, the roles whose texts are learned, and the allowed steps between states.

    States: 0 before the first turn, then one number per role. ``steps`` maps (state, role) to the next state; anything
    else is invalid and stays so. ``final`` are the states in which a conversation may end.
    """

    turn: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    steps: dict[tuple[int, str], int] = field(default_factory=lambda: {
        (START, "system"): 1, (START, "user"): 2, (1, "user"): 2, (2, "assistant"): 3, (3, "user"): 2})
    final: tuple[int, ...] = (3,)


CHATML = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def _escape_role(role: Column) -> Column:
    """A role is one line: its line ends and percent signs are written as in URLs."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_conversations(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Rows (``conv_id``, ``turn``, ``role``, ``text``) to one row per conversation: ``conv_id``, ``n_turns``, ``valid``,
    ``segments`` (array of ``text``, ``loss``), ``formatted``.

    Turns are ordered by ``turn`` (null first); equal numbers by role, then text. Null texts and roles are empty; a
    null ``conv_id`` is a conversation of its own. Repeated rows are turns of their own. ``valid`` tells whether the
    roles follow the machine to a final state; conversations that do not are formatted all the same. Other columns are
    not read. A conversation is one training string, so its turns meet in one row; different conversations are
    spread by hash. An empty table gives no rows.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    steps = F.create_map(*[F.lit(x) for (state, role), to in sorted(template.steps.items()) for x in (f"{state} {role}", to)])

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def segments(t: Column) -> Column:
        return F.array(segment(F.concat(F.lit(template.turn), _escape_role(t["role"]), F.lit(template.after_role)), F.lit(False)),
                       segment(escape(t["text"]), t["role"].isin(*template.learned)),
                       segment(F.lit(template.end), F.lit(False)))

    state = F.aggregate("turns", F.lit(START), lambda now, t: F.coalesce(steps[F.concat(now.cast("string"), F.lit(" "), t["role"])], F.lit(INVALID)))
    return convs.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), state.isin(*template.final).alias("valid"),
                        F.flatten(F.transform("turns", segments)).alias("segments")) \
        .withColumn("formatted", F.concat_ws("", F.transform("segments", lambda s: s["text"])))


def read_back(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """``conv_id``, ``turns`` (array of ``role``, ``text``) from the string, and ``learned``, the texts under the loss mask."""
    def turn(part: Column) -> Column:
        at = F.locate(template.after_role, part)
        return F.struct(_unescape_role(F.substring(part, F.lit(1), at - 1)).alias("role"),
                        unescape(F.substring(part, at + len(template.after_role), F.length(part) - at - len(template.after_role) - len(template.end) + 1)).alias("text"))

    parts = F.split("formatted", F.lit(_quoted(template.turn)))
    return formatted.select(
        "conv_id", F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn).alias("turns"),
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])).alias("learned"), "formatted")


def _quoted(marker: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != "_" else c for c in marker)
