"""Chat formatting: records of many layouts to canonical turns, to one templated string with a loss mask.

Schema fingerprinting: the nested field paths that hold a value in a record (``prompt``,
``messages[].role``) are hashed; a table of fingerprints selects the declarative mapping
that turns the record into canonical turns of (role, text). A mapping is data: the paths
it requires, those it may have, and where its turns stand. Records arrive as Spark reads
heterogeneous data, in typed columns of which each record fills those of its layout;
columns that no mapping names are ignored, so clashing and extra columns do no harm.

The template marks each turn by the markers of its role; other roles than system,
user and assistant are named inside a marker. Wherever a text holds a control string, a
backslash is put behind its first character (and one more where backslashes stand
there already), so no text can end its turn or open another, and reading back
removes exactly what was added. All of it is SQL functions on rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

TURN = "array<struct<role:string,text:string>>"
_LAYOUT, _TURNS = "_tf_layout", "_tf_turns"


@dataclass(frozen=True)
class Said:
    """One turn: the non-empty texts of these paths, a blank line between them; no turn if all are empty."""

    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Listed:
    """One turn for each element of an array; ``parts`` names a text field inside an array-valued text."""

    path: str
    role: str
    text: str
    parts: str | None = None


@dataclass(frozen=True)
class Alternating:
    """An array of texts, or of arrays of texts: user and assistant in turn."""

    path: str


@dataclass(frozen=True)
class Layout:
    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    turns: tuple[Said | Listed | Alternating, ...]


def _asked(name: str, question: tuple[str, ...], answer: str, optional: tuple[str, ...] = ()) -> Layout:
    """A single question and its answer, with an optional system text."""
    own = tuple(p for p in question if p not in optional)
    said = (Said("system", ("system",)), Said("user", question), Said("assistant", (answer,)))
    return Layout(name, (*own, answer), ("system", *optional), said)


LAYOUTS = (
    Layout("messages", ("messages[].role",), ("messages[].content",), (Listed("messages", "role", "content"),)),
    Layout("message_parts", ("messages[].role",), ("messages[].content[].text", "messages[].content[].type"), (Listed("messages", "role", "content", "text"),)),
    Layout("turns", ("turns[].role",), ("turns[].text",), (Listed("turns", "role", "text"),)),
    Layout("conversations", ("conversations[].from",), ("conversations[].value",), (Listed("conversations", "from", "value"),)),
    Layout("prompt_messages", ("prompt[].role", "completion[].role"), ("prompt[].content", "completion[].content"), (Listed("prompt", "role", "content"), Listed("completion", "role", "content"))),
    _asked("instruction", ("instruction", "input"), "output", optional=("input",)),
    _asked("instruction_response", ("instruction", "context"), "response", optional=("context",)),
    Layout(
        "instruction_history",
        ("instruction", "output", "history[]"),
        ("system", "input"),
        (Said("system", ("system",)), Alternating("history"), Said("user", ("instruction", "input")), Said("assistant", ("output",))),
    ),
    _asked("prompt_completion", ("prompt",), "completion"),
    _asked("prompt_response", ("prompt",), "response"),
    _asked("question_answer", ("question", "context"), "answer", optional=("context",)),
    _asked("query_response", ("query",), "response"),
    Layout("dialog", ("dialog[]",), (), (Alternating("dialog"),)),
)

# Names of roles in other layouts (fixed values).
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "instruction": "system"}


def fingerprint_of(paths: Sequence[str]) -> str:
    """The hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def fingerprints(layouts: Sequence[Layout] = LAYOUTS) -> dict[str, str]:
    """Fingerprint to layout name: each layout with every choice of its optional paths."""
    known: dict[str, str] = {}
    for layout in layouts:
        for k in range(len(layout.optional) + 1):
            for more in combinations(layout.optional, k):
                key = fingerprint_of([*layout.required, *more])
                # The first layout of the list wins where two have the same paths.
                known.setdefault(key, layout.name)
    return known


def _leaves(name: str, kind: DataType) -> list[str]:
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in _leaves(f"{name}.{f.name}", f.dataType)]
    if isinstance(kind, ArrayType):
        inner = kind.elementType
        if isinstance(inner, StructType):
            return [p for f in inner.fields for p in _leaves(f"{name}[].{f.name}", f.dataType)]
        return _leaves(f"{name}[]", inner) if isinstance(inner, ArrayType) else [f"{name}[]"]
    return [name]


def field_paths(schema: StructType) -> list[str]:
    """Nested field paths of a schema: dots for structs, [] for arrays."""
    return [p for f in schema.fields for p in _leaves(f.name, f.dataType)]


def _filled(value: Column, path: str) -> Column:
    """Whether a record holds a value at a path."""
    here, more, rest = path.partition("[]")
    for part in here.split("."):
        value = value[part] if part else value
    if not more:
        return value.isNotNull()
    if not rest:
        return F.coalesce(F.size(value) > 0, F.lit(False))
    return F.coalesce(F.exists(value, lambda x: _filled(x, rest)), F.lit(False))


def _present(path: str) -> Column:
    head = re.split(r"[.\[]", path)[0]
    return _filled(F.col(head), path[len(head) :])


def _named_paths(schema: StructType, layouts: Sequence[Layout]) -> list[str]:
    """Paths of a schema, in order, that some layout names; arrays of arrays of text count by their outer array."""
    named = {p for layout in layouts for p in (*layout.required, *layout.optional)}
    found = {re.sub(r"\[\]\[\]$", "[]", p) for p in field_paths(schema)}
    return sorted(found & named)


def fingerprint(schema: StructType, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Hash of the named paths at which a record holds a value."""
    paths = [F.when(_present(p), F.lit(p)) for p in _named_paths(schema, layouts)]
    return F.sha2(F.array_join(F.array(*paths, F.lit(None).cast("string")), "\n"), 256)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _type_at(schema: StructType, path: str) -> DataType | None:
    kind: DataType = schema
    for part in path.split("."):
        if not isinstance(kind, StructType) or part not in kind.names:
            return None
        kind = kind[part].dataType
    return kind


def _turns_of(schema: StructType, step: Said | Listed | Alternating) -> Column | None:
    """The turns of one step of a mapping, or None where the columns are not there."""
    empty = F.lit([]).cast(TURN)
    if isinstance(step, Said):
        texts = [F.col(p) for p in step.paths if isinstance(_type_at(schema, p), StringType)]
        if not texts:
            return empty
        text = F.array_join(F.filter(F.array(*texts), lambda x: x != ""), "\n\n")
        return F.when(text != "", F.array(_turn(F.lit(step.role), text))).otherwise(empty)
    kind = _type_at(schema, step.path)
    if not isinstance(kind, ArrayType):
        return None
    items = F.col(step.path)
    if isinstance(step, Alternating):
        texts = F.flatten(items) if isinstance(kind.elementType, ArrayType) else items
        return F.transform(texts, lambda x, i: _turn(F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")), x))
    inner = kind.elementType
    if not isinstance(inner, StructType) or step.role not in inner.names:
        return None
    body = inner[step.text].dataType if step.text in inner.names else None
    if body is not None and isinstance(body, ArrayType) != (step.parts is not None):
        return None
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])

    def turn(x: Column) -> Column:
        role = x[step.role]
        if step.role == "from":
            role = F.coalesce(names[role], role)
        if body is None:
            return _turn(role, F.lit(""))
        text = x[step.text]
        return _turn(role, F.array_join(F.transform(text, lambda part: part[step.parts]), "") if step.parts else text)

    return F.transform(items, turn)


def canonical_turns(
    records: DataFrame, *, layouts: Sequence[Layout] = LAYOUTS, layout_col: str = "layout", turns_col: str = "chat"
) -> DataFrame:
    """The records with the name of their layout and their turns, array<struct<role, text>>.

    Null texts and roles read as empty. A record whose fingerprint no layout has keeps
    its row with null layout and turns; so does one without any value. Equal records
    stay apart, an empty table gives no rows. Columns of the output's names, in any
    case, are replaced.
    """
    built = {}
    for layout in layouts:
        steps = [_turns_of(records.schema, step) for step in layout.turns]
        if all(step is not None for step in steps):
            built[layout.name] = F.concat(*[F.coalesce(step, F.lit([]).cast(TURN)) for step in steps])
    # Only layouts whose columns have the types their mapping reads are in the table.
    known = fingerprints([layout for layout in layouts if layout.name in built])
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURN)
    if known:
        name = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])[fingerprint(records.schema, layouts)]
    marked = records.withColumn(_LAYOUT, name)
    for layout, column in built.items():
        turns = F.when(F.col(_LAYOUT) == layout, column).otherwise(turns)
    kept = [c for c in records.columns if c.lower() not in (layout_col.lower(), turns_col.lower())]
    return marked.withColumn(_TURNS, turns).select(*kept, F.col(_LAYOUT).alias(layout_col), F.col(_TURNS).alias(turns_col))


# ------------------------------------------------------------------ template

# Markers of a turn by its role; (opening, closing) of other roles hold the role's name and a line break (fixed values).
MARKERS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]")
LOSS_ROLE = "assistant"

# The first character of a control string, whatever backslashes follow it.
_OPENS = r"(<(?=\\{n}/?s>)|\[(?=\\{n}/?(?:SYS|INST|ROLE)\]))"
_ONE_TURN = r"(?s)\[SYS\] .*? \[/SYS\]|\[INST\] .*? \[/INST\]|<s>.*?</s>|\[ROLE\].*?\[/ROLE\]"


def escaped(text: Column) -> Column:
    """A backslash more behind the first character of each control string."""
    return F.regexp_replace(text, _OPENS.replace("{n}", "*"), r"$1\\")


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``."""
    return F.regexp_replace(text, _OPENS.replace("{n}", "+") + r"\\", "$1")


def _name_of(role: Column) -> Column:
    """A role's name on one line, control strings escaped."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_of(name: Column) -> Column:
    """The inverse of ``_name_of``: doubled backslashes are one, a single one stands before n."""
    parts = F.split(unescaped(name), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def _by_role(role: Column, side: int, other: Column) -> Column:
    out = other
    for name, markers in MARKERS.items():
        out = F.when(role == name, F.lit(markers[side])).otherwise(out)
    return out


def formatted_chats(
    records: DataFrame, *, turns_col: str = "chat", text_col: str = "formatted", segments_col: str = "segments"
) -> DataFrame:
    """The records with their templated string and its loss mask.

    ``segments_col`` is array<struct<text, loss>>: the string cut at every change of the
    mask, in order; joined, the texts are the string. Only texts of assistant turns are
    under the mask, empty ones too. Null turns give nulls, no turns an empty string.
    """

    def parts(turn: Column) -> Column:
        role = turn["role"]
        opening = _by_role(role, 0, F.concat(F.lit(OTHER[0]), _name_of(role), F.lit("\n")))
        pieces = [(opening, F.lit(False)), (escaped(turn["text"]), role == LOSS_ROLE), (_by_role(role, 1, F.lit(OTHER[1])), F.lit(False))]
        return F.array(*[F.struct(text.alias("text"), loss.alias("loss")) for text, loss in pieces])

    cut = records.withColumn(segments_col, F.flatten(F.transform(turns_col, parts)))
    return cut.withColumn(text_col, F.array_join(F.transform(segments_col, lambda s: s["text"]), ""))


def read_turns(formatted: Column) -> Column:
    """The turns of a templated string, as they went in."""

    def turn(whole: Column) -> Column:
        role, text = F.lit(None).cast("string"), F.lit(None).cast("string")
        head = F.substring_index(whole, "\n", 1)
        size = F.length(whole)
        body = F.substring(whole, F.length(head) + 2, size - F.length(head) - 1 - len(OTHER[1]))
        role, text = _role_of(F.substring(head, F.lit(len(OTHER[0]) + 1), F.length(head))), body
        for name, (opening, closing) in MARKERS.items():
            mine = whole.startswith(opening)
            role = F.when(mine, F.lit(name)).otherwise(role)
            text = F.when(mine, F.substring(whole, F.lit(len(opening) + 1), size - len(opening) - len(closing))).otherwise(text)
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(_ONE_TURN), F.lit(0)), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def from_turn_rows(rows: DataFrame, keys: Sequence[str], *, order_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows of single turns as one record a conversation: keys and ``turns``, ordered by turn.

    Turns of equal number, or of none (these come first), go by role and text. A
    conversation becomes one string, so it is one row, whatever its length.
    """
    turn = F.struct(
        F.col(order_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
