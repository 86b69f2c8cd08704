"""Chat formatting: records of any known layout become canonical turns, then
one text with control strings and a loss mask.  DataFrame functions only.

A record's schema is what it holds: the nested field paths that have a value
in that row (``messages[].role``; one element with a value is enough).  The
paths that some mapping names are sorted and hashed; the hash is the record's
``fingerprint`` and selects the declarative mapping (``LAYOUTS``).  Paths that
no mapping names, such as ids or metadata, do not change it.

``gather`` first turns a table of one row per turn into records.  ``canonical``
adds the fingerprint, the layout's name and the turns (role, text).  ``render``
writes them by a template: ``segments`` are pieces of the text with a flag
``loss`` (the trained roles' texts, nothing else) and ``formatted`` is their
concatenation.  ``parse`` and ``loss_text`` read both back.

Inside a text the opening of a control string cannot occur: ``<``, any
backslashes, ``|`` get one more backslash, which ``parse`` takes away.  All
other text is left as it is.

Defined results: a record whose fingerprint selects no mapping keeps NULL
layout and turns, and NULL text; a NULL text or role in a list of turns is
empty; a field that is NULL gives no turn; a record without turns is the
empty text; no rows give no rows; rows of one turn number are ordered by role
and text; a NULL id is a conversation like another.  One conversation is one
value, as its text is in the output: it must fit Spark's 2 GB for a value.
Other columns pass through; names that the functions add must be free.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Seed of Spark's xxhash64.
_SEED = 42
_TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Messages:
    """A list of turns at ``path`` with fields ``role`` and ``text``; roles
    renamed by ``renames``; an optional field ``system`` leads."""

    name: str
    path: str
    role: str
    text: str
    renames: tuple[tuple[str, str], ...] = ()
    system: str | None = "system"

    def required(self) -> tuple[str, ...]:
        return f"{self.path}[].{self.role}", f"{self.path}[].{self.text}"

    def optional(self) -> tuple[str, ...]:
        return (self.system,) if self.system else ()


@dataclass(frozen=True)
class Fields:
    """One turn for each (role, fields), the fields' texts joined by a blank line."""

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...]
    may_lack: tuple[str, ...] = ()

    def required(self) -> tuple[str, ...]:
        return tuple(p for _, paths in self.turns for p in paths if p not in self.may_lack)

    def optional(self) -> tuple[str, ...]:
        return self.may_lack


# Usual layouts of instruction and chat data.
_SPEAKERS = (("human", "user"), ("prompter", "user"), ("gpt", "assistant"), ("bot", "assistant"),
             ("chatgpt", "assistant"), ("model", "assistant"))
LAYOUTS: tuple[Messages | Fields, ...] = (
    Messages("rows", "rows", "role", "text", system=None),
    Messages("messages", "messages", "role", "content"),
    Messages("speakers", "conversations", "from", "value", _SPEAKERS),
    Messages("dialogue", "dialogue", "speaker", "utterance", _SPEAKERS),
    Fields("instruction", (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
           ("system", "input")),
    Fields("completion", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), ("system",)),
    Fields("response", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), ("system",)),
    Fields("question", (("system", ("system",)), ("user", ("context", "question")), ("assistant", ("answer",))),
           ("system", "context")),
)


@dataclass(frozen=True)
class Template:
    """``start`` role ``gap`` text ``end``; both control strings begin with ``<|``."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    gap: str = "\n"
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if not (self.start.startswith("<|") and self.end.startswith("<|")) or self.start == self.end:
            raise ValueError("control strings begin with <| and differ")
        if self.gap != "\n":
            raise ValueError("the role ends with a line feed")


CHATML = Template()


def fingerprint_of(paths: Sequence[str]) -> int:
    """Fingerprint of a record that holds exactly ``paths``."""
    h = xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode(), seed=_SEED)
    return h - (1 << 64) if h >> 63 else h


def fingerprints(layout: Messages | Fields) -> list[int]:
    """All fingerprints that select ``layout``: with and without its optional paths."""
    return [fingerprint_of([*layout.required(), *some])
            for n in range(len(layout.optional()) + 1) for some in combinations(layout.optional(), n)]


def _present(dtype: T.DataType, prefix: str) -> dict[str, object]:
    """Nested paths of a type, each with a function from a value to "is there"."""
    if isinstance(dtype, T.StructType):
        def inside(there, name: str):
            return lambda c: there(c[name])
        return {path: inside(there, f.name) for f in dtype.fields
                for path, there in _present(f.dataType, f"{prefix}.{f.name}" if prefix else f.name).items()}
    if isinstance(dtype, T.ArrayType):
        def anywhere(there):
            return lambda c: F.coalesce(F.exists(c, lambda e: there(e)), F.lit(False))
        return {path: anywhere(there) for path, there in _present(dtype.elementType, prefix + "[]").items()}
    return {prefix: lambda c: c.isNotNull()}


def _struct(schema: T.StructType) -> Column:
    return F.struct(*[F.col(f"`{f.name}`") for f in schema.fields])


def fingerprint(schema: T.StructType, layouts: Sequence[Messages | Fields] = LAYOUTS) -> Column:
    """The fingerprint of each row of a frame with ``schema``."""
    named = {p for x in layouts for p in (*x.required(), *x.optional())}
    record = _struct(schema)
    there = {p: test(record) for p, test in _present(schema, "").items() if p in named}
    return F.xxhash64(F.array_join(F.array(*[F.when(there[p], F.lit(p)) for p in sorted(there)]).cast("array<string>"),
                                   "\n"))


def _value(path: str) -> Column:
    return F.col(path).cast("string")


def _turns(layout: Messages | Fields, there: set[str]) -> Column:
    """The canonical turns of a record with this layout."""
    def turn(role: str, paths: Sequence[str]) -> Column:
        values = [_value(p) for p in paths if p in there]
        if not values:
            return F.lit(None).cast("struct<role: string, text: string>")
        return F.when(F.coalesce(*values).isNotNull(),
                      F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *values).alias("text")))

    if isinstance(layout, Fields):
        return F.array_compact(F.array(*[turn(role, paths) for role, paths in layout.turns]))

    def named(role: Column) -> Column:
        out = role
        for old, new in layout.renames:
            out = F.when(role == old, F.lit(new)).otherwise(out)
        return F.coalesce(out, F.lit(""))

    listed = F.transform(F.col(layout.path), lambda m: F.struct(
        named(m[layout.role].cast("string")).alias("role"),
        F.coalesce(m[layout.text].cast("string"), F.lit("")).alias("text")))
    if layout.system and layout.system in there:
        listed = F.concat(F.array_compact(F.array(turn("system", [layout.system]))), listed)
    return listed


def gather(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One record (id, ``rows`` in order) for each conversation of a table
    with one row per turn; NULL role or text is empty, NULL turns come first."""
    row = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                   F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.groupBy(id_col).agg(F.sort_array(F.collect_list(row)).alias("rows"))


def canonical(records: DataFrame, layouts: Sequence[Messages | Fields] = LAYOUTS) -> DataFrame:
    """``records`` with ``fingerprint``, ``layout`` and ``turns``."""
    schema = records.schema
    taken = {"fingerprint", "layout", "turns"} & set(schema.names)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are added here: rename them first")
    there = set(_present(schema, ""))
    usable = [x for x in layouts if set(x.required()) <= there]
    out = records.withColumn("fingerprint", fingerprint(schema, layouts))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for x in usable:
        chosen = F.col("fingerprint").isin(fingerprints(x))
        name = F.when(chosen, F.lit(x.name)).otherwise(name)
        turns = F.when(chosen, _turns(x, there).cast(_TURNS)).otherwise(turns)
    return out.withColumns({"layout": name, "turns": turns})


def escape(text: Column) -> Column:
    """``text`` without the opening of a control string."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    """A role on one line: line feeds become a backslash and n, backslashes a
    backslash and s."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def render(df: DataFrame, template: Template = CHATML) -> DataFrame:
    """``df`` (with ``turns``) plus ``segments`` (text, loss) and ``formatted``."""
    def pieces(t: Column) -> Column:
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            part(F.concat(F.lit(template.start), _escape_role(t["role"]), F.lit(template.gap)), F.lit(False)),
            part(escape(t["text"]), t["role"].isin(list(template.trained))),
            part(F.lit(template.end), F.lit(False)))

    out = df.withColumn("segments", F.flatten(F.transform("turns", pieces)))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse(formatted: Column, template: Template = CHATML) -> Column:
    """The turns of a formatted text."""
    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(template.start) + 1), F.length(piece))
        role = F.substring_index(body, template.gap, 1)
        return F.struct(_unescape_role(role).alias("role"),
                        unescape(F.substring(body, F.length(role) + 2, F.length(body))).alias("text"))

    pieces = F.split(formatted, rf"\Q{template.end}\E", -1)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, in order, without its escapes."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
