"""Conversations of any known layout as canonical turns, and a reversible
template with a loss mask.

A layout is known by its fingerprint: the SHA-256 of its sorted nested field
paths (``messages[].role``). Each mapping declares the paths it reads and one
SQL expression that turns a record into ``array<struct<role, text>>``. A table
is fingerprinted by its schema, a JSON record by its own keys; in both cases
only paths that some mapping declares count, so extra fields do not hide a
layout. DataFrame functions only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.llm.common import fresh, quoted

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """A list of turns (``turns``, with its role and text fields), or one
    question (``ask``, with optional ``extra`` below it) and its ``answer``."""
    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    ask: str = ""
    extra: str = ""
    answer: str = ""

    @property
    def paths(self) -> list[str]:
        if self.turns:
            return [f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"]
        return [p for p in (self.ask, self.extra, self.answer) if p]

    @property
    def fingerprint(self) -> str:
        return fingerprint(self.paths)

    @property
    def schema(self) -> str:
        if self.turns:
            return f"`{self.turns}` array<struct<`{self.role}`:string,`{self.text}`:string>>"
        return ", ".join(f"`{p}` string" for p in self.paths)

    def canonical(self, record: Column) -> Column:
        """array<struct<role, text>> of a record (a struct with these paths)."""
        if self.turns:
            names = F.create_map(*(F.lit(v) for pair in ROLE_NAMES.items() for v in pair))
            return F.transform(record[self.turns], lambda x: F.struct(
                F.coalesce(names[x[self.role]], x[self.role]).alias("role"), x[self.text].alias("text")))
        ask = record[self.ask]
        if self.extra:
            extra = F.coalesce(record[self.extra], F.lit(""))
            ask = F.when(extra == "", ask).otherwise(
                F.concat(F.coalesce(ask, F.lit("")), F.lit("\n\n"), extra))
        return F.array(F.struct(F.lit("user").alias("role"), ask.alias("text")),
                       F.struct(F.lit("assistant").alias("role"), record[self.answer].alias("text")))


def fingerprint(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

LAYOUTS = [
    Layout("messages", turns="messages", role="role", text="content"),
    Layout("from-value", turns="conversations", role="from", text="value"),
    Layout("turns", turns="turns", role="role", text="text"),
    Layout("instruction-input", ask="instruction", extra="input", answer="output"),
    Layout("instruction-output", ask="instruction", answer="output"),
    Layout("prompt-response", ask="prompt", answer="response"),
    Layout("prompt-completion", ask="prompt", answer="completion"),
    Layout("question-answer", ask="question", answer="answer"),
]


def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Nested paths of all leaf fields; ``[]`` marks an array."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields
                for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, prefix + "[]")
    return [prefix]


def layout_of(paths) -> Layout | None:
    """The layout whose declared paths are all there (the one with most paths;
    equal counts: the first listed)."""
    best = None
    for layout in LAYOUTS:
        if fingerprint(set(paths) & set(layout.paths)) == layout.fingerprint \
                and (best is None or len(layout.paths) > len(best.paths)):
            best = layout
    return best


def _canonical(turns: Column) -> Column:
    """Null turns, roles and texts become empty."""
    return F.transform(F.coalesce(turns, F.array().cast(TURNS)), lambda x: F.struct(
        F.coalesce(x["role"], F.lit("")).alias("role"), F.coalesce(x["text"], F.lit("")).alias("text")))


def from_columns(df: DataFrame, key: str) -> DataFrame:
    """(``key``, turns, layout) of a table whose schema has a known layout.

    Unknown layouts raise: every record of a table has the same one.
    """
    layout = layout_of(field_paths(df.schema))
    if layout is None:
        raise ValueError(f"no layout for fields {sorted(field_paths(df.schema))}")
    return df.select(F.col(*quoted([key])), _canonical(layout.canonical(F.struct(*quoted(df.columns)))).alias("turns"),
                     F.lit(layout.name).alias("layout"))


def from_json(df: DataFrame, key: str, record: str) -> DataFrame:
    """(``key``, turns, layout) of JSON records of mixed layouts.

    Each row is fingerprinted by its own field paths, those of a list by all
    its elements together, so turns may lack fields. Null, broken and unknown
    records come back with no turns and a null layout.
    """
    arrays = sorted({x.turns for x in LAYOUTS if x.turns})
    raw, found = F.col(*quoted([record])), fresh(df, "_paths")
    none = F.array().cast("array<string>")
    own = F.coalesce(F.json_object_keys(raw), none)

    def nested(top: str) -> Column:
        items = F.from_json(raw, f"`{top}` array<string>")[top]
        keys = F.array_distinct(F.flatten(F.transform(items, lambda x: F.coalesce(F.json_object_keys(x), none))))
        return F.transform(F.when(F.array_contains(own, top) & keys.isNotNull(), keys).otherwise(none),
                           lambda k: F.concat(F.lit(f"{top}[]."), k))

    paths = F.concat(own, *map(nested, arrays))
    chosen, name = F.lit(None).cast(TURNS), F.lit(None).cast("string")
    for layout in sorted(LAYOUTS, key=lambda x: len(x.paths)):
        shared = F.array_sort(F.array_distinct(
            F.array_intersect(found, F.array(*map(F.lit, sorted(layout.paths))))))
        is_it = F.sha2(F.array_join(shared, "\n"), 256) == layout.fingerprint
        chosen, name = F.when(is_it, layout.canonical(F.from_json(raw, layout.schema))).otherwise(chosen), \
            F.when(is_it, layout.name).otherwise(name)
    return (df.withColumn(found, paths)
            .select(F.col(*quoted([key])), _canonical(chosen).alias("turns"), name.alias("layout")))


def gather_turns(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows by turn (``key``, turn, role, text) as one record per conversation,
    in the layout ``turns[].role, turns[].text``.

    Turns are ordered by turn (null first), then role and text; repeated rows
    stay. A null key is a conversation of its own.
    """
    item = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("turns"))


# --- the template ------------------------------------------------------------

OPEN, CLOSE_HEAD, END = "<turn ", ">", "</turn>\n"


def escape(text: Column) -> Column:
    """No mark can occur in the result: backslash and both angle brackets
    become a backslash and a letter."""
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")),
                               F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<")),
                               F.lit("\\g"), F.lit(">")), F.lit("\\b"), F.lit("\\"))


def format_turns(df: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Add ``formatted`` and ``loss`` (array of start, length in code points).

    One turn is ``<turn ROLE>TEXT</turn>`` and a line break, role and text
    escaped. The loss mask covers the escaped text of ``trained`` roles only.
    No turns give an empty string. Other columns stay, but for two of these
    names, which are replaced.
    """
    found, widths = fresh(df, "_parts"), fresh(df, "_sizes")
    parts = F.transform("turns", lambda x: F.struct(
        F.concat(F.lit(OPEN), escape(x["role"]), F.lit(CLOSE_HEAD)).alias("head"),
        escape(x["text"]).alias("body"), x["role"].isin(*trained).alias("trained")))
    sizes = F.transform(found, lambda p: F.struct(
        F.char_length(p["head"]).alias("head"), F.char_length(p["body"]).alias("body"),
        p["trained"].alias("trained")))
    walk = F.aggregate(
        widths,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["head"] + s["body"] + F.lit(len(END))).alias("at"),
            F.when(s["trained"], F.array_append(acc["spans"], F.struct(
                (acc["at"] + s["head"]).alias("start"), s["body"].alias("length"))))
            .otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return (df.withColumn(found, parts).withColumn(widths, sizes)
            .withColumn("formatted", F.array_join(F.transform(
                found, lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""))
            .withColumn("loss", walk).drop(found, widths))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substr(F.substring_index(p, CLOSE_HEAD, 1), F.lit(len(OPEN) + 1))).alias("role"),
        unescape(F.substring_index(p, CLOSE_HEAD, -1)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substr(formatted, s["start"] + 1, s["length"]))), "")
