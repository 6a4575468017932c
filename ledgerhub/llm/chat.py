"""Conversations of many layouts as canonical turns, and turns as one training text.

The nested paths of the fields a record fills are sorted and hashed; the hash selects one of
the declared layouts. Records whose hash no layout has are kept with a null layout. All of it
is built-in expressions; a record's turns never leave its row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerhub.llm.common import with_new

TURNS = "array<struct<role:string,text:string>>"

#: The marks of the template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Control strings of this template and of common others.
CONTROL = r"([<\[])(\||/?s>|/?INST\]|</?SYS>>|start_of_turn>|end_of_turn>)"
#: Other names of roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """A layout: the paths it must fill, those it may fill, and its turns."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    turns: Callable[[], Column]

    @property
    def roots(self) -> set[str]:
        return {p.split("[")[0].split(".")[0] for p in self.required + self.optional}

    def fingerprints(self) -> list[str]:
        chosen = (c for n in range(len(self.optional) + 1) for c in combinations(self.optional, n))
        return [fingerprint_of([*self.required, *c]) for c in chosen]


def fingerprint_of(paths: list[str]) -> str:
    return hashlib.sha1("\n".join(sorted(paths)).encode()).hexdigest()


def said(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def listed(column: str, role: str, text: str) -> Callable[[], Column]:
    def one(x: Column) -> Column:
        name = F.coalesce(x[role], F.lit(""))
        for other, canonical in ROLES.items():
            name = F.when(x[role] == other, canonical).otherwise(name)
        return F.struct(name.alias("role"), F.coalesce(x[text], F.lit("")).alias("text"))

    return lambda: F.transform(F.col(column), one)


def instructed() -> Column:
    asked = F.concat_ws("\n\n", F.nullif(F.col("instruction"), F.lit("")), F.nullif(F.col("input"), F.lit("")))
    return F.array(said("user", asked), said("assistant", F.col("output")))


LAYOUTS = [
    Layout("messages", ("messages",), ("messages[].role", "messages[].content"),
           listed("messages", "role", "content")),
    Layout("conversations", ("conversations",), ("conversations[].from", "conversations[].value"),
           listed("conversations", "from", "value")),
    Layout("turns", ("turns",), ("turns[].turn", "turns[].role", "turns[].text"),
           lambda: F.transform(F.sort_array("turns"), lambda x: F.struct(
               F.coalesce(x["role"], F.lit("")).alias("role"), F.coalesce(x["text"], F.lit("")).alias("text")))),
    Layout("prompt and response", ("prompt",), ("response",),
           lambda: F.array(said("user", F.col("prompt")), said("assistant", F.col("response")))),
    Layout("system, prompt and response", ("system", "prompt"), ("response",),
           lambda: F.array(said("system", F.col("system")), said("user", F.col("prompt")),
                           said("assistant", F.col("response")))),
    Layout("question and answer", ("question",), ("answer",),
           lambda: F.array(said("user", F.col("question")), said("assistant", F.col("answer")))),
    Layout("instruction", ("instruction",), ("input", "output"), instructed),
]

def _list(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields.items()]))


#: All fields of all layouts, to read JSON records with or to widen a frame to.
RECORD = T.StructType([
    T.StructField("messages", _list(role=T.StringType(), content=T.StringType())),
    T.StructField("conversations", _list(**{"from": T.StringType(), "value": T.StringType()})),
    T.StructField("turns", _list(turn=T.LongType(), role=T.StringType(), text=T.StringType())),
    *[T.StructField(name, T.StringType()) for name in (
        "system", "prompt", "response", "question", "answer", "instruction", "input", "output")],
])


def any_fills(values: Column, field: str) -> Column:
    return F.exists(values, lambda x: x[field].isNotNull())


def filled(kind: T.DataType, value: Column, path: str) -> list[tuple[str, Column]]:
    """(path, whether the record fills it) of a field and all fields below it."""
    found = [(path, value.isNotNull())]
    if isinstance(kind, T.StructType):
        for field in kind:
            found += filled(field.dataType, value[field.name], f"{path}.{field.name}")
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        for field in kind.elementType:
            found.append((f"{path}[].{field.name}", F.coalesce(any_fills(value, field.name), F.lit(False))))
    return found


def fingerprint(schema: T.StructType = RECORD) -> Column:
    """Hash of the sorted paths of all fields that a record fills."""
    paths = [x for f in schema for x in filled(f.dataType, F.col(f.name), f.name)]
    return F.sha1(F.concat_ws("\n", *[F.when(is_set, path) for path, is_set in sorted(paths, key=lambda x: x[0])]))


def from_json(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the fields of all layouts read from JSON text; they replace columns of their names."""
    record = F.from_json(column, RECORD)
    parsed = df.select("*", record.alias("record_"))
    return with_new(parsed, **{f.name: F.col("record_")[f.name] for f in RECORD}).drop("record_")


def canonical(df: DataFrame, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """``df`` without layout fields but with ``layout`` and ``canonical_turns`` (role, text).

    Fields the frame lacks count as not filled. A null role or text is ''. A record that fills
    none or an unknown set of fields has null layout and turns; a list without elements has no
    turns. Columns called layout and canonical_turns are replaced, all others stay.
    """
    missing = [f for f in RECORD if f.name not in df.columns]
    wide = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    wide = with_new(wide, fingerprint_=fingerprint())
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:
        same = F.col("fingerprint_").isin(layout.fingerprints())
        name = F.when(same, layout.name).otherwise(name)
        turns = F.when(same, layout.turns().cast(TURNS)).otherwise(turns)
    done = with_new(wide, layout=name, canonical_turns=turns)
    return done.drop("fingerprint_", *[f.name for f in RECORD])


def escaped(text: Column) -> Column:
    """``text`` with no control string in it: each has a backslash after its first character."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(df: DataFrame, turns: str = "canonical_turns", learn: str = "assistant") -> DataFrame:
    """``df`` with ``formatted`` and ``loss_runs`` in place of the turns.

    ``loss_runs`` are runs of characters (length, loss) that cover the formatted text from start
    to end; exactly the texts of role ``learn`` are under loss. Null turns give null in both.
    """
    def runs(x: Column) -> Column:
        role, text = F.length(escaped(x["role"])), F.length(escaped(x["text"]))
        run = lambda n, loss: F.struct(n.cast("long").alias("length"), loss.alias("loss"))
        return F.array(
            run(role + len(TURN) + len(TEXT), F.lit(False)),
            run(text, x["role"] == learn),
            run(F.lit(len(END)), F.lit(False)),
        )

    written = F.transform(turns, lambda x: F.concat(
        F.lit(TURN), escaped(x["role"]), F.lit(TEXT), escaped(x["text"]), F.lit(END)))
    out = with_new(
        df, formatted=F.array_join(written, ""), loss_runs=F.flatten(F.transform(turns, runs))
    )
    return out.drop(turns)


def read_back(df: DataFrame) -> DataFrame:
    """``df`` with ``read_turns`` (role, text, loss, sound), from the formatted text and its runs alone.

    ``sound`` says that the turn's pieces have the lengths of its runs.
    """
    def one(piece: Column, i: Column) -> Column:
        cut = F.split(piece, r"<\|text\|>")
        role, text = cut[0], F.left(cut[1], F.length(cut[1]) - len(END))
        first, second = F.col("loss_runs")[i * 3], F.col("loss_runs")[i * 3 + 1]
        return F.struct(
            unescaped(role).alias("role"), unescaped(text).alias("text"), second["loss"].alias("loss"),
            ((first["length"] == F.length(role) + len(TURN) + len(TEXT))
             & (second["length"] == F.length(text))).alias("sound"),
        )

    pieces = F.split("formatted", r"<\|turn\|>")
    return with_new(df, read_turns=F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), one))


def by_conversation(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as one record of layout ``turns`` per conversation.

    Turns are ordered by number, nulls first, then role and text; a repeated row is a turn of its
    own. A conversation's turns must meet in one row, as its text does.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    return rows.groupBy("conv_id").agg(F.collect_list(turn).alias("turns"))
