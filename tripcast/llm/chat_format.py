"""Chat formatting by schema fingerprints (DataFrame functions only).

A record's layout is the set of its nested field paths that hold a value
(``messages``, ``messages[].role``, ...).  The SHA-256 of the sorted paths is the
layout's fingerprint; it selects a declarative mapping that turns the record
into canonical turns ``array<struct<role, text>>``.  The turns are then written
in one template::

    <|im_start|>{role}\\n{text}<|im_end|>\\n

Inside a text ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so that no text can
hold a control string; ``unescape`` reverses it.  Roles are percent-encoded.
The output keeps the formatted string as ``segments`` with a loss flag each (the
assistants' texts), whose texts joined give ``formatted``.

A listed field counts where some item of the record's array holds a value in it,
and an item with a value in none of the fields is a path of its own (``messages[]{}``),
so that items of other fields are of unknown layout.  A system text or prompt beside
listed turns becomes their first turn unless they hold it already.

Defined cases: null role or text counts as empty, but a non-empty list that holds no
role or no text at all is of unknown layout (in ``turns``, made of table rows, not);
a record of unknown layout has a null ``layout`` and no turns; turns of a conversation are ordered by turn (null
first), then role and text, and repeated rows are kept; an empty table gives an
empty table; columns the mapping does not name are ignored.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

START, END = "<|im_start|>", "<|im_end|>"
TURNS_TYPE = "array<struct<role:string,text:string>>"

# Role names of public chat layouts and their canonical form.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``listed`` = (array path, role field, text field), or ``fields`` = pairs of
    (role, column), beside listed turns such that may come with them; ``optional``
    names fields that a record may lack, ``order`` the field by which listed turns are
    sorted, and ``rows`` says that items are table rows, whose fields may all be null.
    """
    name: str
    listed: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    order: str | None = None
    rename: bool = True
    rows: bool = False

    def path_sets(self) -> list[list[str]]:
        """The nested field paths of records in this layout, with and without the optional ones."""
        sets = [[c for _, c in self.fields if c not in self.optional]]
        if self.listed:
            array, role, text = self.listed
            items = [f"{array}[].{c}" for c in (role, text, self.order) if c]
            lists = [[array], [array] + items]
            if self.rows:
                lists = [[array]]
                for path in items + [_bare(array)]:
                    lists += [s + [path] for s in lists]
            sets = [s + own for s in sets for own in lists]
        for c in dict.fromkeys(c for _, c in self.fields if c in self.optional):
            sets += [s + [c] for s in sets]
        return sets


def _bare(array: str) -> str:
    """The path of items that hold a value in no field."""
    return f"{array}[]{{}}"


_BESIDE = {"fields": (("system", "system"), ("user", "prompt")), "optional": ("system", "prompt")}
MAPPINGS = [
    Mapping("turns", listed=("turns", "role", "text"), order="turn", rename=False, rows=True),
    Mapping("messages", listed=("messages", "role", "content"), **_BESIDE),
    Mapping("share", listed=("conversations", "from", "value"), **_BESIDE),
    Mapping("prompt", fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion")),
            optional=("system",)),
    Mapping("prompt_response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")),
            optional=("system",)),
    Mapping("instruction", fields=(("system", "system"), ("user", "instruction"), ("user", "input"),
                                   ("assistant", "output")), optional=("system", "input")),
    Mapping("question", fields=(("user", "question"), ("assistant", "answer"))),
]
#: all columns a JSON record of a known layout may have
JSON_SCHEMA = ("messages array<struct<role:string,content:string>>, "
               "conversations array<struct<`from`:string,value:string>>, system string, prompt string, "
               "completion string, response string, instruction string, input string, output string, "
               "question string, answer string")


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _some_item(items: Column, fields: list[str], held: bool) -> Column:
    """Whether some item holds a value (or none) in all the fields."""
    return F.exists(items, lambda x: reduce(lambda a, b: a & b, [x[c].isNotNull() if held else x[c].isNull()
                                                                 for c in fields]))


def _paths(schema: T.StructType, mappings: list[Mapping]) -> list[tuple[str, Column]]:
    """(nested path, whether it holds a value) of every field that some mapping knows."""
    known = {p.split("[]")[0] for m in mappings for s in m.path_sets() for p in s}
    listed = {m.listed[0]: m.listed[1:] for m in mappings if m.listed}
    out = []
    for f in schema.fields:
        if f.name not in known:
            continue
        own = F.col(f"`{f.name}`")
        out.append((f.name, own.isNotNull()))
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            out += [(f"{f.name}[].{g.name}", _some_item(own, [g.name], held=True)) for g in f.dataType.elementType.fields]
            main = [c for c in listed.get(f.name, ()) if c in f.dataType.elementType.names]
            if main:
                out.append((_bare(f.name), _some_item(own, main, held=False)))
    return sorted(out, key=lambda x: x[0])


def row_fingerprint(df: DataFrame, mappings: list[Mapping]) -> Column:
    """SHA-256 of the sorted nested field paths that hold a value in this row."""
    held = [F.when(holds, F.lit(path)) for path, holds in _paths(df.schema, mappings)]
    return F.sha2(F.concat_ws("\n", *held), 256) if held else F.lit(None).cast("string")


def _canonical(mapping: Mapping) -> Column:
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    if mapping.listed:
        array, role, body = mapping.listed
        items = F.col(f"`{array}`")
        if mapping.order:
            items = F.array_sort(F.transform(items, lambda x: F.struct(
                x[mapping.order].alias("o"), text(x[role]).alias(role), text(x[body]).alias(body))))

        def named(x):
            r = text(x[role])
            if not mapping.rename:
                return r
            return reduce(lambda acc, kv: F.when(F.lower(r) == kv[0], kv[1]).otherwise(acc), ROLE_NAMES.items(), r)

        turns = F.transform(items, lambda x: F.struct(named(x).alias("role"), text(x[body]).alias("text")))
        for kind, c in reversed(mapping.fields):
            lead = F.struct(F.lit(kind).alias("role"), text(F.col(f"`{c}`")).alias("text"))
            said = F.array_contains(turns, lead)
            turns = F.when(F.col(f"`{c}`").isNull() | said, turns).otherwise(F.concat(F.array(lead), turns))
        return turns
    whole = [(r, [c for q, c in mapping.fields if q == r]) for r in dict.fromkeys(r for r, _ in mapping.fields)]
    turns = []
    for role, cols in whole:
        some = [F.col(f"`{c}`").cast("string") for c in cols]
        turn = F.struct(F.lit(role).alias("role"), F.concat_ws("\n", *some).alias("text"))
        turns.append(F.when(reduce(lambda a, b: a | b, [c.isNotNull() for c in some]), turn))
    return F.array_compact(F.array(*turns))


def canonical_turns(records: DataFrame, keep: list[str], mappings: list[Mapping] = MAPPINGS) -> DataFrame:
    """``keep`` columns, layout (mapping name), fingerprint and canonical turns of each record."""
    named = {f.name for f in records.schema.fields}
    hashed = records.withColumn("__print", row_fingerprint(records, mappings))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS_TYPE)
    for m in mappings:
        columns = {p.split("[]")[0] for s in m.path_sets() for p in s}
        if not columns - set(m.optional) <= named:
            continue
        missing = [c for c in columns if c not in named]
        usable = m if not missing else Mapping(m.name, m.listed, tuple((r, c) for r, c in m.fields if c in named),
                                               tuple(c for c in m.optional if c in named), m.order, m.rename, m.rows)
        mine = F.col("__print").isin([fingerprint(s) for s in usable.path_sets()])
        layout = F.when(mine, F.lit(m.name)).otherwise(layout)
        turns = F.when(mine, _canonical(usable).cast(TURNS_TYPE)).otherwise(turns)
    return hashed.select(*keep, layout.alias("layout"), F.col("__print").alias("fingerprint"),
                         F.coalesce(turns, F.array().cast(TURNS_TYPE)).alias("turns"))


def records_from_json(df: DataFrame, json_col: str, keep: list[str]) -> DataFrame:
    """JSON records of mixed layouts as one table with every known column."""
    return df.select(*keep, F.from_json(json_col, JSON_SCHEMA).alias("__r")).select(*keep, "__r.*")


def records_from_rows(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """One record per conversation from a table with one row per turn."""
    item = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
                    F.col(text_col).cast("string").alias("text"))
    return rows.groupBy(F.col(id_col).alias("conv_id")).agg(F.collect_list(item).alias("turns"))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def format_chat(turns: DataFrame) -> DataFrame:
    """Adds segments (text, loss) and the formatted string to canonical turns."""
    def segments(t: Column) -> Column:
        head = F.concat(F.lit(START), F.url_encode(t["role"]), F.lit("\n"))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")),
                       F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")))

    out = turns.withColumn("segments", F.flatten(F.transform("turns", segments)))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse_chat(formatted: Column) -> Column:
    """Canonical turns read back from a formatted string."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")

    def turn(p: Column) -> Column:
        cut = F.instr(p, "\n")
        body = F.substring(p, cut + 1, F.length(p) - cut - len(END) - 1)
        return F.struct(F.url_decode(F.substring(p, F.lit(1), cut - 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(parts, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order and with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
