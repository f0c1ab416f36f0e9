"""Chat formatting of heterogeneous records, in built-in functions only.

A record is a JSON text of any known layout. Its nested field paths are read as
a schema text, scalar types blanked, and hashed; the hash selects a declarative
mapping (``LAYOUTS``), which turns the record into canonical turns (role, text).
The template marks each turn and escapes control strings inside texts, so turns
and the loss mask can be read back from the output.

Defined cases: a record with an unknown layout, or that is not JSON, gets null
in ``layout``, ``turns`` and all that follows from them; null roles and texts
are empty; an empty list of messages is an empty conversation; repeated turns
stay, in the order of (turn, role, text).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TURNS = "array<struct<role string, text string>>"
#: Names that other layouts use for the canonical roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant"}


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record lie: a list of objects, or one field for each role."""

    name: str
    messages: str | None = None
    role: str = "role"
    text: str = "content"
    fields: tuple[tuple[str, str], ...] = ()
    optional: frozenset[str] = frozenset()
    renamed: bool = False

    def schemas(self) -> list[tuple[str, tuple[tuple[str, str], ...]]]:
        """Each schema text that this mapping reads, with the fields that are there."""
        if self.messages:
            item = ", ".join(f"{k}: *" for k in sorted((self.role, self.text)))
            return [(f"OBJECT<{self.messages}: ARRAY<{x}>>", ()) for x in (f"OBJECT<{item}>", "*")]
        found = []
        for present in product(*[(True, False) if f in self.optional else (True,) for f, _ in self.fields]):
            kept = tuple(x for x, p in zip(self.fields, present, strict=True) if p)
            found.append((f"OBJECT<{', '.join(f'{f}: *' for f in sorted(f for f, _ in kept))}>", kept))
        return found

    def turns(self, record: Column, kept: tuple[tuple[str, str], ...]) -> Column:
        if self.messages:
            items = F.variant_get(record, f"$.{self.messages}", f"array<struct<{self.role} string, {self.text} string>>")
            return F.transform(items, lambda m: turn(m[self.role], m[self.text], self.renamed))
        return F.array(*[turn(F.lit(role), F.variant_get(record, f"$.{f}", "string")) for f, role in kept])


LAYOUTS = (
    Layout("messages", messages="messages"),
    Layout("conversations", messages="conversations", role="from", text="value", renamed=True),
    Layout("prompt", fields=(("system", "system"), ("prompt", "user"), ("response", "assistant")), optional=frozenset({"system"})),
    Layout(
        "instruction",
        fields=(("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")),
        optional=frozenset({"system", "input"}),
    ),
)


def turn(role: Column, text: Column, renamed: bool = False) -> Column:
    """A canonical turn; in a ``renamed`` layout, its names of roles become the canonical ones."""
    role = F.coalesce(role, F.lit(""))
    for other, own in ROLE_NAMES.items() if renamed else ():
        role = F.when(role == other, F.lit(own)).otherwise(role)
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def fingerprint(schema: Column) -> Column:
    return F.xxhash64(schema)


def field_paths(record: Column) -> Column:
    """The nested field paths of a variant, sorted, with scalar types blanked."""
    scalar = r"(^|: |ARRAY<)(?!OBJECT<|ARRAY<)[A-Z_]+(\(\d+,\s*\d+\))?(?=[,>]|$)"
    return F.regexp_replace(F.schema_of_variant(record), scalar, "$1*")


def canonical_turns(records: DataFrame, column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``fingerprint``, ``layout`` and ``turns`` read from the JSON text in ``column``."""
    v = F.col("_variant")
    rows = records.withColumn("_variant", F.try_parse_json(column)).withColumn("fingerprint", fingerprint(field_paths(v)))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for each in layouts:
        for schema, kept in each.schemas():
            here = F.col("fingerprint") == fingerprint(F.lit(schema))
            layout = F.when(here, F.lit(each.name)).otherwise(layout)
            turns = F.when(here, each.turns(v, kept)).otherwise(turns)
    return rows.withColumn("layout", layout).withColumn("turns", turns).drop("_variant")


def escape(text: Column) -> Column:
    """After this no control string is left: each ``<|`` is followed by a further bar."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def head(role: Column) -> Column:
    """What stands before a turn's text; a line feed in a role becomes a control string of its own."""
    return F.concat(F.lit(START), F.replace(escape(role), F.lit("\n"), F.lit("<|nl|>")), F.lit("\n"))


def formatted(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t["role"]), escape(t["text"]), F.lit(END))), "")


def loss_runs(turns: Column, trained: str = "assistant") -> Column:
    """The loss mask as runs over the formatted text: for each turn, characters before, under and after it."""

    def runs(t: Column) -> Column:
        whole = F.length(head(t["role"])) + F.length(escape(t["text"]))
        under = F.when(t["role"] == trained, F.length(escape(t["text"]))).otherwise(F.lit(0))
        return F.struct((whole - under).alias("before"), under.alias("under"), F.lit(len(END)).alias("after"))

    return F.transform(turns, runs)


def format_chats(records: DataFrame, column: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``layout``, ``turns``, ``formatted`` and ``loss_mask`` to records of known layouts."""
    rows = canonical_turns(records, column, layouts)
    return rows.withColumns({"formatted": formatted(F.col("turns")), "loss_mask": loss_runs(F.col("turns"))})


def turn_parts(text: Column) -> Column:
    """The formatted text cut behind each turn, without the end marks."""
    parts = F.split(text, r"<\|im_end\|>\n")
    return F.slice(parts, 1, F.size(parts) - 1)


def read_turns(parts: Column) -> Column:
    """Turns from their formatted parts."""

    def read(p: Column) -> Column:
        at = F.instr(p, "\n")
        role = F.substring(p, F.lit(len(START) + 1), at - F.lit(len(START) + 1))
        role = unescape(F.replace(role, F.lit("<|nl|>"), F.lit("\n")))
        return F.struct(role.alias("role"), unescape(F.substring(p, at + 1, F.length(p))).alias("text"))

    return F.transform(parts, read)


def read_loss(parts: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(
        F.zip_with(parts, mask, lambda p, m: unescape(F.substring(p, m["before"] + 1, m["under"]))), ""
    )


def conversation_records(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as one JSON record for each conversation, in the layout that fits it.

    A question with its answer is a prompt, with a system text an instruction;
    longer ones are lists, under either of two names.
    """
    turns = F.array_sort(
        F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    )
    convs = rows.groupBy("conv_id").agg(turns.alias("t"))
    roles, text = F.transform("t", lambda x: x["role"]), lambda i: F.col("t")[i]["text"]
    as_list = lambda role, body: F.transform("t", lambda x: F.struct(x["role"].alias(role), x["text"].alias(body)))
    is_ = lambda *names: roles == F.array(*[F.lit(n) for n in names])
    named = F.exists(roles, lambda r: r.isin(*ROLE_NAMES))  # such a role would be renamed in a list
    record = (
        F.when(is_("user", "assistant"), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(
            is_("system", "user", "assistant"),
            F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))),
        )
        .when((F.col("conv_id") % 2 == 0) & ~named, F.to_json(F.struct(as_list("from", "value").alias("conversations"))))
        .otherwise(F.to_json(F.struct(as_list("role", "content").alias("messages"))))
    )
    return convs.select("conv_id", record.alias("record"))
