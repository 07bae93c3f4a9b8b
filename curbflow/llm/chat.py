"""Chat formatting: records of different layouts to canonical turns, turns to one marked text.

A record's layout is known by its nested field paths alone: those of them that any layout
names are hashed, and the hash selects a declarative mapping, whatever the values. Fields no
layout names change nothing. Records that no layout fits are a table of their own. Canonical turns are rows, so a long
conversation is built from rows formatted in parallel. Each turn becomes

    <s>[INST]role[/INST]text</s>

and control strings inside roles and texts get a backslash after their first
character, one more than they had, which reading takes away again. The loss mask
lists byte ranges of assistant texts.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.arrays import before, let

OPEN, HEAD, MID, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
#: An opening character that a control string follows, and one whose mark is to go.
_CONTROL = r"(<(?=\\*/?s>)|\[(?=\\*/?INST\]))"
_MARKED = r"(<)\\(?=\\*/?s>)|(\[)\\(?=\\*/?INST\])"
#: Characters of a text that a JSON record holds; longer ones stand beside their record.
LONG = 1 << 23


@dataclass(frozen=True)
class Layout:
    """How one shape of record maps to turns; names are field paths of the record.

    Either a list of turns (``turns`` with its ``role`` and ``text`` fields),
    single fields that each are a turn (``parts``: field to role), or a row that is
    one turn (``turns`` empty). ``order`` is the field that places a row's turn.
    """

    name: str
    turns: str = ""
    role: str = ""
    text: str = ""
    order: str = ""
    parts: dict[str, str] = field(default_factory=dict)
    roles: dict[str, str] = field(default_factory=dict)

    @property
    def shapes(self) -> list[list[str]]:
        """The sets of paths that make the layout; a list of turns may be empty."""
        if self.parts:
            return [[*self.parts]]
        if not self.turns:
            return [[self.role, self.text, self.order]]
        first = [f"{self.turns}[0].{path.removeprefix('$.')}" for path in (self.role, self.text)]
        return [[self.turns, *first], [self.turns]]

    @property
    def fingerprints(self) -> list[str]:
        return [hashlib.sha256(",".join(sorted(s)).encode()).hexdigest() for s in self.shapes]


_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant"}
LAYOUTS = [
    Layout("turn rows", role="$.role", text="$.content", order="$.turn"),
    Layout("messages", "$.messages", "$.role", "$.content"),
    Layout("conversations", "$.conversations", "$.from", "$.value", roles=_NAMES),
    Layout("prompt", parts={"$.prompt": "user", "$.response": "assistant"}),
    Layout("system prompt", parts={"$.system": "system", "$.prompt": "user", "$.response": "assistant"}),
    Layout("instruction", parts={"$.instruction": "user", "$.output": "assistant"}),
    Layout("instruction with input", parts={"$.instruction": "user", "$.input": "user", "$.output": "assistant"}),
]


def fingerprint(record: Column, layouts: list[Layout] = LAYOUTS) -> Column:
    """Hash of the nested field paths of a variant that any layout names, in order."""
    paths = sorted({p for layout in layouts for shape in layout.shapes for p in shape})
    present = [F.when(F.try_variant_get(record, p, "variant").isNotNull(), F.lit(p)) for p in paths]
    return F.sha2(F.concat_ws(",", *present), 256)


def _turn(order: Column, role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.struct(order.alias("turn"), F.coalesce(role, empty).alias("role"), F.coalesce(text, empty).alias("text"))


def _turns(record: Column, layout: Layout, beside: Column) -> Column:
    def get(path: str, kind: str, of: Column = record) -> Column:
        return F.try_variant_get(of, path, kind)

    if layout.parts:
        return F.array(
            *[
                _turn(F.lit(i).cast("long"), F.lit(role), get(path, "string"))
                for i, (path, role) in enumerate(layout.parts.items())
            ]
        )
    if not layout.turns:
        text = F.coalesce(beside, get(layout.text, "string"))
        return F.array(_turn(get(layout.order, "long"), get(layout.role, "string"), text))

    def one(item: Column, i: Column) -> Column:
        role = get(layout.role, "string", item)
        for old, new in layout.roles.items():
            role = F.when(role == old, new).otherwise(role)
        return _turn(i.cast("long"), role, get(layout.text, "string", item))

    return F.transform(get(layout.turns, "array<variant>"), one)


def _known(records: DataFrame, layouts: list[Layout]) -> DataFrame:
    """``record`` with ``k (json, conv_id, layout, turns)``; layout and turns are null where none fits.

    A record is parsed once and its layout looked up once; what follows reads the result.
    """
    beside = F.col("long_text") if "long_text" in records.columns else F.lit(None).cast("string")

    def read(v: Column, prints: Column) -> Column:
        name, turns = F.lit(None).cast("string"), F.lit(None)
        for layout in layouts:
            here = prints.isin(*layout.fingerprints)
            if layout.turns:
                here = here & F.try_variant_get(v, layout.turns, "array<variant>").isNotNull()
            name = F.when(here, layout.name).otherwise(name)
            turns = F.when(here, _turns(v, layout, beside)).otherwise(turns)
        return F.struct(
            v.isNotNull().alias("json"), F.try_variant_get(v, "$.id", "long").alias("conv_id"),
            F.when(v.isNotNull(), name).alias("layout"), F.when(v.isNotNull(), turns).alias("turns"),
        )

    found = let(F.try_parse_json("record"), lambda v: let(fingerprint(v, layouts), lambda prints: read(v, prints)))
    return records.select("record", found.alias("k"))


def canonical(records: DataFrame, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """``(conv_id, layout, turn, role, text)`` rows of ``records (record)``, JSON text each.

    A column ``long_text``, if there is one, has the text of a one-turn record that is too long for JSON. Records that
    are no JSON, or whose paths no layout has, are in :func:`rejected` alone. An empty list of turns gives
    no rows; what a layout does not name is not read; texts that are numbers are their digits. A
    null or missing text or role is empty. Repeated records give their turns
    again; no records give no rows.
    """
    # outer, and the others dropped behind: a filter on the turns would read every record again
    rows = _known(records, layouts).select("k.conv_id", "k.layout", F.explode_outer("k.turns").alias("t"))
    return rows.where("t IS NOT NULL").select("conv_id", "layout", "t.*")


def rejected(records: DataFrame, layouts: list[Layout] = LAYOUTS) -> DataFrame:
    """``(record, reason)`` of the records that are no JSON, too long for it, or of no layout; null records too."""
    reason = F.when(F.col("k.json"), "no layout").otherwise("no JSON, or too long")
    return _known(records, layouts).where("k.layout IS NULL").select("record", reason.alias("reason"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _MARKED, "$1$2")


def formatted(turns: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss)``: the marked text of each conversation and its loss mask.

    ``turns (conv_id, turn, role, text)`` are ordered by turn; equal turns by
    role, then text. ``loss`` lists ``(start, length)`` in bytes of every assistant
    text. A conversation is one output value, so its turns meet in one row; they
    are escaped, marked and measured before. A null conv_id is a conversation.
    """
    head = F.concat(F.lit(OPEN + HEAD), escaped(F.col("role")), F.lit(MID))
    body = escaped(F.col("text"))
    marked = turns.select(
        "conv_id", "turn", "role", "text",
        F.octet_length(head).cast("long").alias("at"),
        F.octet_length(body).cast("long").alias("length"),
        F.concat(head, body, F.lit(CLOSE)).alias("marked"),
    ).select(
        "conv_id",
        F.struct(
            "turn", "role", "text", "at", "length", F.octet_length("marked").cast("long").alias("size"), "marked"
        ).alias("t"),
    )
    whole = marked.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    loss = let(
        before(F.transform("ts", lambda t: t["size"])),
        lambda starts: F.filter(
            F.transform(
                "ts",
                lambda t, i: F.when(
                    t["role"] == "assistant",
                    F.struct((starts[i] + t["at"]).alias("start"), t["length"].alias("length")),
                ),
            ),
            lambda s: s.isNotNull(),
        ),
    )
    return whole.select("conv_id", F.array_join("ts.marked", "").alias("formatted"), loss.alias("loss"))


def turns_of(text: Column) -> Column:
    """Array of ``(role, text)`` read back from a marked text."""
    parts = F.split(text, CLOSE, -1)
    pattern = r"(?s)^<s>\[INST\](.*?)\[/INST\](.*)$"
    return F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda p: F.struct(
            unescaped(F.regexp_extract(p, pattern, 1)).alias("role"),
            unescaped(F.regexp_extract(p, pattern, 2)).alias("text"),
        ),
    )


def loss_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, joined."""
    return let(
        text.cast("binary"),
        lambda data: F.array_join(
            F.transform(
                loss,
                lambda s: unescaped(
                    F.substring(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")
                ),
            ),
            "",
        ),
    )


def turn_records(conversations: DataFrame) -> DataFrame:
    """``(record, long_text)`` of a table with a row per turn: JSON records, very long texts beside them.

    A null text or role is empty.
    """
    text = F.coalesce("text", F.lit(""))
    long = F.length(text) > LONG
    fields = F.struct(
        F.col("conv_id").alias("id"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.when(long, "").otherwise(text).alias("content"),
    )
    return conversations.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("record"), F.when(long, text).alias("long_text"))
