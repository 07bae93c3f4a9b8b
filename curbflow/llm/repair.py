"""Repair of conversation structure: generalised LR parsing with weighted edits.

The roles of a conversation, by their initials, have to follow the grammar

    Dialogue -> (nothing) | Turns      Turns -> Open a      Open -> s u | u | Turns u

A graph-structured stack reads the turns in order. Every stack takes all actions: keep
the turn, give it another role, delete it, and insert turns before it. Stacks with
equal tops merge, and the least (cost, audit) stays. After its reductions a stack of
this grammar is the start and one symbol, so a merge loses nothing.

A conversation may hold any share of all turns, so it is read in blocks: turns are
sorted over all tasks by range, a block is a bounded run of a conversation's turns, and
the parser crosses it from each stack it may be entered with. Crossings are joined
along the conversation by the same minimum. Only initials and faults reach the parser;
texts stay in their rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbflow.llm.common import stored

REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
#: Turns of a block at most, as a power of two.
BLOCK_BITS = 14
#: Adjacent initials that may follow each other.
LEGAL = ("su", "ua", "au")
#: Faults as they reach the parser: first that holds, in this order.
BLANK, DUPLICATE, TRUNCATED, SOUND = "b", "d", "t", "-"

# The LR automaton of the grammar above: shifts, reductions (symbol, length), gotos, accepting tops.
_SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 5, (3, "u"): 6, (4, "a"): 7}
_REDUCE = {2: ("Open", 1), 5: ("Open", 2), 6: ("Open", 2), 7: ("Turns", 2)}
_GOTO = {(0, "Open"): 4, (0, "Turns"): 3}
_ACCEPT = (0, 3)
START = (0, None)

_BLOCK = "struct<blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,first:string,last:string,ways:array<struct<enter:int,leave:int,cost:bigint,edits:string>>>"
_RESULT = "struct<blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint,audit:string,blocks:array<struct<block:bigint,edits:string>>>"


def _shifted(stack: tuple, symbol: str) -> tuple | None:
    """The stack with a symbol shifted and all reductions done, or None."""
    state = _SHIFT.get((stack[0], symbol))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in _REDUCE:
        name, length = _REDUCE[stack[0]]
        for _ in range(length):
            stack = stack[1]
        stack = (_GOTO[stack[0], name], stack)
    return stack


def _tops() -> dict[int, tuple]:
    """Every stack that can be reached, by its top."""
    found, new = {0: START}, [START]
    while new:
        stack = new.pop()
        for symbol in "sua":
            got = _shifted(stack, symbol)
            if got and got[0] not in found:
                found[got[0]] = got
                new.append(got)
    return found


TOPS = _tops()


def _inserted(stack: tuple) -> list[tuple[tuple, str]]:
    """The stack and those that insertions make of it, with their edits; each top once, by the fewest."""
    found, new = {stack[0]: (stack, "")}, [(stack, "")]
    for now, edits in new:
        for symbol in ROLES:
            got = _shifted(now, symbol)
            if got and got[0] not in found:
                found[got[0]] = (got, edits + "I" + symbol)
                new.append(found[got[0]])
    return list(found.values())


def _actions() -> dict[tuple[int, str, str], list[tuple[int, str, int]]]:
    """Per top, initial and fault: what may be done with a turn, as (cost, edits, new top).

    Edits are pairs of a letter and the role it leaves. Of actions with equal new
    tops only the least (cost, letters) can win.
    """
    table = {}
    for top, stack in TOPS.items():
        for initial in "suax":
            for fault in (BLANK, DUPLICATE, TRUNCATED, SOUND):
                best: dict[int, tuple[int, str, str]] = {}
                for now, before in _inserted(stack):
                    cost = INSERT * len(before) // 2
                    ways = [(cost + DELETE, "D-", now)]
                    if fault in (TRUNCATED, SOUND):
                        cost += UNFINISHED * (fault == TRUNCATED)
                        ways.append((cost, "K" + initial, _shifted(now, initial)))
                        ways += [(cost + REROLE, "R" + r, _shifted(now, r)) for r in ROLES]
                    for total, edit, to in ways:
                        if to is not None:
                            way = (total, (before + edit)[::2], before + edit)
                            best[to[0]] = min(best.get(to[0], way), way)
                table[top, initial, fault] = [(c, edits, to) for to, (c, _, edits) in best.items()]
    return table


ACTIONS = _actions()


def _merged(ways: list[tuple[int, int, str, int, tuple]]) -> dict[int, tuple[int, int, tuple]]:
    """Per top the least (cost, rank of what came before, letters), and the new ranks.

    Audits are never compared whole: no audit of a wave begins another one, so their order
    is that of the audits they continue, then that of the letters added.
    """
    best: dict[int, tuple] = {}
    for cost, rank, edits, top, trail in ways:
        way = (cost, rank, edits[::2], edits, trail)
        if top not in best or way[:3] < best[top][:3]:
            best[top] = way
    order = sorted(best, key=lambda top: best[top][1:3])
    return {top: (best[top][0], order.index(top), (best[top][4], best[top][3])) for top in best}


def _unrolled(trail: tuple | None) -> list[str]:
    edits = []
    while trail is not None:
        trail, edit = trail
        edits.append(edit)
    return edits[::-1]


def crossed(codes: str, enter: int) -> list[tuple[int, int, str]]:
    """(new top, cost, edits) of the best ways through a block's turns, from a stack.

    ``codes`` holds two characters a turn: its initial (x: none of the grammar's) and fault.
    """
    wave: dict[int, tuple[int, int, tuple | None]] = {enter: (0, 0, None)}
    for at in range(0, len(codes), 2):
        initial, fault = codes[at], codes[at + 1]
        wave = _merged([
            (cost + more, rank, edits, to, trail)
            for top, (cost, rank, trail) in wave.items()
            for more, edits, to in ACTIONS[top, initial, fault]
        ])
    return [(top, cost, "".join(_unrolled(trail))) for top, (cost, _, trail) in wave.items()]


def _block(codes: pd.Series, first: pd.Series) -> pd.DataFrame:
    """Faults of a block, and its crossings: from the start where a conversation begins, else from every stack."""
    out = []
    for code, begins in zip(codes, first):
        initials, faults = code[::2], code[1::2]
        out.append((
            *map(faults.count, (BLANK, DUPLICATE, TRUNCATED)),
            sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1)), initials[0], initials[-1],
            [{"enter": e, "leave": to, "cost": c, "edits": x} for e in ([0] if begins else TOPS) for to, c, x in crossed(code, e)],
        ))
    return pd.DataFrame(out, columns=["blank", "duplicate", "truncated", "illegal", "first", "last", "ways"])


def _joined(blocks: list) -> tuple:
    """The least (cost, audit) along all blocks of a conversation."""
    wave: dict[int, tuple[int, int, tuple | None]] = {0: (0, 0, None)}
    for block in blocks:
        wave = _merged([
            (wave[w["enter"]][0] + w["cost"], wave[w["enter"]][1], w["edits"], w["leave"], wave[w["enter"]][2])
            for w in block["found"]["ways"] if w["enter"] in wave
        ])
    ends = [
        (cost + INSERT * len(edits) // 2, rank, edits[::2], edits, trail)
        for top, (cost, rank, trail) in wave.items()
        for to, edits in _inserted(TOPS[top])
        if to[0] in _ACCEPT
    ]
    cost, _, _, last, trail = min(ends, key=lambda way: way[:3])
    edits = _unrolled(trail)
    edits[-1] += last
    seams = zip(blocks, blocks[1:])
    found = [b["found"] for b in blocks]
    return (
        *(sum(int(f[k]) for f in found) for k in ("blank", "duplicate", "truncated")),
        sum(int(f["illegal"]) for f in found) + sum(a["found"]["last"] + b["found"]["first"] not in LEGAL for a, b in seams),
        int(cost),
        "".join(e[::2] for e in edits),
        [{"block": int(b["block"]), "edits": e} for b, e in zip(blocks, edits)],
    )


def _conversation(blocks: pd.Series) -> pd.DataFrame:
    names = ["blank", "duplicate", "truncated", "illegal", "cost", "audit", "blocks"]
    return pd.DataFrame([_joined(list(b)) for b in blocks], columns=names)


def ordered(turns: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """The turns in order, stored: ``conv_id, turn, role, text, digest, place, block``.

    Turns come by number, those without one first, equal numbers by role, then by the
    text's digest. Nulls of role and text are one space. ``place`` is unique and grows along the
    order; ``block`` is a bounded run of places. Sorting by range splits long conversations.
    """
    key = ["conv_id", "turn", "role", "digest"]
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("digest", F.sha2("text", 256))
    placed = rows.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("place", F.monotonically_increasing_id())
    return stored(placed.withColumn("block", F.shiftright("place", block_bits)), "turns")


def _codes(rows: DataFrame) -> DataFrame:
    """``conv_id, block, place, code``: initial and fault of every turn, without its text.

    A turn repeats if its role and text stood earlier in its conversation, that is unless its
    place is the least of them; the least places are met by place, so no key is hot.
    """
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("_first")).select("_first")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    initial = F.substring("role", 1, 1)
    own = rows.select(
        "conv_id", "block", "place",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        last.isin(".", "!", "?").alias("ended"),
    )
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("_first").isNull(), DUPLICATE)
        .when(~F.col("ended"), TRUNCATED)
        .otherwise(SOUND)
    )
    met = own.join(firsts, F.col("place") == F.col("_first"), "left")
    return met.select("conv_id", "block", "place", F.concat("initial", fault).alias("code"))


def reports(rows: DataFrame) -> DataFrame:
    """Per conversation of :func:`ordered`: its faults, cost, audit and the edits of its blocks.

    ``gaps`` counts numbers missing between the least and the greatest. ``audit`` has the initials of
    the cheapest edits in order (Keep, Rerole, Delete, Insert), the ASCII-least of equally cheap ones.
    Blank and repeated turns are always deleted. No rows give none.
    """
    in_order = F.array_sort(F.collect_list(F.struct("place", "code")))
    blocks = _codes(rows).groupBy("conv_id", "block").agg(
        F.array_join(F.transform(in_order, lambda t: t["code"]), "").alias("codes")
    )
    along = Window.partitionBy("conv_id").orderBy("block")
    found = blocks.withColumn("first", F.row_number().over(along) == 1).select("conv_id", "block", F.pandas_udf(_block, _BLOCK)("codes", "first").alias("found"))
    whole = found.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("block", "found")), _by_block).alias("blocks"))
    repaired = whole.select("conv_id", F.pandas_udf(_conversation, _RESULT)("blocks").alias("r")).select("conv_id", "r.*")
    numbers = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy(F.col("conv_id").alias("_conv")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    return repaired.join(numbers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def _by_block(a: Column, b: Column) -> Column:
    return F.when(a["block"] < b["block"], -1).when(a["block"] > b["block"], 1).otherwise(0)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns ``conv_id, place, part, edit, role, text``, ordered by (place, part) in a conversation.

    ``rows`` come from :func:`ordered` and ``found`` from :func:`reports`. Inserted turns have empty
    texts and stand at the place of the turn they precede, or after the last. Texts never meet
    in one row here; a join by place brings every turn its edits.
    """
    chosen = found.select("conv_id", F.explode("blocks").alias("b")).select("conv_id", "b.*")
    spots = rows.groupBy("conv_id", "block").agg(F.min("place").alias("from"))
    keys = [F.col("conv_id").eqNullSafe(F.col("_conv")), F.col("block") == F.col("_block")]
    named = chosen.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "edits")
    each = F.regexp_extract_all("edits", F.lit("((?:I.)*[KRD].|(?:I.)+$)"), 1)
    edits = spots.join(named, keys).select(
        F.col("conv_id").alias("_conv"), "from", F.posexplode(each).alias("i", "edit")
    ).select("_conv", (F.col("from") + F.col("i")).alias("_at"), "edit")
    # what is inserted at the end has the place after the last, where another conversation may begin
    joined = edits.join(rows, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("place") == F.col("_at")), "left")
    steps = F.regexp_extract_all("edit", F.lit("([IKR].)"), 1)
    split = joined.select(
        F.col("_conv").alias("conv_id"), F.col("_at").alias("place"),
        F.posexplode(steps).alias("part", "step"), F.col("role").alias("_role"), F.col("text").alias("_text"),
    )
    letter, name = F.substring("step", 1, 1), F.when(F.substring("step", 2, 1) == "u", "user").otherwise("assistant")
    return split.select(
        "conv_id", "place", "part", letter.alias("edit"),
        F.when(letter == "K", F.col("_role")).otherwise(name).alias("role"),
        F.when(letter == "I", "").otherwise(F.col("_text")).alias("text"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with one turn in four damaged, by the checksum of its number.

    Of twenty classes 0 drops a turn, 1 empties its text, 2 takes its full stops, 3 repeats it and
    4 makes it the user's. Nulls are one space, in the checksum too.
    """
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("_kind"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        rows.where("_kind <> 0")
        .withColumn("_copy", F.explode(copies))
        .select(
            "conv_id", "turn",
            F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        )
    )
