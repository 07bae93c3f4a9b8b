"""Personal data: patterned identifiers, and terms that reveal them by co-occurrence.

Identifiers (the protected entities) are found by patterns. A term beside an
entity is judged by the corpus: with n documents, n_c holding the entity, n_t the
term and n_ct the term beside the entity, what is left to know of the entity beside
the term is -log2(n_ct / n_t) bits of its log2(n / n_c). A term that leaves at most
``RESIDUAL`` bits, and tells at least ``GAIN``, is disclosed: removed if it stands nowhere
else, else generalised. The bounds are the same for every n. How often the
entity stands beside the term, n_ct / n_t, is shrunk towards the entity's share of
all documents as if ``PRIOR`` texts had been seen before: an entity of a single
text can be disclosed, by terms of that text alone. Copies of one text are
one piece of evidence. Counts cover all documents.

Terms are runs of letters and figures, and pairs of neighbours in scripts without
spaces; identifiers are blanked out before terms are looked for. A document that
holds an entity loses the terms that reveal it wherever they stand in its text.
Documents without the entity keep them: no identifier is left in the output that
they could lead to.

Everything is DataFrame functions; the corpus counts are aggregates that combine
before their shuffle, and texts without identifiers are never moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.arrays import before, let
from curbflow.llm.common import fresh, stored

#: Bits that a disclosing term leaves of an entity at most, and that it tells at least.
RESIDUAL, GAIN = 1.0, 1.0
#: Texts that the entity's share of all documents weighs as, against those with the term beside it.
PRIOR = 1.0
#: Characters on either side of an identifier in which terms count as beside it.
WINDOW = 80

# A run of characters is tried once, from its start or where the last match ended.
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(_PATTERNS)
#: What a text must hold for a pattern to be tried.
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Scripts without spaces, and what else a word is made of; a single letter beside an apostrophe or dash names nobody.
_LOOSE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_LETTER = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{_LOOSE}]]"
_TERM = rf"[{_LOOSE}]++|{_LETTER}{{2,}}+"


def matches(text: Column, pattern: str, needs: str = "") -> Column:
    """Array of ``(value, start, end)``: leftmost matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<value:string,start:bigint,end:bigint>>")

    def placed(values: Column) -> Column:
        return let(
            F.split(text, pattern, -1),
            lambda pieces: let(
                before(
                    F.transform(values, lambda v, i: F.length(pieces[i]).cast("long") + F.length(v))
                ),
                lambda starts: F.transform(
                    values,
                    lambda v, i: let(
                        starts[i] + F.length(pieces[i]),
                        lambda s: F.struct(
                            v.alias("value"),
                            s.alias("start"),
                            (s + F.length(v)).alias("end"),
                        ),
                    ),
                ),
            ),
        )

    result = let(found, lambda values: F.when(F.size(values) > 0, placed(values)).otherwise(none))
    return F.when(F.contains(text, F.lit(needs)), result).otherwise(none) if needs else result


def _luhn(digits: Column) -> Column:
    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (i % 2 + 1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    name = F.lower(value) if kind == "email" else value if kind == "ip" else F.regexp_replace(value, "[^0-9]", "")
    return F.concat(F.lit(f"{kind}:"), name)


def _spans_of(kind: str, text: Column) -> Column:
    right = F.filter(matches(text, _PATTERNS[kind], _NEEDS[kind]), lambda m: _holds(kind, m["value"]))
    return F.transform(
        right,
        lambda m: F.struct(
            F.lit(kind).alias("kind"),
            m["start"].alias("start"),
            m["end"].alias("end"),
            _entity(kind, m["value"]).alias("entity"),
        ),
    )


def base_spans(text: Column) -> Column:
    """Array of ``(kind, start, end, entity)``, by kind as listed, then start."""
    return F.concat(*[_spans_of(kind, text) for kind in KINDS])


def blanked(text: Column, spans: Column) -> Column:
    """The text with spaces for every span, so that places stay."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        at, out = state["at"], state["out"]
        gap = F.substring(text, (at + 1).cast("int"), F.greatest(s["start"] - at, F.lit(0)).cast("int"))
        hole = F.repeat(F.lit(" "), (s["end"] - F.greatest(at, s["start"])).cast("int"))
        return F.struct(F.greatest(at, s["end"]).alias("at"), F.concat(out, gap, hole).alias("out"))

    places = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.aggregate(
        F.array_sort(places),
        start,
        step,
        lambda state: F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text))),
    )


def _pairs(run: Column) -> Column:
    """Places of the pairs of neighbours in a run, or of its one character."""
    return F.sequence(F.lit(0), F.greatest(F.length(run) - 2, F.lit(0)))


def terms(text: Column) -> Column:
    """Array of the terms of a text, in lower case."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))
    loose = F.flatten(
        F.transform(
            runs,
            lambda v: F.when(
                v.rlike(f"^[{_LOOSE}]"), F.transform(_pairs(v), lambda i: F.substring(v, i + 1, F.lit(2)))
            ).otherwise(F.array(v)),
        )
    )
    return F.array_distinct(F.when(text.rlike(f"[{_LOOSE}]"), loose).otherwise(runs))


def placed_terms(text: Column) -> Column:
    """Array of ``(term, start, end)``: every term of a text, with its place."""

    def place(value: Column, start: Column) -> Column:
        return F.struct(F.lower(value).alias("term"), start.alias("start"), (start + F.length(value)).alias("end"))

    def places(m: Column) -> Column:
        value, start = m["value"], m["start"]
        pairs = F.transform(_pairs(value), lambda i: place(F.substring(value, i + 1, F.lit(2)), start + i))
        return F.when(value.rlike(f"^[{_LOOSE}]"), pairs).otherwise(F.array(place(value, start)))

    return F.flatten(F.transform(matches(text, _TERM), places))


def beside(text: Column, spans: Column) -> Column:
    """Array of distinct ``(entity, term)``: terms of a blanked text within ``WINDOW`` of each span, none cut by its edge."""

    def around(s: Column) -> Column:
        near = F.least(s["start"], F.lit(WINDOW + 1))
        left = F.substring(text, (s["start"] - near + 1).cast("int"), near.cast("int"))
        right = F.substring(text, (s["end"] + 1).cast("int"), F.lit(WINDOW + 1))
        left = F.when(F.length(left) > WINDOW, F.regexp_replace(left, f"^{_LETTER}++", "")).otherwise(left)
        right = F.when(F.length(right) > WINDOW, F.regexp_replace(right, f"{_LETTER}++$", "")).otherwise(right)
        return F.transform(
            terms(F.concat(left, F.lit(" "), right)),
            lambda t: F.struct(s["entity"].alias("entity"), t.alias("term")),
        )

    return F.array_distinct(F.flatten(F.transform(spans, around)))


def found(docs: DataFrame, name: str = "pii") -> DataFrame:
    """``docs`` with a struct ``name``: the row's text hash and its base spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spans, rows = fresh(docs, "_spans"), docs
    rows = rows.withColumn(spans, base_spans(text))
    return rows.select(
        *docs.columns,
        F.struct(F.xxhash64(text).alias("hash"), F.col(spans).alias("spans")).alias(name),
    )


def disclosed(held: DataFrame, others: DataFrame) -> DataFrame:
    """``(entity, term, only)``: terms that disclose an entity; ``only`` if they stand nowhere else.

    ``held`` has ``spans``, ``beside`` and the blanked text of rows with
    identifiers, ``others`` the texts of all other rows.
    """
    docs = held.select("text").unionByName(others.select("text"))
    total = docs.count()
    entities = (
        held.select(F.explode(F.array_distinct(F.col("spans.entity"))).alias("entity"))
        .groupBy("entity")
        .agg(F.count("*").alias("n_c"))
    )
    pairs = (
        held.select("hash", F.explode("beside").alias("p"))
        .groupBy("p.entity", "p.term", "hash")
        .agg(F.count("*").alias("n"))
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("n_ct"), F.count("*").alias("texts"))
    )
    words = (
        docs.select(F.explode(terms(F.coalesce(F.col("text"), F.lit("")))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n_t"))
    )
    counted = pairs.join(words, "term").join(entities, "entity").withColumn("n", F.lit(total))
    share = F.col("n_c") / F.col("n")
    beside = (F.col("texts") * F.col("n_ct") / F.col("n_t") + PRIOR * share) / (F.col("texts") + PRIOR)
    return counted.where((beside >= 2.0**-RESIDUAL) & (beside >= share * 2.0**GAIN)).select("entity", "term", (F.col("n_t") <= F.col("n_ct")).alias("only"))


def term_spans(held: DataFrame, reveals: DataFrame) -> DataFrame:
    """``(doc_id, hash, extra)``: spans ``(start, end, only)`` by place, of the terms that reveal a row's own entities."""
    words = held.select("doc_id", "hash", F.explode(placed_terms(F.col("text"))).alias("t"))
    own = held.select(
        F.col("doc_id").alias("_of"), F.col("hash").alias("_by"), F.explode("spans.entity").alias("_entity")
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("hash") == F.col("_by"))
    return (
        words.select("doc_id", "hash", "t.*")
        .join(reveals, "term")
        .join(own, same & (F.col("entity") == F.col("_entity")), "left_semi")
        .groupBy("doc_id", "hash", "start", "end")
        .agg(F.max("only").alias("only"))
        .groupBy("doc_id", "hash")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "only"))).alias("extra"))
    )


def _held(rows: DataFrame, pii: str = "pii") -> DataFrame:
    hits = rows.where(F.size(f"{pii}.spans") > 0).select("doc_id", f"{pii}.hash", f"{pii}.spans", "text")
    return stored(
        hits.withColumn("text", blanked(F.col("text"), F.col("spans"))).withColumn(
            "beside", beside(F.col("text"), F.col("spans"))
        ),
        "pii-held",
    )


def _others(rows: DataFrame, pii: str = "pii") -> DataFrame:
    return rows.where(F.size(f"{pii}.spans") == 0).select("text")


_EXTRA = "array<struct<start:bigint,end:bigint,only:boolean>>"


def _joined(rows: DataFrame, extra: DataFrame, pii: str) -> tuple[DataFrame, Column]:
    """Rows with their term spans: a left join on (doc_id, text hash), null ids included."""
    key, mark, spans = (fresh(rows, x) for x in ("_id", "_hash", "_terms"))
    right = extra.select(F.col("doc_id").alias(key), F.col("hash").alias(mark), F.col("extra").alias(spans))
    match = rows["doc_id"].eqNullSafe(F.col(key)) & (rows[f"{pii}.hash"] == F.col(mark))
    return rows.join(right, match, "left"), F.coalesce(F.col(spans), F.array().cast(_EXTRA))


def all_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` for every row: base spans by kind and start, then ``term`` spans.

    A null text is empty and has no spans; repeated rows come back as often as
    they stand there with the same spans; a null doc_id is kept. Ties cannot
    occur: no two spans of one kind have the same place. An empty table gives no rows and
    other columns are not read.
    """
    only = docs.select("doc_id", "text")
    rows = stored(found(only), "pii-found")
    held = _held(rows)
    extra = term_spans(held, disclosed(held, _others(rows)))
    joined, own = _joined(rows, extra, "pii")
    terms = F.transform(
        own, lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end"))
    )
    base = F.transform(
        "pii.spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    return joined.select("doc_id", F.concat(base, terms).alias("spans"))


def _rewritten(text: Column, spans: Column) -> Column:
    """The text with every span ``(start, end, says)`` replaced; overlapping spans by the first's."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        at, out = state["at"], state["out"]
        gap = F.substring(text, (at + 1).cast("int"), (s["start"] - at).cast("int"))
        return F.struct(
            F.greatest(at, s["end"]).alias("at"),
            F.when(s["start"] >= at, F.concat(out, gap, s["says"])).otherwise(out).alias("out"),
        )

    return F.aggregate(
        F.array_sort(spans),
        start,
        step,
        lambda state: F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text))),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with identifiers replaced by their kind and disclosing terms generalised or removed.

    Texts without identifiers stay as they are, a null text stays null. A column
    ``n_chars`` follows the new text. All other columns pass through. Rows that repeat id and text are
    rewritten alike; rows without an id are told apart by their text. An empty table gives no rows.
    """
    pii = fresh(docs, "_pii")
    rows = stored(found(docs, pii), "pii-rows")
    held = _held(rows, pii)
    extra = term_spans(held, disclosed(held, _others(rows, pii)))
    hits, own = _joined(rows.where(F.size(f"{pii}.spans") > 0), extra, pii)
    says = F.create_map(*[F.lit(x) for k in KINDS for x in (k, f"[{k.upper()}]")])
    spans = F.concat(
        F.transform(
            f"{pii}.spans",
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), says[s["kind"]].alias("says")),
        ),
        F.transform(
            own,
            lambda t: F.struct(
                t["start"].alias("start"), t["end"].alias("end"),
                F.when(t["only"], "").otherwise("[TERM]").alias("says"),
            ),
        ),
    )
    changed = hits.withColumn("text", _rewritten(F.col("text"), spans))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    untouched = rows.where(F.size(f"{pii}.spans") == 0)
    return untouched.select(*docs.columns).unionByName(changed.select(*docs.columns))
