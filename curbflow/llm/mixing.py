"""Mixing sources to target weights: raking word weights, then calibrated sampling.

Words are summed per cell (source, language, topic), whatever the number of classes.
Iterative proportional fitting finds a factor for every class, so that the cells times
their three factors meet the targets of all dimensions: each step sums the cells over one
dimension, under the present factors of the others, and sets that dimension's factors to
target over sum. Cells and factors are stored tables; steps are joins and sums, so sources may
be as many as they like. Up to ``FEW`` cells, the same steps run on arrays instead of tables. A
document's sampling probability is its cell's product of factors, scaled so that the largest is
one; a hash of the document decides, so a repeated run keeps the same documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import fresh, stored
from curbflow.llm.pieces import word_lists

DIMENSIONS = ("source", "lang", "topic")
#: Without named targets a class aims at its share of the cells' words to this power: targets that can be met together.
TEMPER = 0.95
#: Rounds within which every class must come this close to its share of all words.
ROUNDS, TOLERANCE = 2000, 1e-8
#: Cells that are raked in arrays; more are raked by joins.
FEW = 100_000
SEED = 17
#: Bounds of the topic rule, as shares of a text's characters.
DIGITS, MARKS = 0.02, 0.05

_FIGURES, _MARKS = b"0123456789", b"#*$%&|<>{}[]=_/\\"
#: Classes: a name behind a sign, so that null and the unnamed are classes no table names.
_NULL, _OTHER = "", "*"
#: The least column set of each stage.
NAMES = ("n_words", "topic", "probability", "sampled")


def _register(text: bytes, n_words: int) -> str:
    n = max(1, len(text.decode()))
    lines = text.count(b"\n") + 1
    if not n_words:
        return "empty"
    if len(text) - len(text.translate(None, _FIGURES)) > DIGITS * n:
        return "figures"
    if len(text) - len(text.translate(None, _MARKS)) > MARKS * n:
        return "marks"
    return "list" if n < 60 * lines else "short" if n < 2000 else "long"


def _facts(texts: pd.Series) -> pd.DataFrame:
    words = [sum(map(len, word_lists(t))) for t in texts]
    return pd.DataFrame({"n": words, "topic": [_register(t, n) for t, n in zip(texts, words)]})


def _free(docs: DataFrame, names: list[str]) -> None:
    taken = {c.lower() for c in docs.columns}
    wrong = [n for n in names if n.lower() in taken]
    if wrong or len({n.lower() for n in names}) < len(names):
        raise ValueError(f"columns {wrong or names} are there already")


def weighed(docs: DataFrame, n_words: str, topic: str, draw: str) -> DataFrame:
    """``docs`` with three columns more: words of each text, its register, and a number in [0, 1) that decides.

    Words are cut at ASCII white space. The topic is the register of a text: figures, marks, lists, short or
    long prose; ``empty`` without any word. Null texts are empty; copies of a row draw alike.
    """
    _free(docs, [n_words, topic, draw])
    text = F.coalesce("text", F.lit(""))
    facts = F.pandas_udf(_facts, "n long, topic string")(text.cast("binary"))
    number = F.pmod(F.xxhash64("doc_id", text, F.lit(SEED)), F.lit(1 << 53)) / float(1 << 53)
    kept = docs.columns
    name = fresh(docs, "_facts")
    return docs.withColumn(name, facts).select(
        *kept, F.col(f"{name}.n").alias(n_words), F.col(f"{name}.topic").alias(topic), number.alias(draw)
    )


def _class(column: Column, named: dict[str, float] | None) -> Column:
    """A class by name; where targets are named all without one are a class together."""
    own = F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(_NULL))
    return F.when(column.isin(*named), own).otherwise(_OTHER) if named else own


def _aims(cells: DataFrame, dimension: str, named: dict[str, float] | None) -> DataFrame:
    """``(dimension, share, factor)``: what each class with words aims at, factors one."""
    present = cells.groupBy(dimension).agg(F.sum("share").alias("share"), F.sum("tempered").alias("tempered")).where("share > 0")
    if not named:
        return present.select(dimension, F.col("tempered").alias("share"), F.lit(1.0).alias("factor"))
    rows = [(f"={k}", float(v)) for k, v in named.items()]
    aims = cells.sparkSession.createDataFrame(rows, f"{dimension} string, aim double")
    joined = present.join(aims, dimension, "left")
    rest = F.col(dimension) == _OTHER  # it keeps its share, the named ones divide the others'
    totals = joined.agg(F.sum(F.when(rest, F.col("share"))).alias("rest"), F.sum(F.when(~rest, F.col("aim"))).alias("all")).first()
    others, total = totals["rest"] or 0.0, totals["all"] or 1.0
    share = F.when(rest, F.col("share")).otherwise(F.col("aim") / total * (1 - others))
    return joined.select(dimension, share.alias("share"), F.lit(1.0).alias("factor")).where("share > 0")


def _unmet(worst: float, rounds: int) -> ValueError:
    return ValueError(f"marginals are {worst:.2g} off after {rounds} rounds: the targets can't be met together")


def rake(
    cells: DataFrame, aims: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE, few: int = FEW
) -> dict[str, DataFrame]:
    """Per dimension ``(class, factor)``: the factors under which ``cells`` meet every share.

    ``cells`` has a class per dimension and ``share`` of all words, ``aims`` per dimension
    ``(class, share, factor)`` to start from; shares of a dimension sum to one. Classes without words need no factor.
    Targets that are not met within ``rounds``, as where cells they need are empty, raise. No cells give no factors.
    """
    some = cells.limit(few + 1).count()
    if not some:
        return {d: a.select(d, "factor") for d, a in aims.items()}
    return (_raked_arrays if some <= few else _raked_tables)(cells, aims, rounds, tolerance)


def _raked_arrays(cells: DataFrame, aims: dict[str, DataFrame], rounds: int, tolerance: float) -> dict[str, DataFrame]:
    rows = cells.select(*DIMENSIONS, "share").orderBy(*DIMENSIONS).collect()  # few
    weight = np.array([r["share"] for r in rows])
    names, index, share = {}, {}, {}
    for d in DIMENSIONS:
        goals = {r[d]: r["share"] for r in aims[d].select(d, "share").collect()}
        names[d], index[d] = np.unique([r[d] for r in rows], return_inverse=True)
        share[d] = np.array([goals.get(str(k), 0.0) for k in names[d]])
        if missing := sum(v for k, v in goals.items() if k not in set(names[d].tolist())):
            raise _unmet(missing, 0)
    factor = {d: np.ones(len(names[d])) for d in DIMENSIONS}
    for _ in range(rounds):
        worst = 0.0
        for d in DIMENSIONS:
            now = np.bincount(index[d], weight, len(names[d]))
            worst = max(worst, float(np.abs(now - share[d]).max()))
            step = np.divide(share[d], now, out=np.zeros_like(now), where=now > 0)
            factor[d] *= step
            weight = weight * step[index[d]]
        if worst < tolerance:
            return {
                d: cells.sparkSession.createDataFrame(
                    [(str(k), float(f)) for k, f in zip(names[d], factor[d])], f"{d} string, factor double"
                )
                for d in DIMENSIONS
            }
    raise _unmet(worst, rounds)


def _raked_tables(cells: DataFrame, aims: dict[str, DataFrame], rounds: int, tolerance: float) -> dict[str, DataFrame]:
    factors = {d: stored(a, "mixing-aims") for d, a in aims.items()}
    for _ in range(rounds):
        for d in DIMENSIONS:
            now, weight = cells, F.col("share")
            for other in DIMENSIONS:
                if other != d:
                    now = now.join(factors[other].select(other, F.col("factor").alias(f"by_{other}")), other)
                    weight = weight * F.col(f"by_{other}")
            sums = now.groupBy(d).agg(F.sum(weight).alias("sum"))
            off = F.coalesce(F.abs(F.col("sum") * F.col("factor") - F.col("share")), F.col("share"))
            factors[d] = stored(
                factors[d].join(sums, d, "left").select(d, "share", (F.col("share") / F.col("sum")).alias("factor"), off.alias("off")),
                "mixing-factors",
            )
        offs = [f.select("off") for f in factors.values()]
        worst = offs[0].union(offs[1]).union(offs[2]).agg(F.max("off")).first()[0]
        if worst < tolerance:
            return {d: f.select(d, "factor") for d, f in factors.items()}
    raise _unmet(worst, rounds)


def chances(
    rows: DataFrame, classes: dict[str, Column], n_words: str, targets: dict[str, dict[str, float]] | None = None, few: int = FEW
) -> DataFrame:
    """``(source, lang, topic, probability)`` per cell of classes."""
    grid = rows.select(F.col(n_words).cast("double").alias("_n"), *(c.alias(d) for d, c in classes.items()))
    sums = stored(grid.groupBy(*DIMENSIONS).agg(F.sum("_n").alias("words")), "mixing-cells")
    power = F.when(F.col("words") > 0, F.pow("words", F.lit(TEMPER))).otherwise(0.0)
    total = sums.agg(F.sum("words"), F.sum(power)).first()
    cells = sums.select(
        *DIMENSIONS, (F.col("words") / (total[0] or 1.0)).alias("share"), (power / (total[1] or 1.0)).alias("tempered")
    )
    factors = rake(cells.where("share > 0"), {d: _aims(cells, d, (targets or {}).get(d)) for d in DIMENSIONS}, few=few)
    ratio = F.lit(1.0)
    for d in DIMENSIONS:
        cells = cells.join(factors[d].select(d, F.col("factor").alias(f"by_{d}")), d, "left")
        # classes that hold words but are given no share go; classes without words stay as they are
        ratio = ratio * F.coalesce(f"by_{d}", F.when(F.col("share") > 0, 0.0).otherwise(1.0))
    known = stored(cells.select(*DIMENSIONS, "share", ratio.alias("ratio")), "mixing-ratios")
    most = known.where("share > 0").agg(F.max("ratio")).first()[0] or 1.0
    return known.select(*DIMENSIONS, F.least(F.lit(1.0), F.round(F.col("ratio") / most, 12)).alias("probability"))


def decided(
    rows: DataFrame, n_words: str, topic: str, draw: str, probability: str, sampled: str,
    targets: dict[str, dict[str, float]] | None = None, few: int = FEW,
) -> DataFrame:
    """Rows of :func:`weighed` with the probability of each and whether it is drawn."""
    _free(rows, [probability, sampled])
    classes = {d: _class(F.col(topic if d == "topic" else d), (targets or {}).get(d)) for d in DIMENSIONS}
    found = chances(rows, classes, n_words, targets, few)
    names: list[str] = []
    for d in (*DIMENSIONS, "chance"):
        name = fresh(rows, f"_{d}")
        names.append(name)
    cells = found.toDF(*names)
    met = [classes[d] == F.col(n) for d, n in zip(DIMENSIONS, names)]
    return (
        rows.join(cells, met[0] & met[1] & met[2], "left")
        .withColumn(probability, F.col(names[3]))
        .withColumn(sampled, F.col(draw) < F.col(names[3]))
        .drop(*names)
    )


def calibrated(
    docs: DataFrame, names: dict[str, str], targets: dict[str, dict[str, float]] | None = None, few: int = FEW
) -> DataFrame:
    """``docs`` with columns for words, topic, probability and decision, named by ``names``.

    ``names`` maps ``n_words``, ``topic``, ``probability``, ``sampled`` to column names; one that ``docs``
    has raises. ``targets`` names shares for classes of a dimension: they divide what the classes without a target
    leave, which keep their share together. In a dimension without targets every class, null too, aims at its
    words under the tempered cells. A text without words weighs nothing and takes its cell's probability. A
    repeated row gets the decision of its copy. An empty table gives no rows; other columns pass through.
    """
    n_words, topic, probability, sampled = (names[k] for k in NAMES)
    draw = fresh(docs, "_draw")
    rows = weighed(docs, n_words, topic, draw)
    return decided(rows, n_words, topic, draw, probability, sampled, targets, few).drop(draw)


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """The sampled documents, with their columns as they were; nulls, empties, ties and repeats as in :func:`calibrated`."""
    names = {k: fresh(docs, f"_{k}") for k in NAMES}
    return calibrated(docs, names, targets).where(F.col(names["sampled"])).select(*docs.columns)
