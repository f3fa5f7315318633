"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities.

Only DataFrame functions. Tokens are summed by cell (source, language, topic); rounds of raking scale the cells until their
marginals are the targets; each document of a cell is kept with the cell's probability, decided by a hash of its id, so
a repeated run keeps the same documents. Cells are far fewer than documents: their number is that of the combinations of values,
whatever the number of rows. A round is three window sums over them in one partition, so rounds exchange nothing, and the driver
plans one stage for all windows of a plan; to deal a few hundred cells by each side in turn took it a stage a window.

No cell gives more than its tokens. Targets are first made reachable: a value whose target exceeds its tokens gives all of
them, the others share what is left in proportion. Then every cell has a pull, and weighs its pull or its room, whichever is
less; a round scales pulls by target over weight, so a full cell stays full and the others of its value make up for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm import common

SIDES = ("source", "lang", "topic")
#: Rounds of raking, share of all tokens to keep, power that flattens shares of tokens to targets, least weight of a cell.
ROUNDS, BUDGET, FLATTEN = 16, 0.6, 0.7
UNKNOWN = "unknown"


def tokens(text: Column) -> Column:
    """Words of a text, at least 1, so that no document weighs nothing."""
    return F.greatest(F.regexp_count(text, F.lit(r"[^\x20\t\n\x0b\f\r]+")), F.lit(1)).cast("bigint")


def topic(text: Column) -> Column:
    """The register of a text by plain marks: table, shouting, list, question, note, article."""
    return (
        F.when(text.contains(" | "), "table").when(text.contains("!!"), "shouting").when(text.contains("\n- ") | text.contains("\n* "), "list")
        .when(text.contains("?"), "question").when(F.length(text) < 600, "note").otherwise("article")
    )


def described(documents: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic and tokens; a null source or language is its own value."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = [F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias(c) for c in ("source", "lang")]
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), *names, topic(text).alias("topic"), tokens(text).alias("tokens"))


def flattened(cells: DataFrame, side: str, power: float = FLATTEN) -> DataFrame:
    """Target shares of one side: its shares of tokens to a power, which lifts small values."""
    sums = cells.groupBy(side).agg(F.sum("tokens").cast("double").alias("sum"))
    weights = sums.select(side, F.pow("sum", F.lit(power)).alias("weight"))
    # One row, so the join is as long as the values of the side.
    total = weights.agg(F.sum("weight").alias("total"))
    return weights.join(F.broadcast(total), F.lit(True)).select(side, (F.col("weight") / F.col("total")).alias("target"))


def reachable(cells: DataFrame, side: str, target: DataFrame, budget: float = BUDGET, rounds: int = ROUNDS) -> DataFrame:
    """Targets of one side that its tokens can meet: (side, target), with sum 1 if the budget is at most 1.

    The values of one side are summed in one window; they are names of sources, languages or topics, not documents.
    """
    room = cells.coalesce(1).groupBy(side).agg(F.sum("tokens").cast("double").alias("tokens"))
    everything = Window.partitionBy(F.lit(side))
    now = room.join(F.broadcast(target.select(side, F.col("target").cast("double").alias("pull"))), side)
    now = now.withColumn("room", F.col("tokens") / (F.sum("tokens").over(everything) * budget))
    # From below, every turn comes nearer to the one factor at which the values that are not full take all that is left.
    for _ in range(rounds):
        now = now.withColumn("pull", F.col("pull") / F.sum(F.least("pull", "room")).over(everything))
    return now.select(side, F.least("pull", "room").alias("target"))


def raked(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, budget: float | None = None) -> DataFrame:
    """Cells with `weight`, whose sums by each side are the targets as nearly as the cells allow; a value without target keeps none.

    With a budget, no weight exceeds the cell's room: the share of the kept tokens that all its tokens make. Without one, cells have no bound.
    """
    now = cells = cells.coalesce(1)
    for side in SIDES:
        now = now.join(F.broadcast(targets[side].select(side, F.col("target").alias(f"to_{side}"))), side, "left")
    now = now.na.fill(0.0, [f"to_{side}" for side in SIDES])
    # One row, so the join is as long as the cells.
    everything = cells.agg(F.sum("tokens").cast("double").alias("all_tokens"))
    room = F.lit(float("inf")) if budget is None else F.col("tokens") / (F.col("all_tokens") * budget)
    now = now.join(F.broadcast(everything), F.lit(True)).withColumns({"room": room, "pull": F.col("tokens") / F.col("all_tokens")}).drop("all_tokens")
    weight = F.least("pull", "room")
    for turn in range(rounds):
        for side in SIDES:
            total = F.sum(weight).over(Window.partitionBy(side))
            now = now.withColumn("pull", F.when(total > 0, F.col("pull") * F.col(f"to_{side}") / total).otherwise(0.0))
        if turn % 4 == 3:
            now = common.keep(now, "mixing-cells").coalesce(1)
    return now.select(*SIDES, "tokens", weight.alias("weight"))


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) from the id alone; a null id draws 0 and is kept wherever its cell is."""
    return F.coalesce(F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), doc_id.cast("string"))), 1, 8), 16, 10).cast("double") / 2**32, F.lit(0.0))


def calibrated(documents: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """Cells with weight and probability: of a cell's tokens, the share that the mix takes, never above 1."""
    return calibrated_rows(described(documents), targets, budget)


def calibrated_rows(rows: DataFrame, targets: dict[str, DataFrame] | None, budget: float) -> DataFrame:
    cells = common.keep(rows.groupBy(*SIDES).agg(F.sum("tokens").alias("tokens")), "mixing-sums").coalesce(1)
    aims = targets or {side: flattened(cells, side) for side in SIDES}
    aims = {side: common.keep(reachable(cells, side, aims[side], budget), "mixing-targets") for side in SIDES}
    out = raked(cells, aims, budget=budget)
    everything = cells.agg(F.sum("tokens").cast("double").alias("all_tokens"))
    wanted = F.col("weight") * budget * F.col("all_tokens") / F.col("tokens")
    # One row, so each side of this join is as long as the cells.
    return out.join(F.broadcast(everything), F.lit(True)).select(*SIDES, F.round("weight", 9).alias("weight"), F.round(wanted, 6).alias("probability"))


def mixed(documents: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight, probability and kept of each row of `documents` (doc_id, text, source, lang).

    `targets` gives (value, target) for source, lang and topic; without it each side's shares of tokens are flattened. A null
    source or language counts as "unknown", a null text as empty with one token. Repeated rows are decided alike. An
    empty table gives an empty result. A value whose target exceeds its tokens is kept whole and the other values of its side share
    the rest; so is a full cell, and the other cells of its values make up for it. Nothing is taken twice.
    """
    rows = common.keep(described(documents), "mixing-rows")
    out = rows.join(calibrated_rows(rows, targets, budget), [*SIDES], "left")
    return out.select("doc_id", *SIDES, "tokens", "weight", "probability", (draw(F.col("doc_id")) < F.col("probability")).alias("kept"))


def sampled(documents: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """The documents that the mix keeps, with all their columns."""
    cells = calibrated(documents, targets, budget).select(*[F.col(s).alias(f"mix_{s}") for s in SIDES], "probability")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    same = [F.col("mix_source") == F.coalesce(F.col("source").cast("string"), F.lit(UNKNOWN)), F.col("mix_lang") == F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)), F.col("mix_topic") == topic(text)]
    kept = documents.join(cells.withColumnRenamed("probability", "mix_probability"), same[0] & same[1] & same[2])
    return kept.where(draw(F.col("doc_id")) < F.col("mix_probability")).select(*[documents[c] for c in documents.columns])
