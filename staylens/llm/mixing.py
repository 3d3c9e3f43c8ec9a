"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted by cell (source x language x topic, as far as the targets name them). Raking
scales the cells' weights to each target margin in turn, sweep after sweep, and never above the
tokens that a cell has. A document's inclusion probability is its cell's raked weight over the
cell's tokens; as long as no cell is exhausted, the expected token shares of the sample are the
targets. Each document is drawn on its own by a
hash of its key, so the sample doesn't depend on partitions and a retried task draws the same.

Only DataFrame expressions are used. The number of cells is bounded by the targets (values that
they don't name share one category), so raking runs on one small partition without more exchanges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import WORD, staged, text_or_empty, unique_name

SWEEPS = 12
#: Share of all tokens that the sample is to have.
KEEP_SHARE = 0.4
SEED = "mix-1"
#: The category of all values that a margin doesn't name, NULL included.
REST = "*"

#: Columns that ``with_probability`` adds.
RESULTS = ["n_tokens", "probability", "kept"]

Targets = dict[str, dict[str, float]]


def category(value: Column, shares: dict[str, float]) -> Column:
    return F.when(value.isin(list(shares)), value).otherwise(F.lit(REST))


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the key alone: 52 bits of its md5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def _target(cat: str, shares: dict[str, float]) -> Column:
    """Target share of a category; what the named ones leave goes to REST."""
    rest = max(0.0, 1.0 - sum(shares.values()))
    out = F.lit(rest)
    for value, share in shares.items():
        out = F.when(F.col(cat) == value, F.lit(float(share))).otherwise(out)
    return out


def rake(
    cells: DataFrame, targets: Targets, tokens: str = "tokens", share: float = KEEP_SHARE, sweeps: int = SWEEPS
) -> DataFrame:
    """``cells`` (one row per combination of the target columns) with ``weight``: the tokens to keep
    of each cell, ``share`` of all, raked to the targets and never more than the cell has. Targets of
    categories without tokens go to the others in proportion."""
    out = cells.where(F.col(tokens) > 0).repartition(1).withColumn("weight", F.col(tokens).cast("double"))
    wanted = F.sum(tokens).over(Window.partitionBy(F.lit(1))) * F.lit(share)
    out = out.withColumn("_wanted", wanted)
    for dim, shares in targets.items():
        out = out.withColumn(f"_t_{dim}", _target(dim, shares))
    for _ in range(sweeps):
        for dim in targets:
            now = F.sum("weight").over(Window.partitionBy(dim))
            raked = F.when(now > 0, F.col("weight") * F.col(f"_t_{dim}") * F.col("_wanted") / now).otherwise(0.0)
            out = out.withColumn("weight", F.least(raked, F.col(tokens).cast("double")))
    return out.drop("_wanted", *[f"_t_{d}" for d in targets])


def with_probability(
    docs: DataFrame,
    targets: Targets,
    *,
    values: dict[str, Column] | None = None,
    text: str = "text",
    key: str = "doc_id",
    share: float = KEEP_SHARE,
    sweeps: int = SWEEPS,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with n_tokens (words of the text; 0 for NULL), probability and kept.

    ``targets`` gives the shares of each margin; ``values`` an expression for a margin that is no
    column. A cell without tokens or with a target of 0 has probability 0. Rows that repeat a key
    are kept or dropped together; a NULL key counts as the empty string. Columns n_tokens,
    probability and kept of ``docs`` are replaced."""
    values = values or {}
    taken = [c for c in docs.columns if c.lower() not in RESULTS]
    cat = {}
    for dim in targets:
        cat[dim] = unique_name(taken + list(cat.values()), f"_{dim}_cat")
    counted = docs.select(
        *[F.col(f"`{c}`") for c in taken],
        F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("n_tokens"),
        *[category(values.get(d, F.col(d)).cast("string"), targets[d]).alias(c) for d, c in cat.items()],
    )
    cells = counted.groupBy(*cat.values()).agg(F.sum("n_tokens").alias("tokens"))
    raked = staged(
        rake(cells.toDF(*targets, "tokens"), targets, share=share, sweeps=sweeps).select(
            *[F.col(d).alias(c) for d, c in cat.items()], (F.col("weight") / F.col("tokens")).alias("_p")
        ),
        "cells",
    )
    # one row for each cell of the targets, whatever the size of docs
    joined = counted.join(F.broadcast(raked), list(cat.values()), "left")
    probability = F.coalesce(F.col("_p"), F.lit(0.0))
    return joined.select(
        *[F.col(f"`{c}`") for c in taken],
        "n_tokens",
        probability.alias("probability"),
        (uniform(F.col(key), seed) < probability).alias("kept"),
    )
