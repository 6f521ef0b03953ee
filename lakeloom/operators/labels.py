"""Ground truth: five technical score tables merged, label sources by precedence, and the gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.maths import from_unit, gaussian_bins, vote_score

#: Largest lookup that is broadcast (a row of it is at most ten numbers and a name, so some 30 MB); beyond it Spark picks
#: the join.
BROADCAST_ROWS = 200_000


def lookup(df: DataFrame) -> DataFrame:
    """The frame with a broadcast hint if its row count is under the bound."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def last_wins(tables: list[DataFrame], key: str = "file", value: str = "score", order: str = "row_no") -> DataFrame:
    """Keyed union of tables: a later table beats an earlier one, and a later row an earlier one of its table."""
    ranked = [t.select(F.lower(key).alias(key), F.col(value).cast("double").alias(value), F.lit(i).alias("_table"), F.col(order).alias("_row")) for i, t in enumerate(tables)]
    union = reduce(DataFrame.unionByName, ranked)
    return union.groupBy(key).agg(F.max_by(value, F.struct("_table", "_row")).alias(value))


def attach_scores(
    samples: DataFrame,
    slug: str,
    file: str,
    stem: str,
    votes: DataFrame | None = None,
    aadb: DataFrame | None = None,
    technical: DataFrame | None = None,
    row_score: Column | None = None,
    normalize: bool = True,
) -> DataFrame:
    """Adds ``score``, ``probs`` and ``gt_found``.

    Precedence goes by the slug, not by which table has a hit: ``ava`` (votes by the stem as a number), ``aadb``
    (score by exact file name), ``laion`` (the row's own score, else 6.5), otherwise the technical table by lower-cased
    file name. ``votes``: image_num, votes array; ``aadb``, ``technical``: file, score.
    """
    key = F.lower(F.col(slug))
    out = samples
    if votes is not None:
        v = lookup(votes.select(F.col("image_num").cast("long").alias("_image"), F.col("votes").alias("_votes")))
        out = out.join(v, F.expr(f"try_cast({stem} as bigint)") == v["_image"], "left").drop("_image")
    else:
        out = out.withColumn("_votes", F.lit(None).cast("array<double>"))
    for name, table, on in (("_aadb", aadb, F.col(file)), ("_tech", technical, F.lower(F.col(file)))):
        if table is not None:
            t = lookup(table.select(F.col("file").alias(f"{name}_file"), F.col("score").cast("double").alias(name)))
            out = out.join(t, on == t[f"{name}_file"], "left").drop(f"{name}_file")
        else:
            out = out.withColumn(name, F.lit(None).cast("double"))
    own = F.coalesce(row_score, F.lit(6.5)) if row_score is not None else F.lit(6.5)
    use_ava = F.contains(key, F.lit("ava")) & F.lit(votes is not None)
    use_aadb = F.contains(key, F.lit("aadb")) & F.lit(aadb is not None)
    use_laion = F.contains(key, F.lit("laion"))
    score = F.when(use_ava, vote_score(F.col("_votes"), normalize)).when(use_aadb, from_unit(F.col("_aadb"))).when(use_laion, own).otherwise(F.col("_tech"))
    out = out.withColumn("score", score)
    voted = F.transform("_votes", lambda v: F.try_divide(v, F.aggregate("_votes", F.lit(0.0), lambda s, y: s + y))) if normalize else F.col("_votes")
    probs = F.when(F.col("score").isNull(), F.lit(None)).when(use_ava, voted).otherwise(gaussian_bins(F.col("score")))
    return out.withColumn("probs", probs).withColumn("gt_found", F.col("score").isNotNull()).drop("_votes", "_aadb", "_tech")


def gate(df: DataFrame, slug: str, threshold: float = 4.0, strict: bool = False, vetting: str = "literal") -> DataFrame:
    """Rows that pass the strict ground-truth gate and the quality threshold (equality passes).

    A row without a score counts as 1.0 (``literal``) or passes without one (``pass_through``).
    """
    if strict:
        df = df.where(F.col("score").isNotNull() | F.contains(F.lower(F.col(slug)), F.lit("laion")))
    return df.where(F.coalesce(F.col("score"), F.lit(1.0 if vetting == "literal" else threshold)) >= threshold)


def pixel_filters(width: Column, height: Column, dark: Column, black_threshold: float = 0.1, least: int = 128) -> Column:
    """Keeps images of at least ``least`` pixels a side whose share of dark pixels is not above the limit."""
    return (width >= least) & (height >= least) & (dark <= 1 - black_threshold)
