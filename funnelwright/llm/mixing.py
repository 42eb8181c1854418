"""Mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelwright.llm.common import Scratch, words

WEIGHTS = (5, 2, 1)  # of the sources by name, repeating
MOST_EPOCHS = 3
DOCS_PER_SLICE = 5_000
LEAST_WEIGHT = 0.001  # of a document whose quality is given


def quality_weight(tokens: Column) -> Column:
    """0.25 to 1: how little a text repeats its words."""
    n = F.size(tokens)
    return F.when(n > 0, 0.25 + 0.75 * F.size(F.array_distinct(tokens)) / n).otherwise(F.lit(0.25))


def _sized(docs: DataFrame, text: str, doc_id: str, quality: str | None = None) -> DataFrame:
    """``docs`` with _size, _weight and a fingerprint _print from which its random number follows.

    The weight is the column ``quality`` where that is given, raised to ``LEAST_WEIGHT`` (also from NULL and NaN), so that
    no document's key is infinite.
    """
    tokens = words(F.col(text))
    weight = quality_weight(F.col("_tokens"))
    if quality is not None:
        given = F.nanvl(F.col(quality).cast("double"), F.lit(0.0))
        weight = F.greatest(F.coalesce(given, F.lit(0.0)), F.lit(LEAST_WEIGHT))
    identity = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))
    out = docs.withColumn("_tokens", tokens)
    return out.withColumns(
        {"_size": F.size("_tokens").cast("long"), "_weight": weight, "_print": F.md5(identity)}
    ).drop("_tokens")


def _key() -> Column:
    """An exponential variable of rate _weight: rows of small keys come first, heavy ones more often."""
    uniform = (F.conv(F.substring("_print", 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(2**52))
    return -F.ln(uniform) / F.col("_weight")


def targets(sizes: DataFrame, share: float = 1.0, weights: Sequence[float] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size), a row per source, with ``target``.

    Sources by code point, NULL last, have the ``weights`` in turn. ``share`` of all sizes is dealt by weight; no target
    exceeds ``most_epochs`` times its source, and what is above goes to the others by weight. In order of limit / weight
    the sources at their limit come first, so one pass finds the common level: that of the first source that stays
    below its limit. The table has a row per source, so one task orders it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size").cast("double") * most_epochs)
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(whole).cast("double") * share
    leveled = ranked.withColumn("level", (total - before) / after)
    fits = F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", F.col("source").isNull().alias("last"), "source", "level"))
    leveled = leveled.withColumn("level", F.min(fits).over(whole)["level"])
    target = F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap"))
    return leveled.select("source", "source_size", target.alias("target"))


def mix_plan(sized: DataFrame, source: str, scratch: Scratch, share: float, weights: Sequence[float], most_epochs: int) -> DataFrame:
    """A row per source: source, source_size, target, ``epochs`` (complete ones), and the last key of the further sample.

    After the complete epochs, rows are taken by key until the rest of the target is met as closely as whole documents
    allow. A source's rows are cut into slices of about ``DOCS_PER_SLICE`` by key; sizes are summed within slices, and
    the slices' sums before them. So a source may hold any share of the rows.
    """
    units = sized.withColumn("key", _key()).groupBy(F.col(source).alias("source"), "key", "_print")
    units = scratch.store(units.agg(F.sum("_size").alias("size"), F.sum("_weight").alias("w"), F.count("*").alias("n")), "units")
    sums = units.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_units"), (F.sum("w") / F.sum("n")).alias("rate")
    )
    sums = scratch.store(sums, "sources")
    goals = targets(sums.select("source", "source_size"), share, weights, most_epochs)
    epochs = F.floor(F.try_divide(F.col("target"), F.col("source_size")))
    goals = goals.withColumn("epochs", F.coalesce(epochs, F.lit(0)))
    goals = scratch.store(goals.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")

    slices = F.ceil(F.col("n_units") / DOCS_PER_SLICE)
    spread = (1 - F.exp(-F.col("key") * F.col("rate"))) * slices
    shapes = sums.select(F.col("source").alias("name"), "n_units", "rate")
    placed = units.join(shapes, F.col("source").eqNullSafe(F.col("name")))
    placed = placed.select("source", "key", "_print", "size", F.least(F.floor(spread), slices - 1).cast("long").alias("slice"))
    within = Window.partitionBy("source", "slice").orderBy("key", "_print").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("source", "slice").agg(F.sum("size").alias("held"))
    offsets = offsets.select(
        F.col("source").alias("name"), F.col("slice").alias("part"), F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("offset")
    )
    summed = placed.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    summed = summed.join(offsets, F.col("source").eqNullSafe(F.col("name")) & (F.col("slice") == F.col("part"))).drop("name")
    rests = goals.select(F.col("source").alias("name"), "rest")
    taken = summed.join(rests, F.col("source").eqNullSafe(F.col("name")))
    taken = taken.filter(F.col("offset") + F.col("before") + F.col("size") / 2 <= F.col("rest"))
    last = taken.groupBy("source").agg(F.max(F.struct("key", "_print")).alias("last")).select(F.col("source").alias("name"), "last")
    plan = goals.join(last, F.col("source").eqNullSafe(F.col("name")), "left").drop("name", "rest")
    return scratch.store(plan, "plan")


def _with_turns(sized: DataFrame, plan: DataFrame, source: str) -> DataFrame:
    """``sized`` with _turns: how often the mix takes each row. The plan has a row per source."""
    rows = plan.select(F.col("source").alias("_plan_of"), *[F.col(c).alias(f"_{c}") for c in ("source_size", "target", "epochs", "last")])
    joined = sized.withColumn("_key", _key()).join(rows, F.col(source).eqNullSafe(F.col("_plan_of")), "left")
    extra = F.coalesce(F.struct(F.col("_key").alias("key"), "_print") <= F.col("_last"), F.lit(False))
    return joined.withColumn("_turns", (F.col("_epochs") + extra.cast("long")).cast("int"))


def mix_sizes(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", share: float = 1.0,
    weights: Sequence[float] = WEIGHTS, most_epochs: int = MOST_EPOCHS, quality: str | None = None,
) -> DataFrame:
    """What the mix takes of each row of ``docs``: doc_id, size, source_size, target, taken, source.

    ``size`` is the number of words; ``taken`` counts repetitions. The random numbers follow from doc_id and text, so
    reruns agree, however the rows are dealt out. ``quality`` names a column of ``docs`` with weights, such as the scores of
    ``score_quality``; without it the weight is told by how little a text repeats its words.

    Defined cases: NULL and empty texts have size 0 and take nothing. A NULL source is a source of its own, the last.
    Rows that agree in source, doc_id and text are taken together; where the target ends among them, they are in if at
    least half of them fit. Ties of keys go by fingerprint. A source without words has target 0. Extra columns are
    ignored. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    given = [] if quality is None else [F.col(quality).alias("quality")]
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"), *given)
    sized = scratch.store(_sized(own, "text", "doc_id", quality and "quality").drop("text", "quality"), "sized")
    plan = mix_plan(sized, "source", scratch, share, weights, most_epochs)
    out = _with_turns(sized, plan, "source")
    return out.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_size") * F.col("_turns")).alias("taken"), "source",
    )


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", share: float = 1.0,
    weights: Sequence[float] = WEIGHTS, most_epochs: int = MOST_EPOCHS, quality: str | None = None,
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix_sizes`` takes it. Texts are read again and never shuffled.

    Rows of size 0 are taken as often as the complete epochs say. Columns of any name stay as they are; see ``mix_sizes`` for
    NULLs, ties, repeated rows and empty tables.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    given = [] if quality is None else [F.col(quality).alias("quality")]
    boxed = docs.select(
        F.struct("*").alias("_row"), F.col(text).alias("text"), F.col(source).alias("source"), F.col(doc_id).alias("doc_id"), *given
    )
    sized = _sized(boxed, "text", "doc_id", quality and "quality")
    plan = mix_plan(sized.select("source", "_size", "_weight", "_print"), "source", scratch, share, weights, most_epochs)
    turns = _with_turns(sized, plan, "source").filter("_turns > 0")
    return turns.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_turns")))).select("_row.*")
