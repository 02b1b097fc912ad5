"""Mixing sources to target weights, in DataFrame functions only.

Every source gets a budget: its share of the whole by weight, but no more than ``most`` times its own size; what a
full source cannot take is shared again by weight among the others.  A budget of 2.3 times the source is two complete
epochs and 0.3 of a third one.  The fractional epoch is an Efraimidis-Spirakis sample: each document draws the
exponential key ``-ln(u) / quality``, the source is ordered by key, and a running sum of sizes is cut at the budget.

The running sum never orders a source in one task.  The keys of a source with n documents are cut into about sqrt(n)
ranges; sums per range (a small table) give each range its start, and only the rows of one range are ordered together.
A source with a third of all rows is so spread over sqrt(n) groups, and both levels grow with the square root.  The
one window without such a split runs over the table of sources, which has one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.tables import stored, word_count

#: Characters that speak against a text's quality; fixed values of this operator.
MARKUP = "#*$%&|<>!"


def quality_weight(text: Column) -> Column:
    """1 for plain prose, down to 0.05 where a tenth of the characters are markup signs; 0.05 for null and empty."""
    plain = F.length(F.translate(text, MARKUP, ""))
    share = 1 - plain / F.nullif(F.length(text), F.lit(0))
    return F.coalesce(F.greatest(F.lit(0.05), 1 - 10 * share), F.lit(0.05))


def uniform(ident: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the id and the seed alone; ids that are null share one number."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def budgets(sources: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """``source, source_size`` plus ``target``: shares by weight, filled up to ``most`` times the source.

    Weights repeat over the sources in code point order, null last.  A source is full exactly if its limit per weight
    is below the common level, so in the order of limit per weight the full ones come first, and the level is what is
    left after them divided by the weights after them.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.select(
        "source", "source_size", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1).alias("w")
    ).withColumn("limit", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("w").over(onward)
    own = ranked.withColumn("own_level", level)
    # the first source that is not full sets the level of all from there on
    first = F.min(F.when(F.col("limit") >= F.col("own_level") * F.col("w"), F.struct(F.col("limit") / F.col("w"), "own_level")))
    common = own.withColumn("common", first.over(whole)["own_level"])
    return common.select("source", "source_size", F.round(F.least(F.col("limit"), F.col("common") * F.col("w")), 6).alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    most: float = 3.0,
    seed: int = 7,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    whole_documents: bool = False,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, source, size, source_size, target, taken, copies``.

    ``taken`` counts words, repeats included.  By default the last document of a fractional epoch gives only the words
    that still fit, so a source meets its target to one word.  With ``whole_documents`` that document is taken whole if
    this comes nearer to the target, else not at all; ``copies`` is how often a document is taken then.

    Null and empty texts have size 0 and are never taken; rows with a null source form a source of their own; a source
    of size 0 has target 0; equal keys are ordered by id and size, so rows that are equal in both may change places but
    not the result.  An empty table gives an empty one.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        (-F.log(uniform(F.col(key), seed)) / quality_weight(F.col(text))).alias("draw"),
    )
    rows = stored(rows, "mix-rows")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = budgets(per_source.select("source", "source_size"), weights, most)
    plan = stored(
        targets.alias("t")
        .join(per_source.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")))
        .select("t.source", "t.source_size", "t.target", "s.n")
        .withColumn("epochs", F.floor(F.least(F.lit(most), F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0)))))
        .withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
        .withColumn("parts", F.ceil(F.sqrt("n"))),
        "mix-plan",
    )
    # exp(-draw) lies in (0, 1) and falls with the draw: equal steps of it make ranges of like size
    placed = (
        rows.alias("r")
        .join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
        .select("r.*", "p.source_size", "p.target", "p.epochs", "p.rest", F.floor((1 - F.exp(-F.col("draw"))) * F.col("parts")).alias("part"))
    )
    sums = placed.groupBy("source", "part").agg(F.sum("size").alias("in_part"))
    starts = sums.select(
        "source",
        "part",
        F.coalesce(
            F.sum("in_part").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("start"),
    )
    inside = Window.partitionBy("source", "part").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = (
        placed.alias("d")
        .join(starts.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.part") == F.col("b.part")))
        .select("d.*", "b.start")
        .withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    )
    fits = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    if whole_documents:
        fits = F.when(2 * fits >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("epochs") + F.when(fits > 0, 1).otherwise(0))
    return summed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + fits).cast("long").alias("taken"),
        copies.cast("int").alias("copies"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, whole, with its own columns.

    Documents are told apart by id; rows that share an id are taken as often as the first of them in the order of size.
    """
    key = options.get("key", "doc_id")
    copies = mix(docs, whole_documents=True, **options).groupBy("doc_id").agg(F.max("copies").alias("n"))
    taken = copies.where("n > 0").select(F.col("doc_id").alias("taken_id"), "n")
    names = [F.col(f"d.`{c}`") for c in docs.columns]
    joined = docs.alias("d").join(taken.alias("t"), F.col(f"d.`{key}`").eqNullSafe(F.col("t.taken_id")))
    times = F.explode(F.array_repeat(F.lit(1), F.col("t.n")))
    return joined.select(*names, times.alias("t_nth")).drop("t_nth")
