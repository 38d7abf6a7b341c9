"""Mixing sources to target weights by weighted fair queueing.

Every document is an entry in its source's queue, in a shuffled order. Its virtual
finish time is the source's words up to and with it, divided by the source's weight;
a source may be queued more than once. All entries are sorted by finish time over the
whole corpus and the list is cut at the total budget. A source whose queue runs out
leaves the rest of the budget to the others by weight, so the cut gives each source
its water-filled target to within one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import running_totals, small_side, text_of, words
from martlet.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def source_targets(
    slim: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """One row for each source: its size, weight, target and the words before it.

    The target is the least of ``repeats`` times the source and weight times a common
    level. For any set of capped sources, (budget - their caps) / (weights of the
    rest) is a level at most the true one, and the true one is reached with the
    sources that cap first; so the level is the maximum over prefixes in that order.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))
    )
    earlier = by_name.rowsBetween(Window.unboundedPreceding, -1)
    cap = F.lit(float(repeats)) * F.col("source_size")
    by_end = Window.orderBy(cap / F.col("weight"), "rank")
    rest = by_end.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    over_all = Window.orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    capped = F.coalesce(
        F.sum(cap).over(by_end.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    return (
        ranked.withColumn("start", F.coalesce(F.sum("source_size").over(earlier), F.lit(0)))
        .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(over_all))
        .withColumn("_open", (F.col("budget") - capped) / F.sum("weight").over(rest))
        .withColumn("_level", F.max("_open").over(over_all))
        .withColumn("target", F.least(cap, F.col("weight") * F.col("_level")))
        .withColumn("total", F.sum("target").over(over_all))
        .select("source", "rank", "weight", "source_size", "start", "target", "total")
    )


def mix(
    docs: DataFrame,
    carry: list[str],
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """How often the mix takes each row of ``docs``.

    Returns the columns ``carry`` of every row (they must not be named like the
    result columns) and ``mix_source``, ``size`` (words), ``source_size``, ``target``,
    ``copies`` (0 to ``repeats``) and ``taken`` (words, repeats counted). ``docs``
    needs doc_id, source and text; a null source is a source of its own (the last),
    a null or empty text has size 0 and takes nothing, a null id is shuffled like any
    other, repeated rows are separate entries, and an empty table gives an empty
    result. The shuffle is a hash of the id, so reruns agree.
    """
    slim = written(
        docs.select(
            F.struct(*carry).alias("carry"),
            "source",
            word_count(text_of()).alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("draw"),
            F.monotonically_increasing_id().alias("tie"),
        ),
        "mix",
    )
    sources = small_side(written(source_targets(slim, weights, share, repeats), "sources"))
    order = [F.col("source").asc_nulls_last(), F.col("draw"), F.col("size"), F.col("tie")]
    queue = (
        running_totals(slim, order, ["size"], "queue").alias("q")
        .join(sources.alias("s"), F.col("q.source").eqNullSafe(F.col("s.source")))
        .select(
            "carry", F.col("q.source").alias("mix_source"), "size", "source_size", "target",
            "total", "rank", "weight", "place",
            (F.col("before_size") + F.col("size") - F.col("start")).alias("reach"),
        )
    )

    def entry(epoch: Column) -> Column:
        finish = (epoch * F.col("source_size") + F.col("reach")) / F.col("weight")
        return F.struct(
            finish.alias("finish"), F.col("rank").alias("rank"),
            epoch.cast("long").alias("epoch"), F.col("place").alias("place"),
        )

    epochs = F.explode(F.array(*[F.lit(e) for e in range(repeats)]))
    entries = written(
        queue.withColumn("_epoch", epochs).select(
            entry(F.col("_epoch")).alias("entry"), "size", "total"
        ),
        "entries",
    )
    served = running_totals(entries, ["entry"], ["size"], "served")
    last = (
        served.filter(F.col("before_size") + F.col("size") <= F.col("total"))
        .agg(F.max("entry").alias("entry"))
        .first()["entry"]
    )

    def served_at(epoch: int) -> Column:
        if last is None:
            return F.lit(0)
        cut = F.struct(
            F.lit(last["finish"]).cast("double").alias("finish"),
            F.lit(last["rank"]).cast("int").alias("rank"),
            F.lit(last["epoch"]).cast("long").alias("epoch"),
            F.lit(last["place"]).cast("long").alias("place"),
        )
        return (entry(F.lit(epoch)) <= cut).cast("int")

    copies = sum((served_at(e) for e in range(1, repeats)), served_at(0))
    return queue.withColumn("copies", copies).select(
        "carry.*", "mix_source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each none, once or more.

    All columns stay as they are, whatever their names.
    """
    numbered = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    plan = mix(numbered, ["__row"], weights, share, repeats).filter("copies > 0")
    plan = plan.select(
        "__row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy")
    )
    return numbered.join(plan, "__row").select(*[numbered[f"`{c}`"] for c in docs.columns])
