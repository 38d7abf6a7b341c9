"""Quality rules: plain counts, and a hashed n-gram likelihood ratio between trusted
documents and the raw corpus.

Words and word pairs are hashed into a fixed number of buckets. One multinomial is
counted over all documents, one over trusted ones (label 1), and a document's score is
the mean log ratio of its n-grams. The model is one array of a value for each bucket,
so its size does not depend on the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import text_of, words
from martlet.session import written

#: Buckets of the hashed n-grams: what the model and each task's counts are bounded by.
BUCKETS = 1 << 17
#: At most this many trusted documents, the first by hash of their id, are the target.
TRUSTED = 20_000
#: Added to a bucket's target count and to its expected one.
PSEUDO = 5.0
#: Documents whose mean log ratio is below this are rejected.
LEAST_RATIO = -0.2
WINDOW = 8
_SYMBOLS = "[#*$%&|<>]"


def _neighbours(hashes: str, step: int) -> Column:
    """Hash of each element with the one ``step`` places on, where there is one."""
    ahead = F.slice(hashes, F.lit(step + 1), F.size(hashes))
    here = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - step, F.lit(0)))
    return F.zip_with(here, ahead, lambda a, b: F.xxhash64(a, b))


def hashed(docs: DataFrame) -> DataFrame:
    """Add hashes of the words of ``text`` (one) and of neighbouring words (two)."""
    tokens = docs.withColumn("tokens", words(F.col("text")))
    ones = tokens.withColumn("one", F.transform("tokens", lambda w: F.xxhash64(w)))
    return ones.withColumn("two", _neighbours("one", 1))


def bucket(gram: Column) -> Column:
    return F.pmod(gram, F.lit(BUCKETS)).cast("int")


def trusted_ids(labels: DataFrame, limit: int = TRUSTED) -> DataFrame:
    """Ids of at most ``limit`` documents with label 1."""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def ratio_model(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row with the array of log ratios by bucket.

    A bucket's target count is held against the count its share of the raw corpus would
    give, both with the same pseudo-count, so a bucket with little evidence, as all are
    in a small corpus, has a ratio near 0.
    Without trusted documents all ratios are 0.
    """
    spark = docs.sparkSession
    ids = F.broadcast(written(trusted_ids(labels), "trusted"))  # at most TRUSTED ids

    def counted(part: DataFrame, name: str) -> DataFrame:
        grams = hashed(part.select(text_of().alias("text"))).select(F.concat("one", "two").alias("g"))
        # outer: else Spark filters on the size of the array, and computes it twice for that
        each = grams.select(F.explode_outer("g").alias("g")).select(bucket(F.col("g")).alias("bucket"))
        return each.groupBy("bucket").agg(F.count("bucket").alias(name)).filter("bucket IS NOT NULL")

    raw = counted(docs, "raw")
    target = counted(docs.join(ids, "doc_id", "left_semi"), "target")
    counts = written(raw.join(target, "bucket", "left").fillna(0, ["target"]), "ratio")
    sums = counts.agg(F.sum("raw").alias("r"), F.sum("target").alias("t")).first()
    n_raw, n_target = sums["r"] or 1, sums["t"] or 0
    expected = F.col("raw") * F.lit(n_target / n_raw)
    ratio = F.log((F.col("target") + F.lit(PSEUDO)) / (expected + F.lit(PSEUDO)))
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counts.select("bucket", ratio.alias("ratio")), "bucket", "left")
    model = filled.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("bucket", F.coalesce("ratio", F.lit(0.0)).alias("v")))),
            lambda s: s["v"].cast("float"),
        ).alias("model")
    )
    return written(model, "ratio-model")


def rules(docs: DataFrame) -> DataFrame:
    """Base counts of every row: see ``judge``; keeps all columns in the struct ``doc``."""
    line_has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    frame = hashed(docs.select(F.struct("*").alias("doc"), text_of().alias("text")))
    frame = frame.withColumn("lines", F.filter(F.split("text", "\n"), line_has_word))
    # windows of eight words, compared by 64-bit hash: pairs of pairs of pairs
    frame = frame.withColumn("four", _neighbours("two", 2))
    frame = frame.withColumn("hashes", _neighbours("four", 4))
    twice = F.size(F.array_distinct("hashes")) < F.size("hashes")
    sorted_starts = F.sort_array(
        F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    frame = frame.withColumn("ordered", F.when(twice, sorted_starts))
    # windows that equal a neighbour in the order of hashes; the starts of these are
    # sorted, and each covers the words up to the next, at most a window's
    twin = F.transform("ordered", lambda s, i: F.when(
        (s["h"] == F.get("ordered", i - 1)["h"]) | (s["h"] == F.get("ordered", i + 1)["h"]), s["i"]
    ))
    frame = frame.withColumn("starts", F.sort_array(F.array_compact(twin)))
    covered = F.aggregate(
        F.transform("starts", lambda s, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get("starts", i + 1) - s, F.lit(WINDOW))
        )),
        F.lit(0), lambda acc, x: acc + x,
    )
    return frame.withColumns({
        "n_words": F.size("tokens").cast("long"),
        "word_chars": F.length(F.array_join("tokens", "")).cast("long"),
        "n_symbols": F.regexp_count("text", F.lit(_SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    })


def judge(docs: DataFrame, labels: DataFrame, least: float = LEAST_RATIO) -> DataFrame:
    """Counts and verdict of every row of ``docs`` (doc_id, text).

    Returns ``doc`` (a struct of all columns, whatever their names), n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio (mean log
    ratio of the row's n-grams; 0 without words) and kept. Null and empty texts have
    no words and fail the base rule; null ids are judged but never trusted; repeated
    rows are judged alike. With an empty table or no labels nothing is rejected
    beyond the base rules. The pseudo-count is a number of n-grams, so ratios in a small
    corpus are nearer to 0 than in a large one of the same kind: there a document is
    rejected only on more evidence. The result can be filtered by any of its columns.
    """
    model = ratio_model(docs, labels)
    frame = rules(docs).withColumn("model", model.scalar())
    total = F.aggregate(
        F.concat("one", "two"), F.lit(0.0),
        lambda acc, g: acc + F.get("model", bucket(g)).cast("double"),
    )
    size = F.size("one") + F.size("two")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = (
        frame.withColumn("ratio", F.when(size > 0, total / size).otherwise(0.0))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= least))
    )
    # A filter on a result must not move below the hashes, which Spark would then copy
    # into each other; it does not pass columns that depend on a row number.
    row = F.monotonically_increasing_id()
    results = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept",
    ]
    return judged.select("doc", *[F.when(row >= 0, F.col(c)).alias(c) for c in results])


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return judge(docs, labels).filter("kept").select("doc.*")
