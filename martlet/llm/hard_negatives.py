"""Hard-negative mining by coordinate pruning.

Rows are cut into chunks, and a chunk's rows into buckets of similar length, longest
first; each bucket holds a sorted list of values for every coordinate of its unit
vectors. An anchor that has to reach a score needs a certain cosine with any row of a
bucket. That cosine bounds, for each of the anchor's largest coordinates (its focus),
the value a row may have there: two binary searches in the sorted list. Rows inside all
these ranges are scored exactly. The score to reach rises while buckets are read, so
buckets are skipped, or pruned to few rows.

Anchors are dealt in blocks, and a block meets a chunk once, in one task: nothing larger
than a block and a chunk is ever held, and a task returns a few rows for each anchor.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import running_totals, ship
from martlet.session import written

POSITIVES = NEGATIVES = 5
#: A negative's score lies between this share of the positive's score, in percent, and all of it.
LEAST_PERCENT = 80
#: Anchors of a block, rows of a chunk and of a bucket: what a task holds.
ANCHORS, CHUNK, BUCKET = 4096, 8192, 1024
#: Coordinates whose ranges are intersected.
FOCUS = 6
#: Ranges are widened by this much, against rounding.
SLACK = 1e-9
#: Stands for a null id, so that it sorts last.
NO_ID = (1 << 63) - 1


class Bucket:
    """Rows of similar length with a sorted list of values for each coordinate."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, places: np.ndarray):
        self.vectors, self.ids, self.labels, self.places = vectors, ids, labels, places
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.longest = float(lengths.max())
        unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.values = np.take_along_axis(unit, self.order, axis=0)

    def candidates(self, anchor: np.ndarray, length: float, least: float) -> np.ndarray | None:
        """Places of rows whose inner product with ``anchor`` may reach ``least``; None
        for all rows."""
        if least <= 0:
            return None
        reach = length * self.longest
        if reach * (1 + SLACK) < least:
            return np.zeros(0, dtype=np.int64)
        cosine = min(1.0, least / reach)
        unit = anchor / length
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        # a row is at most this angle away from the anchor, so its angle to an axis is at
        # most that much smaller or larger than the anchor's own
        apart, own = np.arccos(cosine), np.arccos(unit[focus].clip(-1, 1))
        lows = np.cos(np.minimum(np.pi, own + apart)) - SLACK
        highs = np.cos(np.maximum(0, own - apart)) + SLACK
        n, inside, met = len(self.ids), None, 0
        for at, low, high in zip(focus, lows, highs):
            column = self.values[:, at]
            start, end = np.searchsorted(column, low, "left"), np.searchsorted(column, high, "right")
            if end - start == n:
                continue
            if inside is None:
                inside = np.zeros(n, dtype=np.int8)
            inside[self.order[start:end, at]] += 1
            met += 1
        return None if inside is None else np.flatnonzero(inside == met)


def buckets(vectors, ids, labels, places, size: int = BUCKET) -> list[Bucket]:
    """Buckets of a chunk, longest rows first."""
    by_length = np.argsort(-(vectors.astype(np.float64) ** 2).sum(axis=1), kind="stable")
    return [
        Bucket(*(x[by_length[i:i + size]] for x in (vectors, ids, labels, places)))
        for i in range(0, len(by_length), size)
    ]


def _scores(bucket: Bucket, rows: np.ndarray | None, anchor: np.ndarray) -> np.ndarray:
    return (bucket.vectors if rows is None else bucket.vectors[rows]) @ anchor


def top_of_label(found: list[Bucket], anchor, length, label, place, k: int):
    """The best ``k`` rows (scores, ids, places) of the anchor's label but itself."""
    best = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    for bucket in found:
        least = best[0][-1] if len(best[0]) == k else -np.inf
        rows = bucket.candidates(anchor, length, least)
        score = _scores(bucket, rows, anchor)
        rows = np.arange(len(bucket.ids)) if rows is None else rows
        good = (bucket.labels[rows] == label) & (bucket.places[rows] != place) & (score >= least)
        best = _first(best, score[good], bucket.ids[rows[good]], bucket.places[rows[good]], k)
    return best


def _first(best, score, ids, places, k: int):
    score, ids, places = (np.concatenate(x) for x in zip(best, (score, ids, places)))
    order = np.lexsort((places, ids, -score))[:k]
    return score[order], ids[order], places[order]


def just_below(found: list[Bucket], anchor, length, label, positives: np.ndarray, k: int, percent: int):
    """For each score of ``positives``, the first ``k`` rows (scores, ids, places) of
    another label between ``percent`` of it and all of it."""
    none = np.zeros(0, dtype=np.int64)
    best = [(none, none, none) for _ in positives]
    floors = [-(-p * percent // 100) for p in positives.tolist()]
    for bucket in found:
        need = [max(f, b[0][-1]) if len(b[0]) == k else f for f, b in zip(floors, best)]
        rows = bucket.candidates(anchor, length, min(need))
        score = _scores(bucket, rows, anchor)
        rows = np.arange(len(bucket.ids)) if rows is None else rows
        other = (bucket.labels[rows] != label) & (score >= min(need))
        score, rows = score[other], rows[other]
        for i, (positive, least) in enumerate(zip(positives, need)):
            good = (score >= least) & (score <= positive)
            if good.any():
                best[i] = _first(best[i], score[good], bucket.ids[rows[good]], bucket.places[rows[good]], k)
    return best


def _held(group, dim: int):
    """Vectors, ids, labels and places of a group's rows."""
    vectors = np.array(group["vector"].tolist(), dtype=np.int64).reshape(len(group), dim)
    return vectors, group["id"].to_numpy(), group["label"].to_numpy(), group["place"].to_numpy()


def _fast(*matrices: np.ndarray) -> list[np.ndarray]:
    """As doubles where inner products of these are exact in them, else as they are.

    Products that do not fit 64 bits raise an error rather than give a wrong score.
    """
    dim = matrices[0].shape[1]
    most = max((int(np.abs(m).max()) for m in matrices if m.size), default=0)
    if dim * most * most >= 1 << 63:
        raise ValueError("components are too large for inner products of 64 bits")
    return [m.astype(np.float64) for m in matrices] if dim * most * most < 1 << 53 else list(matrices)


def _meet(anchors: DataFrame, rows: DataFrame, pairs: DataFrame, search: Callable, result: str) -> DataFrame:
    """``search`` in one task for each (block, chunk) of ``pairs``, over the block's
    anchors dealt to that chunk and the chunk's rows."""
    both = pairs.select(F.col("block").alias("for"), "chunk").distinct()
    theirs = rows.join(both, "chunk").withColumn("of", F.col("chunk").cast("long"))
    return (
        pairs.groupBy("block", "chunk")
        .cogroup(theirs.groupBy("for", "of"))
        .applyInPandas(search, result)
    )


def _chunk(place: Column | str, size: int) -> Column:
    return F.floor((F.col(place) if isinstance(place, str) else place) / size).cast("long")


def _ranked(found: DataFrame, group: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("id"), "found")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT, block: int = ANCHORS, chunk: int = CHUNK, bucket: int = BUCKET,
) -> DataFrame:
    """Hard negatives of the rows of ``vectors`` (id, label, vector) where ``anchors`` holds.

    ``vector`` holds whole numbers (array of long). Rows with a null label or vector or a
    null component take no part, and only vectors of one dimension meet. An anchor's
    positives are its best ``positives`` other rows of its label; for each of them come
    the best ``negatives`` rows of other labels whose score is from ``least_percent`` of
    the positive's up to all of it. Ties go to the smaller id (null last). Returns
    anchor_id, positive_id, rank, negative_id, positive_score and negative_score; repeated
    rows are rows of their own, an empty table gives an empty result, and other columns
    are not looked at. Every (block, chunk) is met, so no row is missed.
    """
    ship(__name__)
    rows = vectors.filter(
        F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    ).select(
        F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("id"), "label", "vector", F.size("vector").alias("dim"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x).alias("square"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = ["dim", "label", F.col("square").desc(), "id", "tie"]
    placed = written(running_totals(rows, order, [], "placed").drop("tie"), "rows").withColumn("chunk", _chunk("place", chunk))
    few = written(running_totals(
        placed.filter("anchor").withColumnRenamed("place", "row"), ["dim", "label", "row"], [], "anchors"
    ).withColumn("block", _chunk("place", block)).drop("place", "chunk", "anchor"), "anchors")
    spans = placed.groupBy("dim", "label").agg(F.min("chunk").alias("first"), F.max("chunk").alias("last"))
    near = few.join(spans, ["dim", "label"])
    slim = placed.select("chunk", "id", "label", "vector", "place", "dim")

    def search_positives(mine_, theirs):
        import pandas as pd

        out = []
        for dim, asked in mine_.groupby("dim"):
            held = theirs[theirs["dim"] == dim]
            matrix, ids, labels, places = _held(held, int(dim))
            asking, _, wanted, at = _held(asked.rename(columns={"row": "place"}), int(dim))
            asking, matrix = _fast(asking, matrix)
            for label in np.unique(wanted):
                own = labels == label
                found = buckets(matrix[own], ids[own], labels[own], places[own], bucket)
                for i in np.flatnonzero(wanted == label):
                    length = float(np.sqrt((asking[i].astype(np.float64) ** 2).sum()))
                    score, who, where = top_of_label(found, asking[i], length, label, at[i], positives)
                    out.append((np.full(len(score), at[i]), where, who, score.astype(np.int64)))
        row, found_, ids_, scores = map(np.concatenate, zip(*out)) if out else [np.zeros(0, dtype=np.int64)] * 4
        return pd.DataFrame({"row": row, "found": found_, "id": ids_, "score": scores})

    same = near.select(
        "block", F.explode(F.sequence("first", "last")).alias("chunk"), "row", "id", "label", "vector", "dim"
    )
    best = written(_ranked(
        _meet(few, slim, same, search_positives, "row long, found long, id long, score long"), ["row"], positives
    ), "positives")
    by_rank = F.sort_array(F.collect_list(F.struct("rank", "score")))
    wanted = best.groupBy("row").agg(F.transform(by_rank, lambda p: p["score"]).alias("positives"))
    floor = F.array_min("positives") * F.lit(least_percent / 100)
    # a chunk between the ends of the anchor's own label has no other; and none of a
    # chunk's rows is longer than its longest
    reach = placed.groupBy("dim", "chunk").agg(F.max("square").alias("most"))
    whole = placed.groupBy("dim").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    far = near.join(wanted, "row").join(whole, "dim").select(
        "block", "row", "id", "label", "vector", "dim", "square", "positives", floor.alias("floor"),
        F.explode(F.filter(F.sequence("low", "high"), lambda c: (c <= F.col("first")) | (c >= F.col("last")))).alias("chunk"),
    ).join(reach, ["dim", "chunk"]).filter(
        F.sqrt(F.col("square") * F.col("most")) * (1 + SLACK) >= F.col("floor")
    ).drop("square", "most", "floor")

    def search_negatives(mine_, theirs):
        import pandas as pd

        out = []
        for dim, asked in mine_.groupby("dim"):
            held = theirs[theirs["dim"] == dim]
            matrix, ids, labels, places = _held(held, int(dim))
            asking, _, wanted_, at = _held(asked.rename(columns={"row": "place"}), int(dim))
            asking, matrix = _fast(asking, matrix)
            found = buckets(matrix, ids, labels, places, bucket)
            for i, listed in enumerate(asked["positives"]):
                length = float(np.sqrt((asking[i].astype(np.float64) ** 2).sum()))
                scores = np.array(listed, dtype=np.int64)
                below = just_below(found, asking[i], length, wanted_[i], scores, negatives, least_percent)
                for rank, (score, who, where) in enumerate(below, 1):
                    n = len(score)
                    out.append((np.full(n, at[i]), np.full(n, rank), where, who, score.astype(np.int64)))
        names = ["row", "positive", "found", "id", "score"]
        columns = map(np.concatenate, zip(*out)) if out else [np.zeros(0, dtype=np.int64)] * 5
        return pd.DataFrame(dict(zip(names, columns)))

    below = _ranked(
        _meet(few, slim, far, search_negatives, "row long, positive int, found long, id long, score long"),
        ["row", "positive"], negatives,
    )
    def shown(name: str) -> Column:
        return F.when(F.col(name) < NO_ID, F.col(name)).alias(name)

    asked = best.select(
        "row", F.col("rank").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        below.join(asked, ["row", "positive"]).join(few.select("row", F.col("id").alias("anchor_id")), "row")
        .select(
            shown("anchor_id"), shown("positive_id"), "rank", shown("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
    )
