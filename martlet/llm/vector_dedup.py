"""Near-duplicate vectors by sorted projection passes.

A pass hashes every vector to the signs of random projections, concatenated to one
number, and sorts all vectors by it. Vectors at a small angle share long prefixes and
stand close to each other, so each is compared, exactly, with a window of neighbours.
Where more vectors than a window share a prefix, all of them are compared, in pairs of
blocks, except those already known to be in one component. So every pair that shares
a prefix in some pass is found, however dense its surroundings; the number of passes
follows from the number of vectors. These comparisons only return links that join
components. Links are then counted once, inside the final components, by comparing
all their members in pairs of blocks.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import components, running_totals, ship
from martlet.session import written

COSINE = 0.9
#: The least number of passes.
PASSES = 12
#: Sign bits of a pass.
BITS = 48
#: Each vector is compared with this many neighbours on either side.
WINDOW = 1024
#: Chance, at least, that a pair at the least cosine shares a prefix in some pass.
RECALL = 0.999
#: Rows of a block where all members of a group are compared.
BLOCK = 8192
#: Rows compared with a block at a time; bounds the memory of a task.
TOGETHER = 1024
SEED = 20


def prefix_bits(rows: int, window: int = WINDOW) -> int:
    """Length of the prefix that, were signs independent, at most two thirds of a
    window share."""
    return 0 if rows <= window else min(BITS, math.ceil(math.log2(1.5 * rows / window)))


def passes_for(rows: int, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which a pair at the least cosine has shared a prefix with a chance
    of ``recall``."""
    chance = (1 - math.acos(COSINE) / math.pi) ** prefix_bits(rows, window)
    return 1 if chance == 1 else math.ceil(math.log(1 - recall) / math.log(1 - chance))


def _planes(dim: int, number: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim, number]).standard_normal((dim, BITS))


def _codes(frame: DataFrame, passes: int) -> DataFrame:
    """A row (pass, code, cls) for each pass and distinct vector; the code sorts like
    the concatenated signs. Vectors of other dimensions never meet: it is part of the
    key."""
    ship(__name__)
    import pyarrow as pa

    weights = (1 << np.arange(BITS, dtype=np.int64))[::-1]

    def run(batches):
        for batch in batches:
            classes = batch.column("cls").to_numpy(zero_copy_only=False)
            vectors = batch.column("vector").to_pylist()
            sizes = np.array([len(v) for v in vectors])
            for dim in np.unique(sizes):
                mine = np.flatnonzero(sizes == dim)
                x = _scaled(np.array([vectors[i] for i in mine], dtype=np.float64))
                for number in range(passes):
                    code = (x @ _planes(int(dim), number) > 0) @ weights
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(mine), number, dtype=np.int32)),
                         pa.array(np.full(len(mine), dim, dtype=np.int32)),
                         pa.array(code), pa.array(classes[mine])],
                        names=["pass", "dim", "code", "cls"])

    return frame.mapInArrow(run, "pass int, dim int, code long, cls long")


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings the largest component to 0.5 to 1, so that
    squares and sums neither overflow nor vanish; components keep all their digits."""
    power = np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]
    return np.ldexp(x, -power)


def _unit(vectors) -> np.ndarray:
    x = _scaled(np.array(vectors.tolist(), dtype=np.float64))
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _joining(x: np.ndarray, mine: np.ndarray, others: np.ndarray, label: np.ndarray) -> list:
    """Places (i, j) of links between the rows ``mine`` and ``others`` of ``x`` that
    join rows of different labels; joined rows get the same label."""
    found = []
    for start in range(0, len(mine), TOGETHER):
        part = mine[start:start + TOGETHER]
        close = x[part] @ x[others].T >= COSINE
        p, q = np.nonzero(close)
        for k in np.unique(p[label[part[p]] != label[others[q]]]):
            i, partners = part[k], others[close[k]]
            met, first = np.unique(label[partners], return_index=True)
            new = met != label[i]
            if new.any():
                found.extend((i, partners[f]) for f in first[new])
                label[np.isin(label, met)] = label[i]
    return found


def _edges(classes: np.ndarray, found: list):
    import pandas as pd

    i, j = np.array(found, dtype=np.int64).reshape(-1, 2).T
    p, q = classes[i], classes[j]
    return pd.DataFrame({"a": np.minimum(p, q), "b": np.maximum(p, q)}).query("a != b")


def _compare(blocks: DataFrame) -> DataFrame:
    """Links (a, b), a < b, that join the rows of each block.

    A block has ``window`` rows of its own and the ``window`` rows before them, so a
    group is bounded; rows are unit vectors in double precision.
    """

    def run(group):
        own = group["own"].to_numpy()
        dims = group["vector"].map(len).to_numpy()
        classes = group["cls"].to_numpy()
        found = []
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            x = _unit(group["vector"].to_numpy()[at])
            # the end of a pass and the start of the next may hold the same vector
            label = np.unique(classes[at], return_inverse=True)[1]
            links = _joining(x, np.flatnonzero(own[at]), np.arange(len(at)), label)
            found += [(at[i], at[j]) for i, j in links]
        return _edges(classes, found)

    return blocks.groupBy("block").applyInPandas(run, "a long, b long")


def _crowded(
    ranked: DataFrame, vectors: DataFrame, roots: DataFrame, bits: int, window: int, block: int
) -> DataFrame:
    """Links that join components, among all rows that share a prefix of ``bits`` bits
    where those are more than a window.

    Rows are sorted by component inside a prefix, and a row is not sent to a block
    that only holds its own component.
    """
    key = ["pass", "dim", "prefix"]
    rows = ranked.select(
        "pass", "dim", F.shiftright("code", BITS - bits).alias("prefix"), "cls"
    )
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > window)
    full = rows.join(sizes.drop("n"), key).join(roots.withColumnRenamed("node", "cls"), "cls")
    placed = running_totals(full, [*key, "root", "cls"], [], "crowded")
    runs = written(
        placed.groupBy(*key, "root").agg(F.min("place").alias("s"), F.max("place").alias("e")), "runs"
    )
    spans = runs.groupBy(*key).agg(F.min("s").alias("first"), F.max("e").alias("last"))
    spans = spans.join(runs, key).filter("s > first OR e < last")
    home = F.floor(F.col("place") / block)

    def mixed(j):
        low = F.greatest(j * block, F.col("first"))
        high = F.least((j + 1) * block - 1, F.col("last"))
        return (low < F.col("s")) | (high > F.col("e"))

    met = F.filter(
        F.sequence(F.floor(F.col("first") / block), F.floor(F.col("last") / block)), mixed
    )
    dealt = placed.join(spans, [*key, "root"]).select(
        *key, "cls", "root", home.alias("home"), F.explode(met).alias("other")
    ).select(
        *key, "cls", "root", "home",
        F.least("home", "other").alias("i"), F.greatest("home", "other").alias("j"),
    )

    def run(group):
        home = group["home"].to_numpy()
        label = np.unique(group["root"].to_numpy(), return_inverse=True)[1]
        mine = np.flatnonzero(home == group["i"].iloc[0])
        others = np.flatnonzero(home == group["j"].iloc[0])
        return _edges(group["cls"].to_numpy(), _joining(_unit(group["vector"]), mine, others, label))

    return dealt.join(vectors, "cls").groupBy(*key, "i", "j").applyInPandas(run, "a long, b long")


def _counts(members: DataFrame, vectors: DataFrame, block: int) -> DataFrame:
    """Rows that each vector of ``members`` (root, cls, copies) links with, other than
    its own copies: (cls, others). All pairs of a component are compared."""
    placed = running_totals(members, ["root", "cls"], [], "members")
    home = F.floor(F.col("place") / block)
    spans = placed.groupBy("root").agg(F.min(home).alias("first"), F.max(home).alias("last"))
    dealt = placed.join(spans, "root").select(
        "root", "cls", "copies", home.alias("home"), F.explode(F.sequence("first", "last")).alias("other")
    ).select(
        "root", "cls", "copies", "home",
        F.least("home", "other").alias("i"), F.greatest("home", "other").alias("j"),
    )

    def run(group):
        import pandas as pd

        group = group.sort_values("root")
        roots, home = group["root"].to_numpy(), group["home"].to_numpy()
        copies = group["copies"].to_numpy().astype(np.float64)
        vectors = group["vector"].to_numpy()
        low, high = group["i"].iloc[0], group["j"].iloc[0]
        total = np.zeros(len(group))
        ends = np.flatnonzero(np.append(roots[1:] != roots[:-1], True)) + 1
        for start, end in zip(np.append(0, ends[:-1]), ends):
            x, n, side = _unit(vectors[start:end]), copies[start:end], home[start:end]
            mine, others = np.flatnonzero(side == low), np.flatnonzero(side == high)
            for k in range(0, len(mine), TOGETHER):
                part = mine[k:k + TOGETHER]
                close = x[part] @ x[others].T >= COSINE
                if low == high:
                    close[np.arange(len(part)), k + np.arange(len(part))] = False
                else:
                    total[start + others] += n[part] @ close
                total[start + part] += close @ n[others]
        return pd.DataFrame({"cls": group["cls"].to_numpy(), "others": total.astype(np.int64)})

    counted = dealt.join(vectors, "cls").groupBy("i", "j").applyInPandas(run, "cls long, others long")
    return counted.groupBy("cls").agg(F.sum("others").alias("others"))


def link_vectors(
    vectors: DataFrame, passes: int = PASSES, window: int = WINDOW, block: int = BLOCK
) -> DataFrame:
    """Links and component of every row of ``vectors`` (vec_id, embedding).

    Returns vec_id, n_links, component_id and kept. Links have a cosine of at least
    0.9 in double precision. Null and zero vectors, and those with null or non-finite
    components, link with nothing and are kept; huge and tiny ones are compared like
    others. Rows with equal vectors are links of
    each other and are compared with others only once. ``passes`` is the least number
    of passes; more are made where the number of vectors asks for them. A null vec_id links like
    others; a component of such rows alone has a null id and none is kept. An empty
    table gives an empty result; other columns are not looked at.
    """
    vector = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(
        "vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    some = F.exists("vector", lambda v: v != 0)
    rows = vectors.select("vec_id", vector.alias("vector")).select(
        "vec_id", F.when(finite & some, F.col("vector")).alias("vector")
    )
    keyed = written(
        rows.withColumn("cls", F.when(F.col("vector").isNotNull(), F.xxhash64("vector"))), "vectors"
    )
    # equal vectors: one row for each distinct vector, with the number of its rows
    distinct = written(
        keyed.filter("cls IS NOT NULL").groupBy("cls")
        .agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies")),
        "distinct",
    )
    n = distinct.count()
    bits, passes = prefix_bits(n, window), max(passes, passes_for(n, window))
    bare, nodes = distinct.select("cls", "vector"), distinct.select(F.col("cls").alias("node"))
    codes = written(_codes(bare, passes), "codes")
    ranked = running_totals(codes, ["pass", "dim", "code", "cls"], [], "passes")
    at = F.floor(F.col("place") / window)
    dealt = ranked.select(
        "cls",
        F.explode(F.array(
            F.struct(at.alias("block"), F.lit(True).alias("own")),
            F.struct((at + 1).alias("block"), F.lit(False).alias("own")),
        )).alias("in"),
    ).select("cls", "in.block", "in.own")
    near = written(_compare(dealt.join(bare, "cls")).distinct(), "near")
    roots = written(components(nodes, near), "near-roots")
    far = written(_crowded(ranked, bare, roots, bits, window, block).distinct(), "far")
    if not far.isEmpty():
        roots = written(components(nodes, near.unionByName(far)), "roots")
    sizes = distinct.select("cls", "copies").join(roots.withColumnRenamed("node", "cls"), "cls")
    several = roots.groupBy("root").count().filter("count > 1").select("root")
    linked = _counts(written(sizes.join(several, "root"), "linked"), bare, block)
    classes = written(
        sizes.join(linked, "cls", "left")
        .select("cls", "root", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "classes",
    )
    placed = keyed.drop("vector").join(classes, "cls")
    least = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    out = placed.join(least, "root").select("vec_id", "n_links", "component_id")
    alone = keyed.filter("cls IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return out.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
