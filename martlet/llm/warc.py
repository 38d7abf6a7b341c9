"""WARC files and their fixity: Merkle trees over records and ordered offset ranges.

Records lie one after the other in files; leaves hash a record together with its
offset range, parents the ordered children. Two replicas whose roots agree are equal.
Where they differ, the audit goes down through the nodes that mismatch, so the work
after hashing is the number of damaged paths, not of records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import ship, small_side
from martlet.session import written

#: Children of a node: what one group of a tree level holds.
FANOUT = 16
#: Records of a file.
PER_FILE = 1024
_END = "\r\n"


def record(url: Column, body: Column, number: Column) -> Column:
    """The bytes of one WARC/1.1 resource record."""
    payload = F.coalesce(body, F.lit("")).cast("binary")
    digest = F.concat(F.lit("sha256:"), F.sha2(payload, 256))
    head = F.concat_ws(
        _END,
        F.lit("WARC/1.1"), F.lit("WARC-Type: resource"),
        F.concat(F.lit("WARC-Record-ID: <urn:sha256:"), F.sha2(F.concat_ws(
            "|", number.cast("string"), F.coalesce(url, F.lit(""))
        ).cast("binary"), 256), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.coalesce(url, F.lit(""))),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("WARC-Payload-Digest: "), digest),
        F.concat(F.lit("Content-Length: "), F.octet_length(payload)),
        F.lit(""), F.lit(""),
    )
    return F.concat(head.cast("binary"), payload, F.lit(_END + _END).cast("binary"))


def write_records(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) as WARC records in files of PER_FILE records.

    Returns file, place (in the file), offset, length, page_id and data, ordered by
    page_id and position in the input; written once. Null urls and bodies are
    empty; null ids come first; repeated rows are separate records; an empty table
    has no files. Other columns are left out.
    """
    rows = pages.select("page_id", "url", "html", F.monotonically_increasing_id().alias("row"))
    order = ["page_id", "row"]
    # The bytes are moved once, into their order; a task adds up the lengths of its slab.
    slabs = written(
        _placed(
            rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("page_id", record(F.col("url"), F.col("html"), F.col("page_id")).alias("data"))
        ),
        "records",
    )
    sizes = slabs.groupBy("slab").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"))
    earlier = Window.orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    slab_starts = sizes.select(  # one row for each task
        "slab",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
    )
    place = F.col("rows_before") + F.col("slab_place")
    placed = slabs.join(F.broadcast(slab_starts), "slab").select(
        F.floor(place / PER_FILE).alias("file"), (place % PER_FILE).alias("place"),
        (F.col("bytes_before") + F.col("slab_offset")).alias("start"), "length", "page_id", "data",
    )
    files = small_side(written(
        placed.filter("place = 0").select("file", F.col("start").alias("begin")), "files"
    ))
    return placed.join(files, "file").select(
        "file", "place", (F.col("start") - F.col("begin")).alias("offset"), "length", "page_id", "data"
    )


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` (page_id, data) with the number of their partition (``slab``), and their
    place and offset in it."""
    ship(__name__)
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def run(batches):
        rows_before = bytes_before = 0
        for batch in batches:
            length = pc.binary_length(batch.column("data")).cast(pa.int64()).to_numpy()
            ends = bytes_before + np.cumsum(length, dtype=np.int64)
            places = rows_before + np.arange(batch.num_rows, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, (length, places, ends - length))],
                names=["slab", "page_id", "data", "length", "slab_place", "slab_offset"],
            )
            if batch.num_rows:
                rows_before, bytes_before = rows_before + batch.num_rows, int(ends[-1])

    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.select(F.spark_partition_id().alias("slab"), "page_id", "data").mapInArrow(
        run, f"slab int, page_id {kind}, data binary, length long, slab_place long, slab_offset long"
    )


def leaves(records: DataFrame) -> DataFrame:
    """A leaf for each record: its digest covers its offset range and its bytes."""
    span = F.concat_ws(":", "offset", F.octet_length("data"))
    return records.select(
        "file", F.lit(0).alias("level"), F.col("place").alias("node"), "offset",
        F.octet_length("data").cast("long").alias("length"),
        F.sha2(F.concat(span.cast("binary"), F.lit(b"\0"), F.col("data")), 256).alias("digest"),
    )


def tree(leaf: DataFrame) -> list[DataFrame]:
    """The levels of the trees of all files, leaves first, each written once.

    A parent covers up to FANOUT children: the range from the first one's offset to
    the last one's end, and the hash of their digests in order.
    """
    levels = [written(leaf, "leaves")]
    while not levels[-1].filter("node > 0").isEmpty():
        child = F.struct("node", "offset", "length", "digest")
        up = (
            levels[-1].groupBy("file", F.floor(F.col("node") / FANOUT).alias("node"))
            .agg(F.sort_array(F.collect_list(child)).alias("c"))  # at most FANOUT
            .select(
                "file", F.lit(len(levels)).alias("level"), "node",
                F.array_min("c.offset").alias("offset"),
                F.aggregate("c.length", F.lit(0).cast("long"), lambda a, b: a + b).alias("length"),
                F.sha2(F.concat_ws("", F.transform(
                    "c", lambda x: F.concat_ws(":", x["node"] % FANOUT, x["digest"])
                )).cast("binary"), 256).alias("digest"),
            )
        )
        levels.append(written(up, f"level-{len(levels)}"))
    return levels


def audit(primary: list[DataFrame], replica: list[DataFrame]) -> DataFrame:
    """The records in which two replicas differ.

    Roots are compared first; of each level only children of nodes that mismatch are
    looked at. A record that one side lacks counts as a difference: its other digest
    is null. A replica with fewer levels lacks the nodes above. Returns file, place,
    offset, length (of the primary, else of the replica), primary and replica digest.
    """
    height = max(len(primary), len(replica))

    def level(side: list[DataFrame], k: int) -> DataFrame:
        if k < len(side):
            return side[k].select("file", "node", "offset", "length", "digest")
        return side[0].select("file", "node", "offset", "length", "digest").limit(0)

    suspect = None
    for k in reversed(range(height)):
        one, two = level(primary, k).alias("p"), level(replica, k).alias("r")
        if suspect is not None:
            parent = F.floor(F.col("node") / FANOUT)
            above = suspect.select(F.col("file"), F.col("node").alias("up"))
            one = one.withColumn("up", parent).join(above, ["file", "up"], "left_semi").alias("p")
            two = two.withColumn("up", parent).join(above, ["file", "up"], "left_semi").alias("r")
        both = one.join(
            two, (F.col("p.file") == F.col("r.file")) & (F.col("p.node") == F.col("r.node")), "full"
        ).filter(~F.col("p.digest").eqNullSafe(F.col("r.digest")))
        suspect = written(both.select(
            F.coalesce("p.file", "r.file").alias("file"), F.coalesce("p.node", "r.node").alias("node"),
            F.coalesce("p.offset", "r.offset").alias("offset"),
            F.coalesce("p.length", "r.length").alias("length"),
            F.col("p.digest").alias("primary_digest"), F.col("r.digest").alias("replica_digest"),
        ), "suspect")
    return suspect.withColumnRenamed("node", "place")


def damaged(records: DataFrame, one_in: int = 20) -> DataFrame:
    """A replica as an unreliable store might return it, the same on every run.

    Of about every ``one_in``-th record, by a hash of its place, the last byte before
    the closing line ends is lost, a byte is replaced, or the whole record is missing.
    """
    draw = F.pmod(F.xxhash64("file", "place"), F.lit(3 * one_in))
    size = F.octet_length("data")
    spot = (size / 2).cast("int")
    flipped = F.concat(
        F.col("data").substr(F.lit(1), spot - 1),
        F.lit(b"\xff"), F.col("data").substr(spot + 1, size),
    )
    cut = F.col("data").substr(F.lit(1), size - 5)
    data = F.when(draw == 0, flipped).when(draw == 1, cut).otherwise(F.col("data"))
    return records.filter(draw != 2).withColumn("data", data)
