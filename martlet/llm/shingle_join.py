"""N-gram Jaccard self-join with token-combination prefixes.

A document's set holds its distinct shingles, as 64-bit hashes. All sets are ordered
by the same order of tokens: rare before frequent, as told by counts over the whole
corpus in hashed buckets. A pair that is similar enough misses at most e = |x| / 4
tokens of either set, so it shares a signature of prefixes long enough to survive e
losses. Rare tokens are signatures alone. Frequent tokens are dealt to cells by hash
and only pairs of tokens in one cell are signatures; n tokens in a cell then survive
n - 1 losses, and the prefix is extended until all cells together survive e.

The number of cells grows with the size of a set, in bands; bands overlap, so two
similar sets have a band in common. In the first band all tokens count alone.

Sets that are equal collapse into one class before anything is compared. Every class is
first compared with a few first classes of its signatures' groups; classes that are then
still in different components are compared in blocks of their groups.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.llm.common import components, ship, small_side, text_of
from martlet.session import written

WORDS = 5
#: Similarity: intersection * TIMES >= union * LEAST, and the losses it allows.
LEAST, TIMES = 75, 100
#: Buckets of the corpus counts: what each task sends and the driver gets.
BUCKETS = 1 << 20
#: Sets up to this size are in the first band; each further band is four times as
#: wide, with CELLS cells times the same power. 0.75 * 0.75 * FIRST > CELLS keeps
#: every set of a band large enough for its cells.
FIRST, CELLS = 120, 64
#: A signature expected in more than this many documents is dealt over several tasks.
GROUP = 2000
#: Words of 64 bits in the parity map of a set: bit i tells whether an odd number of its
#: tokens hash to i. Two maps differ in at most as many bits as the sets in tokens.
MAP_WORDS = 8
#: Bits that tell which classes are compared; only a sieve before a join.
SIEVE_BITS = 1 << 23
#: First classes that a class is compared with before all others.
LEADS = 3
#: Classes of a block in which members of a group are compared: a row is sent once for each
#: block it meets, so larger blocks shuffle less. Rows and pairs of blocks that a task looks
#: at together, and found pairs that it holds before it sends them: its memory is a few dozen
#: MB, however alike the texts are.
BLOCK, TOGETHER, PAIRS, HELD = 4096, 50_000, 1 << 16, 1 << 18
#: Rounds in which only the closest pairs of two components are verified, at most; another
#: one follows only if the last joined one pair in WORTH.
ROUNDS, WORTH = 2, 4
#: Words of 64 bits of a finer parity map, which decides whether texts are compared.
FINE_WORDS = 64
#: Signatures are cut to 48 bits, which shuffle smaller; two that become equal only share
#: a group, and lose nothing.
SHORT = np.uint64((1 << 48) - 1)
#: Rows, most of them with texts, that go to a Python task and back at once.
BATCH = 1000
#: Letters of a word whose values are looked up.
TABLED = 64

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher: a bijection that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of texts.

    A word's hash is the sum of one random value for each of its bytes and their places
    in the word, and its length; no pattern of bytes cancels out, at whatever length.
    """

    def __init__(self) -> None:
        self.gap = np.zeros(256, dtype=bool)
        self.gap[[9, 10, 11, 12, 13, 32]] = True
        self.weights = _mix(np.arange(1001, 1001 + WORDS, dtype=np.uint64) * _ODD) | np.uint64(1)
        self.table = self._value(np.arange(256 * TABLED, dtype=np.uint64))

    @staticmethod
    def _value(place_and_byte: np.ndarray) -> np.ndarray:
        return _mix((place_and_byte + np.uint64(1)) * _ODD)

    def words(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode().lower(), dtype=np.uint8)
        n = len(data)
        gap = np.ones(n + 2, dtype=np.int8)
        gap[1:-1] = self.gap[data]
        turn = np.diff(gap)
        start, end = np.flatnonzero(turn < 0), np.flatnonzero(turn > 0)
        if not len(start):
            return np.zeros(0, dtype=np.uint64)
        sizes = end - start
        ends = np.cumsum(sizes)
        letters = data[gap[1:-1] == 0]
        place = np.arange(len(letters)) - np.repeat(ends - sizes, sizes)
        key = (place << 8) | letters
        if sizes.max() <= TABLED:
            values = self.table[key]
        else:
            values = self._value(key.astype(np.uint64))
        return _mix(np.add.reduceat(values, ends - sizes) + sizes.astype(np.uint64))

    def __call__(self, text: str) -> np.ndarray:
        words = self.words(text)
        n = len(words)
        if n == 0:
            return words
        if n < WORDS:
            whole = (words * self.weights[:n]).sum(dtype=np.uint64) + np.uint64(n)
            return _mix(whole[None] * _ODD)
        out = words[: n - WORDS + 1] * self.weights[0]
        for k in range(1, WORDS):
            out = out + words[k : n - WORDS + 1 + k] * self.weights[k]
        out = np.sort(_mix(out))
        return out[np.concatenate(([True], out[1:] != out[:-1]))]


def set_class(tokens: np.ndarray) -> int:
    """A 64-bit digest of a set; equal sets have equal classes."""
    total = _mix(tokens ^ _ODD).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(_mix(total[None]).astype(np.int64)[0])


def bucket_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def parity_map(tokens: np.ndarray, words: int = MAP_WORDS) -> np.ndarray:
    """The parity map of a set, as signed words."""
    bits = 64 * words
    odd = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def bands(size: int) -> list[int]:
    """Bands of a set: 0 up to FIRST, then k for 0.75 T < size <= 4 T, T = FIRST * 4^(k-1)."""
    out = [0] if size <= FIRST else []
    band, low = 1, FIRST
    while 4 * size > 3 * low:
        if size <= 4 * low:
            out.append(band)
        band, low = band + 1, low * 4
    return out


def signatures(tokens: np.ndarray, counts: np.ndarray, usual: float, frequent: float):
    """Signatures of a set; for each, how many cells its group is dealt over, and its room.

    The room is the number of the set's tokens from that one on. The first token that
    two sets share in the common order is a signature of both if it is rare, and all
    they share lies in its rooms; a pair of frequent tokens has the whole set as room.
    """
    size = len(tokens)
    losses = size - -(-size * LEAST // TIMES)
    seen = counts[bucket_of(tokens)]
    order = np.lexsort((tokens, seen))
    tokens, seen = tokens[order], seen[order]
    rare = int(np.searchsorted(seen, frequent, side="right"))
    out, many, room = [], [], []
    for band in bands(size):
        salt = np.uint64(band * int(_ODD) % (1 << 64))
        alone = losses + 1 if band == 0 else min(rare, losses + 1)
        out.append(_mix(tokens[:alone] + salt))
        many.append(seen[:alone])
        room.append(size - np.arange(alone))
        missing = losses + 1 - alone
        if missing <= 0:
            continue
        often, their = tokens[rare:], seen[rare:]
        cell = (_mix(often ^ salt) % np.uint64(CELLS << 2 * (band - 1))).astype(np.int64)
        new = np.zeros(len(often), dtype=bool)
        new[np.unique(cell, return_index=True)[1]] = True
        stop = int(np.searchsorted(np.cumsum(~new), missing)) + 1
        by_cell = np.lexsort((often[:stop], cell[:stop]))
        often, their, cell = often[:stop][by_cell], their[:stop][by_cell], cell[:stop][by_cell]
        apart = 1
        while apart < stop:
            same = np.flatnonzero(cell[apart:] == cell[:-apart])
            if not len(same):
                break
            one, two = often[same], often[same + apart]
            out.append(_mix(_mix(one + salt) * np.uint64(3) + two))
            many.append(np.minimum(their[same], their[same + apart]))
            room.append(np.full(len(same), size))
            apart += 1
    many = np.concatenate(many)
    dealt = np.maximum(1, np.ceil((many - usual) / GROUP)).astype(np.int64)
    return np.concatenate(out), dealt, np.concatenate(room)


def _texts(batches):
    """(batch, text) of every row; a null text is empty."""
    for batch in batches:
        yield batch, batch.column("text").to_pylist()


def sketch(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Size, class and parity map of every row, and the corpus counts of shingles by bucket.

    ``docs`` has id and text. Counts come as one sparse row for each task.
    """
    ship(__name__)
    import pyarrow as pa

    def run(batches):
        shingler, counts = Shingler(), np.zeros(BUCKETS, dtype=np.int64)
        pending: list[np.ndarray] = []
        schema = pa.schema([
            ("id", id_type), ("row", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()),
            ("map", pa.list_(pa.int64())), ("bucket", pa.list_(pa.int32())), ("count", pa.list_(pa.int64())),
        ])
        for batch, texts in _texts(batches):
            sizes, classes, maps = [], [], []
            for text in texts:
                tokens = shingler(text)
                sizes.append(len(tokens))
                maps.append(parity_map(tokens))
                classes.append(set_class(tokens) if len(tokens) else None)
                pending.append(bucket_of(tokens))
                if len(pending) == 1000:
                    counts += np.bincount(np.concatenate(pending), minlength=BUCKETS)
                    pending.clear()
            none = pa.nulls(len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.array(sizes, pa.int64()),
                 pa.array(classes, pa.int64()), pa.array(maps, pa.list_(pa.int64())),
                 none.cast(schema.field("bucket").type),
                 none.cast(schema.field("count").type)], schema=schema)
        if pending:
            counts += np.bincount(np.concatenate(pending), minlength=BUCKETS)
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                 pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int64())), pa.array([some], schema.field("bucket").type),
                 pa.array([counts[some]], schema.field("count").type)], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_type

    id_spark = docs.schema["id"].dataType
    id_type = to_arrow_type(id_spark)
    out = written(
        docs.mapInArrow(
            run, f"id {id_spark.simpleString()}, row long, n long, cls long, "
                 "map array<long>, bucket array<int>, count array<long>"),
        "sketch",
    )
    zipped = F.explode_outer(F.arrays_zip("bucket", "count")).alias("b")
    rows = (
        out.filter("bucket IS NOT NULL").select(zipped)
        .groupBy("b.bucket").agg(F.sum("b.count").alias("count")).toArrow()
    )
    counts = np.zeros(BUCKETS)
    counts[rows["bucket"].to_numpy()] = rows["count"].to_numpy()
    return out.filter("bucket IS NULL").select("id", "row", "n", "cls", "map"), counts


def _signature_rows(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """A row for each signature of each document: the cell of its group, class, size and
    room in one number, and the signature itself where the group is dealt over several cells."""
    import pyarrow as pa

    usual = float(counts.sum()) / BUCKETS
    frequent = usual + 8 * usual**0.5 + 8
    sent = docs.sparkSession.sparkContext.broadcast(counts)  # BUCKETS numbers

    def run(batches):
        shingler, known = Shingler(), set()
        for _, texts in _texts(batches):
            parts = []
            for text in texts:
                tokens = shingler(text)
                cls = set_class(tokens) if len(tokens) else None
                if cls is None or cls in known:
                    continue
                if len(known) < 1_000_000:  # equal rows of a task once; others later
                    known.add(cls)
                found, dealt, room = signatures(tokens, sent.value, usual, frequent)
                found &= SHORT
                sizes = (len(tokens) << _ROOM_BITS) + room
                parts.append((found, dealt, np.full(len(found), cls), sizes))
            for low in range(0, len(parts), 500):
                found, dealt, cls, sizes = map(np.concatenate, zip(*parts[low : low + 500]))
                mine = _mix(cls.astype(np.uint64)) % dealt.astype(np.uint64)
                cell = np.where(dealt > 1, _mix(found + mine * _ODD + np.uint64(1)), found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((cell & SHORT).astype(np.int64)), pa.array(cls), pa.array(sizes),
                     pa.array(found.astype(np.int64), mask=dealt == 1)],
                    names=["cell", "cls", "sizes", "sig"])

    return docs.select("text").mapInArrow(run, "cell long, cls long, sizes long, sig long")


def _busy(rows: DataFrame) -> DataFrame:
    """Rows (sig, cls, n, room, times) of signatures that several classes may share, each with
    two first classes: of all its cell, and of those of about its size.

    One shuffle by cell; of the signatures, most are alone and go no further. Cells of the
    same classes become one group, with the largest room that each class has in any of them
    and their number: a passage that many texts share goes on once and not once a shingle.
    Two groups that get one number by chance are compared together, which loses nothing.
    """
    width = F.lit(np.log(TIMES / LEAST).item())
    group = Window.partitionBy("cell")
    shared = rows.withColumns({
        "low": F.min("cls").over(group), "last": F.max("cls").over(group),
        "all": F.bit_xor(F.xxhash64("cls")).over(group),
    }).filter("sig IS NOT NULL OR low < last")
    merged = shared.select(
        F.xxhash64("low", "last", "all").bitwiseAND(F.lit(int(SHORT))).alias("of"), "sig", "cls", "sizes"
    ).groupBy("of", F.coalesce("sig", "of").alias("sig"), "cls").agg(
        F.max("sizes").alias("sizes"), F.count(F.lit(1)).alias("times")
    )
    n = F.shiftright("sizes", _ROOM_BITS)
    sized = merged.select(
        "of", "sig", "cls", n.alias("n"), F.col("sizes").bitwiseAND(F.lit((1 << _ROOM_BITS) - 1)).alias("room"),
        "times", F.floor(F.log(n.cast("double")) / width).cast("int").alias("band"),
    )
    first = F.min(F.struct("cls", "n", "room"))
    return sized.withColumns({
        "top": first.over(Window.partitionBy("of")), "lead": first.over(Window.partitionBy("of", "band")),
    }).select("sig", "cls", "n", "room", "times", "top", "lead")


#: What a pair needs: an intersection of at least LEAST / (TIMES + LEAST) of both sizes
#: together fits into the rooms (and so into the sizes).
_FITS = f"least(room, space) * {TIMES + LEAST} >= (n + m) * {LEAST}"
_ROOM_BITS = 31


def _star(busy: DataFrame) -> DataFrame:
    """Every class with a few of the first classes of its signatures, those it shares most
    signatures with.

    These pairs only join what is obviously alike; ``_across`` finds all other links.
    """
    both = F.explode(F.array_distinct(F.array("top", "lead"))).alias("first")
    met = busy.select("cls", "n", "room", "times", both).select(
        "cls", "n", "room", "times", F.col("first.cls").alias("other"), F.col("first.n").alias("m"),
        F.col("first.room").alias("space"),
    )
    shared = met.filter(f"cls <> other AND {_FITS}").groupBy("cls", "other").agg(F.sum("times").alias("times"))
    best = Window.partitionBy("cls").orderBy(F.col("times").desc(), "other")
    few = shared.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= LEADS)
    return few.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct()


def _open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (sig, cls, n, room, root, size of the component) of signatures whose classes are
    in several components. Components only grow, so no other signature opens later."""
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    sized = written(roots.join(sizes, "root"), "sized")
    placed = rows.select("sig", "cls", "n", "room").join(
        sized.withColumnRenamed("node", "cls"), "cls"
    )
    several = placed.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi")
    return written(placed.join(several.select("sig"), "sig", "left_semi"), "open")


def _across(open_: DataFrame, placed: DataFrame, closest: bool, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) in one signature's group whose classes are in different components p < q,
    and how far ``apart`` their maps are, in thousandths of both sizes. With ``closest``,
    of the pairs of two components only the closest that a task sees.

    Signatures with the same classes are one group, with the largest room each class
    has in any of them, so that a passage many texts share is compared once and not
    once a shingle. The members of a group's largest component are never compared with
    each other; the rest is dealt in blocks, and a task meets two blocks of a group.
    Groups with the same first class, which mostly share their members, follow each other
    in one task, and a pair found in many of them leaves it once. Sizes, rooms and the maps
    of ``placed`` rule out pairs that must differ in too many tokens, never a link.
    """
    import pyarrow as pa

    members = open_.groupBy("sig").agg(
        F.count(F.lit(1)).alias("many"), F.max(F.struct("size", "root")).alias("most"), F.min("cls").alias("low"),
        F.bit_xor(F.xxhash64("cls")).alias("all"),
    ).select("sig", F.struct("low", "many", "all").alias("members"), "most.root")
    mixed = open_.join(members.withColumnRenamed("root", "most"), "sig").groupBy("members", "cls").agg(
        F.max("room").alias("room"), F.first("n").alias("n"), F.first("root").alias("root"),
        F.first(F.col("root") == F.col("most")).alias("main"),
    )
    mixed = written(mixed.select("members.*", "cls", "room", "n", "root", "main"), "mixed")
    key = ["low", "many", "all"]
    large = mixed.filter(F.col("many") > block).groupBy(*key).agg(
        F.count_if("main").alias("ours"), F.count_if(~F.col("main")).alias("others")
    )

    def blocks(rows_: str):  # a power of two, so that groups of like sizes are cut alike
        return F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col(rows_) / block, F.lit(1.0))))).cast("int")

    cut = mixed.join(
        large.select(*key, blocks("ours").alias("p_main"), blocks("others").alias("p_rest")), key, "left"
    ).fillna(1, ["p_main", "p_rest"]).withColumn("part", F.pmod(F.xxhash64("cls"), F.when(F.col("main"), F.col("p_main")).otherwise(F.col("p_rest"))).cast("int"))
    rest = F.sequence(F.lit(0), F.col("p_rest") - 1)
    main = F.sequence(F.lit(0), F.col("p_main") - 1)

    def unit(i, j, side):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    # side: 1 left, 2 right, 3 both
    part = F.col("part")
    units = F.when(
        F.col("main"), F.transform(rest, lambda i: unit(i, F.col("p_rest") + part, F.lit(2)))
    ).otherwise(F.concat(
        F.transform(rest, lambda q: unit(F.least(q, part), F.greatest(q, part), F.when(q == part, 3).when(q < part, 2).otherwise(1))),
        F.transform(main, lambda q: unit(part, F.col("p_rest") + q, F.lit(1))),
    ))
    words = [f"w{i}" for i in range(MAP_WORDS)]
    maps = placed.join(mixed.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(
        F.first("map").alias("map")
    ).select("cls", *[F.col("map")[i].alias(w) for i, w in enumerate(words)])
    order = ["low", "i", "j", "many", "all"]
    dealt = cut.select(*key, "cls", "room", "n", "root", F.explode(units).alias("unit")).select(
        *key, "cls", "room", "n", "root", "unit.*"
    ).join(maps, "cls").repartition("low", "i", "j").sortWithinPartitions(*order)

    def batch(pairs: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in pairs.T.copy()], names=["p", "q", "apart", "a", "b"])

    def run(batches):
        held, many = [], 0
        for table in _whole_units(batches, order):
            column = {c: table.column(c).to_numpy() for c in ("cls", "room", "n", "root", "side", "unit")}
            bits = np.stack([table.column(w).to_numpy() for w in words], axis=1).view(np.uint64)
            for p, q in _meetings(column["unit"], column["side"]):
                n, m = column["n"][p], column["n"][q]
                fits = np.minimum(column["room"][p], column["room"][q]) * (TIMES + LEAST) >= (n + m) * LEAST
                fits &= column["root"][p] != column["root"][q]
                p, q, both = p[fits], q[fits], (n + m)[fits]
                apart = np.bitwise_count(bits[p] ^ bits[q]).sum(axis=1, dtype=np.int64)
                near = apart * (TIMES + LEAST) <= both * (TIMES - LEAST)
                p, q = p[near], q[near]
                if not len(p):
                    continue
                ends = [f(column[c][p], column[c][q]) for c in ("root", "cls") for f in (np.minimum, np.maximum)]
                held.append(_sifted(np.stack([*ends[:2], 1000 * apart[near] // both[near], *ends[2:]], axis=1), closest))
                many += len(held[-1])
                if many < HELD:
                    continue
                held = [_sifted(np.concatenate(held), closest)]
                many = len(held[0])
                if many >= HELD // 2:  # sifting does not help; the rows are sifted again later
                    yield batch(held[0])
                    held, many = [], 0
        if many:
            yield batch(_sifted(np.concatenate(held), closest))

    return dealt.mapInArrow(run, "p long, q long, apart long, a long, b long").distinct()


def _sifted(pairs: np.ndarray, closest: bool) -> np.ndarray:
    """Distinct rows (p, q, apart, a, b), in order; with ``closest`` the first of each p, q."""
    pairs = np.unique(pairs, axis=0)
    if not closest or not len(pairs):
        return pairs
    return pairs[np.concatenate(([True], (pairs[1:, :2] != pairs[:-1, :2]).any(axis=1)))]


def _whole_units(batches, key: list[str]):
    """Tables of whole units (rows of one key, which follow each other), with their number
    in ``unit``; of about ``TOGETHER`` rows, or one unit."""
    import pyarrow as pa

    def numbered(table):
        change = np.zeros(len(table), dtype=bool)
        for c in key:
            values = table.column(c).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.cumsum(change)

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < TOGETHER:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        unit = numbered(table)
        last = int(np.searchsorted(unit, unit[-1]))  # the last unit may go on
        if last:
            yield table.slice(0, last).append_column("unit", pa.array(unit[:last]))
        held, rows = table.slice(last).to_batches(), len(table) - last
    if rows:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table.append_column("unit", pa.array(numbered(table)))


def _meetings(unit: np.ndarray, side: np.ndarray):
    """Places (p, q) of all left rows with all right rows of their unit, a slice at a time;
    of two rows that are both, each pair once."""
    left, right = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
    start = np.searchsorted(unit[right], unit[left], "left")
    # of rows on both sides only the later ones
    inside = np.searchsorted(right, left, "right")
    start = np.where(side[left] == 3, inside, start)
    count = np.searchsorted(unit[right], unit[left], "right") - start
    upto = np.cumsum(count)
    low = 0
    while low < len(left):
        done = upto[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
        n = count[low:high]
        if n.sum():
            p = np.repeat(left[low:high], n)
            q = right[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[low:high], n)]
            yield p, q
        low = high


def _one_text(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """A text, its size n and its finer parity map for each class of ``wanted`` (cls).

    A sieve of hashed bits, of fixed size, keeps most other texts out of the shuffle;
    the join decides.
    """
    import pyarrow as pa

    bit = F.pmod("cls", F.lit(SIEVE_BITS))
    words = (
        wanted.groupBy(F.floor(bit / 32).cast("long").alias("word"))
        .agg(F.bit_or(F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.pmod("cls", F.lit(32)).cast("int")
        )).alias("bits"))
        .toArrow()
    )
    sieve = np.zeros(SIEVE_BITS // 32, dtype=np.int64)
    sieve[words["word"].to_numpy()] = words["bits"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(sieve)

    def run(batches):
        shingler, known = Shingler(), set()
        for _, texts in _texts(batches):
            kept, classes, sizes, maps = [], [], [], []
            for text in texts:
                tokens = shingler(text)
                if not len(tokens):
                    continue
                cls = set_class(tokens)
                bit = cls % SIEVE_BITS
                if not sent.value[bit // 32] >> (bit % 32) & 1 or cls in known:
                    continue
                if len(known) < 1_000_000:
                    known.add(cls)
                kept.append(text)
                classes.append(cls)
                sizes.append(len(tokens))
                maps.append(parity_map(tokens, FINE_WORDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.int64()), pa.array(kept, pa.string()), pa.array(sizes, pa.int64()),
                 pa.array(maps, pa.list_(pa.int64()))], names=["cls", "text", "n", "map"])

    texts = docs.select("text").mapInArrow(run, "cls long, text string, n long, map array<long>")
    # sets of one class are equal, so any of its rows will do
    return texts.join(wanted, "cls", "left_semi").groupBy("cls").agg(
        *[F.first(c).alias(c) for c in ("text", "n", "map")]
    )


def verify(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of the candidate pairs (a, b), those whose sets are similar enough. ``texts`` is that
    of ``_one_text``; its maps rule most other pairs out before texts are shuffled."""
    import pyarrow as pa

    a = texts.select(F.col("cls").alias("a"), "n", "map")
    b = texts.select(F.col("cls").alias("b"), F.col("n").alias("m"), F.col("map").alias("other"))
    apart = F.aggregate(
        F.zip_with("map", "other", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x
    )
    pairs = written(
        pairs.join(a, "a").join(b, "b").filter(apart * (TIMES + LEAST) <= (F.col("n") + F.col("m")) * (TIMES - LEAST))
        .select("a", "b"), "near",
    )
    sides = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls")))
    texts = texts.join(written(sides.distinct(), "sides"), "cls", "left_semi")
    one = texts.select(F.col("cls").alias("a"), F.col("text").alias("one"))
    two = texts.select(F.col("cls").alias("b"), F.col("text").alias("two"))

    def run(batches):
        shingler = Shingler()
        last: dict[str, tuple[int, np.ndarray]] = {}

        def tokens(side: str, cls: int, text: str) -> np.ndarray:
            if side not in last or last[side][0] != cls:  # rows of one class often follow each other
                last[side] = (cls, shingler(text))
            return last[side][1]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            kept = []
            for i, (p, q, s, t) in enumerate(zip(a, b, batch.column("one").to_pylist(), batch.column("two").to_pylist())):
                x, y = tokens("a", p, s), tokens("b", q, t)
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                if both * TIMES >= (len(x) + len(y) - both) * LEAST:
                    kept.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in kept], pa.int64()), pa.array([b[i] for i in kept], pa.int64())],
                names=["a", "b"])

    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return joined.mapInArrow(run, "a long, b long")


def _merged(roots: DataFrame, joined: DataFrame) -> DataFrame:
    """``roots`` after the components p and q of each row of ``joined`` became one."""
    edges = written(joined.select(F.col("p").alias("a"), F.col("q").alias("b")).distinct(), "edges")
    ends = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    moved = components(ends, edges).select(F.col("node").alias("root"), F.col("root").alias("to"))
    return roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))


@contextmanager
def _small_batches(spark: SparkSession):
    """Spark's 10,000 rows of texts take tens of MB, several times on either side of a task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), BATCH) if int(before) > 0 else BATCH))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _grouped(docs: DataFrame) -> DataFrame:
    """``row``, id, n and component_id of every row of ``docs`` (id, row, text). All Python
    tasks run in here; the frame that is returned only joins what they wrote."""
    ship(__name__)
    with _small_batches(docs.sparkSession):
        return _linked(docs)


def _linked(docs: DataFrame) -> DataFrame:
    placed, counts = sketch(docs)
    busy = written(_busy(_signature_rows(docs, counts)), "busy")
    nodes = written(busy.select(F.col("cls").alias("node")).distinct(), "nodes")
    texts = written(_one_text(docs, nodes.withColumnRenamed("node", "cls")), "texts")
    pairs = written(_star(busy), "star")
    roots = written(components(nodes, written(verify(texts, pairs), "links")), "roots")
    open_, rounds = busy, ROUNDS
    while True:
        open_ = _open(open_, roots)
        # one pair of each two components, which mostly joins many more; then all that is left
        closest = rounds > 0
        found = written(_across(open_, placed, closest), "across")
        if closest:
            found = found.groupBy("p", "q").agg(F.min(F.struct("apart", "a", "b")).alias("best")).select(
                "p", "q", "best.a", "best.b"
            )
        tried = written(found.select("p", "q", "a", "b"), "tried")
        if tried.isEmpty():
            break
        links = written(verify(texts, tried.select("a", "b")), "links")
        roots = written(_merged(roots, links.join(tried, ["a", "b"]).select("p", "q")), "roots")
        if not closest:
            break
        rounds = rounds - 1 if links.count() * WORTH >= tried.count() else 0
    class_root = placed.filter("cls IS NOT NULL").join(
        roots, placed["cls"] == roots["node"], "left"
    ).select("id", "row", "n", F.coalesce("root", "cls").alias("root"))
    class_root = written(class_root, "placed")
    least = class_root.groupBy("root").agg(F.min("id").alias("component_id"))
    linked = class_root.join(least, "root").select("row", "id", "n", "component_id")
    alone = placed.filter("cls IS NULL").select("row", "id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Component of every row of ``docs`` (doc_id, text) under Jaccard >= 0.75 of shingles.

    Returns row (position in the input), doc_id, n_shingles and component_id, the
    smallest doc_id that links reach. Null and empty texts and texts without words
    have empty sets and link with nothing; rows with a null id link like others, and a
    component without any id has a null one; repeated rows are in one component; an
    empty table gives an empty result. Other columns are not looked at.
    """
    return _grouped(docs.select(
        F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("row"), text_of().alias("text")
    )).select("row", F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, and of several
    with that id the first. Rows without words all stay. Columns stay as they are.

    The rows are numbered and written once, so a number means the same row however the
    input is cut into tasks later.
    """
    numbered = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    ), "numbered")
    found = written(_grouped(numbered.select(
        F.col("doc.doc_id").alias("id"), "row", F.coalesce("doc.text", F.lit("")).alias("text")
    )).filter("n > 0").select("row", "id", "component_id"), "found")
    first = found.groupBy("component_id").agg(
        F.min_by("row", F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))).alias("row")
    )
    gone = written(found.join(first.select("row"), "row", "left_anti").select("row"), "gone")
    return numbered.join(small_side(gone), "row", "left_anti").select("doc.*")
