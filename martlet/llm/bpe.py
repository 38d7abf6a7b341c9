"""Byte-level BPE with a rank queue.

All distinct pre-tokens of a batch stand in one linked list of byte positions, with a
stop after each. A queue has a bucket for each merge rank; a bucket holds the
positions whose pair has that rank. A hierarchical bitmap over the ranks finds the
lowest filled bucket by find-first-set. Merging a bucket changes neighbours' pairs,
which go to the buckets of their new ranks; old entries stay and are skipped as stale
when their bucket's turn comes. A pre-token of n bytes costs O(n) bucket entries,
whatever its length, and a bucket's positions are merged by array operations.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import ship, text_of

#: Rank of pairs that do not merge.
NEVER = np.int64(1) << 40
#: A task forgets its pre-tokens when it knows more than this many.
KNOWN = 1_000_000
_WORD = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class FirstSet:
    """A set of small numbers as a hierarchy of bitmaps with 64 children a node."""

    def __init__(self, size: int) -> None:
        self.levels = [[0] * (-(-size // _WORD))]
        while len(self.levels[-1]) > 1:
            self.levels.append([0] * (-(-len(self.levels[-1]) // _WORD)))

    def add(self, number: int) -> None:
        for level in self.levels:
            number, bit = divmod(number, _WORD)
            level[number] |= 1 << bit

    def remove(self, number: int) -> None:
        for level in self.levels:
            number, bit = divmod(number, _WORD)
            level[number] &= ~(1 << bit)
            if level[number]:
                break

    def first(self) -> int:
        """The lowest member, or -1."""
        place = 0
        for level in reversed(self.levels):
            node = level[place]
            if not node:
                return -1
            place = place * _WORD + (node & -node).bit_length() - 1
        return place


class RankQueue:
    """Buckets of positions by rank."""

    def __init__(self, ranks: int) -> None:
        self.filled = FirstSet(ranks)
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        """Put each position into the bucket of its rank; NEVER is left out."""
        some = ranks < NEVER
        if not some.all():
            positions, ranks = positions[some], ranks[some]
        if not len(ranks):
            return
        if len(ranks) > 1:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for low, high in zip(cuts, cuts[1:]):
            rank = int(ranks[low])
            bucket = self.buckets.get(rank)
            if bucket is None:
                self.buckets[rank] = [positions[low:high]]
                self.filled.add(rank)
            else:
                bucket.append(positions[low:high])

    def pop(self, span: int) -> tuple[int, np.ndarray]:
        """The lowest filled rank and its positions in order; with a ``span`` of a bitmap
        word, the first rank of the lowest filled word and the positions of all its
        ranks. -1 and none if the queue is empty."""
        first = self.filled.first()
        if first < 0:
            return first, np.zeros(0, dtype=np.int64)
        begin = first // span * span
        word = self.filled.levels[0][first // _WORD]
        parts: list[np.ndarray] = []
        for rank in range(first, begin + span):
            if word >> rank % _WORD & 1:
                self.filled.remove(rank)
                parts += self.buckets.pop(rank)
        if len(parts) == 1:
            return begin, parts[0]
        places = np.sort(np.concatenate(parts))
        return begin, places[np.append(True, places[1:] != places[:-1])]


class Merges:
    """Ranks of all pairs of tokens that make a token, for lookups by array."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.size = max(ranks.values()) + 1
        self.bytes = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        keys, made = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    made.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.made = np.array(made, dtype=np.int64)[order]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NEVER)
        wanted = left * self.size + right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.made[at], NEVER)


def encode_tokens(
    tokens: list[bytes], merges: Merges, span: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pre-tokens, one after the other, and how many each has.

    The order of merges inside a pre-token is that of always merging its lowest-ranked,
    leftmost pair; different pre-tokens do not depend on each other. So of the
    positions popped, those of each pre-token's lowest rank are merged and the others
    put back. Positions of one rank are merged together as long as that makes no pair
    of a lower rank: from the first such merge on, the rest of them wait.
    """
    sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.uint32), np.zeros(len(tokens), dtype=np.int64)
    owner = np.repeat(np.arange(len(tokens)), sizes)
    # place n stands for "none" on either side
    token = np.empty(n + 1, dtype=np.int64)
    token[:n], token[n] = merges.single[data], 0
    after = np.arange(1, n + 2)
    before = np.arange(-1, n)
    ends = np.cumsum(sizes[sizes > 0])
    after[ends - 1] = n
    before[ends - sizes[sizes > 0]] = n
    after[n] = before[n] = n
    pair = np.full(n + 1, NEVER)
    inner = np.flatnonzero(after[:n] < n)
    pair[inner] = merges.rank(token[inner], token[after[inner]])
    alive = np.ones(n, dtype=bool)
    queue = RankQueue(merges.size)
    queue.push(inner, pair[inner])
    while True:
        begin, places = queue.pop(span)
        if begin < 0:
            break
        ranks = pair[places]
        fresh = (ranks >= begin) & (ranks < begin + span)  # the others are stale
        if not fresh.all():
            places, ranks = places[fresh], ranks[fresh]
        if not len(places):
            continue
        if len(places) > 1:
            places, ranks, waiting = _mergeable(places, ranks, token, after, before, owner, merges)
            queue.push(waiting, pair[waiting])
        gone = after[places]
        alive[gone] = False
        pair[gone] = NEVER
        token[places] = ranks
        right = after[gone]
        after[places] = right
        before[right] = places
        before[n] = n
        left = before[places]
        fresh = np.where(right < n, merges.rank(token[places], token[right]), NEVER)
        pair[places] = fresh
        queue.push(places, fresh)
        some = left < n
        if some.any():
            left, mine = left[some], places[some]
            fresh = merges.rank(token[left], token[mine])
            pair[left] = fresh
            queue.push(left, fresh)
        pair[n] = NEVER
    kept = np.flatnonzero(alive)
    counts = np.bincount(owner[kept], minlength=len(tokens))
    return token[kept].astype(np.uint32), counts


def _mergeable(places, ranks, token, after, before, owner, merges):
    """Positions merged now, their ranks, and positions that wait.

    When a position is merged, the pairs around it are its left neighbour (already
    merged if that is the position before) with the new token, and the new token with
    its right neighbour as it still is.
    """
    none = len(token) - 1
    mine = owner[places]
    first = np.concatenate(([True], mine[1:] != mine[:-1]))
    waiting = places[:0]
    if not first.all():
        starts = np.flatnonzero(first)
        lowest = np.minimum.reduceat(ranks, starts)
        now = ranks == np.repeat(lowest, np.diff(np.append(starts, len(places))))
        waiting = places[~now]
        places, ranks = places[now], ranks[now]
        # of a chain of pairs that overlap, every second is merged
        chained = before[places[1:]] == places[:-1]
        if chained.any():
            start = np.flatnonzero(np.concatenate(([True], ~chained)))
            run = np.arange(len(places)) - np.repeat(start, np.diff(np.append(start, len(places))))
            places, ranks = places[run % 2 == 0], ranks[run % 2 == 0]
        mine = owner[places]
        first = np.concatenate(([True], mine[1:] != mine[:-1]))
        if first.all():
            return places, ranks, waiting
        gone = after[places]
        right = after[gone]
        low = (right < none) & (merges.rank(ranks, token[right]) < ranks)
        left = before[places]
        joined = np.concatenate(([False], left[1:] == gone[:-1])) & (left < none)
        left_token = np.where(joined, ranks, token[left])
        low |= (left < none) & (merges.rank(left_token, ranks) < ranks)
        if low.any():
            seen = np.cumsum(low) - low
            wait = seen > np.maximum.accumulate(np.where(first, seen, 0))
            waiting = np.concatenate((waiting, places[wait]))
            places, ranks = places[~wait], ranks[~wait]
    return places, ranks, waiting


#: Bytes up to which pre-tokens are merged together.
SHORT = 64

#: White space as Unicode defines it, for the inside of a character class.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Stretches that no pre-token crosses: a run of other signs with the one space before
#: it, and what is left of a run of white space.
STRETCH = f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"


_PLAIN_WORD = re.compile(r" ?[A-Za-z]+").fullmatch


def _gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of ``pool``, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - ends + sizes, sizes) + np.arange(total)]


class Encoder:
    """Encodes texts, remembering the stretches it has met.

    ``pattern`` finds the pre-tokens. If it is one whose matches never go from a sign
    to white space (like the pattern of the public vocabularies), a text can first be
    cut into stretches, and each distinct one is matched and merged only once.
    """

    def __init__(self, merges: Merges, pattern: str, known: int = KNOWN) -> None:
        self.merges, self.find, self.most = merges, regex.compile(pattern).findall, known
        self.stretches = re.compile(STRETCH).findall
        self._forget()

    def _forget(self) -> None:
        self.place: defaultdict[str, int] = defaultdict()
        self.place.default_factory = self.place.__len__
        self.start = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _learn(self, fresh: list[str]) -> None:
        plain = _PLAIN_WORD  # one pre-token, whatever the pattern says about other signs
        found = [(s,) if plain(s) else self.find(s) for s in fresh]
        distinct: dict[str, int] = {}
        used = [distinct.setdefault(t, len(distinct)) for tokens in found for t in tokens]
        tokens = [t.encode() for t in distinct]
        size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        # a word of ranks at a time over the short ones together, a rank over each long one
        parts = [np.flatnonzero(size <= SHORT), *np.flatnonzero(size > SHORT)[:, None]]
        pool, start = [], np.zeros(len(tokens), dtype=np.int64)
        made = np.zeros(len(tokens), dtype=np.int64)
        filled = 0
        for part in parts:
            ids, counts = encode_tokens(
                [tokens[i] for i in part], self.merges, _WORD if len(part) > 1 else 1
            )
            pool.append(ids)
            made[part] = counts
            start[part] = filled + np.cumsum(counts) - counts
            filled += len(ids)
        sizes = made[used]
        ids = _gather(np.concatenate(pool), start[used], sizes)
        ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))
        upto = np.concatenate(([0], np.cumsum(sizes)))
        sizes = np.diff(upto[ends], prepend=0)
        self.start = np.concatenate((self.start, len(self.ids) + upto[ends] - sizes))
        self.size = np.concatenate((self.size, sizes))
        self.ids = np.concatenate((self.ids, ids))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.start) > self.most:
            self._forget()
        place = self.place.__getitem__
        used = [np.array(list(map(place, self.stretches(text))), dtype=np.int32) for text in texts]
        fresh = list(islice(self.place, len(self.start), None))
        if fresh:
            self._learn(fresh)
        for tokens in used:
            yield _gather(self.ids, self.start[tokens], self.size[tokens])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.merges.bytes.__getitem__, ids.tolist()))


#: Characters encoded together; bounds what a task holds beside its Arrow batch.
TOGETHER = 16_000_000


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Encode the column text of every row and decode the ids again.

    Returns ``doc`` (a struct of all columns but text, whatever their names), n_tokens,
    ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256 and, if
    asked for, ``ids``. A null text counts as empty and has no ids; null ids and
    repeated rows are rows like others; an empty table gives an empty result. The rank
    file is read on the driver and sent with the tasks.
    """
    ship(__name__)
    ranks = read_ranks(ranks_path)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(ranks)  # one vocabulary, whatever the corpus
    others = [c for c in docs.columns if c != "text"]
    carried = F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("__none"))
    frame = docs.select(carried.alias("doc"), text_of().alias("text"))
    doc_type = frame.schema["doc"].dataType.simpleString()
    schema = f"doc {doc_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if keep_ids else ""

    def run(batches):
        encoder = Encoder(Merges(sent.value), pattern)
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = []
            low = 0
            while low < len(texts):
                high, chars = low, 0
                while high < len(texts) and (high == low or chars + len(texts[high]) <= TOGETHER):
                    chars += len(texts[high])
                    high += 1
                for ids in encoder.encode(texts[low:high]):
                    row = (
                        len(ids),
                        hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                        hashlib.sha256(encoder.decode(ids)).hexdigest(),
                    )
                    rows.append((*row, ids.astype(np.int32)) if keep_ids else row)
                low = high
            columns = list(zip(*rows)) if rows else [[] for _ in range(4 if keep_ids else 3)]
            arrays = [batch.column("doc"), pa.array(columns[0], pa.int64())]
            arrays += [pa.array(c, pa.string()) for c in columns[1:3]]
            names = ["doc", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                arrays.append(pa.array([x.tolist() for x in columns[3]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return frame.mapInArrow(run, schema)
