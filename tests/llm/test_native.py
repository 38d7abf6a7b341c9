"""Operators built of DataFrame functions only."""

import hashlib
import re
import zlib
from collections import Counter

import pandas as pd

from martlet.llm import mixing, pii, quality_rules, sharding
from martlet.llm.common import table
from martlet.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# sharding


def check_shards(rows, docs, shards=8):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs
    )
    size = Counter()
    for r in rows:
        size[r.shard] += r.size
    total, most = sum(size.values()), max(r.size for r in rows)
    assert all(0 <= s < shards and abs(b - total / shards) <= most for s, b in size.items())
    for shard in size:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_shards_are_even_and_gapless(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    check_shards(QUERIES["op2_sampled_splitters"](spark, sf_dir).collect(), docs)


def test_shards_of_odd_and_no_rows(spark, odd, empty):
    check_shards(
        sharding.shard_documents(odd).collect(), [(r.doc_id, r.text) for r in odd.collect()]
    )
    assert sharding.shard_documents(empty).count() == 0


def test_a_hot_text_is_subdivided(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.shard_documents(docs, ranges=16).collect()
    check_shards(out, rows)
    assert len({r.shard for r in out if r.text_crc32 == zlib.crc32(b"same text")}) >= 5


# personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def counts(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain_spans(text):
    found = [
        (m.start(), place, f"{kind}:{m.start()}:{m.end()}")
        for place, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "") if counts(kind, m[0])
    ]
    return [f[2] for f in sorted(found)]


TRICKY = [
    "a@b.c.d_e@f.g x@y z@@q.w 1.2.3.4.5 256.1.1.1 001.002.003.004 1.2.3.4567",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111 1111 1111 1111 11 41111111111111111111",
    "+1 (017) 555-7713 +12 +4915112345678. é+49 151 1234 5678x ++1 234 567 8901 +1.2.3",
    "+1 234 567890abc@x.de é漢 4242424242424242@x.io 12.34.56.78@9.9.9.9",
    "a" * 30000 + "@" + "b" * 30000, "1" * 40000, "a.a" * 20000 + "@" + "x.y" * 9000,
    "".join(f"u{i}@h{i}.org " for i in range(1500)),
]


def test_base_spans_equal_the_plain_patterns(spark, sf_dir):
    texts = [r.text for r in table(spark, sf_dir, "documents").collect()] + TRICKY
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.find(docs).select("doc.doc_id", pii.listing(pii.base_spans("spans")).alias("s"))
    for r in found.collect():
        assert r.s == ",".join(plain_spans(texts[r.doc_id])), texts[r.doc_id][:80]


def test_query_digests(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    for r in QUERIES["op3_personal_data"](spark, sf_dir).collect():
        spans = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert (r.n_email, r.n_phone) == tuple(sum(s.startswith(k) for s in spans) for k in ("email", "phone"))


def test_added_kinds_need_checksum_or_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 ok", "DE89 3704 0044 0532 0130 01 wrong",
             "ssn 078-05-1120", "part 078-05-1120 of"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.s for r in pii.find(docs).select("doc.doc_id", pii.listing("spans").alias("s")).collect()}
    assert got == {0: "iban:5:32", 1: "", 2: "ssn:4:15", 3: ""}


def test_redaction_covers_and_keeps(spark, odd, empty):
    docs = spark.createDataFrame(
        [(1, "x +1 234 567890abc@x.de y", 9), (2, "clean", 5), (3, None, None)],
        "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(docs).collect()}
    assert got[2] == ("clean", 5) and got[3] == (None, None)
    assert "@" not in got[1][0] and "234" not in got[1][0] and got[1][1] == len(got[1][0])
    out = pii.redact(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert pii.redact(empty).count() == 0


# mixing


def test_mix_of_odd_and_no_rows(spark, odd, empty):
    rows = mixing.mix(odd, ["doc_id"]).collect()
    assert len(rows) == odd.count()
    assert all(r.taken in (0, r.size, 2 * r.size) for r in rows)
    assert mixing.mix(empty, ["doc_id"]).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


def test_targets_and_order_do_not_depend_on_the_layout(spark):
    rows = [(i, f"w{i} " * (i % 40 + 1), f"s{i % 3 if i % 4 else 0}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = sorted(map(tuple, mixing.mix(docs.repartition(1), ["doc_id"]).collect()))
    two = sorted(map(tuple, mixing.mix(docs.repartition(7), ["doc_id"]).collect()))
    assert one == two
    frame = pd.DataFrame(one, columns=mixing.mix(docs, ["doc_id"]).columns)
    by = frame.groupby("mix_source").agg(size=("size", "sum"), t=("target", "first"), k=("taken", "sum"))
    assert abs(by.t.sum() - 1.5 * by["size"].sum()) < 1e-6
    assert (by.t <= 2 * by["size"] + 1e-9).all() and ((by.k - by.t).abs() <= 2 * 40).all()


def test_mixed_documents_repeat_whole_rows(spark, odd):
    out = mixing.mixed_documents(odd)
    assert out.columns == odd.columns
    many = Counter(map(str, out.collect()))
    source = Counter(map(str, odd.collect()))
    assert all(n <= 2 * source[row] for row, n in many.items())


# quality rules


def plain_counts(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    n = len(w)
    return (n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), repeated, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def test_counts_equal_the_plain_version(spark, sf_dir, odd):
    for docs in (table(spark, sf_dir, "documents"), odd):
        rules = quality_rules.judge(docs, spark.createDataFrame([], LABELS)).collect()
        assert len(rules) == docs.count()
        for r in rules:
            assert plain_counts(r.doc.text) == tuple(r[1:7])
            assert r.kept == (not r.base_failed)  # nothing to compare with


def test_ratio_tells_junk(spark):
    good = "the old man and the sea went on and the wind came over the hills again "
    rows = [(i, (good + f"word{i} ") * 2) for i in range(200)]
    rows = [(i, " ".join(f"{w}{i % 7}" for w in t.split())) for i, t in rows]
    junk = [(1000 + i, " ".join(f"{w}&&&" for w in t.split())) for i, t in rows[:40]]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 2)], LABELS)
    got = {r.doc.doc_id: r for r in quality_rules.judge(docs, labels).collect()}
    # so few words say little against the mass of the buckets, but they tell the sides
    assert all(got[i].ratio > 0 > got[1000 + j].ratio for i in range(200) for j in range(40))
    kept = quality_rules.judge(docs, labels, least=0.0).filter("kept").select("doc.doc_id").collect()
    assert {r.doc_id for r in kept} <= set(range(200))


def test_keep_good_keeps_columns(spark, odd, empty):
    labels = spark.createDataFrame([], LABELS)
    assert quality_rules.keep_good(odd, labels).columns == odd.columns
    assert quality_rules.keep_good(empty, labels).count() == 0
