"""Stock movements against a plain fold, with hot products and small chunks."""

import random
from datetime import date, timedelta

import pytest
from frames import rows
from pyspark.sql import functions as F

from martlet.operators import ledger
from martlet.plans import business, extras

KEY = ["product_id", "location_code"]
MOVES = "product_id int, location_code string, seq bigint, quantity bigint, transaction_type string"
STOCK = ("product_id int, location_code string, quantity_on_hand bigint, "
         "quantity_available bigint, quantity_allocated bigint, reorder_point bigint, "
         "last_received_date date")


def fold(moves, opening):
    balance, out = dict(opening), {}
    for product, place, seq, quantity, kind in sorted(moves, key=lambda r: r[2]):
        key = (product, place)
        if key not in balance or kind not in ("RECEIPT", "RETURN", "ADJUSTMENT"):
            continue
        balance[key] = quantity if kind == "ADJUSTMENT" else balance[key] + quantity
        out[seq] = balance[key]
    return balance, out


def random_moves(seed, n=300):
    rnd = random.Random(seed)
    kinds = ["RECEIPT"] * 4 + ["RETURN", "ADJUSTMENT", "SCRAP"]
    return [
        # a third of all movements belong to product 1
        (1 if rnd.random() < 0.34 else rnd.randint(2, 6), "MAIN", i, rnd.randint(1, 9),
         rnd.choice(kinds))
        for i in range(1, n + 1)
    ]


@pytest.mark.parametrize("seed,chunk", [(1, 3), (2, 7), (3, 50), (4, 100_000)])
def test_running_balance_equals_fold(spark, seed, chunk):
    moves = random_moves(seed)
    opening = {(p, "MAIN"): 10 * p for p in range(1, 7)}
    df = spark.createDataFrame(moves, MOVES).withColumn("opening", F.col("product_id") * 10)
    got = ledger.running(df, KEY, F.col("opening"), chunk)
    _, want = fold(moves, opening)
    assert dict(rows(got, "seq", "balance")) == want


@pytest.mark.parametrize("seed", [5, 6])
def test_closing_stock_equals_fold(spark, seed):
    moves = random_moves(seed)
    stock = [(p, "MAIN", 10 * p, 10 * p, 0, 5, None) for p in range(1, 9)]
    got = business.apply_moves(
        spark.createDataFrame(stock, STOCK), spark.createDataFrame(moves, MOVES), date(2020, 1, 1))
    balance, _ = fold(moves, {(p, "MAIN"): 10 * p for p in range(1, 9)})
    assert {r.product_id: r.quantity_on_hand for r in got.collect()} == {
        p: q for (p, _), q in balance.items()}


def test_messages(spark):
    stock = spark.createDataFrame([(1, "MAIN", 10, 8, 2, 5, None)], STOCK)
    moves = spark.createDataFrame(
        [(1, "MAIN", 1, 5, "RECEIPT"), (1, "MAIN", 2, 5, "ADJUSTMENT"), (1, "MAIN", 3, 1, "RETURN"),
         (1, "MAIN", 4, 1, "SCRAP"), (1, "WEST", 5, 1, "RECEIPT")], MOVES)
    got = {r.seq: (r.balance, r.message) for r in business.move_messages(stock, moves).collect()}
    assert got[1][0] == 15 and "New quantity: 15" in got[1][1]
    assert got[2][0] == 5 and "WARNING" in got[2][1]  # exactly on the reorder point
    assert got[3][0] == 6 and "New quantity: 6" in got[3][1]
    assert got[4] == (None, "Invalid transaction type: SCRAP")
    assert got[5] == (None, "Unknown stock location: WEST")
    after = business.apply_moves(stock, moves, date(2020, 5, 1)).first()
    assert (after.quantity_on_hand, after.quantity_available) == (6, 4)
    assert after.last_received_date == date(2020, 5, 1)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stock_days_equal_fold(spark, seed):
    rnd = random.Random(seed)
    start, end = date(2000, 1, 10), date(2000, 2, 20)
    moves = [
        (p, place, seq, q, kind, date(2000, 1, 1) + timedelta(days=rnd.randint(0, 70)))
        for p, place, seq, q, kind in random_moves(seed, 150)
    ]
    moves += [(99, "MAIN", 1, 5, "RECEIPT", date(2000, 1, 15))]  # not in stock
    opening = {(p, "MAIN"): p * 10 for p in range(1, 9)}  # 7 and 8 never move
    want = dict.fromkeys(opening, 0)
    for n in range((end - start).days + 1):
        now = start + timedelta(days=n)
        # seq orders the moves of one day only
        so_far = sorted((m for m in moves if m[5] <= now), key=lambda m: (m[5], m[2]))
        balance, _ = fold([(*m[:2], i, *m[3:5]) for i, m in enumerate(so_far)], opening)
        for key in opening:
            want[key] += balance[key]
    frame = spark.createDataFrame(moves, MOVES + ", move_date date")
    stock = spark.createDataFrame(
        [(*k, v) for k, v in opening.items()], "product_id int, location_code string, opening bigint"
    )
    got = ledger.stock_days(frame, KEY, stock, start, end)
    assert {(r.product_id, r.location_code): r.stock_days for r in got.collect()} == want
    with pytest.raises(ValueError):
        ledger.stock_days(frame, KEY, stock, end, start)


def test_turnover_of_a_still_product(spark, mart):
    still = extras.inventory_turnover(mart, date(1994, 1, 1), date(1994, 1, 31))
    row = still.filter("product_number = 'P000005'").collect()[0]
    assert (row.units_shipped, row.average_stock) == (0, 105.0)
    assert row.turnover_ratio == 0.0 and row.days_of_supply is None
