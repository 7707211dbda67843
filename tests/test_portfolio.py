"""Allocation, history and dependencies against plain Python; one key holds most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import allocation, dependencies, history, lending
from tidemark.plans import QUERIES

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def allocate(schedule, payments):
    """Money handed out one payment after another."""
    out = {}
    for loan in {s[0] for s in schedule}:
        open_ = [[k, due] for l, k, due in sorted(schedule) if l == loan and due > 0]
        for l, number, at, paid in sorted(payments, key=lambda p: (p[2], p[1])):
            if l != loan or paid <= 0:
                continue
            while paid and open_:
                part = min(paid, open_[0][1])
                out[loan, open_[0][0], number] = out.get((loan, open_[0][0], number), 0) + part
                paid -= part
                open_[0][1] -= part
                if not open_[0][1]:
                    open_.pop(0)
    return sorted((*k, v) for k, v in out.items())


def irregular():
    draws = random.Random(4)
    schedule = [(loan, k, draws.choice([0, 1, 50, 999, 10_000])) for loan in range(6) for k in range(1, 13)]
    payments = [(loan, n, day(draws.randint(0, 90)), draws.choice([0, -5, 1, 7, 300, 25_000])) for loan in range(7) for n in range(20)]
    # a third of all payments settle one loan cent by cent
    payments += [(0, 1000 + n, day(100 + n % 50), draws.randint(1, 3)) for n in range(1500)]
    return schedule, payments


def frames(spark, schedule, payments):
    return (
        spark.createDataFrame(schedule, "loan int, k int, due_cents bigint").repartition(3),
        spark.createDataFrame(payments, "loan int, payment int, value_date date, paid_cents bigint").repartition(5),
    )


def test_allocation_hands_out_every_cent_in_order(spark, rows, plan):
    schedule, payments = irregular()
    due, paid = frames(spark, schedule, payments)
    got = allocation.allocate(due, paid)
    assert rows(got, "loan", "k", "payment", "allocated_cents") == sorted(allocate(schedule, payments), key=repr)
    text = plan(got)
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "SinglePartition" not in text
    total = {}
    for loan, _, _, cents in payments:
        total[loan] = total.get(loan, 0) + max(cents, 0)
    for loan, _, cents in schedule:
        total[loan] = total.get(loan, 0) - cents
    assert rows(allocation.overpaid(due, paid)) == sorted(((k, v) for k, v in total.items() if v > 0), key=repr)


def test_settlement_and_arrears(spark):
    due = spark.createDataFrame(
        [(1, 1, 100, day(0)), (1, 2, 100, day(30)), (1, 3, 103, day(60)), (2, 1, 10, day(0))],
        "loan int, k int, due_cents bigint, due_date date",
    )
    paid = spark.createDataFrame(
        [(1, 1, day(5), 130), (1, 2, day(31), 20), (1, 3, day(99), 500)],
        "loan int, payment int, value_date date, paid_cents bigint",
    )
    settled = allocation.settlement(due, allocation.allocate(due, paid), str(day(40)))
    got = {(r.loan, r.k): (r.paid_cents, r.settled_on, r.days_past_due, r.status) for r in settled.collect()}
    assert got == {
        (1, 1): (100, day(5), 0, "PAID"), (1, 2): (50, None, 10, "OVERDUE"),
        (1, 3): (0, None, 0, "PENDING"), (2, 1): (0, None, 40, "OVERDUE"),
    }
    rest = {r.loan: (r.outstanding_cents, r.past_due_cents, r.days_past_due, r.paid_installments) for r in allocation.arrears(settled).collect()}
    assert rest == {1: (153, 50, 10, 1), 2: (10, 10, 40, 0)}


def test_equal_installments_settle_as_a_schedule_does(spark, rows):
    draws = random.Random(9)
    # remainders of either sign, shares of nothing, single installments, no amount, no payment
    loans = [(loan, draws.choice([0.0, -0.02, 0.05, 0.2, 1.0, 99.99, 5000.0]), draws.choice([0.0, 7.5, 90.0]), draws.choice([1, 2, 7, 36])) for loan in range(60)]
    loans += [(60, None, 8.0, 12), (61, 500.0, 8.0, 12)]
    terms = lending.installment_terms(
        spark.createDataFrame(loans, "loan int, amount double, rate double, tenure int").repartition(3),
        F.col("amount"), F.col("rate"), F.col("tenure"), F.lit(DAY).cast("date"),
    )
    payments = [(draws.randint(0, 59), n, day(draws.randint(0, 900)), draws.choice([0, -5, 1, 7, 300, 25_000])) for n in range(600)]
    payments += [(3, 1000 + n, day(100 + n % 50), draws.randint(1, 3)) for n in range(1500)]
    paid = spark.createDataFrame(payments, "loan int, payment int, value_date date, paid_cents bigint").repartition(5)
    due = lending.schedule(terms, settle_remainder=True).select(
        "loan", "k", "due_date", (F.col("principal_due") + F.col("interest_due")).alias("due_cents")
    )
    columns = ["loan", "k", "payment", "value_date", "allocated_cents"]
    plain = allocation.allocate(due, paid)
    assert rows(allocation.allocate_terms(terms, paid), *columns) == rows(plain, *columns)
    columns = ["loan", "k", "due_date", "due_cents", "paid_cents", "settled_on", "days_past_due", "status"]
    for as_of in (str(day(-1)), str(day(120)), str(day(450)), str(day(2000))):
        settled = allocation.settle_terms(terms, paid, as_of)
        assert rows(settled, *columns) == rows(allocation.settlement(due, plain, as_of), *columns)


@pytest.mark.parametrize("name", ["payment_allocation", "installment_settlement", "loan_arrears"])
def test_no_installment_is_shuffled(spark, sf_dir, plan, name):
    text = plan(QUERIES[name](spark, sf_dir))
    # a plan is printed from its result down
    assert 0 < text.index("Generate explode") < text.index("Exchange")


def test_validity_merges_and_closes(spark, rows):
    data = [("a", 1, "x"), ("a", 2, "x"), ("a", 2, "x"), ("a", 4, "x"), ("a", 5, None), ("b", 1, None), ("b", 2, "")]
    df = spark.createDataFrame([(k, day(n), v) for k, n, v in data] + [("hot", day(1), "h")] * 500 + [("hot", day(9), "h")] * 500, "k string, d date, v string")
    assert rows(history.validity(df, ["k"], "d", ["v"]), "k", "v", "valid_from", "valid_to") == sorted(
        [("a", "x", day(1), day(5)), ("a", None, day(5), None), ("b", None, day(1), day(2)), ("b", "", day(2), None), ("hot", "h", day(1), None)], key=repr
    )
    # days 1, 2, 4, 5 and 9 are whole tables: a is back on day 4, the hot key on day 9
    assert rows(history.validity(df, ["k"], "d", ["v"], snapshots=True), "k", "v", "valid_from", "valid_to") == sorted(
        [("a", "x", day(1), day(5)), ("a", None, day(5), day(9)), ("b", None, day(1), day(2)), ("b", "", day(2), day(4)),
         ("hot", "h", day(1), day(2)), ("hot", "h", day(9), None)], key=repr
    )


def test_difference(spark, rows):
    schema = "k int, v string, w int"
    old = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3), (4, None, 4)], schema)
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 0), (4, "x", 5), (5, None, None)], schema)
    assert rows(history.difference(old, new, ["k"], ["v", "w"])) == sorted(
        [(2, "UPDATE", ["w"]), (3, "DELETE", []), (4, "UPDATE", ["v", "w"]), (5, "INSERT", [])], key=repr
    )


def test_as_of_join_with_a_hot_key(spark, rows, plan):
    draws = random.Random(1)
    versions = [("hot" if i % 3 else f"k{i}", day(10 * i), day(10 * i + 10) if i < 40 else None, i) for i in range(41)]
    facts = [(i, draws.choice(["hot", "hot", "k0", "k3", "none"]), day(draws.randint(-20, 500))) for i in range(2000)]
    got = history.as_of_join(
        spark.createDataFrame(facts, "id int, k string, d date"),
        spark.createDataFrame(versions, "k string, valid_from date, valid_to date, v int"), ["k"], "d", ["v"],
    )
    want = []
    for i, k, d in facts:
        hits = [v for kk, a, b, v in versions if kk == k and a <= d and (b is None or d < b)]
        want.append((i, k, d, hits[0] if hits else None))
    assert rows(got) == sorted(want, key=repr)
    assert "NestedLoop" not in plan(got) and "CartesianProduct" not in plan(got)


def edges_of(spark, pairs):
    return spark.createDataFrame(pairs, "table_id bigint, upstream bigint")


def test_levels_and_cycles(spark, rows):
    tables = spark.range(1, 13).toDF("table_id")
    pairs = [(2, 1), (3, 2), (3, 1), (4, 5), (5, 4), (6, 4), (7, 7), (8, 6), (8, 7), (9, 8), (9, 3), (10, 99), (11, 10), (5, 12), (6, 7)]
    placed, left = dependencies.levels(tables, edges_of(spark, pairs))
    assert rows(placed) == [(1, 0), (12, 0), (2, 1), (3, 2)] and left.count() > 0
    # 6 lies behind two cycles but before none
    assert rows(dependencies.cycles(tables, edges_of(spark, pairs))) == [(4,), (5,), (7,)]
    between = dependencies.cycles(tables, edges_of(spark, [*pairs, (7, 6)]))
    assert rows(between) == [(4,), (5,), (6,), (7,)]


@pytest.mark.parametrize("small", [True, False])
def test_readiness_through_many_layers(spark, rows, monkeypatch, small):
    if not small:
        monkeypatch.setattr(dependencies, "broadcast_if_small", lambda frame, **_: frame)
    tables = spark.range(1, 400).toDF("table_id")
    # a chain of 30, a hub that hundreds of tables need, a cycle, an unknown and an unreadable id
    pairs = [(i, i - 1) for i in range(2, 31)] + [(i, 50) for i in range(100, 380)] + [(60, 61), (61, 60), (62, 61), (70, 999), (71, 70), (80, None), (81, 80)]
    finished = tables.where("table_id not in (3, 50)")
    got = {r.table_id: (r.level, r.in_cycle, r.hops_to_cause, r.is_ready) for r in dependencies.readiness(tables, edges_of(spark, pairs), finished).collect()}
    assert len(got) == 399
    assert got[1] == (0, False, None, True) and got[3] == (2, False, None, True)
    assert all(got[i] == (i - 1, False, i - 3, False) for i in range(4, 31))
    assert all(got[i] == (1, False, 1, False) for i in range(100, 380)) and got[50][3]
    assert got[60] == got[61] == (None, True, 1, False) and got[62] == (None, False, 1, False)
    assert got[70] == (None, False, 1, False) and got[71] == (None, False, 2, False)
    assert got[80] == (None, False, 1, False) and got[81] == (None, False, 2, False)


def test_readiness_broadcasts_no_ids_that_were_not_measured(spark, rows, plan, monkeypatch):
    # all files here are far below Spark's own limit for a broadcast; beyond the measured one none is sent
    plans, stage = [], dependencies.staged
    monkeypatch.setattr(dependencies, "broadcast_if_small", lambda frame, **_: frame)
    monkeypatch.setattr(dependencies, "staged", lambda frame, name: plans.append(plan(frame)) or stage(frame, name))
    pairs = [(2, 1), (3, 2), (3, 1), (4, 5), (5, 4), (6, 4), (7, 99), (8, 7), (8, 3)]
    found = dependencies.readiness(spark.range(1, 9).toDF("table_id"), edges_of(spark, pairs), spark.range(2, 9).toDF("table_id"))
    assert rows(found) == [
        (1, 0, False, None, True), (2, 1, False, 1, False), (3, 2, False, 1, False), (4, None, True, 1, False),
        (5, None, True, 1, False), (6, None, False, 1, False), (7, None, False, 1, False), (8, None, False, 2, False),
    ]
    assert not [text for text in [*plans, plan(found)] if "Broadcast" in text]


def test_edges_are_read_from_the_configuration(spark, rows):
    config = spark.createDataFrame([(1, None), (2, "1, 1,x"), (3, " , ")], "table_id bigint, depends_on_table_ids string")
    assert rows(dependencies.dependency_edges(config)) == sorted([(2, 1), (2, None)], key=repr)
