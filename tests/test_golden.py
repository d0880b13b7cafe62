"""A lending library's changelog with hand-computed results.

Two branches (sources ``north`` and ``south``) keep the tables ``member`` and ``loan``.
North's log, position by position:

 1  member 1 Ada, member 2 Bo, member 3 Cy join
 2  loan 11 (member 1, fee 0.50), loan 12 (member 3, fee 1.25)
 3  Bo moves to tier gold
 4  Cy's card is renumbered: member 3 goes, member 30 comes, at one position
 5  loan 12 is moved to member 30, fee 2.00
 6  loan 11 is returned (deleted)
 7  loan 13 (member 2, fee 0.75) and, in the same position, member 4 Di joins
 8  Di leaves again
 9  loan 14 (member 4, fee 3.00): its member is gone, an orphan

South has a member 1 of its own (Eve), who moves to tier gold at position 2.
"""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.lsn import lsn_from_number
from tidemark.operators import analytics, merge
from tidemark.operators.routing import union_sources

MEMBER = "n long, seqval long, op int, id int, name string, tier string"
LOAN = "n long, seqval long, op int, loan int, member int, fee decimal(6,2)"
GONE, NEW, BEFORE, AFTER = 1, 2, 3, 4

NORTH_MEMBER = [
    (1, 0, NEW, 1, "Ada", "basic"),
    (1, 1, NEW, 2, "Bo", "basic"),
    (1, 2, NEW, 3, "Cy", "basic"),
    (3, 0, BEFORE, 2, "Bo", "basic"),
    (3, 0, AFTER, 2, "Bo", "gold"),
    (4, 0, GONE, 3, "Cy", "basic"),
    (4, 0, NEW, 30, "Cy", "basic"),
    (7, 1, NEW, 4, "Di", "basic"),
    (8, 0, GONE, 4, "Di", "basic"),
]
NORTH_LOAN = [
    (2, 0, NEW, 11, 1, Decimal("0.50")),
    (2, 1, NEW, 12, 3, Decimal("1.25")),
    (5, 0, BEFORE, 12, 3, Decimal("1.25")),
    (5, 0, AFTER, 12, 30, Decimal("2.00")),
    (6, 0, GONE, 11, 1, Decimal("0.50")),
    (7, 0, NEW, 13, 2, Decimal("0.75")),
    (9, 0, NEW, 14, 4, Decimal("3.00")),
]
SOUTH_MEMBER = [
    (1, 0, NEW, 1, "Eve", "basic"),
    (2, 0, BEFORE, 1, "Eve", "basic"),
    (2, 0, AFTER, 1, "Eve", "gold"),
]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).withColumn("lsn", lsn_from_number("n")).drop("n")


@pytest.fixture(scope="module")
def logs(spark):
    return frame(spark, NORTH_MEMBER, MEMBER), frame(spark, NORTH_LOAN, LOAN), frame(spark, SOUTH_MEMBER, MEMBER)


def upto(n):
    return F.col("lsn") <= lsn_from_number(F.lit(n))


def members(df):
    return {(r.id, r.name, r.tier) for r in df.collect()}


@pytest.mark.parametrize(
    ("position", "expected"),
    [
        (1, {(1, "Ada", "basic"), (2, "Bo", "basic"), (3, "Cy", "basic")}),
        (3, {(1, "Ada", "basic"), (2, "Bo", "gold"), (3, "Cy", "basic")}),
        (4, {(1, "Ada", "basic"), (2, "Bo", "gold"), (30, "Cy", "basic")}),
        (7, {(1, "Ada", "basic"), (2, "Bo", "gold"), (30, "Cy", "basic"), (4, "Di", "basic")}),
        (9, {(1, "Ada", "basic"), (2, "Bo", "gold"), (30, "Cy", "basic")}),
    ],
)
def test_member_table_at_each_position(logs, position, expected):
    assert members(merge.snapshot_as_of(logs[0], ["id"], lsn_from_number(F.lit(position)))) == expected


def test_loans_and_their_orphan(logs):
    member, loan, _ = logs
    m, ln = merge.latest_per_key(member, ["id"]), merge.latest_per_key(loan, ["loan"])
    assert {(r.loan, r.member, str(r.fee)) for r in ln.collect()} == {(12, 30, "2.00"), (13, 2, "0.75"), (14, 4, "3.00")}
    assert [r.loan for r in merge.check_foreign_keys(ln, m, ["member"], ["id"]).collect()] == [14]
    # before the card was renumbered in the loans, loan 12 was an orphan for one position
    at4 = merge.snapshot_as_of(loan, ["loan"], lsn_from_number(F.lit(4)))
    m4 = merge.snapshot_as_of(member, ["id"], lsn_from_number(F.lit(4)))
    assert [r.loan for r in merge.check_foreign_keys(at4, m4, ["member"], ["id"]).collect()] == [12]


def test_rows_affected_and_replay(logs):
    member = logs[0]
    ra = merge.rows_affected(member, None, ["id"])
    assert ra.agg(F.sum("rows_affected")).first()[0] == 8  # every applied change meets what it expects
    twice = member.unionByName(member.where(upto(4)))
    assert members(merge.latest_per_key(twice, ["id"])) == members(merge.latest_per_key(member, ["id"]))
    assert merge.dedupe_replays(twice, pk=["id"]).count() == member.count()


def test_late_part_of_the_log_changes_nothing(logs):
    """Positions 5-9 applied first, 1-4 delivered afterwards."""
    member = logs[0]
    late, early = member.where(~upto(4)), member.where(upto(4))
    both = late.unionByName(early)
    assert members(merge.latest_per_key(both, ["id"])) == {(1, "Ada", "basic"), (2, "Bo", "gold"), (30, "Cy", "basic")}


def test_sources_stay_apart(logs):
    both = union_sources({"north": logs[0], "south": logs[2]})
    got = {(r.source, r.id, r.name, r.tier) for r in merge.latest_per_key(both, ["source", "id"]).collect()}
    assert {g for g in got if g[1] == 1} == {("north", 1, "Ada", "basic"), ("south", 1, "Eve", "gold")}


def test_changed_columns_and_net_changes(logs):
    member, loan, _ = logs
    pairs = analytics.changed_columns(analytics.pair_updates(loan, ["loan"]), ["loan", "member", "fee"])
    assert [(r.loan, list(r.changed)) for r in pairs.collect()] == [(12, ["member", "fee"])]
    net = {r.id: r.net_op for r in analytics.net_changes(member, ["id"]).collect()}
    assert net == {1: "insert", 2: "insert", 3: "none", 30: "insert", 4: "none"}
    with pytest.raises(ValueError):
        analytics.pair_updates(loan)
