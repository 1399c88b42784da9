from __future__ import annotations

from collections import defaultdict
from datetime import date
from functools import reduce
from zlib import crc32

import pytest
from pyspark.errors import PySparkException

from compare import spark_bag
from finmart import schemas
from finmart.operators import scd2
from finmart.sources.scratch import materialize
from plans import exchanges, plan_of, settings
from rows import SNAPSHOT, customer, frame, version

APRIL, MAY, JUNE = date(2026, 4, 1), date(2026, 5, 17), date(2026, 6, 15)


def snapshot(spark, *rows):
    return frame(spark, SNAPSHOT, *rows)


def nothing(spark):
    return schemas.empty(spark, schemas.DIM_CUSTOMER)


def merged(spark, *snapshots):
    return reduce(scd2.scd2_merge, snapshots, nothing(spark))


def by_id(df) -> dict:
    return {(row.customer_id, row.effective_from): row for row in df.collect()}


def test_first_load_opens_all(spark):
    df = merged(spark, snapshot(spark, customer(customer_id="C2"), customer()))
    rows = df.collect()
    assert {(row.customer_id, row.customer_key) for row in rows} == {("C1", 1), ("C2", 2)}
    assert all(row.is_current and row.effective_to is None for row in rows)
    assert {row.effective_from for row in rows} == {APRIL}
    assert dict(df.dtypes) == schemas.DIM_CUSTOMER


def test_unchanged_customer_stays(spark):
    before = merged(spark, snapshot(spark, customer()))
    after = scd2.scd2_merge(before, snapshot(spark, customer(snapshot_date=MAY)))
    assert spark_bag(after) == spark_bag(before)


def test_change_closes_and_opens(spark):
    df = merged(
        spark,
        snapshot(spark, customer()),
        snapshot(spark, customer(province="Phuket", snapshot_date=MAY)),
    )
    rows = by_id(df)
    old, new = rows["C1", APRIL], rows["C1", MAY]
    assert (old.customer_key, old.province, old.effective_to, old.is_current) == (
        1,
        "Rayong",
        MAY,
        False,
    )
    assert (new.customer_key, new.province, new.effective_to, new.is_current) == (
        2,
        "Phuket",
        None,
        True,
    )


def test_new_customer_opens(spark):
    df = merged(
        spark,
        snapshot(spark, customer()),
        snapshot(spark, customer(snapshot_date=MAY), customer(customer_id="C9", snapshot_date=MAY)),
    )
    rows = by_id(df)
    assert len(rows) == 2 and rows["C9", MAY].customer_key == 2 and rows["C9", MAY].is_current


def test_absent_customer_stays_open(spark):
    df = merged(
        spark,
        snapshot(spark, customer(), customer(customer_id="C2")),
        snapshot(spark, customer(snapshot_date=MAY)),
    )
    assert by_id(df)["C2", APRIL].is_current


def test_null_and_empty_text_are_the_same(spark):
    first = snapshot(spark, customer(kyc_level=None))
    second = snapshot(spark, customer(kyc_level="", snapshot_date=MAY))
    assert merged(spark, first, second).count() == 1


def test_closed_versions_are_carried_over(spark):
    df = merged(
        spark,
        snapshot(spark, customer()),
        snapshot(spark, customer(segment="sme", snapshot_date=MAY)),
        snapshot(spark, customer(segment="private", snapshot_date=JUNE)),
    )
    spans = {(r.effective_from, r.effective_to, r.customer_key) for r in by_id(df).values()}
    assert spans == {(APRIL, MAY, 1), (MAY, JUNE, 2), (JUNE, None, 3)}


def test_changed_and_new_share_one_numbering(spark):
    df = merged(
        spark,
        snapshot(spark, customer(customer_id="C2"), customer(customer_id="C4")),
        snapshot(
            spark,
            customer(customer_id="C4", name="x", snapshot_date=MAY),
            customer(customer_id="C1", snapshot_date=MAY),
            customer(customer_id="C2", name="x", snapshot_date=MAY),
        ),
    )
    keys = {row.customer_id: row.customer_key for row in df.where("is_current").collect()}
    assert keys == {"C1": 3, "C2": 4, "C4": 5}


@pytest.mark.parametrize(
    ("rows", "fault"),
    [
        ([customer(), customer(name="other")], "repeated"),
        ([customer(snapshot_date=None)], "undated"),
        ([customer(customer_id=None)], "nameless"),
    ],
)
def test_bad_snapshots_fail(spark, rows, fault):
    with pytest.raises(ValueError, match=fault):
        merged(spark, snapshot(spark, *rows))
    with pytest.raises(ValueError, match=fault):
        scd2.scd2_replay([snapshot(spark, *rows)])


def test_a_customer_with_two_dates_in_one_snapshot_fails(spark):
    twice = snapshot(spark, customer(), customer(snapshot_date=MAY))
    with pytest.raises(ValueError, match="repeated"):
        merged(spark, twice)


def test_an_old_snapshot_fails_if_it_changes_something(spark):
    dim = frame(spark, schemas.DIM_CUSTOMER, version(effective_from=MAY))
    assert scd2.scd2_merge(dim, snapshot(spark, customer())).count() == 1
    with pytest.raises(PySparkException, match="not newer than the open version of customer C1"):
        scd2.scd2_merge(dim, snapshot(spark, customer(province="Phuket")))


def test_change_classes(spark):
    dim = merged(spark, snapshot(spark, *[customer(customer_id=f"C{i}") for i in range(4)]))
    later = snapshot(
        spark,
        customer(customer_id="C1", snapshot_date=MAY),
        customer(customer_id="C2", snapshot_date=MAY),
        customer(customer_id="C3", name="x", snapshot_date=MAY),
        customer(customer_id="C8", snapshot_date=MAY),
    )
    found = {row["class"]: row.n for row in scd2.scd2_change_classes(dim, later).collect()}
    assert found == {"absent": 1, "unchanged": 2, "changed": 1, "new": 1}


def random_snapshots(spark, seed: int):
    """Ten customers over five dates: coming, going, changing and changing back."""
    days = [date(2026, month, 1) for month in range(1, 6)]

    def pick(customer_id: int, day: date, salt: str, n: int) -> int:
        return crc32(f"{seed} {customer_id} {day} {salt}".encode()) % n

    return [
        snapshot(
            spark,
            *[
                customer(
                    customer_id=f"C{i}",
                    province=["Rayong", "Phuket"][pick(i, day, "p", 2)],
                    segment=[None, "", "sme"][pick(i, day, "s", 3)],
                    snapshot_date=day,
                )
                for i in range(10)
                if pick(i, day, "seen", 4)
            ],
        )
        for day in days
    ]


@pytest.mark.parametrize("seed", range(2))
def test_replay_equals_merging_one_by_one(spark, seed):
    snapshots = random_snapshots(spark, seed)
    history = scd2.scd2_replay(snapshots)
    assert spark_bag(history) == spark_bag(merged(spark, *snapshots))
    assert spark_bag(scd2.scd2_replay(snapshots[::-1])) == spark_bag(history)


def test_history_has_no_gaps_and_no_overlaps(spark):
    spans = defaultdict(list)
    rows = scd2.scd2_replay(random_snapshots(spark, 7)).collect()
    for row in rows:
        spans[row.customer_id].append((row.effective_from, row.effective_to, row.is_current))
    assert sorted(row.customer_key for row in rows) == list(range(1, len(rows) + 1))
    for versions in spans.values():
        versions.sort(key=lambda span: span[0])
        assert [end for _, end, _ in versions[:-1]] == [start for start, _, _ in versions[1:]]
        assert [current for *_, current in versions] == [False] * (len(versions) - 1) + [True]
        assert versions[-1][1] is None


@pytest.mark.parametrize("partitions", [1, 17])
def test_layout_does_not_matter(spark, partitions):
    snapshots = random_snapshots(spark, 1)[:2]
    moved = [df.repartition(partitions) for df in snapshots]
    assert spark_bag(scd2.scd2_replay(moved)) == spark_bag(scd2.scd2_replay(snapshots))
    assert spark_bag(merged(spark, *moved)) == spark_bag(merged(spark, *snapshots))


def test_overlapping_versions_fail(spark):
    two_open = [version(), version(customer_key=2, effective_from=date(2026, 2, 1))]
    late = [
        version(effective_to=date(2026, 3, 1), is_current=False),
        version(customer_key=2, effective_from=date(2026, 2, 1)),
    ]
    fine = [
        version(effective_to=date(2026, 2, 1), is_current=False),
        version(customer_key=2, effective_from=date(2026, 2, 1)),
    ]
    incoming = snapshot(spark, customer(customer_id="C9", snapshot_date=MAY))
    for rows in (two_open, late):
        with pytest.raises(PySparkException, match="overlaps the next one of customer C1"):
            scd2.scd2_merge(frame(spark, schemas.DIM_CUSTOMER, *rows), incoming)
    assert scd2.scd2_merge(frame(spark, schemas.DIM_CUSTOMER, *fine), incoming).count() == 3


def test_a_customer_with_closed_versions_only_opens_again(spark):
    closed = version(effective_to=date(2026, 3, 1), is_current=False)
    after = scd2.scd2_merge(frame(spark, schemas.DIM_CUSTOMER, closed), snapshot(spark, customer()))
    assert {(r.customer_key, r.effective_from, r.is_current) for r in after.collect()} == {
        (closed["customer_key"], closed["effective_from"], False),
        (closed["customer_key"] + 1, APRIL, True),
    }


def test_merging_joins_once_and_deals_the_history_once(spark):
    """The check for overlaps and the join share one shuffle of the history."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
    ):
        dim = materialize(merged(spark, *random_snapshots(spark, 3)[:2]), "dim")
        late = materialize(random_snapshots(spark, 3)[2], "late")
        plan = plan_of(scd2._actions(dim, late))
    assert plan.count("FullOuter") == 1 and plan.count("Join") == 1
    assert exchanges(plan) == ["hashpartitioning"] * 2


def test_keys_beyond_an_int_fail(spark):
    dim = frame(spark, schemas.DIM_CUSTOMER, version(customer_key=2**31 - 1))
    with pytest.raises(PySparkException, match="do not fit an int"):
        scd2.scd2_merge(dim, snapshot(spark, customer(customer_id="C9", snapshot_date=MAY))).collect()
