"""Random small inputs against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import date, timedelta
from random import Random

import pytest

from finmart import schemas
from finmart.operators import fact, quality, scd2
from finmart.plans import registry, roles
from finmart.schemas import TRACKED
from plans import settings
from rows import SNAPSHOT, account, branch, customer, frame, txn

DAYS = [date(2026, 4, 1) + timedelta(days=n) for n in range(40)]


def random_feed(rng: Random, n: int) -> list[dict]:
    return [
        txn(
            txn_id=rng.choice([None, "HOT", "HOT", "HOT", *[f"T{i}" for i in range(n // 3)]]),
            txn_date=rng.choice([None, "2026-04-05", "2026-04-06", "someday"]),
            account_id=rng.choice([None, "A1", "A2", "A3"]),
            customer_id=rng.choice([None, "C1", "C2", "C3"]),
            branch_code=rng.choice([None, "B1", "B2", "B3", "B4"]),
            channel=rng.choice([None, "atm"]),
            is_cash=rng.choice([None, True, False]),
            amount=rng.choice([None, -1.0, 0.0, 1.0, 2.5, 2.5, float("inf")]),
            fee=rng.choice([None, 0.0, 1.0]),
        )
        for _ in range(n)
    ]


def first_null(value):
    return (value is not None, value if value is not None else 0)


def gate(rows: list[dict]) -> Counter:
    """Rows with their reason."""
    verdicts, contenders = [], defaultdict(list)
    for row in rows:
        if any(row[name] is None for name in quality.REQUIRED):
            verdicts.append((row, quality.NULL_FIELD))
        elif row["amount"] < 0:
            verdicts.append((row, quality.NEGATIVE))
        elif row["amount"] == float("inf"):
            verdicts.append((row, quality.BAD_AMOUNT))
        elif row["txn_date"] == "someday":
            verdicts.append((row, quality.BAD_DATE))
        else:
            contenders[row["txn_id"]].append(row)
    for copies in contenders.values():
        copies.sort(key=lambda row: [first_null(row[name]) for name in quality.TIE_BREAK])
        verdicts += [(copies[0], None), *[(row, quality.DUPLICATE) for row in copies[1:]]]
    return Counter((*[row[c] for c in schemas.RAW_TRANSACTIONS], why) for row, why in verdicts)


@pytest.mark.parametrize("seed", range(3))
def test_gate(spark, seed):
    rows = random_feed(Random(seed), 600)
    tagged = quality.tag_transactions(
        frame(spark, schemas.RAW_TRANSACTIONS, *rows).repartition(5)
    )
    expected = gate(rows)
    assert Counter(tuple(row) for row in tagged.collect()) == expected
    why = Counter()
    for row, n in expected.items():
        why[row[-1]] += n
    found = dict(quality.reject_counts(frame(spark, schemas.RAW_TRANSACTIONS, *rows)).collect())
    assert found == {reason: n for reason, n in why.items() if reason}


def random_history(rng: Random) -> list[list[dict]]:
    return [
        [
            customer(
                customer_id=f"C{i}",
                segment=rng.choice([None, "", "private", "sme"]),
                province=rng.choice(["Rayong", "Phuket"]),
                snapshot_date=day,
            )
            for i in range(30)
            if rng.random() < 0.8
        ]
        for day in (DAYS[0], DAYS[15], DAYS[25])
    ]


def merge(dim: list[dict], snapshot: list[dict]) -> list[dict]:
    def tracked(row):
        return [row[name] or "" for name in TRACKED]

    open_rows = {row["customer_id"]: row for row in dim if row["is_current"]}
    arriving = []
    for row in snapshot:
        old = open_rows.get(row["customer_id"])
        if old is None or tracked(old) != tracked(row):
            arriving.append(row)
            if old is not None:
                old |= {"effective_to": row["snapshot_date"], "is_current": False}
    top = len(dim)
    for key, row in enumerate(sorted(arriving, key=lambda row: row["customer_id"]), start=top + 1):
        dim.append(
            {
                "customer_key": key,
                **{name: row[name] for name in ("customer_id", *TRACKED)},
                "effective_from": row["snapshot_date"],
                "effective_to": None,
                "is_current": True,
            }
        )
    return dim


@pytest.mark.parametrize("seed", range(2))
def test_history_and_fact(spark, seed):
    rng = Random(seed)
    snapshots = random_history(rng)
    dim: list[dict] = []
    for snapshot in snapshots:
        dim = merge(dim, snapshot)
    expected = Counter(tuple(row[name] for name in schemas.DIM_CUSTOMER) for row in dim)
    replayed = scd2.scd2_replay([frame(spark, SNAPSHOT, *rows) for rows in snapshots])
    assert Counter(tuple(row) for row in replayed.collect()) == expected

    feed = [
        txn(
            txn_id=f"T{i}",
            txn_date=str(rng.choice(DAYS)),
            customer_id=f"C{rng.randrange(35)}",
            account_id=rng.choice(["A1", "A9"]),
            branch_code=rng.choice(["B1", "B9"]),
        )
        for i in range(300)
    ]
    keys = {}
    for row in feed:
        day = date.fromisoformat(row["txn_date"])
        versions = [
            version["customer_key"]
            for version in dim
            if version["customer_id"] == row["customer_id"]
            and version["effective_from"] <= day
            and (version["effective_to"] is None or day < version["effective_to"])
        ]
        assert len(versions) <= 1
        keys[row["txn_id"]] = (
            int(day.strftime("%Y%m%d")),
            versions[0] if versions else None,
            7 if row["account_id"] == "A1" else None,
            9 if row["branch_code"] == "B1" else None,
        )
    built = fact.build_fact_transactions(
        quality.as_money(frame(spark, schemas.RAW_TRANSACTIONS, *feed)),
        replayed,
        frame(spark, schemas.DIM_ACCOUNT, account(account_key=7)),
        frame(spark, schemas.DIM_BRANCH, branch(branch_key=9)),
    ).collect()
    assert len(built) == len(feed)
    assert {
        row.txn_id: (row.date_key, row.customer_key, row.account_key, row.branch_key)
        for row in built
    } == keys


@pytest.mark.parametrize(
    "setting",
    [
        {"spark__sql__adaptive__enabled": "false"},
        {"spark__sql__ansi__enabled": "false"},
        {"spark__sql__session__timeZone": "Asia/Bangkok"},
        {"spark__sql__autoBroadcastJoinThreshold": "-1"},
    ],
    ids=lambda setting: next(iter(setting)).replace("__", "."),
)
def test_results_do_not_depend_on_settings(spark, sf_dir, setting):
    def bags():
        roles.forget(spark, sf_dir)
        return [
            sorted(map(repr, registry.QUERIES[name](spark, sf_dir).collect()))
            for name in ("clean_rejected", "fact_transactions", "ctr_report", "monthly_summary")
        ]

    before = bags()
    with settings(spark, **setting):
        assert bags() == before
    roles.forget(spark, sf_dir)
