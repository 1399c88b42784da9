"""Literal rows for small cases."""

from __future__ import annotations

from datetime import date

from finmart import schemas


# A sound transaction by the types of the contract; what tests look at they set themselves.
_BY_TYPE = {"string": "{}", "boolean": False, "double": 815.25}


def txn(**overrides) -> dict:
    filled = {
        name: value.format(name) if isinstance(value := _BY_TYPE[kind], str) else value
        for name, kind in schemas.RAW_TRANSACTIONS.items()
    }
    known = {"txn_id": "T1", "txn_date": "2026-04-05", "account_id": "A1", "customer_id": "C1", "branch_code": "B1", "channel": "branch"}
    return {**filled, **known, **overrides}


def customer(**overrides) -> dict:
    return {
        "customer_id": "C1",
        "name": "Mali Suk",
        "segment": "private",
        "province": "Rayong",
        "kyc_level": "simple",
        "snapshot_date": date(2026, 4, 1),
        **overrides,
    }


def version(**overrides) -> dict:
    return {
        "customer_key": 1,
        "customer_id": "C1",
        "name": "Mali Suk",
        "segment": "private",
        "province": "Rayong",
        "kyc_level": "simple",
        "effective_from": date(2026, 1, 1),
        "effective_to": None,
        "is_current": True,
        **overrides,
    }


def account(**overrides) -> dict:
    return {
        "account_key": 1,
        "account_id": "A1",
        "customer_id": "C1",
        "product_type": "term",
        "currency": "EUR",
        "opened_date": date(2019, 7, 3),
        "status": "active",
        **overrides,
    }


def branch(**overrides) -> dict:
    return {
        "branch_key": 1,
        "branch_code": "B1",
        "branch_name": "Harbour",
        "province": "Rayong",
        "region": "Coast",
        **overrides,
    }


def booked(**overrides) -> dict:
    return {
        "txn_id": "T1",
        "date_key": 20260405,
        "customer_key": 1,
        "account_key": 1,
        "branch_key": 1,
        "channel": "branch",
        "txn_type": "deposit",
        "is_cash": True,
        "amount": 100.0,
        "fee": 0.0,
        **overrides,
    }


SNAPSHOT = {**schemas.RAW_CUSTOMERS, "snapshot_date": "date"}


def frame(spark, contract: dict[str, str], *rows: dict):
    """Rows under a contract; money may be given as float."""
    loose = {name: "double" if kind == schemas.MONEY else kind for name, kind in contract.items()}
    df = spark.createDataFrame(
        [tuple(row[name] for name in contract) for row in rows], schemas.ddl(loose)
    )
    return df.selectExpr(*[f"cast({name} as {kind}) as {name}" for name, kind in contract.items()])
