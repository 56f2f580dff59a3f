"""Composition of staging, dimensions and facts in dependency order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tallyward.operators.quality import Check, accepted_values, column_report, relationships
from tallyward.plans import dims as D

TYPE1 = ("branch", "department", "transaction_type", "merchant", "atm", "card")
TYPE2 = ("employee", "customer", "account")


def dimensions(stg: Callable[[str], DataFrame], as_of: str, now: str,
               detection: DataFrame | None = None, registry: DataFrame | None = None,
               keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> dict[str, DataFrame]:
    """All dimensions. ``keep`` may store each one and hand back the stored table, so later
    ones read it instead of building it again."""
    out: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> None:
        out[name] = keep(f"dim_{name}", df)

    put("branch", D.dim_branch(stg("branch"), now))
    put("department", D.dim_department(stg("department"), out["branch"], now))
    put("employee", D.dim_employee(stg("employee"), out["department"], out["branch"], as_of, now))
    put("transaction_type", D.dim_transaction_type(stg("transaction_type"), now))
    put("merchant", D.dim_merchant(stg("merchant"), now))
    put("atm", D.dim_atm(stg("atm"), out["branch"], now))
    put("customer", D.dim_customer(stg("customer"), stg("customer_phone"), as_of, now))
    put("account", D.dim_account(stg("account"), out["customer"], out["branch"], as_of, now))
    put("card", D.dim_card(stg("card"), out["account"], now))
    if detection is not None:
        put("fraud_model", D.dim_fraud_model(detection, registry, now))
    return out


_BOTH = ("not_null", "unique")
_FILLED = ("not_null",)

# The column tests of every model.
MODEL_TESTS = {
    "stg_branch": {"branch_id": _BOTH},
    "stg_department": {"department_id": _BOTH},
    "stg_employee": {"employee_id": _BOTH},
    "stg_transaction_type": {"transaction_type_id": _BOTH},
    "stg_merchant": {"merchant_id": _BOTH},
    "stg_atm": {"atm_id": _BOTH},
    "stg_customer": {"customer_id": _BOTH},
    "stg_account": {"account_number": _BOTH},
    "stg_card": {"card_number_hashed": _BOTH},
    "stg_realtime_transaction": {"transaction_id": _FILLED, "amount": _FILLED},
    "stg_realtime_fraud_detection": {"transaction_id": _FILLED, "fraud_score": _FILLED},
    "stg_transaction": {"transaction_id": _BOTH, "amount": _FILLED},
    "stg_loan": {"loan_id": _BOTH},
    "dim_branch": {"branch_key": _BOTH, "branch_id": _FILLED},
    "dim_department": {"department_key": _BOTH},
    "dim_employee": {"employee_key": _BOTH},
    "dim_transaction_type": {"transaction_type_key": _BOTH},
    "dim_merchant": {"merchant_key": _BOTH},
    "dim_atm": {"atm_key": _BOTH},
    "dim_customer": {"customer_key": _BOTH},
    "dim_account": {"account_key": _BOTH},
    "dim_card": {"card_key": _BOTH},
    "dim_fraud_model": {"model_key": _BOTH},
    "fact_transaction": {"transaction_id": _BOTH, "amount": _FILLED},
    "fact_fraud_detection": {"transaction_id": _BOTH, "fraud_score": _FILLED},
    "fact_loan_snapshot": {"snapshot_key": _BOTH, "loan_id": _FILLED},
    "fact_account_balance_snapshot": {"snapshot_key": _BOTH, "account_key": _FILLED},
}

# Accepted values and foreign keys: (model, column, values) and (child, fk, parent, pk).
ACCEPTED = [
    ("fact_fraud_detection", "risk_indication", ("Low", "Medium", "High", "Critical")),
    ("fact_fraud_detection", "action_taken", ("Pass", "Step-Up-Auth", "Flag", "Block")),
    ("stg_loan", "loan_status", ("PAID_OFF", "OVERDUE", "ACTIVE")),
]
FOREIGN_KEYS = [
    ("fact_transaction", "customer_key", "dim_customer", "customer_key"),
    ("fact_transaction", "account_key", "dim_account", "account_key"),
    ("fact_transaction", "merchant_key", "dim_merchant", "merchant_key"),
    ("fact_transaction", "atm_key", "dim_atm", "atm_key"),
    ("fact_fraud_detection", "model_key", "dim_fraud_model", "model_key"),
]


def tested_columns(model: str) -> list[str]:
    """The columns of a model that any declared test reads."""
    columns = [*MODEL_TESTS[model], *[c for name, c, _ in ACCEPTED if name == model]]
    for child, fk, parent, pk in FOREIGN_KEYS:
        columns += [c for name, c in ((child, fk), (parent, pk)) if name == model]
    return list(dict.fromkeys(columns))


def warehouse_checks(models: dict[str, DataFrame]) -> list[Check | DataFrame]:
    """Every declared test whose model is present."""
    checks: list[Check | DataFrame] = []
    for name, columns in MODEL_TESTS.items():
        if name in models:
            checks.append(column_report(name, models[name], columns))
    for name, column, values in ACCEPTED:
        if name in models:
            checks.append(Check(name, column, "accepted_values",
                                accepted_values(models[name], column, values)))
    for child, fk, parent, pk in FOREIGN_KEYS:
        if child in models and parent in models:
            real = models[child].filter(f"{fk} <> '-1'")
            checks.append(Check(child, fk, "relationships",
                                relationships(real, fk, models[parent], pk)))
    return checks
