"""Staging models: filter one batch, keep the latest row per key, drop blank keys, type."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions import keys as K
from tallyward.functions.parsing import (
    any_day, blank_to_null, day, flag, is_blank, number, parse_datetime, real, text,
    upper_text, whole,
)
from tallyward.operators.dedup import latest_per_key

# Merchant codes that count as high risk, and categories that count as cash.
HIGH_RISK_MCC = ("7995", "5912", "5999", "6211", "7801", "7802", "7993")
CASH_CATEGORIES = ("CASH", "WITHDRAWAL", "DEPOSIT")


def not_blank(df: DataFrame, key: str) -> DataFrame:
    return df.filter(~is_blank(key))


def of_batch(df: DataFrame, batch_id: str) -> DataFrame:
    """Rows of one load; prunes folders where RAW is partitioned by ``_BATCH_ID``."""
    return df.filter(F.col("_BATCH_ID") == batch_id)


def stage(raw: DataFrame, batch_id: str | None, key: str, columns: dict[str, Column]) -> DataFrame:
    """Common shape of every batch model.

    Blank keys go before the window, not after it: the result is the same and a large group
    of blank keys is never shuffled.
    """
    rows = raw if batch_id is None else of_batch(raw, batch_id)
    rows = latest_per_key(not_blank(rows, key), key, [F.col("_LOAD_TS").desc_nulls_last()])
    return rows.select(*[e.alias(name) for name, e in columns.items()])


def _full_name(first: str, last: str) -> Column:
    return F.concat(text(first), F.lit(" "), text(last))


def _same(names: dict[str, str], how: Callable[[str], Column] = text) -> dict[str, Column]:
    return {out: how(source) for out, source in names.items()}


def customer_columns() -> dict[str, Column]:
    return {
        **_same({"customer_id": "CustomerID", "first_name": "FirstName", "last_name": "LastName"}),
        "full_name": _full_name("FirstName", "LastName"),
        "email": blank_to_null("Email"),
        "date_of_birth": day("DateOfBirth"),
        **_same({"gender": "Gender", "marital_status": "MaritalStatus", "occupation": "Occupation",
                 "street_address": "StreetAddress", "city": "City", "state": "State"}),
        "country": upper_text("Country"),
        "postal_code": text("PostalCode"),
        "customer_since": day("CustomerSince"),
        **_same({"customer_segment": "CustomerSegment", "id_type": "IDType",
                 "id_number": "IDNumber", "tax_id": "TaxID"}),
        "scd2_hash": K.change_hash("Occupation", "StreetAddress", "City", "State", "Country",
                                   "CustomerSegment"),
    }


def account_columns() -> dict[str, Column]:
    return {
        **_same({"account_number": "AccountNumber", "customer_id": "CustomerID",
                 "account_type": "AccountType", "branch_id": "BranchID"}),
        **_same({"balance": "Balance", "available_balance": "AvailableBalance"}, number),
        "currency": upper_text("Currency"),
        **_same({"open_date": "OpenDate", "last_activity_date": "LastActivityDate"}, day),
        "interest_rate": number("InterestRate", 10, 4),
        **_same({"minimum_balance": "MinimumBalance", "overdraft_limit": "OverdraftLimit"}, number),
        "account_status": text("AccountStatus"),
        **_same({"created_date": "CreatedDate", "modified_date": "ModifiedDate"}, parse_datetime),
        "scd2_hash": K.change_hash("AccountType", "AccountStatus", "BranchID", "Currency"),
    }


def card_columns() -> dict[str, Column]:
    return {
        "card_number_hashed": K.card_hash("CardNumber"),
        **_same({"account_number": "AccountNumber", "card_type": "CardType",
                 "card_network": "CardNetwork"}),
        **_same({"issue_date": "IssueDate", "card_expiry_date": "ExpiryDate"}, any_day),
        "card_holder_name": text("CardHolderName"),
        **_same({"daily_withdrawal_limit": "DailyWithdrawalLimit",
                 "daily_purchase_limit": "DailyPurchaseLimit",
                 "single_txn_limit": "SingleTransactionLimit"}, number),
        "card_status": text("CardStatus"),
    }


def branch_columns() -> dict[str, Column]:
    return {
        **_same({"branch_id": "BranchID", "branch_name": "BranchName",
                 "branch_location": "BranchLocation", "city": "City", "state": "State"}),
        "country": upper_text("Country"),
        "postal_code": text("PostalCode"),
        "open_date": day("OpenDate"),
        "branch_type": text("BranchType"),
    }


def department_columns() -> dict[str, Column]:
    return _same({"department_id": "DepartmentID", "department_name": "DepartmentName",
                  "manager_id": "ManagerID", "branch_id": "BranchID"})


def employee_columns() -> dict[str, Column]:
    return {
        **_same({"employee_id": "EmployeeID", "first_name": "FirstName", "last_name": "LastName"}),
        "full_name": _full_name("FirstName", "LastName"),
        **_same({"email": "Email", "phone_number": "PhoneNumber"}, blank_to_null),
        **_same({"date_of_birth": "DateOfBirth", "hire_date": "HireDate"}, day),
        "position": blank_to_null("Position"),
        "salary": number("Salary"),
        **_same({"department_id": "DepartmentID", "branch_id": "BranchID",
                 "supervisor_id": "SupervisorID"}),
        "scd2_hash": K.change_hash("Position", "Salary", "DepartmentID", "BranchID"),
    }


def transaction_type_columns() -> dict[str, Column]:
    category = upper_text("Category")
    crossing = category.contains("INTERNATIONAL") | category.contains("CROSS")
    return {
        **_same({"transaction_type_id": "TransactionTypeID",
                 "transaction_type_name": "TransactionTypeName", "category": "Category",
                 "description": "Description"}),
        "is_cash_transaction": F.coalesce(category.isin(*CASH_CATEGORIES), F.lit(False)),
        "is_cross_border": F.coalesce(crossing, F.lit(False)),
    }


def merchant_columns() -> dict[str, Column]:
    return {
        **_same({"merchant_id": "MerchantID", "merchant_name": "MerchantName",
                 "merchant_category": "MerchantCategory", "mcc": "MCC",
                 "street_address": "StreetAddress", "city": "City", "state": "State"}),
        "country": upper_text("Country"),
        **_same({"postal_code": "PostalCode", "phone_number": "PhoneNumber",
                 "business_type": "BusinessType", "website_url": "WebsiteURL"}),
        "is_high_risk": F.coalesce(text("MCC").isin(*HIGH_RISK_MCC), F.lit(False)),
    }


def atm_columns() -> dict[str, Column]:
    return {
        **_same({"atm_id": "ATMID", "location": "Location", "street_address": "StreetAddress",
                 "city": "City", "state": "State"}),
        "country": upper_text("Country"),
        "postal_code": text("PostalCode"),
        "latitude": number("Latitude", 10, 7),
        "longitude": number("Longitude", 10, 7),
        **_same({"branch_id": "BranchID", "atm_type": "ATMType", "manufacturer": "Manufacturer",
                 "model": "Model"}),
        **_same({"max_withdrawal_amount": "MaxWithdrawalAmount",
                 "current_cash_level": "CurrentCashLevel"}, number),
        "atm_status": text("ATMStatus"),
        **_same({"installation_date": "InstallationDate",
                 "last_maintenance_date": "LastMaintenanceDate"}, day),
    }


def loan_columns(as_of: str) -> dict[str, Column]:
    amount, outstanding = number("LoanAmount"), number("OutstandingAmount")
    status = (
        F.when(outstanding <= 0, "PAID_OFF")
        .when(day("EndDate") < F.lit(as_of).cast("date"), "OVERDUE")
        .otherwise("ACTIVE")
    )
    repaid = F.round((amount - outstanding).cast("double") / amount.cast("double") * 100, 2)
    return {
        **_same({"loan_id": "LoanID", "customer_id": "CustomerID",
                 "account_number": "AccountNumber", "branch_id": "BranchID",
                 "loan_type": "LoanType"}),
        **_same({"loan_amount": "LoanAmount", "outstanding_amount": "OutstandingAmount"}, number),
        "interest_rate": number("InterestRate", 10, 4),
        "loan_term_months": whole("LoanTermMonths"),
        **_same({"start_date": "StartDate", "end_date": "EndDate",
                 "next_payment_date": "NextPaymentDate"}, day),
        "monthly_payment": number("MonthlyPayment"),
        "loan_status": status,
        "repayment_pct": F.when(amount > 0, repaid).otherwise(F.lit(0.0)),
    }


def transaction_columns() -> dict[str, Column]:
    stamp = parse_datetime("TransactionDate")
    return {
        **_same({"transaction_id": "TransactionID", "account_number": "AccountNumber"}),
        "transaction_date": stamp,
        "amount": number("Amount"),
        "currency": upper_text("Currency"),
        **_same({"transaction_type_id": "TransactionTypeID",
                 "transaction_method": "TransactionMethod", "channel": "Channel",
                 "merchant_id": "MerchantID", "atm_id": "ATMID", "city": "City",
                 "state": "State"}),
        "country": upper_text("Country"),
        "latitude": number("Latitude", 10, 7),
        "longitude": number("Longitude", 10, 7),
        "is_international": flag("IsInternational"),
        **_same({"device_id": "DeviceID", "device_type": "DeviceType",
                 "ip_address": "IPAddress"}),
        "card_number_hashed": K.card_hash("CardNumber"),
        "date_key": K.date_key(stamp, None),
    }


def phone_columns() -> dict[str, Column]:
    return {
        **_same({"phone_id": "PhoneID", "customer_id": "CustomerID",
                 "phone_number": "PhoneNumber", "phone_type": "PhoneType"}),
        "is_primary": flag("IsPrimary"),
    }


def realtime_transaction_columns() -> dict[str, Column]:
    """Stored stream rows, retyped. ``location_mismatch`` stays 0/1/2."""
    def flags(*names):
        return {n: flag(n) for n in names}

    def reals(*names):
        return {n: real(n) for n in names}

    def wholes(*names):
        return {n: whole(n) for n in names}

    return {
        **_same({"transaction_id": "TransactionID", "account_number": "AccountNumber",
                 "customer_id": "CustomerID", "merchant_id": "MerchantID", "atm_id": "ATMID",
                 "branch_id": "BranchID", "card_number_hashed": "CardNumberHashed"}),
        "transaction_date": parse_datetime("TransactionDate"),
        "amount": number("Amount"),
        "currency": upper_text("Currency"),
        **_same({"transaction_type_id": "TransactionTypeID",
                 "transaction_method": "TransactionMethod", "channel": "Channel",
                 "transaction_status": "TransactionStatus", "city": "City", "state": "State"}),
        "country": upper_text("Country"),
        "latitude": number("Latitude", 10, 7),
        "longitude": number("Longitude", 10, 7),
        "is_international": flag("IsInternational"),
        **_same({"device_id": "DeviceID", "device_type": "DeviceType", "ip_address": "IPAddress",
                 "customer_segment": "CustomerSegment", "customer_city": "CustomerCity"}),
        "customer_country": upper_text("CustomerCountry"),
        **_same({"account_type": "AccountType", "account_status": "AccountStatus"}),
        **_same({"current_balance": "CurrentBalance", "available_balance": "AvailableBalance"},
                number),
        **wholes("transaction_hour", "transaction_day_of_week"),
        **flags("is_weekend", "is_night_transaction"),
        **reals("amount_to_balance_ratio", "amount_to_available_ratio"),
        **flags("is_high_value"),
        **reals("balance_utilization"),
        **flags("below_minimum_balance", "is_home_city", "is_home_country"),
        **wholes("location_mismatch"),
        **flags("is_new_account", "is_dormant_account"),
        **wholes("account_age_days", "days_since_last_activity", "customer_age_days",
                 "customer_tenure_days"),
        **flags("is_new_customer", "is_active_account", "is_active_customer", "is_withdrawal",
                "is_transfer", "is_purchase", "is_deposit", "is_atm", "is_online", "is_mobile",
                "is_branch"),
        **reals("risk_score_base", "combined_risk_score"),
        **wholes("transactions_last_1h", "transactions_last_24h"),
        **reals("amount_last_1h", "amount_last_24h", "avg_amount_24h"),
        **flags("is_high_velocity", "is_unusual_amount"),
        "processing_timestamp": parse_datetime("processing_timestamp"),
        "load_timestamp": F.col("_LOAD_TS"),
        "source_file": F.col("_SOURCE_FILE"),
    }


def realtime_detection_columns() -> dict[str, Column]:
    return {
        "transaction_id": text("TransactionID"),
        "fraud_score": real("fraud_score"),
        "is_fraud_predicted": flag("is_fraud_predicted"),
        "confidence_score": real("confidence_score"),
        **{n: text(n) for n in ("fraud_type", "risk_indication", "action_taken")},
        "inference_latency_ms": real("inference_latency_ms"),
        "processing_timestamp": parse_datetime("processing_timestamp"),
        **{n: text(n) for n in ("model_name", "model_version")},
        "is_review_required": flag("is_review_required"),
        "load_timestamp": F.col("_LOAD_TS"),
        "source_file": F.col("_SOURCE_FILE"),
    }


# model -> (natural key in RAW, projection)
BATCH_MODELS = {
    "customer": ("CustomerID", customer_columns),
    "customer_phone": ("PhoneID", phone_columns),
    "account": ("AccountNumber", account_columns),
    "card": ("CardNumber", card_columns),
    "branch": ("BranchID", branch_columns),
    "department": ("DepartmentID", department_columns),
    "employee": ("EmployeeID", employee_columns),
    "transaction_type": ("TransactionTypeID", transaction_type_columns),
    "merchant": ("MerchantID", merchant_columns),
    "atm": ("ATMID", atm_columns),
    "loan": ("LoanID", loan_columns),
    "transaction": ("TransactionID", transaction_columns),
}


def stage_batch(name: str, raw: DataFrame, batch_id: str, as_of: str) -> DataFrame:
    """Any of the twelve batch models by name."""
    key, columns = BATCH_MODELS[name]
    made = columns(as_of) if name == "loan" else columns()
    return stage(raw, batch_id, key, made)


def stage_realtime_transaction(raw: DataFrame) -> DataFrame:
    rows = not_blank(raw, "TransactionID")
    return rows.select(*[e.alias(n) for n, e in realtime_transaction_columns().items()])


def stage_realtime_detection(raw: DataFrame) -> DataFrame:
    rows = not_blank(raw, "TransactionID")
    return rows.select(*[e.alias(n) for n, e in realtime_detection_columns().items()])
