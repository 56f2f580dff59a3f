"""Declared RAW layouts: every column is text, typing happens in staging."""

from __future__ import annotations

from pyspark.sql import types as T

# Source column names, in source order.
BATCH_COLUMNS = {
    "customer": """CustomerID FirstName LastName Email DateOfBirth Gender MaritalStatus
        Occupation StreetAddress City State Country PostalCode CustomerSince CustomerSegment
        IDType IDNumber TaxID IsActive CreatedDate ModifiedDate""",
    "customer_phone": "PhoneID CustomerID PhoneNumber PhoneType IsPrimary",
    "account": """AccountNumber CustomerID AccountType BranchID Balance AvailableBalance
        Currency OpenDate LastActivityDate InterestRate MinimumBalance OverdraftLimit
        AccountStatus CreatedDate ModifiedDate""",
    "card": """CardNumber AccountNumber CardType CardNetwork IssueDate ExpiryDate
        CardHolderName DailyWithdrawalLimit DailyPurchaseLimit SingleTransactionLimit
        CardStatus""",
    "branch": """BranchID BranchName BranchLocation City State Country PostalCode
        PhoneNumber ManagerID OpenDate BranchType""",
    "department": "DepartmentID DepartmentName ManagerID BranchID",
    "employee": """EmployeeID FirstName LastName Email PhoneNumber DateOfBirth HireDate
        Position Salary DepartmentID BranchID SupervisorID""",
    "transaction_type": "TransactionTypeID TransactionTypeName Category Description",
    "merchant": """MerchantID MerchantName MerchantCategory MCC StreetAddress City State
        Country PostalCode PhoneNumber BusinessType WebsiteURL""",
    "atm": """ATMID Location StreetAddress City State Country PostalCode Latitude Longitude
        BranchID ATMType Manufacturer Model MaxWithdrawalAmount CurrentCashLevel ATMStatus
        InstallationDate LastMaintenanceDate""",
    "loan": """LoanID CustomerID AccountNumber BranchID LoanType LoanAmount
        OutstandingAmount InterestRate LoanTermMonths StartDate EndDate NextPaymentDate
        MonthlyPayment TotalPaid""",
    "transaction": """TransactionID AccountNumber TransactionDate Amount Currency
        TransactionTypeID TransactionMethod Channel TransactionStatus MerchantID ATMID City
        State Country Latitude Longitude IsInternational DeviceID DeviceType IPAddress
        CardNumber""",
}
BATCH_COLUMNS = {name: text.split() for name, text in BATCH_COLUMNS.items()}

# Card secrets exist at the source and are dropped before anything is written.
NEVER_EXTRACTED = ("CVV", "PIN")

BATCH_METADATA = ["_BATCH_ID", "_SOURCE_SYSTEM", "_LOAD_TS", "_ROW_HASH"]
STREAM_METADATA = ["_LOAD_TS", "_SOURCE_FILE"]

# The pass-through part of a stored real-time transaction.
REALTIME_PASS_THROUGH = """TransactionID AccountNumber CustomerID MerchantID ATMID BranchID
    CardNumberHashed TransactionDate Amount Currency TransactionTypeID TransactionMethod
    Channel TransactionStatus City State Country Latitude Longitude IsInternational DeviceID
    DeviceType IPAddress CustomerSegment CustomerCity CustomerCountry AccountType
    AccountStatus CurrentBalance AvailableBalance""".split()

# The engineered part of a stored real-time transaction.
REALTIME_ENGINEERED = """transaction_hour transaction_day_of_week is_weekend
    is_night_transaction amount_to_balance_ratio amount_to_available_ratio is_high_value
    balance_utilization below_minimum_balance is_home_city is_home_country
    location_mismatch is_new_account is_dormant_account account_age_days
    days_since_last_activity customer_age_days customer_tenure_days is_new_customer
    is_active_account is_active_customer is_withdrawal is_transfer is_purchase is_deposit
    is_atm is_online is_mobile is_branch risk_score_base combined_risk_score
    transactions_last_1h transactions_last_24h amount_last_1h amount_last_24h
    avg_amount_24h is_high_velocity is_unusual_amount processing_timestamp""".split()

# A stored detection.
REALTIME_DETECTION = """TransactionID fraud_score is_fraud_predicted confidence_score
    fraud_type risk_indication action_taken inference_latency_ms processing_timestamp
    model_name model_version is_review_required""".split()


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


RAW_SCHEMAS = {
    **{name: text_schema(cols + BATCH_METADATA) for name, cols in BATCH_COLUMNS.items()},
    "realtime_transaction": text_schema(
        REALTIME_PASS_THROUGH + REALTIME_ENGINEERED + STREAM_METADATA
    ),
    "realtime_fraud_detection": text_schema(REALTIME_DETECTION + STREAM_METADATA),
}

# Folder of each RAW table below a lake root.
RAW_LOCATIONS = {
    **{name: f"batch/raw/{name}" for name in BATCH_COLUMNS},
    "realtime_transaction": "realtime/transactions",
    "realtime_fraud_detection": "realtime/detections",
}

# One change event: the transaction columns plus balances, an optional customer and operation.
CDC_SCHEMA = text_schema(
    BATCH_COLUMNS["transaction"] + ["BalanceBefore", "BalanceAfter", "CustomerID", "__op"]
)
