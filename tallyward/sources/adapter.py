"""Bank inputs derived from the analytics tables (customer, orders, events, ...).

Every derived value is integer or modulo arithmetic on the source columns, so another
engine can rebuild the same rows. All columns come out as text, like a real RAW load.
Each dimension row is delivered in two batches; rows whose key divides by 10 are sent a
second time, corrected, an hour later, and some batches carry rows with a blank key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.schemas import BATCH_COLUMNS
from tallyward.functions.keys import row_hash

FIRST_BATCH, BATCH = "B1", "B2"
AS_OF = "2024-02-01"
NOW = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _versions(df: DataFrame, key: str, batches=(FIRST_BATCH, BATCH)) -> DataFrame:
    """Copies of each row: v=0 as sent, v=1 corrected later, v=2 with a blank key."""
    v = F.expr(
        f"filter(array(0, if({key} % 10 = 0, 1, null), if({key} % 53 = 11, 2, null)), "
        "x -> x is not null)"
    )
    return df.withColumn("v", F.explode(v)).withColumn(
        "b", F.explode(F.array(*[F.lit(b) for b in batches]))
    )


def _raw(df: DataFrame, name: str, key_column: str, exprs: dict[str, str]) -> DataFrame:
    """Project to the declared RAW columns (missing ones NULL) and add the load metadata."""
    columns = []
    for c in BATCH_COLUMNS[name]:
        e = f"cast({exprs.get(c, 'null')} as string)"
        columns.append(f"if(v = 2, '  ', {e}) as {c}" if c == key_column else f"{e} as {c}")
    out = df.selectExpr(
        *columns, "b as _BATCH_ID", "'CORE' as _SOURCE_SYSTEM",
        "concat(if(b = 'B1', '2023-12-31', '2024-01-15'), if(v = 1, 'T07:00:00', 'T06:00:00')) as _LOAD_TS",
    )
    return out.withColumn("_ROW_HASH", row_hash(BATCH_COLUMNS[name]))


def raw_customer(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    df = _versions(c.join(n, c.c_nationkey == n.n_nationkey, "left"), "c_custkey")
    return _raw(df, "customer", "CustomerID", {
        "CustomerID": "if(c_custkey % 17 = 3, concat(' C', c_custkey, ' '), concat('C', c_custkey))",
        "FirstName": "if(c_custkey % 89 = 7, null, concat(' First', c_custkey % 50))",
        "LastName": "c_name",
        "Email": "if(c_custkey % 11 = 0, '  ', concat('c', c_custkey, '@example.com'))",
        "DateOfBirth": "case when c_custkey % 97 = 0 then '' when c_custkey % 131 = 9 then 'not-a-date' "
                       "else cast(date_add(date'1950-01-01', cast((c_custkey * 37) % 22000 as int)) as string) end",
        "Gender": "if(c_custkey % 2 = 0, 'F', 'M')",
        "MaritalStatus": "case c_custkey % 3 when 0 then 'Single' when 1 then 'Married' else null end",
        "Occupation": "concat('Occ', c_custkey % 12, if(v = 1, ' fixed', ''))",
        "StreetAddress": "concat(c_custkey, ' Main St')",
        "City": "concat('City', if(b = 'B2' and c_custkey % 7 = 0, c_custkey + 1, c_custkey) % 10)",
        "State": "concat('S', c_nationkey)",
        "Country": "n_name",
        "PostalCode": "lpad(cast(c_custkey % 100000 as string), 5, '0')",
        "CustomerSince": "date_sub(date'2023-11-15', cast(c_custkey % 400 as int))",
        "CustomerSegment": "case c_mktsegment when 'MACHINERY' then 'Premium' when 'BUILDING' then 'VIP' "
                           "when 'FURNITURE' then 'Basic' else 'Standard' end",
        "IDType": "if(c_custkey % 4 = 0, 'PASSPORT', 'NATIONAL_ID')",
        "IDNumber": "concat('ID', c_custkey)",
        "TaxID": "concat('TX', c_custkey)",
        "IsActive": "if(c_custkey % 10 = 9, '0', '1')",
        "CreatedDate": "concat(date_sub(date'2023-11-15', cast(c_custkey % 400 as int)), 'T00:00:00')",
        "ModifiedDate": "'2023-12-01 10:00:00.5'",
    })


def raw_customer_phone(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").withColumn("i", F.explode(F.expr("array(0, 1)")))
    df = _versions(c, "c_custkey")
    return _raw(df, "customer_phone", "PhoneID", {
        "PhoneID": "concat('P', c_custkey * 2 + i)",
        "CustomerID": "concat('C', c_custkey)",
        "PhoneNumber": "concat(' +49', lpad(cast(c_custkey * 2 + i + v as string), 9, '0'))",
        "PhoneType": "if(i = 0, 'mobile', 'home')",
        "IsPrimary": "if(i = c_custkey % 2, 'Yes', 'no')",
    })


def raw_account(spark, sf_dir) -> DataFrame:
    df = _versions(table(spark, sf_dir, "customer"), "c_custkey")
    return _raw(df, "account", "AccountNumber", {
        "AccountNumber": "if(c_custkey % 19 = 4, concat('  A', c_custkey), concat('A', c_custkey))",
        "CustomerID": "if(c_custkey % 101 = 5, 'C8888888', concat('C', c_custkey))",
        "AccountType": "case c_custkey % 3 when 0 then ' Checking' when 1 then 'Savings' else 'Business' end",
        "BranchID": "concat('B', c_nationkey)",
        "Balance": "if(c_custkey % 113 = 6, 'n/a', cast(cast(c_acctbal as decimal(18,2)) + v as string))",
        "AvailableBalance": "cast(cast(c_acctbal as decimal(18,2)) * 0.9 as decimal(18,2))",
        "Currency": "if(c_custkey % 2 = 0, 'usd ', 'EUR')",
        "OpenDate": "date_sub(date'2023-12-15', cast((c_custkey * 7) % 1000 as int))",
        "LastActivityDate": "date_sub(date'2023-12-31', cast((c_custkey * 11) % 400 as int))",
        "InterestRate": "cast((c_custkey % 900) as decimal(10,4)) / 100",
        "MinimumBalance": "'100'",
        "OverdraftLimit": "if(c_custkey % 3 = 0, '500', null)",
        "AccountStatus": "case when c_custkey % 20 = 7 then 'Frozen' "
                         "when b = 'B2' and c_custkey % 9 = 0 then 'Dormant' else 'Active' end",
        "CreatedDate": "concat(date_sub(date'2023-12-15', cast((c_custkey * 7) % 1000 as int)), ' 08:30:00')",
        "ModifiedDate": "'2023-12-31T10:00:00+02:00'",
    })


def raw_card(spark, sf_dir) -> DataFrame:
    df = _versions(table(spark, sf_dir, "customer"), "c_custkey")
    return _raw(df, "card", "CardNumber", {
        "CardNumber": "concat('4', lpad(cast(c_custkey as string), 15, '0'), if(c_custkey % 23 = 1, ' ', ''))",
        "AccountNumber": "concat('A', c_custkey)",
        "CardType": "if(c_custkey % 2 = 0, 'Debit', 'Credit')",
        "CardNetwork": "case c_custkey % 3 when 0 then 'NetA' when 1 then 'NetB' else ' NetC ' end",
        "IssueDate": "date_add(date'2022-01-01', cast(c_custkey % 700 as int))",
        "ExpiryDate": "if(c_custkey % 29 = 2, '05/2027', '2027-05-31')",
        "CardHolderName": "concat(c_name, ' ')",
        "DailyWithdrawalLimit": "500 + (c_custkey % 10) * 100 + v",
        "DailyPurchaseLimit": "2000 + (c_custkey % 10) * 100",
        "SingleTransactionLimit": "'1000.005'",
        "CardStatus": "if(c_custkey % 15 = 0, 'Blocked', 'Active')",
    })


def raw_branch(spark, sf_dir) -> DataFrame:
    df = _versions(table(spark, sf_dir, "nation"), "n_nationkey")
    return _raw(df, "branch", "BranchID", {
        "BranchID": "concat('B', n_nationkey)",
        "BranchName": "concat('Branch ', n_name, if(v = 1, ' fixed', ''))",
        "BranchLocation": "concat('Lot ', n_nationkey)",
        "City": "concat('City', n_nationkey % 10)",
        "State": "concat('S', n_nationkey)",
        "Country": "lower(n_name)",
        "PostalCode": "lpad(cast(n_nationkey as string), 5, '0')",
        "PhoneNumber": "concat('+1', n_nationkey)",
        "ManagerID": "concat('E', n_nationkey)",
        "OpenDate": "if(n_nationkey = 13, '2001-2-3', cast(date_add(date'2001-02-03', n_nationkey * 30) as string))",
        "BranchType": "if(n_nationkey % 3 = 0, 'HQ', 'Retail')",
    })


def raw_department(spark, sf_dir) -> DataFrame:
    df = _versions(table(spark, sf_dir, "region"), "r_regionkey")
    return _raw(df, "department", "DepartmentID", {
        "DepartmentID": "concat('DP', r_regionkey)",
        "DepartmentName": "concat(' ', r_name)",
        "ManagerID": "concat('E', r_regionkey)",
        "BranchID": "concat('B', r_regionkey * 7)",
    })


def raw_employee(spark, sf_dir) -> DataFrame:
    df = _versions(table(spark, sf_dir, "supplier"), "s_suppkey")
    return _raw(df, "employee", "EmployeeID", {
        "EmployeeID": "concat('E', s_suppkey)",
        "FirstName": "concat('Emp', s_suppkey % 30)",
        "LastName": "concat(s_name, ' ')",
        "Email": "if(s_suppkey % 6 = 0, '', concat('e', s_suppkey, '@example.com'))",
        "PhoneNumber": "if(s_suppkey % 5 = 0, ' ', concat('+2', s_suppkey))",
        "DateOfBirth": "date_add(date'1960-01-01', cast((s_suppkey * 41) % 15000 as int))",
        "HireDate": "date_add(date'2010-01-01', cast((s_suppkey * 13) % 4000 as int))",
        "Position": "case s_suppkey % 4 when 0 then 'Analyst' when 1 then 'Teller' when 2 then 'Manager' else '' end",
        "Salary": "cast(cast(abs(s_acctbal) as decimal(18,2)) + if(b = 'B2' and s_suppkey % 8 = 0, 100, 0) + v as decimal(18,2))",
        "DepartmentID": "concat('DP', s_suppkey % 6)",
        "BranchID": "concat('B', s_nationkey)",
        "SupervisorID": "if(s_suppkey % 10 = 0, null, concat('E', s_suppkey - s_suppkey % 10))",
    })


_TYPE_ID = ("case event_type when 'signup' then 1 when 'purchase' then 2 when 'error' then 3 "
            "when 'click' then 4 else 5 end")


def raw_transaction_type(spark, sf_dir) -> DataFrame:
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    df = _versions(kinds.withColumn("k", F.expr(_TYPE_ID)), "k")
    return _raw(df, "transaction_type", "TransactionTypeID", {
        "TransactionTypeID": "k",
        "TransactionTypeName": "concat(' ', initcap(event_type))",
        "Category": "case k when 1 then 'Deposit' when 2 then 'Card' when 3 then ' cash ' "
                    "when 4 then 'International Transfer' else 'Cross-border' end",
        "Description": "concat('Type ', event_type)",
    })


# Merchant codes used by the adapter; four of the ten count as high risk.
_MCC = "array('5411','7995','5812','5912','4111','6211','5732','7801','5541','5814')"


def raw_merchant(spark, sf_dir) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    df = _versions(s.join(n, s.s_nationkey == n.n_nationkey, "left"), "s_suppkey")
    return _raw(df, "merchant", "MerchantID", {
        "MerchantID": "concat('M', s_suppkey)",
        "MerchantName": "concat(s_name, if(v = 1, ' fixed', ''))",
        "MerchantCategory": "concat('Cat', s_suppkey % 7)",
        "MCC": f"concat(element_at({_MCC}, cast(s_suppkey % 10 as int) + 1), ' ')",
        "StreetAddress": "concat(s_suppkey, ' Market St')",
        "City": "concat('City', s_suppkey % 10)",
        "State": "concat('S', s_nationkey)",
        "Country": "lower(n_name)",
        "PostalCode": "lpad(cast(s_suppkey as string), 5, '0')",
        "PhoneNumber": "concat('+3', s_suppkey)",
        "BusinessType": "if(s_suppkey % 2 = 0, 'Retail', 'Online')",
        "WebsiteURL": "concat('https://m', s_suppkey, '.example.com')",
    })


def raw_atm(spark, sf_dir) -> DataFrame:
    df = _versions(table(spark, sf_dir, "part"), "p_partkey")
    return _raw(df, "atm", "ATMID", {
        "ATMID": "concat('T', p_partkey)",
        "Location": "p_name",
        "StreetAddress": "concat(p_partkey, ' Station Rd')",
        "City": "concat('City', p_partkey % 10)",
        "State": "concat('S', p_partkey % 25)",
        "Country": "concat('nation_', p_partkey % 25)",
        "PostalCode": "lpad(cast(p_partkey as string), 5, '0')",
        "Latitude": "cast(cast(p_partkey % 1800000 as decimal(18,7)) / 10000 - 90 as decimal(10,7))",
        "Longitude": "if(p_partkey % 59 = 3, 'east', cast(cast(p_partkey % 3600 as decimal(18,7)) / 10 - 180 as string))",
        "BranchID": "concat('B', p_partkey % 27)",
        "ATMType": "p_type",
        "Manufacturer": "p_brand",
        "Model": "concat('X', p_size)",
        "MaxWithdrawalAmount": "cast(p_retailprice as decimal(18,2))",
        "CurrentCashLevel": "p_partkey * 3 + v",
        "ATMStatus": "if(p_partkey % 12 = 0, 'Down', 'Up')",
        "InstallationDate": "date_add(date'2015-01-01', cast(p_partkey % 3000 as int))",
        "LastMaintenanceDate": "if(p_partkey % 31 = 0, '', '2023-12-20')",
    })


def raw_loan(spark, sf_dir) -> DataFrame:
    df = _versions(table(spark, sf_dir, "orders"), "o_orderkey")
    amount = "cast(o_totalprice as decimal(18,2))"
    return _raw(df, "loan", "LoanID", {
        "LoanID": "concat('L', o_orderkey)",
        "CustomerID": "concat('C', o_custkey)",
        "AccountNumber": "concat('A', o_custkey)",
        "BranchID": "concat('B', o_custkey % 27)",
        "LoanType": "substr(o_orderpriority, 3)",
        "LoanAmount": f"if(o_orderkey % 211 = 8, '0', cast({amount} as string))",
        "OutstandingAmount": "case when o_orderkey % 41 = 0 then '' when v = 1 then '0' "
                             f"else cast(cast({amount} * (o_orderkey % 5) / 5 as decimal(18,2)) as string) end",
        "InterestRate": "cast(cast(o_orderkey % 900 as decimal(18,4)) / 100 as decimal(10,4))",
        "LoanTermMonths": "12 * (1 + o_orderkey % 30)",
        "StartDate": "cast(o_orderdate as date)",
        "EndDate": "if(o_orderkey % 37 = 0, '', cast(date_add(cast(o_orderdate as date), 9500) as string))",
        "NextPaymentDate": "if(o_orderkey % 3 = 0, null, '2024-02-15')",
        "MonthlyPayment": f"cast({amount} / (12 * (1 + o_orderkey % 30)) as decimal(18,2))",
        "TotalPaid": "'0'",
    })


def _events(spark, sf_dir) -> DataFrame:
    """Events with account number ``k`` (a fifth of them on account 0) and its home nation.

    A file of few row groups is read by as few tasks, and a hot account comes out of the join in one, so
    the narrow rows are dealt evenly before anybody makes wide ones of them.
    """
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withColumn(
        "k",
        F.expr("case when event_id % 50 = 1 then 9999999 when event_id % 5 = 0 then 0 else user_id end"),
    )
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_nationkey")
    return e.join(c, "k", "left").withColumn("nat", F.coalesce("c_nationkey", F.lit(0))).hint("rebalance")


_TXN = {
    "AccountNumber": "if(event_id % 401 = 17, '', concat('A', k))",
    "Currency": "if(event_id % 3 = 0, ' usd', 'EUR')",
    "TransactionTypeID": _TYPE_ID,
    "TransactionMethod": "case event_id % 3 when 0 then 'Chip' when 1 then 'Contactless' else ' Transfer' end",
    "Channel": "case event_id % 5 when 0 then 'ATM' when 1 then 'Online' when 2 then 'Mobile' "
               "when 3 then 'Branch' else 'POS' end",
    "TransactionStatus": "if(event_id % 29 = 0, 'Pending', 'Completed')",
    "MerchantID": "if(event_id % 2 = 1, concat('M', event_id % 120), null)",
    "ATMID": "if(event_id % 5 = 0, concat('T', cast(floor(event_id / 5) as bigint) % 230), null)",
    "City": "case when event_id % 307 = 2 then null when event_id % 4 = 0 then concat('City', event_id % 10) "
            "else concat('City', k % 10) end",
    "State": "concat('S', nat)",
    "Country": "if(event_id % 8 = 0, concat('NATION_', event_id % 25), concat('NATION_', nat))",
    "Latitude": "if(event_id % 501 = 0, 'north', cast(cast(cast(event_id % 180 as decimal(18,7)) - 90 as decimal(10,7)) as string))",
    "Longitude": "cast(cast(event_id % 360 as decimal(18,7)) - 180 as decimal(10,7))",
    "IsInternational": "if(event_id % 8 = 0, 'true', '0')",
    "DeviceID": "concat('D', k % 1000)",
    "DeviceType": "case event_id % 3 when 0 then 'ios' when 1 then 'android' else 'web' end",
    "IPAddress": "concat('10.0.', event_id % 256, '.', k % 256)",
    "CardNumber": "if(event_id % 3 = 0, concat('4', lpad(cast(k as string), 15, '0')), null)",
}
_AMOUNT = "cast(value * 100 as decimal(18,2)) * if(event_id % 23 = 6, -1, 1)"


def raw_transaction(spark, sf_dir) -> DataFrame:
    df = _versions(_events(spark, sf_dir), "event_id", batches=(BATCH,))
    return _raw(df, "transaction", "TransactionID", {
        **_TXN,
        "TransactionID": "case when event_id % 97 = 5 then ' ' when event_id % 19 = 4 "
                         "then concat(' X', event_id) else concat('X', event_id) end",
        "TransactionDate": "if(event_id % 977 = 13, 'bad-date', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"))",
        "Amount": f"if(event_id % 211 = 3, 'n/a', cast({_AMOUNT} + v as string))",
    })


def cdc_events(spark, sf_dir) -> DataFrame:
    """One JSON change event per source event, as a ``value`` text column; some are broken."""
    e = _events(spark, sf_dir)
    fields = {
        **_TXN,
        "TransactionID": "concat('X', event_id)",
        "TransactionDate": "if(event_id % 977 = 13, 'bad-date', cast(unix_seconds(ts) * 1000000000 as string))",
        "Amount": f"if(event_id % 211 = 3, 'n/a', cast({_AMOUNT} as string))",
        "BalanceBefore": "cast(event_id % 50000 as string)",
        "BalanceAfter": f"cast(cast(event_id % 50000 as decimal(18,2)) - {_AMOUNT} as string)",
        "CustomerID": "if(k = 9999999, concat('C', user_id), null)",
        "__op": "case event_id % 10 when 0 then 'u' when 3 then 'r' when 7 then 'd' when 8 then null else 'c' end",
    }
    body = F.to_json(F.struct(*[F.expr(x).cast("string").alias(c) for c, x in fields.items()]))
    broken = F.expr("event_id % 499 = 7")
    return e.select(F.when(broken, F.expr("concat('{\"TransactionID\": \"X', event_id)")).otherwise(body).alias("value"))


def decisions(spark, sf_dir) -> DataFrame:
    """Analyst reviews: verdict TRUE, FALSE or pending, minutes taken and the analyst."""
    return table(spark, sf_dir, "events").select(
        F.expr("concat('X', event_id)").alias("transaction_id"),
        F.expr("case event_id % 3 when 0 then true when 1 then false end").alias("is_confirmed_fraud"),
        F.expr("if(event_id % 3 = 2, null, cast(event_id % 600 as int))").alias("resolution_minutes"),
        F.expr("concat('E', event_id % 10)").alias("analyst_id"),
    )


def rates(spark, sf_dir) -> DataFrame:
    """Currency to USD rates by day, from the days and currencies that occur."""
    day = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("rate_date")).distinct()
    return day.withColumn("currency", F.explode(F.expr("array('EUR', 'USD')"))).withColumn(
        "usd_rate",
        F.expr("if(currency = 'USD', cast(1 as decimal(10,4)), cast(cast(1 as decimal(10,4)) + cast(day(rate_date) as decimal(10,4)) / 1000 as decimal(10,4)))"),
    )


RAW = {
    "customer": raw_customer, "customer_phone": raw_customer_phone, "account": raw_account,
    "card": raw_card, "branch": raw_branch, "department": raw_department,
    "employee": raw_employee, "transaction_type": raw_transaction_type,
    "merchant": raw_merchant, "atm": raw_atm, "loan": raw_loan, "transaction": raw_transaction,
}
