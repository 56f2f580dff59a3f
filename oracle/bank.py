"""The bank inputs again, in DuckDB SQL, written apart from the Spark adapter."""

from __future__ import annotations

VERSIONS = "(select unnest([0, 1, 2]) as v) vv, (select unnest(['B1', 'B2']) as b) bb"
ONE_BATCH = "(select unnest([0, 1, 2]) as v) vv, (select 'B2' as b) bb"


def _raw(source: str, k: str, id_column: str, columns: dict[str, str], batches: str = VERSIONS) -> str:
    cols = []
    for name, e in columns.items():
        e = f"cast({e} as varchar)"
        if name == id_column:
            e = f"case when v = 2 then '  ' else {e} end"
        cols.append(f"{e} as {name}")
    return (
        f"select {', '.join(cols)}, b as _BATCH_ID, "
        "(case when b = 'B1' then '2023-12-31' else '2024-01-15' end) || "
        "(case when v = 1 then 'T07:00:00' else 'T06:00:00' end) as _LOAD_TS "
        f"from {source}, {batches} "
        f"where v = 0 or (v = 1 and {k} % 10 = 0) or (v = 2 and {k} % 53 = 11)"
    )


RAW = {}
RAW["raw_customer"] = _raw(
    "customer left join nation on c_nationkey = n_nationkey", "c_custkey", "CustomerID", {
        "CustomerID": "case when c_custkey % 17 = 3 then ' C' || c_custkey || ' ' else 'C' || c_custkey end",
        "FirstName": "case when c_custkey % 89 <> 7 then ' First' || (c_custkey % 50) end",
        "LastName": "c_name",
        "Email": "case when c_custkey % 11 = 0 then '  ' else 'c' || c_custkey || '@example.com' end",
        "DateOfBirth": "case when c_custkey % 97 = 0 then '' when c_custkey % 131 = 9 then 'not-a-date' "
                       "else cast(date '1950-01-01' + cast((c_custkey * 37) % 22000 as integer) as varchar) end",
        "Gender": "case when c_custkey % 2 = 0 then 'F' else 'M' end",
        "MaritalStatus": "case c_custkey % 3 when 0 then 'Single' when 1 then 'Married' end",
        "Occupation": "'Occ' || (c_custkey % 12) || case when v = 1 then ' fixed' else '' end",
        "StreetAddress": "c_custkey || ' Main St'",
        "City": "'City' || ((case when b = 'B2' and c_custkey % 7 = 0 then c_custkey + 1 else c_custkey end) % 10)",
        "State": "'S' || c_nationkey",
        "Country": "n_name",
        "PostalCode": "lpad(cast(c_custkey % 100000 as varchar), 5, '0')",
        "CustomerSince": "date '2023-11-15' - cast(c_custkey % 400 as integer)",
        "CustomerSegment": "case c_mktsegment when 'MACHINERY' then 'Premium' when 'BUILDING' then 'VIP' "
                           "when 'FURNITURE' then 'Basic' else 'Standard' end",
        "IDType": "case when c_custkey % 4 = 0 then 'PASSPORT' else 'NATIONAL_ID' end",
        "IDNumber": "'ID' || c_custkey",
        "TaxID": "'TX' || c_custkey",
        "IsActive": "case when c_custkey % 10 = 9 then '0' else '1' end",
        "CreatedDate": "cast(date '2023-11-15' - cast(c_custkey % 400 as integer) as varchar) || 'T00:00:00'",
    })
RAW["raw_customer_phone"] = _raw(
    "customer, (select unnest([0, 1]) as i) ii", "c_custkey", "PhoneID", {
        "PhoneID": "'P' || (c_custkey * 2 + i)",
        "CustomerID": "'C' || c_custkey",
        "PhoneNumber": "' +49' || lpad(cast(c_custkey * 2 + i + v as varchar), 9, '0')",
        "PhoneType": "case when i = 0 then 'mobile' else 'home' end",
        "IsPrimary": "case when i = c_custkey % 2 then 'Yes' else 'no' end",
    })
RAW["raw_account"] = _raw("customer", "c_custkey", "AccountNumber", {
    "AccountNumber": "case when c_custkey % 19 = 4 then '  A' || c_custkey else 'A' || c_custkey end",
    "CustomerID": "case when c_custkey % 101 = 5 then 'C8888888' else 'C' || c_custkey end",
    "AccountType": "case c_custkey % 3 when 0 then ' Checking' when 1 then 'Savings' else 'Business' end",
    "BranchID": "'B' || c_nationkey",
    "Balance": "case when c_custkey % 113 = 6 then 'n/a' else cast(cast(c_acctbal as decimal(18,2)) + v as varchar) end",
    "AvailableBalance": "cast(cast(c_acctbal as decimal(18,2)) * 0.9 as decimal(18,2))",
    "Currency": "case when c_custkey % 2 = 0 then 'usd ' else 'EUR' end",
    "OpenDate": "date '2023-12-15' - cast((c_custkey * 7) % 1000 as integer)",
    "LastActivityDate": "date '2023-12-31' - cast((c_custkey * 11) % 400 as integer)",
    "InterestRate": "cast(c_custkey % 900 as decimal(10,4)) * 0.01",
    "MinimumBalance": "'100'",
    "OverdraftLimit": "case when c_custkey % 3 = 0 then '500' end",
    "AccountStatus": "case when c_custkey % 20 = 7 then 'Frozen' when b = 'B2' and c_custkey % 9 = 0 then 'Dormant' else 'Active' end",
    "CreatedDate": "cast(date '2023-12-15' - cast((c_custkey * 7) % 1000 as integer) as varchar) || ' 08:30:00'",
    "ModifiedDate": "'2023-12-31T10:00:00+02:00'",
})
RAW["raw_card"] = _raw("customer", "c_custkey", "CardNumber", {
    "CardNumber": "'4' || lpad(cast(c_custkey as varchar), 15, '0') || case when c_custkey % 23 = 1 then ' ' else '' end",
    "AccountNumber": "'A' || c_custkey",
    "CardType": "case when c_custkey % 2 = 0 then 'Debit' else 'Credit' end",
    "CardNetwork": "case c_custkey % 3 when 0 then 'NetA' when 1 then 'NetB' else ' NetC ' end",
    "IssueDate": "date '2022-01-01' + cast(c_custkey % 700 as integer)",
    "ExpiryDate": "case when c_custkey % 29 = 2 then '05/2027' else '2027-05-31' end",
    "CardHolderName": "c_name || ' '",
    "DailyWithdrawalLimit": "500 + (c_custkey % 10) * 100 + v",
    "DailyPurchaseLimit": "2000 + (c_custkey % 10) * 100",
    "SingleTransactionLimit": "'1000.005'",
    "CardStatus": "case when c_custkey % 15 = 0 then 'Blocked' else 'Active' end",
})
RAW["raw_branch"] = _raw("nation", "n_nationkey", "BranchID", {
    "BranchID": "'B' || n_nationkey",
    "BranchName": "'Branch ' || n_name || case when v = 1 then ' fixed' else '' end",
    "BranchLocation": "'Lot ' || n_nationkey",
    "City": "'City' || (n_nationkey % 10)",
    "State": "'S' || n_nationkey",
    "Country": "lower(n_name)",
    "PostalCode": "lpad(cast(n_nationkey as varchar), 5, '0')",
    "OpenDate": "case when n_nationkey = 13 then '2001-2-3' else cast(date '2001-02-03' + n_nationkey * 30 as varchar) end",
    "BranchType": "case when n_nationkey % 3 = 0 then 'HQ' else 'Retail' end",
})
RAW["raw_department"] = _raw("region", "r_regionkey", "DepartmentID", {
    "DepartmentID": "'DP' || r_regionkey",
    "DepartmentName": "' ' || r_name",
    "ManagerID": "'E' || r_regionkey",
    "BranchID": "'B' || (r_regionkey * 7)",
})
RAW["raw_employee"] = _raw("supplier", "s_suppkey", "EmployeeID", {
    "EmployeeID": "'E' || s_suppkey",
    "FirstName": "'Emp' || (s_suppkey % 30)",
    "LastName": "s_name || ' '",
    "Email": "case when s_suppkey % 6 = 0 then '' else 'e' || s_suppkey || '@example.com' end",
    "PhoneNumber": "case when s_suppkey % 5 = 0 then ' ' else '+2' || s_suppkey end",
    "DateOfBirth": "date '1960-01-01' + cast((s_suppkey * 41) % 15000 as integer)",
    "HireDate": "date '2010-01-01' + cast((s_suppkey * 13) % 4000 as integer)",
    "Position": "case s_suppkey % 4 when 0 then 'Analyst' when 1 then 'Teller' when 2 then 'Manager' else '' end",
    "Salary": "cast(cast(abs(s_acctbal) as decimal(18,2)) + (case when b = 'B2' and s_suppkey % 8 = 0 then 100 else 0 end) + v as decimal(18,2))",
    "DepartmentID": "'DP' || (s_suppkey % 6)",
    "BranchID": "'B' || s_nationkey",
    "SupervisorID": "case when s_suppkey % 10 <> 0 then 'E' || (s_suppkey - s_suppkey % 10) end",
})
TYPE_ID = "(case event_type when 'signup' then 1 when 'purchase' then 2 when 'error' then 3 when 'click' then 4 else 5 end)"
RAW["raw_transaction_type"] = _raw(
    f"(select distinct event_type, {TYPE_ID} as k from events)", "k", "TransactionTypeID", {
        "TransactionTypeID": "k",
        "TransactionTypeName": "' ' || upper(event_type[1]) || event_type[2:]",
        "Category": "case k when 1 then 'Deposit' when 2 then 'Card' when 3 then ' cash ' "
                    "when 4 then 'International Transfer' else 'Cross-border' end",
        "Description": "'Type ' || event_type",
    })
RAW["raw_merchant"] = _raw(
    "supplier left join nation on s_nationkey = n_nationkey", "s_suppkey", "MerchantID", {
        "MerchantID": "'M' || s_suppkey",
        "MerchantName": "s_name || case when v = 1 then ' fixed' else '' end",
        "MerchantCategory": "'Cat' || (s_suppkey % 7)",
        "MCC": "['5411','7995','5812','5912','4111','6211','5732','7801','5541','5814'][s_suppkey % 10 + 1] || ' '",
        "StreetAddress": "s_suppkey || ' Market St'",
        "City": "'City' || (s_suppkey % 10)",
        "State": "'S' || s_nationkey",
        "Country": "lower(n_name)",
        "PostalCode": "lpad(cast(s_suppkey as varchar), 5, '0')",
        "PhoneNumber": "'+3' || s_suppkey",
        "BusinessType": "case when s_suppkey % 2 = 0 then 'Retail' else 'Online' end",
        "WebsiteURL": "'https://m' || s_suppkey || '.example.com'",
    })
RAW["raw_atm"] = _raw("part", "p_partkey", "ATMID", {
    "ATMID": "'T' || p_partkey",
    "Location": "p_name",
    "StreetAddress": "p_partkey || ' Station Rd'",
    "City": "'City' || (p_partkey % 10)",
    "State": "'S' || (p_partkey % 25)",
    "Country": "'nation_' || (p_partkey % 25)",
    "PostalCode": "lpad(cast(p_partkey as varchar), 5, '0')",
    "Latitude": "cast(cast(p_partkey % 1800000 as decimal(18,7)) * 0.0001 - 90 as decimal(10,7))",
    "Longitude": "case when p_partkey % 59 = 3 then 'east' else cast(cast(cast(p_partkey % 3600 as decimal(18,7)) * 0.1 - 180 as decimal(18,7)) as varchar) end",
    "BranchID": "'B' || (p_partkey % 27)",
    "ATMType": "p_type",
    "Manufacturer": "p_brand",
    "Model": "'X' || p_size",
    "MaxWithdrawalAmount": "cast(p_retailprice as decimal(18,2))",
    "CurrentCashLevel": "p_partkey * 3 + v",
    "ATMStatus": "case when p_partkey % 12 = 0 then 'Down' else 'Up' end",
    "InstallationDate": "date '2015-01-01' + cast(p_partkey % 3000 as integer)",
    "LastMaintenanceDate": "case when p_partkey % 31 = 0 then '' else '2023-12-20' end",
})
_CENTS = "cast(cast(o_totalprice as decimal(18,2)) * 100 as bigint)"
_TERM = "(12 * (1 + o_orderkey % 30))"
RAW["raw_loan"] = _raw("orders", "o_orderkey", "LoanID", {
    "LoanID": "'L' || o_orderkey",
    "CustomerID": "'C' || o_custkey",
    "AccountNumber": "'A' || o_custkey",
    "BranchID": "'B' || (o_custkey % 27)",
    "LoanType": "o_orderpriority[3:]",
    "LoanAmount": "case when o_orderkey % 211 = 8 then '0' else cast(cast(o_totalprice as decimal(18,2)) as varchar) end",
    "OutstandingAmount": "case when o_orderkey % 41 = 0 then '' when v = 1 then '0' "
                         "else cast(cast(cast(o_totalprice as decimal(18,2)) * (o_orderkey % 5) * 0.2 as decimal(18,2)) as varchar) end",
    "InterestRate": "cast(o_orderkey % 900 as decimal(10,4)) * 0.01",
    "LoanTermMonths": _TERM,
    "StartDate": "cast(o_orderdate as date)",
    "EndDate": "case when o_orderkey % 37 = 0 then '' else cast(cast(o_orderdate as date) + 9500 as varchar) end",
    "NextPaymentDate": "case when o_orderkey % 3 <> 0 then '2024-02-15' end",
    "MonthlyPayment": f"cast((2 * {_CENTS} + {_TERM}) // (2 * {_TERM}) as decimal(18,2)) * 0.01",
})
EVENT = """
    select e.*, coalesce(c_nationkey, 0) as nat from (
        select *, case when event_id % 50 = 1 then 9999999 when event_id % 5 = 0 then 0 else user_id end as k
        from events) e left join customer on c_custkey = k
"""
TXN = {
    "AccountNumber": "case when event_id % 401 = 17 then '' else 'A' || k end",
    "Currency": "case when event_id % 3 = 0 then ' usd' else 'EUR' end",
    "TransactionTypeID": TYPE_ID,
    "TransactionMethod": "case event_id % 3 when 0 then 'Chip' when 1 then 'Contactless' else ' Transfer' end",
    "Channel": "['ATM', 'Online', 'Mobile', 'Branch', 'POS'][event_id % 5 + 1]",
    "TransactionStatus": "case when event_id % 29 = 0 then 'Pending' else 'Completed' end",
    "MerchantID": "case when event_id % 2 = 1 then 'M' || (event_id % 120) end",
    "ATMID": "case when event_id % 5 = 0 then 'T' || ((event_id // 5) % 230) end",
    "City": "case when event_id % 307 = 2 then null when event_id % 4 = 0 then 'City' || (event_id % 10) else 'City' || (k % 10) end",
    "State": "'S' || nat",
    "Country": "'NATION_' || (case when event_id % 8 = 0 then event_id % 25 else nat end)",
    "Latitude": "case when event_id % 501 = 0 then 'north' else cast(cast(event_id % 180 - 90 as decimal(10,7)) as varchar) end",
    "Longitude": "cast(event_id % 360 - 180 as decimal(10,7))",
    "IsInternational": "case when event_id % 8 = 0 then 'true' else '0' end",
    "DeviceID": "'D' || (k % 1000)",
    "DeviceType": "['ios', 'android', 'web'][event_id % 3 + 1]",
    "IPAddress": "'10.0.' || (event_id % 256) || '.' || (k % 256)",
    "CardNumber": "case when event_id % 3 = 0 then '4' || lpad(cast(k as varchar), 15, '0') end",
}
AMOUNT = "(cast(value * 100 as decimal(18,2)) * (case when event_id % 23 = 6 then -1 else 1 end))"
RAW["event_rows"] = EVENT
RAW["raw_transaction"] = _raw("event_rows", "event_id", "TransactionID", {
    **TXN,
    "TransactionID": "case when event_id % 97 = 5 then ' ' when event_id % 19 = 4 then ' X' || event_id else 'X' || event_id end",
    "TransactionDate": "case when event_id % 977 = 13 then 'bad-date' else strftime(ts, '%Y-%m-%dT%H:%M:%S') end",
    "Amount": f"case when event_id % 211 = 3 then 'n/a' else cast({AMOUNT} + v as varchar) end",
}, ONE_BATCH)
# Change events that parse; the broken ones never reach this table.
RAW["cdc_parsed"] = "select " + ", ".join(f"cast({e} as varchar) as {n}" for n, e in {
    **TXN,
    "TransactionID": "'X' || event_id",
    "TransactionDate": "case when event_id % 977 = 13 then 'bad-date' else cast(epoch_us(date_trunc('second', ts)) * 1000 as varchar) end",
    "Amount": f"case when event_id % 211 = 3 then 'n/a' else cast({AMOUNT} as varchar) end",
    "BalanceBefore": "event_id % 50000",
    "BalanceAfter": f"cast(event_id % 50000 as decimal(18,2)) - {AMOUNT}",
    "CustomerID": "case when k = 9999999 then 'C' || user_id end",
    "op": "case event_id % 10 when 0 then 'u' when 3 then 'r' when 7 then 'd' when 8 then null else 'c' end",
}.items()) + " from event_rows where event_id % 499 <> 7"
RAW["cdc_kept"] = "select * from cdc_parsed where op is null or op in ('c', 'u')"
RAW["decision_rows"] = """
    select 'X' || event_id as transaction_id,
           case event_id % 3 when 0 then true when 1 then false end as is_confirmed_fraud,
           case when event_id % 3 <> 2 then cast(event_id % 600 as integer) end as resolution_minutes,
           'E' || (event_id % 10) as analyst_id
    from events
"""
