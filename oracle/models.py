"""Staging, features, dimensions and facts as CTEs."""

from __future__ import annotations

from oracle.bank import RAW
from oracle.build import day, days, dkey, flag, hashed, key, num, real, stamp, whole

CTES = dict(RAW)


def _staged(raw: str, k: str, columns: str, batch: str = "B2") -> str:
    return (
        f"select {columns} from (select *, row_number() over (partition by {k} order by _LOAD_TS desc) as rn "
        f"from {raw} where _BATCH_ID = '{batch}') where rn = 1 and trim({k}) <> ''"
    )


CUSTOMER = f"""
    trim(CustomerID) as customer_id, trim(FirstName) as first_name, trim(LastName) as last_name,
    trim(FirstName) || ' ' || trim(LastName) as full_name, nullif(trim(Email), '') as email,
    {day('DateOfBirth')} as date_of_birth, trim(Gender) as gender, trim(MaritalStatus) as marital_status,
    trim(Occupation) as occupation, trim(StreetAddress) as street_address, trim(City) as city,
    trim(State) as state, upper(trim(Country)) as country, trim(PostalCode) as postal_code,
    {day('CustomerSince')} as customer_since, trim(CustomerSegment) as customer_segment,
    trim(IDType) as id_type, trim(IDNumber) as id_number, trim(TaxID) as tax_id,
    {hashed('Occupation', 'StreetAddress', 'City', 'State', 'Country', 'CustomerSegment')} as scd2_hash
"""
ACCOUNT = f"""
    trim(AccountNumber) as account_number, trim(CustomerID) as customer_id, trim(AccountType) as account_type,
    trim(BranchID) as branch_id, {num('Balance')} as balance, {num('AvailableBalance')} as available_balance,
    upper(trim(Currency)) as currency, {day('OpenDate')} as open_date,
    {day('LastActivityDate')} as last_activity_date, {num('InterestRate', 10, 4)} as interest_rate,
    {num('MinimumBalance')} as minimum_balance, {num('OverdraftLimit')} as overdraft_limit,
    trim(AccountStatus) as account_status, {stamp('CreatedDate')} as created_date,
    {stamp('ModifiedDate')} as modified_date,
    {hashed('AccountType', 'AccountStatus', 'BranchID', 'Currency')} as scd2_hash
"""
CTES["stg_customer"] = _staged("raw_customer", "CustomerID", CUSTOMER)
CTES["stg_customer_b1"] = _staged("raw_customer", "CustomerID", CUSTOMER, "B1")
CTES["stg_account"] = _staged("raw_account", "AccountNumber", ACCOUNT)
CTES["stg_account_b1"] = _staged("raw_account", "AccountNumber", ACCOUNT, "B1")
CTES["stg_customer_phone"] = _staged("raw_customer_phone", "PhoneID", f"""
    trim(PhoneID) as phone_id, trim(CustomerID) as customer_id, trim(PhoneNumber) as phone_number,
    trim(PhoneType) as phone_type, {flag('IsPrimary')} as is_primary""")
CTES["stg_card"] = _staged("raw_card", "CardNumber", f"""
    sha256(trim(CardNumber)) as card_number_hashed, trim(AccountNumber) as account_number,
    trim(CardType) as card_type, trim(CardNetwork) as card_network,
    try_cast(trim(IssueDate) as date) as issue_date, try_cast(trim(ExpiryDate) as date) as card_expiry_date,
    trim(CardHolderName) as card_holder_name, {num('DailyWithdrawalLimit')} as daily_withdrawal_limit,
    {num('DailyPurchaseLimit')} as daily_purchase_limit, {num('SingleTransactionLimit')} as single_txn_limit,
    trim(CardStatus) as card_status""")
CTES["stg_branch"] = _staged("raw_branch", "BranchID", f"""
    trim(BranchID) as branch_id, trim(BranchName) as branch_name, trim(BranchLocation) as branch_location,
    trim(City) as city, trim(State) as state, upper(trim(Country)) as country, trim(PostalCode) as postal_code,
    {day('OpenDate')} as open_date, trim(BranchType) as branch_type""")
CTES["stg_department"] = _staged("raw_department", "DepartmentID", """
    trim(DepartmentID) as department_id, trim(DepartmentName) as department_name,
    trim(ManagerID) as manager_id, trim(BranchID) as branch_id""")
EMPLOYEE = f"""
    trim(EmployeeID) as employee_id, trim(FirstName) as first_name, trim(LastName) as last_name,
    trim(FirstName) || ' ' || trim(LastName) as full_name, nullif(trim(Email), '') as email,
    nullif(trim(PhoneNumber), '') as phone_number, {day('DateOfBirth')} as date_of_birth,
    {day('HireDate')} as hire_date, nullif(trim(Position), '') as position, {num('Salary')} as salary,
    trim(DepartmentID) as department_id, trim(BranchID) as branch_id, trim(SupervisorID) as supervisor_id,
    {hashed('Position', 'Salary', 'DepartmentID', 'BranchID')} as scd2_hash"""
CTES["stg_employee"] = _staged("raw_employee", "EmployeeID", EMPLOYEE)
CTES["stg_transaction_type"] = _staged("raw_transaction_type", "TransactionTypeID", """
    trim(TransactionTypeID) as transaction_type_id, trim(TransactionTypeName) as transaction_type_name,
    trim(Category) as category, trim(Description) as description,
    coalesce(upper(trim(Category)) in ('CASH', 'WITHDRAWAL', 'DEPOSIT'), false) as is_cash_transaction,
    coalesce(upper(trim(Category)) like '%INTERNATIONAL%' or upper(trim(Category)) like '%CROSS%', false) as is_cross_border""")
CTES["stg_merchant"] = _staged("raw_merchant", "MerchantID", """
    trim(MerchantID) as merchant_id, trim(MerchantName) as merchant_name,
    trim(MerchantCategory) as merchant_category, trim(MCC) as mcc, trim(StreetAddress) as street_address,
    trim(City) as city, trim(State) as state, upper(trim(Country)) as country, trim(PostalCode) as postal_code,
    trim(PhoneNumber) as phone_number, trim(BusinessType) as business_type, trim(WebsiteURL) as website_url,
    coalesce(trim(MCC) in ('7995','5912','5999','6211','7801','7802','7993'), false) as is_high_risk""")
CTES["stg_atm"] = _staged("raw_atm", "ATMID", f"""
    trim(ATMID) as atm_id, trim(Location) as location, trim(StreetAddress) as street_address,
    trim(City) as city, trim(State) as state, upper(trim(Country)) as country, trim(PostalCode) as postal_code,
    {num('Latitude', 10, 7)} as latitude, {num('Longitude', 10, 7)} as longitude, trim(BranchID) as branch_id,
    trim(ATMType) as atm_type, trim(Manufacturer) as manufacturer, trim(Model) as model,
    {num('MaxWithdrawalAmount')} as max_withdrawal_amount, {num('CurrentCashLevel')} as current_cash_level,
    trim(ATMStatus) as atm_status, {day('InstallationDate')} as installation_date,
    {day('LastMaintenanceDate')} as last_maintenance_date""")
CTES["stg_loan"] = _staged("raw_loan", "LoanID", f"""
    trim(LoanID) as loan_id, trim(CustomerID) as customer_id, trim(AccountNumber) as account_number,
    trim(BranchID) as branch_id, trim(LoanType) as loan_type, {num('LoanAmount')} as loan_amount,
    {num('OutstandingAmount')} as outstanding_amount, {num('InterestRate', 10, 4)} as interest_rate,
    {whole('LoanTermMonths')} as loan_term_months, {day('StartDate')} as start_date, {day('EndDate')} as end_date,
    {day('NextPaymentDate')} as next_payment_date, {num('MonthlyPayment')} as monthly_payment,
    case when {num('OutstandingAmount')} <= 0 then 'PAID_OFF'
         when {day('EndDate')} < date '2024-02-01' then 'OVERDUE' else 'ACTIVE' end as loan_status,
    case when {num('LoanAmount')} > 0 then round(cast({num('LoanAmount')} - {num('OutstandingAmount')} as double)
         / cast({num('LoanAmount')} as double) * 100, 2) else 0.0 end as repayment_pct""")
CTES["stg_transaction"] = _staged("raw_transaction", "TransactionID", f"""
    trim(TransactionID) as transaction_id, trim(AccountNumber) as account_number,
    {stamp('TransactionDate')} as transaction_date, {num('Amount')} as amount, upper(trim(Currency)) as currency,
    trim(TransactionTypeID) as transaction_type_id, trim(TransactionMethod) as transaction_method,
    trim(Channel) as channel, trim(MerchantID) as merchant_id, trim(ATMID) as atm_id, trim(City) as city,
    trim(State) as state, upper(trim(Country)) as country, {num('Latitude', 10, 7)} as latitude,
    {num('Longitude', 10, 7)} as longitude, {flag('IsInternational')} as is_international,
    trim(DeviceID) as device_id, trim(DeviceType) as device_type, trim(IPAddress) as ip_address,
    sha256(nullif(trim(CardNumber), '')) as card_number_hashed,
    cast(strftime({stamp('TransactionDate')}, '%Y%m%d') as integer) as date_key""")

# ---- live lookups, sliding figures, features --------------------------------------------
CTES["live_txn"] = f"""
    select trim(TransactionID) as transaction_id, trim(AccountNumber) as account_number,
        nullif(trim(CustomerID), '') as event_customer_id, MerchantID as merchant_id, ATMID as atm_id,
        sha256(nullif(trim(CardNumber), '')) as card_number_hashed, {stamp('TransactionDate')} as transaction_date,
        coalesce({num('Amount')}, 0) as amount, Currency as currency,
        coalesce(cast(trunc({real('TransactionTypeID')}) as integer), 0) as transaction_type_id,
        TransactionMethod as transaction_method, coalesce(Channel, '') as channel,
        TransactionStatus as transaction_status, coalesce(City, '') as city, State as state,
        coalesce(Country, '') as country, coalesce({real('Latitude')}, 0) as latitude,
        coalesce({real('Longitude')}, 0) as longitude, {flag('IsInternational')} as is_international,
        DeviceID as device_id, DeviceType as device_type, IPAddress as ip_address,
        coalesce({num('BalanceBefore')}, 0) as balance_before, coalesce({num('BalanceAfter')}, 0) as balance_after
    from cdc_kept
"""
CTES["live_account"] = f"""
    select trim(AccountNumber) as account_number, trim(CustomerID) as customer_id, AccountType as account_type,
        AccountStatus as account_status, {num('Balance')} as current_balance,
        {num('AvailableBalance')} as available_balance, {stamp('OpenDate')} as account_open_date,
        {stamp('LastActivityDate')} as last_activity_date, BranchID as branch_id, Currency as account_currency,
        {num('InterestRate', 10, 4)} as interest_rate, {num('MinimumBalance')} as minimum_balance,
        {num('OverdraftLimit')} as overdraft_limit
    from (select *, row_number() over (partition by AccountNumber order by _LOAD_TS desc) as rn from raw_account)
    where rn = 1 and trim(AccountNumber) <> ''
"""
CTES["live_customer"] = f"""
    select trim(CustomerID) as customer_id, FirstName as customer_first_name, LastName as customer_last_name,
        Email as customer_email, DateOfBirth as customer_dob, Gender as customer_gender,
        Occupation as customer_occupation, City as customer_city, State as customer_state,
        Country as customer_country, CustomerSegment as customer_segment, {stamp('CustomerSince')} as customer_since,
        {flag('IsActive')} as customer_is_active, {stamp('CreatedDate')} as customer_created_date
    from (select *, row_number() over (partition by CustomerID order by _LOAD_TS desc) as rn from raw_customer)
    where rn = 1 and trim(CustomerID) <> ''
"""


def sliding(source: str) -> str:
    """RANGE frames per account; money in whole cents so the mean is rounded exactly."""
    frame = "over (partition by account_number order by tick range between {w} preceding and current row)"
    h, d = frame.format(w=3600000000), frame.format(w=86400000000)
    return f"""
        select * exclude (tick, cents, s1, s24, n1, n24),
            cast(case when blank then 1 else n1 end as integer) as transactions_last_1h,
            cast(case when blank then 1 else n24 end as integer) as transactions_last_24h,
            cast(case when blank then cents else s1 end as decimal(18,2)) * 0.01 as amount_last_1h,
            cast(case when blank then cents else s24 end as decimal(18,2)) * 0.01 as amount_last_24h,
            cast(case when blank then cents
                 else sign(s24) * ((2 * abs(s24) + n24) // (2 * n24)) end as decimal(18,2)) * 0.01 as avg_amount_24h
        from (select *, count(*) {h} as n1, count(*) {d} as n24,
                  cast(sum(cents) {h} as bigint) as s1, cast(sum(cents) {d} as bigint) as s24
              from (select *, coalesce(trim(account_number), '') = '' as blank,
                        coalesce(epoch_us(transaction_date), 0) as tick, cast(amount * 100 as bigint) as cents
                    from {source}))
    """


CTES["txn_velocity"] = sliding("live_txn")
CTES["with_account"] = """
    select t.*, a.* exclude (account_number) from txn_velocity t left join live_account a using (account_number)
"""
CTES["enriched"] = """
    select t.* exclude (customer_id, event_customer_id), t.cid as customer_id, c.* exclude (customer_id)
    from (select *, coalesce(nullif(customer_id, ''), event_customer_id) as cid from with_account) t
    left join live_customer c on t.cid = c.customer_id
"""


def features(source: str) -> str:
    amt = "cast(amount as double)"
    bal, avl = "coalesce(cast(current_balance as double), 0)", "coalesce(cast(available_balance as double), 0)"
    over = f"({bal} + coalesce(cast(overdraft_limit as double), 0))"

    def ratio(b):
        return f"round(case when {b} > 0 then {amt} / {b} else 0 end, 6)"

    def bit(c):
        return f"cast(coalesce({c}, false) as integer)"

    return f"""
    select *, risk_score_base + segment_risk_adjustment as combined_risk_score,
        {bit('transactions_last_1h >= 5')} as is_high_velocity,
        {bit('avg_amount_24h > 0 and amount > avg_amount_24h * 3')} as is_unusual_amount
    from (select *,
        is_high_value * 3 + cast(is_international as integer) * 2 + is_night_transaction + location_mismatch * 2
        + is_new_account + is_dormant_account * 2 + below_minimum_balance + (1 - is_active_account) * 2
        + (1 - is_active_customer) * 3 as risk_score_base,
        case customer_segment when 'Premium' then -1 when 'VIP' then -2 when 'Standard' then 0 else 1 end
        as segment_risk_adjustment
    from (select *,
        {bit('transaction_day_of_week in (6, 7)')} as is_weekend,
        {bit('transaction_hour >= 23 or transaction_hour <= 4')} as is_night_transaction,
        (1 - is_home_city) + (1 - is_home_country) as location_mismatch,
        {bit('account_age_days < 90')} as is_new_account, {bit('days_since_last_activity > 180')} as is_dormant_account,
        {bit('customer_tenure_days < 90')} as is_new_customer
    from (select *,
        coalesce(hour(transaction_date), 0) as transaction_hour,
        coalesce(isodow(transaction_date), 1) as transaction_day_of_week,
        {ratio(bal)} as amount_to_balance_ratio, {ratio(avl)} as amount_to_available_ratio,
        {ratio(over)} as balance_utilization, balance_before - balance_after as amount_change,
        {bit('amount > 10000')} as is_high_value,
        {bit(f'{bal} < coalesce(cast(minimum_balance as double), 0)')} as below_minimum_balance,
        {bit("coalesce(city, '') = coalesce(customer_city, '')")} as is_home_city,
        {bit("coalesce(country, '') = coalesce(customer_country, '')")} as is_home_country,
        {days('transaction_date', 'account_open_date')} as account_age_days,
        {days('transaction_date', 'last_activity_date')} as days_since_last_activity,
        {days("coalesce(transaction_date, timestamp '2024-02-01')", 'customer_created_date')} as customer_age_days,
        {days("coalesce(transaction_date, timestamp '2024-02-01')", 'customer_since')} as customer_tenure_days,
        {bit("account_status = 'Active'")} as is_active_account, {bit('customer_is_active')} as is_active_customer,
        {bit('transaction_type_id = 1')} as is_deposit, {bit('transaction_type_id = 2')} as is_purchase,
        {bit('transaction_type_id = 3')} as is_withdrawal, {bit('transaction_type_id = 4')} as is_transfer,
        {bit("channel = 'ATM'")} as is_atm, {bit("channel = 'Online'")} as is_online,
        {bit("channel = 'Mobile'")} as is_mobile, {bit("channel = 'Branch'")} as is_branch
    from {source})))
    """


CTES["featured"] = features("enriched")


def scored(source: str) -> str:
    return f"""
    select *, round(raw_score, 4) as fraud_score, raw_score >= 0.5 as is_fraud_predicted,
        round(abs(raw_score - 0.5) * 2, 4) as confidence_score,
        case when raw_score >= 0.8 then 'Critical' when raw_score >= 0.6 then 'High'
             when raw_score >= 0.4 then 'Medium' else 'Low' end as risk_indication,
        case when raw_score >= 0.8 then 'Block' when raw_score >= 0.6 then 'Flag'
             when raw_score >= 0.4 then 'Step-Up-Auth' else 'Pass' end as action_taken,
        case when not raw_score >= 0.5 then null
             when location_mismatch >= 2 then 'Account-Takeover'
             when is_online = 1 and is_high_value = 1 then 'Card-Not-Present'
             when is_atm = 1 and is_night_transaction = 1 then 'ATM-Skimming'
             when is_new_account = 1 and is_high_value = 1 then 'New-Account-Fraud'
             when is_dormant_account = 1 then 'Dormant-Account-Takeover'
             else 'Suspicious-Transaction' end as fraud_type
    from {source}
    """


CTES["timed"] = """
    select *, coalesce(transaction_date, timestamp '2024-02-01') + interval 5 second as processing_timestamp,
        greatest(0.0, least(1.0, cast(combined_risk_score as double) / 16.0)) as base_score from featured
"""
CTES["score_runs"] = """
    select * replace (processing_timestamp + to_seconds(60 * run) as processing_timestamp),
        greatest(0.0, least(1.0, base_score + 0.05 * run)) as raw_score,
        'tally-rules' as model_name,
        case when coalesce(transaction_date, timestamp '2024-02-01') < timestamp '2024-01-16' then 'v1' else 'v2' end as model_version
    from timed, (select unnest([0, 1]) as run) r
    where run = 0 or cast(transaction_id[2:] as bigint) % 6 = 0
"""
CTES["scored_runs"] = scored("score_runs")
CTES["stg_rt"] = """
    select * replace (upper(trim(currency)) as currency, trim(transaction_method) as transaction_method,
        cast(amount as decimal(18,2)) as amount, upper(trim(country)) as country, trim(city) as city,
        trim(account_type) as account_type) from timed
"""
CTES["stg_det"] = """
    select transaction_id, fraud_score, is_fraud_predicted, confidence_score, fraud_type, risk_indication,
        action_taken, 0.0 as inference_latency_ms, processing_timestamp, model_name, model_version,
        fraud_score >= 0.6 as is_review_required
    from scored_runs
"""

# ---- dimensions -------------------------------------------------------------------------
CTES["d_branch"] = f"select {key('branch_id')} as branch_key, * from stg_branch"
CTES["d_department"] = f"""
    select {key('department_id')} as department_key, department_id, department_name, manager_id as manager_key,
        coalesce(branch_key, '-1') as branch_key from stg_department left join d_branch using (branch_id)
"""
CTES["d_employee"] = f"""
    select {key('employee_id', 'e.scd2_hash', "date '2024-02-01'")} as employee_key, employee_id, first_name, last_name, full_name, email,
        phone_number, date_of_birth, hire_date, position, salary, coalesce(d.department_key, '-1') as department_key,
        coalesce(b.branch_key, '-1') as branch_key, supervisor_id as supervisor_key, e.scd2_hash,
        date '2024-02-01' as effective_date, cast(null as date) as expiry_date, true as is_current
    from stg_employee e left join d_department d using (department_id) left join d_branch b on e.branch_id = b.branch_id
"""
CTES["d_transaction_type"] = f"select {key('transaction_type_id')} as transaction_type_key, * from stg_transaction_type"
CTES["d_merchant"] = f"select {key('merchant_id')} as merchant_key, * from stg_merchant"
CTES["d_atm"] = f"""
    select {key('atm_id')} as atm_key, atm_id, location as location_name, a.street_address, a.city, a.state, a.country,
        a.postal_code, latitude, longitude, coalesce(branch_key, '-1') as branch_key, atm_type, manufacturer, model,
        max_withdrawal_amount, atm_status
    from stg_atm a left join d_branch b on a.branch_id = b.branch_id
"""
_AGE = "(2024 - year(date_of_birth))"
CTES["d_customer"] = f"""
    select {key('c.customer_id', 'scd2_hash', "date '2024-02-01'")} as customer_key, c.customer_id, first_name, last_name, full_name, email,
        date_of_birth, case when date_of_birth is null then 'Unknown' when {_AGE} < 18 then 'Under 18'
            when {_AGE} <= 25 then '18-25' when {_AGE} <= 35 then '26-35' when {_AGE} <= 45 then '36-45'
            when {_AGE} <= 55 then '46-55' when {_AGE} <= 65 then '56-65' else '65+' end as age_band,
        gender, marital_status, occupation, street_address, city, state, country, postal_code, customer_segment,
        id_type as ic_type, id_number, primary_phone, scd2_hash, date '2024-02-01' as effective_date,
        cast(null as date) as expiry_date, true as is_current
    from stg_customer c left join (select customer_id, min(phone_number) as primary_phone from stg_customer_phone
        where is_primary group by 1) p on c.customer_id = p.customer_id
"""
CTES["d_account"] = f"""
    select {key('account_number', 'a.scd2_hash', "date '2024-02-01'")} as account_key, account_number,
        coalesce(c.customer_key, '-1') as customer_key, coalesce(b.branch_key, '-1') as branch_key, account_type,
        account_status, currency, a.open_date, last_activity_date, interest_rate, minimum_balance, overdraft_limit,
        a.scd2_hash, date '2024-02-01' as effective_date, cast(null as date) as expiry_date, true as is_current
    from stg_account a left join d_customer c on a.customer_id = c.customer_id
    left join d_branch b on a.branch_id = b.branch_id
"""
CTES["d_card"] = f"""
    select {key('card_number_hashed')} as card_key, card_number_hashed, coalesce(account_key, '-1') as account_key,
        card_type, card_network, issue_date, card_expiry_date, card_holder_name, daily_withdrawal_limit,
        daily_purchase_limit, single_txn_limit, card_status
    from stg_card c left join d_account a on c.account_number = a.account_number
"""
CTES["d_model"] = f"""
    select {key('model_name', 'model_version')} as model_key, model_name, model_version from
    (select distinct model_name, model_version from stg_det where model_name is not null and model_version is not null)
"""
CTES["d_date"] = """
    select cast(strftime(d, '%Y%m%d') as integer) as date_key, cast(d as date) as full_date, year(d) as year,
        quarter(d) as quarter, month(d) as month, day(d) as day_of_month, isodow(d) as day_of_week,
        weekofyear(d) as week_of_year, dayofyear(d) as day_of_year, isodow(d) >= 6 as is_weekend,
        cast(date_trunc('month', d) as date) as month_start, cast(date_trunc('week', d) as date) as week_start,
        last_day(d) = cast(d as date) as is_month_end
    from (select unnest(generate_series(lo, hi, interval 1 day)) as d from
        (select cast(min(ts) as date) as lo, date '2024-02-29' as hi from events))
"""

# ---- facts ------------------------------------------------------------------------------
_COLS = """transaction_id, account_number, customer_id, merchant_id, atm_id, card_number_hashed, transaction_date,
    amount, currency, transaction_type_id, transaction_method, channel, city, state, country, latitude, longitude,
    is_international, transaction_hour, is_night_transaction"""
CTES["src_rt"] = f"""
    select {_COLS.replace('is_night_transaction', 'is_night_transaction = 1 as is_night_transaction')
            .replace('transaction_type_id', 'cast(transaction_type_id as varchar) as transaction_type_id')
            .replace(' latitude', ' cast(latitude as decimal(10,7)) as latitude')
            .replace(' longitude', ' cast(longitude as decimal(10,7)) as longitude')},
        processing_timestamp as load_ts, 1 as source_priority from stg_rt
"""
CTES["src_batch"] = f"""
    select {_COLS.replace('customer_id', 'a.customer_id')
            .replace('currency', 't.currency')
            .replace(' transaction_hour', ' hour(transaction_date) as transaction_hour')
            .replace('is_night_transaction', 'coalesce(hour(transaction_date) >= 22 or hour(transaction_date) < 6, false) as is_night_transaction')},
        transaction_date as load_ts, 2 as source_priority
    from stg_transaction t left join stg_account a using (account_number)
"""
CTES["all_sources"] = "select * from src_rt union all select * from src_batch"


def fact_transaction(source: str) -> str:
    return f"""
    select {key('t.transaction_id')} as transaction_fact_key, t.transaction_id, {dkey('transaction_date')} as date_key,
        coalesce(c.customer_key, '-1') as customer_key, coalesce(a.account_key, '-1') as account_key,
        coalesce(k.card_key, '-1') as card_key, coalesce(m.merchant_key, '-1') as merchant_key,
        coalesce(atm.atm_key, '-1') as atm_key, coalesce(a.branch_key, '-1') as branch_key,
        coalesce(ty.transaction_type_key, '-1') as transaction_type_key, amount, t.currency, transaction_method, channel,
        t.city, t.state, t.country, t.latitude, t.longitude, transaction_hour as hour_of_day, is_night_transaction,
        is_international as is_cross_border, cast(null as boolean) as is_fraud_confirmed,
        cast(null as integer) as fraud_label_date_key, cast(null as varchar) as fraud_label_source,
        transaction_date as transaction_timestamp
    from (select *, row_number() over (partition by transaction_id order by source_priority, load_ts desc) as rn
          from {source}) t
    left join d_customer c on t.customer_id = c.customer_id
    left join d_account a on t.account_number = a.account_number
    left join d_transaction_type ty on t.transaction_type_id = ty.transaction_type_id
    left join d_merchant m on t.merchant_id = m.merchant_id
    left join d_atm atm on t.atm_id = atm.atm_id
    left join d_card k on t.card_number_hashed = k.card_number_hashed
    where rn = 1
    """


CTES["f_txn"] = fact_transaction("all_sources")
CTES["latest_det"] = """
    select * from (select *, row_number() over (partition by transaction_id order by processing_timestamp desc) as rn
    from stg_det) where rn = 1
"""
CTES["f_det"] = f"""
    select d.transaction_id, cast(null as varchar) as result_id,
        coalesce(f.transaction_fact_key, '-1') as transaction_fact_key,
        {dkey('processing_timestamp')} as detection_date_key, coalesce(f.customer_key, '-1') as customer_key,
        coalesce(f.account_key, '-1') as account_key, coalesce(m.model_key, '-1') as model_key, fraud_score,
        is_fraud_predicted, confidence_score, fraud_type, risk_indication, action_taken, is_review_required,
        inference_latency_ms, processing_timestamp as detection_timestamp
    from latest_det d left join f_txn f on d.transaction_id = f.transaction_id
    left join d_model m on d.model_name = m.model_name and d.model_version = m.model_version
"""
CTES["activity"] = """
    select account_number, count(*) as txn_count, sum(case when amount > 0 then amount else 0 end) as total_credits,
        sum(case when amount < 0 then -amount else 0 end) as total_debits
    from stg_transaction group by account_number
"""
CTES["f_balance"] = f"""
    select {key('s.account_number', "date '2024-02-01'")} as snapshot_key, coalesce(a.account_key, '-1') as account_key,
        coalesce(c.customer_key, '-1') as customer_key, 20240201 as snapshot_date_key, balance, available_balance,
        s.currency, coalesce(total_debits, 0) as daily_debit_total, coalesce(total_credits, 0) as daily_credit_total,
        coalesce(txn_count, 0) as transaction_count
    from stg_account s left join d_customer c on s.customer_id = c.customer_id
    left join d_account a on s.account_number = a.account_number
    left join activity v on s.account_number = v.account_number
"""


def fact_loan(as_of: str) -> str:
    y, m = int(as_of[:4]), int(as_of[5:7])
    return f"""
    select {key('loan_id', f"date '{as_of}'")} as snapshot_key, loan_id, coalesce(c.customer_key, '-1') as customer_key,
        coalesce(b.branch_key, '-1') as branch_key, {as_of.replace('-', '')} as snapshot_date_key,
        {dkey('start_date', None)} as start_date_key, {dkey('end_date', None)} as end_date_key,
        {dkey('next_payment_date', None)} as next_payment_date_key, loan_type, account_number, loan_amount,
        outstanding_amount, interest_rate, loan_term_months,
        case when end_date is not null and start_date is not null
             then greatest(0, (year(end_date) - {y}) * 12 + month(end_date) - {m}) end as remaining_months,
        monthly_payment, 0 as days_past_due, false as is_delinquent
    from stg_loan l left join d_customer c on l.customer_id = c.customer_id
    left join d_branch b on l.branch_id = b.branch_id
    """


CTES["f_loan"] = fact_loan("2024-02-01")
CTES["f_loan_prior"] = fact_loan("2024-01-31")
CTES["f_alert"] = f"""
    select {key('d.transaction_id', 'model_key')} as alert_key, d.transaction_id, transaction_fact_key, customer_key,
        account_key, model_key, coalesce(employee_key, '-1') as employee_key, detection_date_key as alert_date_key,
        fraud_score, risk_indication, fraud_type, is_confirmed_fraud, resolution_minutes,
        case when is_confirmed_fraud is null then 'PENDING' else 'RESOLVED' end as alert_status
    from f_det d left join decision_rows r on d.transaction_id = r.transaction_id
    left join d_employee e on r.analyst_id = e.employee_id where fraud_score >= 0.6
"""
CTES["f_labelled"] = """
    select f.* replace (r.is_confirmed_fraud as is_fraud_confirmed,
        case when r.is_confirmed_fraud is not null then 20240201 end as fraud_label_date_key,
        case when r.is_confirmed_fraud is not null then 'ANALYST' end as fraud_label_source)
    from f_txn f left join decision_rows r on f.transaction_id = r.transaction_id
"""
CTES["label_rows"] = """
    select transaction_id, cast(is_fraud_confirmed as integer) as label from f_labelled where is_fraud_confirmed is not null
"""
CTES["snapshots"] = """
    select *, date '2023-12-31' as snapshot_date from stg_customer_b1
    union all select *, date '2024-01-15' as snapshot_date from stg_customer
"""
CTES["history"] = """
    select * exclude (snapshot_date, previous), snapshot_date as effective_date,
        lead(snapshot_date) over (partition by customer_id order by snapshot_date) - 1 as expiry_date,
        lead(snapshot_date) over (partition by customer_id order by snapshot_date) is null as is_current
    from (select *, lag(scd2_hash) over (partition by customer_id order by snapshot_date) as previous from snapshots)
    where previous is null or previous <> scd2_hash
"""
CTES["daily_balance"] = """
    select a.account_number, k.account_key, cast(strftime(d, '%Y%m%d') as integer) as snapshot_date_key,
        a.balance + sum(net) over (partition by a.account_number order by d) as balance
    from (select account_number, cast(transaction_date as date) as d, sum(amount) as net from stg_transaction
          where transaction_date is not null and amount is not null group by 1, 2) t
    join stg_account a using (account_number) join d_account k using (account_number)
"""
