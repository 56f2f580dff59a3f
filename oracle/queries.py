"""One DuckDB statement per named query."""

from __future__ import annotations

from oracle.build import day, days, dkey, flag, hashed, key, num, q, real, stamp, statement, whole
from oracle.models import CTES, fact_loan, features, scored

Q: dict[str, str] = {}

# ---- sources, sinks, filters ------------------------------------------------------------
Q["load_raw_transaction"] = q(
    "TransactionID AccountNumber TransactionDate Amount Currency TransactionTypeID TransactionMethod Channel "
    "TransactionStatus MerchantID ATMID City State Country Latitude Longitude IsInternational DeviceID DeviceType "
    "IPAddress CardNumber _BATCH_ID _LOAD_TS", "raw_transaction")
_KEYS = {
    "customer": "CustomerID", "customer_phone": "PhoneID", "account": "AccountNumber", "card": "CardNumber",
    "branch": "BranchID", "department": "DepartmentID", "employee": "EmployeeID",
    "transaction_type": "TransactionTypeID", "merchant": "MerchantID", "atm": "ATMID", "loan": "LoanID",
    "transaction": "TransactionID",
}
Q["load_summary"] = " union all ".join(f"""
    select '{n}' as table_name, count(distinct _BATCH_ID) as n_units, count(*) as n_rows,
        cast(count(*) filter (where trim({k}) = '') as bigint) as n_errors,
        case when count(*) = 0 or count(*) filter (where trim({k}) <> '') = 0 then 'FAILED'
             when count(*) filter (where trim({k}) = '') > 0 then 'PARTIAL' else 'SUCCESS' end as status
    from raw_{n}""" for n, k in _KEYS.items())
Q["load_totals"] = f"""
    select count(*) as n_tables, cast(sum(n_rows) as bigint) as n_rows, cast(sum(n_errors) as bigint) as n_errors,
        count(*) filter (where status = 'FAILED') as n_failed,
        coalesce(string_agg(table_name, ',' order by table_name) filter (where status = 'FAILED'), '') as failed_tables
    from ({Q["load_summary"]})
"""
Q["merge_keeps_labels"] = """
    select transaction_id, cast(amount * 2 as double) as amount, is_fraud_confirmed, fraud_label_date_key, fraud_label_source
    from f_labelled
"""
Q["refresh_twice"] = """
    select f.transaction_id, f.date_key, f.customer_key, cast(f.amount as double) as amount, f.is_night_transaction,
        case when f.transaction_id in (select transaction_id from stg_rt) then 1 else 2 end as source_priority,
        l.is_fraud_confirmed, l.fraud_label_date_key, l.fraud_label_source
    from f_txn f left join (select * from f_labelled where transaction_id in (select transaction_id from stg_transaction)) l
        on f.transaction_id = l.transaction_id
"""
CTES["three_loads"] = """
    select customer_id, city, scd2_hash, date '2023-12-31' as day from stg_customer_b1
    union all select customer_id, city, scd2_hash, date '2024-01-15' from stg_customer
    union all select customer_id, city, scd2_hash, date '2024-01-31' from stg_customer_b1
"""
Q["scd2_three_loads"] = f"""
    select customer_id, city, scd2_hash, {key('customer_id', 'scd2_hash', 'day')} as customer_key,
        strftime(day, '%Y-%m-%d') as effective_date,
        strftime(lead(day) over w - 1, '%Y-%m-%d') as expiry_date, lead(day) over w is null as is_current
    from (select *, lag(scd2_hash) over (partition by customer_id order by day) as before from three_loads)
    where before is null or before <> scd2_hash window w as (partition by customer_id order by day)
"""
Q["labelled_transactions"] = q("transaction_id label", "label_rows")
Q["detections_split"] = """
    select transaction_id as TransactionID, fraud_score, is_fraud_predicted, confidence_score, fraud_type,
        risk_indication, action_taken, 0.0::double as inference_latency_ms,
        strftime(processing_timestamp, '%Y-%m-%d %H:%M:%S.%f') as processing_timestamp, model_name, model_version,
        is_review_required from stg_det
"""
Q["etl_metadata"] = """
    select TransactionID, AccountNumber, Amount, Channel, _LOAD_TS as SentAt, 'B9' as _BATCH_ID,
        'CORE' as _SOURCE_SYSTEM, '2024-02-01 00:00:00' as _LOAD_TS,
        sha256(concat_ws('|', coalesce(TransactionID, '\\N'), coalesce(AccountNumber, '\\N'), coalesce(Amount, '\\N'),
            coalesce(Channel, '\\N'), coalesce(_LOAD_TS, '\\N'))) as _ROW_HASH
    from raw_transaction
"""
Q["merge_upsert"] = """
    select transaction_id, cast(amount as double) as amount, channel, source_priority from src_rt
    union all
    select transaction_id, cast(amount as double), channel, source_priority from src_batch b
    where not exists (select 1 from src_rt r where r.transaction_id = b.transaction_id)
"""
Q["register_model"] = """
    select model_name, model_version, false as is_active, cast(null as varchar) as algorithm,
        cast(null as varchar) as training_date, cast(null as double) as threshold_score, cast(null as double) as auc_roc
    from d_model union all
    select 'tally-rules', 'v3', true, 'Rules', '2024-02-01', 0.5, 0.5
"""
Q["cdc_filter"] = """
    select coalesce(op, 'none') as op, count(*) as n_rows, coalesce(op, 'none') in ('none', 'c', 'u') as is_kept
    from cdc_parsed group by 1
"""
Q["cdc_parse"] = """
    select 'parsed' as outcome, count(*) as n_rows from events where event_id % 499 <> 7
    union all select 'quarantined', count(*) from events where event_id % 499 = 7
"""
Q["incremental_since"] = q(
    "transaction_id processing_timestamp#t model_version fraud_score", "stg_det",
    "where processing_timestamp > (select coalesce(max(processing_timestamp), timestamp '1970-01-01') "
    "from stg_det where model_version = 'v1')")

# ---- staging ----------------------------------------------------------------------------
Q["stg_customer"] = q(
    "customer_id first_name last_name full_name email date_of_birth#y gender marital_status occupation street_address "
    "city state country postal_code customer_since#y customer_segment id_type id_number tax_id scd2_hash", "stg_customer")
Q["stg_customer_phone"] = "select * from stg_customer_phone"
Q["stg_account"] = q(
    "account_number customer_id account_type branch_id balance#d available_balance#d currency open_date#y "
    "last_activity_date#y interest_rate#d minimum_balance#d overdraft_limit#d account_status created_date#t "
    "modified_date#t scd2_hash", "stg_account")
Q["stg_card"] = q(
    "card_number_hashed account_number card_type card_network issue_date#y card_expiry_date#y card_holder_name "
    "daily_withdrawal_limit#d daily_purchase_limit#d single_txn_limit#d card_status", "stg_card")
Q["stg_branch"] = q("branch_id branch_name branch_location city state country postal_code open_date#y branch_type", "stg_branch")
Q["stg_department"] = "select * from stg_department"
Q["stg_employee"] = q(
    "employee_id first_name last_name full_name email phone_number date_of_birth#y hire_date#y position salary#d "
    "department_id branch_id supervisor_id scd2_hash", "stg_employee")
Q["stg_transaction_type"] = "select * from stg_transaction_type"
Q["stg_merchant"] = "select * from stg_merchant"
Q["stg_atm"] = q(
    "atm_id location street_address city state country postal_code latitude#d longitude#d branch_id atm_type "
    "manufacturer model max_withdrawal_amount#d current_cash_level#d atm_status installation_date#y "
    "last_maintenance_date#y", "stg_atm")
Q["stg_loan"] = q(
    "loan_id customer_id account_number branch_id loan_type loan_amount#d outstanding_amount#d interest_rate#d "
    "loan_term_months start_date#y end_date#y next_payment_date#y monthly_payment#d loan_status repayment_pct#d", "stg_loan")
Q["stg_transaction"] = q(
    "transaction_id account_number transaction_date#t amount#d currency transaction_type_id transaction_method channel "
    "merchant_id atm_id city state country latitude#d longitude#d is_international device_id device_type ip_address "
    "card_number_hashed date_key", "stg_transaction")
_RT_FLAGS = ("is_weekend is_night_transaction is_high_value below_minimum_balance is_home_city is_home_country "
             "is_new_account is_dormant_account is_new_customer is_active_account is_active_customer is_withdrawal "
             "is_transfer is_purchase is_deposit is_atm is_online is_mobile is_branch is_high_velocity "
             "is_unusual_amount").split()
Q["stg_realtime_transaction"] = "select " + ", ".join(f"{f} = 1 as {f}" for f in _RT_FLAGS) + ", " + q(
    "transaction_id account_number customer_id merchant_id atm_id branch_id card_number_hashed transaction_date#t "
    "amount#d currency transaction_method channel transaction_status city state country latitude#d longitude#d "
    "is_international device_id device_type ip_address customer_segment customer_city customer_country account_type "
    "account_status current_balance#d available_balance#d transaction_hour transaction_day_of_week "
    "amount_to_balance_ratio#d amount_to_available_ratio#d balance_utilization#d location_mismatch account_age_days "
    "days_since_last_activity customer_age_days customer_tenure_days risk_score_base#d combined_risk_score#d "
    "transactions_last_1h transactions_last_24h amount_last_1h#d amount_last_24h#d avg_amount_24h#d "
    "processing_timestamp#t", "stg_rt").removeprefix("select ").replace(
        "transaction_method, channel", "cast(transaction_type_id as varchar) as transaction_type_id, transaction_method, channel").replace(
        " from stg_rt", ", '2024-02-01 00:00:00' as load_timestamp, 'stream' as source_file from stg_rt")
Q["stg_realtime_fraud_detection"] = q(
    "transaction_id fraud_score is_fraud_predicted confidence_score fraud_type risk_indication action_taken "
    "inference_latency_ms#d processing_timestamp#t model_name model_version is_review_required", "stg_det").replace(
    " from stg_det", ", '2024-02-01 00:00:00' as load_timestamp, 'stream' as source_file from stg_det")

# ---- joins ------------------------------------------------------------------------------
CTES["still_account"] = "select t.*, a.* exclude (account_number) from live_txn t left join live_account a using (account_number)"
Q["enrich_account"] = q(
    "transaction_id account_number customer_id event_customer_id account_type account_status current_balance#d "
    "available_balance#d account_open_date#t last_activity_date#t branch_id account_currency interest_rate#d "
    "minimum_balance#d overdraft_limit#d", "still_account")
Q["enrich_customer"] = q(
    "transaction_id customer_id customer_first_name customer_last_name customer_email customer_dob customer_gender "
    "customer_occupation customer_city customer_state customer_country customer_segment customer_since#t "
    "customer_is_active customer_created_date#t", "enriched")
Q["two_tier_lookup"] = """
    select t.transaction_id, t.account_number,
        case when f.account_number is not null then f.account_status else a.account_status end as account_status,
        cast(case when f.account_number is not null then f.balance else a.balance end as double) as balance,
        case when f.account_number is not null then 'fresh' when a.account_number is not null then 'base' else 'miss' end as lookup_tier
    from stg_transaction t
    left join (select * from stg_account where account_status = 'Dormant') f on t.account_number = f.account_number
    left join stg_account_b1 a on t.account_number = a.account_number
"""
Q["training_base"] = """
    select transaction_id, t.account_number, t.customer_id, cast(amount as double) as amount,
        strftime(transaction_date, '%Y-%m-%d %H:%M:%S.%f') as transaction_date,
        cast(current_balance as double) as current_balance, account_status, customer_segment, customer_city,
        strftime(customer_since, '%Y-%m-%d %H:%M:%S.%f') as customer_since
    from still_account t left join live_customer c on t.customer_id = c.customer_id
"""
Q["scd2_changes"] = """
    select s.customer_id, s.city, s.occupation, s.scd2_hash from stg_customer s
    left join stg_customer_b1 e on s.customer_id = e.customer_id
    where e.customer_id is null or e.scd2_hash <> s.scd2_hash
"""
Q["point_in_time_join"] = """
    select t.transaction_id, t.customer_id, strftime(t.transaction_date, '%Y-%m-%d %H:%M:%S.%f') as transaction_date,
        h.city, strftime(h.effective_date, '%Y-%m-%d') as effective_date
    from still_account t left join history h on t.customer_id = h.customer_id
        and cast(t.transaction_date as date) >= h.effective_date
        and cast(t.transaction_date as date) <= coalesce(h.expiry_date, date '9999-12-31')
    where t.transaction_date is not null
"""
ML = ("amount transaction_hour transaction_day_of_week is_weekend is_night_transaction amount_to_balance_ratio "
      "amount_to_available_ratio is_high_value balance_utilization below_minimum_balance is_home_city is_home_country "
      "location_mismatch is_new_account is_dormant_account customer_age_days customer_tenure_days is_new_customer "
      "is_active_account is_active_customer is_withdrawal is_transfer is_purchase is_deposit is_atm is_online is_mobile "
      "is_branch risk_score_base combined_risk_score account_age_days days_since_last_activity transactions_last_1h "
      "transactions_last_24h amount_last_1h amount_last_24h avg_amount_24h is_high_velocity is_unusual_amount")
_VECTOR = " ".join(f"{c}#d" for c in ML.split())
Q["feature_matrix"] = q(f"transaction_id {_VECTOR}", "featured")
Q["training_labelled"] = q(f"transaction_id {_VECTOR} label", "(select f.*, label from featured f join label_rows using (transaction_id))")

# ---- aggregates and metrics -------------------------------------------------------------
Q["account_activity"] = q("account_number txn_count total_credits#d total_debits#d", "activity")
Q["label_count"] = "select count(*) as n_labels from label_rows"
Q["velocity_quality"] = """
    select count(*) as n_rows, count(*) filter (where transactions_last_1h <> transactions_last_24h) as n_different,
        round(count(*) filter (where transactions_last_1h <> transactions_last_24h) / count(*), 6) as share_different
    from txn_velocity
"""
Q["class_balance"] = """
    select label, count(*) as n_rows, round(count(*) / (select count(*) from label_rows), 6) as share
    from label_rows group by label
"""
CTES["judged"] = """
    select fraud_score, cast(is_fraud_predicted as integer) as prediction, cast(is_confirmed_fraud as integer) as label
    from latest_det join decision_rows using (transaction_id) where is_confirmed_fraud is not null
"""
Q["classification_report"] = """
    select c.label, round(case when predicted > 0 then tp / predicted else 0 end, 6) as precision,
        round(case when support > 0 then tp / support else 0 end, 6) as recall,
        round(case when predicted + support > 0 then 2.0::double * tp / (predicted + support) else 0 end, 6) as f1_score, support
    from (select distinct label from judged union select distinct prediction from judged) c,
        lateral (select count(*) filter (where j.label = c.label and prediction = c.label) as tp,
                        count(*) filter (where j.label = c.label) as support,
                        count(*) filter (where prediction = c.label) as predicted from judged j) x
"""
Q["auc_roc"] = """
    select cast(pos as bigint) as n_positive, cast(neg as bigint) as n_negative,
        round(cast((rank_sum - pos * (pos + 1) / 2) / (pos * neg) as double), 6) as auc_roc
    from (select sum(label)::double as pos, sum(1 - label)::double as neg, sum(case when label = 1 then mid end) as rank_sum
          from (select label, rank() over (order by fraud_score) + (count(*) over (partition by fraud_score) - 1) / 2.0::double as mid
                from judged))
"""
Q["dimension_health"] = """
    select 'account' as dimension, count(*) as n_rows, count(*) = 0 as is_empty from live_account
    union all select 'customer', count(*), count(*) = 0 from live_customer
    union all select 'closed_account', count(*), count(*) = 0 from live_account where account_status = 'Closed'
"""

# ---- windows ----------------------------------------------------------------------------
Q["dedup_latest"] = """
    select TransactionID, _LOAD_TS, Amount from raw_transaction r where trim(TransactionID) <> '' and _LOAD_TS =
        (select max(_LOAD_TS) from raw_transaction s where s.TransactionID = r.TransactionID)
"""
Q["dedup_priority"] = """
    select transaction_id, source_priority, strftime(load_ts, '%Y-%m-%d %H:%M:%S.%f') as load_ts, cast(amount as double) as amount
    from (select *, row_number() over (partition by transaction_id order by source_priority, load_ts desc) as rn from all_sources)
    where rn = 1
"""
Q["dedup_latest_detection"] = q("transaction_id processing_timestamp#t fraud_score model_version", "latest_det")
_FIGURES = "transactions_last_1h transactions_last_24h amount_last_1h#d amount_last_24h#d avg_amount_24h#d"
Q["velocity_1h_24h"] = q(f"transaction_id account_number transaction_date#t amount#d {_FIGURES}", "txn_velocity")
Q["velocity_microbatches"] = q(f"transaction_id account_number transaction_date#t amount#d {_FIGURES}", "txn_velocity",
                               "where transaction_date is not null")
Q["velocity_defaults"] = """
    select transaction_id, cast(amount as double) as amount, 1 as transactions_last_1h, 1 as transactions_last_24h,
        cast(amount as double) as amount_last_1h, cast(amount as double) as amount_last_24h,
        cast(amount as double) as avg_amount_24h
    from live_txn where coalesce(trim(account_number), '') = ''
"""
_HISTORY = ("customer_id first_name last_name full_name email date_of_birth#y gender marital_status occupation "
            "street_address city state country postal_code customer_since#y customer_segment id_type id_number tax_id "
            "scd2_hash effective_date#y expiry_date#y is_current")
Q["scd2_history"] = q(_HISTORY, "history")
Q["scd2_apply"] = q(_HISTORY, """(
    select s.*, date '2023-12-31' as effective_date,
        case when n.scd2_hash <> s.scd2_hash then date '2024-01-14' end as expiry_date,
        not coalesce(n.scd2_hash <> s.scd2_hash, false) as is_current
    from stg_customer_b1 s left join stg_customer n on s.customer_id = n.customer_id
    union all
    select n.*, date '2024-01-15', null, true from stg_customer n left join stg_customer_b1 s on s.customer_id = n.customer_id
    where s.customer_id is null or n.scd2_hash <> s.scd2_hash)""")
Q["union_sources"] = q(
    "transaction_id account_number customer_id amount#d transaction_hour is_night_transaction load_ts#t source_priority",
    "all_sources")

# ---- scalar suites ----------------------------------------------------------------------
_OPEN = day("OpenDate")
_AGE = f"(2024 - year({_OPEN}))"
Q["scalar_suite"] = f"""
    select trim(AccountNumber) as account_number, _LOAD_TS as load_ts, upper(trim(Currency)) as currency,
        nullif(trim(AccountNumber), '') as key_or_null, trim(AccountType) || ' ' || trim(OverdraftLimit) as joined,
        cast({num('Balance')} as double) as balance, {whole('Balance')} as whole_balance, {real('Balance')} as real_balance,
        strftime({_OPEN}, '%Y-%m-%d') as open_date,
        strftime(try_cast(trim(LastActivityDate) as date), '%Y-%m-%d') as last_activity,
        strftime({stamp('ModifiedDate')}, '%Y-%m-%d %H:%M:%S.%f') as modified, {flag('OverdraftLimit')} as has_flag,
        sha256(nullif(trim(AccountNumber), '')) as sha, {hashed('AccountType', 'OverdraftLimit')} as md5,
        {key('AccountNumber', 'OverdraftLimit')} as surrogate, {dkey(_OPEN)} as date_key,
        hour({stamp('CreatedDate')}) as hour, 2024 - year({_OPEN}) as years,
        (2024 - year({_OPEN})) * 12 + 2 - month({_OPEN}) as months,
        case when {_OPEN} is null then 'Unknown' when {_AGE} < 18 then 'Under 18' else '18+' end as band,
        cast(abs({num('Balance')}) as double) as abs_balance, AccountType like '%ing%' as is_like,
        coalesce(OverdraftLimit, '0') as or_zero, coalesce({real('Balance')}, 0.0) as safe_real,
        coalesce(cast(trunc({real('Balance')}) as integer), 0) as safe_whole
    from raw_account where _BATCH_ID = 'B2'
"""
Q["parse_datetime_suite"] = f"""
    select event_id, sent, strftime(parsed, '%Y-%m-%d %H:%M:%S.%f') as parsed,
        {days('parsed', "timestamp '2024-01-15 12:00:00'")} as days_off, isodow(parsed) as weekday,
        greatest(0.0::double, least(1.0::double, (event_id % 40) / 20 - 0.5)) as clamped
    from (select event_id,
        case event_id % 12 when 0 then cast(epoch_us(ts) * 1000 as varchar) when 1 then cast(epoch_us(ts) as varchar)
            when 2 then cast(epoch_us(ts) // 1000 as varchar) when 3 then cast(epoch_us(ts) // 1000000 as varchar)
            when 4 then strftime(ts, '%Y-%m-%dT%H:%M:%S') when 5 then strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
            when 6 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 7 then strftime(ts, '%Y-%m-%dT%H:%M:%S+02:00')
            when 8 then strftime(ts, '%Y-%m-%d') when 9 then strftime(ts, ' %Y-%m-%dT%H:%M:%S ')
            when 10 then '999' else 'soon' end as sent,
        case when event_id % 12 in (0, 1, 5) then ts when event_id % 12 = 2 then date_trunc('millisecond', ts)
            when event_id % 12 in (3, 4, 6, 7, 9) then date_trunc('second', ts)
            when event_id % 12 = 8 then date_trunc('day', ts) end as parsed
        from events)
"""

# ---- features ---------------------------------------------------------------------------
Q["features_time"] = q("transaction_id transaction_hour transaction_day_of_week is_weekend is_night_transaction", "featured")
Q["features_amount"] = q(
    "transaction_id amount_to_balance_ratio#d amount_to_available_ratio#d amount_change#d is_high_value "
    "balance_utilization#d below_minimum_balance", "featured")
Q["features_location"] = q("transaction_id is_home_city is_home_country location_mismatch", "featured")
Q["features_account"] = q(
    "transaction_id account_age_days is_new_account days_since_last_activity is_dormant_account is_active_account "
    "is_active_customer", "featured")
Q["features_customer"] = q("transaction_id customer_age_days customer_tenure_days is_new_customer", "featured")
Q["features_type_channel"] = q(
    "transaction_id is_deposit is_purchase is_withdrawal is_transfer is_atm is_online is_mobile is_branch", "featured")
Q["features_risk"] = q("transaction_id risk_score_base segment_risk_adjustment combined_risk_score", "featured")
Q["features_velocity"] = q("transaction_id is_high_velocity is_unusual_amount", "featured")
Q["features_all"] = q(
    "customer_id account_number transaction_id merchant_id atm_id card_number_hashed transaction_date#t amount#d currency "
    "transaction_type_id transaction_method channel transaction_status city state country latitude#d longitude#d "
    "is_international device_id device_type ip_address balance_before#d balance_after#d account_type account_status "
    "current_balance#d available_balance#d account_open_date#t last_activity_date#t branch_id account_currency "
    "interest_rate#d minimum_balance#d overdraft_limit#d customer_first_name customer_last_name customer_email "
    "customer_dob customer_gender customer_occupation customer_city customer_state customer_country customer_segment "
    "customer_since#t customer_is_active customer_created_date#t "
    f"{_FIGURES} transaction_hour transaction_day_of_week is_weekend is_night_transaction amount_to_balance_ratio#d "
    "amount_to_available_ratio#d amount_change#d is_high_value balance_utilization#d below_minimum_balance is_home_city "
    "is_home_country location_mismatch account_age_days is_new_account days_since_last_activity is_dormant_account "
    "is_active_account is_active_customer customer_age_days customer_tenure_days is_new_customer is_deposit is_purchase "
    "is_withdrawal is_transfer is_atm is_online is_mobile is_branch risk_score_base segment_risk_adjustment "
    "combined_risk_score is_high_velocity is_unusual_amount", "featured")

# ---- scores -----------------------------------------------------------------------------
Q["score_defaults"] = """
    select transaction_id, 0.0::double as fraud_score, false as is_fraud_predicted, 0.0::double as confidence_score,
        cast(null as varchar) as fraud_type, 'Low' as risk_indication, 'Pass' as action_taken from live_txn
"""
Q["risk_bands"] = q("transaction_id run fraud_score#d confidence_score#d risk_indication action_taken", "scored_runs")
Q["fraud_type"] = q("transaction_id run is_fraud_predicted fraud_type", "scored_runs")

# ---- dimensions and facts ---------------------------------------------------------------
Q["dim_branch"] = q("branch_key branch_id branch_name branch_location city state country postal_code open_date#y branch_type", "d_branch")
Q["dim_department"] = "select * from d_department"
Q["dim_employee"] = q(
    "employee_key employee_id first_name last_name full_name email phone_number date_of_birth#y hire_date#y position "
    "salary#d department_key branch_key supervisor_key scd2_hash effective_date#y expiry_date#y is_current", "d_employee")
Q["dim_transaction_type"] = "select * from d_transaction_type"
Q["dim_merchant"] = "select * from d_merchant"
Q["dim_atm"] = q(
    "atm_key atm_id location_name street_address city state country postal_code latitude#d longitude#d branch_key "
    "atm_type manufacturer model max_withdrawal_amount#d atm_status", "d_atm")
Q["dim_customer"] = q(
    "customer_key customer_id first_name last_name full_name email date_of_birth#y age_band gender marital_status "
    "occupation street_address city state country postal_code customer_segment ic_type id_number primary_phone scd2_hash "
    "effective_date#y expiry_date#y is_current", "d_customer")
Q["dim_account"] = q(
    "account_key account_number customer_key branch_key account_type account_status currency open_date#y "
    "last_activity_date#y interest_rate#d minimum_balance#d overdraft_limit#d scd2_hash effective_date#y expiry_date#y "
    "is_current", "d_account")
Q["dim_card"] = q(
    "card_key card_number_hashed account_key card_type card_network issue_date#y card_expiry_date#y card_holder_name "
    "daily_withdrawal_limit#d daily_purchase_limit#d single_txn_limit#d card_status", "d_card")
Q["dim_fraud_model"] = "select model_key, model_name, model_version, true as is_active from d_model"
Q["dim_date"] = q(
    "date_key full_date#y year quarter month day_of_month day_of_week week_of_year day_of_year is_weekend month_start#y "
    "week_start#y is_month_end", "d_date")
Q["fact_transaction"] = q(
    "transaction_fact_key transaction_id date_key customer_key account_key card_key merchant_key atm_key branch_key "
    "transaction_type_key amount#d currency transaction_method channel city state country latitude#d longitude#d "
    "hour_of_day is_night_transaction is_cross_border is_fraud_confirmed fraud_label_date_key fraud_label_source "
    "transaction_timestamp#t", "f_txn")
Q["fact_fraud_detection"] = q(
    "transaction_id result_id transaction_fact_key detection_date_key customer_key account_key model_key fraud_score#d "
    "is_fraud_predicted confidence_score#d fraud_type risk_indication action_taken is_review_required "
    "inference_latency_ms#d detection_timestamp#t", "f_det")
Q["fact_account_balance_snapshot"] = q(
    "snapshot_key account_key customer_key snapshot_date_key balance#d available_balance#d currency daily_debit_total#d "
    "daily_credit_total#d transaction_count", "f_balance")
_LOAN = ("snapshot_key loan_id customer_key branch_key snapshot_date_key start_date_key end_date_key "
         "next_payment_date_key loan_type account_number loan_amount#d outstanding_amount#d interest_rate#d "
         "loan_term_months remaining_months monthly_payment#d days_past_due is_delinquent")
Q["fact_loan_snapshot"] = q(_LOAN, "f_loan")
Q["fact_fraud_alert"] = q(
    "alert_key transaction_id transaction_fact_key customer_key account_key model_key employee_key alert_date_key "
    "fraud_score#d risk_indication fraud_type is_confirmed_fraud resolution_minutes alert_status", "f_alert")
Q["label_writeback"] = q("transaction_id is_fraud_confirmed fraud_label_date_key fraud_label_source", "f_labelled")
Q["fact_transaction_usd"] = """
    select transaction_id, f.currency, cast(amount as double) as amount,
        cast(cast(sign(units) * ((2 * abs(units) + 10000) // 20000) as decimal(18,2)) * 0.01 as double) as amount_usd
    from (select *, cast(amount * 100 as bigint) * case when transaction_timestamp is null then null when currency = 'USD' then 10000
                 when currency = 'EUR' then 10000 + 10 * day(transaction_timestamp) end as units
          from f_txn) f
"""

# ---- quality ----------------------------------------------------------------------------
_C = {n: f"(2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1.0) / {n})" for n in (3, 6, 10, 12, 16)}
CTES["fixed_scores"] = f"""
    select transaction_id, -power(2.0, -((case when a <= 200 then 1 + {_C[12]} when r <= 6 then 2 + {_C[3]} else 2 end)
        + (case when t <= 5 then 1 + {_C[10]} else 1 + {_C[6]} end)) / 2 / {_C[16]}) + 0.5 as decision
    from (select transaction_id, coalesce(cast(amount as double), 0) as a, coalesce(cast(combined_risk_score as double), 0) as r,
              coalesce(cast(transactions_last_24h as double), 0) as t from featured)
"""
Q["score_fixed_iforest"] = """
    select transaction_id, round(greatest(0.0, least(1.0, 0.5 - decision)), 6) as raw_score, decision < 0 as is_outlier
    from fixed_scores
"""
Q["anomaly_summary_fixed"] = """
    select count(*) as n_rows, count(*) filter (where decision < 0) as n_anomalies,
        round(count(*) filter (where decision < 0) / count(*), 6) as share from fixed_scores
"""
CTES["forest_rows"] = """
    select *, case when r > 4 then 2 when a <= 150 then 3 else 4 end as leaf_a, case when t <= 3 then 1 when a <= 400 then 3 else 4 end as leaf_b
    from (select *, coalesce(cast(amount as double), 0) as a, coalesce(cast(combined_risk_score as double), 0) as r,
              coalesce(cast(transactions_last_24h as double), 0) as t from featured)
"""
CTES["forest_labelled"] = "select a, r, t, leaf_a, leaf_b, label from forest_rows join label_rows using (transaction_id)"
CTES["forest_scores"] = """
    select f.*, (coalesce(x.share, 0) + coalesce(y.share, 0)) / 2.0::double as raw_score from forest_rows f
    left join (select leaf_a, sum(label)::double / count(*) as share from forest_labelled group by 1) x using (leaf_a)
    left join (select leaf_b, sum(label)::double / count(*) as share from forest_labelled group by 1) y using (leaf_b)
"""
CTES["forest_runs"] = scored("forest_scores")
Q["score_fixed_forest"] = q(
    "transaction_id fraud_score#d is_fraud_predicted confidence_score#d fraud_type risk_indication action_taken", "forest_runs")


def _loss(rows: str) -> str:
    """Weighted Gini impurity of the labelled rows under a condition."""
    n, bad = f"count(*) filter (where {rows})", f"coalesce(sum(label) filter (where {rows}), 0)"
    return f"coalesce(2.0::double * {bad} * ({n} - {bad}) / nullif({n}, 0), 0)"


def _gain(rows: str, split: str) -> str:
    return f"{_loss(rows)} - {_loss(f'{rows} and {split}')} - {_loss(f'{rows} and not {split}')}"


Q["top_features_fixed"] = f"""
    select feature, round(coalesce(sum(share), 0) / (select count(distinct tree) from gains where total > 0), 6) as importance
    from (select tree, feature, case when total > 0 then gain / total end as share from gains) group by feature
"""
CTES["gains"] = f"""
    select *, sum(gain) over (partition by tree) as total from (
        select 0 as tree, 'combined_risk_score' as feature, {_gain('true', '(r <= 4)')} as gain from forest_labelled
        union all select 0, 'amount', {_gain('r <= 4', '(a <= 150)')} from forest_labelled
        union all select 1, 'transactions_last_24h', {_gain('true', '(t <= 3)')} from forest_labelled
        union all select 1, 'amount', {_gain('t > 3', '(a <= 400)')} from forest_labelled)
"""
Q["dq_not_null"] = "select transaction_id, account_number from stg_transaction where amount is null"
Q["dq_unique"] = "select TransactionID, count(*) as n_rows from raw_transaction where TransactionID is not null group by 1 having count(*) > 1"
Q["dq_accepted_values"] = """
    select channel, count(*) as n_rows from stg_transaction where channel is not null
        and channel not in ('ATM', 'Online', 'Mobile', 'Branch') group by 1
"""
Q["dq_relationships"] = """
    select merchant_id as fk_value, count(*) as n_rows from stg_transaction t where merchant_id is not null
        and not exists (select 1 from stg_merchant m where m.merchant_id = t.merchant_id) group by 1
"""
_TESTED = {
    "stg_branch": "branch_id", "stg_department": "department_id", "stg_employee": "employee_id",
    "stg_transaction_type": "transaction_type_id", "stg_merchant": "merchant_id", "stg_atm": "atm_id",
    "stg_customer": "customer_id", "stg_account": "account_number", "stg_card": "card_number_hashed",
    "stg_transaction": "transaction_id", "stg_loan": "loan_id", "dim_branch": "branch_key",
    "dim_department": "department_key", "dim_employee": "employee_key",
    "dim_transaction_type": "transaction_type_key", "dim_merchant": "merchant_key", "dim_atm": "atm_key",
    "dim_customer": "customer_key", "dim_account": "account_key", "dim_card": "card_key",
    "dim_fraud_model": "model_key", "fact_transaction": "transaction_id", "fact_fraud_detection": "transaction_id",
    "fact_loan_snapshot": "snapshot_key", "fact_account_balance_snapshot": "snapshot_key",
}
_SOURCES = {
    "dim_fraud_model": "d_model", "fact_transaction": "f_txn", "fact_fraud_detection": "f_det",
    "fact_loan_snapshot": "f_loan", "fact_account_balance_snapshot": "f_balance",
    "stg_realtime_transaction": "stg_rt", "stg_realtime_fraud_detection": "stg_det",
}
_FILLED = [
    ("stg_transaction", "amount"), ("dim_branch", "branch_id"), ("fact_transaction", "amount"),
    ("fact_fraud_detection", "fraud_score"), ("fact_loan_snapshot", "loan_id"),
    ("fact_account_balance_snapshot", "account_key"), ("stg_realtime_transaction", "transaction_id"),
    ("stg_realtime_transaction", "amount"), ("stg_realtime_fraud_detection", "transaction_id"),
    ("stg_realtime_fraud_detection", "fraud_score"),
]
_LISTED = [
    ("stg_loan", "loan_status", "'PAID_OFF', 'OVERDUE', 'ACTIVE'"),
    ("fact_fraud_detection", "risk_indication", "'Low', 'Medium', 'High', 'Critical'"),
    ("fact_fraud_detection", "action_taken", "'Pass', 'Step-Up-Auth', 'Flag', 'Block'"),
]
_LINKED = [
    ("fact_transaction", "customer_key", "d_customer"), ("fact_transaction", "account_key", "d_account"),
    ("fact_transaction", "merchant_key", "d_merchant"), ("fact_transaction", "atm_key", "d_atm"),
    ("fact_fraud_detection", "model_key", "d_model"),
]


def _test(model: str, column: str, kind: str) -> str:
    source = _SOURCES.get(model, model.replace("dim_", "d_", 1) if model.startswith("dim_") else model)
    failing = (f"(select count(*) from {source} where {column} is null)" if kind == "not_null" else
               f"(select count(*) from (select {column} from {source} where {column} is not null "
               f"group by 1 having count(*) > 1))")
    return (f"select '{model}' as model, '{column}' as column_name, '{kind}' as test, {failing} as n_failures, "
            f"{failing} = 0 as passed")


Q["dq_report"] = " union all ".join(
    [_test(m, c, k) for m, c in _TESTED.items() for k in ("not_null", "unique")]
    + [_test(m, c, "not_null") for m, c in _FILLED]
    + [f"select '{m}', '{c}', 'accepted_values', count(distinct {c}), count(*) = 0 from {_SOURCES.get(m, m)} "
       f"where {c} not in ({values})" for m, c, values in _LISTED]
    + [f"select '{m}', '{c}', 'relationships', count(distinct {c}), count(*) = 0 from {_SOURCES[m]} "
       f"where {c} <> '-1' and {c} not in (select {c} from {parent})" for m, c, parent in _LINKED])

# ---- analytics --------------------------------------------------------------------------
Q["model_precision_recall"] = """
    select model_name, model_version, n_scored, n_labelled, tp as true_positives, fp as false_positives, fn as false_negatives,
        round(case when tp + fp > 0 then tp / (tp + fp) end, 6) as precision,
        round(case when tp + fn > 0 then tp / (tp + fn) end, 6) as recall
    from (select d.model_key, count(*) as n_scored, count(a.is_confirmed_fraud) as n_labelled,
            count(*) filter (where d.is_fraud_predicted and a.is_confirmed_fraud) as tp,
            count(*) filter (where d.is_fraud_predicted and not a.is_confirmed_fraud) as fp,
            count(*) filter (where not d.is_fraud_predicted and a.is_confirmed_fraud) as fn
          from f_det d left join f_alert a on d.transaction_id = a.transaction_id and d.model_key = a.model_key
          group by 1) left join d_model using (model_key)
"""
Q["fpr_by_merchant_category"] = """
    select coalesce(m.merchant_category, 'Unknown') as merchant_category, count(*) as n_decided,
        count(*) filter (where not a.is_confirmed_fraud) as n_false_positive,
        round(count(*) filter (where not a.is_confirmed_fraud) / count(*), 6) as false_positive_rate
    from f_alert a left join f_txn f using (transaction_fact_key) left join d_merchant m using (merchant_key)
    where a.is_confirmed_fraud is not null group by 1
"""
Q["customer_risk_trend"] = """
    select t.customer_key, c.customer_id, c.customer_segment, strftime(period_start, '%Y-%m-%d') as period_start, n_scored,
        avg_score, max_score, previous_avg_score, round(avg_score - previous_avg_score, 6) as score_change
    from (select *, lag(avg_score) over (partition by customer_key, period_start is null order by period_start) as previous_avg_score
          from (select customer_key, week_start as period_start, count(*) as n_scored,
                    round(cast(sum(cast(fraud_score as decimal(10,4))) as double) / count(*), 6) as avg_score,
                    max(fraud_score) as max_score
                from f_det left join d_date on detection_date_key = date_key group by 1, 2)) t
    left join d_customer c on t.customer_key = c.customer_key
"""
Q["alert_sla"] = """
    select a.employee_key, e.employee_id, e.full_name, year, month, count(*) as n_resolved,
        count(*) filter (where resolution_minutes <= 240) as n_within_sla,
        round(count(*) filter (where resolution_minutes <= 240) / count(*), 6) as sla_rate,
        round(quantile_cont(resolution_minutes, 0.5), 4) as median_minutes, max(resolution_minutes) as max_minutes
    from f_alert a left join d_date on alert_date_key = date_key left join d_employee e on a.employee_key = e.employee_key
    where resolution_minutes is not null group by 1, 2, 3, 4, 5
"""
Q["volume_by_channel_country"] = """
    select year, month, channel, country, coalesce(account_type, 'Unknown') as account_type, count(*) as n_transactions,
        cast(sum(amount) as double) as total_amount
    from f_txn f left join d_date using (date_key) left join d_account a on f.account_key = a.account_key group by all
"""
CTES["loans_twice"] = "select * from f_loan_prior union all select * from f_loan"
Q["loan_portfolio_monthly"] = """
    select year, month, snapshot_date_key, coalesce(customer_segment, 'Unknown') as customer_segment, count(*) as n_loans,
        cast(sum(outstanding_amount) as double) as outstanding, cast(sum(loan_amount) as double) as granted,
        round(cast(sum(interest_rate) as double) / count(interest_rate), 6) as avg_interest_rate
    from loans_twice l left join d_customer c on l.customer_key = c.customer_key
    left join d_date d on l.snapshot_date_key = d.date_key group by 1, 2, 3, 4
"""
Q["balance_anomalies"] = """
    select account_number, strftime(full_date, '%Y-%m-%d') as full_date, cast(balance as double) as balance,
        round(s / n, 2) as trailing_mean, round(spread, 2) as trailing_spread,
        round((cast(balance as double) - s / n) / spread, 3) as z_score
    from (select *, sqrt(greatest(0.0, (n * q - s * s) / (n * (n - 1)))) as spread
          from (select account_number, snapshot_date_key, balance, count(*) over w as n,
                    cast(sum(balance) over w as double) as s,
                    cast(sum(cast(cast(balance as decimal(18,2)) * cast(balance as decimal(18,2)) as decimal(36,4))) over w as double) as q
                from daily_balance where balance is not null
                window w as (partition by account_key order by snapshot_date_key rows between 7 preceding and 1 preceding))
          where n >= 3) b
    join d_date d on b.snapshot_date_key = d.date_key
    where spread > 0.005 and abs(round((cast(balance as double) - s / n) / spread, 3)) >= 2
"""
Q["fraud_hotspots"] = """
    select *, round(n_fraud / n_transactions, 6) as fraud_rate from (
        select 'ATM' as place_kind, a.city as place_city, a.country as place_country, count(*) as n_transactions,
            count(*) filter (where is_fraud_confirmed) as n_fraud
        from f_labelled f join d_atm a using (atm_key) group by 1, 2, 3
        union all
        select 'MERCHANT', m.city, m.country, count(*), count(*) filter (where is_fraud_confirmed)
        from f_labelled f join d_merchant m using (merchant_key) group by 1, 2, 3)
    where n_fraud > 0
    order by n_fraud desc, fraud_rate desc, place_kind, place_city, place_country limit 20
"""
Q["score_drift"] = """
    with periods as (select model_key, week_start as period_start, count(*) as n_scored
                     from f_det left join d_date on detection_date_key = date_key group by 1, 2),
    bins as (select unnest(range(0, 10)) as bin),
    shares as (select p.model_key, period_start, n_scored, bin, greatest(
                   (select count(*) from f_det f left join d_date d on f.detection_date_key = d.date_key
                    where f.model_key = p.model_key and d.week_start is not distinct from p.period_start
                      and least(cast(floor(f.fraud_score * 10) as integer), 9) = bins.bin) / n_scored, 0.0001) as p
               from periods p, bins),
    paired as (select *, first_value(p) over (partition by model_key, bin order by period_start) as q0 from shares)
    select model_name, model_version, strftime(period_start, '%Y-%m-%d') as period_start, n_scored,
        round(sum((p - q0) * ln(p / q0)), 6) as psi
    from paired left join d_model using (model_key) group by 1, 2, 3, 4
"""
Q["label_rate_by_analyst"] = """
    select a.employee_key, e.employee_id, year, month, count(*) as n_alerts, count(is_confirmed_fraud) as n_labelled,
        count(*) filter (where is_confirmed_fraud) as n_confirmed,
        round(count(is_confirmed_fraud) / count(*), 6) as label_rate,
        round(case when count(is_confirmed_fraud) > 0 then count(*) filter (where is_confirmed_fraud) / count(is_confirmed_fraud) end, 6) as confirmed_rate
    from f_alert a left join d_date on alert_date_key = date_key left join d_employee e on a.employee_key = e.employee_key
    group by 1, 2, 3, 4
"""


def _assemble(sql: str) -> str:
    """A body that brings its own WITH keeps it behind the shared CTEs."""
    body = sql.strip()
    if body.startswith("with "):
        whole_sql = statement(body.removeprefix("with ").strip(), CTES)
        return whole_sql.replace("\nperiods as", ",\nperiods as", 1)
    return statement(body, CTES)


ORACLES = {name: _assemble(sql) for name, sql in Q.items()}
