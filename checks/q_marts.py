"""The nine marts, run end to end over sources derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views
from checks.registry import Inputs, query
from lendmart.sources.catalog import Catalog

# logical source -> view that stands for it
SOURCES = {
    "installments": "raw_installments", "proposals": "proposals", "proposal_collections": "proposal_collections",
    "loans": "raw_loans", "loans_dedup": "raw_loans", "loan_detail": "loan_detail", "dictionary": "dictionary",
    "state_log": "state_log", "tu_scores": "tu_scores", "crif_scores": "crif_scores", "payment_register": "payment_register",
    "logins": "logins", "users": "raw_users", "employment": "employment", "additional_info": "additional_info",
    "identity_addresses": "identity_addresses", "rule_runs": "rule_runs", "job_log": "job_log", "job_steps": "job_steps",
    "rep_assignments": "rep_assignments", "source_owners": "source_owners", "bank_months": "bank_months", "mandates": "mandates",
    "mandate_ledger": "mandate_ledger", "bank_mandates": "bank_mandates", "subscriptions": "subscriptions", "cheques": "cheques",
    "bank_accounts": "bank_accounts", "transactions": "transactions", "bureau_ignore": "bureau_ignore",
    "lender_rule_log": "lender_rule_log", "lender_eligibility": "lender_eligibility", "prospects": "prospects",
    "campaign_runs": "campaign_runs", "campaign_performance": "campaign_performance", "channel_master": "channel_master",
    "pincode_master": "geo", "tenure_master": "tenure_master", "uw_master": "uw_master", "lead_details": "leads",
}


def catalog(i: Inputs, **frames) -> Catalog:
    """All sources as views; ``frames`` replaces some of them."""
    lazy = {name: (lambda v=v: getattr(i, v)) for name, v in SOURCES.items()}
    return Catalog(i.spark, frames={**lazy, **frames})


from checks.q_lead import day_sql  # noqa: E402
from checks.q_portfolio import (AS_OF, FEES_SQL, MEASURES, SITE, SPINE_SQL, SUMMARY_SQL, D, M0, M1, P0, P1, bucket_sql, idless, money,  # noqa: E402
                                monthly_sql, period_sql, position_sql, sum_if, tag_sql)
from lendmart.plans import lead_details as lead  # noqa: E402
from lendmart.plans import portfolio, static_pool  # noqa: E402
from lendmart.sources import sinks  # noqa: E402
from lendmart.sources.staging import scratch, stage  # noqa: E402

DISBURSED_SQL = "(SELECT loan_id, min(day) AS first_disburse_date, max(day) AS last_disburse_date FROM collected GROUP BY loan_id)"


@query("disburse_master", uses="collected raw_loans dictionary tenure_master live_inst", sql=f"""
SELECT l.id AS loan_id, {day_sql('l.created', 0)} AS loan_created, p.f AS first_disburse_date, strftime(p.f, '%b-%y') AS first_disburse_month, p.t AS last_disburse_date,
  strftime(p.t, '%b-%y') AS last_disburse_month, p.amount AS disburse_amount, CAST(coalesce(r.rate, 0.00) AS VARCHAR) || '%' AS roi, e.emi, coalesce(t.tenure, 0) AS tenure_months
FROM raw_loans l JOIN (SELECT loan_id, min(day) AS f, max(day) AS t, {money('sum(cp_amount)')} AS amount FROM collected GROUP BY loan_id) p ON p.loan_id = l.id
LEFT JOIN (SELECT id, CAST(trim(replace(cnd_name, '%', '')) AS DECIMAL(10,2)) AS rate FROM dictionary WHERE deleted = 'N' AND cnd_group = 'INTREST_RATE') r ON r.id = l.max_irate_approved
LEFT JOIN tenure_master t ON t.tenure_code = l.tenure
LEFT JOIN (SELECT loan_id, emi FROM (SELECT loan_id, {money('sum(amount)')} AS emi, row_number() OVER (PARTITION BY loan_id ORDER BY date_trunc('month', due) DESC) AS rn
           FROM live_inst GROUP BY loan_id, date_trunc('month', due)) WHERE rn = 1) e ON e.loan_id = l.id
WHERE l.deleted = 'N'""")
def _(i):
    return portfolio.disburse_master(catalog(i))


@query("loan_details", uses="live_inst leads transactions", sql=f"""
SELECT p.loan_id, p.portfolio_type, CASE WHEN settled THEN 'Closed' ELSE 'Active' END AS loan_status, current_total_due_principal AS loan_statusss, l.loan_type, l.loan_city, l.loan_registered_date,
  l.actual_live_date AS live_date, l.first_disburse_date AS disburse_date, CAST(last_day(l.first_disburse_date) AS DATE) AS lastday_disburse_date, CAST(date_trunc('month', l.first_disburse_date) AS DATE) AS disburse_month,
  first_emi_date, last_emi_date, first_emi_paid_date, CASE WHEN settled THEN last_paid_date END AS loan_close_date, last_paid_date, emi_due_date AS due_emi_date, count_total_emi AS tenure,
  CAST(l.rate_max_approved AS VARCHAR) || ' %' AS roi, l.risk_bucket, first_emi_amount, loan_emi_amount, l.loan_amount_expected, l.max_amount_approved, l.disburse_amount, principal_total AS loan_amount,
  count_paid_emi, count_balance_emi, interest_total AS loan_total_interest, amount_total AS loan_total_amount, principal_total_paid, interest_total_paid, emi_total_paid AS amount_total_paid,
  {', '.join(f'current_total_due_{m} AS total_due_{m}, current_due_{m}' for m in MEASURES)}, count_of_emi_total_due, emi_duedate_first, emi_duedate_last, count_of_emi_due, dpd_current,
  pt_current_dueamount, pt_current_dueprincipal, pt_due_date_since, pt_last_due_date, pt_count_of_emi_due, l.source AS source_of_lead, l.sub_category, l.category, l.channel, l.cibil_score, l.crif_score,
  f.registration_fees, f.processing_fees, {bucket_sql('loan', 'dpd_current')} AS dpd_classification
FROM (SELECT *, current_total_due_principal = 0 AS settled FROM {position_sql(AS_OF, '1998-06-30', 'live_inst')} q) p
LEFT JOIN (SELECT *, DATE '1970-01-01' AS unused FROM (SELECT loan_id, first_disburse_date, actual_live_date, loan_type, loan_city, loan_registered_date, rate_max_approved, risk_bucket,
  loan_amount_expected, max_amount_approved, disburse_amount, source, sub_category, category, channel, cibil_score, crif_score FROM leads)) l ON l.loan_id = p.loan_id
LEFT JOIN {FEES_SQL} f ON f.loan_id = p.loan_id""")
def _(i):
    leads = i.leads.withColumn("first_disburse_month", F.trunc("first_disburse_date", "month"))
    return portfolio.loan_details(catalog(i, lead_details=leads), AS_OF, SITE)


_OPEN_START = f"created < {M0} AND (state = 'due' OR updated >= {M0})"
_OPEN_PREV = f"created < {P0} AND (state = 'due' OR updated >= {P0})"
_CLS = "CASE WHEN state = 'due' THEN 'due' ELSE 'paid' END"


def dpd_sql(low, limit, at):
    return f"CASE WHEN date_trunc('month', {low}) <= {limit} THEN datediff('day', {low}, {at}) END"


COLLECTION_SQL = f"""(SELECT *, {bucket_sql('ops', 'dpd_current', settled='total_due_principal <= 0')} AS dpdcurrent_classification,
  {bucket_sql('finance', 'dpd_current', settled='total_due_principal <= 0')} AS dpdcurrent_classification_finance,
  {bucket_sql('ops_window', 'dpd_previous_month_start', settled='pos_previous_month <= 0', at=(P0, P1))} AS dpd_previous_month_day_classification,
  {bucket_sql('finance_window', 'dpd_previous_month_start', settled='pos_previous_month <= 0', at=(P0, P1))} AS dpd_previous_month_day_classification_finance,
  {bucket_sql('ops_window', 'dpd_month_start', settled='total_due_principal_start_month <= 0', at=(M0, M1))} AS dpdstart_classification,
  {bucket_sql('finance_window', 'dpd_month_start', settled='total_due_principal_start_month <= 0', at=(M0, M1))} AS dpdstart_classification_finance,
  CASE WHEN loan_status = 'closed' THEN last_paid_date END AS loan_close_date
FROM (SELECT * EXCLUDE (low_prev), {dpd_sql('due_emi_date', M0, D)} AS dpd_current, {dpd_sql('low_prev', P1, P0)} AS dpd_previous_month_start, {dpd_sql('due_emi_date_start_month', M0, M0)} AS dpd_month_start
FROM (SELECT loan_id, {tag_sql(2)} AS portfolio_type, CASE WHEN sum(CASE WHEN state = 'due' THEN 1 ELSE 0 END) > 0 THEN 'Active' ELSE 'closed' END AS loan_status, max(no) AS total_emi_count,
  coalesce(max(CASE WHEN month_due = 0 THEN cls_no END), 0) AS paid_emi_count, coalesce(max(CASE WHEN month_due > 0 AND state = 'due' THEN cls_no END), 0) AS balance_emi_count,
  {sum_if('no = 1', 'amount', 'first_emi_amount')}, {sum_if('no = 2', 'amount', 'emi_amount')}, min(due) AS first_emi_date, max(due) AS last_emi_date, {period_sql()},
  max(CASE WHEN state = 'paid' THEN updated END) AS last_paid_date, max(CASE WHEN month_due = 0 THEN updated END) AS last_paid_date_full_emi,
  max(CASE WHEN state = 'due' THEN no ELSE 0 END) AS count_of_emi_total_due, max(CASE WHEN state = 'due' AND due <= {M1} THEN no ELSE 0 END) AS count_of_emi_due,
  max(CASE WHEN {_OPEN_START} AND due <= {M1} THEN no ELSE 0 END) AS due_emi_count_start_month, min(CASE WHEN state = 'due' THEN due END) AS due_emi_date,
  min(CASE WHEN {_OPEN_START} THEN due END) AS due_emi_date_start_month, min(CASE WHEN {_OPEN_PREV} THEN due END) AS low_prev
FROM (SELECT *, dense_rank() OVER (PARTITION BY loan_id ORDER BY date_trunc('month', due)) AS no, dense_rank() OVER (PARTITION BY loan_id, {_CLS} ORDER BY date_trunc('month', due)) AS cls_no,
  sum(CASE WHEN state = 'due' THEN 1 ELSE 0 END) OVER (PARTITION BY loan_id, date_trunc('month', due)) AS month_due FROM {{src}}) GROUP BY loan_id)))"""


@query("collection_position", uses="inst", sql=f"SELECT * FROM {COLLECTION_SQL.format(src='inst')} c")
def _(i):
    return portfolio.collection_position(i.inst, AS_OF, SITE)


@query("collection_position_idless", uses="idless_inst", sql=f"SELECT * FROM {COLLECTION_SQL.format(src='idless_inst')} c")
def _(i):
    return portfolio.collection_position(idless(i), AS_OF, SITE)


@query("collection_master", uses="live_inst leads", sql=f"""
SELECT c.*, {D} AS report_datetime FROM {COLLECTION_SQL.format(src='live_inst')} c LEFT JOIN leads l ON l.loan_id = c.loan_id
WHERE (l.first_disburse_date < {M0} OR (l.first_disburse_date IS NULL AND dpdstart_classification <> 'A8_Future EMI')) AND l.plus <> 420""")
def _(i):
    return portfolio.collection_master(catalog(i), AS_OF, SITE)


_LOANS = f"""(SELECT s.* EXCLUDE (min_emi_created), coalesce(d.first_disburse_date, s.min_emi_created) AS disburse_date, d.first_disburse_date, d.last_disburse_date
  FROM {SUMMARY_SQL.format(src='live_inst')} s LEFT JOIN {DISBURSED_SQL} d ON d.loan_id = s.loan_id)"""
_LM = SPINE_SQL.format(loans=_LOANS)
_KEYS = f"(SELECT loan_id, status_month FROM {_LM} z)"
MONTHLY_SQL = f"""(SELECT k.loan_id, k.portfolio_type, {', '.join(f'k.loan_total_{m}' for m in MEASURES)}, k.total_emi_count, k.first_emi_date, k.last_emi_date, k.disburse_date, k.first_disburse_date, k.last_disburse_date,
  k.status_month, CASE WHEN active_count > 0 THEN 'Active' ELSE 'Closed' END AS loan_status, total_emi_count - paid_emi_count AS balance_emi_count, paid_emi_count,
  {', '.join(f'total_paid_{m}, total_paid_{m}_this_month, total_due_{m}, due_{m}_to_collect' for m in MEASURES)}, last_paid_date, due_emi_date, dpd_month_current,
  CASE WHEN bounce_relax_count > 0 THEN 1 ELSE 0 END AS bounce_relaxed, CASE WHEN bounce_act_count > 0 THEN 1 ELSE 0 END AS bounce_actual,
  datediff('month', k.first_emi_date, k.status_month) + 1 AS mob_emi, datediff('month', k.disburse_date, k.status_month) AS mob,
  CASE WHEN (last_day(k.last_emi_date) < k.status_month AND active_count > 0) OR bounce_relax_count > 0 THEN 1 ELSE 0 END AS missed_payment_relaxed,
  CASE WHEN (last_day(k.last_emi_date) < k.status_month AND active_count > 0) OR bounce_act_count > 0 THEN 1 ELSE 0 END AS missed_payment_actual,
  CASE WHEN active_count = 0 THEN last_paid_date END AS loan_close_date,
  {bucket_sql('snapshot', 'dpd_month_current', 'last_day(k.first_emi_date)', 'active_count = 0', 'k.status_month')} AS dpdcurrent_classification,
  l.loan_registered_date, l.loan_type, l.loan_city, l.rate_max_approved AS roi, l.risk_bucket, l.source AS source_of_lead, l.sub_category, l.category, l.channel
FROM {_LM} k JOIN (SELECT *, datediff('day', min_overdue_emi_date, least(status_month, {D})) AS dpd_month_current FROM {monthly_sql(_KEYS, 'live_inst')} y) a ON a.loan_id = k.loan_id AND a.status_month = k.status_month
LEFT JOIN leads l ON l.loan_id = k.loan_id)"""


@query("loan_at_monthly_full", uses="live_inst collected leads", sql=f"SELECT * FROM {MONTHLY_SQL} m")
def _(i):
    return portfolio.loan_at_monthly_full(catalog(i), AS_OF, SITE)


@query("loan_at_monthly_refresh", uses="live_inst collected leads", sql=f"SELECT * FROM {MONTHLY_SQL} m WHERE status_month = {M1}")
def _(i):
    return portfolio.loan_at_monthly_current(catalog(i), AS_OF, SITE)


from checks.q_cohort import INCOME, between_sql, employment_sql, upto  # noqa: E402
from lendmart import fixed_values as fv  # noqa: E402

_TAT = {"tat": "datediff('day', l.loan_registered_date, l.first_disburse_date)", "tat_live_disburse": "datediff('day', l.uw_live_date, l.first_disburse_date)",
        "tat_loan_live": "datediff('day', l.loan_registered_date, l.uw_live_date)"}
_TAT_GRP = {"tat": "tat_grp", "tat_live_disburse": "tat_grp_live_disburse", "tat_loan_live": "tat_grp_loan_live"}
_W = "OVER (PARTITION BY user_pan ORDER BY disburse_date, m.loan_id)"
_HISTORY = f"""(SELECT *, CASE WHEN pan_count > 1 THEN 1 ELSE 0 END AS top_up, CASE WHEN pan_count = 1 THEN 0 WHEN old_loan_close_date IS NULL THEN 30 ELSE datediff('day', disburse_date, old_loan_close_date) END AS top_date_diff
FROM (SELECT m.loan_id, m.disburse_date, row_number() {_W} AS pan_count, lag(l.category) {_W} AS old_category, lag(l.sub_category) {_W} AS old_sub_category, lag(l.channel) {_W} AS old_channel,
  lag(m.last_emi_date) {_W} AS old_loan_last_emi_date, lag(m.loan_close_date) {_W} AS old_loan_close_date
  FROM (SELECT loan_id, disburse_date, last_emi_date, loan_close_date FROM monthly WHERE status_month = {M1}) m JOIN leads l ON l.loan_id = m.loan_id AND l.channel <> 'Alliances' AND l.user_pan <> ''))"""
_SCORE = f"""CASE WHEN l.source = 'IMB' AND l.parent_uid <> 0 THEN (SELECT TRY_CAST(nullif(x.crif_score, '') AS INT) FROM (SELECT user_id, crif_score, row_number() OVER (PARTITION BY user_id ORDER BY loan_id DESC) AS rn
  FROM leads) x WHERE x.rn = 1 AND x.user_id = l.parent_uid) ELSE TRY_CAST(nullif(l.crif_score, '') AS INT) END"""
_LADDER = [repr(x) for x in fv.DELINQUENCY_LADDER]


@query("static_pool", uses="live_inst collected leads mandate_ledger", sql=f"""
WITH monthly AS (SELECT * FROM {MONTHLY_SQL} mm), pres AS (SELECT DISTINCT loan_id, unique_reference_no FROM mandate_ledger WHERE deleted = 'N' AND ledger_type <> 'PENALTY' AND {day_sql('CAST(created AS BIGINT)')} <= {M0}),
b AS (SELECT m.loan_id, m.portfolio_type, m.loan_total_principal AS loan_amount, CAST(last_day(m.disburse_date) AS DATE) AS disburse_month, l.gender, l.generations, l.user_pin AS pincode, l.user_city AS borrower_city,
  l.user_district AS borrower_district, l.user_state AS borrower_state, l.user_zone AS borrower_zone, l.residence_type, l.employement_type, '' AS cirf_score, {_SCORE} AS crif_score_original, l.loan_type, l.loan_city,
  l.tenure_months AS tenure, {between_sql('l.tenure_monthsno', [(e + 1, n) for e, n in fv.TENURE_LE], None)} AS tenure_group, l.rate_max_approved AS roi, l.risk_bucket, l.sub_category, l.source, l.category,
  CASE WHEN l.channel <> 'Alliances' AND m.loan_total_principal < 25001 THEN 'Pocket Loan' WHEN l.channel = 'Marketing' THEN 'Organic' ELSE l.channel END AS channel, l.channel AS channel_old,
  CASE WHEN m.loan_status = 'Active' THEN 1 ELSE 0 END AS loan_status, m.total_due_principal AS pos, {between_sql('m.roi', fv.ROI_LT + [(e + 0.001, n) for e, n in fv.ROI_LE], fv.ROI_ELSE)} AS roi_group,
  {between_sql('l.age_loanregister', fv.AGE_LT, fv.AGE_ELSE)} AS age_group, {INCOME.replace('(income', '(l.income')} AS income,
  {employment_sql(INCOME, 'income', fv.INCOME_SALARIED_LT, fv.INCOME_SALARIED_ELSE, fv.INCOME_SELF_LT, fv.INCOME_SELF_ELSE)} AS income_group,
  {between_sql('m.loan_total_principal', fv.AMOUNT_LT, fv.AMOUNT_ELSE)} AS loan_amount_group_new, TRY_CAST(nullif(foir_before, '') AS DECIMAL(10,3)) AS foir_before,
  {employment_sql("TRY_CAST(foir_before AS DECIMAL(10,3))", 'foir_before', fv.FOIR_BEFORE_SALARIED_LT, fv.FOIR_BEFORE_SALARIED_ELSE, fv.FOIR_BEFORE_SELF_LT, fv.FOIR_BEFORE_SELF_ELSE)} AS foir_before_group,
  TRY_CAST(nullif(foir_after, '') AS DECIMAL(10,3)) AS foir_after,
  {employment_sql("TRY_CAST(foir_after AS DECIMAL(10,3))", 'foir_after', fv.FOIR_AFTER_SALARIED_LT, fv.FOIR_AFTER_SALARIED_ELSE, fv.FOIR_AFTER_SELF_LT, fv.FOIR_AFTER_SELF_ELSE)} AS foir_after_group, '' AS crif_group,
  {', '.join(f'{e} AS {n}, {between_sql(e, upto(fv.TURNAROUND_LE), fv.TURNAROUND_ELSE, missing="NA")} AS {_TAT_GRP[n]}' for n, e in _TAT.items())},
  l.dev_exists, l.total_dev, l.bank_name, coalesce(l.nach_source, 'NA') AS nach_type, coalesce(l.nach_status, 'NA') AS nach_status, coalesce(l.nach_reason, 'NA') AS nach_reason,
  coalesce(l.payment_registration_method, 'NA') AS payment_registration_method, CASE WHEN p.loan_id IS NULL THEN 'Others' ELSE 'NACH' END AS payment_presentation_method, l.cheque_total, l.cheque_available,
  CASE WHEN l.cheque_available > 0 THEN 'Yes' ELSE 'No' END AS cheque_available_flag, CASE WHEN m.first_emi_date <= m.status_month - 4 THEN m.loan_total_principal ELSE 0 END AS la_1stemipresented,
  CASE WHEN m.loan_total_principal = m.total_due_principal AND m.first_emi_date <= m.status_month - 4 THEN 1 ELSE 0 END AS non_starter, m.bounce_relaxed AS bounce_mob,
  CASE WHEN l.dev_exists = 'Y' THEN 1 ELSE 0 END AS deviation_exists, l.total_dev AS total_deviation, l.loan_registered_date, l.accepted_date, l.actual_live_date, l.rfd_date, l.first_disburse_date, l.product_type,
  l.comp_natureofbusiness AS nature_of_business, l.comp_industrytype AS industry_type, l.ex360_npa, m.status_month, m.mob, m.loan_status AS loan_status_mob, m.total_due_principal AS pos_mob,
  m.dpdcurrent_classification AS dpd, CASE WHEN m.channel = 'Alliances' THEN 'Alliances' WHEN m.loan_total_principal < 25001 THEN 'Pocket Loan' ELSE l.uw_name END AS uw, l.uw_status_final AS uw_status,
  l.call_disposition AS call_status, l.ba_name AS borrower_agent, l.ba_login_name_clean AS borrower_agent_name, l.rm AS relation_manager,
  CASE WHEN l.loan_img1 IS NULL THEN 'NA' WHEN l.loan_img1 = 'APPROVED' THEN 'PQ Approved' WHEN l.loan_img1 = 'REFER' THEN 'REFER' ELSE 'Unknown' END AS pq_status,
  CASE WHEN l.loan_img2 IS NULL THEN 'NA' WHEN l.loan_img2 = 'YES' THEN 'Yes' WHEN l.loan_img2 = 'NO' THEN 'No' ELSE 'Unknown' END AS offer_status,
  CASE WHEN l.uw_returned_date IS NOT NULL THEN 1 ELSE 0 END AS retuned_flag, CASE WHEN l.uw_forward_to_cs_date IS NOT NULL THEN 1 ELSE 0 END AS forwarded_flag,
  datediff('month', l.comp_startdate, l.loan_registered_date) AS business_vintage, {between_sql("datediff('month', l.comp_startdate, l.loan_registered_date)", upto(fv.VINTAGE_LE), fv.VINTAGE_ELSE, missing='NA')} AS business_vintage_grp,
  CASE WHEN m.channel = 'DSA Partner' THEN nullif(l.user_agent_name, '') END AS dsa, m.mob_emi AS mob_on_1st_emi, h.pan_count, h.top_up, h.old_category, h.old_sub_category, h.old_channel, h.old_loan_last_emi_date,
  h.old_loan_close_date, h.top_date_diff, CASE WHEN h.top_date_diff > 10 THEN 1 ELSE 0 END AS double_disburse, m.due_principal_to_collect, CASE WHEN m.dpd_month_current >= 365 THEN 1 ELSE 0 END AS ex365_month
FROM monthly m JOIN leads l ON l.loan_id = m.loan_id LEFT JOIN {_HISTORY} h ON h.loan_id = m.loan_id LEFT JOIN pres p ON p.loan_id = l.loan_id AND p.unique_reference_no = l.mandate_id
WHERE l.plus <> 420 AND l.fraud_flag = 0)
SELECT *, CASE WHEN non_starter = 1 THEN 'Yes' ELSE 'No' END AS non_starter_flag, CASE WHEN non_starter = 1 THEN pos ELSE 0 END AS non_starter_pos,
  {between_sql('crif_score_original', upto(fv.SCORE_LE), fv.SCORE_ELSE, missing=fv.SCORE_NULL)} AS crif_group_original,
  'CY ' || year(disburse_month) AS cy, 'CY ' || year(disburse_month) || '-Q' || quarter(disburse_month) AS cy_qtr,
  'FY ' || (year(disburse_month - INTERVAL 3 MONTH)) || '-' || right(CAST(year(disburse_month - INTERVAL 3 MONTH) + 1 AS VARCHAR), 2) AS fy,
  'FY ' || (year(disburse_month - INTERVAL 3 MONTH)) || '-' || right(CAST(year(disburse_month - INTERVAL 3 MONTH) + 1 AS VARCHAR), 2) || '-Q' || quarter(disburse_month - INTERVAL 3 MONTH) AS fy_qtr,
  month(disburse_month - INTERVAL 3 MONTH) AS fy_month,
  {', '.join(f"CASE WHEN dpd IN ({', '.join(_LADDER[k:])}) THEN 1 ELSE 0 END AS {n}_count, CASE WHEN dpd IN ({', '.join(_LADDER[k:])}) THEN pos ELSE 0 END AS {n}" for n, k in fv.DELINQUENCY_STARTS.items())}
FROM b""")
def _(i):
    return pool_over(i, monthly_table(i))


def monthly_table(i):
    """The monthly mart is a table by the time the pool reads it."""
    return stage(portfolio.loan_at_monthly_full(catalog(i), AS_OF, SITE), "monthly", "status_month")


def pool_over(i, monthly):
    return static_pool.static_pool(catalog(i, loan_details_at_monthly=monthly), AS_OF, SITE)


@query("lead_channel", uses="leads", sql="SELECT loan_id AS lead_id, source, channel, sub_category, category FROM leads")
def _(i):
    return lead.lead_channel(i.leads)


@query("monthly_refreshed", uses="live_inst collected leads", sql=f"SELECT * FROM {MONTHLY_SQL} m")
def _(i):
    """Written by months with a spoiled current month, which two refreshes replace, and read back."""
    path = scratch(i.spark, "monthly_table")
    full = portfolio.loan_at_monthly_full(catalog(i), AS_OF, SITE)
    spoiled = F.when(F.col("status_month") == F.last_day(F.lit(AS_OF).cast("date")), "spoiled").otherwise(F.col("loan_status"))
    sinks.write_snapshots(full.withColumn("loan_status", spoiled), path)
    for _ in range(2):
        sinks.refresh_snapshots(portfolio.loan_at_monthly_current(catalog(i), AS_OF, SITE), path)
    return i.spark.read.schema(full.schema).parquet(path).select(*full.columns)


@query("published_rebuild", uses="leads", sql="""
SELECT 'open before' AS reader, loan_id AS lead_id, source, upper(channel) AS channel, sub_category, category FROM leads
UNION ALL SELECT 'open after', loan_id, source, channel, sub_category, category FROM leads""")
def _(i):
    """A rebuild while an earlier version is open: that reader keeps its rows, the next one gets the new ones."""
    path = scratch(i.spark, "published_table")
    mart = lead.lead_channel(i.leads)
    published = Catalog(i.spark, mapping={"lead_channel": path})
    sinks.publish(mart.withColumn("channel", F.upper("channel")), path)
    before = published["lead_channel"]
    sinks.publish(mart, path)
    after = published["lead_channel"]
    reader = lambda df, name: df.select(F.lit(name).alias("reader"), *mart.columns)
    return reader(before, "open before").unionByName(reader(after, "open after"))
