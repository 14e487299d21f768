"""Campaigns, prospects, acceptance, registrations and the funnel mart."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from checks.q_history import PIVOT_SQL
from checks.q_marts import catalog
from checks.registry import query
from lendmart import fixed_values as fv
from lendmart.config import DEFAULT_SITE
from lendmart.operators import funnel
from lendmart.operators import state_log as sl
from lendmart.plans import lead_funnel as plan

SITE = dataclasses.replace(DEFAULT_SITE, funnel_from="1995-09-01")
LEADS_SQL = """(SELECT loan_id, loan_registered_date AS lead_registration_date, bor_mobile AS lead_mobile_clean, user_pan AS lead_pan FROM leads
  WHERE loan_registered_date >= DATE '1995-09-01')"""
CAMPAIGN_SQL = """(SELECT los_app_id, min(d) AS campaign_date FROM (
  SELECT los_app_id, CAST(try_strptime(campaign_date, '%Y-%m-%d') AS DATE) AS d FROM campaign_runs
  UNION ALL SELECT CAST(los_app_id AS BIGINT), CAST(DATE '1970-01-01' + CAST((campaign_date - 19800) // 86400 AS INT) AS DATE) FROM campaign_performance WHERE deleted = 'N' AND id > 2) GROUP BY los_app_id)"""
PROSPECT_SQL = f"""(SELECT p.los_app_id, p.pan AS pros_pan, p.mobile AS pros_mobile, c.campaign_date,
  CASE WHEN p.pan <> '' THEN CASE WHEN row_number() OVER (PARTITION BY p.pan ORDER BY c.campaign_date NULLS LAST, p.los_app_id) = 1 THEN 1 ELSE 0 END END AS is_first_of_id
  FROM prospects p LEFT JOIN {CAMPAIGN_SQL} c ON c.los_app_id = p.los_app_id)"""
# Every pair, then the best: fine on a small copy, never the plan on Spark.
ATTR_SQL = f"""(SELECT * FROM (SELECT l.*, x.los_app_id, x.campaign_date, x.pros_mobile, x.pros_pan, row_number() OVER (PARTITION BY l.loan_id ORDER BY x.campaign_date NULLS LAST, x.los_app_id NULLS LAST) AS rn
  FROM {LEADS_SQL} l LEFT JOIN {PROSPECT_SQL} x ON x.pros_mobile = l.lead_mobile_clean OR (x.pros_pan = l.lead_pan AND x.is_first_of_id = 1)) WHERE rn = 1)"""
FIRST_SQL = f"""(SELECT * FROM (SELECT l.loan_id, l.lead_registration_date, e.user_id AS uid, e.loan_registered_date, e.loan_id AS first_loan_id,
  row_number() OVER (PARTITION BY l.loan_id ORDER BY e.loan_registered_date NULLS LAST, e.loan_id) AS rn FROM {LEADS_SQL} l
  LEFT JOIN leads e ON e.bor_mobile = l.lead_mobile_clean OR (e.user_pan = l.lead_pan AND e.user_pan <> '')) WHERE rn = 1)"""
ACCEPT_SQL = f"""(SELECT entity AS loan_id, CAST(DATE '1970-01-01' + CAST(max(at_s - 19800) // 86400 AS INT) AS DATE) AS acc_date FROM log
  WHERE new_state = 1400 AND entity IN (SELECT loan_id FROM {LEADS_SQL} l) GROUP BY entity)"""


def leads(i):
    return plan.recent_leads(i.leads, SITE.funnel_from)


def prospects(i):
    return funnel.prospect_base(i.prospects, funnel.campaign_dates(i.campaign_runs, i.campaign_performance))


@query("campaign_dates", uses="campaign_runs campaign_performance", sql=f"SELECT * FROM {CAMPAIGN_SQL} c")
def _(i):
    return funnel.campaign_dates(i.campaign_runs, i.campaign_performance)


@query("prospect_base", uses="prospects campaign_runs campaign_performance", sql=f"SELECT * FROM {PROSPECT_SQL} p")
def _(i):
    return prospects(i).select("los_app_id", "pros_pan", "pros_mobile", "campaign_date", "is_first_of_id")


@query("attribute_campaign", uses="leads prospects campaign_runs campaign_performance", sql=f"""
SELECT loan_id, los_app_id, campaign_date, pros_mobile, pros_pan, CASE WHEN lead_registration_date - campaign_date BETWEEN 0 AND 90 THEN 1 ELSE 0 END AS campaign_lead,
  lead_registration_date - campaign_date AS camp_lead_diff FROM {ATTR_SQL} a""")
def _(i):
    out = funnel.attribute_campaign(leads(i), prospects(i))
    return out.select("loan_id", "los_app_id", "campaign_date", "pros_mobile", "pros_pan", *[c.alias(n) for n, c in funnel.campaign_window().items()])


@query("first_registration", uses="leads", sql=f"""
SELECT loan_id, uid, loan_registered_date, first_loan_id, CAST(date_trunc('month', loan_registered_date) AS DATE) AS loan_registered_month,
  lead_registration_date - loan_registered_date AS loan_lead_diff FROM {FIRST_SQL} f""")
def _(i):
    return funnel.first_registration(leads(i), i.leads).select("loan_id", "uid", "loan_registered_date", "first_loan_id", "loan_registered_month", "loan_lead_diff")


@query("acceptance", uses="log leads", sql=f"SELECT * FROM {ACCEPT_SQL} a")
def _(i):
    return funnel.acceptance(sl.state_log(i.state_log, None, 0), leads(i))


_ELIGIBLE = " + ".join(f"coalesce({n}, 0)" for _, _, n in fv.LENDER_RULES)
_PREF = " + ".join(f"coalesce({n}, 0)" for n in fv.PREFERRED_ELIGIBILITY)
DISB_SQL = """(SELECT loan_id, product_tag, disburse_amount, disburse_date FROM (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY disburse_date DESC NULLS LAST, product_tag, disburse_amount DESC) AS rn
  FROM lender_eligibility WHERE deleted = 'N' AND disburse_status = 'Y') WHERE rn = 1)"""


@query("eligibility_score", uses="lender_rule_log lender_eligibility", sql=f"""
SELECT p.loan_id, {_ELIGIBLE} AS eligible_lender, CASE WHEN {_PREF} > 0 THEN 1 ELSE 0 END AS bre_approved, CASE WHEN d.disburse_amount > 0 OR d.disburse_date IS NOT NULL THEN 1 ELSE 0 END AS disbursed
FROM {PIVOT_SQL} p LEFT JOIN {DISB_SQL} d ON d.loan_id = p.loan_id""")
def _(i):
    from lendmart.operators.rows import active_only, latest_by
    d = active_only(i.lender_eligibility).filter("disburse_status = 'Y'")
    d = latest_by(d, "loan_id", [F.col("disburse_date").desc(), F.col("product_tag").asc(), F.col("disburse_amount").desc()])
    p = sl.pivot_outcomes(sl.latest_rule_by_type(i.lender_rule_log)).join(d.select("loan_id", "disburse_amount", "disburse_date"), "loan_id", "left")
    return p.select("loan_id", *[c.alias(n) for n, c in sl.eligibility_score().items()])


_LEAD_COLS = ", ".join(f"l.{s} AS {n}" for n, s in plan.LEAD_COLUMNS.items())
_PROS = {n: s for s, n in funnel.PROSPECT_COLUMNS.items() if n != "los_app_id"}


@query("lead_funnel", uses="leads log lender_rule_log lender_eligibility prospects campaign_runs campaign_performance", sql=f"""
SELECT {_LEAD_COLS}, CAST(date_trunc('month', l.loan_registered_date) AS DATE) AS lead_registration_month, a.acc_date, CAST(date_trunc('month', a.acc_date) AS DATE) AS acc_month,
  CASE WHEN a.acc_date IS NOT NULL THEN 1 ELSE 0 END AS accepted, p.bre_date, CAST(date_trunc('month', p.bre_date) AS DATE) AS bre_month, {', '.join('p.' + n for _, _, n in fv.LENDER_RULES)},
  d.product_tag, d.disburse_amount, d.disburse_date, CAST(date_trunc('month', d.disburse_date) AS DATE) AS disb_month, x.los_app_id, x.campaign_date, {', '.join(f'o.{s} AS {n}' for n, s in _PROS.items())},
  CASE WHEN l.loan_registered_date - x.campaign_date BETWEEN 0 AND 90 THEN 1 ELSE 0 END AS campaign_lead, l.loan_registered_date - x.campaign_date AS camp_lead_diff,
  {_ELIGIBLE} AS eligible_lender, CASE WHEN {_PREF} > 0 THEN 1 ELSE 0 END AS bre_approved, CASE WHEN d.disburse_amount > 0 OR d.disburse_date IS NOT NULL THEN 1 ELSE 0 END AS disbursed,
  f.uid, f.loan_registered_date, f.first_loan_id, CAST(date_trunc('month', f.loan_registered_date) AS DATE) AS loan_registered_month, l.loan_registered_date - f.loan_registered_date AS loan_lead_diff
FROM leads l LEFT JOIN {ACCEPT_SQL} a ON a.loan_id = l.loan_id LEFT JOIN {PIVOT_SQL} p ON p.loan_id = l.loan_id LEFT JOIN {DISB_SQL} d ON d.loan_id = l.loan_id
LEFT JOIN {ATTR_SQL} x ON x.loan_id = l.loan_id LEFT JOIN prospects o ON o.los_app_id = x.los_app_id LEFT JOIN {FIRST_SQL} f ON f.loan_id = l.loan_id
WHERE l.loan_registered_date >= DATE '1995-09-01'""")
def _(i):
    return plan.lead_funnel(catalog(i), SITE)
