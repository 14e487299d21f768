"""The lead mart and its borrower projection, with the whole mart restated as one statement."""

from __future__ import annotations

from checks import views
from checks.q_clean import phone_sql, tokens_sql
from checks.q_cohort import between_sql, upto
from checks.q_history import _asof_sql
from checks.q_lead import BANK_SQL, BEST_SQL, NAMEC, SUBS_SQL, _dec, _rate, _START, _tt, day_sql, title  # noqa: F401
from checks.q_marts import catalog
from checks.q_portfolio import AS_OF, SITE, D, money, tag_sql
from checks.registry import RAW, query
from lendmart import fixed_values as fv
from lendmart.plans import lead_details as lead

PARTS = {  # CTE name -> registered query whose SQL it is
    "people": "people_dimension", "reps": "agent_reps", "owners": "source_reps", "chan": "channel_dimension", "facts": "log_frame",
    "alloc": "parsed_allocation", "ops": "ops_remarks", "refs": "slots_wide", "perms": "permanent_contacts", "eav": "latest_value",
    "devs": "deviation_counts", "det": "detail_frame", "chq": "conditional_counts", "rules": "daily_rule_outcome",
    "flags": "lead_flags", "fees": "fee_totals", "acct": "primary_account", "disb": "disbursement_rollup", "lbase": "loan_base",
}
USES = "raw_loans raw_users dictionary tenure_master geo employment collected crif_scores tu_scores uw_master bank_months identity_addresses mandates subscriptions bank_mandates"
ALL_USES = " ".join(dict.fromkeys((USES + " " + " ".join(RAW[q][1] for q in PARTS.values())).split()))


def ts(c):
    return f"make_timestamp(CAST({c} AS BIGINT) * 1000000)"


def part(name):
    """A registered statement as a CTE body."""
    sql = RAW[name][0].strip()
    return sql


_SCORE_TU = _asof_sql("tu_scores", "cibil_score", 0, "CASE WHEN cibil_score LIKE '%0-1%' THEN '1' WHEN cibil_score IN ('000','001','002','003','004','005') "
                      "THEN CAST(CAST(cibil_score AS INT) AS VARCHAR) ELSE cibil_score END").replace("milestone m ON m.loanid", "disb m ON m.loan_id").replace("PARTITION BY loan_id", "PARTITION BY s.loan_id")
_SCORE_CRIF = _asof_sql("crif_scores", "score", 19800, "CASE WHEN score LIKE '%0-1%' THEN '0' ELSE score END").replace("milestone m ON m.loanid", "disb m ON m.loan_id").replace("PARTITION BY loan_id", "PARTITION BY s.loan_id")

JOB = f"""SELECT e.uid, {_tt(_dec('EMPLOYMENT_TYPE', 'employment_type_cnd'), 'unknown')} AS employement_type, is_current AS is_current_employement, {_tt('comp_designation', 'unknown')} AS comp_designation,
  {_tt('comp_name', 'unknown')} AS comp_name, {_tt('comp_address')} AS comp_address, {_tt('g.city_pin', 'unknown')} AS comp_city, {_tt('g.state', 'unknown')} AS comp_state, comp_tenure,
  regexp_extract(comp_pin, '[0-9]+') AS comp_pin, comp_phone, lower(trim(comp_email)) AS comp_email, {day_sql(_START)} AS comp_startdate, {day_sql('TRY_CAST(comp_end AS BIGINT)')} AS com_enddate,
  CASE comp_business_type_cnd WHEN 90000116 THEN '' ELSE '55' END AS comp_businesstype, {_tt(_dec('INDIA_PROFESSION', 'comp_industry_cnd'))} AS comp_industry, company_profit AS comp_profit,
  company_depreciation AS comp_depreciation, company_salary_paid AS comp_salarypaid, '1' AS comp_officeownership, is_verified, '2' AS designation_level, {_tt(_dec('INDIA_PROFESSION', 'profession_cnd'))} AS comp_profession,
  other_salaries_paid AS other_salariespaid, work_exp, prev_takehome_sal AS previous_takehomesalary, {_tt('business_type')} AS business_type,
  CASE office_type WHEN '1' THEN 'Owned' WHEN '0' THEN 'Rented' ELSE '' END AS comp_officetype, no_of_employee AS comp_noofemployee, company_turnover AS comp_turnover, comp_registration_no AS comp_registrationno,
  contact2 AS comp_contactno2, 'N' AS comp_natureofbusiness, CASE WHEN industry_type = '60' THEN 'Other' ELSE {_tt(_dec('business_industry_type_new', 'industry_type'))} END AS comp_industrytype,
  'S' AS comp_subindustrytype, caution_profile, business_cash_component AS comp_cashcomponent
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY id DESC) AS rn FROM employment WHERE deleted = 'N') WHERE rn = 1) e
LEFT JOIN geo g ON CAST(g.pincode AS VARCHAR) = regexp_extract(comp_pin, '[0-9]+')"""
JOB_COLS = [c for c in lead.EMPLOYMENT_COLUMNS]

_ID = {"adhaar_name": "name", "adhaar_state": "state", "adhaar_district": "district", "adhaar_sub_district": "sub_district", "adhaar_street": "street",
       "adhaar_vtc": "vtc", "adhaar_house_number": '"House_number"', "adhaar_locality": "locality"}


def _nn(c):
    return f"regexp_replace({c}, 'null', '', 'g')"


IDENT = f"""SELECT loan_id, dob AS adhaar_dob, gender AS adhaar_gender, {', '.join(f"coalesce({title(f'trim({_nn(c)})')}, '') AS {n}" for n, c in _ID.items())},
  regexp_replace({title("trim(" + " || ' ' || ".join(f"coalesce(trim({_nn(c)}), '')" for c in ('"House_number"', 'locality', 'vtc', 'sub_district', 'district', 'state')) + ")")}, '[\\n|\\r]+', ',', 'g') AS adhaar_fulladdress,
  coalesce(upper(trim({_nn('adhaar')})), '') AS adhaar_adhaar
FROM (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY id DESC) AS rn FROM identity_addresses WHERE deleted = 'N') WHERE rn = 1"""

MANDATE = f"""SELECT b.* EXCLUDE (nach_priority), 'holder' AS nach_bankholder, 'e@x' AS nach_emailid, '9' AS nach_mobile, 'bank' AS nach_bank, 'br' AS nach_branch, 'acc' AS nach_accountno, 'ifsc' AS nach_ifsccode,
  'umrn' AS nach_umrn, CAST(NULL AS DATE) AS enach_approved_date, s.* EXCLUDE (loan_id, mandate_id), k.* EXCLUDE (loan_id, mandate_id),
  CASE WHEN s.mandate_link_created > 0 OR k.icici_mandate_link_created > 0 THEN 'E-Mandate' ELSE 'Nach' END AS nach_source,
  (CASE WHEN nach_status = 'Final Approved' THEN CASE WHEN mandate_active = 1 OR icici_mandate_active = 1 THEN 'E-Mandate Activated' ELSE 'Nach Activated' END
        WHEN mandate_active = 1 OR icici_mandate_active = 1 THEN 'E-Mandate Authorised' ELSE 'No E-Mandate & Nach' END) AS mandate_status
FROM {BEST_SQL} b LEFT JOIN {SUBS_SQL} s ON s.loan_id = b.loan_id AND s.mandate_id = b.mandate_id LEFT JOIN {BANK_SQL} k ON k.loan_id = b.loan_id AND k.mandate_id = b.mandate_id"""

_SLOT = ", ".join(f"w_{n}.uw_name AS uw_{n}, {ts(f'f.uw_{n}_date')} AS uw_{n}_date" for n in fv.UW_SLOTS)
_SLOT_JOINS = " ".join(f"LEFT JOIN uw_master w_{n} ON w_{n}.uw_id = f.uw_{n}" for n in fv.UW_SLOTS)
UW = f"""SELECT *, CASE WHEN a IS NOT NULL THEN nm END AS uw_name, CASE WHEN a IS NOT NULL THEN {ts('at_x')} END AS uw_assigned_date FROM (
  SELECT coalesce(f.loan_id, al.loan_id) AS loan_id, coalesce(al.uwas_id, f.uw_last) AS a, coalesce(wa.uw_name, wl.uw_name) AS nm,
    coalesce(al.at_s, f.uwac_created, f.uw_last_at) AS at_x, {', '.join(f'{ts("f." + n)} AS {n}' for n in fv.MILESTONES)}, f.ba_uid, f.preuw_uid, {_SLOT}
  FROM facts f FULL JOIN alloc al ON al.loan_id = f.loan_id LEFT JOIN uw_master wa ON wa.uw_id = al.uwas_id LEFT JOIN uw_master wl ON wl.uw_id = f.uw_last {_SLOT_JOINS})"""

_ROLE = {"agent_uid": "ra", "sub_agent_uid": "rs", "job_assigning": "rj", "portfolio_manager": "rp"}
_AGENT_COLS = ", ".join(f"{'rs' if 'sub_agent' in src else 'ra'}.{src.replace('_sub_agent', '').replace('_agent', '')}_user AS {n}" for n, src in lead.AGENT_RESULTS.items())
_ADDR = """trim(coalesce(u.address, '') || ' ' || coalesce(u."add", '') || ' ' || coalesce(u.add2, '') || ' ' || coalesce(u.landmark, ''))"""
_FC = fv.DEVIATION_CLASSES


def _state(alias):
    return f"CASE upper(trim({alias}.cnd_name)) " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in fv.CANONICAL_STATES.items()) + f" ELSE upper(trim({alias}.cnd_name)) END"


def _label(alias):
    return title(f"trim({alias}.cnd_name)")


_DICT_JOINS = " ".join(f"LEFT JOIN dct {a} ON {a}.id = {code} AND {a}.{group}" for a, code, group in (
    ("d_sub", "l.loan_sub_type_cnd", "cnd_group IN ('MAIN_LOAN_TYPE', 'FIP_TYPE', 'INDIA_SUB_LOAN', 'MLP_PLAN_BORROWER')"),
    ("d_org", "u.origin_state_cnd", "cnd_group IN ('STATE_INDIA', 'LOAN_CITY')"), ("d_st", "u.state_cnd", "cnd_group IN ('STATE_INDIA', 'LOAN_CITY')"),
    ("d_rel", "u.religion_cnd", "cnd_group = 'INDIA_RELIGION'"), ("d_cas", "u.caste_cnd", "cnd_group LIKE 'RELIGION%'"), ("d_mt", "u.mothertounge_cnd", "cnd_group = 'INDIA_MOTHERTONGUE'")))
_AGE = "datediff('day', {dob}, {at}) // 365"
_PASS_U = [c for c in lead.PASS_THROUGH_USER if c != "email_org_user"]
_PASS_L = [c for c in lead.PASS_THROUGH_LOAN if c not in ("tenure", "rate_expected", "rate_min_approved", "rate_max_approved", "risk_bucket", "loan_sub_staus", "live_date")]
_CONTACTS = ["permannent_address", "permannent_contact", "permannent_contact1", "permannent_address_1", "permannent_contact_1", "permannent_contact1_1"]
_REFS = [f"ref_{k}{f'_{n}' if n else ''}" for n in range(8) for k in ("name", "contact")]
_ENACH = ["mandate_link_created", "enach_first_link_created_date", "enach_active_subscription_date", "mandate_active", "icici_mandate_link_created", "icici_mandate_active",
          "icici_mandate_first_created_date", "icici_mandate_active_date", "mandate_status", "enach_approved_date", "mandate_id"]
_NACH = ["bankholder", "emailid", "mobile", "bank", "branch", "accountno", "account_type", "ifsccode", "umrn", "created", "start_date", "end_date", "reason", "status", "source"]

WIDE = f"""SELECT l.id AS loan_id, upper(coalesce(l.product_type, 'Others')) AS product_type, {title("trim(coalesce(lb.loan_type, 'Others'))")} AS loan_type,
  {title("trim(coalesce(d_sub.cnd_name, 'Others'))")} AS loan_subtype,
  'Others' AS loan_othertype, lb.loan_currentstate, pr.portfolio_type AS pf, l.uid AS user_id, rl.rule_pass_date AS rp0, rl.rule_reject_date AS rr0, {', '.join('l.' + c for c in _PASS_L)},
  lb.rate_expected, lb.rate_min_approved, lb.rate_max_approved, {between_sql('lb.rate_max_approved', [(12, '1.Premium')] + [(e + 0.001, n) for e, n in fv.RISK_RATE_LE], 'Unrated')} AS risk_bucket, lb.loan_sub_staus, lb.live_date,
  {', '.join('u.' + c for c in _PASS_U)}, me.email_org_user, uw.allocated_date, uw.accepted_date, uw.livec_date AS actual_live_date, uw.rfd_date, pr.f AS first_proposal_date, pr.t AS last_proposal_date, pr.amount AS proposal_amount,
  coalesce(ds.first_disburse_date, pr.f) AS first_disburse_date, coalesce(ds.last_disburse_date, pr.t) AS last_disburse_date, coalesce(ds.disburse_amount, pr.amount) AS disburse_amount,
  tm.tenure_months, tm.tenure AS tenure_monthsno, lb.cl_created AS loan_registered_date, {day_sql('l.udated')} AS loan_updated_date, up.namec_user AS loan_updatedby_name, up.mobile_user AS loan_updatedby_mobile,
  up.landline_user AS loan_updatedby_landline, up.email_user AS loan_updatedby_email, uw.uw_name, uw.uw_assigned_date, {', '.join(f"CASE WHEN uw.a IS NOT NULL THEN uw.uw_{n} END AS uw_{n}, CASE WHEN uw.a IS NOT NULL THEN uw.uw_{n}_date END AS uw_{n}_date" for n in fv.UW_SLOTS)},
  ops.ops_remark, ops.ops_reason, {title("trim(coalesce(lb.loan_city, ''))")} AS loan_city, l.original_loan_amt AS loan_original_amount, {title("trim(coalesce(u.fname, '') || ' ' || coalesce(u.lname, ''))")} AS user_name,
  u.fname AS user_fname, u.lname AS user_lname, nullif(regexp_extract(upper(trim(right(trim(regexp_replace(lower(u.pan), '{tokens_sql(fv.ID_STATUS_TOKENS)}', '', 'g')), 10))), '[A-Z]{{5}}[0-9]{{4}}[A-Z]'), '') AS user_pan,
  tu.score AS cibil_score, cr.score AS crif_score, cr.day AS crif_score_date, TRY_CAST(l.bureau_code AS INT) AS bureau_score, {day_sql('u.dob')} AS user_dob,
  regexp_replace({title(_ADDR)}, '  +', ' ', 'g') AS user_fulladdress, u.address AS user_address, u."add" AS user_address1, u.add2 AS user_address2, u.landmark AS user_landmark, u.pin AS user_pin,
  coalesce(g.city_pin, '') AS user_city, coalesce(g.district, '') AS user_district, g.state AS pin_state, {_state('d_org')} AS user_origion_state, {_state('d_st')} AS user_input_state, coalesce(g.zone, '') AS user_zone,
  u.city AS user_input_city, coalesce(g.city_pin, u.city) AS user_final_city, u.mobile AS user_mobile, {phone_sql('u.mobile')} AS bor_mobile, u.landline AS user_landline, {phone_sql('u.landline')} AS bor_landline,
  me.email_user AS user_email, {day_sql('u.created')} AS user_created_date, {day_sql('u.udated')} AS user_updated_date,
  {', '.join(f"{a}.{src}_user AS {p}_{s}" for p, a in (('user_jobassigned', 'rj'), ('user_portfoliomanager', 'rp')) for s, src in (('name', 'namec'), ('mobile', 'mobile'), ('landline', 'landline'), ('email', 'email')))},
  CASE WHEN ch.sub_category = 'Afinoz' THEN 'Afinoz' ELSE ra.namec_user END AS user_agent_name, {_AGENT_COLS}, ch.channel AS ch, ch.sub_category AS sub, ch.category AS cat,
  {_label('d_rel')} AS user_religion, {_label('d_cas')} AS user_caste, {_label('d_mt')} AS user_mothertounge,
  coalesce(u.gender, 'Unknown') AS gender, CASE {' '.join(f"WHEN u.highest_education IN ({', '.join(repr(c) for c in codes)}) THEN '{label}'" for codes, label in fv.EDUCATION_LEVELS)} ELSE 'Unknown' END AS highest_education,
  eav.* EXCLUDE (loan_id), bal.monthly_average_balance, {', '.join('det.field1 AS user_devicename' if c == 'field1' else f'det.{c}' for c in lead.LOAN_DETAIL_COLUMNS)},
  coalesce(det.residence_type, 'Unknown') AS residence_type, coalesce(job.employement_type, 'Unknown') AS employement_type, {', '.join('job.' + c for c in JOB_COLS)}, idn.* EXCLUDE (loan_id), l.reference_id AS referenceid_loan,
  {title("trim(coalesce(ru.fname, '') || ' ' || coalesce(ru.lname, ''))")} AS rn1, {title("trim(coalesce(ru.fname, ''))")} AS rn2, ru.uid AS ruid, ru.mobile AS loan_main_borrower_mobile, ru.landline AS loan_main_borrower_landline, rpl.email_user AS loan_main_borrower_email,
  {', '.join('refs.' + c for c in _REFS)}, {', '.join('perms.' + c for c in _CONTACTS)}, coalesce(u.plus, 0) AS plus, u."minus" AS call_stat, coalesce(fl.fraud_flag, 0) AS fraud_flag, coalesce(fl.ignore_flag, 0) AS ignore_flag, coalesce(fl.ex360_npa, 0) AS ex360_npa,
  uw.cancelled_created AS cancelled_date, uw.foreclosure_created, {', '.join('mn.' + c for c in _ENACH)}, {', '.join('mn.nach_' + c for c in _NACH)}, chq.* EXCLUDE (loan_id),
  pdev.namec_user AS dev_created_by, devs.dev_exists, devs.total_dev, {', '.join('devs.' + n for n, _, _ in _FC)}, {', '.join('acct.' + c for c in lead.ACCOUNT_COLUMNS)},
  fees.registration_fees, fees.processing_fees, uw.ba_uid, uw.preuw_uid, u.source AS src
FROM s4"""

# The joins in steps of a dozen; each joined row travels on as one struct column.
STEPS = {
    "s1": """SELECT l, u, lb, me, up, ra, rs, rj, rp FROM raw_loans l JOIN raw_users u ON u.uid = l.uid LEFT JOIN lbase lb ON lb.loan_id = l.id LEFT JOIN people me ON me.uid = u.uid
  LEFT JOIN people up ON up.uid = l.updated_by """ + " ".join(f"LEFT JOIN people {a} ON {a}.uid = u.{k}" for k, a in _ROLE.items()),
    "s2": f"""SELECT s1.*, ru, rpl, ch, tm, g, job, acct, d_sub, d_org, d_st, d_rel, d_cas, d_mt FROM s1 LEFT JOIN raw_users ru ON ru.uid = l.reference_id LEFT JOIN people rpl ON rpl.uid = ru.uid
  LEFT JOIN chan ch ON ch.source_key = lower(trim(u.source)) AND trim(u.source) <> '' LEFT JOIN tenure_master tm ON tm.tenure_code = l.tenure LEFT JOIN geo g ON g.pincode = u.pin
  LEFT JOIN job ON job.uid = u.uid LEFT JOIN acct ON acct.uid = u.uid {_DICT_JOINS}""",
    "s3": f"""SELECT s2.*, ds, pr, tu, cr, uw, ops, refs, perms, eav FROM s2 LEFT JOIN disb ds ON ds.loan_id = l.id
  LEFT JOIN (SELECT loan_id, min(day) AS f, max(day) AS t, {money('sum(cp_amount)')} AS amount, {tag_sql()} AS portfolio_type FROM collected GROUP BY loan_id) pr ON pr.loan_id = l.id
  """ + " ".join(f"LEFT JOIN {a} ON {a}.loan_id = l.id" for a in ("tu", "cr", "uw", "ops", "refs", "perms", "eav")),
    "s4": "SELECT s3.*, devs, pdev, bal, det, idn, mn, chq, rl, fl, fees FROM s3 LEFT JOIN rules rl ON rl.loan_id = l.id LEFT JOIN flags fl ON fl.loan_id = l.id "
          + " ".join(f"LEFT JOIN {a} ON {a}.loan_id = l.id" for a in ("devs", "bal", "det", "idn", "mn", "chq", "fees")) + " LEFT JOIN people pdev ON pdev.uid = devs.dev_created_by",
}

_DERIVED = f"""SELECT *, CASE WHEN pf IS NOT NULL THEN pf WHEN loan_registered_date < DATE '2020-09-01' THEN 'Non-FD' WHEN coalesce(source, '') = 'IMB' THEN 'INDMoney' ELSE 'FD' END AS portfolio_type,
  CASE WHEN rp0 >= loan_registered_date AND (actual_live_date IS NULL OR rp0 <= actual_live_date) THEN rp0 END AS rule_pass_date, CASE WHEN rr0 >= loan_registered_date AND (actual_live_date IS NULL OR rr0 <= actual_live_date) THEN rr0 END AS rule_reject_date,
  CAST(date_trunc('month', first_proposal_date) AS DATE) AS first_proposal_month, CAST(date_trunc('month', last_proposal_date) AS DATE) AS last_proposal_month, CAST(date_trunc('month', first_disburse_date) AS DATE) AS first_disburse_month,
  CAST(date_trunc('month', last_disburse_date) AS DATE) AS last_disburse_month, {_AGE.format(dob='user_dob', at='loan_registered_date')} AS age_loanregister, {_AGE.format(dob='user_dob', at=D)} AS age_current,
  coalesce(pin_state, user_origion_state, '') AS user_state, coalesce(pin_state, user_input_state, user_origion_state) AS user_final_state, CASE WHEN ruid IS NOT NULL THEN rn1 END AS loan_main_borrower_name, CASE WHEN ruid IS NOT NULL THEN rn2 END AS loan_main_borrower_first_name,
  CASE WHEN loan_currentstate = 'Foreclosure Initiated' THEN foreclosure_created END AS foreclosure_initiated_date, CASE WHEN cancelled_date >= actual_live_date AND loan_currentstate = 'Cancelled' THEN cancelled_date END AS delist_date,
  CASE WHEN nach_status = 'Final Approved' AND coalesce(nach_end_date, DATE '9999-12-31') >= DATE '1998-06-30' THEN mandate_status WHEN cheque_available > 1 THEN 'PDC' ELSE 'Online' END AS payment_registration_method,
  CASE WHEN user_agent_name IS NOT NULL AND coalesce(ch, 'Marketing') = 'Marketing' THEN 'DSA Partner' WHEN product_type = 'IMB' THEN 'Aggregator' ELSE ch END AS channel,
  CASE WHEN user_agent_name IS NOT NULL AND coalesce(ch, 'Marketing') IN ('Marketing', 'DSA Partner') THEN user_agent_name WHEN product_type = 'IMB' THEN 'IndMoney' ELSE sub END AS sub_category,
  CASE WHEN user_agent_name IS NOT NULL AND coalesce(ch, 'Marketing') = 'Marketing' THEN 'DSA' WHEN product_type = 'IMB' THEN 'Aggregator' ELSE cat END AS category FROM wide"""

# Latest of the four moves; ties and later stops leave the assignment in place.
_WHO = ["returned", "forward_to_cs", "cancelled", "live"]
_TOP = "greatest(" + ", ".join(f"coalesce(uw_{n}_date, TIMESTAMP '1900-01-01')" for n in _WHO) + ")"
_NTOP = " + ".join(f"(CASE WHEN uw_{n}_date = {_TOP} THEN 1 ELSE 0 END)" for n in _WHO)
_FINAL = f"""SELECT w.*, {_TOP} AS top, CASE WHEN {_NTOP} = 1 AND {_TOP} >= uw_assigned_date THEN CASE {' '.join(f"WHEN uw_{n}_date = {_TOP} AND {'TRUE' if n == 'live' else f'coalesce(rfd_date < {_TOP}, TRUE)'} THEN '{n}'" for n in _WHO)} END END AS win,
  coalesce(uw_returned_date, uw_forward_to_cs_date, uw_cancelled_date, uw_live_date) IS NOT NULL AS moved, product_type IN ('NST', 'POCKETLY', 'POCKET_LOAN', 'IMB') AS skip,
  coalesce(rfd_date IS NOT NULL AND (rfd_date >= uw_assigned_date OR first_disburse_date IS NOT NULL), FALSE) AS ready,
  coalesce(delist_date >= uw_assigned_date AND loan_currentstate = 'Cancelled' AND uw_live_date IS NOT NULL, FALSE) AS dropped,
  CASE WHEN rule_pass_date IS NULL THEN rule_reject_date WHEN rule_reject_date IS NULL OR rule_reject_date < rule_pass_date THEN rule_pass_date ELSE rule_reject_date END AS mx,
  coalesce(loan_img1 IN ('REFER', 'APPROVED', 'APPROVED_STPQ'), FALSE) AS pre, s.partner_uid AS sp, s.rep AS srep, m.partner_uid AS mp, m.rep AS mrep, o.rm_others, dd.cnd_name AS disp,
  {', '.join(f'{a}.{c} AS {w}_{n}' for w, a in (('ba', 'pb'), ('preuw', 'pp')) for n, c in lead.AGENT_FIELDS.items())}
FROM derived w LEFT JOIN reps s ON s.partner_uid = w.sub_agent_uid LEFT JOIN reps m ON m.partner_uid = w.agent_uid LEFT JOIN owners o ON o.source_name = lower(w.source)
LEFT JOIN (SELECT * FROM dictionary WHERE cnd_group = 'DISPOSITION' AND deleted = 'N') dd ON dd.cnd_code = CAST(w.plus AS VARCHAR) LEFT JOIN people pb ON pb.uid = w.ba_uid LEFT JOIN people pp ON pp.uid = w.preuw_uid"""

_STATUS = """CASE WHEN skip THEN 'UW Not Assigned' WHEN moved AND win = 'returned' THEN 'Returned' WHEN moved AND win = 'forward_to_cs' THEN 'Forward to CS' WHEN moved AND win = 'cancelled' THEN 'Cancelled'
  WHEN moved AND (win = 'live' OR ready) THEN 'Live' WHEN moved AND dropped THEN 'Cancelled' WHEN uw_assigned_date IS NULL THEN 'UW Not Assigned' ELSE 'Assigned' END"""
_UPDATED = ("CASE WHEN skip THEN NULL WHEN moved AND win IS NOT NULL THEN top WHEN moved AND ready THEN rfd_date WHEN moved AND dropped THEN delist_date "
            "ELSE uw_assigned_date END")
# Decimal means: six places per month, ten over the months.
BALANCE = f"""SELECT loanid AS loan_id, CAST(round(avg(a), 10) AS DECIMAL(26,10)) AS monthly_average_balance FROM (SELECT loanid, a, row_number() OVER (PARTITION BY loanid ORDER BY m DESC NULLS LAST) AS rn
  FROM (SELECT loanid, date_trunc('month', d) AS m, round(avg(CAST(monthly_amount AS DOUBLE)), 6) AS a FROM (
    SELECT b.loanid, b.monthly_amount, CAST(try_strptime(CAST(CASE WHEN m <= month(c) THEN year(c) ELSE year(c) - 1 END AS VARCHAR) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-'
      || lpad(regexp_extract(date_cnd, '[0-9]+'), 2, '0'), '%Y-%m-%d') AS DATE) AS d
    FROM (SELECT *, instr('Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec', {title('month')}) // 4 + 1 AS m FROM bank_months WHERE deleted = 'N') b
    JOIN (SELECT id, {day_sql('created')} AS c FROM raw_loans) l ON l.id = b.loanid) GROUP BY ALL)) WHERE rn <= 3 GROUP BY loanid"""
_HELPERS = ("pf rp0 rr0 pin_state rn1 rn2 ruid foreclosure_created src ch sub cat top win moved skip ready dropped mx pre sp srep mp mrep rm_others disp st").split()
LEAD_SQL = f"""WITH dct AS MATERIALIZED (SELECT id, cnd_name, cnd_group FROM dictionary WHERE deleted = 'N'), {', '.join(f'{k} AS MATERIALIZED ({part(q)})' for k, q in PARTS.items())}, bal AS MATERIALIZED ({BALANCE}), idn AS MATERIALIZED ({IDENT}), job AS MATERIALIZED ({JOB}), mn AS MATERIALIZED ({MANDATE}),
uw AS MATERIALIZED ({UW}), tu AS MATERIALIZED ({_SCORE_TU}), cr AS MATERIALIZED ({_SCORE_CRIF}), {', '.join(f'{k} AS MATERIALIZED ({v})' for k, v in STEPS.items())}, wide AS MATERIALIZED ({WIDE}), derived AS MATERIALIZED ({_DERIVED}), fin AS MATERIALIZED (SELECT *, {_STATUS} AS st FROM ({_FINAL}))
SELECT * EXCLUDE ({', '.join(_HELPERS)}), {D} AS report_datetime, CASE WHEN rule_pass_date IS NOT NULL THEN 1 END AS rule_pass, CASE WHEN rule_reject_date IS NOT NULL THEN 1 END AS rule_reject,
  {between_sql('age_loanregister', upto(fv.GENERATION_LE), None, missing='Unknown')} AS generations,
  CASE WHEN payment_registration_method = 'PDC' THEN 'Reliable Data Services' WHEN payment_registration_method = 'Online' THEN 'Not Known' WHEN icici_mandate_active = 1 THEN 'E-MANDATE thru ICICI'
       WHEN mandate_active = 1 THEN 'E-MANDATE thru CASHFREE' ELSE 'MANDATE - Manual' END AS payment_registration_vendor,
  CASE WHEN sp IS NOT NULL THEN srep WHEN mp IS NOT NULL THEN mrep WHEN rm_others IS NOT NULL THEN rm_others WHEN channel = 'Marketing' THEN 'Call_Center' END AS rm,
  CASE WHEN disp IS NULL AND plus IN (0, 30) THEN '' {' '.join(f"WHEN plus = {k} THEN '{v}'" for k, v in fv.DISPOSITION_OVERRIDES.items())} ELSE disp END AS call_disposition,
  CASE call_stat WHEN 0 THEN 'Open' WHEN 1 THEN 'Valid' WHEN 2 THEN 'Invalid' END AS call_status,
  CASE WHEN skip THEN 'UW Not Assigned' WHEN moved AND win IS NOT NULL THEN CASE win {' '.join(f"WHEN '{n}' THEN uw_{n}" for n in _WHO)} END WHEN uw_assigned_date IS NULL THEN 'UW Not Assigned' ELSE uw_name END AS uw_name_final,
  st AS uw_status_final, {_UPDATED} AS uw_updated_date,
  CASE WHEN first_disburse_date IS NOT NULL OR pre OR mx IS NOT NULL THEN 1 ELSE 0 END AS rule_executed_flag,
  CASE WHEN first_disburse_date IS NOT NULL OR pre THEN 1 WHEN rule_pass_date IS NOT NULL THEN CASE WHEN coalesce(rule_reject_date <= rule_pass_date, TRUE) THEN 1 ELSE 0 END WHEN rule_reject_date IS NOT NULL THEN 0 END AS pq_approved_flag,
  CASE WHEN first_disburse_date IS NOT NULL AND (mx IS NULL OR first_disburse_date <= mx) THEN first_disburse_date WHEN first_disburse_date IS NOT NULL OR pre THEN mx
       WHEN rule_pass_date IS NOT NULL AND coalesce(rule_reject_date <= rule_pass_date, TRUE) THEN rule_pass_date END AS pq_approved_date,
  CASE WHEN first_disburse_date IS NOT NULL THEN 1 ELSE 0 END AS disbursed_flag,
  CASE WHEN CASE WHEN skip THEN 'UW Not Assigned' WHEN moved AND win IS NOT NULL THEN CASE win {' '.join(f"WHEN '{n}' THEN uw_{n}" for n in _WHO)} END WHEN uw_assigned_date IS NULL THEN 'UW Not Assigned' ELSE uw_name END <> 'UW Not Assigned' THEN 1 ELSE 0 END AS uw_allocated_flag,
  CASE WHEN st = 'Cancelled' THEN 1 ELSE 0 END AS uw_cancelled_flag, CASE WHEN st = 'Returned' THEN 1 ELSE 0 END AS uw_returned_flag, CASE WHEN st = 'Forward to CS' THEN 1 ELSE 0 END AS uw_forward_to_cs_flag,
  CASE WHEN st = 'Live' THEN 1 ELSE 0 END AS uw_live_flag, CASE WHEN st = 'Live' AND loan_currentstate = 'Cancelled' AND delist_date > {_UPDATED} THEN 1 ELSE 0 END AS delist_flag FROM fin"""


def full_oracle() -> str:
    """The whole mart as one DuckDB statement."""
    return views.oracle(LEAD_SQL, *ALL_USES.split(), materialize=True)


@query("lead_details", uses=ALL_USES, materialize=True, sql=LEAD_SQL)
def _(i):
    return lead.lead_details(catalog(i), AS_OF, SITE)


_B_PARTS = {"people": "people_dimension", "chan": "channel_dimension", "lbase": "loan_base", "disb": "disbursement_rollup"}
_B_USES = " ".join(dict.fromkeys(("raw_loans raw_users dictionary geo crif_scores tu_scores " + " ".join(RAW[q][1] for q in _B_PARTS.values())).split()))
_B_AGE = _AGE.format(dob=day_sql("u.dob"), at="lb.cl_created")


@query("lead_borrower", uses=_B_USES, materialize=True, sql=f"""
WITH dct AS MATERIALIZED (SELECT id, cnd_name, cnd_group FROM dictionary WHERE deleted = 'N'), {', '.join(f'{k} AS MATERIALIZED ({part(q)})' for k, q in _B_PARTS.items())},
tu AS MATERIALIZED ({_SCORE_TU}), cr AS MATERIALIZED ({_SCORE_CRIF})
SELECT l.id AS loan_id, lb.cl_created AS lead_registered_date, {title("trim(coalesce(lb.loan_type, 'Others'))")} AS loan_type, {title("trim(coalesce(d_sub.cnd_name, 'Others'))")} AS loan_subtype, 'Others' AS loan_othertype,
  upper(coalesce(l.product_type, 'Others')) AS product_type, lb.loan_currentstate AS lead_current_status, l.loan_desc AS lead_description, l.uid AS borrower_id,
  {between_sql('lb.rate_max_approved', [(12, '1.Premium')] + [(e + 0.001, n) for e, n in fv.RISK_RATE_LE], 'Unrated')} AS risk_bucket, {title("trim(coalesce(u.fname, '') || ' ' || coalesce(u.lname, ''))")} AS borrower_name,
  nullif(regexp_extract(upper(trim(right(trim(regexp_replace(lower(u.pan), '{tokens_sql(fv.ID_STATUS_TOKENS)}', '', 'g')), 10))), '[A-Z]{{5}}[0-9]{{4}}[A-Z]'), '') AS borrower_pan,
  tu.score AS cibil_score, cr.score AS crif_score, {day_sql('u.dob')} AS borrower_dob, {_B_AGE} AS borrower_age_loandate, {between_sql('(' + _B_AGE + ')', upto(fv.GENERATION_LE), None, missing='Unknown')} AS borrower_generation,
  regexp_replace({title(_ADDR)}, '  +', ' ', 'g') AS borrower_address, u.pin AS borrower_pin, coalesce(g.city_pin, '') AS borrower_city, coalesce(g.district, '') AS borrower_district,
  coalesce(g.state, {_state('d_org')}, '') AS borrower_state, coalesce(g.zone, '') AS borrower_zone, coalesce(g.city_pin, u.city) AS borrower_final_city, coalesce(g.state, {_state('d_st')}, {_state('d_org')}) AS borrower_final_state,
  {_state('d_org')} AS borrower_origion_state, u.mobile AS borrower_mobile, u.landline AS borrower_landline, me.email_user AS borrower_email, {day_sql('u.created')} AS borrower_created_date,
  rj.namec_user AS borrower_jobassigned_name, rj.mobile_user AS borrower_jobassigned_mobile, rj.email_user AS borrower_jobassigned_email, CASE WHEN ch.sub_category = 'Afinoz' THEN 'Afinoz' ELSE ra.namec_user END AS borrower_agent_name,
  ra.mobile_user AS borrower_agent_mobile, ra.email_user AS borrower_agent_email, coalesce(u.gender, 'Unknown') AS borrower_gender, u.aadhaar_number AS borrower_adhaarnumber, u.spouse AS borrower_spouse_name,
  u.father AS borrower_father_name, u.mother AS borrower_mother_name, CASE WHEN ru.uid IS NOT NULL THEN {title("trim(coalesce(ru.fname, ''))")} END AS loan_main_borrower_first_name,
  CASE WHEN ru.uid IS NOT NULL THEN {title("trim(coalesce(ru.fname, '') || ' ' || coalesce(ru.lname, ''))")} END AS loan_main_borrower_name, ru.mobile AS loan_main_borrower_mobile, ru.landline AS loan_main_borrower_landline,
  rpl.email_user AS loan_main_borrower_email
FROM raw_loans l JOIN raw_users u ON u.uid = l.uid LEFT JOIN lbase lb ON lb.loan_id = l.id LEFT JOIN people me ON me.uid = u.uid LEFT JOIN people ra ON ra.uid = u.agent_uid LEFT JOIN people rj ON rj.uid = u.job_assigning
LEFT JOIN raw_users ru ON ru.uid = l.reference_id LEFT JOIN people rpl ON rpl.uid = ru.uid LEFT JOIN chan ch ON ch.source_key = lower(trim(u.source)) AND trim(u.source) <> '' LEFT JOIN geo g ON g.pincode = u.pin
LEFT JOIN dct d_sub ON d_sub.id = l.loan_sub_type_cnd AND d_sub.cnd_group IN ('MAIN_LOAN_TYPE', 'FIP_TYPE', 'INDIA_SUB_LOAN', 'MLP_PLAN_BORROWER')
LEFT JOIN dct d_org ON d_org.id = u.origin_state_cnd AND d_org.cnd_group IN ('STATE_INDIA', 'LOAN_CITY') LEFT JOIN dct d_st ON d_st.id = u.state_cnd AND d_st.cnd_group IN ('STATE_INDIA', 'LOAN_CITY')
LEFT JOIN tu ON tu.loan_id = l.id LEFT JOIN cr ON cr.loan_id = l.id""")
def _(i):
    return lead.lead_borrower(lead.LeadMart(catalog(i), AS_OF, SITE))
