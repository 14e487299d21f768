"""Views over the given tables that stand for the operational sources.

Every view is one SELECT that Spark and DuckDB both understand, so a query and its SQL
counterpart start from identical rows.  ``{orders}`` etc. are the given tables; views are
referenced by name.  ``{dayno}x)`` is the number of days since 1970-01-01.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

AS_OF = "1998-06-15"
AS_OF_LATE = "1998-06-27"
EVENTS_AS_OF = "2024-01-20"



def _local_epoch(day: str, seconds: str = "3600") -> str:
    return "(({dayno}" + day + ")) * 86400 - 19800 + " + seconds + ")"


def _utc_epoch(day: str, seconds: str = "3600") -> str:
    return "(({dayno}" + day + ")) * 86400 + " + seconds + ")"


SHIP = "CAST(l_shipdate AS DATE)"
ORDERED = "CAST(o_orderdate AS DATE)"
TS = ("(({dayno}CAST(ts AS DATE))) * 86400 + CAST(hour(ts) AS BIGINT) * 3600 + minute(ts) * 60"
      " + CAST(floor(second(ts)) AS BIGINT))")
ACTOR = "CAST(replace(replace(props, '{{\"k\": ', ''), '}}', '') AS BIGINT)"
# A day per customer between 1995-06-01 and 1997-05-01.
REGISTERED = "(DATE '1995-06-01' + CAST(c_custkey % 700 AS INT))"
# Three loans share a user; every customer row is a user of its own.
USER = "(100000 + c_custkey)"
UID = "(100000 + CAST(floor(c_custkey / 3) AS BIGINT))"



def _person(key: str, hot: int) -> str:
    """A number of persons that grows with the key; one key in ``hot`` belongs to the same person."""
    return f"(CASE WHEN {key} % {hot} = 3 THEN 7 ELSE {key} END)"


def _national_id(key: str, hot: int) -> str:
    k = _person(key, hot)
    letter = lambda size: f"chr(65 + CAST(floor({k} / {size}) % 26 AS INT))"
    return f"'ABC' || {letter(260000)} || {letter(10000)} || lpad(CAST({k} % 10000 AS VARCHAR(10)), 4, '0') || 'K'"


def _phone(key: str, hot: int) -> str:
    return f"'8' || lpad(CAST({_person(key, hot)} AS VARCHAR(10)), 9, '0')"


VIEWS: dict[str, str] = {}

# Accounts ending in 0 are settled and over before 1998; those ending in 1 lie in the future.  Their days and
# states are moved, so that no row is left out.
DUE = (f"({SHIP} + CASE WHEN o_custkey % 10 = 0 AND {SHIP} > DATE '1998-01-01' THEN -1461 "
       f"WHEN o_custkey % 10 = 1 AND {SHIP} <= DATE '{AS_OF}' THEN 1461 ELSE 0 END)")
VIEWS["inst_rows"] = f"""
  SELECT o_custkey AS loan_id, l_suppkey AS lender, {DUE} AS due, least({ORDERED}, {DUE}) AS created,
         {DUE} + CAST(l_linenumber * 7 - 10 AS INT) AS updated,
         CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN 'closed'
              WHEN l_linestatus = 'O' AND o_custkey % 10 <> 0 AND {DUE} >= DATE '{AS_OF}' - CAST(o_custkey % 240 AS INT) THEN 'due'
              ELSE 'paid' END AS state,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2))
              - CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))
              AS DECIMAL(18,2)) AS principal,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS interest,
         l_linenumber AS line, CAST(l_orderkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(2)) || '-' || CAST(l_partkey AS VARCHAR(20))
           || '-' || CAST(l_suppkey AS VARCHAR(20)) || '-' || CAST({SHIP} AS VARCHAR(10)) || '-' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR(20)) AS row_id
  FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey"""

VIEWS["inst"] = "SELECT loan_id, lender, due, created, updated, state, amount, principal, interest, line FROM inst_rows"

# Source rows repeat: the second line of every order comes twice.
_RAW = f"""
SELECT row_id AS id, loan_id, lender AS uid_l, {_local_epoch('due', 'line * 3600')} AS due_date,
       {_local_epoch('created')} AS created, {_local_epoch('updated', '86399')} AS udated,
       amount, principal, interest, state AS emi_state,
       CASE WHEN line = 7 AND lender % 13 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM inst_rows"""
VIEWS["raw_installments"] = f"{_RAW} UNION ALL {_RAW} WHERE line = 2"

# A source without row ids, with a note that no mart reads: the second line comes twice, the third again a second
# later (another installment of the same day), the fourth again with another note; some days are missing.
_IDLESS = f"""
SELECT loan_id, lender AS uid_l, CASE WHEN line = 6 AND lender % 7 = 0 THEN NULL ELSE {_local_epoch('due', 'line * 3600')} END AS due_date,
       {_local_epoch('created')} AS created, CASE WHEN line = 5 AND lender % 3 = 0 THEN NULL ELSE {_local_epoch('updated', '80000 + again')} END AS udated,
       amount, principal, interest, state AS emi_state, CASE WHEN line = 7 AND lender % 13 = 0 THEN 'Y' ELSE 'N' END AS deleted,
       'note ' || CAST(remark AS VARCHAR(2)) AS note
FROM"""
VIEWS["raw_installments_idless"] = " UNION ALL ".join(
    f"{_IDLESS} (SELECT *, {again} AS again, {remark} AS remark FROM inst_rows{where}) AS r{k}"
    for k, (again, remark, where) in enumerate(((0, 0, ""), (0, 0, " WHERE line = 2"), (1, 0, " WHERE line = 3"), (0, 1, " WHERE line = 4"))))

# The same rows for Spark, which would join the tables anew for each of these parts: one join, whose rows are repeated.
_COPIES = {2: ((0, 0), (0, 0)), 3: ((0, 0), (1, 0)), 4: ((0, 0), (0, 1))}
SPARK_VIEWS = {
    "raw_installments": f"{_RAW} LATERAL VIEW explode(CASE WHEN line = 2 THEN array(0, 1) ELSE array(0) END) c AS copy",
    "raw_installments_idless": f"{_IDLESS} (SELECT * FROM inst_rows LATERAL VIEW inline(CASE line "
    + " ".join(f"WHEN {n} THEN array({', '.join(f'struct({a} AS again, {r} AS remark)' for a, r in pairs)})" for n, pairs in _COPIES.items())
    + " ELSE array(struct(0 AS again, 0 AS remark)) END) c AS again, remark) AS r"}

# The same installments as a mart sees them.
_DAY = "(DATE '1970-01-01' + CAST(floor(({0} + 19800) / 86400) AS INT))"
VIEWS["idless_inst"] = f"""
SELECT loan_id, uid_l AS lender, {_DAY.format('due_date')} AS due, {_DAY.format('created')} AS created, {_DAY.format('udated')} AS updated,
       emi_state AS state, amount, principal, interest
FROM (SELECT DISTINCT * FROM raw_installments_idless WHERE deleted = 'N') AS r"""

# The installments a mart sees: those not soft-deleted.
VIEWS["live_inst"] = "SELECT * FROM inst WHERE NOT (line = 7 AND lender % 13 = 0)"

VIEWS["loans"] = f"""
SELECT o_orderkey AS loan_id, o_custkey AS borrower, {ORDERED} AS created,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderpriority AS product, o_orderstatus AS state
FROM {{orders}}"""

VIEWS["disbursements"] = f"""
SELECT l_orderkey AS loan_id, {SHIP} AS day, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM {{lineitem}}"""

VIEWS["payment_register"] = f"""
SELECT l_orderkey AS loan_id, CAST({_local_epoch(SHIP)} AS VARCHAR(20)) AS payment_instrument_date,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS instrument_amount,
       CASE WHEN l_suppkey % 17 = 3 THEN 8888888888 ELSE l_suppkey END AS pay_user_id,
       CASE l_returnflag WHEN 'A' THEN 'Paid' WHEN 'N' THEN 'Pending' ELSE 'Rejected' END AS payment_status,
       CASE WHEN l_linenumber = 7 THEN 'Y' ELSE 'N' END AS deleted
FROM {{lineitem}}"""

VIEWS["proposals"] = f"""
SELECT o_orderkey AS id, o_custkey AS loan_id, o_orderkey % 40 AS lender_uid,
       CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
       CASE WHEN o_orderpriority = '5-LOW' THEN '12000' ELSE '13000' END AS proposal_state,
       CASE WHEN o_orderstatus = 'P' THEN 'N' ELSE 'Y' END AS is_collected,
       {_utc_epoch(ORDERED)} AS created, {_utc_epoch(ORDERED, '7200')} AS udated, 'N' AS deleted
FROM {{orders}}"""

VIEWS["proposal_collections"] = f"""
SELECT CAST(l_orderkey AS VARCHAR(20)) AS proposal_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
       CASE WHEN l_returnflag = 'R' THEN '13500' ELSE '14000' END AS proposal_state,
       CASE WHEN l_linenumber = 6 THEN '1' ELSE '0' END AS is_declined,
       {_utc_epoch(SHIP)} AS created, {_utc_epoch(SHIP, '86399')} AS udated,
       CASE WHEN l_linenumber = 5 THEN 'Y' ELSE 'N' END AS deleted
FROM {{lineitem}}"""

# Accepted proposals joined to their collections, for the SQL side.
VIEWS["collected"] = f"""
SELECT o_custkey AS loan_id, o_orderkey % 40 AS lender, CAST(o_totalprice AS DECIMAL(18,2)) AS cp_amount, {SHIP} AS day
FROM {{orders}} JOIN {{lineitem}} ON o_orderkey = l_orderkey
WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P' AND l_returnflag <> 'R' AND l_linenumber NOT IN (5, 6)"""

VIEWS["transactions"] = """
SELECT l_orderkey AS loan_id, CASE l_linenumber WHEN 1 THEN 1358 WHEN 2 THEN 90133286 ELSE 77 END AS txn_type,
       CAST(l_extendedprice * l_tax AS DECIMAL(18,2)) AS txn_amount,
       CASE WHEN l_linestatus = 'F' THEN 200 ELSE 100 END AS txn_state,
       CASE WHEN l_suppkey % 10 = 9 THEN 'Y' ELSE 'N' END AS deleted
FROM {lineitem}"""

VIEWS["geo"] = """
SELECT n_nationkey AS pincode, n_name AS city_pin, n_name AS district, r_name AS state, substr(r_name, 1, 2) AS zone
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""

# Code dictionary: blocks of the nation table under different groups.
_BLOCKS = [
    (1000, "LOAN_CITY", "'Town ' || n_name"), (2000, "STATE_INDIA", "CASE WHEN n_nationkey % 5 = 0 THEN 'Tamilnadu' ELSE lower(n_name) END"),
    (3000, "INTREST_RATE", "CAST(10 + n_nationkey AS VARCHAR(10)) || '.5 %'"), (4000, "LOAN_STATE", "CASE n_nationkey WHEN 3 THEN 'foreclosure initiated' WHEN 4 THEN 'cancelled' ELSE 'state ' || lower(n_name) END"),
    (5000, "INDIA_LOAN", "' loan ' || n_name"), (6000, "EMPLOYMENT_TYPE", "CASE WHEN n_nationkey % 2 = 0 THEN 'salaried employee' ELSE 'self employed' END"),
    (7000, "INDIA_PROFESSION", "'job ' || n_name"), (8000, "RESIDENCE_TYPE", "'res ' || n_name"), (9000, "INDIA_RELIGION", "'rel ' || n_name"),
    (9100, "RELIGION_ONE", "'caste ' || n_name"), (9500, "DISPOSITION", "'disp ' || n_name"), (9800, "business_industry_type_new", "'ind ' || n_name"),
    (9900, "INDIA_MOTHERTONGUE", "'tongue ' || n_name"),
]
VIEWS["dictionary"] = " UNION ALL ".join(
    f"SELECT {base} + n_nationkey AS id, CAST(n_nationkey AS VARCHAR(10)) AS cnd_code, {name} AS cnd_name, "
    f"'{group}' AS cnd_group, CASE WHEN n_nationkey = 24 THEN 'Y' ELSE 'N' END AS deleted FROM {{nation}}"
    for base, group, name in _BLOCKS)

VIEWS["tenure_master"] = """
SELECT DISTINCT CAST(n_nationkey AS INT) AS tenure_code, CAST(n_nationkey + 6 AS VARCHAR(10)) || ' Months' AS tenure_months,
       CAST((n_nationkey % 8) * 6 AS INT) AS tenure FROM {nation}"""

VIEWS["raw_loans"] = f"""
SELECT c_custkey AS id, {UID} AS uid, CAST(c_custkey % 7 AS VARCHAR(10)) AS loan_state,
       CASE c_custkey % 4 WHEN 0 THEN 714 WHEN 1 THEN 1 ELSE 0 END AS loan_sub_state,
       'title' AS loan_title, CAST(c_acctbal AS DECIMAL(18,2)) AS loan_amount_expected, CAST(c_custkey % 24 AS INT) AS tenure,
       5000 + c_custkey % 30 AS loan_type_cnd, 'desc' AS loan_desc,
       CASE c_custkey % 5 WHEN 0 THEN 'APPROVED' WHEN 1 THEN 'REJECTED' END AS loan_img1,
       CASE c_custkey % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' END AS loan_img2,
       3000 + c_custkey % 22 AS loan_irate_expected, 3000 + c_custkey % 9 AS min_irate_apporved,
       3000 + c_custkey % 26 AS max_irate_approved, CAST(c_acctbal * 2 AS DECIMAL(18,2)) AS max_amount_approved,
       CASE WHEN c_custkey % 97 = 5 THEN 'Y' ELSE 'N' END AS deleted,
       {_local_epoch(REGISTERED)} AS created, {_local_epoch(REGISTERED + ' + 3')} AS udated,
       100000 + c_custkey % 50 AS updated_by,
       CASE c_custkey % 3 WHEN 0 THEN 'code ' || CAST(1000 + c_custkey % 27 AS VARCHAR(10)) WHEN 1 THEN 'plain town' END AS loan_city,
       'N' AS verified_personal, 'N' AS verified_professional, 0 AS percent_fund, '' AS editor_comment,
       0 AS document_pending, 0 AS underwriting_pending, 0 AS doc_verify, 0 AS delisting, 'low' AS risk,
       CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE {_local_epoch(REGISTERED + ' + 20')} END AS live_date,
       100000 + c_custkey % 20 AS reference_id, CAST(c_acctbal AS DECIMAL(18,2)) AS original_loan_amt,
       0 AS processing_fee, '' AS remark, 5000 + c_custkey % 11 AS loan_sub_type_cnd,
       CASE c_custkey % 9 WHEN 0 THEN 'imb' WHEN 1 THEN 'nst' WHEN 2 THEN 'personal' END AS product_type,
       0 AS total_settlement_amount, CAST(c_custkey % 19 AS INT) AS settlement_term,
       CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'NaN' ELSE CAST(600 + c_custkey % 200 AS VARCHAR(10)) END AS bureau_code,
       0 AS other_loan_type_cnd, 'tag' AS product_tag, 0 AS pd_value, 'x' AS pd_status
FROM {{customer}}"""

VIEWS["raw_users"] = f"""
SELECT {USER} AS uid, lower(c_mktsegment) AS fname, CAST(c_custkey AS VARCHAR(20)) AS lname,
       CASE c_custkey % 4 WHEN 0 THEN '+91-98' || lpad(CAST(c_custkey AS VARCHAR(10)), 8, '0')
                          WHEN 1 THEN '070' || lpad(CAST({_person("c_custkey", 40)} AS VARCHAR(10)), 8, '0')
                          WHEN 2 THEN '12345' ELSE {_phone("c_custkey", 50)} END AS mobile,
       CASE WHEN c_custkey % 2 = 0 THEN '0' || CAST(6000000000 + c_custkey AS VARCHAR(12)) END AS landline,
       CASE WHEN c_custkey % 8 = 0 THEN 'fc_invalid_' ELSE '' END || 'abcde'
         || lpad(CAST({_person("c_custkey", 40)} % 10000 AS VARCHAR(10)), 4, '0') || 'k' AS pan,
       {_local_epoch("(DATE '1955-01-01' + CAST(c_custkey * 31 % 17000 AS INT))")} AS dob,
       'addr ' || CAST(c_custkey AS VARCHAR(10)) AS address, 'block  ' || CAST(c_custkey % 31 AS VARCHAR(10)) AS "add", CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'lane ' || CAST(c_custkey % 37 AS VARCHAR(10)) END AS add2, 'near  park ' || CAST(c_custkey % 41 AS VARCHAR(10)) AS landmark,
       CAST(c_nationkey AS INT) AS pin, 'town ' || CAST(c_custkey % 43 AS VARCHAR(10)) AS city,
       CASE c_custkey % 5 WHEN 0 THEN 'IMB' WHEN 1 THEN lower(c_mktsegment) WHEN 2 THEN c_mktsegment WHEN 3 THEN '' END AS source,
       CASE WHEN c_custkey % 3 = 0 AND c_custkey % 4 = 0 THEN 100000 + c_custkey % 15 ELSE 0 END AS agent_uid,
       100000 + c_custkey % 12 AS sub_agent_uid, 100000 + c_custkey % 9 AS job_assigning, 100000 + c_custkey % 5 AS portfolio_manager,
       9000 + c_custkey % 28 AS religion_cnd, 9100 + c_custkey % 28 AS caste_cnd, 2000 + c_custkey % 30 AS origin_state_cnd,
       2000 + c_custkey % 25 AS state_cnd, 9900 + c_custkey % 25 AS mothertounge_cnd,
       CASE c_custkey % 6 WHEN 0 THEN 420 WHEN 1 THEN 301 WHEN 2 THEN 5 WHEN 3 THEN 30 END AS plus,
       CAST(c_custkey % 4 AS INT) AS "minus", {_local_epoch(REGISTERED)} AS created, {_local_epoch(REGISTERED)} AS udated,
       CASE WHEN c_custkey % 41 = 0 THEN 'Y' ELSE 'N' END AS deleted,
       'sp' || CAST(c_custkey % 47 AS VARCHAR(10)) AS spouse, 'fa' || CAST(c_custkey % 53 AS VARCHAR(10)) AS father, 'mo' || CAST(c_custkey % 59 AS VARCHAR(10)) AS mother, '1' || CAST(c_custkey % 61 AS VARCHAR(10)) AS aadhaar_number, 'single' || CAST(c_custkey % 2 AS VARCHAR(10)) AS marital_status,
       CASE WHEN c_custkey % 2 = 0 THEN 'Male' END AS gender, CAST(1 + c_custkey % 6 AS INT) AS reg_step, 'old' || CAST(c_custkey % 67 AS VARCHAR(10)) AS old_source, CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS mobile_verify,
       CAST(319 + CAST(floor(c_custkey / 3) AS BIGINT) % 7 AS VARCHAR(10)) AS highest_education, 'web' || CAST(c_custkey % 71 AS VARCHAR(10)) AS registration_type, 'x' || CAST(c_custkey % 73 AS VARCHAR(10)) AS source_type,
       'g' || CAST(c_custkey % 79 AS VARCHAR(10)) AS gst, 'rel' || CAST(c_custkey % 83 AS VARCHAR(10)) AS relation_type, CAST(c_custkey % 89 AS INT) AS campaign_id, CASE WHEN c_custkey % 5 = 0 THEN 'N' ELSE 'Y' END AS is_pan_verified,
       CASE WHEN c_custkey % 5 = 0 THEN 100000 + c_custkey % 30 ELSE 0 END AS parent_uid
FROM {{customer}}"""

VIEWS["logins"] = f"""
SELECT {USER} AS uid,
       CASE c_custkey % 5 WHEN 0 THEN 'FC_invalid_' WHEN 1 THEN 'closed_loan_' ELSE '' END || 'User.' || CAST(c_custkey AS VARCHAR(10)) AS name,
       CASE c_custkey % 7 WHEN 0 THEN 'invalid_' ELSE '' END || 'u' || CAST(c_custkey AS VARCHAR(10))
         || CASE WHEN c_custkey % 3 = 0 THEN '@platform.com1' ELSE '@mail.test' END AS mail
FROM {{customer}}"""

VIEWS["state_log"] = f"""
SELECT event_id AS id, CASE event_id % 3 WHEN 0 THEN CAST(user_id AS VARCHAR(20)) WHEN 1 THEN ' ' || CAST(user_id AS VARCHAR(20)) || '''' ELSE CAST(user_id AS VARCHAR(20)) || '.' END AS logged_entity_id,
       CASE WHEN event_type = 'error' THEN 'cent_vendor_borrower_varification' ELSE 'cent_loan' END AS logged_entity_type,
       CASE event_type WHEN 'click' THEN 1400 WHEN 'view' THEN 1050 WHEN 'purchase' THEN 1500 WHEN 'signup' THEN 1200 ELSE 0 END AS old_state,
       CASE WHEN event_type = 'error' THEN 90135409
            WHEN event_type = 'click' THEN CASE event_id % 3 WHEN 0 THEN 1100 WHEN 1 THEN 1600 ELSE -1000 END
            WHEN event_type = 'view' THEN CASE event_id % 2 WHEN 0 THEN 1200 ELSE 1050 END
            WHEN event_type = 'purchase' THEN CASE event_id % 4 WHEN 0 THEN 2500 WHEN 1 THEN 7500 ELSE 1600 END
            ELSE 1400 END AS new_state,
       CASE WHEN event_type IN ('view', 'signup') AND {ACTOR} % 40 > 1 THEN 100000 ELSE 0 END + {ACTOR} % 40 AS updated_by, {TS} AS created,
       CASE WHEN event_id % 23 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM {{events}}"""

# The log as the operators see it, for the SQL side.
VIEWS["log"] = """
SELECT id, CAST(replace(replace(replace(logged_entity_id, '.', ''), '''', ''), ' ', '') AS BIGINT) AS entity,
       logged_entity_type AS entity_type, old_state, new_state, updated_by AS actor, created + 19800 AS at_s
FROM state_log WHERE deleted = 'N'"""

VIEWS["uw_master"] = """
SELECT n_nationkey + 5 AS uw_id, 'UW ' || n_name AS uw_name FROM {nation}"""

VIEWS["scores"] = f"""
SELECT user_id AS loanid, CAST(CAST(floor(value * 7) AS INT) % 900 AS VARCHAR(10)) AS raw_score, {TS} AS created,
       CAST(ts AS DATE) AS day, event_id AS id
FROM {{events}} WHERE event_type = 'view'"""

VIEWS["crif_scores"] = """
SELECT loanid, CASE id % 11 WHEN 0 THEN 'x0-1' WHEN 1 THEN '' ELSE raw_score END AS score, created FROM scores"""

VIEWS["tu_scores"] = """
SELECT loanid, CASE id % 9 WHEN 0 THEN '000' WHEN 1 THEN '003' WHEN 2 THEN '0-1' ELSE raw_score END AS cibil_score, created FROM scores"""

VIEWS["milestone"] = """
SELECT user_id AS loanid, min(CASE WHEN event_type = 'purchase' AND user_id % 4 <> 0 AND CAST(ts AS DATE) >= DATE '2024-01-10' THEN CAST(ts AS DATE) END)
         AS first_disburse_date FROM {events} GROUP BY user_id"""

# Every disbursal of a loan, many a loan.
VIEWS["disbursals"] = "SELECT user_id AS loanid, CAST(ts AS DATE) AS disbursed FROM {events} WHERE event_type = 'purchase'"

VIEWS["rule_runs"] = f"""
SELECT user_id AS loan_id, {TS} AS created,
       CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'Reject' WHEN event_type = 'error' THEN 'REJECTED' ELSE 'APPROVED' END AS status,
       CASE event_id % 4 WHEN 0 THEN 'RULE_EXECUTION' WHEN 1 THEN 'FC_RULE_EXECUTION' WHEN 2 THEN 'OTHER' END AS action_type,
       CASE WHEN event_id % 29 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM {{events}}"""

_RULES = ["ABFL_PL", "ABFL", "AXIS", "DMI", "IDFC", "TATA_PL", "TATA", "UNITY_BIL", "UNITY_SBL", "UNKNOWN"]
VIEWS["lender_rule_log"] = f"""
SELECT event_id AS id, user_id AS loan_id, {TS} AS created,
       CASE event_id % 10 {' '.join(f"WHEN {i} THEN '{r}_RULE_EXECUTION'" for i, r in enumerate(_RULES))} END AS action_type,
       CASE WHEN value > 20 THEN '1000' ELSE '2000' END AS final_value,
       CASE WHEN event_id % 31 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM {{events}}"""

VIEWS["lender_eligibility"] = """
SELECT user_id AS loan_id, event_type AS product_tag, CAST(value AS DECIMAL(18,2)) AS disburse_amount,
       CAST(ts AS DATE) AS disburse_date, CASE WHEN event_type = 'purchase' THEN 'Y' ELSE 'N' END AS disburse_status,
       CASE WHEN event_id % 5 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM {events}"""

# Entity-attribute-value rows: orders stand for answers about their customer's loan.
VIEWS["additional_info"] = f"""
SELECT o_orderkey AS id, o_custkey AS loan_id,
       CASE o_orderkey % 8 WHEN 0 THEN 'x_LOAN_eligibility_fixed_obligation_1' WHEN 1 THEN 'loan_eligibility_monthly_income'
            WHEN 2 THEN 'loan_eligibility_debt_service_ratio' WHEN 3 THEN 'REFERENCE_DETAILS' WHEN 4 THEN 'USER_PERMANENT_INFO'
            WHEN 5 THEN 'borrower_deviation' WHEN 6 THEN 'loan_state_remark' ELSE 'loan_state_remark_reason' END AS action_type,
       CASE WHEN o_orderkey % 8 = 5 THEN CASE o_custkey % 4 WHEN 0 THEN '90135088' WHEN 1 THEN '90157880' WHEN 2 THEN '90135300' ELSE '90157884' END
            WHEN o_orderkey % 8 = 7 THEN CAST(1000 + o_orderkey % 40 AS VARCHAR(10))
            WHEN o_orderkey % 16 IN (0, 1) THEN NULL ELSE lower(o_orderpriority) || ' ' || CAST(o_orderkey % 6 AS VARCHAR(10)) END AS value1,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(20)) END AS value2,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'inc ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(20)) || ' pm' END AS value3,
       {_utc_epoch(ORDERED)} AS created, CAST(100000 + o_custkey % 60 AS VARCHAR(10)) AS created_by,
       CASE WHEN o_orderkey % 37 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM {{orders}}"""

VIEWS["identity_addresses"] = """
SELECT doc_id AS id, CAST(floor(doc_id / 2) AS BIGINT) AS loan_id, 'null ' || source AS name, '01/01/1990' AS dob, 'M' AS gender,
       replace(text, '  ', ' ') AS "House_number", lang AS locality, 'null' AS street, source AS vtc, lang AS sub_district,
       source AS district, upper(lang) AS state, 'null' AS adhaar,
       CASE WHEN doc_id % 19 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM {documents}"""

VIEWS["mandates"] = f"""
SELECT o_custkey AS loan_id, 'REF' || lpad(CAST(o_orderkey AS VARCHAR(12)), 10, '0') AS unique_reference_no,
       CASE o_orderkey % 9 WHEN 0 THEN 'Final Approved' WHEN 1 THEN 'Cancelled' WHEN 2 THEN 'Deactivated' WHEN 3 THEN 'Final Rejected'
            WHEN 4 THEN 'NPCI Initial Rejected' WHEN 5 THEN 'WIP' WHEN 6 THEN 'Pending' WHEN 7 THEN 'unheard of' END AS mandate_status,
       CASE o_orderkey % 4 WHEN 0 THEN 'please DEACTIVATE it' WHEN 1 THEN 'Invalid UMRN or inactive mandate here' WHEN 2 THEN 'no funds' END AS rejected_reason,
       CASE o_orderkey % 7 WHEN 0 THEN '050102017' WHEN 1 THEN '31022024' WHEN 2 THEN '5-10-2017' WHEN 3 THEN '12/11/2018'
            WHEN 4 THEN '' WHEN 5 THEN '1514764800' END AS startdate,
       CASE o_orderkey % 6 WHEN 0 THEN '3101201' WHEN 1 THEN '29-02-2024' WHEN 2 THEN '29/02/2023' WHEN 3 THEN '01012030' WHEN 4 THEN '7122026' END AS enddate,
       'holder' AS bank_holder_name, 'e@x' AS email_id, '9' AS mobile_no, 'bank' AS bank_name, 'br' AS branch_name, 'acc' AS account_no,
       CASE WHEN o_orderkey % 2 = 0 THEN '10' ELSE '11' END AS account_type, 'ifsc' AS ifsc_code, 'umrn' AS umrn,
       {_local_epoch(ORDERED)} AS created, CAST(NULL AS DATE) AS approved_date,
       CASE WHEN o_orderkey % 43 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM {{orders}}"""

VIEWS["subscriptions"] = f"""
SELECT o_custkey AS loan_id, 'REF' || lpad(CAST(o_orderkey AS VARCHAR(12)), 10, '0') AS unique_reference_no,
       CASE l_linenumber % 3 WHEN 0 THEN 'Subscription activated successfully' WHEN 1 THEN 'xx subscription_already_exist yy' ELSE 'failed' END AS cf_message,
       CASE WHEN l_returnflag = 'R' THEN 'inactive' ELSE 'active' END AS cf_status, 'holder' AS bank_holder_name, 'acc' AS account_no,
       {_utc_epoch(SHIP)} AS created, CASE WHEN l_linestatus = 'F' THEN 'OK' ELSE 'KO' END AS status,
       CASE WHEN o_orderkey % 3 = 0 THEN 'N' ELSE 'Y' END AS deleted
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey"""

VIEWS["bank_mandates"] = f"""
SELECT o_custkey AS loan_id, 'REF' || lpad(CAST(o_orderkey AS VARCHAR(12)), 10, '0') AS mandate_id,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS state, CASE WHEN o_orderstatus = 'F' THEN '0300' ELSE '0100' END AS status,
       'r' AS reason, {_utc_epoch(ORDERED)} AS created, CASE WHEN o_orderkey % 5 = 0 THEN 'N' ELSE 'Y' END AS deleted
FROM {{orders}}"""

VIEWS["cheques"] = """
SELECT l_orderkey AS loan_id, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey END AS cheque_no,
       CASE l_linenumber % 5 WHEN 0 THEN 'Pending' WHEN 1 THEN 'Cancel' WHEN 2 THEN 'Paid' WHEN 3 THEN 'Bounce' ELSE 'Lost' END AS cheque_status,
       CASE WHEN l_suppkey % 9 = 8 THEN 'Y' ELSE 'N' END AS deleted
FROM {lineitem}"""

VIEWS["bank_accounts"] = f"""
SELECT 100000 + {_person("o_custkey", 40)} AS uid, 'name' AS account_name, 'AC' || lpad(CAST(o_orderkey AS VARCHAR(12)), 10, '0') AS account_number,
       lower(o_orderpriority) AS account_ifsc_number,
       CASE o_orderkey % 4 WHEN 0 THEN '10' WHEN 1 THEN 'Current' WHEN 2 THEN 'saving' ELSE 'odd' END AS account_type,
       'branch' AS branch_add, o_orderpriority AS bank_name, 'm' AS micr_number,
       {_utc_epoch(ORDERED)} AS created, CASE WHEN o_orderkey % 13 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM {{orders}}"""

VIEWS["employment"] = f"""
SELECT o_orderkey AS id, {UID.replace('c_custkey', 'o_custkey')} AS uid, 'Y' AS is_current, lower(o_orderpriority) AS comp_designation,
       CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE ' acme corp ' END AS comp_name, 'line ' || CAST(1 + o_orderkey % 97 AS VARCHAR(10)) AS comp_address, CAST(100 + o_orderkey % 23 AS VARCHAR(10)) AS comp_tenure,
       'pin ' || CAST(o_orderkey % 30 AS VARCHAR(10)) AS comp_pin, CAST(700 + o_orderkey % 89 AS VARCHAR(10)) AS comp_phone, ' A' || CAST(1 + o_orderkey % 83 AS VARCHAR(10)) || '@B ' AS comp_email,
       CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'nan' WHEN 2 THEN '6309528114600' ELSE CAST({_local_epoch(ORDERED)} AS VARCHAR(20)) END AS comp_start,
       CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE CAST({_local_epoch(ORDERED)} AS VARCHAR(20)) END AS comp_end,
       CAST(1000 + o_orderkey % 11 AS VARCHAR(10)) AS company_profit, CAST(2000 + o_orderkey % 13 AS VARCHAR(10)) AS company_depreciation, CAST(3000 + o_orderkey % 17 AS VARCHAR(10)) AS company_salary_paid, CASE WHEN o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS is_verified, CAST(4000 + o_orderkey % 19 AS VARCHAR(10)) AS other_salaries_paid,
       CAST(5000 + o_orderkey % 29 AS VARCHAR(10)) AS work_exp, CAST(6000 + o_orderkey % 31 AS VARCHAR(10)) AS prev_takehome_sal, 'type ' || CAST(1 + o_orderkey % 37 AS VARCHAR(10)) AS business_type,
       CASE o_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN 'null' END AS office_type, CAST(7000 + o_orderkey % 41 AS VARCHAR(10)) AS no_of_employee,
       CAST(8000 + o_orderkey % 43 AS VARCHAR(10)) AS company_turnover, CAST(9000 + o_orderkey % 47 AS VARCHAR(10)) AS comp_registration_no, CAST(10000 + o_orderkey % 53 AS VARCHAR(10)) AS contact2, 'caution ' || CAST(1 + o_orderkey % 3 AS VARCHAR(10)) AS caution_profile, CAST(11000 + o_orderkey % 59 AS VARCHAR(10)) AS business_cash_component,
       CASE o_orderkey % 3 WHEN 0 THEN '60' ELSE CAST(9800 + o_orderkey % 28 AS VARCHAR(10)) END AS industry_type,
       6000 + o_orderkey % 26 AS employment_type_cnd, CASE WHEN o_orderkey % 7 = 0 THEN 90000116 ELSE 55 END AS comp_business_type_cnd,
       7000 + o_orderkey % 27 AS comp_industry_cnd, 1 AS company_offc_ownership_cnd, 2 AS desig_level_cnd, 7000 + o_orderkey % 25 AS profession_cnd,
       'n' AS nature_of_business, 's' AS sub_industry_type, CASE WHEN o_orderkey % 47 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM {{orders}}"""

VIEWS["loan_detail"] = """
SELECT o_orderkey AS id, o_custkey AS loan_id, 8000 + o_orderkey % 27 - CASE WHEN o_orderkey % 5 = 0 THEN 8000 ELSE 0 END AS residence_type_cnd,
       CASE WHEN o_orderkey % 2 = 0 THEN '800000000' ELSE 'x' END AS residence_shifting_date,
       CAST(100 + o_orderkey % 2 AS INT) AS child, CAST(200 + o_orderkey % 3 AS INT) AS dependent, CAST(300 + o_orderkey % 5 AS INT) AS total_exp, CAST(400 + o_orderkey % 7 AS INT) AS sibling, CAST(500 + o_orderkey % 11 AS INT) AS cibil, CAST(600 + o_orderkey % 13 AS INT) AS equinox, CAST(700 + o_orderkey % 17 AS INT) AS gross_salary_m, CAST(800 + o_orderkey % 19 AS INT) AS take_home_salary_m,
       CAST(900 + o_orderkey % 23 AS INT) AS deductions_m, 'dev' || CAST(0 + o_orderkey % 29 AS VARCHAR(10)) AS field1, 'd' || CAST(0 + o_orderkey % 31 AS VARCHAR(10)) AS dept, 'b' || CAST(0 + o_orderkey % 37 AS VARCHAR(10)) AS business_reg_proof, 'o' || CAST(0 + o_orderkey % 41 AS VARCHAR(10)) AS business_owner_proof, 'i' || CAST(0 + o_orderkey % 43 AS VARCHAR(10)) AS itr_gstin_proof,
       'n' || CAST(0 + o_orderkey % 47 AS VARCHAR(10)) AS itr_ack_num, 'v' || CAST(0 + o_orderkey % 53 AS VARCHAR(10)) AS itr_valid_message, 's' || CAST(0 + o_orderkey % 59 AS VARCHAR(10)) AS itr_valid_status, 'r' || CAST(0 + o_orderkey % 61 AS VARCHAR(10)) AS refer_product, CASE WHEN o_orderkey % 2 = 0 THEN 'N' ELSE 'Y' END AS is_nbfc_pass,
       CASE WHEN o_orderkey % 17 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM {orders}"""

VIEWS["bank_months"] = """
SELECT l_orderkey AS id, o_custkey AS loanid,
       CASE l_linenumber % 4 WHEN 0 THEN 'JAN' WHEN 1 THEN 'feb' WHEN 2 THEN 'Nov' ELSE 'Sep' END AS month,
       'day ' || CAST(l_suppkey % 31 + 1 AS VARCHAR(4)) AS date_cnd, CAST(l_quantity AS DECIMAL(18,2)) AS monthly_amount,
       'detailed_banking_info' AS action_type, CASE WHEN l_suppkey % 21 = 0 THEN 'Y' ELSE 'N' END AS deleted
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""

VIEWS["job_log"] = """
SELECT n_nationkey AS cron_id, CASE n_nationkey % 3 WHEN 0 THEN 'automatic_allocation_of_cases_to_underwriters.sh'
       WHEN 1 THEN 'automatic_allocation_of_cases_to_underwriters_new.sh' ELSE 'other.sh' END AS cron_type, 'N' AS deleted FROM {nation}"""

VIEWS["job_steps"] = f"""
SELECT event_id AS id, event_id % 25 AS cron_id, CAST(100000 + user_id AS VARCHAR(20)) AS communication_id,
       'agent- ' || CAST(event_id % 40 AS VARCHAR(10)) || ' took the case' AS remark,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status, {TS} AS created, 'N' AS deleted
FROM {{events}}"""

VIEWS["channel_master"] = """
SELECT CASE s_suppkey % 4 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'Automobile' WHEN 2 THEN 'machinery' ELSE 'Src' || CAST(s_suppkey % 30 AS VARCHAR(10)) END AS channel_source,
       CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'Marketing' WHEN 3 THEN 'DSA Partner' ELSE 'Alliances' END AS channel,
       CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Afinoz' ELSE 'Sub' || CAST(s_suppkey % 7 AS VARCHAR(10)) END AS sub_category,
       CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE 'Cat' || CAST(s_suppkey % 4 AS VARCHAR(10)) END AS category
FROM {supplier}"""

VIEWS["rep_assignments"] = """
SELECT s_suppkey AS id, CASE WHEN s_suppkey % 9 = 0 THEN 0 ELSE 100000 + s_suppkey % 20 END AS value1,
       'rep.' || lower(s_name) AS agent_name, CASE WHEN s_suppkey % 11 = 0 THEN 'Y' ELSE 'N' END AS deleted FROM {supplier}"""

VIEWS["source_owners"] = """
SELECT s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'furniture' ELSE 'Src' || CAST(s_suppkey % 30 AS VARCHAR(10)) END AS old_source,
       CAST(100000 + s_suppkey AS VARCHAR(20)) AS assigned_to, 'BORROWER_RM_ASSIGNED' AS action_type, 'N' AS deleted FROM {supplier}"""

VIEWS["bureau_ignore"] = """
SELECT o_custkey AS loan_id, CASE WHEN o_orderkey % 2 = 0 THEN 'why' END AS remark, CASE WHEN o_custkey % 11 <> 0 OR o_orderkey % 4 = 1 THEN 'Y' ELSE 'N' END AS deleted
FROM {orders}"""

VIEWS["mandate_ledger"] = f"""
SELECT o_custkey AS loan_id, 'REF' || lpad(CAST(o_orderkey AS VARCHAR(12)), 10, '0') AS unique_reference_no,
       CASE WHEN l_linenumber = 3 THEN 'PENALTY' ELSE 'EMI' END AS ledger_type, CAST({_local_epoch(SHIP)} AS VARCHAR(20)) AS created,
       CASE WHEN l_linenumber = 6 THEN 'Y' ELSE 'N' END AS deleted
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey"""

VIEWS["prospects"] = f"""
SELECT o_orderkey AS los_app_id, 'app' AS applicant_name, DATE '1990-01-01' AS user_dob, 30 AS user_age,
       CASE WHEN o_orderkey % 6 = 0 THEN '' WHEN o_orderkey % 6 = 1 THEN NULL ELSE {_national_id("o_custkey", 40)} END AS pan,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE {_phone("o_custkey", 50)} END AS mobile,
       DATE '2023-01-01' AS user_date, 1 AS user_vintage, 1 AS user_pin, 'w' AS registration_type, 'e' AS employement_type, 's' AS employment_sub_type,
       DATE '2023-01-01' AS score_date, 700 AS bureau_score, 'd' AS score_description, DATE '2023-01-01' AS cs_score_date, 1 AS cs_score, 1 AS propensity
FROM {{orders}}"""

VIEWS["campaign_runs"] = f"""
SELECT o_orderkey AS los_app_id, CASE WHEN o_orderkey % 50 = 0 OR o_orderkey % 2 = 1 THEN 'bad' ELSE CAST({ORDERED} AS VARCHAR(10)) END AS campaign_date
FROM {{orders}}"""

VIEWS["campaign_performance"] = f"""
SELECT l_linenumber AS id, CAST(l_orderkey AS VARCHAR(20)) AS los_app_id, {_utc_epoch(SHIP, '10800')} AS campaign_date,
       CASE WHEN l_linestatus = 'O' AND l_orderkey % 3 = 0 THEN 'N' ELSE 'Y' END AS deleted
FROM {{lineitem}}"""

# Stands for the lead mart where another mart reads it.
VIEWS["leads"] = f"""
SELECT c_custkey AS loan_id, {UID} AS user_id, {REGISTERED} AS loan_registered_date, 'Live' AS loan_currentstate,
       c_name AS user_name, 'm' AS user_mobile, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE {_phone("c_custkey", 50)} END AS bor_mobile,
       CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 9 = 1 THEN NULL ELSE {_national_id("c_custkey", 40)} END AS user_pan,
       DATE '1980-01-01' AS user_dob, CAST(20 + c_custkey % 45 AS INT) AS age_loanregister, CAST(21 + c_custkey % 45 AS INT) AS age_current,
       CAST(c_nationkey AS INT) AS user_pin, 'city' AS user_city, 'fcity' AS user_final_city, 'dist' AS user_district, 'st' AS user_state,
       'z' AS user_zone, 'fst' AS user_final_state, CASE c_custkey % 5 WHEN 0 THEN 'IMB' WHEN 1 THEN 'web' END AS source,
       CASE WHEN c_custkey % 6 = 0 THEN '' WHEN c_custkey % 6 = 1 THEN 'Agent' END AS user_agent_name, 'ag' AS user_agents_name,
       'Sub' || CAST(c_custkey % 3 AS VARCHAR(4)) AS sub_category, 'Cat' || CAST(c_custkey % 4 AS VARCHAR(4)) AS category,
       CASE c_custkey % 5 WHEN 0 THEN 'Alliances' WHEN 1 THEN 'Marketing' WHEN 2 THEN 'DSA Partner' WHEN 3 THEN 'Direct' END AS channel, 'rm' AS rm,
       CASE WHEN c_custkey % 2 = 0 THEN 'Salaried Employee' ELSE 'Self Employed' END AS employement_type,
       CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE {REGISTERED} + CAST(c_custkey % 90 AS INT) END AS first_disburse_date,
       CAST(10 + c_custkey % 30 AS DECIMAL(10,2)) AS rate_max_approved, 'r' AS risk_bucket, 'type' AS loan_type, 'lcity' AS loan_city,
       CAST(c_acctbal AS DECIMAL(18,2)) AS loan_amount_expected, CAST(c_acctbal AS DECIMAL(18,2)) AS max_amount_approved,
       CAST(c_acctbal AS DECIMAL(18,2)) AS disburse_amount, CASE WHEN c_custkey % 13 = 0 THEN 420 ELSE 0 END AS plus,
       CASE WHEN c_custkey % 17 = 0 THEN 1 ELSE 0 END AS fraud_flag, CAST(NULL AS VARCHAR(4)) AS cibil_score,
       CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE CAST(500 + c_custkey % 400 AS VARCHAR(10)) END AS crif_score,
       CASE WHEN c_custkey % 10 = 0 THEN 100000 + c_custkey % 200 ELSE 0 END AS parent_uid, 'Male' AS gender, 'gen' AS generations, 'Rented' AS residence_type,
       '12 Months' AS tenure_months, CAST(c_custkey % 45 AS INT) AS tenure_monthsno,
       CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'pm ' || CAST(CAST(c_custkey * 53 % 100000 AS DECIMAL(10,2)) AS VARCHAR(20)) END AS income,
       CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE CAST(c_custkey % 80 AS VARCHAR(10)) || '.5' END AS foir_before,
       CASE c_custkey % 7 WHEN 2 THEN '' WHEN 3 THEN NULL ELSE CAST(c_custkey % 100 AS VARCHAR(10)) || '.25' END AS foir_after,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE {REGISTERED} + CAST(c_custkey % 40 AS INT) END AS uw_live_date,
       CASE WHEN c_custkey % 3 = 0 THEN 'Y' END AS dev_exists, CASE WHEN c_custkey % 3 = 0 THEN 2 END AS total_dev, 'bank' AS bank_name,
       CASE WHEN c_custkey % 4 = 0 THEN 'Nach' END AS nach_source, CASE WHEN c_custkey % 4 = 0 THEN 'Pending' END AS nach_status,
       CASE WHEN c_custkey % 4 = 0 THEN '' END AS nach_reason, 'PDC' AS payment_registration_method,
       'REF' || lpad(CAST(c_custkey AS VARCHAR(12)), 10, '0') AS mandate_id, c_custkey % 3 AS cheque_available, c_custkey % 4 AS cheque_total,
       {REGISTERED} AS accepted_date, {REGISTERED} + 9 AS actual_live_date, CAST(NULL AS DATE) AS rfd_date, 'P' AS product_type,
       'n' AS comp_natureofbusiness, 'i' AS comp_industrytype, 0 AS ex360_npa, 'uw' AS uw_name, 'Live' AS uw_status_final, 'c' AS call_disposition,
       'ba' AS ba_name, 'bl' AS ba_login_name_clean, CASE c_custkey % 5 WHEN 0 THEN 'APPROVED' WHEN 1 THEN 'REFER' WHEN 2 THEN 'odd' END AS loan_img1,
       CASE c_custkey % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 2 THEN 'odd' END AS loan_img2,
       CASE WHEN c_custkey % 2 = 0 THEN {REGISTERED} END AS uw_returned_date, CASE WHEN c_custkey % 3 = 0 THEN {REGISTERED} END AS uw_forward_to_cs_date,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE {REGISTERED} - CAST(c_custkey * 7 % 3000 AS INT) END AS comp_startdate
FROM {{customer}}"""

VIEWS["messy_dates"] = f"""
SELECT l_orderkey AS id, l_linenumber AS line, l_partkey AS part,
       CASE l_linenumber
         WHEN 1 THEN lpad(CAST(day({SHIP}) AS VARCHAR(2)), 2, '0') || lpad(CAST(month({SHIP}) AS VARCHAR(2)), 2, '0') || CAST(year({SHIP}) AS VARCHAR(4))
         WHEN 2 THEN lpad(CAST(day({SHIP}) AS VARCHAR(2)), 2, '0') || '-' || lpad(CAST(month({SHIP}) AS VARCHAR(2)), 2, '0') || '-' || CAST(year({SHIP}) AS VARCHAR(4))
         WHEN 3 THEN CAST(day({SHIP}) % 9 + 1 AS VARCHAR(2)) || lpad(CAST(month({SHIP}) AS VARCHAR(2)), 2, '0') || CAST(year({SHIP}) AS VARCHAR(4))
         WHEN 4 THEN CAST({_local_epoch(SHIP)} AS VARCHAR(20))
         WHEN 5 THEN '3102' || CAST(year({SHIP}) AS VARCHAR(4))
         WHEN 6 THEN CASE WHEN l_partkey % 2 = 0 THEN '' ELSE '050102017' END
         ELSE lpad(CAST(l_suppkey % 40 AS VARCHAR(2)), 2, '0') || '/' || lpad(CAST(l_partkey % 15 AS VARCHAR(2)), 2, '0') || '/' || CAST(year({SHIP}) AS VARCHAR(4)) END AS raw
FROM {{lineitem}}"""

VIEWS["messy_text"] = """
SELECT doc_id AS id, text FROM {documents}
UNION ALL SELECT 10000000 + conv_id * 1000 + turn AS id, text FROM {conversations}"""


def _needed(names: list[str]) -> list[str]:
    """The views and the views they use, dependencies first."""
    order: list[str] = []

    def visit(name):
        if name in order:
            return
        for other in VIEWS:
            if other != name and re.search(rf"(?i)\b(FROM|JOIN)\s+{other}\b", VIEWS[name]):
                visit(other)
        order.append(name)

    for n in names:
        visit(n)
    return order


def _compose(names: list[str], body: str, keys: dict, how: str = "", texts: dict = VIEWS) -> str:
    ctes = ", ".join(f"{n} AS {how}({texts[n].format(**keys)})" for n in _needed(names))
    if not ctes:
        return body
    body = body.strip()
    return f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    keys = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}
    keys["dayno"] = "datediff(DAY, DATE '1970-01-01', "
    text = _compose([name], f"SELECT * FROM {name}", keys, texts=VIEWS | SPARK_VIEWS)
    # Double quotes mark identifiers in standard SQL, back quotes in Spark.
    return spark.sql(re.sub(r'"(add|minus|House_number)"', r"`\1`", text))


def oracle(body: str, *names: str, materialize: bool = False) -> str:
    """A DuckDB statement: the named views as CTEs in front of ``body``.

    ``materialize`` evaluates each view once, for statements that name views many times.
    """
    keys = {t: t for t in TABLES}
    keys["dayno"] = "datediff('day', DATE '1970-01-01', "
    return _compose(list(names), body, keys, "MATERIALIZED " if materialize else "")
