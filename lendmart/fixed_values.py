"""Word lists, code lists, labels and thresholds the results depend on.

Nothing in here is logic.  Each table is plain data in its natural order and is
consumed by the data-driven builders in ``functions`` and ``operators``.
Site-specific identifiers live in :mod:`lendmart.config` and can be replaced.
"""

# --- calendar -------------------------------------------------------------
IST_OFFSET_S = 19800
MONTH_NAMES = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec"
EPOCH_DATE_LIMIT = 2147463847          # last epoch that may be shifted by the offset
EPOCH_MAX = 2147483647                 # beyond this a birth date is dropped
EPOCH_MAX_DATE = "2038-01-19"
PAID_SENTINEL = "1970-01-01"
FIRST_STILL_DUE_SENTINEL = "1900-01-02"
NOT_FIRST_SENTINEL = "1900-01-01"

# --- repairs of known bad date texts --------------------------------------
START_DATE_REPAIRS = {"050102017": "05102017"}
END_DATE_REPAIRS = {
    "3101201": "31012021",
    "3107022": "31072022",
    "3108022": "31082022",
    "3122018": "03122018",
    "3009202": "30092022",
}
BAD_EMPLOYMENT_START = {"6309528114600": 1577491200}

# --- status tokens written into names, e-mails and ids ---------------------
# "{brand}" is filled from configuration.
NAME_STATUS_TOKENS = [
    "fc_invalid1_lockdown_invalid_lockdown_invalid_",
    "fcinvalid_invalid-",
    "fc_invalid3_invalid_{brand}_",
    "fc_invalid_1",
    "fc_invalid1_lockdown_invalid_",
    "fc_invalid3_lockdown_invalid_",
    "lockdown_invalid_fc_invalid1_",
    "fc_invalid1_invalid_{brand}_",
    "fc_invalid_lockdown_invalid_",
    "fc_invalid3_closed_loan_",
    "fc_invalid1_invalid_fc_",
    "invalid_{brand}_",
    "lockdown_invalid_",
    "invalid_admin_",
    "fc_invalid1_",
    "fc_invalid3_",
    "fc_invalid2_",
    "fc_invalid_2",
    "fc_invalid_",
    "fc_invalid1",
    "fc_ invalid",
    "fcinvalid_",
    "invalid_",
    "invalid-",
    "fc_invalid",
    "fc_closed_2",
    "fc_closed_1",
    "fc_closed_",
    "fc_close_",
    "fc_closed",
    "closed_loan_",
    "closed_",
]
NAME_DOMAIN_TOKENS = ["@{brand}.com1", "@{brand}.com"]
ID_STATUS_TOKENS = [
    "-individdual",
    "-individual",
    "fc_invalid_fc_invalid_",
    "fc_reapply_fc_reapply_",
    "fc_invalid_fc_inalid_",
    "fc_invalid_invalid _",
    "fc_invalid_invalid_",
    "lockdown_invalid_",
    "invalid_{brand}_",
    "fc_invalid_valid_",
    "fc_closedtopup_",
    "fc_invalid_1_",
    "fc_invalid__",
    "closed_loan_",
    "_ invalid no",
    "fc_closed_1_",
    "fc_closed_5_",
    "fc_invalid1_",
    "fc_invalid_",
    "fc_invalid1",
    "fc_closed1_",
    "_invalid no",
    "_individual",
    "fc_closed2_",
    "fc_reapply_",
    "in_valid _",
    "fc_closed_",
    "_duplicate",
    "fc_invaid_",
    "in_valid_",
    "_invallid",
    "fc_close_",
    "invalid_",
    "_invalid",
    "top_up_",
    "invali_",
    "closed_",
    "inalid_",
    "topup_",
    "_inv",
    "top_",
    "fc_",
    "invalid",
    "invild",
    "-invld",
    "invailid",
    "_test",
    "test",
]
NATIONAL_ID_PATTERN = "[A-Z]{5}[0-9]{4}[A-Z]"
DECIMAL_PATTERN = "[0-9]+.[0-9]+"

# --- canonical region names ------------------------------------------------
CANONICAL_STATES = {
    "ANDAMAN AND NICOBAR ISLANDS": "ANDAMAN & NICOBAR ISLANDS",
    "CHHATTISGARH": "CHATTISGARH",
    "JAMMU": "JAMMU & KASHMIR",
    "MADHYAPRADESH": "MADHYA PRADESH",
    "PUDUCHERRY": "PONDICHERRY",
    "TAMILNADU": "TAMIL NADU",
    "UP": "UTTAR PRADESH",
    "UTTARPRADESH": "UTTAR PRADESH",
    "UTTARANCHAL": "UTTARAKHAND",
}

# --- dictionary groups -----------------------------------------------------
CITY_GROUPS = ["LOAN_CITY", "STATE_PIN", "STATE_INDIA", "CORONA_CITY"]
CITY_CODE = "INDIA_CITY"
STATE_GROUPS = ["STATE_INDIA", "LOAN_CITY", "STATE_JAMMU_AND_KASHMIR", "STATE_DELHI"]
LOAN_TYPE_GROUPS = ["CIVIL_LOAN_TYPE", "CRIF_LOAN_TYPE", "INDIA_LOAN", "MAIN_LOAN_TYPE", "PAISABAZAR_PURPOSE"]
OTHER_LOAN_TYPE_GROUPS = ["NBFC_TYPE", "FIP_TYPE"]
LOAN_SUBTYPE_GROUPS = ["MAIN_LOAN_TYPE", "FIP_TYPE", "INDIA_SUB_LOAN", "MLP_PLAN_BORROWER"]
RATE_GROUP = "intrest_rate"
LOAN_STATE_GROUP = "loan_state"
CITY_OVERRIDES = {"90047195": "Bangalore"}
EMPLOYMENT_DECODES = [
    # column of the employment table, dictionary group, result column
    ("employment_type_cnd", "EMPLOYMENT_TYPE", "employement_type"),
    ("comp_business_type_cnd", "BUSINESS_TYPE", "comp_business_type"),
    ("comp_industry_cnd", "INDIA_PROFESSION", "comp_industry"),
    ("profession_cnd", "INDIA_PROFESSION", "profession"),
    ("company_offc_ownership_cnd", "OFFICE_OWNERSHIP", "company_offc_ownership"),
    ("desig_level_cnd", "DESIGNATION_LEVEL", "designation_level"),
    ("nature_of_business", "nature_of_business_borrower", "nature_of_business"),
    ("sub_industry_type", "business_subindustry_type_new", "sub_industry_type"),
    ("industry_type", "business_industry_type_new", "industry_type"),
    ("caution_profile", "borrower_caution_profile", "caution_profile"),
]
RESIDENCE_TYPES = {1: "Rented", 2: "Self Owned", 3: "Owned By Parent Or Sibling", 4: "Relatives"}
LOAN_SUB_STATES = {
    1: "Not Contactable/Not reachable",
    714: "FINAL APPROVE",
    715: "FINAL REJECT",
    15000: "Cooling-Off Period - Closed",
}
EDUCATION_LEVELS = [
    (["0"], "No graduation"),
    (["320", "321", "991"], "Undergraduation"),
    (["", "1", "322", "992", "others"], "Graduation"),
    (["323", "990", "993"], "Post graduation"),
    (["994"], "Professional"),
]
ACCOUNT_TYPES = [
    (["10", "Fixed", "Salaried", "Saving", "saving"], "Saving"),
    (["11", "13", "Current", "current", "Over_draft"], "Current"),
]

# --- bureau scores ---------------------------------------------------------
SCORE_CODES = {"000": "0", "001": "1", "002": "2", "003": "3", "004": "4", "005": "5"}
NO_HISTORY_PATTERN = "%0-1%"

# --- state log -------------------------------------------------------------
LOAN_ENTITY = "cent_loan"
VERIFY_ENTITY = "cent_vendor_borrower_varification"
UW_FROM_STATES = [1400, 1500, 1700]
UW_TO_STATES = [-1000, 1100, 1500, 1600, 2500, 2700]
UW_SLOTS = {"cancelled": -1000, "returned": 1100, "forward_to_cs": 1600, "live": 2500}
BORROWER_AGENT_TRANSITIONS = [(None, [1050])]
PREUW_TRANSITIONS = [([1050], [1200]), ([1200], [1400, 1100])]
MILESTONES = {
    "livec_date": (LOAN_ENTITY, [2500]),
    "rfd_date": (VERIFY_ENTITY, [90135409]),
    "allocated_date": (LOAN_ENTITY, [1050, 1200]),
    "accepted_date": (LOAN_ENTITY, [1400]),
    "foreclosure_created": (LOAN_ENTITY, [7500]),
    "cancelled_created": (LOAN_ENTITY, [-1000, 10]),
}
ACCEPTED_STATE = 1400
REJECT_WORDS = ["REJECTED", "Reject", "REJECT"]
RULE_ACTIONS = [
    "Covid_3rd_wave_rule", "{BRAND}_RULE", "FC_PQ_RULE_EXECUTION",
    "FC_RULE_EXECUTION", "FC_RULE_EXECUTION_STPQ", "RULE_EXECUTION",
]
ALLOCATION_JOBS = [
    "automatic_allocation_of_cases_to_underwriters.sh",
    "automatic_allocation_of_cases_to_underwriters_new.sh",
]
PREAPPROVED = ["REFER", "APPROVED", "APPROVED_STPQ"]

# --- entity-attribute-value actions ---------------------------------------
EAV_PATTERNS = {
    "obligation": "%loan_eligibility_fixed_obligation%",
    "income": "%loan_eligibility_monthly_income%",
    "ratio": "%loan_eligibility_debt_service_ratio%",
}
DEVIATION_ACTIONS = ["borrower_deviation", "borrower_deviation_new"]
DEVIATION_CLASSES = [
    # counter name, reason, codes
    ("age_dev", "AGE", ["90135088", "90157880"]),
    ("aqb_dev", "AQB", ["90135094", "90157877"]),
    ("bureau_score_dev", "Bureau Score", ["90135098", "90157878"]),
    ("bureau_vintage_dev", "Bureau Vintage", ["90157879"]),
    ("caution_profile_dev", "Caution Profile", ["90157883"]),
    ("docs_income_dev", "Docs - Income", ["90135090", "90157881"]),
    ("enquiry_dev", "Enquiry", ["90135300"]),
    ("foir_dev", "FOIR", ["90135089", "90135091", "90135093", "90157873", "90157874", "90157875"]),
    ("higher_la_dev", "Higher LA", ["90157876"]),
    ("income_mode_dev", "Income Mode", ["90135096"]),
    ("profile_dev", "Profile", ["90135095", "90157882"]),
    ("rco_dev", "RCO", ["90135092", "90135097"]),
    ("roi_waiver_dev", "ROI Waiver", ["90157885"]),
    ("statbility_dev", "Stability", ["90135099"]),
    ("stressed_sector_dev", "Stressed Sector", ["90157884"]),
]

# --- mandates, cheques, transactions --------------------------------------
MANDATE_PRIORITY = [
    (["Cancelled", "Deactivated"], 7),
    (["Final Approved"], 6),
    (["Final Rejected"], 5),
    (["NPCI Initial Rejected"], 4),
    (["TPSL Rejected"], 3),
    (["WIP"], 2),
    (["Pending"], 1),
]
MANDATE_REASONS = [
    ("%invalid umrn or inactive mandate%", "Invalid Umrn Or Inactive Mandate"),
    ("%activat%", "Deactivation Request"),
]
SUBSCRIPTION_STATES = ["ACTIVE", "BANK_APPROVAL_PENDING", "ERROR"]
SUBSCRIPTION_MESSAGES = [
    "subscription activated successfully",
    "subscription authorised successfully",
]
SUBSCRIPTION_EXISTS = "%SUBSCRIPTION_ALREADY_EXIST%"
BANK_MANDATE_OK = ("Y", "0300")
CHEQUE_COUNTERS = {
    "cheque_available": ["Pending"],
    "cheque_cancel": ["Cancel"],
    "cheque_used": ["Paid", "Bounce"],
    "cheque_paid": ["Paid"],
    "cheque_bounce": ["Bounce"],
}
FEE_TYPES = {"registration_fees": 1358, "processing_fees": 90133286}
SETTLED_TXN_STATE = 200
PAYMENT_STATES = ["Paid", "Pending", "pending"]

# --- call dispositions -----------------------------------------------------
SILENT_DISPOSITIONS = [0, 30]
DISPOSITION_OVERRIDES = {
    301: "Not Contactable/Not Reachable",
    302: "Not Contactable/Not Picking",
    303: "Not Contactable/Switched off",
    424: "Not_Reachable",
    425: "Ringing",
    75: "Lender made live",
    210: "Paid/Follow-up for docs",
    211: "Unpaid/Follow-up for docs",
    311: "Agreement Initiated -Lender",
    312: "Agreement Completed -Lender",
}
CALL_STATES = {0: "Open", 1: "Valid", 2: "Invalid"}
EXCLUDED_DISPOSITION = 420
NO_UNDERWRITING_PRODUCTS = ["NST", "POCKETLY", "POCKET_LOAN", "IMB"]

# --- band tables: (upper edge, label) --------------------------------------
RISK_RATE_LT = [(12, "1.Premium")]
RISK_RATE_LE = [(14, "2.Minimal"), (18, "3.Low"), (22, "4.Medium"), (26, "5.High"), (30, "6.Very High")]
TENURE_LE = [(11, "A1 <12"), (15, "A2 12-15"), (18, "A3 16-18"), (24, "A4 19-24"), (30, "A5 25-30"), (36, "A6 31-36")]
ROI_LT = [(20, "A1 <20%")]
ROI_LE = [(25, "A2 20%-25%"), (30, "A3 26%-30%"), (36, "A4 31%-36%")]
ROI_ELSE = "A5 36%+"
AGE_LT = [(25, "A1 <25"), (31, "A2 25-30"), (36, "A3 31-35"), (41, "A4 36-40"),
          (46, "A5 41-45"), (51, "A6 46-50"), (56, "A7 51-55")]
AGE_ELSE = "A8 55+"
AMOUNT_LT = [(25001, "A01 <=25K"), (50001, "A02 25K-50K"), (100001, "A03 50K-1L"), (150001, "A04 1L-1.5L"),
             (200001, "A05 1.5L-2L"), (250001, "A06 2L-2.5L"), (300001, "A07 2.5L-3L"), (500001, "A08 3L-5L"),
             (700001, "A09 5L-7L")]
AMOUNT_ELSE = "A10 7L+"
SALARIED = "Salaried Employee"
INCOME_SALARIED_LT = [(26000, "SA01 <26K"), (28000, "SA02 26K-28K"), (30000, "SA03 28K-30K"),
                      (33000, "SA04 30K-33K"), (44000, "SA05 33K-44K")]
INCOME_SALARIED_ELSE = "SA06 44K+"
INCOME_SELF_LT = [(44000, "SE01 <44K"), (51000, "SE02 44K-51K"), (55000, "SE03 51K-55K"),
                  (58000, "SE04 55K-58K"), (62000, "SE05 58K-62K"), (90000, "SE06 62K-90K")]
INCOME_SELF_ELSE = "SE07 90K+"
FOIR_BEFORE_SALARIED_LT = [(18, "SA01 <18"), (25, "SA02 18-25"), (32, "SA03 25-32"), (37, "SA04 32-37"),
                           (42, "SA05 37-42"), (48, "SA06 42-48"), (54, "SA07 48-54")]
FOIR_BEFORE_SALARIED_ELSE = "SA08 54+"
FOIR_BEFORE_SELF_LT = [(19, "SE01 <19"), (25, "SE02 19-25"), (32, "SE03 25-32"), (37, "SE04 32-37"),
                       (42, "SE05 37-42"), (48, "SE06 42-48"), (55, "SE07 48-55"), (66, "SE08 55-66")]
FOIR_BEFORE_SELF_ELSE = "SE09 66+"
FOIR_AFTER_SALARIED_LT = [(40, "SA01 <40"), (49, "SA02 40-48"), (56, "SA03 49-55"), (61, "SA04 56-60"),
                          (67, "SA05 61-66"), (71, "SA06 67-70"), (76, "SA07 71-75"), (82, "SA08 76-81")]
FOIR_AFTER_SALARIED_ELSE = "SA09 81+"
FOIR_AFTER_SELF_LT = [(34, "SE01 <34"), (41, "SE02 34-40"), (49, "SE03 41-48"), (56, "SE04 49-55"),
                      (63, "SE05 56-62"), (71, "SE06 63-70"), (79, "SE07 71-78"), (85, "SE08 79-84")]
FOIR_AFTER_SELF_ELSE = "SE09 85+"
SCORE_LE = [(550, "A01 <=550"), (575, "A02 551-575"), (600, "A03 576-600"), (625, "A04 601-625"),
            (650, "A05 626-650"), (675, "A06 651-675"), (700, "A07 675-700"), (725, "A08 701-725"),
            (750, "A09 726-750"), (775, "A10 751-775"), (800, "A11 775-800"), (850, "A12 801-850")]
SCORE_ELSE = "A13 850+"
SCORE_NULL = "CNF"
TURNAROUND_LE = [(1, "A1 Same Day"), (4, "A2 2-4 Days"), (8, "A3 a Week"), (15, "A4 a Fortnight"),
                 (31, "A5 a Month"), (60, "A6 2 Month")]
TURNAROUND_ELSE = "A7 2+ Month"
VINTAGE_LE = [(6, "A1 Upto 6M"), (12, "A2 6-12M"), (24, "A3 12-24M"), (36, "A4 24-36M"), (60, "A5 36-60M")]
VINTAGE_ELSE = "A6 60+ M"
GENERATION_LE = [(22, "Generation Z( upto 22)"), (38, "Millennials(22-38)"),
                 (54, "Generation X(39-54)"), (73, "Boomers(55-73)")]
SMALL_TICKET_LIMIT = 25001
DELINQUENCY_LADDER = ["A2_1-30 DPD", "A3_31-60 DPD", "A4_61-90 DPD", "A5_91-180 DPD", "A6_180+ DPD"]
DELINQUENCY_STARTS = {"plus_x": 0, "plus_30": 1, "plus_60": 2, "plus_90": 3}

# --- lender rule executions: (action, lender, eligibility column) -----------
LENDER_RULES = [
    ("ABFL_PL_RULE_EXECUTION", "ABFL_PL", "abfl_pl_bre_eligible"),
    ("ABFL_RULE_EXECUTION", "ABFL_BL", "abfl_bl_bre_eligible"),
    ("AXIS_RULE_EXECUTION", "AXIS_BL", "axis_bl_bre_eligible"),
    ("BAJAJ_BL_RULE_EXECUTION", "BAJAJ_BL", "bajaj_bl_bre_eligible"),
    ("CREDITSAISON_RULE_EXECUTION", "CREDITSAISON", "cs_bre_eligible"),
    ("DMI_RULE_EXECUTION", "DMI_BL", "dmi_bl_bre_eligible"),
    ("FATAKPAY_RULE_EXECUTION", "FATAKPAY_PL", "fatakpay_pl_bre_eligible"),
    ("FINNABLE_PL_RULE_EXECUTION", "FINNABLE_PL", "finnable_pl_bre_eligible"),
    ("FLEXILOANS_RULE_EXECUTION", "FLEXI_BL", "flexi_bl_bre_eligible"),
    ("IDFC_RULE_EXECUTION", "IDFC", "idfc_bre_eligible"),
    ("INCRED_RULE_EXECUTION", "INCRED_PL", "incred_pl_bre_eligible"),
    ("INDIFI_RULE_EXECUTION", "INDIFI_BL", "indifi_bl_bre_eligible"),
    ("LENDINGKART_RULE_EXECUTION", "LK_BL", "lk_bl_bre_eligible"),
    ("MUTHOOT_BL_RULE_EXECUTION", "MUTHOOT_BL", "muthoot_bl_bre_eligible"),
    ("MUTHOOT_RULE_EXECUTION", "MUTHOOT_PL", "muthoot_pl_bre_eligible"),
    ("TATA_PL_RULE_EXECUTION", "TATA_PL", "tata_pl_bre_eligible"),
    ("TATA_RULE_EXECUTION", "TATA_BL", "tata_bl_bre_eligible"),
    ("UNITY_BIL_RULE_EXECUTION", "UNITY_BL", "unity_bl_bre_eligible"),
    ("UNITY_SBL_RULE_EXECUTION", "UNITY_SBL", "unity_sbl_bre_eligible"),
]
RULE_PASS_VALUE = "1000"
PREFERRED_ELIGIBILITY = ["tata_bl_bre_eligible", "unity_bl_bre_eligible", "unity_sbl_bre_eligible"]
CAMPAIGN_WINDOW_DAYS = 90
