"""Mart: one row per loan application with every attribute of loan, borrower and process.

Built from sub-frames that are each unique by their key.  Borrower-keyed frames meet the
loans first (one exchange on the borrower), then the loan-keyed frames are joined on the
loan, whose frames already arrive partitioned by it from their own aggregation.

``LeadMart`` is the plan of the mart: making one, asking for its columns or narrowing it with ``select`` starts no job.
``frame`` stages what several consumers read and returns the mart as a DataFrame; only those sub-frames are
built, staged and joined that the selected columns use.

    leads = LeadMart(catalog, as_of).select("loan_id", "channel")
    with Scope(spark) as scope:
        sinks.write_mart(leads.frame(scope.stage), path)
"""

from __future__ import annotations

import re
from functools import cache, cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.config import DEFAULT_SITE, SiteConfig
from lendmart.functions import bands
from lendmart.functions.bands import classify, lookup
from lendmart.functions.dates import (age_years, date_lit, epoch_to_local_date, nonzero_epoch_date,
                                      resolve_month_name_date, text_epoch_to_date)
from lendmart.functions.text import (compose_address, extract_national_id, normalize_phone, normalize_score, percent_rate,
                                     person_name, title_clean, title_or)
from lendmart.operators import installments as ins
from lendmart.operators import leads as ld
from lendmart.operators import rows
from lendmart.operators import state_log as sl
from lendmart.sources.catalog import Catalog
from lendmart.sources.staging import stage, together, unstaged


# --- sub-frames keyed by loan ----------------------------------------------

def loan_base(catalog: Catalog, d: DataFrame) -> DataFrame:
    """Application with decoded type, state, rates and city."""
    known = d.withColumn("cnd_name", F.coalesce("cnd_name", F.lit("unknown")))
    df = catalog["loans_dedup"]
    city = F.col("cnd_group").isin(fv.CITY_GROUPS) | (F.col("cnd_code") == fv.CITY_CODE)
    # Soft-deleted applications keep their raw city text.
    df = rows.decode_embedded_code(df, "loan_city", d, city, "loan_city", only=F.col("deleted") == "N")
    df = rows.decode(df, "loan_state", known, fv.LOAN_STATE_GROUP, "loan_currentstate", key="cnd_code",
                     fold_case=True, unique=False)
    df = rows.decode(df, "other_loan_type_cnd", known, fv.OTHER_LOAN_TYPE_GROUPS, "other_loan_type")
    df = rows.decode(df, "loan_type_cnd", known, fv.LOAN_TYPE_GROUPS, "loan_type")
    df = rows.decode(df, "loan_sub_type_cnd", known, fv.LOAN_SUBTYPE_GROUPS, "loan_subtype")
    for code, name in (("loan_irate_expected", "rate_expected"), ("min_irate_apporved", "rate_min_approved"),
                       ("max_irate_approved", "rate_max_approved")):
        df = rows.decode(df, code, known, fv.RATE_GROUP, name, fold_case=True)
        rate = F.coalesce(percent_rate(name), F.lit(0).cast("decimal(10,2)"))
        df = df.withColumn(name, F.when(F.col(name).isNotNull(), rate))
    return (df.withColumnRenamed("id", "loan_id")
            .withColumn("loan_currentstate", F.initcap(F.trim("loan_currentstate")))
            .withColumn("risk_bucket", bands.risk_bucket("rate_max_approved"))
            .withColumn("loan_sub_staus", lookup("loan_sub_state", fv.LOAN_SUB_STATES))
            .withColumn("cl_created", epoch_to_local_date("created"))
            .withColumn("cl_updated", epoch_to_local_date("udated"))
            .withColumn("live_date", nonzero_epoch_date("live_date")))


def score_frame(scores: DataFrame, disbursed: DataFrame, raw: str, name: str, offset_s: int, codes, no_history: str,
                empty: str | None) -> DataFrame:
    """Bureau score valid at disbursal, or the newest one."""
    s = scores.filter(F.col("loanid").isNotNull() & F.col(raw).isNotNull() & (F.col(raw) != "")).select(
        F.col("loanid").cast("long").alias("loan_id"), normalize_score(raw, codes, no_history, empty).alias(name),
        epoch_to_local_date("created", offset_s).alias(f"{name}_date"), F.struct("created", F.col(raw)).alias("__tie"))
    return rows.asof_score(s, disbursed, "loan_id", name, f"{name}_date", "first_disburse_date", "__tie")


def log_frame(log: DataFrame, staff: DataFrame, site: SiteConfig) -> DataFrame:
    """Milestones, responsible agents and underwriting moves: one pass over the log."""
    listed = staff.select(F.col("uw_id").alias("actor"), F.lit(True).alias("is_staff"))
    log = log.join(listed, "actor", "left")
    facts = {n: sl.milestone_fact(et, states) for n, (et, states) in fv.MILESTONES.items()}
    facts["ba_uid"] = sl.last_actor_fact(fv.BORROWER_AGENT_TRANSITIONS, site.system_actors)
    facts["preuw_uid"] = sl.last_actor_fact(fv.PREUW_TRANSITIONS, site.system_actors)
    facts["uwac_created"] = sl.first_entry_fact(fv.ACCEPTED_STATE)
    facts.update(sl.underwriting_facts(site.system_actors))
    return sl.log_facts(log, facts).withColumnRenamed("entity", "loan_id")


def underwriting_frame(catalog: Catalog, facts: DataFrame, staff: DataFrame) -> DataFrame:
    """Milestones and agents of a loan, its assigned underwriter and the actors of the final moves.

    ``facts`` are the log facts; loans known to the allocation jobs only are added.
    """
    alloc = sl.parsed_allocation(catalog["job_log"], catalog["job_steps"], catalog["loans_dedup"])
    df = facts.join(alloc, "loan_id", "full")
    at = F.coalesce("uwas_assigned_date", "uwac_created", "uw_last_at")
    df = df.withColumn("__assigned", F.coalesce("uwas_id", "uw_last"))
    # Underwriting columns exist for loans with an assigned underwriter only.
    known = F.col("__assigned").isNotNull()

    def named(frame, key, name):
        s = staff.select(F.col("uw_id").alias("__id"), F.col("uw_name").alias(name))
        return frame.join(s, frame[key] == s["__id"], "left").drop("__id")

    df = named(df, "uwas_id", "__alloc_name")
    df = named(df, "uw_last", "__last_name")
    for slot in fv.UW_SLOTS:
        df = named(df.withColumnRenamed(f"uw_{slot}", f"__{slot}"), f"__{slot}", f"uw_{slot}")
    return df.select(
        "loan_id", *fv.MILESTONES, "ba_uid", "preuw_uid",
        F.col("__assigned").alias("uw_assigned_id"), F.when(known, F.coalesce("__alloc_name", "__last_name")).alias("uw_name"),
        F.when(known, at).alias("uw_assigned_date"), F.when(known, F.last_day(F.to_date(at))).alias("uw_lastday_assigned_date"),
        *[F.when(known, F.col(c)).alias(c) for slot in fv.UW_SLOTS for c in (f"uw_{slot}", f"uw_{slot}_date")])


def info_kinds() -> dict:
    """Purpose of an additional-info row -> condition; the conditions exclude each other."""
    a = F.col("action_type")
    eav = F.lit(False)
    for pattern in fv.EAV_PATTERNS.values():
        eav = eav | F.lower(a).like(pattern)
    return {"remark": a.like("loan_state_remark%"), "reference": a == "REFERENCE_DETAILS",
            "permanent": a == "USER_PERMANENT_INFO", "deviation": a.isin(fv.DEVIATION_ACTIONS), "answer": eav}


def split_info(info: DataFrame, stage) -> dict[str, DataFrame]:
    """One scan of the attribute table, written by purpose; consumers prune to their share."""
    kind = None
    for name, cond in info_kinds().items():
        kind = F.when(cond, name) if kind is None else kind.when(cond, name)
    tagged = info.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    staged = stage(tagged, "additional_info", "kind")
    return {name: staged.filter(F.col("kind") == name).drop("kind") for name in info_kinds()}


def ops_remarks(info: DataFrame, logins: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Remarks and decoded reasons of state changes made by known users."""
    i = rows.active_only(info)
    known = (i.filter(F.col("action_type").like("loan_state_remark%"))
             .select("loan_id", F.col("created_by").cast("string").alias("by"))
             .join(logins.select(F.col("uid").cast("string").alias("by")), "by", "left_semi").select("loan_id").distinct())
    remark = rows.string_collect(i.filter(F.col("action_type") == "loan_state_remark"), "loan_id", "value1", "ops_remark")
    reasons = i.filter(F.col("action_type") == "loan_state_remark_reason").select("loan_id", "value1")
    labels = dictionary.select(F.col("id").cast("string").alias("value1"), "cnd_name")
    reasons = reasons.join(labels, "value1", "left").withColumn("reason", F.coalesce("cnd_name", "value1"))
    reason = rows.string_collect(reasons, "loan_id", "reason", "ops_reason")
    return known.join(remark, "loan_id", "left").join(reason, "loan_id", "left")


def reference_contacts(info: DataFrame) -> DataFrame:
    """Up to eight reference persons side by side."""
    names = ["ref_name"] + [f"ref_name_{i}" for i in range(1, 8)]
    phones = ["ref_contact"] + [f"ref_contact_{i}" for i in range(1, 8)]
    r = rows.active_only(info).filter(F.col("action_type") == "REFERENCE_DETAILS").select(
        "loan_id", *[F.initcap(F.coalesce(c, F.lit(""))).alias(n) for c, n in (("value1", "n"), ("value2", "p"))]).distinct()
    return rows.slots_wide(r, "loan_id", [F.col("n").asc(), F.col("p").asc()], {"n": names, "p": phones}, 8)


def permanent_contacts(info: DataFrame) -> DataFrame:
    """Up to two permanent addresses; soft-deleted entries count too."""
    cols = {"a": ["permannent_address", "permannent_address_1"], "b": ["permannent_contact", "permannent_contact_1"],
            "c": ["permannent_contact1", "permannent_contact1_1"]}
    r = info.filter(F.col("action_type") == "USER_PERMANENT_INFO").select(
        "loan_id", *[F.initcap(F.coalesce(v, F.lit(""))).alias(n) for v, n in (("value1", "a"), ("value2", "b"), ("value3", "c"))])
    return rows.slots_wide(r.distinct(), "loan_id", [F.col(c).asc() for c in cols], cols, 2)


def eav_values(info: DataFrame) -> DataFrame:
    """Newest obligation, savings, income and ratio answers: one grouped pass."""
    def like(kind):
        return F.lower("action_type").like(fv.EAV_PATTERNS[kind])
    v1, v2, v3 = F.col("value1"), F.col("value2"), F.col("value3")
    return rows.latest_value(rows.active_only(info), "loan_id", {
        "total_obligation": (like("obligation"), F.coalesce(v2, v1)),
        "obligation": (like("obligation"), F.coalesce(v1, v2)),
        "savings": (like("obligation"), v3),
        "income": (like("income"), F.coalesce(v3, v1)),
        "foir_before": (like("ratio"), v1),
        "foir_after": (like("ratio"), v2)})


def identity_frame(addresses: DataFrame) -> DataFrame:
    """Newest identity document with cleaned names and address."""
    a = rows.latest_by(rows.active_only(addresses), "loan_id", [F.col("id").desc()])
    parts = ["House_number", "locality", "vtc", "sub_district", "district", "state"]
    cleaned = {"adhaar_name": "name", "adhaar_state": "state", "adhaar_district": "district",
               "adhaar_sub_district": "sub_district", "adhaar_street": "street", "adhaar_vtc": "vtc",
               "adhaar_house_number": "House_number", "adhaar_locality": "locality"}
    return a.select("loan_id", F.col("dob").alias("adhaar_dob"), F.col("gender").alias("adhaar_gender"),
                    *[title_clean(c).alias(n) for n, c in cleaned.items()],
                    compose_address(parts, drop="null", squeeze=False).alias("adhaar_fulladdress"),
                    F.coalesce(F.upper(F.trim(F.regexp_replace("adhaar", "null", ""))), F.lit("")).alias("adhaar_adhaar"))


def bank_balance(months: DataFrame, loans: DataFrame) -> DataFrame:
    """Mean balance of the latest three statement months."""
    m = rows.active_only(months).filter(
        (F.col("action_type") == "detailed_banking_info") & F.col("monthly_amount").isNotNull())
    m = m.select(F.col("loanid").alias("loan_id"), "month", "date_cnd", "monthly_amount").join(
        loans.select("loan_id", "cl_created"), "loan_id")
    m = m.withColumn("day", resolve_month_name_date("month", "date_cnd", "cl_created"))
    return rows.recent_months_average(m, "loan_id", "day", "monthly_amount", "monthly_average_balance")


LOAN_DETAIL_COLUMNS = [
    "child", "dependent", "total_exp", "sibling", "cibil", "equinox", "gross_salary_m", "take_home_salary_m",
    "deductions_m", "field1", "dept", "business_reg_proof", "business_owner_proof", "itr_gstin_proof", "itr_ack_num",
    "itr_valid_message", "itr_valid_status", "refer_product", "is_nbfc_pass",
]


def detail_frame(details: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Newest detail record of a loan; a deleted newest record leaves the loan without one."""
    d = rows.latest_by(details, "loan_id", [F.col("id").desc()])
    d = rows.decode(rows.active_only(d), "residence_type_cnd", dictionary, "RESIDENCE_TYPE", "__res")
    residence = lookup("residence_type_cnd", fv.RESIDENCE_TYPES, F.initcap(F.coalesce("__res", F.lit("unknown"))))
    return d.select("loan_id", residence.alias("residence_type"),
                    text_epoch_to_date("residence_shifting_date").alias("residence_shifting_date"),
                    *LOAN_DETAIL_COLUMNS)


# --- borrower side ---------------------------------------------------------

def borrower_frame(catalog: Catalog, people: DataFrame, dictionary: DataFrame, wanted=None) -> DataFrame:
    """Users with roles, employment, account and pincode attributes: one row per user.

    ``wanted`` (a function from columns to whether any is wanted) leaves out parts.
    """
    wanted = wanted or (lambda columns: True)
    users = ld.user_profile(catalog["users"], people, dictionary).drop("deleted", "created", "udated")
    pins = catalog["pincode_master"].select("pincode", "city_pin", "district", F.col("state").alias("pin_state"), "zone")
    if wanted(("city_pin", "district", "pin_state", "zone")):
        users = users.join(pins, users["pin"] == pins["pincode"], "left").drop("pincode")
    if wanted(("employement_type", *EMPLOYMENT_COLUMNS)):
        users = users.join(ld.employment_profile(catalog["employment"], dictionary, catalog["pincode_master"]), "uid", "left")
    if wanted(ACCOUNT_COLUMNS):
        users = users.join(ld.primary_account(catalog["bank_accounts"], catalog["loans"]), "uid", "left")
    return users


def reference_borrowers(people: DataFrame, users: DataFrame) -> DataFrame:
    """Contact data of the main borrower an application refers to."""
    u = users.select(F.col("uid").alias("referenceid_loan"), person_name("fname", "lname").alias("loan_main_borrower_name"),
                     F.initcap(F.trim(F.coalesce("fname", F.lit("")))).alias("loan_main_borrower_first_name"),
                     F.col("mobile").alias("loan_main_borrower_mobile"), F.col("landline").alias("loan_main_borrower_landline"))
    p = people.select(F.col("uid").alias("referenceid_loan"), F.col("email_user").alias("loan_main_borrower_email"))
    return u.join(p, "referenceid_loan", "left")


# --- the mart --------------------------------------------------------------

PASS_THROUGH_LOAN = [
    "loan_desc", "tenure", "loan_amount_expected", "rate_expected", "rate_min_approved", "rate_max_approved",
    "max_amount_approved", "risk_bucket", "verified_personal", "verified_professional", "percent_fund",
    "editor_comment", "document_pending", "underwriting_pending", "doc_verify", "delisting", "risk", "processing_fee",
    "remark", "total_settlement_amount", "settlement_term", "product_tag", "loan_img1", "loan_img2", "pd_value",
    "pd_status", "loan_sub_staus", "live_date",
]
PASS_THROUGH_USER = [
    "pan", "spouse", "father", "mother", "aadhaar_number", "marital_status", "reg_step", "source", "old_source",
    "mobile_verify", "registration_type", "source_type", "gst", "relation_type", "campaign_id", "is_pan_verified",
    "agent_uid", "sub_agent_uid", "portfolio_manager", "parent_uid", "email_org_user",
]
EMPLOYMENT_COLUMNS = [
    "is_current_employement", "comp_designation", "comp_name", "comp_address", "comp_city", "comp_state", "comp_tenure",
    "comp_pin", "comp_phone", "comp_email", "comp_startdate", "com_enddate", "comp_businesstype", "comp_industry",
    "comp_profit", "comp_depreciation", "comp_salarypaid", "comp_officeownership", "is_verified", "designation_level",
    "comp_profession", "other_salariespaid", "work_exp", "previous_takehomesalary", "business_type", "comp_officetype",
    "comp_noofemployee", "comp_turnover", "comp_registrationno", "comp_contactno2", "comp_natureofbusiness",
    "comp_industrytype", "comp_subindustrytype", "caution_profile", "comp_cashcomponent",
]
ACCOUNT_COLUMNS = ["account_name", "account_number", "account_ifsc", "account_type", "branch_add", "bank_name", "micr_number"]
ROLE_RESULTS = {
    # result prefix, role, {result suffix: field}
    "user_jobassigned": ("jobassigned", {"name": "namec", "mobile": "mobile", "landline": "landline", "email": "email"}),
    "user_portfoliomanager": ("portfolio_manager", {"name": "namec", "mobile": "mobile", "landline": "landline", "email": "email"}),
}
AGENT_RESULTS = {
    "user_org_agents_name": "namec_org_agent", "user_agents_name": "name_agent", "user_agent_mobile": "mobile_agent",
    "user_agent_landline": "landline_agent", "user_agent_email": "email_agent", "user_org_agent_email": "email_org_agent",
    "user_sub_agent_name": "namec_sub_agent", "user_org_sub_agent_name": "namec_org_sub_agent",
    "user_sub_agents_name": "name_sub_agent", "user_sub_agent_mobile": "mobile_sub_agent",
    "user_sub_agent_landline": "landline_sub_agent", "user_sub_agent_email": "email_sub_agent",
    "user_org_sub_agent_email": "email_org_sub_agent",
}
AGENT_FIELDS = {"name": "name_user", "mobile": "mobile_user", "login_name": "namec_org_user",
                "login_name_clean": "namec_user", "email_original": "email_org_user", "name_from_email": "email_user"}


def loan_frames(catalog: Catalog, people: DataFrame, dictionary: DataFrame, base: DataFrame, site: SiteConfig, stage) -> dict:
    """Every loan-keyed sub-frame, each with one row per loan, as a function that builds it; parts they share are staged once."""
    info = cache(lambda: split_info(catalog["additional_info"], stage))
    disbursed = cache(lambda: stage(ins.register_rollup(catalog["payment_register"], site.ignored_payees), "disbursed"))

    def proposals():
        rollup = ins.proposal_rollup(ins.collected_proposals(catalog["proposals"], catalog["proposal_collections"]),
                                     site.priority_lenders, site.other_portfolio)
        return rollup.withColumnsRenamed({"first_day": "first_proposal_date", "last_day": "last_proposal_date"})

    def mandates():
        return ld.mandate_status(ld.best_mandate(catalog["mandates"]), ld.subscription_counts(catalog["subscriptions"]),
                                 ld.bank_mandate_counts(catalog["bank_mandates"])).drop("nach_priority")

    def rules():
        found = sl.daily_rule_outcome(catalog["rule_runs"], site.fill(fv.RULE_ACTIONS))
        return found.withColumnsRenamed({"rule_pass_date": "__pass", "rule_reject_date": "__reject"})

    def underwriting():
        staff = rows.latest_by(catalog["uw_master"].select(F.col("uw_id").cast("long").alias("uw_id"), "uw_name"),
                               "uw_id", [F.col("uw_name").asc()])
        return underwriting_frame(catalog, log_frame(sl.state_log(catalog["state_log"]), staff, site), staff)

    return {
        "disbursed": disbursed, "proposals": proposals,
        "tu": lambda: score_frame(catalog["tu_scores"], disbursed(), "cibil_score", "cibil_score", 0, fv.SCORE_CODES, "1", None),
        "crif": lambda: score_frame(catalog["crif_scores"], disbursed(), "score", "crif_score", fv.IST_OFFSET_S, None, "0", "0"),
        "underwriting": underwriting,
        "remarks": lambda: ops_remarks(info()["remark"], catalog["logins"], catalog["dictionary"]),
        "references": lambda: reference_contacts(info()["reference"]), "permanent": lambda: permanent_contacts(info()["permanent"]),
        "answers": lambda: eav_values(info()["answer"]), "deviations": lambda: ld.deviation_counts(info()["deviation"], people),
        "identity": lambda: identity_frame(catalog["identity_addresses"]), "balance": lambda: bank_balance(catalog["bank_months"], base),
        "detail": lambda: detail_frame(catalog["loan_detail"], dictionary), "mandates": mandates,
        "cheques": lambda: ld.cheque_counts(catalog["cheques"]), "rules": rules,
        "flags": lambda: ld.lead_existence_flags(catalog["bureau_ignore"], catalog["loans"]), "fees": lambda: ins.fee_totals(catalog["transactions"]),
    }


# Columns of the frames keyed by loan; the same whatever the catalog, so they are looked at once.
_FRAME_COLUMNS: dict[str, list[str]] = {}


def words_in(c: Column) -> set[str]:
    """The names that an expression mentions, and other words; more than it uses at worst."""
    return set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", str(c)))


def alias_of(c) -> str:
    """The name of a column, or of the column a name stands for."""
    if isinstance(c, str):
        return c
    return re.search(r"(?:^Column<'| AS )`?([A-Za-z_][A-Za-z_0-9]*)`?'>$", str(c))[1]


def named(columns: dict) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


class LeadMart:
    """The plan of the lead mart, or of some of its columns."""

    def __init__(self, catalog: Catalog, as_of, site: SiteConfig = DEFAULT_SITE, columns=None):
        self.catalog, self.as_of, self.site, self.selected = catalog.opened(), as_of, site, None if columns is None else list(columns)

    def select(self, *columns: str) -> "LeadMart":
        unknown = [c for c in columns if c not in self.columns]
        if unknown:
            raise ValueError(f"no such columns: {unknown}")
        narrowed = LeadMart(self.catalog, self.as_of, self.site, columns)
        narrowed.__dict__.update(catalog=self.catalog, schemas=self.schemas)
        return narrowed

    @property
    def columns(self) -> list[str]:
        return self.every_column if self.selected is None else self.selected

    # --- what there is, and what it needs: analysis only, no job

    @cached_property
    def schemas(self) -> dict[str, list[str]]:
        """Columns of every frame keyed by loan."""
        if not _FRAME_COLUMNS:
            dictionary, people, base = self.shared_frames(unstaged)
            frames = loan_frames(self.catalog, people, dictionary, base, self.site, unstaged)
            _FRAME_COLUMNS.update({n: [c for c in build().columns if c != "loan_id"] for n, build in frames.items()})
        return _FRAME_COLUMNS

    @cached_property
    def names(self) -> list[str]:
        return [c for part in self.schemas.values() for c in part]

    @cached_property
    def every_column(self) -> list[str]:
        given = [n for n in (*self.first(self.names), *self.labels()) if n not in ("__ch", "__sub", "__cat")]
        people = [f"{who}_{n}" for who in ("ba", "preuw") for n in AGENT_FIELDS]
        return ["report_datetime", *dict.fromkeys([*given, "rm", *people, *self.after()]), *self.flags()]

    def needs(self) -> tuple[set[str], set[str]]:
        """Columns that have to be made for the selected ones, and the words of what they read of the wide row."""
        made = {**self.first(self.names)}
        levels = [self.flags(), self.after(), self.labels()]
        known = [*made, *(n for level in levels for n in level), "rm", "disp_name"]
        todo, seen, read = list(self.columns), set(), {"loan_id"}
        while todo:
            c = todo.pop()
            if c in seen:
                continue
            seen.add(c)
            who = re.match(r"(ba|preuw)_(.+)$", c)
            level = next((x for x in levels if c in x), None)
            if level is not None:
                todo += words_in(level[c]) & set(known)
            elif c == "rm":
                todo += ["sub_agent_uid", "agent_uid", "source", "sub_category", "channel"]
            elif c == "disp_name":
                todo.append("plus")
            elif who and who[2] in AGENT_FIELDS:
                todo.append(f"{who[1]}_uid")
            if c in made:
                read |= words_in(made[c])
        return seen, read

    # --- the wide row

    def shared_frames(self, stage) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Dictionary, people and applications, which several frames read."""
        catalog = self.catalog
        dictionary, people = together(
            lambda: stage(rows.active_only(catalog["dictionary"]), "dictionary"),
            lambda: stage(ld.people_dimension(catalog["logins"], catalog["users"], self.site), "people"))
        return dictionary, people, stage(loan_base(catalog, dictionary), "loan_base")

    def wide(self, stage, read: set[str] | None):
        """Applications with their borrowers, and builders of the frames keyed by loan."""
        catalog, site = self.catalog, self.site
        wanted = lambda columns: read is None or bool(read & set(columns))
        dictionary, people, base = self.shared_frames(stage)
        self.shared = dictionary, people
        borrowers = stage(borrower_frame(catalog, people, dictionary, wanted), "borrowers")
        # Borrower-keyed joins first, loan-keyed joins after; the whole mart's row is packed, so that joins
        # do not write its columns one by one.
        loan_cols = [c for c in base.columns if c not in ("uid", "deleted", "created", "udated", "updated_by", "reference_id")]
        df = base.select(*loan_cols, F.col("uid").alias("uid"), F.col("updated_by").alias("__updated_by"),
                         F.col("reference_id").cast("long").alias("referenceid_loan"))
        pack = rows.packed if read is None else rows.not_packed
        df = pack(df, ["loan_id", "uid", "tenure", "__updated_by", "referenceid_loan"], "loan")
        df = df.join(pack(borrowers, ["uid", "source"], "borrower"), "uid")
        # Staff and main borrowers are fewer than people: as tables their sizes are known, so that the whole mart's row need not be
        # moved to meet them.
        apart = stage if read is None else unstaged
        met = lambda who, key: ld.referenced_people(who, base, [key]) if read is None else who
        updated_by = {"loan_updatedby_name": "namec_user", "loan_updatedby_mobile": "mobile_user",
                      "loan_updatedby_landline": "landline_user", "loan_updatedby_email": "email_user"}
        if wanted(updated_by):
            df = ld.attach_person(df, apart(met(people, "updated_by"), "updating_staff"), "__updated_by", updated_by)
        if wanted([f"loan_main_borrower_{c}" for c in MAIN_BORROWER]):
            main = apart(reference_borrowers(people, met(catalog["users"], "reference_id")), "main_borrowers")
            df = df.join(main, "referenceid_loan", "left")
        if wanted(("__ch", "__sub", "__cat")):
            dim = ld.channel_dimension(catalog["channel_master"]).withColumnsRenamed(
                {"channel": "__ch", "sub_category": "__sub", "category": "__cat"})
            dim = apart(dim, "channels")
            df = df.join(dim, ld.source_key("source") == dim["source_key"], "left").drop("source_key")
        if wanted(("tenure_months", "tenure_monthsno")):
            tenure = catalog["tenure_master"].select(F.col("tenure_code").alias("tenure"), "tenure_months",
                                                     F.col("tenure").alias("tenure_monthsno"))
            df = df.join(tenure, "tenure", "left")
        return df, loan_frames(catalog, people, dictionary, base, site, stage)

    # --- columns, level by level

    def first(self, names: list[str]) -> dict[str, Column]:
        """Columns from the wide row."""
        site, as_of = self.site, self.as_of
        first_disb = F.coalesce("first_disburse_date", "first_proposal_date")
        last_disb = F.coalesce("last_disburse_date", "last_proposal_date")
        cancelled_state = F.col("loan_state") == 10
        state = F.when(~F.coalesce(cancelled_state, F.lit(False)), F.col("loan_currentstate")).otherwise("Cancelled")
        agent = ld.agent_label(site, "__sub")
        product = F.upper(F.coalesce("product_type", F.lit("Others")))
        born, reg = F.col("cu_dob"), F.col("cl_created")
        age = age_years(born, reg)
        city = lookup("loan_city", fv.CITY_OVERRIDES, F.initcap(F.trim(F.coalesce("loan_city", F.lit("")))))
        registration = ld.registration_method(as_of)

        out = [
            "loan_id", product.alias("product_type"), title_or("loan_type", "Others").alias("loan_type"),
            title_or("loan_subtype", "Others").alias("loan_subtype"),
            title_or("other_loan_type", "Others").alias("loan_othertype"),
            state.alias("loan_currentstate"),
            ld.default_portfolio(site).alias("portfolio_type"), F.col("uid").alias("user_id"),
            *[c.alias(n) for n, c in sl.rule_window_flags("cl_created", "livec_date", "__pass", "__reject").items()],
            *[c for c in PASS_THROUGH_LOAN if c != "tenure"], *PASS_THROUGH_USER,
            "allocated_date", "accepted_date", F.col("livec_date").alias("actual_live_date"), "rfd_date",
            "first_proposal_date", F.trunc("first_proposal_date", "month").alias("first_proposal_month"),
            "last_proposal_date", F.trunc("last_proposal_date", "month").alias("last_proposal_month"), "proposal_amount",
            first_disb.alias("first_disburse_date"), F.trunc(first_disb, "month").alias("first_disburse_month"),
            last_disb.alias("last_disburse_date"), F.trunc(last_disb, "month").alias("last_disburse_month"),
            F.coalesce(F.col("disburse_amount").cast("decimal(38,2)"), F.col("proposal_amount").cast("decimal(38,2)")).alias("disburse_amount"),
            "tenure_months", "tenure_monthsno", reg.alias("loan_registered_date"), F.col("cl_updated").alias("loan_updated_date"),
            *[f"loan_updatedby_{c}" for c in ("name", "mobile", "landline", "email")],
            "uw_name", "uw_assigned_date", *[c for s in fv.UW_SLOTS for c in (f"uw_{s}", f"uw_{s}_date")],
            "ops_remark", "ops_reason", city.alias("loan_city"), F.col("original_loan_amt").alias("loan_original_amount"),
            person_name("fname", "lname").alias("user_name"), F.col("fname").alias("user_fname"), F.col("lname").alias("user_lname"),
            extract_national_id("pan", site.fill(fv.ID_STATUS_TOKENS)).alias("user_pan"),
            "cibil_score", "crif_score", "crif_score_date",
            F.when(~F.col("bureau_code").isin("null", "", "NaN"), F.col("bureau_code").try_cast("int")).alias("bureau_score"),
            born.alias("user_dob"), age.alias("age_loanregister"), age_years(born, date_lit(as_of)).alias("age_current"),
            bands.generation(age).alias("generations"),
            compose_address(["address", "add", "add2", "landmark"]).alias("user_fulladdress"),
            F.col("address").alias("user_address"), F.col("add").alias("user_address1"), F.col("add2").alias("user_address2"),
            F.col("landmark").alias("user_landmark"), F.col("pin").alias("user_pin"),
            F.coalesce("city_pin", F.lit("")).alias("user_city"), F.coalesce("district", F.lit("")).alias("user_district"),
            F.coalesce("pin_state", "origion_state", F.lit("")).alias("user_state"), F.coalesce("zone", F.lit("")).alias("user_zone"),
            F.col("city").alias("user_input_city"), F.coalesce("city_pin", "city").alias("user_final_city"),
            F.col("input_state").alias("user_input_state"),
            F.coalesce("pin_state", "input_state", "origion_state").alias("user_final_state"),
            F.col("origion_state").alias("user_origion_state"), F.col("mobile").alias("user_mobile"),
            normalize_phone("mobile").alias("bor_mobile"), F.col("landline").alias("user_landline"),
            normalize_phone("landline").alias("bor_landline"), F.col("email_user").alias("user_email"),
            F.col("cu_created").alias("user_created_date"), F.col("cu_updated").alias("user_updated_date"),
            *[F.col(f"{field}_{role}").alias(f"{prefix}_{suffix}")
              for prefix, (role, fields) in ROLE_RESULTS.items() for suffix, field in fields.items()],
            agent.alias("user_agent_name"), *[F.col(c).alias(n) for n, c in AGENT_RESULTS.items()],
            F.col("religion").alias("user_religion"), F.col("caste").alias("user_caste"),
            F.col("mothertounge").alias("user_mothertounge"), F.coalesce("gender", F.lit("Unknown")).alias("gender"),
            classify("highest_education", fv.EDUCATION_LEVELS, "Unknown").alias("highest_education"),
            "total_obligation", "obligation", "savings", "income", "foir_before", "foir_after", "monthly_average_balance",
            *[c for c in LOAN_DETAIL_COLUMNS if c != "field1"], F.coalesce("residence_type", F.lit("Unknown")).alias("residence_type"),
            F.col("field1").alias("user_devicename"),
            F.coalesce("employement_type", F.lit("Unknown")).alias("employement_type"), *EMPLOYMENT_COLUMNS,
            *[c for c in names if c.startswith("adhaar_")], "referenceid_loan",
            *[f"loan_main_borrower_{c}" for c in ("name", "first_name", "mobile", "landline", "email")],
            *[c for c in names if c.startswith(("permannent_", "ref_name", "ref_contact"))],
            F.coalesce("plus", F.lit(0)).alias("plus"), F.col("minus").alias("call_stat"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("fraud_flag", "ignore_flag", "ex360_npa")],
            F.when(state == "Foreclosure Initiated", F.col("foreclosure_created")).alias("foreclosure_initiated_date"),
            F.col("cancelled_created").alias("cancelled_date"),
            F.when((F.col("cancelled_created") >= F.col("livec_date")) & ((state == "Cancelled") | cancelled_state),
                   F.col("cancelled_created")).alias("delist_date"),
            "mandate_id", *[c for c in names if c.startswith("nach_")],
            "enach_approved_date", "mandate_link_created", "enach_first_link_created_date", "enach_active_subscription_date",
            "mandate_active", "icici_mandate_link_created", "icici_mandate_active", "icici_mandate_first_created_date",
            "icici_mandate_active_date", "mandate_status",
            *[c.alias(n) for n, c in registration.items()],
            *[c for c in names if c.startswith("cheque_")],
            "dev_created_by", "dev_exists", "total_dev", *[n for n, _, _ in fv.DEVIATION_CLASSES], *ACCOUNT_COLUMNS,
            "registration_fees", "processing_fees", "ba_uid", "preuw_uid", "__ch", "__sub", "__cat"]
        return {alias_of(c): F.col(c) if isinstance(c, str) else c for c in out}

    def labels(self) -> dict[str, Column]:
        return ld.attribute_channel(self.site, channel="__ch", sub_category="__sub", category="__cat")

    def after(self) -> dict[str, Column]:
        """Columns from those above, the disposition and the people."""
        return {"call_disposition": ld.disposition(), "call_status": lookup("call_stat", fv.CALL_STATES), **sl.resolve_latest_event(), **sl.prequal_flags(),
                "disbursed_flag": F.when(F.col("first_disburse_date").isNotNull(), 1).otherwise(0)}

    def flags(self) -> dict[str, Column]:
        def flag(c):
            return F.when(c, 1).otherwise(0)

        status = F.col("uw_status_final")
        return {
            "uw_allocated_flag": flag(F.col("uw_name_final") != "UW Not Assigned"), "uw_cancelled_flag": flag(status == "Cancelled"),
            "uw_returned_flag": flag(status == "Returned"), "uw_forward_to_cs_flag": flag(status == "Forward to CS"), "uw_live_flag": flag(status == "Live"),
            "delist_flag": flag((F.col("delist_date") > F.col("uw_updated_date")) & (F.col("loan_currentstate") == "Cancelled") & (status == "Live"))}

    # --- the mart

    def frame(self, stage=stage) -> DataFrame:
        """Build the mart.  What several consumers read is staged once as a table."""
        seen, read = (None, None) if self.selected is None else self.needs()
        made = lambda n: seen is None or n in seen
        df, frames = self.wide(stage, read)
        used = {n: build for n, build in frames.items() if read is None or read & set(self.schemas[n])}
        # What several frames share is staged before them, side by side.
        together(*(frames[n] for n in ("disbursed", "remarks") if any(x in used for x in SHARING[n])))
        pack = rows.packed if read is None else rows.not_packed
        parts = [pack(build(), "loan_id", n) for n, build in used.items()]
        df = rows.unpacked(reduce(lambda left, right: left.join(right, "loan_id", "left"), parts, df))
        agents = [who for who in ("ba", "preuw") if any(made(f"{who}_{n}") for n in AGENT_FIELDS)]
        if agents:
            # The wide row is written once: agents are picked from it, and everything below is derived from it.
            df = stage(df, "applications")
        dictionary, people = self.shared
        out = df.select(*named({n: c for n, c in self.first(self.names).items() if made(n)}))
        # Columns that depend on the ones above.
        out = out.select("*", *named({n: c for n, c in self.labels().items() if made(n)})).drop("__ch", "__sub", "__cat")
        order = out.columns
        out = pack(out, [c for c in ATTACHED_BY if c in order], "row")
        if made("disp_name"):
            d = rows.dictionary_slice(dictionary, "DISPOSITION", key="cnd_code") \
                    .groupBy("__code").agg(F.min("__label").alias("disp_name"))
            out = out.join(d, out["plus"].cast("string") == d["__code"], "left").drop("__code")
        if made("rm"):
            # Few rows each, which only shows when they are tables: no row of the mart is moved to meet them.
            reps = together(lambda: stage(ld.agent_reps(self.catalog["rep_assignments"]), "agent_reps"),
                            lambda: stage(ld.source_reps(self.catalog["source_owners"], people), "source_reps"))
            out = ld.assign_rep(out, *reps, self.site)
        if agents:
            # A table, so that its size is known and the wide row is not moved to meet few agents.
            known = stage(ld.referenced_people(people, df, [f"{who}_uid" for who in agents]), "agents")
            for who in agents:
                out = ld.attach_person(out, known, f"{who}_uid", {f"{who}_{n}": f for n, f in AGENT_FIELDS.items()},
                                       spread_by="loan_id")
        out = rows.unpacked(out)
        out = out.select(*order, *[c for c in out.columns if c not in order])
        out = out.select("*", *named({n: c for n, c in self.after().items() if made(n)}))
        out = out.select(date_lit(self.as_of).alias("report_datetime"), "*", *named({n: c for n, c in self.flags().items() if made(n)})).drop("disp_name")
        return out if self.selected is None else out.select(*self.selected)


# Frames whose first one, once built, has staged what they share.
SHARING = {"disbursed": ("disbursed", "tu", "crif"), "remarks": ("remarks", "references", "permanent", "answers", "deviations")}
# What dispositions, representatives and agents are attached by.
ATTACHED_BY = ("loan_id", "plus", "sub_agent_uid", "agent_uid", "source", "sub_category", "channel", "ba_uid", "preuw_uid")
MAIN_BORROWER = ("name", "first_name", "mobile", "landline", "email")


def lead_details(catalog: Catalog, as_of, site: SiteConfig = DEFAULT_SITE, stage=stage) -> DataFrame:
    """All columns of the mart."""
    return LeadMart(catalog, as_of, site).frame(stage)


# Published columns of the two projections.
CHANNEL_COLUMNS = {"lead_id": "loan_id", "source": "source", "channel": "channel", "sub_category": "sub_category",
                   "category": "category"}
BORROWER_COLUMNS = {
    "loan_id": "loan_id", "lead_registered_date": "loan_registered_date", "loan_type": "loan_type",
    "loan_subtype": "loan_subtype", "loan_othertype": "loan_othertype", "product_type": "product_type",
    "lead_current_status": "loan_currentstate", "lead_description": "loan_desc", "borrower_id": "user_id",
    "risk_bucket": "risk_bucket", "borrower_name": "user_name", "borrower_pan": "user_pan", "cibil_score": "cibil_score",
    "crif_score": "crif_score", "borrower_dob": "user_dob", "borrower_age_loandate": "age_loanregister",
    "borrower_generation": "generations", "borrower_address": "user_fulladdress", "borrower_pin": "user_pin",
    "borrower_city": "user_city", "borrower_district": "user_district", "borrower_state": "user_state",
    "borrower_zone": "user_zone", "borrower_final_city": "user_final_city", "borrower_final_state": "user_final_state",
    "borrower_origion_state": "user_origion_state", "borrower_mobile": "user_mobile", "borrower_landline": "user_landline",
    "borrower_email": "user_email", "borrower_created_date": "user_created_date",
    "borrower_jobassigned_name": "user_jobassigned_name", "borrower_jobassigned_mobile": "user_jobassigned_mobile",
    "borrower_jobassigned_email": "user_jobassigned_email", "borrower_agent_name": "user_agent_name",
    "borrower_agent_mobile": "user_agent_mobile", "borrower_agent_email": "user_agent_email", "borrower_gender": "gender",
    "borrower_adhaarnumber": "aadhaar_number", "borrower_spouse_name": "spouse", "borrower_father_name": "father",
    "borrower_mother_name": "mother", "loan_main_borrower_first_name": "loan_main_borrower_first_name",
    "loan_main_borrower_name": "loan_main_borrower_name", "loan_main_borrower_mobile": "loan_main_borrower_mobile",
    "loan_main_borrower_landline": "loan_main_borrower_landline", "loan_main_borrower_email": "loan_main_borrower_email",
}


def lead_channel(leads: DataFrame) -> DataFrame:
    return leads.select(*[F.col(s).alias(n) for n, s in CHANNEL_COLUMNS.items()])


def lead_borrower(leads: DataFrame | LeadMart, stage=stage) -> DataFrame:
    """The borrower's columns, from the mart as a table, or from its plan, of which only what they use is built."""
    if isinstance(leads, LeadMart):
        leads = leads.select(*dict.fromkeys(BORROWER_COLUMNS.values())).frame(stage)
    return leads.select(*[F.col(s).alias(n) for n, s in BORROWER_COLUMNS.items()])
