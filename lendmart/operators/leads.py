"""Lead attributes: channels, representatives, mandates, accounts, people, employment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.config import SiteConfig
from lendmart.functions.bands import classify, lookup
from lendmart.functions.dates import col, date_lit, epoch_to_local_date, parse_messy_date, safe_epoch_date
from lendmart.functions.text import (canonical_state, filled, person_name, scrub_status_prefix,
                                     title_or)
from lendmart.operators.rows import active_only, conditional_counts, decode, latest_by


# --- channel ---------------------------------------------------------------

def channel_dimension(master: DataFrame) -> DataFrame:
    """One row per source, ignoring case; the most complete one wins."""
    key = F.lower(F.coalesce("channel_source", F.lit("")))
    parts = ["channel", "sub_category", "category"]
    order = [F.when(filled(p), 0).otherwise(1) for p in parts] + [F.col(p).asc_nulls_last() for p in parts]
    return latest_by(master.select(key.alias("source_key"), *parts), "source_key", order)


def source_key(source) -> Column:
    """Join key of a lead source; NULL for blank sources so they match nothing."""
    return F.lower(F.nullif(F.trim(col(source)), F.lit("")))


def attribute_channel(site: SiteConfig, agent="user_agent_name", product="product_type",
                      channel="channel", sub_category="sub_category", category="category") -> dict[str, Column]:
    """Agent overrides, then agents without a specific channel, then the partner product, then the dimension."""
    a, ch = col(agent), col(channel)
    organic = ch.isNull() | (ch == site.organic_channel)
    agentish = ch.isNull() | ch.isin(site.organic_channel, site.agent_channel[0])
    out = {}
    for i, (name, fallback) in enumerate((("channel", ch), ("sub_category", col(sub_category)), ("category", col(category)))):
        c = None
        for agent_name, labels in site.channel_by_agent.items():
            hit = a == agent_name
            c = F.when(hit, F.lit(labels[i])) if c is None else c.when(hit, F.lit(labels[i]))
        by_agent = {"channel": (organic, F.lit(site.agent_channel[0])), "sub_category": (agentish, a),
                    "category": (organic, F.lit(site.agent_channel[1]))}[name]
        rule = (a.isNotNull() & by_agent[0], by_agent[1])
        c = F.when(*rule) if c is None else c.when(*rule)
        out[name] = c.when(col(product) == site.partner_source, F.lit(site.partner_channel[i])).otherwise(fallback)
    return out


def agent_label(site: SiteConfig, sub_category="sub_category", agent="namec_agent") -> Column:
    """Agent name overridden by the sub-category of the lead source."""
    sub = col(sub_category)
    out = lookup(sub, site.agent_by_sub_category)
    return out.when(sub.isin(list(site.agent_is_sub_category)), sub).otherwise(col(agent))


def agent_reps(assignments: DataFrame) -> DataFrame:
    """Partner -> representative of the newest assignment."""
    a = active_only(assignments).select(F.col("value1").cast("long").alias("partner_uid"), "agent_name", "id")
    a = latest_by(a.filter(F.col("partner_uid").isNotNull() & (F.col("partner_uid") != 0)), "partner_uid", [F.col("id").desc()])
    return a.select("partner_uid", F.initcap(F.regexp_replace("agent_name", r"\.", " ")).alias("rep"))


def source_reps(owners: DataFrame, people: DataFrame) -> DataFrame:
    """Lead source -> name of the representative of the newest assignment, '' when unknown."""
    o = active_only(owners).filter(F.col("action_type") == "BORROWER_RM_ASSIGNED")
    o = latest_by(o.select(F.lower("old_source").alias("source_name"), F.col("assigned_to").try_cast("long").alias("uid"), "id"),
                  "source_name", [F.col("id").desc()])
    p = people.select("uid", F.col("namec_user").alias("__name"))
    return (o.filter(F.col("source_name").isNotNull()).join(p, "uid", "left")
            .select("source_name", F.coalesce("__name", F.lit("")).alias("rm_others")))


def assign_rep(df: DataFrame, agents: DataFrame, sources: DataFrame, site: SiteConfig) -> DataFrame:
    """Representative: sub-agent's, agent's, source owner, sub-category override, channel override."""
    for side, key in (("sub", "sub_agent_uid"), ("main", "agent_uid")):
        a = agents.select(F.col("partner_uid").alias(f"__{side}"), F.col("rep").alias(f"__rep_{side}"))
        df = df.join(a, df[key].cast("long") == a[f"__{side}"], "left")
    s = sources.select(F.col("source_name").alias("__src"), "rm_others")
    df = df.join(s, F.lower(df["source"]) == s["__src"], "left")
    rep = (F.when(F.col("__sub").isNotNull(), F.col("__rep_sub")).when(F.col("__main").isNotNull(), F.col("__rep_main"))
            .when(F.col("rm_others").isNotNull(), F.col("rm_others")))
    for c, table in (("sub_category", site.rep_by_sub_category), ("channel", site.rep_by_channel)):
        for label, who in table.items():
            rep = rep.when(F.col(c) == label, who)
    return df.withColumn("rm", rep).drop("__sub", "__main", "__rep_sub", "__rep_main", "__src", "rm_others")


def default_portfolio(site: SiteConfig, portfolio="portfolio_type", source="source", registered="cl_created") -> Column:
    """Portfolio of an application that has no proposal yet, by source and registration day."""
    recent = col(registered) >= date_lit(site.default_portfolio_from)
    partner = col(source) == site.partner_source
    return (F.when(col(portfolio).isNotNull(), col(portfolio))
             .when(recent & (col(source).isNull() | ~partner), site.default_portfolio)
             .when(recent & partner, site.partner_portfolio)
             .when(~recent, site.other_portfolio))


# --- mandates --------------------------------------------------------------

def mandate_reason() -> Column:
    dead = F.col("mandate_status").isin("Cancelled", "Deactivated")
    out = F.when(F.col("mandate_status") == "Final Approved", "")
    for pattern, label in fv.MANDATE_REASONS:
        out = out.when(dead & F.lower("rejected_reason").like(pattern), label)
    return out.otherwise(F.initcap(F.trim(F.coalesce("rejected_reason", F.lit("")))))


def mandate_state() -> Column:
    return (F.when(F.col("mandate_status").isin("Cancelled", "Deactivated"), "Deactivated")
             .otherwise(F.initcap(F.trim(F.coalesce("mandate_status", F.lit(""))))))


def best_mandate(register: DataFrame) -> DataFrame:
    """The mandate of a loan with the highest priority, then the lowest reference."""
    r = active_only(register).withColumn("nach_priority", classify("mandate_status", fv.MANDATE_PRIORITY))
    r = latest_by(r, "loan_id", [F.col("nach_priority").desc_nulls_last(), F.col("unique_reference_no").asc(),
                                 F.col("created").desc()])
    return r.select(
        "loan_id", F.col("unique_reference_no").alias("mandate_id"), "nach_priority",
        F.col("bank_holder_name").alias("nach_bankholder"), F.col("email_id").alias("nach_emailid"),
        F.col("mobile_no").alias("nach_mobile"), F.col("bank_name").alias("nach_bank"),
        F.col("branch_name").alias("nach_branch"), F.col("account_no").alias("nach_accountno"),
        F.when(F.col("account_type") == "10", "Saving").otherwise("Current").alias("nach_account_type"),
        F.col("ifsc_code").alias("nach_ifsccode"), F.col("umrn").alias("nach_umrn"),
        epoch_to_local_date("created").alias("nach_created"),
        parse_messy_date("startdate", "[^0-9]", fv.START_DATE_REPAIRS).alias("nach_start_date"),
        parse_messy_date("enddate", "-|/", fv.END_DATE_REPAIRS).alias("nach_end_date"),
        F.col("approved_date").alias("enach_approved_date"),
        mandate_reason().alias("nach_reason"), mandate_state().alias("nach_status"))


def subscription_counts(subscriptions: DataFrame) -> DataFrame:
    """Links, activation flag and days per (loan, mandate) of the payment gateway."""
    ok = (F.upper("cf_status").isin(fv.SUBSCRIPTION_STATES)
          & (F.lower("cf_message").isin(fv.SUBSCRIPTION_MESSAGES) | F.upper("cf_message").like(fv.SUBSCRIPTION_EXISTS)))
    s = (active_only(subscriptions).filter(F.col("status") == "OK")
         .select("loan_id", F.col("unique_reference_no").alias("mandate_id"), "cf_message", "cf_status",
                 "bank_holder_name", "account_no", epoch_to_local_date("created", 0).alias("day")).distinct())
    return s.groupBy("loan_id", "mandate_id").agg(
        F.count(F.lit(1)).alias("mandate_link_created"),
        F.max(F.when(ok, 1).otherwise(0)).alias("mandate_active"),
        F.min("day").alias("enach_first_link_created_date"),
        F.max(F.when(ok, F.col("day"))).alias("enach_active_subscription_date"))


def bank_mandate_counts(mandates: DataFrame) -> DataFrame:
    """The same for mandates registered directly with the bank."""
    state, status = fv.BANK_MANDATE_OK
    ok = (F.col("state") == state) & (F.col("status") == status)
    m = active_only(mandates).select("loan_id", "mandate_id", "state", "status", "reason",
                                     epoch_to_local_date("created", 0).alias("day")).distinct()
    return m.groupBy("loan_id", "mandate_id").agg(
        F.count(F.lit(1)).alias("icici_mandate_link_created"),
        F.max(F.when(ok, 1).otherwise(0)).alias("icici_mandate_active"),
        F.min("day").alias("icici_mandate_first_created_date"),
        F.max(F.when(ok, F.col("day"))).alias("icici_mandate_active_date"))


def mandate_status(best: DataFrame, subscriptions: DataFrame, bank: DataFrame) -> DataFrame:
    """Paper and electronic state of the chosen mandate."""
    out = best.join(subscriptions, ["loan_id", "mandate_id"], "left").join(bank, ["loan_id", "mandate_id"], "left")
    linked = (F.coalesce("mandate_link_created", F.lit(0)) > 0) | (F.coalesce("icici_mandate_link_created", F.lit(0)) > 0)
    electronic = (F.coalesce("mandate_active", F.lit(0)) == 1) | (F.coalesce("icici_mandate_active", F.lit(0)) == 1)
    approved = F.col("nach_status") == "Final Approved"
    return (out.withColumn("nach_source", F.when(linked, "E-Mandate").otherwise("Nach"))
               .withColumn("mandate_status",
                           F.when(approved, F.when(electronic, "E-Mandate Activated").otherwise("Nach Activated"))
                            .otherwise(F.when(electronic, "E-Mandate Authorised").otherwise("No E-Mandate & Nach"))))


def registration_method(as_of) -> dict[str, Column]:
    """How installments are collected: a valid mandate, post-dated cheques, or online; and by whom."""
    end = F.col("nach_end_date")
    valid = (F.col("nach_status") == "Final Approved") & (end.isNull() | (end >= F.last_day(date_lit(as_of))))
    method = (F.when(valid, F.col("mandate_status")).when(F.col("cheque_available") > 1, "PDC").otherwise("Online"))
    mandate = ~method.isin("PDC", "Online")
    return {
        "payment_registration_method": method,
        "payment_registration_vendor": (F.when((F.col("icici_mandate_active") == 1) & mandate, "E-MANDATE thru ICICI")
                                        .when((F.col("mandate_active") == 1) & mandate, "E-MANDATE thru CASHFREE")
                                        .when(mandate, "MANDATE - Manual")
                                        .when(method == "PDC", "Reliable Data Services").otherwise("Not Known")),
    }


def cheque_counts(cheques: DataFrame) -> DataFrame:
    return conditional_counts(active_only(cheques), "loan_id",
                              {n: F.col("cheque_status").isin(v) for n, v in fv.CHEQUE_COUNTERS.items()},
                              {"cheque_total": F.count("cheque_no")})


def deviation_counts(info: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """Policy deviations per loan by reason, and who raised the newest one."""
    d = (active_only(info).filter(F.col("action_type").isin(fv.DEVIATION_ACTIONS))
         .select("loan_id", F.col("value1").alias("code"), epoch_to_local_date("created", 0).alias("day"),
                 F.col("created_by").try_cast("long").alias("uid")).distinct())
    specs = {name: F.col("code").isin(codes) for name, _, codes in fv.DEVIATION_CLASSES}
    out = conditional_counts(d, "loan_id", specs, {
        "total_dev": F.count(F.lit(1)), "uid": F.max_by("uid", F.struct("day", "code"))})
    out = out.withColumn("dev_exists", F.lit("Y"))
    if people is None:
        return out.withColumnRenamed("uid", "dev_created_by")
    p = people.select("uid", F.col("namec_user").alias("dev_created_by"))
    return out.join(p, "uid", "left").drop("uid")


def primary_account(accounts: DataFrame, loans: DataFrame) -> DataFrame:
    """Newest bank account of users who have a loan."""
    a = active_only(accounts).join(active_only(loans).select("uid"), "uid", "left_semi")
    order = [F.col("created").desc(), F.col("account_number").asc()]
    return latest_by(a, "uid", order).select(
        "uid", "account_name", "account_number", F.upper("account_ifsc_number").alias("account_ifsc"),
        classify("account_type", fv.ACCOUNT_TYPES, "").alias("account_type"), "branch_add", "bank_name", "micr_number")


def lead_existence_flags(ignored: DataFrame, loans: DataFrame) -> DataFrame:
    """Fraud, ignore and long-overdue flags per loan that has any of them."""
    ig = active_only(ignored).groupBy("loan_id").agg(
        F.max(F.when(F.col("remark").isNull(), 1).otherwise(0)).alias("fraud_flag"), F.lit(1).alias("ignore_flag"))
    npa = (active_only(loans).filter(F.col("settlement_term") == 1)
           .groupBy(F.col("id").alias("loan_id")).agg(F.lit(1).alias("ex360_npa")))
    out = ig.join(npa, "loan_id", "full")
    return out.select("loan_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("fraud_flag", "ignore_flag", "ex360_npa")])


def disposition(plus="plus", text="disp_name") -> Column:
    """Call result: fixed texts for some codes, else the dictionary text."""
    out = F.when(col(text).isNull() & col(plus).isin(fv.SILENT_DISPOSITIONS), "")
    for code, label in fv.DISPOSITION_OVERRIDES.items():
        out = out.when(col(plus) == code, label)
    return out.otherwise(col(text))


# --- people ----------------------------------------------------------------

def people_dimension(logins: DataFrame, users: DataFrame, site: SiteConfig) -> DataFrame:
    """Login and person data of a user, cleaned: one row per uid."""
    u = users.select("uid", "fname", "lname", F.col("mobile").alias("mobile_user"),
                     F.col("landline").alias("landline_user"), "deleted")
    j = active_only(logins.select("uid", "name", "mail").join(u, "uid", "left"), tolerate_null=True)
    tokens = site.fill(fv.NAME_STATUS_TOKENS)
    domains = site.fill(fv.NAME_DOMAIN_TOKENS)
    mail = scrub_status_prefix("mail", tokens)
    return j.select(
        F.col("uid").cast("long").alias("uid"), person_name("fname", "lname").alias("name_user"),
        "mobile_user", "landline_user",
        F.col("name").alias("namec_org_user"),
        F.initcap(scrub_status_prefix("name", tokens + domains, dots_to_space=True)).alias("namec_user"),
        F.col("mail").alias("email_org_user"),
        F.replace(mail, F.lit(domains[0]), F.lit(domains[1])).alias("email_user"))


# Rows that name nobody are dealt over so many places.
BLANK_PLACES = 512


def attach_person(df: DataFrame, people: DataFrame, key: str, fields: dict, spread_by: str | None = None) -> DataFrame:
    """Left join of a slim people dimension under new column names.

    Most rows may name nobody (a null or zero key).  With ``spread_by``, a column that tells rows apart, these are dealt over
    ``BLANK_PLACES`` instead of meeting in one task; a person numbered zero stands at each of these places, so matches are the same.
    """
    p = people.select(F.col("uid").alias("__uid"), *[F.col(s).alias(n) for n, s in fields.items()])
    if spread_by is None:
        return df.join(p, df[key].cast("long") == p["__uid"], "left").drop("__uid")
    blank = F.coalesce(F.col(key).cast("long"), F.lit(0)) == 0
    df = df.withColumn("__at", F.when(blank, F.pmod(F.xxhash64(spread_by), F.lit(BLANK_PLACES))).otherwise(F.lit(0)).cast("int"))
    last = F.when(F.col("__uid") == 0, F.lit(BLANK_PLACES - 1)).otherwise(F.lit(0))
    p = p.withColumn("__place", F.explode(F.sequence(F.lit(0), last)))
    return df.join(p, (df[key].cast("long") == p["__uid"]) & (df["__at"] == p["__place"]), "left").drop("__uid", "__at", "__place")


def referenced_people(people: DataFrame, df: DataFrame, keys) -> DataFrame:
    """People that are referenced by any of the key columns.

    Agents and staff are few compared to users, so the result stays small and adaptive
    execution can broadcast it by its measured size in the joins that follow.
    """
    ids = df.select(F.explode(F.array(*[F.col(k).cast("long") for k in keys])).alias("uid")).distinct()
    return people.join(ids, "uid", "left_semi")


ROLE_FIELDS = {
    "agent_uid": ("agent", ("name", "namec", "namec_org", "mobile", "landline", "email", "email_org")),
    "sub_agent_uid": ("sub_agent", ("name", "namec", "namec_org", "mobile", "landline", "email", "email_org")),
    "job_assigning": ("jobassigned", ("name", "namec", "mobile", "landline", "email")),
    "portfolio_manager": ("portfolio_manager", ("name", "namec", "mobile", "landline", "email")),
}


def user_profile(users: DataFrame, people: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Users with decoded attributes and the names and contacts of their agents and assignees."""
    slim = referenced_people(people, users, list(ROLE_FIELDS))
    out = users
    for key, (role, fields) in ROLE_FIELDS.items():
        out = attach_person(out, slim, key, {f"{f}_{role}": f"{f}_user" for f in fields}, spread_by="uid")
    out = attach_person(out, people, "uid", {"email_user": "email_user", "email_org_user": "email_org_user"})
    dictionary = dictionary.withColumn("cnd_name", F.coalesce("cnd_name", F.lit("unknown")))
    for code, groups, name in (("religion_cnd", "INDIA_RELIGION", "religion"),
                               ("mothertounge_cnd", "INDIA_MOTHERTONGUE", "mothertounge")):
        out = decode(out, code, dictionary, groups, name)
        out = out.withColumn(name, F.initcap(F.trim(name)))
    caste = dictionary.filter(F.col("cnd_group").like("RELIGION%"))
    out = decode(out, "caste_cnd", caste.withColumn("cnd_group", F.lit("CASTE")), "CASTE", "caste")
    out = out.withColumn("caste", F.initcap(F.trim("caste")))
    for code, name in (("origin_state_cnd", "origion_state"), ("state_cnd", "input_state")):
        out = decode(out, code, dictionary, fv.STATE_GROUPS, name)
        out = out.withColumn(name, F.when(F.col(name).isNotNull(), canonical_state(name)))
    return (out.withColumn("cu_dob", safe_epoch_date("dob"))
               .withColumn("cu_created", epoch_to_local_date("created"))
               .withColumn("cu_updated", epoch_to_local_date("udated")))


# --- employment ------------------------------------------------------------

def employment_epoch(c, repairs: dict) -> Column:
    """Epoch text to a local day; blank and placeholder texts are NULL, known bad ones repaired."""
    c = col(c)
    out = None
    for bad, good in repairs.items():
        out = F.when(c == bad, F.lit(good).cast("long")) if out is None else out.when(c == bad, F.lit(good).cast("long"))
    value = c.try_cast("long")
    return epoch_to_local_date(value if out is None else out.otherwise(value))


def employment_profile(employment: DataFrame, dictionary: DataFrame, pincodes: DataFrame) -> DataFrame:
    """Latest employment of a user, codes decoded, texts title-cased."""
    e = latest_by(active_only(employment), "uid", [F.col("id").desc()])
    e = e.withColumn("comp_pin", F.regexp_substr("comp_pin", F.lit("[0-9]+")))
    p = pincodes.select(F.col("pincode").cast("string").alias("__pin"), F.col("city_pin").alias("comp_city"),
                        F.col("state").alias("comp_state"))
    e = e.join(p, e["comp_pin"] == p["__pin"], "left").drop("__pin")
    for code, group, name in fv.EMPLOYMENT_DECODES:
        e = decode(e, code, dictionary, group, name, default=F.col(code).cast("string"))
    office = F.when(F.col("office_type") == "1", "Owned").when(F.col("office_type") == "0", "Rented").otherwise(F.col("office_type"))

    def title(c, default="", blank=None, replace=None):
        t = title_or(c, default)
        for v in blank or ():
            t = F.when(t == v, "").otherwise(t)
        for bad, good in (replace or {}).items():
            t = F.when(t == bad, good).otherwise(t)
        return t

    return e.select(
        F.col("uid"),
        title("employement_type", "unknown").alias("employement_type"),
        F.col("is_current").alias("is_current_employement"),
        *[title(c, "unknown").alias(c) for c in ("comp_designation", "comp_name")],
        F.regexp_replace(title("comp_address"), "[\\n\\r]+", ",").alias("comp_address"),
        *[title(c, "unknown").alias(c) for c in ("comp_city", "comp_state")],
        "comp_tenure", "comp_pin", "comp_phone",
        F.lower(F.trim(F.coalesce("comp_email", F.lit("")))).alias("comp_email"),
        employment_epoch("comp_start", fv.BAD_EMPLOYMENT_START).alias("comp_startdate"),
        employment_epoch("comp_end", {}).alias("com_enddate"),
        title("comp_business_type", blank=["90000116"]).alias("comp_businesstype"),
        title("comp_industry").alias("comp_industry"),
        F.col("company_profit").alias("comp_profit"), F.col("company_depreciation").alias("comp_depreciation"),
        F.col("company_salary_paid").alias("comp_salarypaid"),
        title("company_offc_ownership").alias("comp_officeownership"), "is_verified",
        title("designation_level").alias("designation_level"), title("profession").alias("comp_profession"),
        F.col("other_salaries_paid").alias("other_salariespaid"), "work_exp",
        F.col("prev_takehome_sal").alias("previous_takehomesalary"), title("business_type").alias("business_type"),
        title(office, blank=["Null"]).alias("comp_officetype"),
        F.col("no_of_employee").alias("comp_noofemployee"), F.col("company_turnover").alias("comp_turnover"),
        F.col("comp_registration_no").alias("comp_registrationno"), F.col("contact2").alias("comp_contactno2"),
        title("nature_of_business").alias("comp_natureofbusiness"),
        title("industry_type", replace={"60": "Other"}).alias("comp_industrytype"),
        title("sub_industry_type").alias("comp_subindustrytype"), "caution_profile",
        F.col("business_cash_component").alias("comp_cashcomponent"))
