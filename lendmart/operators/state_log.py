"""State log: who moved an entity into which state, and when.

Every question about the log is an aggregate expression keyed by the entity, so any
number of them run in one pass over the log with map-side combine (:func:`log_facts`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmart import fixed_values as fv
from lendmart.functions.dates import col, epoch_to_local_date, epoch_to_timestamp, month_end
from lendmart.functions.text import clean_entity_id
from lendmart.operators.rows import first_n_by, latest_by


def state_log(df: DataFrame, entity_types=(fv.LOAN_ENTITY, fv.VERIFY_ENTITY),
              offset_s: int = fv.IST_OFFSET_S) -> DataFrame:
    """Typed log: entity number, from, to, actor, local time; rows without a readable entity are dropped.

    ``entity_types=None`` keeps every logged type.
    """
    keep = F.col("deleted") == "N"
    if entity_types is not None:
        keep = keep & F.col("logged_entity_type").isin(list(entity_types))
    return (df.filter(keep)
              .select("id",
                      clean_entity_id("logged_entity_id").alias("entity"),
                      F.col("logged_entity_type").alias("entity_type"),
                      F.col("old_state").cast("int").alias("old_state"),
                      F.col("new_state").cast("int").alias("new_state"),
                      F.col("updated_by").cast("long").alias("actor"),
                      epoch_to_timestamp("created", offset_s).alias("at"))
              .filter(F.col("entity").isNotNull()))


def transition(pairs) -> Column:
    """Condition for a list of (from states or None, to states)."""
    out = None
    for old, new in pairs:
        c = F.col("new_state").isin(list(new))
        if old is not None:
            c = c & F.col("old_state").isin(list(old))
        out = c if out is None else out | c
    return out


def human(system_actors=(0, 1)) -> Column:
    return F.col("actor").isNotNull() & ~F.col("actor").isin(list(system_actors))


def _newest(value: str, cond: Column) -> Column:
    return F.max_by(F.col(value), F.when(cond, F.struct("at", "id")))


def log_facts(log: DataFrame, facts: dict) -> DataFrame:
    """Any number of per-entity aggregates in one grouped pass."""
    return log.groupBy("entity").agg(*[a.alias(n) for n, a in facts.items()])


def last_actor_fact(pairs, system_actors=(0, 1)) -> Column:
    """Latest human actor of the given transitions."""
    return _newest("actor", transition(pairs) & human(system_actors) & (F.col("entity_type") == fv.LOAN_ENTITY))


def milestone_fact(entity_type: str, states) -> Column:
    """Latest time in any of the states."""
    return F.max(F.when((F.col("entity_type") == entity_type) & F.col("new_state").isin(list(states)), F.col("at")))


def first_entry_fact(state: int, entity_type: str = fv.LOAN_ENTITY) -> Column:
    """First time in a state."""
    return F.min(F.when((F.col("entity_type") == entity_type) & (F.col("new_state") == state), F.col("at")))


def last_actor(log: DataFrame, pairs, system_actors=(0, 1)) -> DataFrame:
    """Entity -> latest human actor of the transitions and its time."""
    hit = log.filter(transition(pairs) & human(system_actors) & (F.col("entity_type") == fv.LOAN_ENTITY))
    return latest_by(hit, "entity", [F.col("at").desc(), F.col("id").desc()]).select("entity", "actor", "at")


def underwriting_moves(log: DataFrame, staff: DataFrame | None, system_actors=(0, 1), staff_id: str = "uw_id",
                       from_states=fv.UW_FROM_STATES, to_states=fv.UW_TO_STATES) -> DataFrame:
    """Moves out of underwriting made by a human, optionally restricted to listed staff."""
    out = log.filter((F.col("entity_type") == fv.LOAN_ENTITY)
                     & F.col("old_state").isin(list(from_states)) & F.col("new_state").isin(list(to_states))
                     & human(system_actors))
    if staff is not None:
        out = out.join(staff.select(F.col(staff_id).cast("long").alias("actor")), "actor", "left_semi")
    return out


def last_actor_per_state(moves: DataFrame) -> DataFrame:
    """Entity and state -> latest actor and latest time."""
    return (moves.groupBy("entity", "new_state")
            .agg(F.max_by("actor", F.struct("at", "id")).alias("actor"), F.max("at").alias("at")))


def first_entry(log: DataFrame, state: int) -> DataFrame:
    return log.filter((F.col("new_state") == state) & (F.col("entity_type") == fv.LOAN_ENTITY)) \
              .groupBy("entity").agg(F.min("at").alias("at"))


def latest_milestones(log: DataFrame, specs: dict = fv.MILESTONES) -> DataFrame:
    """Wide table of the latest time per named set of states."""
    return log_facts(log, {name: milestone_fact(et, states) for name, (et, states) in specs.items()})


def actors_wide(moves: DataFrame, slots: dict = fv.UW_SLOTS) -> DataFrame:
    """Entity -> actor and time of each named state, plus the latest actor overall."""
    return log_facts(moves, _move_facts(F.lit(True), slots))


def _move_facts(move: Column, slots: dict) -> dict[str, Column]:
    facts = {"uw_last": _newest("actor", move), "uw_last_at": F.max(F.when(move, F.col("at")))}
    for name, state in slots.items():
        cond = move & (F.col("new_state") == state)
        facts[f"uw_{name}"] = _newest("actor", cond)
        facts[f"uw_{name}_date"] = F.max(F.when(cond, F.col("at")))
    return facts


def underwriting_facts(system_actors=(0, 1), staff_flag: str = "is_staff", slots: dict = fv.UW_SLOTS) -> dict[str, Column]:
    """The facts of :func:`actors_wide` as aggregates over the whole log, staff marked by a flag."""
    move = ((F.col("entity_type") == fv.LOAN_ENTITY) & F.col("old_state").isin(fv.UW_FROM_STATES)
            & F.col("new_state").isin(fv.UW_TO_STATES) & human(system_actors) & F.coalesce(F.col(staff_flag), F.lit(False)))
    return _move_facts(move, slots)


def parsed_allocation(jobs: DataFrame, steps: DataFrame, loans: DataFrame,
                      job_types=fv.ALLOCATION_JOBS, offset_s: int = fv.IST_OFFSET_S) -> DataFrame:
    """Loan -> agent number parsed from the remark of the newest successful allocation step."""
    jobs = jobs.filter((F.col("deleted") == "N") & F.col("cron_type").isin(list(job_types))).select("cron_id").distinct()
    steps = (steps.filter((F.col("deleted") == "N") & (F.col("status") == "success"))
             .join(jobs, "cron_id", "left_semi")
             .select("id", F.col("communication_id").cast("string").alias("uid"), "remark", "created"))
    # One newest step per borrower before it meets the borrower's loans.
    newest = latest_by(steps, "uid", [F.col("id").desc()])
    agent = F.regexp_replace(F.regexp_replace("remark", "agent- ", ""), " .*", "").try_cast("long")
    return (loans.select(F.col("id").alias("loan_id"), F.col("uid").cast("string").alias("uid"))
            .join(newest.select("uid", agent.alias("uwas_id"),
                                epoch_to_timestamp("created", offset_s).alias("uwas_assigned_date")), "uid")
            .drop("uid"))


def assigned_actor(df: DataFrame) -> DataFrame:
    """Allocation first, else the last underwriter; date from allocation, acceptance or last move."""
    at = F.coalesce("uwas_assigned_date", "uwac_created", "uw_last_at")
    return (df.withColumn("uw_assigned_id", F.coalesce("uwas_id", "uw_last"))
              .withColumn("uw_assigned_date", at)
              .withColumn("uw_lastday_assigned_date", month_end(F.to_date(at)))
              .filter(F.col("uw_assigned_id").isNotNull()))


def _latest_of(name: str, others, assigned: str) -> Column:
    """``name`` is set, not before the assignment, and later than every other set time."""
    c = F.col(name)
    out = c.isNotNull() & (c >= F.col(assigned))
    for o in others:
        out = out & (F.col(o).isNull() | (F.col(o) < c))
    return out


def resolve_latest_event(assigned: str = "uw_assigned_date", assigned_name: str = "uw_name",
                         product: str = "product_type", skip=fv.NO_UNDERWRITING_PRODUCTS) -> dict[str, Column]:
    """Final underwriting name, status and time of an application.

    The event that is later than all others wins; without one the assignment stands.
    """
    times = {"returned": "uw_returned_date", "forward_to_cs": "uw_forward_to_cs_date",
             "cancelled": "uw_cancelled_date", "live": "uw_live_date"}
    labels = {"returned": "Returned", "forward_to_cs": "Forward to CS", "cancelled": "Cancelled"}
    none = None
    for t in times.values():
        none = F.col(t).isNull() if none is None else none & F.col(t).isNull()
    a = F.col(assigned)
    wins = {}
    for n, t in times.items():
        others = [o for m, o in times.items() if m != n]
        if n != "live":
            others.append("rfd_date")
        wins[n] = _latest_of(t, others, assigned)
    ready = F.col("rfd_date").isNotNull() & ((F.col("rfd_date") >= a) | F.col("first_disburse_date").isNotNull())
    dropped = (F.col("delist_date").isNotNull() & (F.col("delist_date") >= a)
               & (F.col("loan_currentstate") == "Cancelled") & F.col("uw_live_date").isNotNull())
    unassigned = F.lit("UW Not Assigned")
    base_name = F.when(a.isNull(), unassigned).otherwise(F.col(assigned_name))
    base_status = F.when(a.isNull(), unassigned).otherwise(F.lit("Assigned"))
    skipped = F.col(product).isin(list(skip))

    name = F.when(none, base_name)
    for n in times:
        name = name.when(wins[n], F.col(f"uw_{n}"))
    status = F.when(none, base_status)
    when = F.when(none, a)
    for n in labels:
        status = status.when(wins[n], labels[n])
        when = when.when(wins[n], F.col(times[n]))
    status = status.when(wins["live"] | ready, "Live").when(dropped, "Cancelled")
    when = (when.when(wins["live"], F.col("uw_live_date")).when(ready, F.col("rfd_date"))
                .when(dropped, F.col("delist_date")))
    return {
        "uw_name_final": F.when(skipped, unassigned).otherwise(name.otherwise(base_name)),
        "uw_status_final": F.when(skipped, unassigned).otherwise(status.otherwise(base_status)),
        "uw_updated_date": F.when(~skipped, when.otherwise(a)),
    }


# --- automatic rules -------------------------------------------------------

def daily_rule_outcome(runs: DataFrame, actions, offset_s: int = fv.IST_OFFSET_S) -> DataFrame:
    """Loan -> first day with only approvals and first day with a rejection."""
    daily = (runs.filter((F.col("deleted") == "N")
                         & (F.col("action_type").isNull() | F.col("action_type").isin(list(actions))))
             .groupBy("loan_id", epoch_to_local_date("created", offset_s).alias("day"))
             .agg(F.max(F.when(F.col("status").isin(fv.REJECT_WORDS), 1).otherwise(0)).alias("rejected")))
    return daily.groupBy("loan_id").agg(
        F.min(F.when(F.col("rejected") == 0, F.col("day"))).alias("rule_pass_date"),
        F.min(F.when(F.col("rejected") == 1, F.col("day"))).alias("rule_reject_date"))


def rule_window_flags(registered, live, pass_day="rule_pass_date", reject_day="rule_reject_date") -> dict[str, Column]:
    """Outcomes count only between registration and going live."""
    out = {}
    for flag, day in (("rule_pass", pass_day), ("rule_reject", reject_day)):
        d = F.col(day)
        ok = (d >= col(registered)) & (col(live).isNull() | (d <= col(live)))
        out[flag] = F.when(ok, 1)
        out[f"{flag}_date"] = F.when(ok, d)
    return out


def prequal_flags() -> dict[str, Column]:
    """Rules executed, pre-qualified, and the day of pre-qualification."""
    disb, ok, bad = F.col("first_disburse_date"), F.col("rule_pass_date"), F.col("rule_reject_date")
    pre = F.col("loan_img1").isin(fv.PREAPPROVED)
    last = F.greatest(ok, bad)
    passed = ok.isNotNull()
    clean = bad.isNull() | (bad <= ok)
    return {
        "rule_executed_flag": F.when(disb.isNotNull() | pre | passed | bad.isNotNull(), 1).otherwise(0),
        "pq_approved_flag": (F.when(disb.isNotNull(), 1).when(pre, 1)
                             .when(passed, F.when(clean, 1).otherwise(0)).when(bad.isNotNull(), 0)),
        "pq_approved_date": (F.when(disb.isNotNull(), F.least(disb, last))
                             .when(pre, last).when(passed & clean, ok)),
    }


def latest_rule_by_type(runs: DataFrame, rules=fv.LENDER_RULES, pass_value: str = fv.RULE_PASS_VALUE) -> DataFrame:
    """Newest result per (loan, rule) with lender, day and pass flag."""
    hit = runs.filter((F.col("deleted") == "N") & F.col("action_type").isin([a for a, _, _ in rules]))
    tie = [F.col("created").desc()] + ([F.col("id").desc()] if "id" in runs.columns else [])
    newest = first_n_by(hit, ["loan_id", "action_type"], tie, 1, "__rn")
    lender = None
    for action, label, _ in rules:
        c = F.col("action_type") == action
        lender = F.when(c, label) if lender is None else lender.when(c, label)
    return newest.select("loan_id", lender.alias("lender_name"), epoch_to_local_date("created", 0).alias("rule_date"),
                         F.when(F.col("final_value") == pass_value, 1).otherwise(0).alias("bre_pass"))


def pivot_outcomes(latest: DataFrame, rules=fv.LENDER_RULES) -> DataFrame:
    """First rule day and one pass column per lender; NULL where a lender was not evaluated."""
    aggs = [F.sum(F.when(F.col("lender_name") == label, F.col("bre_pass"))).alias(name) for _, label, name in rules]
    return latest.groupBy("loan_id").agg(F.min("rule_date").alias("bre_date"), *aggs)


def eligibility_score(rules=fv.LENDER_RULES, preferred=fv.PREFERRED_ELIGIBILITY) -> dict[str, Column]:
    """Number of passing lenders, any preferred lender passing, disbursed."""
    def total(names):
        out = F.lit(0)
        for n in names:
            out = out + F.coalesce(F.col(n), F.lit(0))
        return out
    return {
        "eligible_lender": total([n for _, _, n in rules]),
        "bre_approved": F.when(total(preferred) > 0, 1).otherwise(0),
        "disbursed": F.when((F.col("disburse_amount") > 0) | F.col("disburse_date").isNotNull(), 1).otherwise(0),
    }
