"""Ordered rule sets as column expressions, and decision flows made of them."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ALLOWED = re.compile(r"[\w\s.+\-*/<>=!()%,]*(?:'[^']*')?[\w\s.+\-*/<>=!()%,]*")


@dataclass(frozen=True)
class Rule:
    """Conditions are ANDed; actions (target, expression) run in order when they hold."""

    name: str
    chain: str = "if"  # "if" opens a chain, "elseif" fires only when no earlier member did
    when: Sequence[tuple[str, str]] = ()
    then: Sequence[tuple[str, str]] = ()
    record: bool = True


@dataclass
class _Draft:
    name: str
    seq: int
    chain: str
    record: bool
    when: list = field(default_factory=list)
    then: list = field(default_factory=list)


def _checked(text: str) -> str:
    if not _ALLOWED.fullmatch(text):
        raise ValueError(f"not a rule expression: {text}")
    return text


def read_rules(rows: Sequence[Mapping[str, str]]) -> list[Rule]:
    """Rules from the rows of a rule-set table (one row per condition or action)."""
    drafts: dict[str, _Draft] = {}
    for r in sorted(rows, key=lambda r: (int(r["rule_seq_no"]), r["expression_type"] == "ACTION", int(r["expression_order"]))):
        draft = drafts.setdefault(
            r["rule_id"],
            _Draft(r["rule_nm"], int(r["rule_seq_no"]), r["conditional"], r["record_rule_fired_flag"] == "Y"),
        )
        target, text = r.get("lhs_term") or "", r["expression"]
        if r["expression_type"] == "CONDITION":
            draft.when.append((target, text))
        else:
            if not target:
                target, text = (part.strip() for part in text.split("=", 1))
            draft.then.append((target, text))
    ordered = sorted(drafts.values(), key=lambda x: x.seq)
    return [Rule(x.name, x.chain, tuple(x.when), tuple(x.then), x.record) for x in ordered]


#: Columns of a stored rule-set table, one row per condition or action.
RULE_ROW = (
    "rule_set_nm string, rule_id string, rule_nm string, rule_seq_no int, conditional string, record_rule_fired_flag string, "
    "expression_type string, expression_order int, lhs_term string, expression string"
)


def rule_rows(spark: SparkSession, rule_set: str, rules: Sequence[Rule]) -> DataFrame:
    """The rows of a rule-set table for these rules; read_rules and stored_rules turn them back."""
    rows = []
    for seq, rule in enumerate(rules, 1):
        head = (rule_set, f"{rule_set}-{seq}", rule.name, seq, rule.chain, "Y" if rule.record else "N")
        for kind, terms in (("CONDITION", rule.when), ("ACTION", rule.then)):
            rows += [(*head, kind, order, target, text) for order, (target, text) in enumerate(terms, 1)]
    return spark.createDataFrame(rows, RULE_ROW)


def stored_rules(table: DataFrame, rule_set: str) -> list[Rule]:
    """The rules of one set of a stored table, in any row order; only this set's rows are fetched."""
    rules = read_rules([r.asDict() for r in table.filter(F.col("rule_set_nm") == rule_set).collect()])
    if not rules:
        raise ValueError(f"no rule set named {rule_set}")
    return rules


def apply_rules(df: DataFrame, rules: Sequence[Rule], only_if: Column | None = None) -> DataFrame:
    """Run a rule set. Each rule sees the values left by the rules before it; Catalyst folds
    the steps into one projection. `rules_fired` collects the names of recorded rules.

    A condition on a missing value does not hold. `only_if` guards the whole set.
    """
    scratch: list[str] = []
    chain: Column | None = None
    if only_if is not None:
        df = df.withColumn("_guard", F.coalesce(only_if, F.lit(False)))
        scratch.append("_guard")
    guard = F.col("_guard") if only_if is not None else F.lit(True)
    fired_names = []
    for i, rule in enumerate(rules):
        tests = [F.expr(_checked(f"{lhs} {text}")) for lhs, text in rule.when]
        holds = F.coalesce(reduce(and_, tests), F.lit(False)) if tests else F.lit(True)
        opens = rule.chain != "elseif" or chain is None
        flag = f"_rule{i}"
        df = df.withColumn(flag, guard & (holds if opens else holds & ~chain))
        scratch.append(flag)
        chain = F.col(flag) if opens else chain | F.col(flag)
        for target, text in rule.then:
            value = F.expr(_checked(text))
            before = F.col(target) if target in df.columns else F.lit(None)
            df = df.withColumn(target, F.when(F.col(flag), value).otherwise(before))
        if rule.record:
            fired_names.append(F.when(F.col(flag), F.lit(rule.name)))
    names = F.filter(F.array(*fired_names), lambda x: x.isNotNull()) if fired_names else F.array().cast("array<string>")
    earlier = F.col("rules_fired") if "rules_fired" in df.columns else F.array().cast("array<string>")
    return df.withColumn("rules_fired", F.concat(earlier, names)).drop(*scratch)


# The lending rule sets.
SCREENING = [
    Rule("Default_assignment_1", then=[("DeclineFlag", "0")], record=False),
    Rule("Default_assignment_4", then=[("MonthlyIncome", "orig_net_worth/26")], record=False),
    Rule(
        "Basic credit conditions",
        when=[("orig_credit_score", "<= 620")],
        then=[("DeclineFlag", "1"), ("DeclineReason", "'Your credit score is below the minimum threshold'")],
    ),
    Rule(
        "Default_rule_5_else_1",
        "elseif",
        when=[("orig_debt_to_income", "> 100")],
        then=[("DeclineFlag", "1"), ("DeclineReason", "'Your debt-to-income ratio exceeds our minimum requirements'")],
    ),
]
LOAN_SIZE = [
    Rule(
        "Loan amount min_max requirements",
        when=[("orig_amount", ">= 200000")],
        then=[
            ("DeclineFlag", "1"),
            ("DeclineReason", "'Your requested loan amount exceeds our maximum loan threshold'"),
        ],
    ),
    Rule(
        "Loan amount min_max requirements_else_1",
        "elseif",
        when=[("orig_amount", "< 5000")],
        then=[
            ("DeclineFlag", "1"),
            ("DeclineReason", "'Your requested loan is below the minimum amount that we lend'"),
        ],
    ),
]
CURRENT_CUSTOMER = [
    Rule("Default_assignment_1", then=[("ApproveFlag", "0")], record=False),
    Rule(
        "Current customer credit conditions",
        when=[("orig_credit_score", ">= 720"), ("orig_debt_to_income", "<= 30")],
        then=[("ApproveFlag", "1")],
    ),
]
PROSPECTIVE_CUSTOMER = [
    Rule("Default_assignment_1", then=[("ApproveFlag", "0")], record=False),
    Rule(
        "Current customer credit conditions",
        when=[("orig_credit_score", ">= 680"), ("orig_debt_to_income", "<= 40")],
        then=[("ApproveFlag", "1")],
    ),
]
APPROVE = [Rule("Default_assignment_1", then=[("loan_decision", "'approve'")], record=False)]
DENY = [Rule("Default_assignment_1", then=[("loan_decision", "'deny'")], record=False)]
REVIEWS = ("auto_escalate", "review", "do_not_review")


def truthy(flag: Column) -> Column:
    """Flags arrive as TRUE, false, 1 ...; text is normalised."""
    return F.lower(flag.cast("string")).isin("true", "1", "yes")


def decide_loan(df: DataFrame, relationship: str) -> DataFrame:
    """Screening, loan size, credit check by customer type, then approve or deny.

    Later checks run only on requests that are not declined yet.
    """
    df = apply_rules(df, SCREENING)
    df = apply_rules(df, LOAN_SIZE, F.col("DeclineFlag") == 0)
    current = truthy(F.col(relationship))
    df = apply_rules(df, CURRENT_CUSTOMER, (F.col("DeclineFlag") == 0) & current)
    df = apply_rules(df, PROSPECTIVE_CUSTOMER, (F.col("DeclineFlag") == 0) & ~F.coalesce(current, F.lit(False)))
    approved = (F.col("DeclineFlag") == 0) & (F.col("ApproveFlag") == 1)
    df = apply_rules(df, APPROVE, approved)
    return apply_rules(df, DENY, ~F.coalesce(approved, F.lit(False)))


def review_band(p: Column, escalate: float, review: float) -> Column:
    """Three-way routing of a score."""
    high, middle, low = REVIEWS
    return F.when(p >= escalate, high).when(p >= review, middle).otherwise(low)


def label_bands(points: Column, fraud: float = 75, clear: float = 25) -> Column:
    return F.when(points >= fraud, "FRAUD").when(points <= clear, "NOT_FRAUD").otherwise("REVIEW")


_SPARK_TYPES = {"decimal": "double", "integer": "int", "boolean": "boolean", "string": "string"}


def validate_table(df: DataFrame, dictionary: Sequence[Mapping]) -> DataFrame:
    """Check a table against a variable dictionary of name, dataType, direction, length.

    One row per input variable: present, values that do not cast, texts that are too long.
    """
    inputs = [v for v in dictionary if v["direction"] in ("input", "inOut")]
    parts = []
    for v in inputs:
        present = v["name"] in df.columns
        zero = F.lit(0).cast("bigint")
        bad = long = zero
        if present:
            x = F.col(v["name"])
            cast = x.cast("string").try_cast(_SPARK_TYPES[v["dataType"]])
            bad = F.count_if(x.isNotNull() & cast.isNull())
            if v["dataType"] == "string" and v.get("length"):
                long = F.count_if(F.length(x.cast("string")) > int(v["length"]))
        parts.append(
            F.struct(
                F.lit(v["name"]).alias("variable"),
                F.lit(v["dataType"]).alias("type"),
                F.lit(present).alias("present"),
                bad.alias("bad_values"),
                long.alias("too_long"),
            )
        )
    return df.agg(F.count(F.lit(1)).alias("_n"), F.array(*parts).alias("_v")).select(F.inline("_v"))


def reconcile(subtotal: Column, tax: Column, total: Column) -> dict[str, Column]:
    """Arithmetic check of a document total; NULL where a part is missing."""
    expected = subtotal + tax
    tolerance = F.greatest(F.lit(0.02), 0.005 * expected)
    return {
        "expected_total": expected,
        "math_consistent": F.abs(expected - total) <= tolerance,
        "unlabeled_delta": (total - subtotal) > F.greatest(F.lit(0.05), 0.01 * subtotal),
    }


def items_match(items_sum: Column, subtotal: Column) -> Column:
    return F.abs(items_sum - subtotal) <= F.greatest(F.lit(0.5), 0.02 * subtotal)
