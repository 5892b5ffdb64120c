"""Federal and state tax calculations as expressions, their lines and their summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.num import money, ratio
from ..operators.aggregates import change_from_previous, share_of_total
from ..operators.lines import pivot_lines, unpivot_lines

# Rates, amounts and line catalogue of the published calculation.
BASE_YEAR, RAISE = 2021, 1.04
INCOME_SHARES = {"wages": 0.80, "bonus": 0.08, "equity": 0.06, "interest": 0.01, "dividends": 0.01, "other_income": 0.02}
AGI_SHARE = 0.95
STANDARD_DEDUCTION, DEDUCTION_YEAR, DEDUCTION_GROWTH = 13_850.0, 2022, 1.03
LOWEST_RATE, RATE_SPREAD, TOP_INCOME = 0.10, 0.27, 500_000.0
CREDIT, WITHHOLDING = 2_000.0, 1.03
SECOND_STATE_SHARE = 0.30
STATE_ADDITIONS, STATE_SUBTRACTIONS, STATE_DEDUCTION = 0.01, 0.02, 5_000.0
STATE_BASE_RATE, STATE_RATE_STEP, STATE_RATE_CLASSES = 0.01, 0.007, 11
LOCAL_SHARE, SDI_RATE, PFL_RATE, STATE_WITHHOLDING = 0.05, 0.001, 0.0008, 1.02
FEDERAL_LINES = (
    (1, "F_WAGES", "W-2 wages", "INCOME", 1, "wages"),
    (2, "F_BONUS", "Bonus", "INCOME", 2, "bonus"),
    (3, "F_EQUITY", "Equity compensation", "INCOME", 3, "equity"),
    (4, "F_INT", "Taxable interest", "INCOME", 4, "interest"),
    (5, "F_DIV", "Dividends", "INCOME", 5, "dividends"),
    (6, "F_OTHER", "Other income", "INCOME", 6, "other_income"),
    (7, "F_AGI", "Adjusted gross income", "ADJUSTMENT", None, "agi"),
    (8, "F_STD_DED", "Standard deduction", "DEDUCTION", None, "standard_deduction"),
    (9, "F_TAXABLE", "Taxable income", "TAXABLE", None, "taxable"),
    (10, "F_TAX", "Federal income tax", "TAX", None, "tax"),
    (11, "F_CREDITS", "Credits", "CREDIT", None, "credits"),
    (12, "F_WITHHELD", "Federal withholding", "PAYMENT", None, "withheld"),
    (13, "F_BAL", "Balance due / (refund)", "PAYMENT", None, "balance"),
    (14, "F_EFF_RATE_BASIS", "Marginal bracket basis", "TAXABLE", None, "taxable"),
)
STATE_LINES = (
    (101, "S_FED_AGI", "Federal AGI (starting point)", "INCOME", "agi"),
    (102, "S_ADD", "State additions", "ADJUSTMENT", "additions"),
    (103, "S_SUB", "State subtractions", "ADJUSTMENT", "subtractions"),
    (104, "S_AGI", "State AGI", "ADJUSTMENT", "state_agi"),
    (105, "S_ALLOC_PCT", "Allocation % to this state", "ADJUSTMENT", "allocation_pct"),
    (106, "S_APPORTIONED", "Apportioned income", "INCOME", "apportioned"),
    (107, "S_STD_DED", "State standard deduction", "DEDUCTION", "state_deduction"),
    (108, "S_TAXABLE", "State taxable income", "TAXABLE", "state_taxable"),
    (109, "S_TAX", "State income tax", "TAX", "state_tax"),
    (110, "S_LOCAL", "Local / city tax", "TAX", "local_tax"),
    (111, "S_SDI", "State disability insurance", "TAX", "sdi"),
    (112, "S_PFL", "Paid family leave", "TAX", "pfl"),
    (113, "S_CREDITS", "State credits", "CREDIT", "state_credits"),
    (114, "S_WITHHELD", "State withholding", "PAYMENT", "state_withheld"),
    (115, "S_EST", "Estimated payments", "PAYMENT", "estimated"),
    (116, "S_BAL", "Balance due / (refund)", "PAYMENT", "state_balance"),
)


def federal_trail(df: DataFrame) -> DataFrame:
    """The federal calculation. Needs ``salary, tax_year, equity_units, has_credit``."""
    pay = F.col("salary")
    income = {name: pay * share for name, share in INCOME_SHARES.items()}
    income["equity"] = income["equity"] * F.col("equity_units")
    out = df.withColumns(income)
    gross = sum((F.col(n) for n in list(income)[1:]), F.col(list(income)[0]))
    out = out.withColumns(
        {
            "agi": gross * AGI_SHARE,
            "standard_deduction": F.lit(STANDARD_DEDUCTION) * F.pow(F.lit(DEDUCTION_GROWTH), F.col("tax_year") - DEDUCTION_YEAR),
        }
    )
    out = out.withColumn("taxable", F.greatest(F.col("agi") - F.col("standard_deduction"), F.lit(0.0)))
    rate = LOWEST_RATE + RATE_SPREAD * F.least(F.col("taxable") / TOP_INCOME, F.lit(1.0))
    out = out.withColumns({"tax": F.col("taxable") * rate, "credits": F.when(F.col("has_credit"), CREDIT).otherwise(0.0)})
    out = out.withColumn("withheld", F.col("tax") * WITHHOLDING)
    return out.withColumn("balance", F.col("tax") - F.col("credits") - F.col("withheld"))


def state_filings(df: DataFrame) -> DataFrame:
    """One row per filing state with its ``share``; the shares of a return always sum to 1.

    Needs ``home_state_key, work_state_key, has_second_state``. A work state equal to the home
    state is no second filing, so the home state then keeps everything.
    """
    second = F.col("has_second_state") & (F.col("work_state_key") != F.col("home_state_key"))
    home = F.struct(
        F.col("home_state_key").cast("int").alias("state_key"), F.when(second, 1 - SECOND_STATE_SHARE).otherwise(1.0).alias("share")
    )
    work = F.struct(F.col("work_state_key").cast("int").alias("state_key"), F.lit(SECOND_STATE_SHARE).alias("share"))
    filings = F.when(second, F.array(home, work)).otherwise(F.array(home))
    kept = [c for c in df.columns if c not in ("home_state_key", "work_state_key", "has_second_state")]
    return df.select(*kept, F.inline(filings))


def state_trail(df: DataFrame, taxed: Column) -> DataFrame:
    """The state calculation. Needs ``agi, share, state_key``; ``taxed`` says whether the state has an income tax."""
    agi, share = F.col("agi"), F.col("share")
    out = df.withColumns(
        {
            "additions": agi * STATE_ADDITIONS,
            "subtractions": agi * STATE_SUBTRACTIONS,
            "allocation_pct": share * 100,
            "state_deduction": share * STATE_DEDUCTION,
            "state_credits": F.lit(0.0),
            "estimated": F.lit(0.0),
        }
    )
    out = out.withColumn("state_agi", agi + F.col("additions") - F.col("subtractions"))
    out = out.withColumn("apportioned", F.col("state_agi") * share)
    out = out.withColumn("state_taxable", F.greatest(F.col("apportioned") - F.col("state_deduction"), F.lit(0.0)))
    rate = STATE_BASE_RATE + F.pmod(F.col("state_key"), F.lit(STATE_RATE_CLASSES)) * STATE_RATE_STEP
    out = out.withColumn("state_tax", F.when(taxed, F.col("state_taxable") * rate).otherwise(0.0))
    out = out.withColumns(
        {
            "local_tax": F.col("state_tax") * LOCAL_SHARE,
            "sdi": F.col("apportioned") * SDI_RATE,
            "pfl": F.col("apportioned") * PFL_RATE,
            "state_withheld": F.col("state_tax") * STATE_WITHHOLDING,
        }
    )
    due = F.col("state_tax") - F.col("state_credits") - F.col("state_withheld") - F.col("estimated")
    return out.withColumn("state_balance", due)


def federal_lines(trail: DataFrame, ids: Sequence[str]) -> DataFrame:
    return unpivot_lines(trail, ids, [(key, column, kind) for key, _, _, _, kind, column in FEDERAL_LINES])


def state_lines(trail: DataFrame, ids: Sequence[str]) -> DataFrame:
    tagged = trail.withColumn("federal_agi_ref", money("agi"))
    return unpivot_lines(tagged, [*ids, "federal_agi_ref"], [(key, column, None) for key, _, _, _, column in STATE_LINES], kind=None)


def line_keys(lines: Sequence[tuple], *codes: str, category: str | None = None) -> list[int]:
    return [x[0] for x in lines if x[1] in codes or (category is not None and x[3] == category)]


FEDERAL_SUMS = {
    "gross_income": line_keys(FEDERAL_LINES, category="INCOME"),
    "federal_agi": line_keys(FEDERAL_LINES, "F_AGI"),
    "federal_taxable_income": line_keys(FEDERAL_LINES, "F_TAXABLE"),
    "federal_tax": line_keys(FEDERAL_LINES, "F_TAX"),
}
STATE_SUMS = {"state_tax": line_keys(STATE_LINES, "S_TAX"), "state_taxable_income": line_keys(STATE_LINES, "S_TAXABLE")}
APPORTIONED = {"apportioned_income": line_keys(STATE_LINES, "S_APPORTIONED")}


def federal_summary(lines: DataFrame) -> DataFrame:
    """entity x year x income type. The line codes are a fixed list, so no lookup is joined."""
    return pivot_lines(lines, ["entity_key", "tax_year", "income_type_key"], "tax_line_key", "amount", FEDERAL_SUMS)


def state_summary(lines: DataFrame) -> DataFrame:
    return pivot_lines(lines, ["entity_key", "state_key", "tax_year"], "tax_line_key", "amount", STATE_SUMS)


def income_with_tax(summary: DataFrame) -> DataFrame:
    """Income at entity x year x type beside the tax of its entity x year, which has no type."""
    income = summary.where("income_type_key IS NOT NULL").select("entity_key", "tax_year", "income_type_key", "gross_income")
    tax = summary.groupBy("entity_key", "tax_year").agg(money(F.sum("federal_tax")).alias("federal_tax"))
    return income.join(tax, ["entity_key", "tax_year"], "left")


def effective_rates(federal: DataFrame, state: DataFrame, by: Sequence[str]) -> DataFrame:
    """(federal + state tax) over gross income from sums. Both sides are grouped before they meet."""
    f = pivot_lines(federal, by, "tax_line_key", "amount", {k: FEDERAL_SUMS[k] for k in ("gross_income", "federal_tax")})
    s = pivot_lines(state, by, "tax_line_key", "amount", {"state_tax": STATE_SUMS["state_tax"], **APPORTIONED})
    both = f.join(s, list(by), "left") if by else f.withColumns({c: s.select(c).scalar() for c in s.columns})
    total = F.col("federal_tax") + F.coalesce("state_tax", F.lit(0))
    gross = F.col("gross_income").cast("double")
    return both.withColumns(
        {
            "federal_rate": ratio(F.col("federal_tax").cast("double"), gross),
            "combined_rate": ratio(total.cast("double"), gross),
            "state_rate": ratio(F.col("state_tax").cast("double"), F.col("apportioned_income").cast("double")),
        }
    )


def state_shares(state: DataFrame) -> DataFrame:
    """Each state's part of all state tax."""
    per_state = pivot_lines(state, ["state_key"], "tax_line_key", "amount", {"state_tax": STATE_SUMS["state_tax"]})
    return share_of_total(per_state.withColumn("state_tax", F.col("state_tax").cast("double")), "state_tax", "share_of_total")


def yearly_change(rates: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return change_from_previous(rates, keys, "tax_year", value)
