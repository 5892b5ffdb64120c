"""Tax calculations over the orders: an order is a return, its price the salary."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.num import money, r6
from ..operators.quality import share_sums
from ..plans import taxes as tax
from .registry import query

IDS = ["return_id", "employee_key", "entity_key", "tax_year"]


def returns(t):
    """Spine with one salary per return."""
    price = F.col("o_totalprice")
    whole = F.floor(price)
    return t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat_ws("-", F.year("o_orderdate").cast("string"), F.col("o_orderkey").cast("string")).alias("return_id"),
        F.col("o_custkey").alias("employee_key"),
        F.col("c_nationkey").alias("entity_key"),
        F.year("o_orderdate").alias("tax_year"),
        price.alias("salary"),
        F.pmod(whole, F.lit(3)).alias("equity_units"),
        (F.pmod(whole, F.lit(5)) == 0).alias("has_credit"),
        F.col("c_nationkey").alias("home_state_key"),
        F.pmod(whole, F.lit(25)).cast("int").alias("work_state_key"),
        (price < 150_000).alias("has_second_state"),
    )


def federal(t):
    return tax.federal_lines(tax.federal_trail(returns(t)), IDS)


def state_trail(t):
    taxed = F.pmod(F.col("state_key"), F.lit(5)) != 0
    return tax.state_trail(tax.state_filings(tax.federal_trail(returns(t))), taxed)


def state(t):
    return tax.state_lines(state_trail(t), ["return_id", "employee_key", "entity_key", "state_key", "tax_year"])


def dec(x: str) -> str:
    """Decimal cast by the shortest decimal text, half up, as Spark casts a double."""
    return f"CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(18,2))"


RETURNS = """r AS (SELECT CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(o_orderkey AS VARCHAR) AS return_id, o_custkey AS employee_key, c_nationkey AS entity_key, CAST(year(o_orderdate) AS INTEGER) AS tax_year,
    o_totalprice AS salary, CAST(floor(o_totalprice) AS BIGINT) % 3 AS eu, CAST(floor(o_totalprice) AS BIGINT) % 5 = 0 AS has_credit, c_nationkey AS home,
    CAST(CAST(floor(o_totalprice) AS BIGINT) % 25 AS INTEGER) AS work, o_totalprice < 150000 AS second FROM orders JOIN customer ON o_custkey = c_custkey)"""
FED = (
    RETURNS,
    """f1 AS (SELECT *, salary * 0.8::DOUBLE AS wages, salary * 0.08::DOUBLE AS bonus, salary * 0.06::DOUBLE * eu AS equity, salary * 0.01::DOUBLE AS interest, salary * 0.01::DOUBLE AS dividends, salary * 0.02::DOUBLE AS other_income,
        13850.0::DOUBLE * pow(1.03::DOUBLE, tax_year - 2022) AS std FROM r)""",
    "f2 AS (SELECT *, (wages + bonus + equity + interest + dividends + other_income) * 0.95::DOUBLE AS agi FROM f1)",
    "f3 AS (SELECT *, greatest(agi - std, 0.0::DOUBLE) AS taxable FROM f2)",
    "f4 AS (SELECT *, taxable * (0.1::DOUBLE + 0.27::DOUBLE * least(taxable / 500000.0::DOUBLE, 1.0::DOUBLE)) AS tax, CASE WHEN has_credit THEN 2000.0::DOUBLE ELSE 0.0::DOUBLE END AS credits FROM f3)",
    "f5 AS (SELECT *, tax * 1.03::DOUBLE AS withheld FROM f4)",
    "f6 AS (SELECT *, tax - credits - withheld AS balance FROM f5)",
)
FED_COLUMNS = "wages bonus equity interest dividends other_income agi std taxable tax credits withheld balance taxable".split()
FED_LINES = "fl AS (" + " UNION ALL ".join(
    f"SELECT return_id, employee_key, entity_key, tax_year, {i + 1} AS tax_line_key, {i + 1 if i < 6 else 'CAST(NULL AS INTEGER)'} AS income_type_key, {dec(c)} AS amount FROM f6"
    for i, c in enumerate(FED_COLUMNS)
) + ")"
ST = (
    """s1 AS (SELECT return_id, employee_key, entity_key, tax_year, agi, home AS state_key, CASE WHEN second AND work <> home THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END AS share FROM f6
        UNION ALL SELECT return_id, employee_key, entity_key, tax_year, agi, work, 0.3::DOUBLE FROM f6 WHERE second AND work <> home)""",
    "s2 AS (SELECT *, agi * 0.01::DOUBLE AS add, agi * 0.02::DOUBLE AS sub, share * 5000.0::DOUBLE AS sstd FROM s1)",
    "s3 AS (SELECT *, agi + add - sub AS s_agi FROM s2)",
    "s4 AS (SELECT *, s_agi * share AS apport FROM s3)",
    "s5 AS (SELECT *, greatest(apport - sstd, 0.0::DOUBLE) AS staxable FROM s4)",
    "s6 AS (SELECT *, CASE WHEN state_key % 5 <> 0 THEN staxable * (0.01::DOUBLE + (state_key % 11) * 0.007::DOUBLE) ELSE 0.0::DOUBLE END AS stax FROM s5)",
    "s7 AS (SELECT *, stax - 0.0::DOUBLE - stax * 1.02::DOUBLE - 0.0::DOUBLE AS sbal FROM s6)",
)
ST_EXPR = "agi|add|sub|s_agi|share * 100|apport|sstd|staxable|stax|stax * 0.05::DOUBLE|apport * 0.001::DOUBLE|apport * 0.0008::DOUBLE|0.0::DOUBLE|stax * 1.02::DOUBLE|0.0::DOUBLE|sbal".split("|")
ST_LINES = "sl AS (" + " UNION ALL ".join(
    f"SELECT return_id, employee_key, entity_key, state_key, tax_year, {101 + i} AS tax_line_key, {dec(c)} AS amount, {dec('agi')} AS federal_agi_ref FROM s7" for i, c in enumerate(ST_EXPR)
) + ")"


def w(ctes, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


CODE_SUM = "CAST(sum(CASE WHEN tax_line_key {} THEN amount END) AS DECIMAL(18,2)) AS {}"
FED_SUMMARY = "fs AS (SELECT entity_key, tax_year, income_type_key, " + ", ".join(
    CODE_SUM.format(k, n) for k, n in (("<= 6", "gross_income"), ("= 7", "federal_agi"), ("= 9", "federal_taxable_income"), ("= 10", "federal_tax"))
) + " FROM fl GROUP BY 1, 2, 3)"
ST_SUMMARY = "ss AS (SELECT entity_key, state_key, tax_year, " + CODE_SUM.format("= 109", "state_tax") + ", " + CODE_SUM.format("= 108", "state_taxable_income") + " FROM sl GROUP BY 1, 2, 3)"


@query("b23_return_spine", """WITH f AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS tax_year, CAST(o_orderdate AS DATE) AS filed_date, o_orderstatus FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1)
    SELECT CAST(y AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS return_id, c_custkey AS employee_key, c_nationkey AS entity_key, CAST(y AS INTEGER) AS tax_year,
    CASE WHEN o_orderstatus = 'F' THEN 'COMPLETE' WHEN o_orderstatus = 'O' THEN 'IN_REVIEW' WHEN o_orderstatus IS NULL THEN 'OPEN' ELSE 'AMENDED' END AS return_status, filed_date
    FROM customer CROSS JOIN range(1992, 1999) g(y) LEFT JOIN f ON o_custkey = c_custkey AND tax_year = y""")
def b23(t):
    """Orders stand for filings: their status and date are those of the return."""
    from ..sources.tax_tables import return_spine

    people = t.customer.select(F.col("c_custkey").alias("employee_key"), F.col("c_nationkey").alias("entity_key"))
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETE").when(F.col("o_orderstatus") == "O", "IN_REVIEW").otherwise("AMENDED")
    filed = t.orders.select(F.col("o_custkey").alias("employee_key"), F.year("o_orderdate").alias("tax_year"), F.to_date("o_orderdate").alias("filed_date"), F.col("o_orderkey").alias("filing_id"), status.alias("return_status"))
    return return_spine(people, filed, list(range(1992, 1999)))


@query("b24_federal_trail", w(FED, "SELECT return_id, " + ", ".join(f"{dec(c)} AS {c}" for c in "wages bonus equity agi taxable tax credits withheld balance".split()) + " FROM f6"))
def b24(t):
    out = tax.federal_trail(returns(t))
    return out.select("return_id", *[money(c).alias(c) for c in "wages bonus equity agi taxable tax credits withheld balance".split()])


@query("b25_state_trail", w((*FED, *ST), "SELECT return_id, state_key, share, " + ", ".join(f"{dec(c)} AS {n}" for c, n in (("s_agi", "state_agi"), ("apport", "apportioned"), ("staxable", "state_taxable"), ("stax", "state_tax"), ("sbal", "state_balance"))) + " FROM s7"))
def b25(t):
    return state_trail(t).select(
        "return_id", "state_key", "share", *[money(c).alias(c) for c in ("state_agi", "apportioned", "state_taxable", "state_tax", "state_balance")]
    )


@query("c10_unpivot_federal_lines", w((*FED, FED_LINES), "SELECT * FROM fl"))
def c10(t):
    return federal(t)


@query("c10_unpivot_state_lines", w((*FED, *ST, ST_LINES), "SELECT * FROM sl"))
def c10b(t):
    return state(t)


@query("c11_pivot_back", w((*FED, FED_LINES), "SELECT return_id, " + ", ".join(CODE_SUM.format(k, n) for k, n in (("<= 6", "gross_income"), ("= 7", "federal_agi"), ("= 9", "federal_taxable_income"), ("= 10", "federal_tax"))) + " FROM fl GROUP BY 1"))
def c11(t):
    from ..operators.lines import pivot_lines

    return pivot_lines(federal(t), ["return_id"], "tax_line_key", "amount", tax.FEDERAL_SUMS)


@query("e16_two_grain_combine", w((*FED, FED_LINES, FED_SUMMARY), """SELECT a.entity_key, a.tax_year, a.income_type_key, a.gross_income, b.federal_tax FROM (SELECT * FROM fs WHERE income_type_key IS NOT NULL) a
    LEFT JOIN (SELECT entity_key, tax_year, CAST(sum(federal_tax) AS DECIMAL(18,2)) AS federal_tax FROM fs GROUP BY 1, 2) b ON a.entity_key = b.entity_key AND a.tax_year = b.tax_year"""))
def e16(t):
    return tax.income_with_tax(tax.federal_summary(federal(t)))


@query("e17_federal_summary", w((*FED, FED_LINES, FED_SUMMARY), "SELECT * FROM fs"))
def e17(t):
    return tax.federal_summary(federal(t))


@query("e17_state_summary", w((*FED, *ST, ST_LINES, ST_SUMMARY), "SELECT * FROM ss"))
def e17b(t):
    return tax.state_summary(state(t))


RATE_SQL = """g AS (SELECT entity_key, tax_year, sum(CASE WHEN tax_line_key <= 6 THEN amount END) AS gross, sum(CASE WHEN tax_line_key = 10 THEN amount END) AS ft FROM fl GROUP BY 1, 2)""", """h AS (SELECT entity_key, tax_year, sum(CASE WHEN tax_line_key = 109 THEN amount END) AS stx, sum(CASE WHEN tax_line_key = 106 THEN amount END) AS app FROM sl GROUP BY 1, 2)""", """rt AS (SELECT entity_key, tax_year, CAST(gross AS DECIMAL(18,2)) AS gross_income, CAST(ft AS DECIMAL(18,2)) AS federal_tax, CAST(stx AS DECIMAL(18,2)) AS state_tax, CAST(app AS DECIMAL(18,2)) AS apportioned_income,
    ft::DOUBLE / nullif(gross::DOUBLE, 0) AS federal_rate, (ft + coalesce(stx, 0))::DOUBLE / nullif(gross::DOUBLE, 0) AS combined_rate, stx::DOUBLE / nullif(app::DOUBLE, 0) AS state_rate FROM g LEFT JOIN h USING (entity_key, tax_year))"""
RATES = ["federal_rate", "combined_rate", "state_rate"]


def rates(t, by):
    return tax.effective_rates(federal(t), state(t), by)


@query("e18_effective_rates", w((*FED, FED_LINES, *ST, ST_LINES, *RATE_SQL), "SELECT entity_key, tax_year, gross_income, federal_tax, state_tax, apportioned_income, round(federal_rate, 6) AS federal_rate, round(combined_rate, 6) AS combined_rate, round(state_rate, 6) AS state_rate FROM rt"))
def e18(t):
    return rates(t, ["entity_key", "tax_year"]).withColumns({c: r6(c) for c in RATES})


@query("e18_overall_rates", w((*FED, FED_LINES, *ST, ST_LINES), """SELECT round((SELECT sum(amount)::DOUBLE FROM fl WHERE tax_line_key = 10) / (SELECT sum(amount)::DOUBLE FROM fl WHERE tax_line_key <= 6), 6) AS federal_rate,
    round(((SELECT sum(amount) FROM fl WHERE tax_line_key = 10) + (SELECT sum(amount) FROM sl WHERE tax_line_key = 109))::DOUBLE / (SELECT sum(amount)::DOUBLE FROM fl WHERE tax_line_key <= 6), 6) AS combined_rate,
    round((SELECT sum(amount)::DOUBLE FROM sl WHERE tax_line_key = 109) / (SELECT sum(amount)::DOUBLE FROM sl WHERE tax_line_key = 106), 6) AS state_rate"""))
def e18b(t):
    return rates(t, []).select(*[r6(c).alias(c) for c in RATES])


@query("e18_state_share", w((*FED, *ST, ST_LINES), "SELECT state_key, round(sum(amount)::DOUBLE, 2) AS state_tax, round(sum(amount)::DOUBLE / (SELECT sum(amount)::DOUBLE FROM sl WHERE tax_line_key = 109), 6) AS share_of_total FROM sl WHERE tax_line_key = 109 GROUP BY 1"))
def e18c(t):
    return tax.state_shares(state(t)).withColumns({"state_tax": F.round("state_tax", 2), "share_of_total": r6("share_of_total")})


@query("e18_yearly_change", w((*FED, FED_LINES, *ST, ST_LINES, *RATE_SQL), "SELECT a.entity_key, a.tax_year, round(a.combined_rate, 6) AS combined_rate, round(b.combined_rate, 6) AS previous_combined_rate, round((a.combined_rate - b.combined_rate) / nullif(b.combined_rate, 0), 6) + 0 AS combined_rate_change FROM rt a LEFT JOIN rt b ON b.entity_key = a.entity_key AND b.tax_year = a.tax_year - 1"))
def e18d(t):
    out = tax.yearly_change(rates(t, ["entity_key", "tax_year"]), ["entity_key"], "combined_rate")
    return out.select("entity_key", "tax_year", *[r6(c).alias(c) for c in ("combined_rate", "previous_combined_rate", "combined_rate_change")])


@query("e19_return_status", "SELECT CAST(year(o_orderdate) AS INTEGER) AS tax_year, CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'O' THEN 'IN_REVIEW' ELSE 'AMENDED' END AS return_status, count(*) AS returns FROM orders GROUP BY 1, 2")
def e19(t):
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETE").when(F.col("o_orderstatus") == "O", "IN_REVIEW").otherwise("AMENDED")
    return t.orders.groupBy(F.year("o_orderdate").alias("tax_year"), status.alias("return_status")).agg(F.count(F.lit(1)).alias("returns"))


@query("n09_share_sums", w((*FED, *ST), "SELECT count(*) AS returns_with_broken_shares FROM (SELECT return_id FROM s1 GROUP BY 1 HAVING abs(sum(share) - 1) > 1e-9)"))
def n09(t):
    return share_sums(tax.state_filings(returns(t)), ["return_id"], "share").agg(F.count(F.lit(1)).alias("returns_with_broken_shares"))


@query("n12_federal_state_lineage", w((*FED, FED_LINES, *ST, ST_LINES), """SELECT count(*) AS state_filings, count(*) FILTER (WHERE a.amount IS NULL) AS without_federal, count(*) FILTER (WHERE a.amount <> b.federal_agi_ref) AS different
    FROM (SELECT DISTINCT return_id, state_key, federal_agi_ref FROM sl) b LEFT JOIN (SELECT return_id, amount FROM fl WHERE tax_line_key = 7) a USING (return_id)"""))
def n12(t):
    agi = federal(t).where("tax_line_key = 7").select("return_id", F.col("amount").alias("agi"))
    # every filing has one line of the first code, so no distinct is needed
    filed = state(t).where(F.col("tax_line_key") == tax.STATE_LINES[0][0]).select("return_id", "state_key", "federal_agi_ref")
    return filed.join(agi, "return_id", "left").agg(
        F.count(F.lit(1)).alias("state_filings"), F.count_if(F.col("agi").isNull()).alias("without_federal"), F.count_if(F.col("agi") != F.col("federal_agi_ref")).alias("different")
    )
