"""Views over regulatory filings: first dissemination, units of reported values, effective reports, votes, trades of insiders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockwright.functions.labels import against_management, how_voted
from blockwright.operators.forks import latest


def filings_first(filings: DataFrame) -> DataFrame:
    """The first dissemination of each accession number, never a deletion notice, with counts and flags over all of them."""
    w = Window.partitionBy("accession_number")
    notice = F.col("is_deletion_notice")
    marked = filings.withColumns({
        "dissemination_count": F.count_if(~notice).over(w), "is_deleted": F.bool_or(notice).over(w),
        "is_corrected": F.bool_or(F.array_contains("dissemination_flags", "CORRECTION") & ~notice).over(w),
    })
    first = latest(marked.where(~notice), ["accession_number"], ["block_num", "filing_index"])
    return first.withColumn("is_redisseminated", F.col("dissemination_count") > 1)


def value_multiplier_rule(filing_date: Column, partition: Column) -> Column:
    """Thousands before 2023-01-03, units from then on."""
    return F.when(F.coalesce(filing_date, partition) < F.lit("2023-01-03").cast("date"), 1000).otherwise(1)


def units_13f(reports: DataFrame, holdings: DataFrame) -> DataFrame:
    """The multiplier of each report's values and where it comes from; ratios decide only over plain share rows."""
    key = ["block_num", "filing_index"]
    plain = holdings.where("shares_or_principal_type = 'SH' AND put_call_norm IS NULL AND shares_or_principal_amount > 0 AND value > 0")
    q = plain.groupBy(*key).agg(F.count("*").alias("qualifying_rows"), F.median(F.col("value").cast("double") / F.col("shares_or_principal_amount")).alias("median_value_per_share"))
    s = reports.join(q, key, "left").withColumn("qualifying_rows", F.coalesce("qualifying_rows", F.lit(0)))
    rule, mid, n = F.col("value_multiplier_rule"), F.col("median_value_per_share"), F.col("qualifying_rows")
    s = s.withColumns({
        "_other": F.when((rule == 1000) & (mid >= 2), 1).when((rule == 1) & (mid < 0.5), 1000),
        "_ratio": F.when((F.col("table_value_total") > 0) & (F.col("holdings_value_sum") > 0), F.col("table_value_total").cast("double") / F.col("holdings_value_sum")),
    })
    small, large = F.col("_ratio").between(0.0005, 0.002), F.col("_ratio").between(500, 2000)
    agreed = ((F.col("_other") == 1) & small) | ((F.col("_other") == 1000) & large)
    source = (F.when((n >= 5) & F.col("_other").isNotNull(), "median_override").when((n > 0) & agreed, "median_and_total_override")
              .when((n >= 5) & (mid >= 0.5) & (mid < 2), "ambiguous").otherwise("filing_date_rule"))
    s = s.withColumn("value_unit_source", source)
    s = s.withColumn("value_multiplier", F.when(F.col("value_unit_source").isin("median_override", "median_and_total_override"), F.col("_other")).otherwise(rule))
    table = F.when(small, F.col("value_multiplier") * 1000).when(large & (F.col("value_multiplier") == 1000), 1).otherwise(F.col("value_multiplier"))
    s = s.withColumn("table_value_multiplier", table).withColumn("table_value_total_usd", F.col("table_value_total") * F.col("table_value_multiplier"))
    return s.drop("_other", "_ratio")


def holdings_usd(holdings: DataFrame, units: DataFrame) -> DataFrame:
    u = units.select("block_num", "filing_index", "value_multiplier", "value_unit_source")
    return holdings.join(u, ["block_num", "filing_index"]).withColumn("value_usd", F.col("value") * F.col("value_multiplier"))


def effective_reports_13f(reports: DataFrame, first: DataFrame) -> DataFrame:
    """The latest original or restatement of each manager and period, and the new-holdings amendments accepted after it."""
    key = ["block_num", "filing_index"]
    r = reports.join(first.select(*key), key, "left_semi").where("report_type IN ('13F HOLDINGS REPORT', '13F COMBINATION REPORT') AND manager_cik IS NOT NULL")
    newest = [F.desc("acceptance_datetime"), F.desc("block_num"), F.desc("filing_index")]
    base = latest(r.where("coalesce(amendment_type, '') <> 'NEW HOLDINGS'"), ["manager_cik", "period_of_report"], newest)
    shown = [*key, "manager_cik", "period_of_report"]
    after = r.where("amendment_type = 'NEW HOLDINGS'").join(base.select("manager_cik", "period_of_report", F.col("acceptance_datetime").alias("_from")), ["manager_cik", "period_of_report"]).where("acceptance_datetime > _from")
    return base.select(*shown, F.lit("base").alias("effective_role")).unionByName(after.select(*shown, F.lit("new_holdings").alias("effective_role")))


def effective_reports_nport(reports: DataFrame, first: DataFrame) -> DataFrame:
    key = ["block_num", "filing_index"]
    r = reports.join(first.select(*key), key, "left_semi").withColumn("_series", F.coalesce("series_id", "series_name"))
    return latest(r, ["filer_cik", "_series", "as_of_date"], [F.desc("acceptance_datetime"), F.desc("block_num"), F.desc("filing_index")]).drop("_series")


def vote_records_norm(votes: DataFrame) -> DataFrame:
    return votes.withColumns({"how_voted_norm": how_voted(F.col("how_voted")), "voted_against_management": against_management(F.col("how_voted"), F.col("management_recommendation"))})


def ownership_facts(trades: DataFrame) -> DataFrame:
    """signed_shares, value_usd (null, never 0, without a price; null on overflow), is_open_market, filing_lag_days, owners and their roles."""
    side = F.col("acquired_disposed_code")
    value = F.try_multiply(F.col("shares"), F.col("price_per_share")).try_cast("decimal(38,6)")
    owners = F.col("owners")
    role = lambda f: F.exists(owners, lambda o: F.coalesce(o[f], F.lit(False)))
    return trades.withColumns({
        "signed_shares": F.when(side == "A", F.col("shares")).when(side == "D", -F.col("shares")), "value_usd": value,
        "is_open_market": ~F.col("is_derivative") & F.coalesce(F.col("transaction_code").isin("P", "S"), F.lit(False)),
        "filing_lag_days": F.date_diff("filing_date", "transaction_date"), "owner_ciks": F.transform(owners, lambda o: o["cik"]),
        "any_owner_is_officer": role("is_officer"), "any_owner_is_director": role("is_director"), "officer_titles": F.transform(F.filter(owners, lambda o: o["is_officer"]), lambda o: o["title"]),
    })


def header_party(parties: Column, roles: list[str], fallback: str | None = None, use_fallback: Column | None = None) -> Column:
    """The first party of the listed roles in header order; with the fallback role for forms whose issuers file for themselves."""
    found = F.get(F.filter(parties, lambda p: p["role"].isin(roles)), 0)
    if fallback is None:
        return found
    own = F.get(F.filter(parties, lambda p: p["role"] == fallback), 0)
    return F.coalesce(found, F.when(use_fallback, own))


def holdings_totals(reports: DataFrame, holdings: DataFrame) -> DataFrame:
    """holdings_count, holdings_value_sum (null on overflow) and whether all declared entries are there."""
    key = ["block_num", "filing_index"]
    s = holdings.groupBy(*key).agg(F.count("*").alias("holdings_count"), F.try_sum("value").alias("holdings_value_sum"))
    out = reports.join(s, key, "left").withColumn("holdings_count", F.coalesce("holdings_count", F.lit(0)))
    return out.withColumn("holdings_complete", F.when(F.col("table_entry_total").isNotNull(), F.col("holdings_count") >= F.col("table_entry_total")))


def notice_totals(notices: DataFrame, lots: str, amount: str) -> DataFrame:
    """The checked total of a list field: null where nothing is given or it overflows."""
    amounts = F.filter(F.transform(lots, lambda x: x[amount]), lambda x: x.isNotNull())
    total = F.aggregate(amounts, F.lit(0).cast("decimal(38,6)"), lambda a, x: F.try_add(a, x).try_cast("decimal(38,6)"))
    return notices.withColumn("total", F.when(F.size(amounts) > 0, total))
