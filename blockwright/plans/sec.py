"""Filings: what their nested forms need before they are flattened, how their texts are read, and the table of issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockwright.functions.parse import base_form_type
from blockwright.functions.schema import IDENTITY
from blockwright.operators.typed import Typing, chained, merged_lists, typed_row

_FILING, _FORM_13F, _NPORT = "filings[]", "filings[].form13f", "filings[].nport"

# How text fields are read. A name holds wherever no place says otherwise.
DATES = [
    "feed_date", "filing_date", "period_of_report", "date_of_original_submission", "transaction_date", "deemed_execution_date", "exercise_date", "expiration_date", "event_date", "notice_date",
    "approx_sale_date", "acquired_date", "donor_acquired_date", "payment_date", "sale_date", "rep_period_end", "rep_period_date", "maturity_date", "termination_date", "settlement_date",
    "date_of_first_sale", "meeting_date", "report_ending_period", "date_incorporation", "deadline_date", "date_changed", "signature_date", "plan_adoption_dates[]",
]
DECIMALS = {
    2: ["aggregate_market_value", "gross_proceeds", "minimum_investment", "total_amount_sold", "sales_commissions", "finders_fees", "gross_proceeds_used", "offering_amount", "maximum_offering_amount"],
    6: ["shares", "price_per_share", "total_value", "shares_owned", "value_owned", "shares_owned_following", "value_owned_following", "conversion_or_exercise_price", "sole_voting_power", "shared_voting_power",
        "sole_dispositive_power", "shared_dispositive_power", "aggregate_amount_owned", "units_sold", "units_outstanding", "amount_acquired", "amount_sold", "num_securities_offered", "price"],
    10: ["total_assets", "total_liabilities", "net_assets", "assets_invested", "misc_securities_assets", "cash_not_reported", "sales", "reinvestment", "redemption", "net_realized_gain", "net_unrealized_appreciation",
         "balance", "value_usd", "loan_value", "cash_collateral_value", "share_no", "principal_amount", "notional_amount", "unrealized_appreciation", "amount_currency_sold", "amount_currency_purchased",
         "upfront_payment", "upfront_receipt", "payment_amount"],
    12: ["percent_of_class", "return_month1", "return_month2", "return_month3", "exchange_rate", "pct_value", "annualized_rate", "conversion_ratio", "fixed_rate", "floating_rate_spread"],
    16: ["shares_voted", "shares_on_loan"],
}
INTEGERS = {32: ["amendment_number", "sequence_number", "year_of_inc", "report_calendar_year", "serial_number"], 64: ["table_value_total", "number_non_accredited_investors", "total_already_invested", "current_employees"]}
FLAGS = ["swap_flag", "provide_info_for_instruction5", "confidential_treatment", "explanatory_choice"]
#: Lines of a financial statement, each for the most recent and the prior fiscal year.
STATEMENT = ["total_assets", "cash_equivalents", "accounts_receivable", "short_term_debt", "long_term_debt", "revenue", "cost_goods_sold", "tax_paid", "net_income"]
PLACES = {
    f"{_FILING}.parties[].fiscal_year_end": "text", f"{_FILING}.form_c.period": "date", f"{_FILING}.npx.cover_page.series_count": "int:32",
    f"{_FORM_13F}.holdings[].value": "int:64", f"{_FORM_13F}.holdings[].shares_or_principal.amount": "int:64", f"{_FORM_13F}.holdings[].voting_authority.sole": "int:64",
    f"{_FORM_13F}.holdings[].voting_authority.shared": "int:64", f"{_FORM_13F}.holdings[].voting_authority.none": "int:64",
    f"{_FILING}.ownership.transactions[].underlying_security.value": "decimal:6", f"{_FILING}.ownership.holdings[].underlying_security.value": "decimal:6",
    f"{_NPORT}.holdings[].derivatives[].exercise_price": "decimal:10", f"{_NPORT}.holdings[].derivatives[].legs[].amount": "decimal:10", f"{_NPORT}.holdings[].derivatives[].ref_index_components[].value": "decimal:10",
    f"{_FILING}.form_d.offering.total_offering_amount": "amount:2", f"{_FILING}.form_d.offering.total_remaining": "amount:2",
    "cusip": "cusip", "ref_cusip": "cusip", "lei": "lei", f"{_FORM_13F}.holdings[].put_call": "put_call",
}
BODIES = ["ownership", "form13f", "beneficial", "form144", "nport", "form_d", "npx", "ncen", "form_c"]
#: signature_source -> list or message it comes from, and its fields as signed_for, signer_name, signature_text, title and signature_date.
SIGNATURES = {
    "ownership": ("ownership.owner_signatures", {"signer_name": "name", "signature_text": "name", "signature_date": "date"}),
    "form13f": ("form13f.signature", {"signer_name": "name", "signature_text": "signature", "title": "title", "signature_date": "signature_date", "phone": "phone", "city": "city", "state": "state_or_country"}),
    "beneficial": ("beneficial.signatures", {"signed_for": "signing_person", "signer_name": "name", "signature_text": "signature", "title": "title", "signature_date": "date"}),
    "nport": ("nport.signature", {"signed_for": "name_of_applicant", "signer_name": "signer_name", "signature_text": "signature", "title": "title", "signature_date": "date_signed"}),
    "form_d": ("form_d.signatures", {"signed_for": "issuer_name", "signer_name": "name_of_signer", "signature_text": "signature_name", "title": "signature_title", "signature_date": "signature_date"}),
    "npx": ("npx.signature", {"signed_for": "reporting_person", "signer_name": "tx_printed_signature", "signature_text": "tx_signature", "title": "tx_title", "signature_date": "tx_as_of_date"}),
    "form_c_issuer": ("form_c.issuer_signature", {"signed_for": "issuer", "signature_text": "issuer_signature", "title": "issuer_title"}),
    "form_c_person": ("form_c.person_signatures", {"signature_text": "signature", "title": "title", "signature_date": "date"}),
}
SIGNATURE_FIELDS = ["signed_for", "signer_name", "signature_text", "title", "phone", "city", "state", "signature_date"]

TYPING = Typing(
    {**dict.fromkeys(DATES, "date"), **{n: f"decimal:{s}" for s, names in DECIMALS.items() for n in names}, **{n: f"int:{b}" for b, names in INTEGERS.items() for n in names}, **dict.fromkeys(FLAGS, "yn"),
     **{f"{line}_{year}_fy": "decimal:2" for line in STATEMENT for year in ("most_recent", "prior")}, **PLACES},
    rows=frozenset(f"{_FILING}.{b}" for b in BODIES), inline=frozenset({f"{_FILING}.parties[].former_names"}))


def _at(kind: T.DataType | None, path: str) -> T.DataType | None:
    for name in path.split("."):
        if not isinstance(kind, T.StructType) or name not in kind.fieldNames():
            return None
        kind = kind[name].dataType
    return kind


def _value(v: Column, path: str) -> Column:
    for name in path.split("."):
        v = v[name]
    return v


def _signature(source: str, names: dict[str, str], have: set[str]):
    return lambda m: F.struct(F.lit(source).alias("signature_source"), *[(m[names[f]] if names.get(f) in have else F.lit(None).cast("string")).alias(f) for f in SIGNATURE_FIELDS])


def _signatures(x: Column, kind: T.StructType) -> Column | None:
    parts = []
    for source, (path, names) in SIGNATURES.items():
        found = _at(kind, path)
        if found is None:
            continue
        message = found.elementType if isinstance(found, T.ArrayType) else found

        v = _value(x, path)
        parts.append(F.coalesce(F.transform(v if isinstance(found, T.ArrayType) else F.when(v.isNotNull(), F.array(v)), _signature(source, names, set(message.fieldNames()))), F.array()))
    return F.concat(*parts) if len(parts) > 1 else (parts[0] if parts else None)


#: New list -> the lists it is made of with their labels, and the name of the label.
MERGED = {
    "ownership.transactions": ({"non_derivative": "ownership.non_derivative_transactions", "derivative": "ownership.derivative_transactions"}, "security_kind"),
    "ownership.holdings": ({"non_derivative": "ownership.non_derivative_holdings", "derivative": "ownership.derivative_holdings"}, "security_kind"),
    "form13f.other_managers": ({"cover": "form13f.cover_page.other_managers", "summary": "form13f.summary_page.other_managers"}, "list_kind"),
    "npx.other_managers": ({"cover": "npx.cover_page.other_managers", "summary": "npx.cover_page.summary_managers"}, "list_kind"),
}


def prepared_filings(blocks: DataFrame) -> DataFrame:
    """Filings with the lists their tables come from: two-part lists merged, nested derivatives as a list, signatures of all forms together."""
    kind = _at(blocks.schema, "filings")
    if not isinstance(kind, T.ArrayType):
        return blocks
    message = kind.elementType

    def more(x: Column) -> Column:
        for target, (parts, tag) in MERGED.items():
            found = [(label, _value(x, path), _at(message, path)) for label, path in parts.items() if _at(message, path) is not None]
            if found:
                body = target.split(".")[0]
                x = x.withField(body, F.when(x[body].isNotNull(), x[body].withField(target.split(".")[1], merged_lists(found, tag))))
        holdings = _at(message, "nport.holdings")
        derivative = _at(holdings.elementType, "derivative") if isinstance(holdings, T.ArrayType) else None
        if derivative is not None:
            chain = F.transform(x["nport"]["holdings"], lambda h: h.withField("derivatives", chained(h["derivative"], derivative, "nested")).dropFields("derivative"))
            x = x.withField("nport", F.when(x["nport"].isNotNull(), x["nport"].withField("holdings", chain)))
        signed = _signatures(x, message)
        return x.withField("signatures", signed) if signed is not None else x

    return blocks.withColumn("filings", F.transform("filings", more))


def typed_filings(blocks: DataFrame) -> DataFrame:
    """Prepared blocks with every text of a known kind typed and the issues beside it; typed blocks stay as they are.

    Each table is a job of its own: store typed blocks once where more than one table is made of them.
    """
    kind = _at(blocks.schema, "filings")
    if isinstance(kind, T.ArrayType) and _at(kind.elementType, "_issues") is not None:
        return blocks
    blocks = prepared_filings(blocks)
    for name, place in (("header", "header"), ("filings", _FILING)):
        kind = _at(blocks.schema, name)
        if isinstance(kind, T.ArrayType):
            element = kind.elementType
            blocks = blocks.withColumn(name, F.transform(name, lambda x: typed_row(TYPING, x, element, place)))  # noqa: B023
        elif isinstance(kind, T.StructType):
            blocks = blocks.withColumn(name, F.when(F.col(name).isNotNull(), typed_row(TYPING, F.col(name), kind, place)))
    return blocks


ISSUE_ROW = "array<struct<filing_index:int,accession_number:string,table_name:string,column_name:string,index_1:int,index_2:int,index_3:int,raw_value:string,issue:string>>"


def _gathered(table: str, v: Column, kind: T.DataType, parts: list[str], positions: list[Column], accession: Column) -> Column | None:
    """The issues of a table's rows at and below ``v`` with the rows' positions."""
    none = F.array().cast(ISSUE_ROW)
    if not parts:
        if _at(kind, "_issues") is None:
            return None

        def row(s: Column) -> Column:
            places: list[Column] = [*positions[1:], *[F.lit(None).cast("int")] * 4]
            keys = [places[k] if k != len(positions) - 1 else s["element"] for k in range(3)]  # an item's position follows the row's own
            return F.struct(positions[0].alias("filing_index") if positions else F.lit(None).cast("int").alias("filing_index"), accession.alias("accession_number"), F.lit(table).alias("table_name"), s["column_name"].alias("column_name"),
                            *[k.cast("int").alias(f"index_{i + 1}") for i, k in enumerate(keys)], s["raw_value"].alias("raw_value"), s["issue"].alias("issue"))

        return F.coalesce(F.transform(v["_issues"], row), none)
    part, rest = parts[0], parts[1:]
    path = part.removeprefix(">").split("@")[0]
    found = _at(kind, path)
    if found is None:
        return None
    at = _value(v, path)
    if part.startswith(">"):
        return _gathered(table, at, found, rest, positions, accession)
    if _gathered(table, F.lit(None), found.elementType, rest, [*positions, F.lit(0)], accession) is None:
        return None
    return F.coalesce(F.flatten(F.transform(at, lambda x, i: _gathered(table, x, found.elementType, rest, [*positions, i], accession))), none)


def parse_issues(typed: DataFrame, tables: dict[str, str]) -> DataFrame:
    """One row a value that did not convert exactly: block, filing_index, accession_number, table_name, column_name, index_1 to index_3, raw_value, issue.

    ``tables``: name -> its path in the family's notation. index_1 to index_3 are the row's positions after the filing's, then an item's position.
    """
    kind = _at(typed.schema, "filings")
    parts: list[Column] = []
    header = _at(typed.schema, "header")
    if header is not None:
        none = F.lit(None).cast("string")
        parts.append(_gathered("blocks", F.col("header"), header, [], [], none))
    if isinstance(kind, T.ArrayType):
        def filing(x: Column, i: Column) -> Column:
            accession = x["accession_number"] if _at(kind.elementType, "accession_number") is not None else F.lit(None).cast("string")
            found = [_gathered(t, x, kind.elementType, text.partition("|")[0].split()[1:], [i], accession) for t, text in tables.items() if text.startswith("filings@")]
            return F.concat(F.array().cast(ISSUE_ROW), *[c for c in found if c is not None])

        parts.append(F.flatten(F.transform("filings", filing)))
    parts = [F.coalesce(p, F.array().cast(ISSUE_ROW)) for p in parts if p is not None]
    identity = [c for c in IDENTITY if c in typed.columns]
    return typed.select(*identity, F.explode(F.concat(F.array().cast(ISSUE_ROW), *parts)).alias("i")).select(*identity, "i.*")


def sec_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What tables hold beyond their messages' fields: raw documents apart, base form types, counts and sums of a report's holdings."""
    filings = tables.get("filings")
    if filings is not None:
        if "raw_xml" in filings.columns:
            shown = [c for c in (*IDENTITY, "filing_index", "accession_number", "form_type", "filing_date", "raw_xml", "date") if c in filings.columns]
            tables["filing_raw_xml"] = filings.where("length(raw_xml) > 0").select(*shown)
            filings = filings.withColumn("raw_xml_size", F.coalesce(F.length("raw_xml"), F.lit(0)).cast("long")).drop("raw_xml")
        if "form_type" in filings.columns:
            filings = filings.withColumn("base_form_type", base_form_type(F.col("form_type")))
        tables["filings"] = filings
    return tables
