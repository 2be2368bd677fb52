"""Typed filings: values, issues with their places, two-part lists, nested derivatives, signatures, and tables of every form."""

import datetime as dt
from decimal import Decimal

from blockwright.plans.sec import TYPING, typed_filings
from blockwright.plans.specs import FAMILIES, flatten_family
from blockwright.sources.tables import stored_table

TX = "transaction_date: string, shares: string, underlying_security: struct<title: string, value: string>"
SHAPE = f"""block_num long, header struct<feed_date: string>, filings array<struct<accession_number: string, form_type: string, filing_date: string, raw_xml: binary,
  parties: array<struct<role: string, fiscal_year_end: string, former_names: array<struct<name: string, date_changed: string>>>>,
  ownership: struct<period_of_report: string, owner_signatures: array<struct<name: string, date: string>>,
    non_derivative_transactions: array<struct<transaction_date: string, shares: string>>, derivative_transactions: array<struct<{TX}>>>,
  form13f: struct<cover_page: struct<amendment_number: string, other_managers: array<struct<sequence_number: string, name: string>>>, summary_page: struct<table_value_total: string, other_managers: array<struct<sequence_number: string, name: string>>>,
    holdings: array<struct<cusip: string, value: string, put_call: string, shares_or_principal: struct<amount: string, type: string>>>>,
  form144: struct<signature: struct<notice_date: string, plan_adoption_dates: array<string>>>,
  nport: struct<holdings: array<struct<balance: string, derivative: struct<exercise_price: string, legs: array<struct<amount: string>>, nested: struct<exercise_price: string, legs: array<struct<amount: string>>>>>>>,
  form_d: struct<offering: struct<total_offering_amount: string, date_of_first_sale: string>>>>"""


def filing(n, **x):
    base = {"accession_number": f"a{n}", "form_type": "4/A", "filing_date": "2026-01-02", "raw_xml": None, "parties": [], "ownership": None, "form13f": None, "form144": None, "nport": None, "form_d": None}
    return tuple((base | x).values())


def blocks(spark):
    owner = ("1/2/2020", [("/s/ X", "soon")], [("2020-01-02Z", "1.5"), ("", "N/A")], [("2020-02-30", "1.0000005", ("t", "x"))])
    report = (("2", [("1", "m")]), ("1.5", [("x", "n"), ("2", "o")]), [("37833100", "12", " put ", ("1e3", "SH")), ("0", "99999999999999999999", None, None)])
    more = [filing(0, ownership=owner, raw_xml=b"<x/>", parties=[("FILER", "1231", [("old", "1999-1-1"), ("older", "??")])]), filing(1, form13f=report, filing_date="2026-13-01"), filing(2, form144=(("N/A", ["2020-01-01", "bad", "2020-01-03+01:00"]),)),
            filing(3, nport=([("1.00000000005", ("7", [("1")], None)), ("-", ("1", [("x")], ("bad", [("2"), ("NONE")]))), ("3", None)],)), filing(4, form_d=(("Indefinite", "2020/01/01"),)), filing(5, form_d=(("12.345", "1-2-2020"),)), filing(6)]
    more[3] = filing(3, nport=([("1.00000000005", ("7", [("1",)], None)), ("-", ("1", [("x",)], ("bad", [("2",), ("NONE",)]))), ("3", None)],))
    return spark.createDataFrame([(1, ("2026-01-02",), more), (2, ("never",), []), (3, None, None)], SHAPE)


ISSUES = {
    (1, 0, "filing_parties", "former_names.date_changed", 0, 1, None, "??", "unparseable"), (1, 0, "ownership_transactions", "transaction_date", 0, None, None, "2020-01-02Z", "tz_dropped"),
    (1, 0, "ownership_transactions", "shares", 1, None, None, "N/A", "sentinel"), (1, 0, "ownership_transactions", "transaction_date", 2, None, None, "2020-02-30", "out_of_range"),
    (1, 0, "ownership_transactions", "shares", 2, None, None, "1.0000005", "rounded"), (1, 0, "ownership_transactions", "underlying_security_value", 2, None, None, "x", "unparseable"),
    (1, 0, "filing_signatures", "signature_date", 0, None, None, "soon", "unparseable"), (1, 1, "filings", "filing_date", None, None, None, "2026-13-01", "out_of_range"),
    (1, 1, "form13f_reports", "summary_page_table_value_total", None, None, None, "1.5", "unparseable"), (1, 1, "form13f_other_managers", "sequence_number", 1, None, None, "x", "unparseable"),
    (1, 1, "form13f_holdings", "shares_or_principal_amount", 0, None, None, "1e3", "unparseable"), (1, 1, "form13f_holdings", "value", 1, None, None, "99999999999999999999", "out_of_range"),
    (1, 2, "form144_notices", "signature_notice_date", None, None, None, "N/A", "sentinel"), (1, 2, "form144_notices", "signature_plan_adoption_dates", 1, None, None, "bad", "unparseable"),
    (1, 2, "form144_notices", "signature_plan_adoption_dates", 2, None, None, "2020-01-03+01:00", "tz_dropped"), (1, 3, "nport_holdings", "balance", 0, None, None, "1.00000000005", "rounded"),
    (1, 3, "nport_holdings", "balance", 1, None, None, "-", "sentinel"), (1, 3, "nport_derivatives", "exercise_price", 1, 1, None, "bad", "unparseable"),
    (1, 3, "nport_derivative_swap_legs", "amount", 1, 0, 0, "x", "unparseable"), (1, 3, "nport_derivative_swap_legs", "amount", 1, 1, 1, "NONE", "sentinel"),
    (1, 4, "form_d_notices", "offering_date_of_first_sale", None, None, None, "2020/01/01", "unparseable"), (1, 5, "form_d_notices", "offering_total_offering_amount", None, None, None, "12.345", "rounded"),
    (2, None, "blocks", "feed_date", None, None, None, "never", "unparseable"),
}


def test_issues_carry_their_places_and_tables_their_flags(spark):
    out = flatten_family(stored_table(typed_filings(blocks(spark)), "typed"), "sec")
    got = [(r["block_num"], r["filing_index"], r["table_name"], r["column_name"], r["index_1"], r["index_2"], r["index_3"], r["raw_value"], r["issue"]) for r in out["parse_issues"].collect()]
    assert len(got) == len(set(got)) and set(got) == ISSUES
    assert {r["accession_number"] for r in out["parse_issues"].where("table_name = 'form13f_holdings'").collect()} == {"a1"}
    flagged = {name: df.where("has_parse_issues").count() for name, df in out.items() if "has_parse_issues" in df.columns}
    rows = {}
    for i in ISSUES:
        rows.setdefault(i[2], set()).add((i[1], *i[4:7]) if i[2] not in ("filing_parties", "form144_notices") else (i[1],))
    assert {k: v for k, v in flagged.items() if v} == {k: len(v) for k, v in rows.items() if k != "blocks"}


def test_typed_values(spark):
    out = flatten_family(stored_table(typed_filings(blocks(spark)), "typed"), "sec")
    tx = [(r["transaction_index"], r["security_kind"], r["transaction_date"], r["shares"], r["accession_number"], r["filing_date"]) for r in out["ownership_transactions"].orderBy("transaction_index").collect()]
    day = dt.date(2026, 1, 2)
    assert tx == [(0, "non_derivative", dt.date(2020, 1, 2), Decimal("1.5"), "a0", day), (1, "non_derivative", None, None, "a0", day), (2, "derivative", None, Decimal("1.000001"), "a0", day)]
    assert [(r["filing_index"], r["period_of_report"]) for r in out["ownership_documents"].collect()] == [(0, dt.date(2020, 1, 2))]
    assert [(r["cusip_norm"], r["value"], r["put_call_norm"], r["shares_or_principal_type"]) for r in out["form13f_holdings"].orderBy("holding_index").collect()] == [("037833100", 12, "PUT", "SH"), (None, None, None, None)]
    assert [(r["other_manager_index"], r["list_kind"], r["sequence_number"]) for r in out["form13f_other_managers"].orderBy("other_manager_index").collect()] == [(0, "cover", 1), (1, "summary", None), (2, "summary", 2)]
    assert [(r["holding_index"], r["nesting_level"], r["exercise_price"]) for r in out["nport_derivatives"].orderBy("holding_index", "nesting_level").collect()] == [(0, 0, 7), (1, 0, 1), (1, 1, None)]
    assert [(r["offering_total_offering_amount"], r["offering_total_offering_amount_is_indefinite"]) for r in out["form_d_notices"].orderBy("filing_index").collect()] == [(None, True), (Decimal("12.35"), False)]
    assert [r["signature_plan_adoption_dates"] for r in out["form144_notices"].collect()] == [[dt.date(2020, 1, 1), None, dt.date(2020, 1, 3)]]
    assert [(r["filing_index"], bytes(r["raw_xml"])) for r in out["filing_raw_xml"].collect()] == [(0, b"<x/>")]
    names = [(r["name"], r["date_changed"]) for r in out["filing_parties"].collect()[0]["former_names"]] if "former_names" in out["filing_parties"].columns else None
    assert names in (None, [("old", dt.date(1999, 1, 1)), ("older", None)])
    filings = out["filings"]
    assert filings.count() == 7 and "raw_xml" not in filings.columns and {r["base_form_type"] for r in filings.collect()} == {"4"}
    assert [(r["signature_source"], r["signer_name"], r["signature_date"]) for r in out["filing_signatures"].collect()] == [("ownership", "/s/ X", None)]


def test_blocks_are_typed_on_the_way_where_they_aren_t(spark):
    out = flatten_family(blocks(spark), "sec", only={"form_d_notices"})
    assert set(out) == {"form_d_notices"} and out["form_d_notices"].where("has_parse_issues").count() == 2


def test_every_form_has_its_tables():
    assert len(FAMILIES["sec"]) + len(["filing_raw_xml", "parse_issues"]) == 43
    assert TYPING.kind("filings[].parties[].fiscal_year_end") is None and TYPING.kind("x.revenue_prior_fy") == "decimal:2"
