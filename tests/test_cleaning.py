import pytest

from fundlake import schemas as S
from fundlake.plans import cleaning
from fundlake.sources import files


def raw(spark, columns, rows):
    """Text rows with their arrival position."""
    kinds = ", ".join(f"{c} STRING" for c in columns) + ", ingest_seq BIGINT"
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], kinds)


def test_bad_last_duplicate_removes_its_day(spark):
    table = raw(spark, S.NAV_HISTORY, [
        ("7", "2024-01-01", "9.5"), ("7", "2024-01-02", "10.0"), ("7", "2024-01-02", "0.0"), ("7", "2024-01-04", "11"), ("7", "soon", "1")])
    rows = sorted((r.date.isoformat(), r.nav) for r in cleaning.clean("nav_history", table).collect())
    assert rows == [("2024-01-01", 9.5), ("2024-01-02", 9.5), ("2024-01-03", 9.5), ("2024-01-04", 11.0)]


def test_bad_fund_code_fails_the_nav_run(spark):
    with pytest.raises(Exception, match="not a whole number"):
        cleaning.clean("nav_history", raw(spark, S.NAV_HISTORY, [("x7", "2024-01-01", "9.5")])).collect()


def _fund(code="1", expense="1.0", plan="Regular", sip="100", name="A"):
    return (code, " House ", name, "Equity", "Large Cap", plan, "2010-01-01", "NIFTY 100 TRI", expense, "1", sip, "5000.9", "M", "High", "EQ")


def test_fund_master_rules_and_types(spark):
    table = raw(spark, S.FUND_MASTER, [
        _fund(name="old"), _fund(name="new"), _fund("2", expense="2.51"), _fund("3", plan=" Direct "), _fund("4", plan="Growth"),
        _fund("abc"), _fund("5", sip="0"), _fund("6.0", expense="2.5")])
    rows = {r.amfi_code: r for r in cleaning.clean("fund_master", table).collect()}
    assert set(rows) == {1, 3, 6}
    assert rows[1].scheme_name == "new" and rows[1].fund_house == "House" and rows[1].min_lumpsum_amount == 5000
    assert rows[3].plan == "Direct"
    dropped = {r.rule: r.dropped for r in cleaning.reject_counts("fund_master", table).collect()}
    assert dropped == {
        "amfi_code missing": 1, "launch_date invalid": 0, "expense_ratio_pct invalid": 1, "minimum amount invalid": 1, "plan invalid": 1}


def _txn(kind="sip", amount="12.7", date="2024-01-01", kyc="Verified"):
    return ("I1", date, "5", kind, amount, "S", "C", "T30", "18-25", "F", "3.5", "UPI", kyc)


def test_transactions(spark):
    table = raw(spark, S.INVESTOR_TRANSACTIONS, [
        _txn(), _txn(), _txn("lump-sum", " 12 "), _txn("Sip"), _txn(amount="abc"), _txn(amount="NaN"), _txn(amount=None),
        _txn(date="01/02/2024"), _txn(kyc="VERIFIED"), _txn("Redemption", "3", kyc=" pending ")])
    rows = cleaning.clean("investor_transactions", table).collect()
    assert sorted((r.transaction_type, r.amount_inr, r.kyc_status) for r in rows) == [
        ("Lumpsum", 12, "Verified"), ("Redemption", 3, "Pending"), ("SIP", 12, "Verified")]
    dropped = {r.rule: r.dropped for r in cleaning.reject_counts("investor_transactions", table).collect()}
    assert dropped == {"transaction_type invalid": 1, "amount_inr invalid": 3, "transaction_date invalid": 1, "kyc_status invalid": 1}


def _performance(code="1", expense="1.0", sharpe="1.1", rating="4"):
    return (code, "A", "H", "Large Cap", "Regular", "10", "12", "11", "9", "1", "1", sharpe, "2", "12", "-10", "500.9", expense, rating, "High")


def test_performance_flags_and_expense_check(spark):
    good = raw(spark, S.SCHEME_PERFORMANCE, [_performance(), _performance("2", sharpe="x"), _performance("3", sharpe="12.00000001")])
    rows = {r.amfi_code: r for r in cleaning.clean("scheme_performance", good).collect()}
    assert set(rows) == {1, 3} and rows[1].aum_crore == 500 and rows[1].anomaly_flag == ""
    assert rows[3].anomaly_flag == "high_sharpe_ratio;sharpe_matches_return_3yr"
    with pytest.raises(Exception, match="out of range"):
        cleaning.clean("scheme_performance", raw(spark, S.SCHEME_PERFORMANCE, [_performance(expense="2.6")])).collect()


def test_negative_flows_are_kept(spark):
    table = raw(spark, S.CATEGORY_INFLOWS, [("2024-01", "Debt ", "-5"), ("2024-01", "Debt", "-7"), ("2024-02", "Debt", "x")])
    assert [(r.category, r.net_inflow_crore) for r in cleaning.clean("category_inflows", table).collect()] == [("Debt", -7.0)]


def test_first_year_growth_stays_missing(spark):
    table = raw(spark, S.MONTHLY_SIP_INFLOWS, [("2022-01", "11517", "4.9", "11", "5.1", None), ("2022-02", "0", "4.9", "11", "5.1", "2")])
    rows = cleaning.clean("monthly_sip_inflows", table).collect()
    assert len(rows) == 1 and rows[0].yoy_growth_pct is None and rows[0].sip_inflow_crore == 11517


def test_planning_wide_rules_is_fast(spark):
    """Thirteen parsed columns in one filter must not blow the optimizer up."""
    import time
    table = raw(spark, S.SCHEME_PERFORMANCE, [_performance()])
    started = time.time()
    cleaning.clean("scheme_performance", table)._jdf.queryExecution().executedPlan()
    assert time.time() - started < 20


def test_runner_writes_sorted_text_and_counts(spark, tmp_path):
    source, target = f"file:{tmp_path}/raw", f"file:{tmp_path}/clean"
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "04_monthly_sip_inflows.csv").write_text(
        "month,sip_inflow_crore,active_sip_accounts_crore,new_sip_accounts_lakh,sip_aum_lakh_crore,yoy_growth_pct\n"
        "2022-02,20,1,1,1,NA\n2022-01,10,1,1,1,\n2022-02,21,1,1,1,5.5\nbad,1,1,1,1,1\n")
    report = cleaning.run_one(spark, "monthly_sip_inflows", source, target).first()
    assert (report.raw_rows, report.clean_rows) == (4, 2)
    back = files.read_csv(spark, f"{target}/04_monthly_sip_inflows.csv", S.MONTHLY_SIP_INFLOWS)
    assert [(r.month, r.sip_inflow_crore, r.yoy_growth_pct) for r in back.orderBy("ingest_seq").collect()] == [("2022-01", "10", None), ("2022-02", "21", "5.5")]
