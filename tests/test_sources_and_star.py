import pytest

from fundlake.operators import aggregates
from fundlake.plans import explore, quality, reporting, warehouse
from fundlake.session import scratch_path
from fundlake.sources import files


def test_csv_reader_keeps_file_order(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text("k , v\n1,NA\n2,x\n")
    (folder / "b.csv").write_text("k , v\n1,last\n")
    rows = files.read_csv(spark, f"file:{folder}").orderBy("ingest_seq").collect()
    assert [(r.k, r.v) for r in rows] == [("1", None), ("2", "x"), ("1", "last")]


def test_folder_problems(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="not found"):
        files.list_csv_files(spark, f"file:{tmp_path}/nowhere")
    with pytest.raises(FileNotFoundError, match="No CSV"):
        files.list_csv_files(spark, f"file:{tmp_path}")


def test_unreadable_files_are_recorded(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a,b\n1,x\n1,x\n2.5,\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "ragged.csv").write_text("a,b\n1,2\n1,2,3,4\n")
    report = quality.profile_folder(spark, f"file:{tmp_path}")
    rows = {(r.file, r.column): r for r in report.collect()}
    assert rows[("good.csv", "a")].dtype == "float64" and rows[("good.csv", "a")].duplicates == 1
    assert rows[("good.csv", "b")].nulls == 1 and rows[("good.csv", "b")].note == "duplicate rows; missing values"
    assert rows[("empty.csv", None)].error and rows[("ragged.csv", None)].error
    counts = quality.inventory(report).first()
    assert (counts.files_found, counts.files_loaded) == (3, 1)


def test_payloads(spark, tmp_path, day):
    (tmp_path / "one.json").write_text('{"meta": {"scheme_code": 119551, "scheme_name": "S"},\n "data": [{"date": "29-05-2026", "nav": "101.5"}, {"date": "x", "nav": "y"}]}')
    (tmp_path / "none.json").write_text('{"meta": {"scheme_code": 5}}')
    rows = files.read_payloads(spark, f"file:{tmp_path}").collect()
    assert {(r.scheme_code, r.date, r.nav) for r in rows} == {(119551, day("2026-05-29"), 101.5), (119551, None, None)}
    documents = spark.read.text(f"file:{tmp_path}", wholetext=True).withColumnRenamed("value", "body")
    assert {(r.scheme_code, r.status) for r in files.payload_status(documents).collect()} == {(119551, "ok"), (5, "No NAV data")}
    assert [r.scheme_name for r in files.tag_schemes(files.payload_rows(documents), {"SBI_Bluechip": 119551}).collect()] == ["SBI_Bluechip"] * 2


FUND = ("amfi_code BIGINT, fund_house STRING, scheme_name STRING, category STRING, sub_category STRING, plan STRING, launch_date DATE, "
        "benchmark STRING, expense_ratio_pct DOUBLE, exit_load_pct DOUBLE, min_sip_amount BIGINT, min_lumpsum_amount BIGINT, "
        "fund_manager STRING, risk_category STRING, sebi_category_code STRING")
TXN = ("investor_id STRING, transaction_date DATE, amfi_code BIGINT, transaction_type STRING, amount_inr BIGINT, state STRING, city STRING, "
       "city_tier STRING, age_group STRING, gender STRING, annual_income_lakh DOUBLE, payment_mode STRING, kyc_status STRING")
PERF = ("amfi_code BIGINT, scheme_name STRING, fund_house STRING, category STRING, plan STRING, return_1yr_pct DOUBLE, return_3yr_pct DOUBLE, "
        "return_5yr_pct DOUBLE, benchmark_3yr_pct DOUBLE, alpha DOUBLE, beta DOUBLE, sharpe_ratio DOUBLE, sortino_ratio DOUBLE, std_dev_ann_pct DOUBLE, "
        "max_drawdown_pct DOUBLE, aum_crore BIGINT, expense_ratio_pct DOUBLE, morningstar_rating BIGINT, risk_grade STRING, anomaly_flag STRING")


@pytest.fixture(scope="module")
def parts(spark, day):
    def fund(code, sub):
        return (code, "H", f"F{code}", "Equity", sub, "Direct", day("2023-02-28"), "NIFTY 50 TRI", 1.0, 0.0, 1, 1, "M", "High", "S")

    def txn(code, date, kind, amount):
        return ("I", day(date), code, kind, amount, "S", "C", "T30", "18-25", "M", 1.0, "UPI", "Verified")

    def perf(code, sharpe):
        return (code, "x", "x", "x", "x", 1.0, 5.0, 1.0, 2.0, 1.0, 1.0, sharpe, 1.0, 1.0, -1.0, 10, 0.9, 3, "High", "")

    funds = spark.createDataFrame([fund(20, "Large"), fund(10, "Large"), fund(30, "Mid")], FUND)
    nav = spark.createDataFrame([(10, day("2024-02-29"), 5.0), (20, day("2024-03-02"), 6.0)], "amfi_code BIGINT, date DATE, nav DOUBLE")
    aum = spark.createDataFrame([(day("2024-03-31"), "H", 1.0, 60, 2), (day("2024-03-31"), "G", 1.0, 40, 2), (day("2023-12-31"), "Z", 1.0, 99, 2)],
                                "date DATE, fund_house STRING, aum_lakh_crore DOUBLE, aum_crore BIGINT, num_schemes BIGINT")
    perf_table = spark.createDataFrame([perf(10, 1.5), perf(20, 1.5), perf(30, 0.2)], PERF)
    txns = spark.createDataFrame([
        txn(10, "2023-02-10", "SIP", 100), txn(10, "2024-02-10", "SIP", 150), txn(10, "2024-03-10", "SIP", 10),
        txn(20, "2024-03-11", "Redemption", 400), txn(20, "2024-04-11", "Lumpsum", 40)], TXN)
    return funds, nav, aum, perf_table, txns


@pytest.fixture(scope="module")
def star(spark, parts):
    funds, nav, aum, perf, txns = parts
    return warehouse.build(spark, scratch_path(spark, "star"), funds, nav, aum, perf, txns)


def test_dimensions(star):
    assert [(r.fund_key, r.amfi_code) for r in star["dim_fund"].orderBy("fund_key").collect()] == [(1, 10), (2, 20), (3, 30)]
    days = {r.date_key: r for r in star["dim_date"].collect()}
    assert days[20230228].is_month_end == 1 and days[20240229].is_month_end == 1
    assert days[20240302].is_weekend == 1 and days[20240302].day_name == "Saturday" and days[20240302].day_of_week == 5


def test_star_is_consistent(star, parts, spark):
    funds, nav, aum, perf, txns = parts
    assert warehouse.check_constraints(star).where("violations > 0").count() == 0
    assert star["fact_transactions"].select("transaction_key").distinct().count() == 5
    assert [r.anomaly_flag for r in star["fact_performance"].collect()] == [None] * 3
    sources = {"dim_fund": funds, "fact_nav": nav, "fact_aum": aum, "fact_performance": perf, "fact_transactions": txns}
    warehouse.verify_row_counts(sources, star)
    with pytest.raises(RuntimeError, match="fact_nav"):
        warehouse.verify_row_counts(sources | {"fact_nav": nav.union(nav)}, star)


def test_reports(star):
    growth = {(r.year, r.month): r for r in reporting.sip_growth(star).collect()}
    assert growth[(2024, 2)].yoy_sip_amount_pct == 50.0 and growth[(2024, 3)].yoy_sip_amount_pct is None
    flow = [(r.year, r.month, r.net_flow, r.mom_net_flow_change_pct) for r in reporting.net_flow(star).collect()]
    assert flow == [(2023, 2, 100, None), (2024, 2, 150, 50.0), (2024, 3, -390, -360.0), (2024, 4, 40, -110.26)]
    assert [r.scheme_name for r in reporting.sharpe_leaders(star).orderBy("scheme_name").collect()] == ["F10", "F20", "F30"]
    market = reporting.concentration(star).first()
    assert (market.hhi_index, market.largest_fund_house_share_pct) == (5200.0, 60.0)
    assert reporting.low_cost_funds(star).count() == 3


def test_finding_sentences(spark):
    rows = [(6, "m", None, 12.86, 13.26, 26.12), (3, "m", "Liquid", 451275.0, None, None), (2, "m", None, 169.24, 11517.0, 31002.0)]
    report = spark.createDataFrame(rows, "finding_no INT, metric STRING, subject STRING, value DOUBLE, from_value DOUBLE, to_value DOUBLE")
    lines = [r.value for r in explore.finding_sentences(report).collect()]
    assert lines == ["2. Monthly SIP inflows grew 169.2% over the data, from Rs. 11,517 crore to Rs. 31,002 crore.",
                     "3. Liquid recorded the highest cumulative net inflow at Rs. 451,275 crore.",
                     "6. Industry folios increased by 12.86 crore, from 13.26 crore to 26.12 crore."]
    assert [r.value for r in explore.finding_sentences(report, "Findings").collect()] == ["# Findings", "", *lines]


def test_value_counts_come_in_order(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccc"] + [(None,)], "v STRING")
    assert [tuple(r) for r in aggregates.value_counts(df, "v").collect()] == [("c", 3), ("a", 2), ("b", 2)]


def test_year_grid_fails_on_unlisted_years_and_repeats(spark, day):
    rows = [(day("2023-12-31"), "A", 2.0), (day("2024-06-30"), "A", 3.0), (day("2024-06-30"), "B", 1.0)]
    aum = spark.createDataFrame(rows, "date DATE, fund_house STRING, aum_lakh_crore DOUBLE")
    assert [tuple(r) for r in explore.aum_grid(aum, [2023, 2024]).collect()] == [("A", 2.0, 3.0), ("B", 0.0, 1.0)]
    with pytest.raises(Exception, match="pivot key not listed"):
        explore.aum_grid(aum, [2024]).collect()
    months = spark.createDataFrame([(day("2024-01-01"), "Liquid", 1.0)] * 2, "month DATE, category STRING, net_inflow_crore DOUBLE")
    with pytest.raises(Exception, match="duplicate entry in pivot"):
        explore.category_matrix(months).collect()


def test_reports_are_sorted(star):
    """The order that the hash of rows does not see."""
    flows = [(r.year, r.month) for r in reporting.net_flow(star).collect()]
    assert flows == sorted(flows)
    states = [(-r.total_amount_inr, -r.transaction_count) for r in reporting.transactions_by_state(star).collect()]
    assert states == sorted(states)
    costs = [(r.expense_ratio_pct, -r.return_3yr_pct) for r in reporting.low_cost_funds(star).collect()]
    assert costs == sorted(costs)
    tiers = [(r.city_tier, -r.total_amount_inr) for r in reporting.city_tier_behaviour(star).collect()]
    assert tiers == sorted(tiers)
    largest = [-r.aum_crore for r in reporting.largest_funds(star).collect()]
    assert largest == sorted(largest)


def test_age_groups_keep_fixed_order(spark):
    df = spark.createDataFrame([("56+",), ("18-25",), ("56+",), ("unknown",)], "age_group STRING")
    assert [(r.age_group, r.n) for r in explore.age_group_counts(df).collect()] == [("18-25", 1), ("56+", 2)]


def test_boxes_trim_before_quantiles(spark):
    rows = [("SIP", "18-25", i) for i in range(1, 101)] + [("SIP", "26-35", 100000)]
    df = spark.createDataFrame(rows, "transaction_type STRING, age_group STRING, amount_inr BIGINT")
    boxes = {r.age_group: r for r in explore.sip_amount_boxes(df).collect()}
    assert set(boxes) == {"18-25"} and boxes["18-25"].median == 50.5
