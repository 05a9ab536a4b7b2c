import pytest
from pyspark.sql import functions as F

from fundlake import schemas as S
from fundlake.functions import calendar as cal
from fundlake.functions import coerce, rules


def one_column(spark, values, kind="STRING"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")


def results(df, expression):
    return [row.y for row in df.select("i", expression.alias("y")).orderBy("i").collect()]


def test_lenient_numbers(spark):
    df = one_column(spark, ["12.7", " 12 ", "abc", "NaN", "", "12d", "1e3", "-.5", "\t7\n", None, "1,000", "0x1F"])
    assert results(df, coerce.lenient_double("x")) == [12.7, 12.0, None, None, None, None, 1000.0, -0.5, 7.0, None, None, None]
    assert results(df, coerce.lenient_long("x")) == [12, 12, None, None, None, None, 1000, 0, 7, None, None, None]


def test_whole_numbers_stay_exact(spark):
    df = one_column(spark, ["9007199254740993", "-9007199254740993"])
    assert results(df, coerce.lenient_long("x")) == [9007199254740993, -9007199254740993]


@pytest.mark.parametrize("bad", ["abc", None])
def test_strict_whole_number_fails_the_query(spark, bad):
    df = one_column(spark, ["1", bad])
    with pytest.raises(Exception, match="not a whole number"):
        results(df, coerce.strict_long("x"))


def test_dates_and_months(spark, day):
    df = one_column(spark, ["2024-02-29", "2023-02-29", "01-02-2024", "2024-2-1", "2024", None])
    assert results(df, coerce.iso_date("x")) == [day("2024-02-29"), None, None, None, None, None]
    months = one_column(spark, ["2024-02", "2024-13", "Feb 2024", "2024-02-01"])
    assert results(months, coerce.month_start("x")) == [day("2024-02-01"), None, None, None]


def test_strip_handles_all_white_space(spark):
    df = one_column(spark, ["\t a b  \n", "x"])
    assert results(df, coerce.strip("x")) == ["a b", "x"]


def test_missing_tokens(spark):
    df = one_column(spark, ["NA", "null", "", "n/a", "nil", "0"])
    assert [r.x for r in coerce.nulls_for_tokens(df).orderBy("i").collect()] == [None, None, None, None, "nil", "0"]


def test_transaction_spellings(spark):
    df = one_column(spark, ["Sip", "LUMPSUM", "lump-sum", " sip ", None])
    assert results(df, coerce.standardise("x", S.TRANSACTION_SPELLINGS)) == [None, None, "Lumpsum", "SIP", None]


def test_year_offset_clamps_leap_day(spark, day):
    df = one_column(spark, [day("2024-02-29"), day("2025-02-28")], "DATE")
    assert results(df, cal.years_before(F.col("x"), 1)) == [day("2023-02-28"), day("2024-02-28")]


def test_benchmark_rules_keep_the_first_hit(spark):
    df = one_column(spark, ["NIFTY 500 TRI", "NIFTY Midcap 50 TRI", "X", None])
    assert results(df, rules.benchmark_key(F.col("x"))) == ["NIFTY50", "NIFTY_MIDCAP150", "NIFTY100", "NIFTY100"]
    assert results(df, rules.benchmark_key(F.col("x"), strict=True))[0] == "NIFTY500"


def test_expense_range_is_inclusive(spark):
    df = one_column(spark, [0.1, 2.5, 0.09, 2.51], "DOUBLE")
    assert results(df, rules.expense_in_range(F.col("x"))) == [True, True, False, False]


def test_anomaly_flags(spark):
    columns = ["expense_ratio_pct", "sharpe_ratio", "return_3yr_pct", "sortino_ratio", "max_drawdown_pct", "return_1yr_pct", "beta", "morningstar_rating"]
    df = spark.createDataFrame(
        [(1.0, 5.14, 5.14, 8.76, -10.0, 5.0, 1.0, 4.0), (1.0, 1.0, 12.0, 2.0, -1.0, 5.0, 1.0, 5.0), (2.6, 0.0, 1.0, 1.0, 0.5, -51.0, 2.1, 0.0)],
        ", ".join(f"{c} DOUBLE" for c in columns))
    assert [r.f for r in df.select(rules.anomaly_flags().alias("f")).collect()] == [
        "high_sharpe_ratio;sharpe_matches_return_3yr;high_sortino_ratio", "",
        "expense_ratio_out_of_range;positive_max_drawdown;extreme_return_1yr;beta_out_of_range;invalid_morningstar_rating"]


def test_labels(spark):
    df = one_column(spark, ["HDFC Mid-Cap Opportunities Fund - Regular - Growth", "A very long scheme name that goes on and on"])
    assert results(df, rules.series_label(F.col("x"))) == ["HDFC Mid-Cap Opps", "A very long scheme name that go..."]
    assert results(df, rules.short_label(F.col("x")))[0] == "HDFC Mid-Cap Oppor"


def test_ratio_without_divisor_is_null(spark):
    df = one_column(spark, [0.0, None, 4.0], "DOUBLE")
    assert results(df, rules.ratio(F.lit(2.0), F.col("x"))) == [None, None, 0.5]
