import pandas as pd
from pyspark.sql import functions as F

from ratelake import fixed
from ratelake.operators import apply as A
from ratelake.operators import registry as G
from ratelake.operators.report import report_lines
from ratelake.operators.series import bad_responses, ingest_series, response_rows

DIESEL, JET = fixed.SERIES_PROGRAM


def tables(spark):
    """Two dates of one table; prices below 2.00 and from 2.00."""
    def brackets(p):
        return [("lt", "< 2", None, 1.99, p, "x"), ("plus", "2+", 2.0, None, None, "x")]
    rows = [
        ("ups", "ground", "2026-01-01", "s1", 0, "r", brackets(5.0)),
        ("UPS", "Ground", "2026-01-08", "s2", 0, "r", brackets(6.0)),
        ("UPS", "ground", "2026-01-08", "s1", 1, "r", brackets(7.0)),
        ("FedEx", "air", "2026-01-99", "s3", 0, "r", brackets(9.0)),  # no calendar day: never in force
    ]
    return spark.createDataFrame(
        rows, "carrier string, program string, effective_date string, source_id string, table_index int, run_id string, "
        "brackets array<struct<bracket_id:string,index_range:string,min_index:double,max_index:double,"
        "surcharge_percent:double,surcharge_text:string>>",
    )


def test_apply(spark):
    prices = spark.createDataFrame(
        [(DIESEL, "2025-12-31", 1.0), (DIESEL, "2026-01-01", 1.0), (DIESEL, "2026-01-05", 2.5), (DIESEL, "2026-01-08", 1.5),
         (DIESEL, "2026-01-09", 1.5), (DIESEL, "2026-01-10", 1.995), (JET, "2026-02-01", 1.0), ("OTHER", "2026-01-09", 1.0)],
        "series_id string, period string, value double",
    )
    out = A.apply_rates(prices, tables(spark)).orderBy("week_ending_date")
    got = [(r.carrier, r.week_ending_date, r.table_effective_date, r.bracket_id, float(r.applied_percent), r.percent_missing, r.reason)
           for r in out.collect()]
    assert got == [
        ("UPS", "2026-01-01", "2026-01-01", "lt", 5.0, False, "new"),
        ("UPS", "2026-01-05", "2026-01-01", "plus", 0.0, True, "fuel_tier_change"),
        ("UPS", "2026-01-08", "2026-01-08", "lt", 7.0, False, "both"),  # a tie goes to the smallest source
        ("UPS", "2026-01-09", "2026-01-08", "lt", 7.0, False, "no_change"),
    ]
    history = A.apply_rates(prices.filter("period <= '2026-01-05'"), tables(spark))
    new = A.apply_rates(prices.filter("period = '2026-01-08'"), tables(spark), history=history)
    assert [r.reason for r in new.collect()] == ["both"]
    assert A.store_applied(history, history).count() == 0
    lines = [r.line for r in report_lines(history, spark.createDataFrame(
        [], "carrier string, program string, effective_date string, source_id string, table_index int")).collect()]
    assert lines == [
        "# Weekly Carrier Pricing Events (2026-01-05)", "", "## Events", "",
        "- FSC | UPS | ground | Week: 2026-01-05 | cause: fuel_tier_change",
        "  - old_charge: 5.00% | new_charge: 0.00% | bracket: 2+ | table_eff: 2026-01-01",
        f"  - fuel: {DIESEL} $2.500", "",
    ]


def test_series(spark):
    raw = ['{"response":{"data":[{"period":2024,"value":"1.5","units":7,"series-description":"d"},{"period":"p","value":null}]}}', '{"x":1}']
    df = spark.createDataFrame([("s", r) for r in raw], "series_id string, raw string")
    rows = response_rows(df, "raw")
    assert [tuple(r) for r in rows.collect()] == [("s", "2024", 1.5, None, "d"), ("s", "p", None, None, None)]
    assert bad_responses(df, "raw").count() == 1
    stored = spark.createDataFrame([], "series_id string, period string")
    out = ingest_series(stored, rows).first()
    assert (out.series_id, out.period, str(out.value), out.units, out.description) == ("s", "2024", "1.5000", "", "d")


def test_provider_batches(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "request string")
    out = G.invoke_provider(rows, lambda pdf: pd.DataFrame({"content": "{\"r\":\"" + pdf["request"] + "\"}"}), "content string")
    parsed = G.parse_responses(out, "content")
    assert parsed.filter("error IS NULL").count() == 2
    assert sorted(r[0] for r in parsed.select(F.try_variant_get("response", "$.r", "string")).collect()) == ["a", "b"]
