"""Sources, cleaning, demand and customer tables on small hand-made inputs."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import cleaning, customers, demand
from tallyfold.schemas import available_columns, require_columns
from tallyfold.sources import files

SALES = "datetime timestamp_ntz, cash_type string, card string, money double, coffee_name string"
TEXT = "datetime string, cash_type string, card string, money string, coffee_name string"


def sales(spark, rows):
    """Rows of (time, card, money, product)."""
    full = [(pd.Timestamp(t).to_pydatetime(), "card" if c else "cash", c, m, p) for t, c, m, p in rows]
    return spark.createDataFrame(full, SALES)


NAN = float("nan")


def test_nan_money_counts_as_missing(spark):
    good = [("2024-01-01 08:00", "A", 3.5, "Latte"), ("2024-01-02 08:00", "B", 3.6, "Latte"), ("2024-01-03 08:00", "C", 3.7, "Latte")]
    df = sales(spark, [*good, ("2024-01-04 08:00", "D", NAN, "Latte")])
    assert {r.money for r in cleaning.preprocess(df).collect()} == {3.5, 3.6, 3.7}
    assert {r.card for r in cleaning.remove_invalid_rows(df).collect()} == {"A", "B", "C"}
    broken = {r.rule: r.n_bad for r in cleaning.schema_violations(df).collect()}
    assert broken["money_not_null"] == 1 and broken["money_positive"] == 0
    assert cleaning.iqr_bounds(df).first().upper < 4.0


# -- sources ---------------------------------------------------------------------


def test_csv_without_card_column_gets_null_cards(spark, tmp_path):
    (tmp_path / "b.csv").write_text("datetime,cash_type,money,coffee_name\n2024-03-01 10:15:50,cash,40.0,Latte\n")
    row = files.scan_csv(spark, str(tmp_path / "b.csv")).first()
    assert row["card"] is None and row["money"] == "40.0"


def test_merge_skips_a_missing_source_and_fails_on_none(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,datetime,cash_type,card,money,coffee_name\nd,2024-03-01 10:15:50.520,card,A1,38.7,Latte\n")
    (tmp_path / "b.csv").write_text("datetime,cash_type,money,coffee_name\n2024-03-01 10:15:50,cash,40.0,Cocoa\n")
    a, b, none = (str(tmp_path / n) for n in ("a.csv", "b.csv", "none.csv"))
    merged = files.scan_merge_sources(spark, [a, b])
    assert merged.count() == 2 and set(merged.columns) == {"date", "datetime", "cash_type", "card", "money", "coffee_name"}
    assert files.scan_merge_sources(spark, [none, b]).count() == 1
    with pytest.raises(FileNotFoundError):
        files.scan_merge_sources(spark, [none])
    with pytest.raises(FileNotFoundError):
        files.scan_csv(spark, none)


def test_csv_folder_with_different_headers(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.csv").write_text("datetime,cash_type,card,money,coffee_name\n2024-03-01 10:15:50,card,A1,38.7,Latte\n")
    (folder / "b.csv").write_text("datetime,cash_type,money,coffee_name\n2024-03-02 10:15:50,cash,40.0,Cocoa\n")
    (folder / "c.csv").write_text("")
    got = sorted((r.card or "", r.money, r.coffee_name) for r in files.scan_csv(spark, str(folder)).collect())
    assert got == [("", "40.0", "Cocoa"), ("A1", "38.7", "Latte")]


def test_half_written_table_is_built_again(spark, tmp_path):
    path = tmp_path / "table"
    (path / "_temporary" / "0").mkdir(parents=True)
    assert files.path_exists(spark, str(path)) and not files.is_complete(spark, str(path))
    assert files.reuse_or_build(spark, str(path), lambda: spark.range(4)).count() == 4
    assert files.is_complete(spark, str(path))
    assert not files.path_exists(spark, str(tmp_path / "none"))


def test_csv_keeps_microseconds(spark, tmp_path):
    stamp = dt.datetime(2024, 3, 1, 10, 15, 50, 520001)
    df = spark.createDataFrame([(stamp, "card", "A", 1.5, 'A "b", c')], SALES)
    back = cleaning.coerce_types(files.scan_csv(spark, files.sink_csv(df, str(tmp_path / "out")))).first()
    assert back["datetime"] == stamp and back["coffee_name"] == 'A "b", c'


def test_reuse_or_build_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "t")
    assert files.reuse_or_build(spark, path, build).count() == 3
    assert files.reuse_or_build(spark, path, build).count() == 3
    assert len(calls) == 1


# -- validation and cleaning -------------------------------------------------------


def test_validation_lists_every_broken_rule(spark):
    df = spark.createDataFrame(
        [("2024-01-01 10:00:00", "card", "A", "3.5", "Latte"), ("junk", "voucher", None, "-1", None)], TEXT
    )
    found = {r.rule: r.n_bad for r in cleaning.schema_violations(df).collect()}
    assert found == {"datetime_not_null": 1, "cash_type_not_null": 0, "cash_type_known": 1,
                     "money_not_null": 0, "money_positive": 1, "coffee_name_not_null": 1}
    with pytest.raises(cleaning.SchemaViolation, match="money_positive: 1"):
        cleaning.validate_schema(df)


def test_validation_coerces_and_passes_extra_columns(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00.5", "cash", None, "3.5", "Latte", 7)], TEXT + ", extra int")
    row = cleaning.validate_schema(df).first()
    assert row["datetime"] == dt.datetime(2024, 1, 1, 10, 0, 0, 500000)
    assert (row["money"], row["card"], row["extra"]) == (3.5, None, 7)


def test_required_columns(spark):
    df = spark.range(1)
    assert require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="revenue"):
        require_columns(df, ["id", "revenue"])
    assert available_columns(df, ["x", "id"]) == ["id"]


def test_day_parts_of_all_hours(spark):
    starts = {"night": 0, "morning": 6, "afternoon": 12, "evening": 18}
    df = sales(spark, [(f"2024-01-06 {hour:02d}:30", "A", 1.0, "Latte") for hour in range(24)])
    for row in cleaning.temporal_features(df).collect():
        part = max((s, name) for name, s in starts.items() if s <= row.hour)[1] if row.hour < 21 else "night"
        assert (row.time_of_day_bucket, row.day_of_week, row.is_weekend, row.week_of_year) == (part, 5, True, 1)


def test_iqr_drops_the_outlier_on_either_side(spark):
    money = [3.0 + 0.5 * i for i in range(10)] + [1000.0, -500.0]
    df = sales(spark, [("2024-01-01", "A", m, "Latte") for m in money])
    kept = {r.money for r in cleaning.iqr_outlier_filter(df).collect()}
    assert kept == set(money[:10])


def test_preprocess_order_and_anonymous(spark):
    df = spark.createDataFrame(
        [("2024-01-01 07:30:00", "cash", None, 3.5, "Latte"), ("bad", "card", "A", 4.0, "Latte"),
         ("2024-01-02 13:00:00", "card", "B", 0.0, "Latte"), ("2024-01-03 18:45:00", "card", "C", 5.0, None)],
        "datetime string, cash_type string, card string, money double, coffee_name string")
    rows = cleaning.preprocess(df).collect()
    assert [(r.card, r.time_of_day_bucket) for r in rows] == [("anonymous", "morning")]


# -- demand ----------------------------------------------------------------------


def gap_sales(spark):
    rows = [("2024-01-01 09:00", "A", 2.0, "Latte"), ("2024-01-01 10:00", "A", 3.0, "Latte"),
            ("2024-01-04 09:00", None, 4.0, "Latte"), ("2024-01-02 09:00", "B", 7.0, "Cocoa"),
            ("2024-01-09 09:00", "B", 7.0, "Tea"), ("2024-01-03 09:00", "B", 9.0, None)]
    return sales(spark, rows)


def test_dense_calendar_is_zero_filled(spark):
    out = demand.daily_demand(gap_sales(spark)).orderBy("product", "date").collect()
    assert [(r.product, r.date.day, r.revenue, r.n_transactions) for r in out] == [
        ("Cocoa", 1, 0, 0), ("Cocoa", 2, 7, 1), ("Cocoa", 3, 0, 0), ("Cocoa", 4, 0, 0),
        ("Latte", 1, 5, 2), ("Latte", 2, 0, 0), ("Latte", 3, 0, 0), ("Latte", 4, 4, 1)]


def test_own_range_calendar(spark):
    daily = demand.daily_sales(gap_sales(spark))
    out = demand.own_range_calendar(daily).groupBy("product").count().collect()
    assert {r["product"]: r["count"] for r in out} == {"Cocoa": 1, "Latte": 4, "Tea": 1}


def test_demand_features_match_pandas(spark):
    rng = np.random.default_rng(0)
    rows = [(f"2024-01-{d:02d} {rng.integers(8, 20):02d}:00", "A", float(rng.integers(1, 50)), p)
            for p in ("Latte", "Cocoa") for d in range(1, 31) for _ in range(rng.integers(0, 4))]
    got = demand.demand_features(sales(spark, rows)).toPandas().sort_values(["product", "date"])
    for _, g in got.groupby("product"):
        y = g["revenue"]
        for k in (1, 7, 14):
            assert np.allclose(g[f"lag_{k}"], y.shift(k).fillna(0))
        for w in (7, 14):
            assert np.allclose(g[f"rolling_mean_{w}"], y.shift(1).rolling(w, min_periods=1).mean().fillna(0))
    days = pd.to_datetime(got["date"])
    assert (got["day_of_week"] == days.dt.dayofweek).all() and (got["month"] == days.dt.month).all()
    assert np.isclose(got["revenue"].sum(), sum(r[2] for r in rows))


def test_halves_follow_product_then_date(spark):
    out = demand.halves(demand.demand_features(gap_sales(spark)))
    sides = {r["product"]: r.side for r in out.select("product", "side").distinct().collect()}
    assert sides == {"Cocoa": "reference", "Latte": "current"}
    by_time = demand.halves(demand.demand_features(gap_sales(spark)), "time")
    assert {(r.date.day, r.side) for r in by_time.collect()} == {(1, "reference"), (2, "reference"), (3, "current"), (4, "current")}


def test_strict_moving_average_waits_for_seven_rows(spark):
    days = [(dt.date(2024, 1, d), "Latte", float(d)) for d in range(1, 9)]
    df = spark.createDataFrame(days, "date date, product string, revenue double")
    out = [r.ma7 for r in demand.moving_average(df, "revenue", strict=True).orderBy("date").collect()]
    assert out == [None] * 6 + [4.0, 5.0]


# -- customers -----------------------------------------------------------------------


def rfm_sales(spark):
    rows = [("2024-03-29", "A", 10.0, "Latte")] * 4 + [("2024-01-10", "A", 10.0, "Latte")]
    rows += [("2024-03-01", "B", 20.0, "Cocoa"), ("2024-02-01", "B", 10.0, "Cocoa"), ("2024-03-31", "C", 100.0, "Latte")]
    rows += [("2024-03-30", None, 5.0, "Latte"), ("2024-04-30", "anonymous", 5.0, "Latte")]
    return sales(spark, rows)


def test_rfm_values(spark):
    got = {r.card: r for r in customers.rfm_features(rfm_sales(spark)).collect()}
    assert {c: (r.recency_days, r.frequency, r.monetary) for c, r in got.items()} == {
        "A": (2, 5, 50.0), "B": (30, 2, 30.0), "C": (0, 1, 100.0)}
    assert (got["C"].recency_norm, got["B"].recency_norm) == (1.0, 0.0)
    assert (got["A"].frequency_norm, got["C"].frequency_norm) == (1.0, 0.0)


def test_single_customer_is_in_the_middle(spark):
    row = customers.rfm_features(sales(spark, [("2024-01-01", "A", 5.0, "Latte")])).first()
    assert (row.recency_norm, row.frequency_norm, row.monetary_norm) == (0.5, 0.5, 0.5)


def test_purchase_later_on_the_reference_day_is_minus_one(spark):
    df = sales(spark, [("2024-01-10 10:00", "A", 5.0, "Latte"), ("2024-01-09 10:00", "B", 5.0, "Latte"), ("2024-01-09", "C", 1.0, "Tea")])
    assert {r.card: r.recency_days for r in customers.rfm_features(df).collect()} == {"A": -1, "B": 0, "C": 1}
    assert {r.card: r.recency_days for r in customers.rfm_features(df, clamp_zero=True).collect()} == {"A": 0, "B": 0, "C": 1}


def test_quintiles_follow_the_closed_form(spark):
    rows = [(f"c{i}", 5, 3, 10.0) for i in range(7)]  # all tied: the key decides
    df = spark.createDataFrame(rows, "card string, recency_days bigint, frequency bigint, monetary double")
    got = {r.card: (r.r_quintile, r.f_quintile, r.m_quintile) for r in customers.rfm_quintiles(df).collect()}
    expected = [1, 1, 2, 3, 4, 5, 5]
    assert got == {f"c{i}": (q, q, q) for i, q in enumerate(expected)}


@pytest.mark.parametrize("n", [1, 2, 6, 23, 60])
def test_quintiles_match_pandas(spark, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"card": [f"c{i:03d}" for i in range(n)], "recency_days": rng.integers(0, 30, n),
                        "frequency": rng.integers(1, 5, n), "monetary": rng.integers(1, 99, n) * 1.0})
    got = customers.rfm_quintiles(spark.createDataFrame(pdf)).toPandas().sort_values("card")
    if n == 1:
        assert got[["r_quintile", "f_quintile", "m_quintile"]].iloc[0].tolist() == [1, 1, 1]
        return
    for q, c, up in (("r_quintile", "recency_days", False), ("f_quintile", "frequency", True), ("m_quintile", "monetary", True)):
        want = pd.qcut(pdf[c].rank(method="first", ascending=up), 5, labels=[1, 2, 3, 4, 5]).astype(int)
        assert got[q].tolist() == want.tolist()


def churn_inputs(spark, last_days_ago, window):
    ref = pd.Timestamp("2024-06-30")
    rows = [(ref, "REF", 10.0, "Latte"), (ref - pd.Timedelta(days=last_days_ago), "X", 8.0, "Cocoa"),
            (ref - pd.Timedelta(days=last_days_ago + window), "X", 6.0, "Latte"), (ref, None, 1.0, "Tea"),
            (ref - pd.Timedelta(days=1), "OTHER", 1.0, "Tea")]
    df = sales(spark, rows)
    rfm = customers.rfm_features(df)
    segments = rfm.where("card <> 'OTHER'").select("card", F.lit(0).alias("cluster_id"), F.lit("Loyal").alias("segment_name"))
    out = customers.churn_features(df, rfm, segments, window).collect()
    return {r.card: r for r in out}


@pytest.mark.parametrize("days, churn", [(90, 0), (91, 1), (5, 0)])
def test_churn_boundary(spark, days, churn):
    got = churn_inputs(spark, days, 90)
    assert set(got) == {"REF", "X"}
    x = got["X"]
    assert (x.churn, x.n_distinct_products, x.days_since_first_purchase) == (churn, 2, days + 90)
    recent = days <= 28
    assert (x.freq_last_4w, x.freq_last_8w, x.avg_ticket_recent) == ((1, 1, 8.0) if recent else (0, 0, 0.0))


def test_empty_input_keeps_the_schema(spark):
    empty = spark.createDataFrame([], SALES)
    assert customers.rfm_features(empty).collect() == []
    out = demand.demand_features(empty)
    assert out.columns == demand.DEMAND_COLUMNS and out.collect() == []
    assert cleaning.preprocess(empty).collect() == []


PURCHASES = [
    ("2024-06-30 09:00", "A", 5.0, "Latte"), ("2024-06-30 09:00", "A", 5.0, "Latte"), ("2024-05-20", "A", None, None),
    ("2024-01-02", "A", 3.0, "Cocoa"), ("2024-03-01", "B", 2.0, "Tea"), (None, "B", 9.0, "Latte"), (None, "C", 9.0, "Latte"),
    ("2024-07-09", None, 1.0, "Tea"), ("2024-06-10", "D", None, "Tea"), ("2024-05-04", "D", 4.0, "Tea"),
]


@pytest.mark.parametrize("latest, passes", [("2024-06-30 23:00", 1), ("2024-07-09 00:00", 2), (None, 2)])
def test_customer_tables_from_one_pass_over_sales(spark, monkeypatch, latest, passes):
    """A wrong guess of the last day costs a pass, never a result."""
    labels, keep = [], customers.materialise
    monkeypatch.setattr(customers, "materialise", lambda df, label="table": labels.append(label) or keep(df, label))
    known = sales(spark, [r for r in PURCHASES if r[0]])
    df = known.union(spark.createDataFrame([(None, "card", *r[1:]) for r in PURCHASES if not r[0]], SALES))
    bought = customers.stored_purchases(df, F.lit(latest).cast("timestamp_ntz"))
    assert labels == ["purchases"] * passes
    for made, wanted in ((customers.rfm_of_purchases(bought), customers.rfm_features(df)),
                         (customers.behaviour_of_purchases(bought), customers.behaviour(df))):
        assert made.schema.simpleString() == wanted.schema.simpleString()
        assert sorted(made.collect()) == sorted(wanted.collect())
    assert {r.card for r in customers.rfm_of_purchases(bought).collect()} == {"A", "B", "D"}


def test_purchases_of_no_sales(spark):
    bought = customers.stored_purchases(spark.createDataFrame([], SALES), F.lit("2024-06-30").cast("timestamp_ntz"))
    assert customers.rfm_of_purchases(bought).collect() == [] == customers.behaviour_of_purchases(bought).collect()


def test_the_churn_table_does_not_store_sales(spark, monkeypatch):
    from tallyfold.plans import inputs

    labels, keep = [], inputs.materialise
    for module in (inputs, customers):
        monkeypatch.setattr(module, "materialise", lambda df, label="table": labels.append(label) or keep(df, label))
    table = inputs.churn_table(spark, "/root/testdata/sf0.001")
    assert "sales" not in labels and labels.count("purchases") == 1 and table.count() > 0
