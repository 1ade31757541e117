"""Unit tests for the distributed building blocks against brute force."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from estatelens.operators.common import global_rank
from estatelens.operators.ingest import change_events, previous_values
from estatelens.operators.quantiles import exact_percentiles, running_totals
from estatelens.operators.scoring import scatter_samples
from estatelens.operators.spatial import knn_join


def test_exact_percentiles_hot_group(spark):
    rng = np.random.default_rng(3)
    # one group holds most rows (skew), values heavy-tailed with ties
    g = np.where(rng.random(30000) < 0.7, 0, rng.integers(1, 20, 30000))
    v = np.round(rng.lognormal(13, 1.2, 30000), -2)
    pdf = pd.DataFrame({"g": g, "v": v})
    res = exact_percentiles(spark.createDataFrame(pdf), ["g"], "v",
                            {"p50": 0.5, "p99": 0.99, "p01": 0.01}, count_alias="n").toPandas()
    for grp, sub in pdf.groupby("g"):
        r = res[res.g == grp].iloc[0]
        exp = sub.v.quantile([0.5, 0.99, 0.01]).values
        assert np.allclose([r.p50, r.p99, r.p01], exp, rtol=0, atol=1e-6)
        assert r.n == len(sub)


def test_running_totals_matches_cumsum(spark):
    pdf = pd.DataFrame({"k": [1] * 50 + [2] * 30, "x": list(range(50)) + list(range(100, 130)),
                        "w": list(range(1, 51)) + [2] * 30})
    out = running_totals(spark.createDataFrame(pdf), ["k"], "x", ["w"], buckets=7).toPandas()
    out = out.sort_values(["k", "x"])
    exp = pdf.sort_values(["k", "x"]).groupby("k").w.cumsum().values
    assert (out.cum_w.values == exp).all()


def test_global_rank_is_total_order(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 97).alias("a"), F.col("id").alias("b"))
    r = global_rank(df, ["a", "b"], "pos").toPandas().sort_values(["a", "b"])
    assert list(r.pos) == list(range(5000))


def test_previous_values_equals_lag(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.integers(0, 5, 3000), "t": rng.permutation(3000),
                        "x": rng.integers(0, 3, 3000)})
    out = previous_values(spark.createDataFrame(pdf), "k", ["t"], ["x"]).toPandas()
    exp = pdf.sort_values(["k", "t"]).assign(prev_x=lambda d: d.groupby("k").x.shift(1))
    m = out.merge(exp, on=["k", "t"], suffixes=("", "_e"))
    assert len(m) == 3000
    assert ((m.prev_x.isna() & m.prev_x_e.isna()) | (m.prev_x == m.prev_x_e)).all()
    ch = change_events(spark.createDataFrame(pdf), "k", ["t"], ["x"]).count()
    exp_ch = (exp.prev_x.isna() | (exp.prev_x != exp.x)).sum()
    assert ch == exp_ch


def test_knn_join_exact(spark):
    rng = np.random.default_rng(9)
    pts = pd.DataFrame({"id": np.arange(400), "lat": rng.uniform(-38.6, -37.4, 400),
                        "lon": rng.uniform(144.4, 145.7, 400)})
    stops = pd.DataFrame({"sid": np.arange(40), "lat": rng.uniform(-38.0, -37.8, 40),
                          "lon": rng.uniform(144.9, 145.0, 40)})
    res = knn_join(spark.createDataFrame(pts), spark.createDataFrame(stops), 3, "id", "sid",
                   metric="euclid", base_cell=0.02).toPandas()
    d = np.sqrt((pts.lat.values[:, None] - stops.lat.values[None]) ** 2
                + (pts.lon.values[:, None] - stops.lon.values[None]) ** 2)
    best = np.argsort(d, axis=1)[:, :3]
    for _, r in res.iterrows():
        assert stops.sid.values[best[int(r.id), int(r["rank"]) - 1]] == r.sid


def test_golden_clean_rules(spark):
    from estatelens.operators.clean import apply_clean_rules, land_flag
    rows = [  # id, status, type, beds, baths, land, lat, lon, price
        ("a", "Sold", "House", 14.0, 25.0, 500.0, -37.8, 145.0, 20000.0),
        ("b", "Sold", "House", 0.0, 1.0, 300.0, -37.8, 145.0, 19999.0),
        ("c", "Sold", "Vacant land", 0.0, 0.0, 500.0, None, 145.0, None),
        ("d", "For Sale", "House", 3.0, 1.0, 0.0, -37.8, 145.0, 5.0),
        ("e", "For Sale", "Apartment / Unit / Flat", 2.0, 1.0, 0.0, -37.8, 145.0, 600000.0),
        ("f", "For Sale", None, 0.0, 0.0, 500.0, -39.0, 145.0, None),
    ]
    df = spark.createDataFrame(rows, "Property_ID string, Status string, Property_Type string, "
                               "Beds double, Baths double, LandSize_sqm double, Latitude double, "
                               "Longitude double, Numeric_Price double").withColumn("Raw_Price", F.lit("$x")).withColumn("Car_Spaces", F.lit(12.0))
    fl = df.withColumn("is_land", land_flag())
    caps = spark.createDataFrame([("House", 400.0)], "Property_Type string, cap double")
    out = {r.Property_ID: r for r in apply_clean_rules(fl, caps).collect()}
    assert out["a"].Beds == 10 and out["a"].Baths == 10 and out["a"].LandSize_sqm == 400.0
    assert out["a"].Car_Spaces == 10
    assert "b" not in out                                   # 19 999 dropped
    assert out["c"].is_land == 1 and out["c"].Beds == 0 and out["c"].out_of_metro == 1
    assert out["d"].LandSize_sqm is None and out["d"].Numeric_Price is None
    assert out["d"].Raw_Price == "Contact Agent"
    assert out["e"].LandSize_sqm == 0.0
    assert out["f"].Property_Type == "Unknown" and out["f"].is_land == 1


def test_split_sizes(spark):
    from estatelens.operators.features import chronological_split
    n = 129069
    df = spark.range(n).select(F.col("id").cast("string").alias("Property_ID"),
                               F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 900).cast("int"))
                               .alias("Date_parsed"))
    c = {r.fold: r["count"] for r in chronological_split(df).groupBy("fold").count().collect()}
    assert c == {"train": 90348, "val": 19360, "test": 19361}


def test_ridge_matches_closed_form(spark):
    from pyspark.ml.linalg import Vectors
    from estatelens.operators.models import LABEL, fit_ridge
    rng = np.random.default_rng(11)
    n, p, alpha = 400, 5, 10.0
    X = rng.normal(size=(n, p))
    y = X @ rng.normal(size=p) + 3 + rng.normal(scale=0.5, size=n)
    df = spark.createDataFrame([(Vectors.dense(X[i].tolist()), float(y[i])) for i in range(n)],
                               ["features", LABEL])
    m = fit_ridge(df, alpha, n, float(np.std(y)))
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(p), Xc.T @ yc)
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-8)
    assert abs(m.intercept - (y.mean() - X.mean(0) @ w)) < 1e-8


def test_hash_sample_equals_global_top_n(spark):
    from estatelens.operators.profile import hash_sample
    df = spark.range(50000).select(F.col("id").cast("string").alias("k"))
    a = [r.k for r in hash_sample(df, 700, "k").collect()]
    b = [r.k for r in df.orderBy(F.xxhash64("k", F.lit(42)), "k").limit(700).collect()]
    assert a == b


def test_changed_only_null_safe(spark):
    from estatelens.operators.ingest import changed_only
    state = spark.createDataFrame([("1", "Sold", None), ("2", "For Sale", "$500k")],
                                  "id string, status string, price string")
    batch = spark.createDataFrame([("1", "Sold", None), ("2", "For Sale", "$490k"), ("3", "Sold", "$1m")],
                                  "id string, status string, price string")
    got = sorted(r.id for r in changed_only(batch, state, "id", ["status", "price"]).collect())
    assert got == ["2", "3"]          # a missing price matches a missing price


def test_pick_boundary_prefers_admin_polygon(spark):
    from estatelens.operators.spatial import pick_boundary
    c = spark.createDataFrame([
        ("carlton ", 0, "place", "suburb", "Point", "[1]"),
        ("Carlton", 1, "boundary", "suburb", "Polygon", "[2]"),
        ("Kew", 0, "place", "suburb", "MultiPolygon", "[3]"),
        ("Kew", 1, "boundary", "administrative", "Point", "[4]"),
        ("Fitzroy", 0, "highway", "road", "Polygon", "[5]")],
        "suburb string, pos int, class string, type string, geom_type string, coordinates string")
    done = spark.createDataFrame([("fitzroy",)], "suburb string")
    got = {r.suburb_key: r.coordinates for r in pick_boundary(c, done).collect()}
    assert got == {"CARLTON": "[2]"}  # Kew's boundary is a Point -> dropped; Fitzroy done


def test_exact_percentiles_property(spark):
    """Random groups/values (with ties, negatives, one-row groups) vs numpy."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=60),
           st.floats(0.0, 1.0))
    def check(rows, q):
        pdf = pd.DataFrame(rows, columns=["g", "v"]).astype({"v": "float64"})
        res = exact_percentiles(spark.createDataFrame(pdf), ["g"], "v", {"p": q}, small=8, grid=4).toPandas()
        for grp, sub in pdf.groupby("g"):
            got = res[res.g == grp].p.iloc[0]
            assert abs(got - sub.v.quantile(q)) < 1e-9
    check()


def test_offences_by_postcode_unnamed_suburbs(spark):
    """Unnamed suburbs count towards the total but are never the reference; a total of 0 goes; the latest year alone counts."""
    from estatelens.operators.enrich import offences_by_postcode
    rows = [("3000", "2024", None, "5"), ("3000", "2024", None, "5"), ("3000", "2024", "B", "1"), ("3000", "2024", "A", "1"),
            ("3000", "2023", "Z", "9"), ("3001", "2024", None, "2"), ("3002", "2024", "C", "0"), (None, "2024", "D", "4"), ("3000", "2024", "B", None)]
    raw = spark.createDataFrame(rows, "`Postcode` string, `Year` string, `Suburb/Town Name` string, `Offence Count` string")
    got = {r.Postcode: (r.crime_offence_count, r.crime_suburb_ref) for r in offences_by_postcode(raw).collect()}
    assert got == {3000: (12.0, "A"), 3001: (2.0, None)}


def test_selection_with_outlier_ties_and_one_large_group(spark):
    """Ranks are found by cells however the values lie: an outlier far off, a value that fills
    most of a group, infinities; small groups, nulls, NaN and null keys beside them."""
    rng = np.random.default_rng(5)
    groups = {
        "outlier": np.r_[rng.normal(size=4000), 1e300],
        "ties": np.r_[np.full(2500, 7.0), rng.uniform(7, 8, 900), rng.uniform(6, 7, 100)],
        "infinite": np.r_[np.full(300, np.inf), np.full(300, -np.inf), rng.normal(size=700)],
        "two": np.r_[np.zeros(500), np.ones(500)],
        "small": rng.normal(size=5),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    rows += [("small", None), ("small", float("nan")), ("none", None), (None, 1.0)]
    qs = {"low": 0.0, "q1": 0.1, "mid": 0.5, "q3": 0.75, "top": 1.0}
    df = spark.createDataFrame(rows, "g string, v double")
    for small, grid in ((20, 4), (500, 10), (100_000, 200)):
        got = exact_percentiles(df, ["g"], "v", qs, count_alias="n", small=small, grid=grid).toPandas().set_index("g")
        assert sorted(got.index) == sorted(groups)
        for g, vs in groups.items():
            assert got.loc[g, "n"] == len(vs)
            vs, want = np.sort(vs), []
            for q in qs.values():
                h = q * (len(vs) - 1)
                lo, hi = vs[int(h)], vs[min(int(h) + 1, len(vs) - 1)]
                want.append(lo if lo == hi else lo + (h - int(h)) * (hi - lo))
            assert np.allclose(got.loc[g, list(qs)].to_numpy(float), want, rtol=1e-12, atol=0), g


def test_running_totals_with_outlier_spread_evenly(spark):
    pdf = pd.DataFrame({"k": 1, "x": np.r_[np.arange(3000.0), 1e300], "w": 1})
    out = running_totals(spark.createDataFrame(pdf), ["k"], "x", ["w"], buckets=16).toPandas().sort_values("x")
    assert (out["cum_w"].to_numpy() == np.arange(1, 3002)).all()


def test_cleaning_books_reconcile(spark):
    """Every step begins with the rows the one before left; a row that breaks two rules is booked once."""
    from estatelens.operators.clean import accounted_clean, clean
    schema = ("Property_ID string, Status string, Date string, Property_Type string, Beds double, Baths double, "
              "Car_Spaces double, LandSize_sqm double, Latitude double, Longitude double, Numeric_Price double, "
              "Raw_Price string, Last_Updated string")

    def row(i, status, date, kind, price, raw="$x", land=500.0, updated="2024-01-01"):
        return (i, status, date, kind, 3.0, 1.0, 1.0, land, -37.8, 145.0, price, raw, updated)

    rows = [row("a", "Sold", "01 Jan 2024", "House", 5e5), row("a", "Sold", "01 Jan 2024", "House", 5e5),
            row("b", "Sold", None, "House", 5.0),                       # no date and out of range: booked under the date
            row("c", "Sold", "02 Jan 2024", "House", 5.0), row("d", "Sold", "02 Jan 2024", "House", None),
            row("e", "For Sale", None, None, None, None, None), row("f", "For Sale", None, "House", 5.0),
            row("f", "For Sale", None, "House", 6e5, updated="2024-02-01"), row(None, "For Sale", None, "House", 6e5),
            row(None, "For Sale", None, "House", 6e5), row("g", "Withdrawn", None, "House", 6e5),
            row("h", None, None, "House", 6e5)]
    df = spark.createDataFrame(rows, schema)
    result, steps = accounted_clean(df)
    got = {r.step: (r.rows_before, r.removed, r.rows_after) for r in steps.collect()}
    assert got == {"other_status": (12, 2, 10), "sold_no_date": (10, 1, 9), "forsale_broken": (9, 1, 8),
                   "forsale_repeated": (8, 2, 6), "sold_price_range": (6, 1, 5)}
    assert result.cleaned.count() == 5
    assert sorted(map(str, result.cleaned.collect())) == sorted(map(str, clean(df).cleaned.collect()))
    _, steps = accounted_clean(df.limit(0))
    assert {(r.rows_before, r.removed, r.rows_after) for r in steps.collect()} == {(0, 0, 0)}


def test_scatter_samples_against_brute_force(spark):
    """A feature with an outlier, one of a single value, one of nulls and NaN; nothing of a null prediction."""
    import hashlib
    rows = [(str(i), None if i % 50 == 7 else float(i), 1e6 if i == 3 else float(i % 97), 5.0,
             None if i % 3 == 0 else float("nan") if i % 3 == 1 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "id string, pred double, a double, b double, c double")
    got = sorted(tuple(r) for r in scatter_samples(df, "id", "pred", ["a", "b", "c"], bins=8, k=5).collect())
    want = []
    for name, at in (("a", 2), ("b", 3)):
        points = [(r[at], r[0], r[1]) for r in rows if r[1] is not None]
        lo, hi = min(points)[0], max(points)[0]
        cells = {}
        for v, key, p in points:
            cells.setdefault(min(7, int((v - lo) / (hi - lo) * 8)) if hi > lo else 0, []).append((hashlib.md5(key.encode()).hexdigest(), key, v, p))
        want += [(name, b, v, key, p) for b, cell in cells.items() for _, key, v, p in sorted(cell)[:5]]
    assert got == sorted(want) and len({r[1] for r in got if r[0] == "a"}) == 2


def test_nearest_distance_searches_places_once(spark, monkeypatch):
    """Stops that share a place are searched once, by distance alone; the answers are those of brute force."""
    from estatelens.operators import spatial as SP
    rng = np.random.default_rng(4)
    spots = [(float(a), float(b)) for a, b in zip(rng.uniform(-38.0, -37.98, 150), rng.uniform(145.0, 145.02, 150))] + [(-36.0, 143.0)]
    stops = spark.createDataFrame([(str(i), *spots[i % 151]) for i in range(3000)] + [("n", None, 1.0)], "stop_id string, stop_lat double, stop_lon double")
    asked = [(str(i), float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(-38.6, -36, 60), rng.uniform(143, 145.7, 60)))] + [("x", *spots[0])]
    seen, plain = [], SP.knn_join
    monkeypatch.setattr(SP, "knn_join", lambda left, right, *a, **k: seen.append((right.count(), a[2])) or plain(left, right, *a, **k))
    got = {r.id: r.dist_nearest_train_km for r in SP.nearest_distance_km(
        spark.createDataFrame(asked, "id string, lat double, lon double"), stops, "id", "lat", "lon").collect()}
    assert seen == [(151, None)]

    def km(a, b, c, d):
        a, b, c, d = map(np.radians, (a, b, c, d))
        h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
        return 6371.0 * 2 * np.arctan2(np.sqrt(h), np.sqrt(1 - h))
    assert got == {i: pytest.approx(min(km(a, b, c, d) for c, d in spots), abs=6e-4) for i, a, b in asked}


def test_first_k_sorts_few_rows(spark):
    """Rows beyond the reach of the first k are left out before sorting; ties, nulls, small groups and long common beginnings keep theirs."""
    from estatelens.operators import scoring as SC
    rows = [("big", hex(i * 2654435761 % 2 ** 32)[2:].zfill(8)) for i in range(20000)] + [("few", "b"), ("few", "a"), (None, "q"), ("same", None)]
    rows += [("same", f"beginning-{i % 50:03d}") for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, t string")
    kept = {r.g: r.n for r in SC._within_reach(df, "g", "t", 25, 64).groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert 25 <= kept["big"] < 200 and kept["few"] == 2 and kept[None] == 1 and kept["same"] == 5001
    got = {}
    for r in SC.first_k_per_group(df, "g", ["t"], 25).collect():
        got.setdefault(r.g, []).append(r.t)
    for g in ("big", "few", None, "same"):
        assert sorted(got[g], key=lambda x: (x is not None, x)) == sorted((t for x, t in rows if x == g), key=lambda x: (x is not None, x))[:25]
