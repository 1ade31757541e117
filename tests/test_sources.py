"""CSV dialect probe and malformed-line handling."""

import tempfile

from estatelens.operators.ingest import explode_payloads, payload_of_html
from estatelens.sources.readers import probe_dialect, read_listings_csv

HEADER = ["Property_ID", "Status", "Suburb", "Postcode", "Property_Type", "Beds", "Numeric_Price"]


def _write(lines, sep, encoding, bom=False):
    d = tempfile.mkdtemp(prefix="csvfix-", dir="/tmp")
    with open(f"{d}/part-0.csv", "w", encoding=encoding, newline="\n") as f:
        if bom:
            f.write("﻿")
        f.write(sep.join(HEADER) + "\n")
        for row in lines:
            f.write(sep.join(row) + "\n")
    return d


def test_bom_tab_short_and_long_lines(spark):
    rows = [["1", "Sold", "Carlton", "3053", "House", "3", "650000"],
            ["2", "For Sale", "Fitzroy", "3065", "N/A", "2"],                     # short: kept
            ["3", "Sold", "Kew", "3101", "House", "4", "1", "extra", "fields"],   # long: dropped
            ["4", "For Sale", "Richmond", "3121", "NA", "NaN", "N/A"]]
    path = _write(rows, "\t", "utf-8", bom=True)
    assert probe_dialect(spark, path) == ("UTF-8", "\t")
    got = {r.Property_ID: r for r in read_listings_csv(spark, path).collect()}
    assert set(got) == {"1", "2", "4"}
    assert got["1"].Numeric_Price == 650000.0 and got["1"].Postcode == 3053
    assert got["2"].Property_Type is None and got["2"].Numeric_Price is None
    assert got["4"].Property_Type is None and got["4"].Beds is None


def test_latin1_comma(spark):
    rows = [["9", "Sold", "Brunswick Éast", "3057", "Unit", "1", "410000"]]
    path = _write(rows, ",", "latin-1")
    enc, sep = probe_dialect(spark, path)
    assert sep == ","
    r = read_listings_csv(spark, path).first()
    assert r.Suburb == "Brunswick Éast" and r.Numeric_Price == 410000.0


def test_csv_keeps_rows_with_bad_cells(spark, tmp_path):
    """A quoted separator, a bad number, "3101.0", a quoted line break, short, long and late non-UTF-8 rows."""
    from estatelens.sources.readers import read_listings_csv
    names = ["Property_ID", "Full_Address", "Suburb", "Postcode", "LandSize_sqm"]
    rows = ['1,"1 A St, B",B,3101,10.5', '2,"2 A St, B",B,3101.0,N/A', '3,"3 ""A"" St, B",B,3101,oops',
            '4,"4 A\nSt, B",B,3101,7', "5,short", "6,a,b,c,1,too,long", "7,É,B,3101,8"]
    for enc in ("utf-8", "latin-1"):
        path = tmp_path / f"{enc}.csv"
        path.write_bytes("\n".join([",".join(names), *rows]).encode(enc) + b"\n")
        got = {r.Property_ID: r for r in read_listings_csv(spark, str(path)).collect()}
        assert sorted(got) == ["1", "2", "3", "4", "5", "7"]
        assert got["1"].Full_Address == "1 A St, B" and got["1"].LandSize_sqm == 10.5
        assert got["2"].LandSize_sqm is None and float(got["2"].Postcode) == 3101
        assert got["3"].LandSize_sqm is None and got["4"].Full_Address == "4 A\nSt, B"
        assert got["5"].Suburb is None and got["7"].Full_Address == "É"


def test_feeds_are_read_by_name(spark, tmp_path):
    from estatelens.sources.readers import read_feed_table
    for feed, head, row in (("a", "stop_id,stop_lat,stop_lon", "s1,-37.8,144.9"), ("b", "stop_lat,stop_id,stop_lon", "-37.9,s2,145.0")):
        (tmp_path / feed).mkdir()
        (tmp_path / feed / "stops.txt").write_text(f"{head}\n{row}\n")
    got = read_feed_table(spark, str(tmp_path), "stops.txt")
    assert {(r.feed_id, r.stop_id, r.stop_lat) for r in got.collect()} == {("a", "s1", "-37.8"), ("b", "s2", "-37.9")}


def test_geojson_collection_and_arrays(spark, tmp_path):
    import json

    from estatelens.sources.readers import read_geojson_features
    from estatelens.sources.sinks import write_geojson_features
    shape = [[[144.1, -37.5], [144.2, -37.5], [144.1, -37.5]]]
    feature = lambda s: {"type": "Feature", "properties": {"Suburb": s}, "geometry": {"type": "Polygon", "coordinates": shape}}
    (tmp_path / "c.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature("A"), feature("B")]}, indent=1))
    got = read_geojson_features(spark, str(tmp_path / "c.json"))
    assert {(r.suburb_key, r.geom_type) for r in got.collect()} == {("A", "Polygon"), ("B", "Polygon")}
    assert all(json.loads(r.coordinates) == shape for r in got.collect())
    out = str(tmp_path / "out")
    write_geojson_features(got, out, "overwrite")
    lines = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted(x["properties"]["Suburb"] for x in lines) == ["A", "B"] and all(x["geometry"]["coordinates"] == shape for x in lines)
    assert read_geojson_features(spark, out).count() == 2


def test_ks_p_values(spark):
    from pyspark.sql import functions as F

    from estatelens.operators.drift import ks_pvalue
    rows = [(0.0, 1000.0), (0.0005, 1000.0), (0.02, 1000.0), (0.05, 1000.0), (0.3, 1000.0)]
    df = spark.createDataFrame(rows, "d double, n double").select("d", ks_pvalue(F.col("d"), F.col("n"), F.col("n")).alias("p"))
    p = [r.p for r in df.orderBy("d").collect()]
    assert p[0] == 1.0 and p[1] > 0.999999 and p == sorted(p, reverse=True) and p[4] < 1e-10


def test_nearest_distance_is_per_row(spark):
    from estatelens.operators.spatial import nearest_distance_km
    points = spark.createDataFrame([("x", -37.8, 144.9), ("x", -37.8, 145.3), ("y", None, 1.0)], "id string, lat double, lon double")
    stops = spark.createDataFrame([("s", -37.8, 144.9)], "stop_id string, stop_lat double, stop_lon double")
    got = nearest_distance_km(points, stops, "id", "lat", "lon").collect()
    assert len(got) == 3 and {(r.id, r.dist_nearest_train_km == 0) for r in got if r.lat} == {("x", True), ("x", False)}


def test_only_files_with_quoted_breaks_are_read_whole(spark, tmp_path):
    """One file of two has a quoted line break, and its name has a space; an inch mark counts as a quote too."""
    head = ",".join(HEADER) + "\n"
    (tmp_path / "a b.csv").write_text(head + '1,Sold,"Carlton\nNorth",3054,House,3,1\n2,Sold,Kew,3101,House,2,5\n')
    (tmp_path / "c.csv").write_text(head + "".join(f"{i},Sold,Kew,3101,House,2,5\n" for i in range(10, 40)))
    got = read_listings_csv(spark, str(tmp_path))
    names = {r.Property_ID: r.Suburb for r in got.collect()}
    assert names == {"1": "Carlton\nNorth", "2": "Kew", **{str(i): "Kew" for i in range(10, 40)}}
    assert got.count() == 32
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation") == 2          # one read in splits, one record by record


def test_payload_of_html(spark):
    """The data script among others, whatever its attributes; pages without one, with an empty and with a cut one."""
    body = '{"props": {"pageProps": {"componentProps": {"listingsMap": {"7": {"listingModel": {"price": "$1"}}}}}}}'
    pages = [(1, f'<script id="__NEXT_DATA__" type="application/json">{body}</script>'),
             (2, f"<SCRIPT type=x\n id = '__NEXT_DATA__'>\n{body}\n</SCRIPT ><script id='__NEXT_DATA__'>{{}}</script>"),
             (3, f"<script>{body}</script><div id='__NEXT_DATA__'>{body}</div>"), (4, '<script id="__NEXT_DATA__"></script>'),
             (5, f'<script id="__NEXT_DATA__">{body[:-5]}</script>'), (6, None), (7, ""),
             (8, f'<script id="__NEXT_DATA__X">{body}</script>'), (9, f'<script data-id="__NEXT_DATA__">{body}</script>'),
             (10, f"<script id=__NEXT_DATA__ defer>{body}</script>"), (10, f"<script id=__NEXT_DATA__ defer>{body}</script>"),
             (11, '<script id="__NEXT_DATA__">{}</script>')]
    got = payload_of_html(spark.createDataFrame(pages, "id int, html string"))
    states = sorted((r.id, r.state) for r in got.collect())
    assert states == [(1, "ok"), (2, "ok"), (3, "no script"), (4, "no script"), (5, "not json"), (6, "no script"), (7, "no script"),
                      (8, "no script"), (9, "no script"), (10, "ok"), (10, "ok"), (11, "ok")]
    assert {r.payload for r in got.where("state = 'ok' AND id < 11").collect()} == {body}
    assert got.where("state <> 'ok' AND payload IS NOT NULL").count() == 0
    items = explode_payloads(got.withColumn("status_label", got.id))
    assert sorted((r.status_label, r.pid, r.m.price) for r in items.collect()) == [(i, "7", "$1") for i in (1, 2, 10, 10)]


def test_null_tokens_are_looked_up_in_text_columns_only(spark, tmp_path):
    path = str(tmp_path / "typed.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("Property_ID,Suburb,Postcode,Beds,Last_Updated\n1,NA,nan,-NaN,None\nNULL,S1,3101.0, 2 ,2020-01-02\n")
    df = read_listings_csv(spark, path)
    rows = {(r["Property_ID"], r["Suburb"], r["Postcode"], r["Beds"], str(r["Last_Updated"])) for r in df.collect()}
    assert rows == {("1", None, None, None, "None"), (None, "S1", 3101, 2.0, "2020-01-02")}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("INSET") == 2
