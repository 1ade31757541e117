"""Deterministic stand-ins shared by Spark queries and DuckDB oracles.

ML-dependent post-processing (intervals, deal signals, choropleths) is
checked against SQL by feeding it a prediction column computed from the row
id instead of a fitted model.  Expressions are valid in both engines.
"""

KEY = "CAST(Property_ID AS BIGINT)"
PRED = f"CAST(200000 + (({KEY} * 7919) % 1300) * 1000 + ({KEY} % 997) AS DOUBLE)"
Q10 = f"({PRED} * CAST(0.8 AS DOUBLE) + CAST(({KEY} % 13) * 1000 AS DOUBLE))"
Q90 = f"({PRED} * CAST(1.2 AS DOUBLE) - CAST(({KEY} % 17) * 1000 AS DOUBLE))"

# Geocoder candidate results, one per listing row (B24 input).
BOUNDARY_COLS = [
    ("suburb", "Suburb"),
    ("pos", KEY),
    ("class", f"(CASE {KEY} % 5 WHEN 0 THEN 'boundary' WHEN 1 THEN 'place' ELSE 'highway' END)"),
    ("type", f"(CASE {KEY} % 7 WHEN 0 THEN 'administrative' ELSE 'suburb' END)"),
    ("geom_type", f"(CASE {KEY} % 4 WHEN 0 THEN 'Point' WHEN 1 THEN 'Polygon' "
                  f"WHEN 2 THEN 'MultiPolygon' ELSE 'LineString' END)"),
    ("coordinates", f"'[' || CAST({KEY} % 1000 AS STRING) || ']'"),
]
DONE_SUBURBS = ("Suburb LIKE 'S%' AND CAST(substr(Suburb, 2) AS INT) % 4 = 0")
