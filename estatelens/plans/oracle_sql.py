"""DuckDB SQL building blocks for the correctness oracle.

Written independently of the Spark code: plain ANSI-ish SQL over the
pre-registered driver tables, so a bug in an operator shows up as a
mismatch instead of being reproduced.
"""

from __future__ import annotations

from estatelens import params as P
from estatelens.sources import listings_adapter as la


def _lst(xs) -> str:
    return "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + ")"


LAND = _lst(P.LAND_TYPES)
APT = _lst(P.APT_LIKE_TYPES)
RURAL = _lst(P.RURAL_LARGE_TYPES)
NEWB = _lst(P.NEW_BUILD_TYPES)


def listings_cte() -> str:
    return f"listings AS (\n{la.duckdb_sql()}\n)"


def cleaned_ctes() -> str:
    """CTEs ending in ``cleaned`` (plus ``flagged`` and ``caps``)."""
    return f"""{listings_cte()},
parsed AS (
  SELECT *, CAST(try_strptime(Date, '%d %b %Y') AS DATE) AS Date_parsed FROM listings
),
parsed2 AS (
  SELECT *, CAST(year(Date_parsed) AS INT) AS Year, CAST(month(Date_parsed) AS INT) AS Month
  FROM parsed
),
kept AS (
  SELECT * FROM parsed2
  WHERE NOT (Status = 'Sold' AND Date_parsed IS NULL)
    AND NOT (Status = 'For Sale' AND Property_Type IS NULL AND LandSize_sqm IS NULL
             AND Raw_Price IS NULL)
),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY Property_ID ORDER BY Last_Updated DESC NULLS LAST,
           Numeric_Price DESC NULLS LAST, Raw_Price DESC NULLS LAST) AS rn
    FROM kept WHERE Status = 'For Sale') t WHERE rn = 1
  UNION ALL
  SELECT * FROM kept WHERE Status <> 'For Sale'
),
flagged AS (
  SELECT *, CASE WHEN Property_Type IN {LAND}
                   OR (Beds = 0 AND Baths = 0 AND coalesce(LandSize_sqm, 0) > 0)
              THEN 1 ELSE 0 END AS is_land
  FROM dedup
),
caps AS (
  SELECT Property_Type,
         CASE WHEN Property_Type IN {RURAL}
              THEN quantile_cont(LandSize_sqm, 0.999) ELSE quantile_cont(LandSize_sqm, 0.99) END AS cap
  FROM flagged
  WHERE Status = 'Sold' AND Property_Type IS NOT NULL AND LandSize_sqm > 0
  GROUP BY Property_Type HAVING count(*) >= 10
),
c1 AS (
  SELECT f.* EXCLUDE (Property_Type, Beds, Car_Spaces, Baths),
         coalesce(f.Property_Type, 'Unknown') AS Property_Type,
         CASE WHEN f.Beds > 10 THEN 10 ELSE f.Beds END AS Beds,
         CASE WHEN f.Car_Spaces > 10 THEN 10 ELSE f.Car_Spaces END AS Car_Spaces,
         f.Baths AS Baths0, c.cap
  FROM flagged f LEFT JOIN caps c ON f.Property_Type = c.Property_Type
),
c2 AS (
  SELECT * EXCLUDE (Baths0),
         CASE WHEN Beds > 0 AND Baths0 > Beds * 2 THEN Beds * 2 ELSE Baths0 END AS Baths1
  FROM c1
),
c3 AS (
  SELECT * EXCLUDE (Baths1, Beds, LandSize_sqm, Numeric_Price, Raw_Price, cap),
    CASE WHEN Beds = 0 AND is_land = 0 THEN NULL ELSE Beds END AS Beds,
    CASE WHEN Beds = 0 AND is_land = 0 THEN NULL
         WHEN Baths1 > 10 THEN 10 ELSE Baths1 END AS Baths,
    CASE WHEN LandSize_sqm = 0 AND Property_Type NOT IN {APT} AND is_land = 0 THEN NULL
         WHEN cap IS NOT NULL AND LandSize_sqm > cap THEN cap
         ELSE LandSize_sqm END AS LandSize_sqm,
    CASE WHEN coalesce(Latitude BETWEEN -38.6 AND -37.4, false)
          AND coalesce(Longitude BETWEEN 144.4 AND 145.7, false) THEN 0 ELSE 1 END AS out_of_metro,
    CASE WHEN Status = 'For Sale' AND Numeric_Price IS NOT NULL
          AND NOT (Numeric_Price BETWEEN 20000 AND 20000000) THEN NULL
         ELSE Numeric_Price END AS Numeric_Price,
    CASE WHEN Status = 'For Sale' AND Numeric_Price IS NOT NULL
          AND NOT (Numeric_Price BETWEEN 20000 AND 20000000) THEN 'Contact Agent'
         ELSE Raw_Price END AS Raw_Price,
    Numeric_Price AS price_in
  FROM c2
),
cleaned AS (
  SELECT * EXCLUDE (price_in) FROM c3
  WHERE NOT (Status = 'Sold' AND price_in IS NOT NULL
             AND NOT (price_in BETWEEN 20000 AND 20000000))
)"""


def with_cleaned(body: str) -> str:
    return f"WITH {cleaned_ctes()}\n{body}"


def with_listings(body: str) -> str:
    return f"WITH {listings_cte()}\n{body}"
