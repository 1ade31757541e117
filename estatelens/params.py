"""All tunable rules as data.

The defaults are the fixed values the reference pipeline uses; every
transform takes a ``Params`` so a caller can override thresholds without
touching code. Nothing here reads the wall clock.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
LAND_TYPES = (
    "Vacant land", "New land", "Development Site", "Farm", "Farmlet",
    "Grazing", "Livestock", "Mixed Farming", "Specialist Farm",
)
APT_LIKE_TYPES = (
    "Apartment / Unit / Flat", "Studio", "Penthouse", "Block of Units",
    "Car Space",
)
RESIDENTIAL_DENSE_TYPES = (
    "House", "Townhouse", "Villa", "Semi-Detached", "Terrace", "Duplex",
    "New House & Land", "New Apartments / Off the Plan", "New Home Designs",
    "Block of Units",
)
RURAL_LARGE_TYPES = ("Acreage / Semi-Rural", "Rural", "Rural Lifestyle")
NEW_BUILD_TYPES = (
    "New House & Land", "New Apartments / Off the Plan", "New Home Designs",
    "New land",
)
NUMERIC_FEATURES = (
    "Beds", "Baths", "Car_Spaces", "LandSize_sqm", "Distance_to_CBD_km",
    "abs_median_income_weekly", "abs_median_age", "abs_population",
    "crime_rate_per_100k", "Propertycount", "dist_nearest_train_km",
    "Latitude", "Longitude",
)
TIME_FEATURES = ("Year", "Month")
FLAG_FEATURES = ("is_land", "out_of_metro", "is_new_build")
# Price-bucket edges (right-closed) and labels used in segment error tables.
PRICE_BUCKET_EDGES = (0, 500_000, 750_000, 1_000_000, 1_500_000, 2_500_000,
                      20_000_000)
PRICE_BUCKET_LABELS = ("<500k", "500-750k", "750k-1M", "1-1.5M", "1.5-2.5M",
                       ">2.5M")
MONTH_ABBR = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep",
              "Oct", "Nov", "Dec")
CBD_LAT, CBD_LON = -37.8136, 144.9631
EARTH_RADIUS_KM = 6371.0
MERCATOR_RADIUS_M = 6378137.0
STATE_CODE = "VIC"
LISTING_URL_BASE = "https://www.domain.com.au"
NULL_TOKENS = ("", "N/A", "NA", "n/a", "NaN", "nan", "null", "NULL", "None",
               "#N/A", "-NaN", "-nan")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Params:
    land_types: tuple = LAND_TYPES
    apt_like_types: tuple = APT_LIKE_TYPES
    residential_dense_types: tuple = RESIDENTIAL_DENSE_TYPES
    rural_large_types: tuple = RURAL_LARGE_TYPES
    new_build_types: tuple = NEW_BUILD_TYPES
    price_floor: float = 20_000.0
    price_ceiling: float = 20_000_000.0
    lat_min: float = -38.6
    lat_max: float = -37.4
    lon_min: float = 144.4
    lon_max: float = 145.7
    stop_lat_min: float = -38.6
    stop_lat_max: float = -37.4
    stop_lon_min: float = 144.3
    stop_lon_max: float = 145.6
    rooms_cap: float = 10.0
    baths_per_bed: float = 2.0
    rare_type_threshold: int = 50
    cap_min_rows: int = 10
    cap_q_rural: float = 0.999
    cap_q_residential: float = 0.99
    split_train: float = 0.70
    split_val: float = 0.15
    deal_threshold: float = 0.10
    deal_basis: str = "prediction"          # "prediction" (production) | "asking"
    suburb_min_sales: int = 30
    year_min_sales: int = 200
    year_type_min_sales: int = 50
    knn_k: int = 5
    grid_n: int = 14
    grid_lat: tuple = (-38.5, -37.5)
    grid_lon: tuple = (144.35, 145.40)
    rail_route_types: tuple = ("2",)
    lenient_rail: bool = False
    as_of: _dt.date = field(default=_dt.date(2026, 5, 2))

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
