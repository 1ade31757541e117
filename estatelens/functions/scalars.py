"""Row-level rules as native Column expressions (no Python UDFs).

Each function returns a ``Column`` so callers compose them inside one
``select``; Catalyst keeps the whole chain in a single codegen stage.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from estatelens import params as P


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# H1 ------------------------------------------------------------------------
def parse_price(raw) -> Column:
    """Free-text asking/sold price -> double (null when no ``$`` amount).

    lower+trim; a digit run of 4+ after ``.``/``,`` is cut to 3 digits;
    commas dropped; en dash and `` to `` become ``-``; every ``$<num>[k|m]``
    is read (``m`` = million, ``k`` = thousand only below 1000); "fhog"
    texts take the first amount, ranges (2+ amounts and a ``-``) the mean of
    the first two, otherwise the first amount.
    """
    s = F.lower(F.trim(_c(raw)))
    s = F.regexp_replace(s, r"([.,])(\d{3})\d+", "$1$2")
    s = F.replace(F.replace(F.replace(s, F.lit(","), F.lit("")),
                            F.lit("–"), F.lit("-")),
                  F.lit(" to "), F.lit("-"))
    found = F.regexp_extract_all(s, F.lit(r"\$\s*(\d+\.?\d*[km]?)"), 1)

    def amount(x):
        body = F.substring(x, 1, F.length(x) - 1)
        num = body.try_cast("double")
        return (F.when(x.endswith("m"), num * 1_000_000.0)
                .when(x.endswith("k"), F.when(num < 1000, num * 1000.0).otherwise(num))
                .otherwise(x.try_cast("double")))

    vals = F.transform(found, amount)
    first = F.get(vals, 0)
    value = (F.when(s.contains("fhog"), first)
             .when((F.size(vals) >= 2) & s.contains("-"),
                   (first + F.get(vals, 1)) / 2.0)
             .otherwise(first))
    ok = s.isNotNull() & (F.length(s) > 0) & s.contains("$") & (F.size(found) > 0)
    return F.when(ok, value)


# H2 ------------------------------------------------------------------------
def land_size_sqm(size, unit) -> Column:
    """Land size in m²: hectare units (any unit text containing 'ha') x 10 000.

    A value that does not convert to a number is kept as null.
    """
    v = _c(size).cast("string").try_cast("double")
    u = F.lower(F.coalesce(_c(unit).cast("string"), F.lit("")))
    is_ha = u.contains("ha") | u.contains("hectare")
    return F.when(is_ha, v * 10000.0).otherwise(v)


# H3 ------------------------------------------------------------------------
def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance (atan2 form, R = 6371 km); null in -> null out."""
    la1, lo1, la2, lo2 = (F.radians(_c(x)) if not isinstance(x, (int, float))
                          else F.radians(F.lit(float(x))) for x in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    return F.lit(P.EARTH_RADIUS_KM) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def distance_to_cbd_km(lat, lon) -> Column:
    return F.bround(haversine_km(P.CBD_LAT, P.CBD_LON, lat, lon), 2)


# H4 / H11 ------------------------------------------------------------------
def full_address(street, suburb, postcode, state: str = P.STATE_CODE) -> Column:
    """``"{street}, {suburb} {state} {postcode}"``; null when street missing."""
    st = _c(street)
    text = F.trim(F.concat_ws("", st, F.lit(", "), _c(suburb), F.lit(f" {state} "),
                              F.coalesce(_c(postcode).cast("string"), F.lit(""))))
    return F.when(st.isNotNull() & (st != "N/A"), text)


def listing_url(path, base: str = P.LISTING_URL_BASE) -> Column:
    p = _c(path)
    return F.when(p.isNotNull() & (p != ""), F.concat(F.lit(base), p)).otherwise(F.lit("N/A"))


# H5 / H6 / H8 --------------------------------------------------------------
def pick_listing_date(date_sold, date_listed, status_date, record_json) -> Column:
    """First present of sold date, listed date, status date, a ``d Mon yyyy``
    text anywhere in the record, an ISO date under a ``*date*`` key; else N/A.
    """
    def present(c):
        c = _c(c)
        return F.when(c.isNotNull() & (c != ""), c)
    txt = _c(record_json)
    dmy = F.regexp_extract(txt, r"([0-9]{1,2}\s+[A-Za-z]{3,9}\s+[0-9]{4})", 1)
    iso = F.regexp_extract(
        txt, r"\"[A-Za-z]*[dD]ate[A-Za-z]*\"\s*:\s*\"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    primary = F.coalesce(_c(date_sold), _c(date_listed))
    return F.coalesce(present(primary), present(status_date), present(dmy),
                      present(iso), F.lit("N/A"))


def parse_listing_date(text) -> Column:
    """``d MMM yyyy`` (e.g. ``1 Jan 2020``) -> date; anything else -> null."""
    return F.try_to_date(_c(text), "d MMM yyyy")


def year_of(d) -> Column:
    return F.year(_c(d)).cast("int")


def month_of(d) -> Column:
    return F.month(_c(d)).cast("int")


# H7 ------------------------------------------------------------------------
def rate_per_100k(count, population) -> Column:
    c, p = _c(count), _c(population)
    return F.when(c.isNotNull() & p.isNotNull() & (p > 0), F.bround(c / p * 100000.0, 1))


# H9 / H10 ------------------------------------------------------------------
def extract_postcode(text) -> Column:
    """First 4-digit run -> int (null if none)."""
    return F.regexp_extract(_c(text).cast("string"), r"(\d{4})", 1).try_cast("int")


def to_number(text) -> Column:
    """String -> double, failure -> null (never raises under ANSI mode)."""
    return F.trim(_c(text).cast("string")).try_cast("double")


# H12 / H13 -----------------------------------------------------------------
def log1p(x) -> Column:
    return F.log1p(_c(x))


def expm1(x) -> Column:
    return F.expm1(_c(x))


def round_thousand(x) -> Column:
    """Nearest 1 000, ties to even (numpy ``round(x, -3)``)."""
    return F.bround(_c(x), -3)


# H14 -----------------------------------------------------------------------
def deal_signal(predicted, asking, threshold: float = 0.10,
                basis: str = "prediction") -> Column:
    """Good Deal / Overpriced / Fair / No Asking Price.

    basis="prediction": band of +/- threshold around the prediction, strict.
    basis="asking": predicted > (1+t) x asking -> Good Deal, predicted <
    (1-t) x asking -> Overpriced.
    """
    p, a = _c(predicted), _c(asking)
    if basis == "prediction":
        good, over = a < p * (1 - threshold), a > p * (1 + threshold)
    else:
        good, over = p > a * (1 + threshold), p < a * (1 - threshold)
    return (F.when(a.isNull(), F.lit("No Asking Price"))
            .when(good, F.lit("Good Deal"))
            .when(over, F.lit("Overpriced"))
            .otherwise(F.lit("Fair")))


# H15 / H16 -----------------------------------------------------------------
def interval_bounds(point, q_lo, q_hi) -> tuple[Column, Column]:
    """Lower = min(q_lo, point), upper = max(q_hi, point) (null-propagating)."""
    p, lo, hi = _c(point), _c(q_lo), _c(q_hi)
    lower = F.when(lo.isNull() | p.isNull(), F.lit(None)).otherwise(F.least(lo, p))
    upper = F.when(hi.isNull() | p.isNull(), F.lit(None)).otherwise(F.greatest(hi, p))
    return lower, upper


def interval_width_pct(point, lower, upper) -> Column:
    p = _c(point)
    return F.bround(F.when(p > 0, (_c(upper) - _c(lower)) / p * 100.0).otherwise(0.0), 1)


# H17 -----------------------------------------------------------------------
def price_bucket(price) -> Column:
    """Right-closed buckets (0,500k] .. (2.5M,20M]; outside -> null."""
    x = _c(price)
    e, lab = P.PRICE_BUCKET_EDGES, P.PRICE_BUCKET_LABELS
    expr = None
    for i, name in enumerate(lab):
        cond = (x > e[i]) & (x <= e[i + 1])
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


# H18 -----------------------------------------------------------------------
def mercator_xy(lat, lon) -> tuple[Column, Column]:
    r = P.MERCATOR_RADIUS_M
    x = F.radians(_c(lon)) * r
    y = F.log(F.tan(F.lit(3.141592653589793 / 4) + F.radians(_c(lat)) / 2)) * r
    return x, y


# H19 -----------------------------------------------------------------------
def abs_error(actual, predicted) -> Column:
    return F.abs(_c(actual) - _c(predicted))


def pct_error(actual, predicted) -> Column:
    return F.abs(_c(actual) - _c(predicted)) / _c(actual) * 100.0


# H21 -----------------------------------------------------------------------
def grid_cell(lat, lon, n: int = 14, lat_rng=(-38.5, -37.5),
              lon_rng=(144.35, 145.40)) -> Column:
    """Cell id row*n+col of an n x n grid (row 0 = north); null outside."""
    la0, la1 = lat_rng
    lo0, lo1 = lon_rng
    lat_step = (la1 - la0) / n
    lon_step = (lo1 - lo0) / n
    row = F.floor((F.lit(la1) - _c(lat)) / lat_step)
    col = F.floor((_c(lon) - F.lit(lo0)) / lon_step)
    inside = (_c(lat).between(la0, la1) & _c(lon).between(lo0, lo1))
    return F.when(inside, F.least(row, F.lit(n - 1)) * n + F.least(col, F.lit(n - 1)))


# H23 -----------------------------------------------------------------------
def stamp(as_of: _dt.date) -> Column:
    return F.lit(as_of)
