"""Registered queries: features, split and preprocessor."""

from functools import reduce

from pyspark.sql import functions as F

from estatelens.operators import clean as C
from estatelens.operators import features as FE
from estatelens.params import NUMERIC_FEATURES
from estatelens.plans import base
from estatelens.plans import oracle_sql as O
from estatelens.plans.registry import register

FEAT_CTES = f"""
, rare AS (SELECT Property_Type FROM cleaned GROUP BY Property_Type HAVING count(*) < 50),
eng AS (SELECT * REPLACE (CASE WHEN Property_Type IN (SELECT Property_Type FROM rare) THEN 'Other'
                               ELSE Property_Type END AS Property_Type),
          CASE WHEN Property_Type IN {O.NEWB} THEN 1 ELSE 0 END AS is_new_build FROM cleaned),
tr AS (SELECT * FROM eng WHERE Status = 'Sold' AND Numeric_Price IS NOT NULL AND Date_parsed IS NOT NULL),
rk AS (SELECT *, row_number() OVER (ORDER BY Date_parsed, Property_ID) - 1 AS row_pos,
         count(*) OVER () AS n_all FROM tr),
split AS (SELECT * EXCLUDE (n_all), CASE WHEN row_pos < floor(n_all * CAST(0.7 AS DOUBLE)) THEN 'train'
    WHEN row_pos < floor(n_all * CAST(0.7 AS DOUBLE)) + floor(n_all * CAST(0.15 AS DOUBLE)) THEN 'val'
    ELSE 'test' END AS fold FROM rk),
train AS (SELECT * FROM split WHERE fold = 'train')"""


def engineered(spark, sf_dir, only=None):
    c = base.cleaned(spark, sf_dir, only=only)
    return FE.add_engineered(c, C.rare_types(c))


def split(spark, sf_dir, only=None):
    """Trainable rows with their chronological fold, sorted and written once per
    input snapshot by the split itself.

    ``only`` names the columns a query reads besides key, date, position and fold, and
    no others are sorted and written; the whole table is used where it is there already."""
    def build():
        rows = FE.trainable(engineered(spark, sf_dir, only))
        return FE.chronological_split(rows if only is None else rows.select("Property_ID", "Date_parsed", *only))
    if only is None:
        return base.once(spark, sf_dir, "split", build)
    return base.once(spark, sf_dir, f"split:{','.join(only)}", build, instead="split")


@register("new_build_rare", O.with_cleaned(FEAT_CTES + """
SELECT Property_ID, Status, Last_Updated, Property_Type, is_new_build FROM eng"""))
def q_new_build(spark, sf_dir):
    return engineered(spark, sf_dir).select("Property_ID", "Status", "Last_Updated",
                                            "Property_Type", "is_new_build")


@register("trainable", O.with_cleaned(FEAT_CTES + """
SELECT Property_ID, Date_parsed, Numeric_Price FROM tr"""))
def q_trainable(spark, sf_dir):
    return FE.trainable(engineered(spark, sf_dir)).select("Property_ID", "Date_parsed", "Numeric_Price")


@register("time_split", O.with_cleaned(FEAT_CTES + """
SELECT Property_ID, CAST(row_pos AS BIGINT) AS row_pos, fold FROM split"""))
def q_time_split(spark, sf_dir):
    return split(spark, sf_dir).select("Property_ID", "row_pos", "fold")


@register("fold_summary", O.with_cleaned(FEAT_CTES + """
SELECT fold, CAST(count(*) AS BIGINT) AS n, min(Date_parsed) AS min_date, max(Date_parsed) AS max_date,
  quantile_cont(Numeric_Price, 0.5) AS median_price FROM split GROUP BY fold"""))
def q_fold_summary(spark, sf_dir):
    return FE.fold_summary(split(spark, sf_dir))


@register("train_medians", O.with_cleaned(FEAT_CTES + " UNION ALL ".join(
    f"{'SELECT' if i else ' SELECT'} '{c}' AS column, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median FROM train"
    for i, c in enumerate(NUMERIC_FEATURES))))
def q_medians(spark, sf_dir):
    tr = split(spark, sf_dir).where("fold = 'train'")
    return FE.fit_medians(tr)


@register("suburb_freq", O.with_cleaned(FEAT_CTES + """
SELECT Suburb, CAST(count(*) AS BIGINT) AS freq FROM train WHERE Suburb IS NOT NULL GROUP BY Suburb"""))
def q_suburb_freq(spark, sf_dir):
    return FE.fit_suburb_freq(split(spark, sf_dir).where("fold = 'train'"))


@register("type_vocab", O.with_cleaned(FEAT_CTES + """
SELECT DISTINCT Property_Type FROM train WHERE Property_Type IS NOT NULL ORDER BY Property_Type"""))
def q_vocab(spark, sf_dir):
    return FE.fit_vocabulary(split(spark, sf_dir).where("fold = 'train'"))


def _fm_sql():
    med = "meds AS (SELECT " + ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in NUMERIC_FEATURES) + " FROM train)"
    cols = ", ".join(f"coalesce(CAST(s.{c} AS DOUBLE), m_{c}) AS {c}" for c in NUMERIC_FEATURES)
    return O.with_cleaned(FEAT_CTES + f""",
{med},
freq AS (SELECT Suburb, count(*) AS freq FROM train WHERE Suburb IS NOT NULL GROUP BY Suburb),
vocab AS (SELECT DISTINCT Property_Type FROM train WHERE Property_Type IS NOT NULL)
SELECT s.Property_ID, {cols}, CAST(s.Year AS DOUBLE) AS Year, CAST(s.Month AS DOUBLE) AS Month,
  CAST(coalesce(s.is_land, 0) AS DOUBLE) AS is_land, CAST(coalesce(s.out_of_metro, 0) AS DOUBLE) AS out_of_metro,
  CAST(coalesce(s.is_new_build, 0) AS DOUBLE) AS is_new_build,
  CAST(coalesce(freq.freq, 0) AS DOUBLE) AS Suburb_freq,
  CASE WHEN s.Property_Type IN (SELECT Property_Type FROM vocab) THEN 1.0 ELSE 0.0 END AS n_onehot,
  CASE WHEN s.Property_Type IN (SELECT Property_Type FROM vocab) THEN 'PT_' || s.Property_Type END AS pt_hot
FROM split s CROSS JOIN meds LEFT JOIN freq ON s.Suburb = freq.Suburb""")


def feature_matrix(spark, sf_dir):
    sp = split(spark, sf_dir)
    prep = FE.fit_preprocessor(sp.where("fold = 'train'"))
    return FE.transform(sp, prep), prep


@register("feature_matrix", _fm_sql())
def q_feature_matrix(spark, sf_dir):
    fm, prep = feature_matrix(spark, sf_dir)
    pts = [f"PT_{t}" for t in prep.vocabulary]
    hot = F.coalesce(*[F.when(F.col(f"`{c}`") == 1.0, F.lit(c)) for c in pts], F.lit(None)) \
        if pts else F.lit(None).cast("string")
    n1 = reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in pts]) if pts else F.lit(0.0)
    base_cols = [c for c in prep.feature_order if not c.startswith("PT_")]
    return fm.select("Property_ID", *base_cols, n1.alias("n_onehot"), hot.alias("pt_hot"))


@register("feature_nulls", O.with_cleaned(FEAT_CTES + " UNION ALL ".join(
    f"{'SELECT' if i else ' SELECT'} '{c}' AS column, CAST(0 AS BIGINT) AS n_null" for i, c in enumerate(
        list(NUMERIC_FEATURES) + ["Year", "Month", "is_land", "out_of_metro", "is_new_build", "Suburb_freq"]))))
def q_feature_nulls(spark, sf_dir):
    fm, prep = feature_matrix(spark, sf_dir)
    cols = [c for c in prep.feature_order if not c.startswith("PT_")]
    return FE.feature_nulls(fm, cols)
