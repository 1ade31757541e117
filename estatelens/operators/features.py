"""Feature engineering, chronological split and the preprocessor
(B15-B18, E5, D11-D13, D27, D31, K1, K2, C8).

The fitted preprocessor is a handful of small tables (medians, suburb
frequencies, type vocabulary) produced by aggregates and applied with
joins; the feature matrix stays a DataFrame of named double columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.operators.common import broadcast_checked, global_rank, materialize
from estatelens.operators.quantiles import multi_column_percentiles
from estatelens.params import DEFAULT, FLAG_FEATURES, NUMERIC_FEATURES, TIME_FEATURES, Params


def add_engineered(df: DataFrame, rare: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """B15 then B16: new-build flag from the original type, then rare types
    (a small fitted table, joined by broadcast after a size check) -> Other."""
    nb = F.coalesce(F.col("Property_Type").isin(*p.new_build_types), F.lit(False)).cast("int")
    rare_b = broadcast_checked(rare.select(F.col("Property_Type").alias("__rare")).distinct())
    j = df.withColumn("is_new_build", nb).join(
        rare_b, F.col("Property_Type") == F.col("__rare"), "left")
    return j.withColumn("Property_Type", F.when(F.col("__rare").isNotNull(), F.lit("Other"))
                        .otherwise(F.col("Property_Type"))).drop("__rare")


def trainable(cleaned: DataFrame) -> DataFrame:
    """Sold rows with a price and a parsed date."""
    return cleaned.where((F.col("Status") == "Sold") & F.col("Numeric_Price").isNotNull()
                         & F.col("Date_parsed").isNotNull())


def chronological_split(df: DataFrame, p: Params = DEFAULT, date: str = "Date_parsed",
                        key: str = "Property_ID") -> DataFrame:
    """E5: rows ordered by (date, key); first floor(0.70 n) -> train, next
    floor(0.15 n) -> val, the rest -> test.  Adds ``row_pos`` and ``fold``.
    The rows and the two cuts are written, the result is a projection of these."""
    ranked = global_rank(df, [date, key], "row_pos")
    n = ranked.agg(F.count(F.lit(1)).alias("__n"))
    cut = materialize(n.select(F.floor(F.col("__n") * p.split_train).alias("__nt"),
                               F.floor(F.col("__n") * p.split_val).alias("__nv")), "split-cuts")
    j = ranked.crossJoin(F.broadcast(cut))      # one-row side: always one row
    fold = (F.when(F.col("row_pos") < F.col("__nt"), F.lit("train"))
            .when(F.col("row_pos") < F.col("__nt") + F.col("__nv"), F.lit("val"))
            .otherwise(F.lit("test")))
    return j.withColumn("fold", fold).drop("__nt", "__nv")


def fold_summary(split: DataFrame) -> DataFrame:
    """Rows, date range and median price per fold."""
    from estatelens.operators.quantiles import exact_percentiles
    basic = split.groupBy("fold").agg(F.count(F.lit(1)).alias("n"),
                                      F.min("Date_parsed").alias("min_date"),
                                      F.max("Date_parsed").alias("max_date"))
    med = exact_percentiles(split, ["fold"], "Numeric_Price", {"median_price": 0.5})
    return basic.join(med, "fold", "left")


@dataclass
class Preprocessor:
    medians: DataFrame        # column, median
    suburb_freq: DataFrame    # Suburb, freq
    vocabulary: list          # sorted property types (feature-column order)

    @property
    def feature_order(self) -> list:
        return (list(NUMERIC_FEATURES) + list(TIME_FEATURES) + list(FLAG_FEATURES)
                + ["Suburb_freq"] + [f"PT_{t}" for t in self.vocabulary])


def fit_medians(train: DataFrame) -> DataFrame:
    """Exact median of each numeric feature (long: column, median)."""
    m = multi_column_percentiles(train, [], list(NUMERIC_FEATURES), {"median": 0.5})
    return m.select("column", "median")


def fit_suburb_freq(train: DataFrame) -> DataFrame:
    """Training rows per suburb (null suburb excluded)."""
    return train.where(F.col("Suburb").isNotNull()).groupBy("Suburb") \
        .agg(F.count(F.lit(1)).alias("freq"))


def fit_vocabulary(train: DataFrame) -> DataFrame:
    """Sorted distinct property types."""
    return train.select("Property_Type").where(F.col("Property_Type").isNotNull()) \
        .distinct().orderBy("Property_Type")


def fit_preprocessor(train: DataFrame) -> Preprocessor:
    """K1: fitted on one fold.  The vocabulary (bounded by the number of
    property types) is read to the driver because it defines the column
    list of the feature matrix, as a string indexer would."""
    vocab = [r[0] for r in fit_vocabulary(train).collect()]
    return Preprocessor(materialize(fit_medians(train), "prep-medians"),
                        materialize(fit_suburb_freq(train), "prep-freq"), vocab)


def transform(df: DataFrame, prep: Preprocessor, keep: tuple = ("Property_ID",)) -> DataFrame:
    """K2: median fill, flags null -> 0, Suburb_freq (unseen -> 0), one-hot
    on the fitted vocabulary (unseen -> all zeros); missing input columns
    get the median (numeric) or 0 (time/flag)."""
    med_row = prep.medians.groupBy().pivot("column", list(NUMERIC_FEATURES)).agg(F.first("median"))
    med_row = med_row.select(*[F.col(c).alias(f"__med_{c}") for c in NUMERIC_FEATURES])
    freq = broadcast_checked(prep.suburb_freq.select(F.col("Suburb").alias("__sub"),
                                                     F.col("freq").alias("__freq")),
                             materialized=True)
    j = df.crossJoin(F.broadcast(med_row))     # one-row side: always one row
    j = j.join(freq, F.col("Suburb") == F.col("__sub"), "left")
    cols = [F.col(k) for k in keep if k in df.columns]
    for c in NUMERIC_FEATURES:
        src = F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double")
        cols.append(F.coalesce(src, F.col(f"__med_{c}")).alias(c))
    for c in TIME_FEATURES:
        cols.append((F.col(c).cast("double") if c in df.columns else F.lit(0.0)).alias(c))
    for c in FLAG_FEATURES:
        cols.append((F.coalesce(F.col(c), F.lit(0)).cast("double") if c in df.columns
                     else F.lit(0.0)).alias(c))
    cols.append(F.coalesce(F.col("__freq"), F.lit(0)).cast("double").alias("Suburb_freq"))
    for t in prep.vocabulary:
        cols.append(F.coalesce(F.col("Property_Type") == t, F.lit(False)).cast("double")
                    .alias(f"PT_{t}"))
    return j.select(*cols)


def feature_nulls(features: DataFrame, columns) -> DataFrame:
    """Null count of every feature column (expected all zero)."""
    wide = features.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__c{i}")
                          for i, c in enumerate(columns)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"__c{i}").alias("n_null"))
        for i, c in enumerate(columns)])).alias("r")).select("r.*")
