"""Readers for the reference's input formats.

Schemas are always explicit; CSV dialects are probed from the header line
only; string-typed reference tables are coerced with ``try_cast``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estatelens.params import NULL_TOKENS

RAW_SCHEMA = T.StructType([
    T.StructField("Property_ID", T.StringType()), T.StructField("Status", T.StringType()),
    T.StructField("Full_Address", T.StringType()), T.StructField("Suburb", T.StringType()),
    T.StructField("Postcode", T.IntegerType()), T.StructField("Property_Type", T.StringType()),
    T.StructField("Date", T.StringType()), T.StructField("Beds", T.DoubleType()),
    T.StructField("Baths", T.DoubleType()), T.StructField("Car_Spaces", T.DoubleType()),
    T.StructField("LandSize_sqm", T.DoubleType()), T.StructField("Propertycount", T.LongType()),
    T.StructField("Raw_Price", T.StringType()), T.StructField("Numeric_Price", T.DoubleType()),
    T.StructField("Latitude", T.DoubleType()), T.StructField("Longitude", T.DoubleType()),
    T.StructField("Distance_to_CBD_km", T.DoubleType()), T.StructField("URL", T.StringType()),
    T.StructField("Last_Updated", T.DateType()),
])
ENRICHED_EXTRA = [
    T.StructField("abs_median_income_weekly", T.DoubleType()),
    T.StructField("abs_median_age", T.DoubleType()), T.StructField("abs_population", T.DoubleType()),
    T.StructField("crime_offence_count", T.DoubleType()),
    T.StructField("crime_rate_per_100k", T.DoubleType()),
    T.StructField("dist_nearest_train_km", T.DoubleType()),
]
ENRICHED_SCHEMA = T.StructType(RAW_SCHEMA.fields + ENRICHED_EXTRA)

# Dialects tried in order (Spark rejects "cp1252" as a CSV encoding name,
# ISO-8859-1 reads the same bytes for the characters listings use).
DIALECTS = [("UTF-8", ","), ("UTF-8", "\t"), ("ISO-8859-1", ","), ("ISO-8859-1", "\t")]


def _clean_name(c: str) -> str:
    return c.strip().lstrip("\ufeff").strip()


def _decodes_cleanly(spark: SparkSession, path: str, enc: str) -> bool:
    """Every line of the input is valid in ``enc`` (one distributed pass)."""
    if enc.upper().startswith("ISO-8859"):
        return True                      # every byte sequence is valid Latin-1
    return spark.read.text(path).where(~F.expr("is_valid_utf8(value)")).isEmpty()


def probe_dialect(spark: SparkSession, path: str, required: Sequence[str] = ("Postcode", "Suburb"),
                  utf8: bool | None = None) -> tuple[str, str]:
    """A1: first (encoding, separator) whose header holds the required names
    and in which the whole input decodes; ``utf8`` tells whether it does in UTF-8, where that is known."""
    first = spark.read.text(path).first()
    for enc, sep in DIALECTS if first is not None else ():
        names = [_clean_name(x) for x in first[0].split(sep)]
        if not all(r in names for r in required):
            continue
        if utf8 if enc == "UTF-8" and utf8 is not None else _decodes_cleanly(spark, path, enc):
            return enc, sep
    raise ValueError(f"no CSV dialect of {path} has columns {list(required)}")


def _typed(c: Column, t: T.DataType) -> Column:
    """A cell as ``t``; null tokens, NaN and cells that do not parse are null."""
    if isinstance(t, T.IntegralType):        # "3101.0" is 3101
        return F.trim(c).try_cast("double").try_cast(t)
    if isinstance(t, T.FractionalType):
        return F.nullif(F.trim(c).try_cast(t), F.lit(float("nan")).cast(t))
    if isinstance(t, T.DateType):            # no null token is a number or a date
        return F.trim(c).try_cast(t)
    c = F.when(~F.trim(c).isin(*NULL_TOKENS), c)
    return c if isinstance(t, T.StringType) else F.trim(c).try_cast(t)


def read_listings_csv(spark: SparkSession, path: str,
                      schema: T.StructType = ENRICHED_SCHEMA) -> DataFrame:
    """A1 + A2 + T1/T3/T4: dialect probe, every cell read as a string and cast
    afterwards, so that a bad cell is null and never costs its row.  Rows with
    more fields than the header are dropped (separators inside quotes do not
    count), short rows are padded with nulls.  Quoted line breaks are kept: a file
    with a line of an odd number of quotes is read record by record, all other
    files in splits."""
    file = F.col("_metadata.file_path")
    # "replace" and byte lengths are a fraction of the time of "translate" and lengths in characters
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"')))
    lines = spark.read.text(path).select(file.alias("file"), (~F.expr("is_valid_utf8(value)")).alias("bad"), (quotes % 2 == 1).alias("open"))
    # one pass for both; at most three rows a file, no more than the driver lists to plan the read
    faults = lines.where("bad OR open").distinct().collect()
    enc, sep = probe_dialect(spark, path, utf8=not any(r["bad"] for r in faults))
    unsplit = sorted({r["file"] for r in faults if r["open"]})
    names = [_clean_name(x) for x in spark.read.text(path).first()[0].split(sep)]
    fields = {f.name: f.dataType for f in schema.fields}
    file_schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_corrupt"]])

    def read(multi_line: bool) -> DataFrame:
        return (spark.read.schema(file_schema).option("header", True).option("sep", sep)
                .option("encoding", enc).option("mode", "PERMISSIVE").option("escape", '"')
                .option("multiLine", multi_line)
                .option("columnNameOfCorruptRecord", "_corrupt").option("enforceSchema", True).csv(path))

    df = read(False)
    if unsplit:
        df = df.where(~file.isin(unsplit)).unionByName(read(True).where(file.isin(unsplit)))
    # all columns are strings: only a wrong number of fields marks a row
    bare = F.regexp_replace("_corrupt", '"(?:[^"]|"")*"', "")
    too_long = F.size(F.split(bare, sep, -1)) > len(names)
    dropped = F.coalesce(F.col("_corrupt").isNotNull() & too_long, F.lit(False))
    # never true: a count of the rows would else read the corrupt column alone, which Spark refuses
    dropped = dropped | F.coalesce(F.length(F.col(f"`{names[0]}`")) < 0, F.lit(False))
    df = df.where(~dropped).drop("_corrupt")
    return df.select(*[_typed(F.col(f"`{n}`"), fields.get(n, T.StringType())).alias(n) for n in names])


def read_string_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A3/A5: header CSV with every column as a string (coerce later)."""
    return spark.read.option("header", True).option("sep", sep).csv(path)


def read_feed_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A4: one table of every unpacked transit feed under ``root``
    (``root/feed_id=<feed>/<table>`` or ``root/<feed>/<table>``); the feed id
    comes from the file path.  Each feed has its own column order: files are
    grouped by header (one line per feed is looked at) and joined by name."""
    files = spark.read.option("basePath", root).text(f"{root}/*/{table}").inputFiles()
    by_header: dict[str, list[str]] = {}
    for f in sorted(files):
        first = spark.read.text(f).first()
        if first is not None:
            by_header.setdefault(first[0], []).append(f)
    out = None
    for paths in by_header.values():
        df = spark.read.option("header", True).option("basePath", root).csv(paths)
        df = df.toDF(*[_clean_name(c) for c in df.columns])
        if "feed_id" not in df.columns:
            df = df.withColumn("feed_id", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no {table} under {root}")
    return out


def read_geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON boundaries, either one Feature per line or a
    FeatureCollection per line or file; ``coordinates`` is their JSON text."""
    feature = "struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"
    schema = f"properties map<string,string>, geometry struct<type:string,coordinates:string>, features array<{feature}>"
    broken = spark.read.text(path).where("trim(value) <> '' AND try_parse_json(value) IS NULL")
    lines = spark.read.schema(schema).option("multiLine", not broken.isEmpty()).json(path)
    one = F.when(F.col("geometry").isNotNull(), F.array(F.struct("properties", "geometry")))
    f = lines.select(F.explode(F.coalesce("features", one)).alias("f")).select("f.*")
    name = F.coalesce(F.col("properties")["Suburb"], F.col("properties")["suburb"])
    return f.select(name.alias("suburb_key"), F.col("geometry.type").alias("geom_type"),
                    F.col("geometry.coordinates").alias("coordinates"))
