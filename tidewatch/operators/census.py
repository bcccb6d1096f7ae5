"""Census feature operators (F-13, D-08 .. D-11, J-06, J-07, J-17, A-03, A-12)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import config as C
from tidewatch.functions.numeric import clip, round_half_even, safe_div, weighted_sum
from tidewatch.functions.text import extract_zip_codes, normalize_text
from tidewatch.operators.scoring import minmax_scores

ACS_NUMERIC = ["population", "median_income", "poverty_universe", "poverty_count", "housing_units",
               "occupied_units", "vacant_units", "no_vehicle_owner", "no_vehicle_renter"]


def drop_sentinels(df: DataFrame, cols=ACS_NUMERIC) -> DataFrame:
    """F-07 + F-13: numeric coercion, then ACS sentinel codes -> null."""
    sentinels = [F.lit(float(s)) for s in C.ACS_SENTINELS]
    out = {}
    for c in cols:
        x = F.col(c).try_cast("double")
        out[c] = F.when(~x.isin(*sentinels), x)
    return df.withColumns(out)


def add_risk_features(df: DataFrame) -> DataFrame:
    """D-09 rates, D-08 min-max scores, D-10 baseline risk index (0-100, 1 decimal, half-even)."""
    df = df.withColumns({
        "poverty_rate": safe_div("poverty_count", "poverty_universe"),
        "no_vehicle_rate": safe_div(F.col("no_vehicle_owner") + F.col("no_vehicle_renter"), F.col("occupied_units")),
        "vacancy_rate": safe_div("vacant_units", "housing_units"),
    })
    df = minmax_scores(df, [
        ("population", "score_population", False),
        ("poverty_rate", "score_poverty", False),
        ("median_income", "score_income_vulnerability", True),
        ("no_vehicle_rate", "score_transport_vulnerability", False),
        ("vacancy_rate", "score_housing_vulnerability", False),
    ])
    raw = weighted_sum(list(C.CENSUS_RISK_WEIGHTS.items()), fill_missing=0.0)
    return (df.withColumn("risk_index_raw", raw)
              .withColumn("risk_index", round_half_even(F.col("risk_index_raw") * 100.0, 1)))


def town_lookup(towns: DataFrame) -> DataFrame:
    """Town table with municipio_key (T-01) and zip_list (T-06)."""
    return (towns.withColumn("municipio_key", normalize_text("municipio"))
                 .withColumn("zip_list", extract_zip_codes("zip_codes_text")))


def zctas_in_towns(zcta: DataFrame, towns: DataFrame) -> DataFrame:
    """J-17 + A-18: ZCTAs whose code appears in any town's ZIP list (semi join)."""
    zips = towns.select(F.explode("zip_list").alias("zip_code"))
    return zcta.join(zips, "zip_code", "left_semi")


ZIP_FEATURES = ["risk_index", "population", "median_income", "poverty_rate", "no_vehicle_rate", "vacancy_rate"]
TOWN_KEYS = ["designated_area", "municipio", "municipio_key", "latitude", "longitude"]


def town_risk(towns: DataFrame, zcta_risk: DataFrame, muni_risk: DataFrame) -> DataFrame:
    """R-02 + J-06 + A-03 + J-07 + D-11: town features from ZIP and municipio tables.

    Group keys include nullable coordinates; Spark keeps null groups, as
    ``groupby(dropna=False)`` does.  The ZIP side is one row per ZIP code, so
    the explode-then-join never fans out beyond the town's own ZIP list.
    """
    exploded = towns.select(*TOWN_KEYS, F.explode_outer("zip_list").alias("zip_code"))
    zf = zcta_risk.select("zip_code", *ZIP_FEATURES)
    j = exploded.join(zf, "zip_code", "left")
    agg = j.groupBy(*TOWN_KEYS).agg(
        F.count_distinct("zip_code").alias("zip_count"),
        F.avg("risk_index").alias("zip_risk_index"),
        F.coalesce(F.sum("population"), F.lit(0.0)).alias("zip_population"),
        F.avg("median_income").alias("zip_median_income"),
        F.avg("poverty_rate").alias("zip_poverty_rate"),
        F.avg("no_vehicle_rate").alias("zip_no_vehicle_rate"),
        F.avg("vacancy_rate").alias("zip_vacancy_rate"),
    )
    m = muni_risk.select(
        "municipio_key",
        F.col("risk_index").alias("municipio_risk_index"),
        F.col("population").alias("municipio_population"),
        F.col("median_income").alias("municipio_median_income"),
        F.col("poverty_rate").alias("municipio_poverty_rate"),
        F.col("no_vehicle_rate").alias("municipio_no_vehicle_rate"),
        F.col("vacancy_rate").alias("municipio_vacancy_rate"),
    )
    out = agg.join(m, "municipio_key", "left")
    mw, zw = C.TOWN_BLEND
    mr, zr = F.col("municipio_risk_index"), F.col("zip_risk_index")
    blend = (F.when(mr.isNotNull() & zr.isNotNull(), round_half_even(mw * mr + zw * zr, 1))
              .when(mr.isNotNull(), round_half_even(mr, 1))
              .when(zr.isNotNull(), round_half_even(zr, 1)))
    return out.withColumn("risk_index", blend)


def municipio_centroids(town_risk_df: DataFrame) -> DataFrame:
    """A-12 / Q13: per municipio_key, the coordinates of the town with the
    smallest designated_area (the first row after the grouped sort)."""
    w = Window.partitionBy("municipio_key").orderBy(F.col("designated_area").asc_nulls_first())
    return (town_risk_df.select("municipio_key", "municipio", "designated_area", "latitude", "longitude")
            .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select("municipio_key", "municipio", "latitude", "longitude"))
