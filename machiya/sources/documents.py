"""JSON document tables: enveloped or bare lists, nested periods, atomic replacement, and small configuration tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def json_table(spark: SparkSession, path: str, schema: StructType, key: str | None = "properties", required: bool = False) -> DataFrame:
    """Rows of a JSON document that is a list of objects, or an object with such a list under ``key``.

    A missing file gives an empty table, or an error if ``required``; entries that are no objects are dropped; fields
    absent from a row are null.
    """
    if not _exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    text = spark.read.text(path, wholetext=True)
    body = F.parse_json("value")
    rows = F.coalesce(*([F.try_variant_get(body, f"$.{key}", "array<variant>")] if key else []), F.try_variant_get(body, "$", "array<variant>"))
    return text.select(F.explode(rows).alias("v")).where(F.schema_of_variant("v").startswith("OBJECT")).select(F.from_json(F.to_json("v"), schema).alias("r")).select("r.*")


def sale_periods(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """Flat sale rows of a document of periods, each with a map of cities that hold lists of rows; adds city and period.

    A flat list under ``transactions`` is added to them.
    """
    row = StructType([StructField(f, StringType()) for f in fields])
    city = StructType([StructField("name", StringType()), StructField("data", ArrayType(row))])
    period = StructType([StructField("period", StringType()), StructField("cities", MapType(StringType(), city))])
    schema = StructType([StructField("periods", ArrayType(period)), StructField("transactions", ArrayType(row))])
    doc = spark.read.option("multiLine", True).schema(schema).json(path)
    nested = doc.select(F.explode("periods").alias("p")).select("p.period", F.explode("p.cities").alias("k", "c"))
    nested = nested.select(F.coalesce("c.name", "k").alias("_cityName"), F.col("period").alias("_period"), F.explode("c.data").alias("r")).select("r.*", "_cityName", "_period")
    return nested.unionByName(doc.select(F.explode("transactions").alias("r")).select("r.*"), allowMissingColumns=True)


def replace_table(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Replace a table at once: write beside it, then swap directories; a failed write leaves the old table.

    ``path`` may be the table that ``df`` reads.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    tag = uuid.uuid4().hex
    fresh, old = f"{path}.new-{tag}", f"{path}.old-{tag}"
    df.write.format(format).save(fresh)
    had = fs.exists(Path(path))
    if had and not fs.rename(Path(path), Path(old)):
        raise OSError(f"cannot move {path}")
    if not fs.rename(Path(fresh), Path(path)):
        if had:
            fs.rename(Path(old), Path(path))
        raise OSError(f"cannot place {path}")
    if had:
        fs.delete(Path(old), True)


def search_targets(config: DataFrame) -> DataFrame:
    """Enabled targets of a configuration (name, url, area, enabled): bad addresses and repeated ones are dropped."""
    ok = config.where(F.coalesce("enabled", F.lit(True)) & F.col("url").rlike(r"(?i)^https?://[^\s/]+"))
    return ok.groupBy("url").agg(F.min_by(F.struct(*[c for c in config.columns if c != "url"]), "name").alias("c")).select("url", "c.*")


def recent_quarters(spark: SparkSession, year: int, quarter: int, count: int = 8) -> DataFrame:
    """(period, year, quarter, age): the last completed quarters before the given one, newest first."""
    at = F.lit(year * 4 + quarter - 1) - F.col("id") - 1
    rows = spark.range(count).select(F.floor(at / 4).cast("int").alias("year"), (F.pmod(at, F.lit(4)) + 1).cast("int").alias("quarter"), F.col("id").cast("int").alias("age"))
    return rows.select(F.concat("year", F.lit("Q"), "quarter").alias("period"), "year", "quarter", "age")


def retrieval_plan(cities: DataFrame, quarters: DataFrame, stored: DataFrame) -> DataFrame:
    """(city, period, status): the newest quarter to ask for per city, unless it is stored already.

    ``stored`` has (city, period).  Cities whose newest quarter is stored are ``already_stored``.
    """
    newest = quarters.orderBy("age").limit(1).select("period")
    plan = cities.select("city").distinct().crossJoin(F.broadcast(newest))
    have = stored.select(F.col("city").alias("_c"), F.col("period").alias("_p")).distinct()
    joined = plan.join(have, (F.col("city") == F.col("_c")) & (F.col("period") == F.col("_p")), "left")
    return joined.select("city", "period", F.when(F.col("_c").isNotNull(), "already_stored").otherwise("to_fetch").alias("status"))


def first_answers(attempts: DataFrame) -> DataFrame:
    """(city, period, rows, status) from attempts (city, age, period, status_code, rows): the outcome per city.

    Attempts run from the newest quarter on; a missing quarter (404) leads to the next older one, an error ends the
    city, and a city whose quarters are all missing has no data in the window.
    """
    stop = F.when(F.col("status_code") != 404, F.struct("age", "period", "status_code", "rows"))
    first = attempts.groupBy("city").agg(F.min(stop).alias("f"))
    status = F.when(F.col("f").isNull(), "no_data_in_search_window").when(F.col("f.status_code") != 200, "error").when(F.col("f.rows") == 0, "success_zero_records").otherwise("success")
    return first.select("city", "f.period", "f.rows", status.alias("status"))
