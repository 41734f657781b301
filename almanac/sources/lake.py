"""Clean-zone tables: scans, catalog registration, views and small lookups of stored files."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the clean tables and the years visible through them (fixed values).
GHO_COLUMNS = "country_code string, indicator_code string, value double, year int"
BANK_COLUMNS = "country_code string, indicator_id string, value double, year int"
NOTICE_COLUMNS = (
    "outbreak_id string, title string, summary string, overview string, disease string, "
    "country string, country_iso2 string, country_iso3 string, publication_date timestamp, "
    "source_url string, year int"
)
TABLES = {
    "life_expectancy": (GHO_COLUMNS, (2000, 2025)),
    "malaria_incidence": (GHO_COLUMNS, (2000, 2025)),
    "cholera": (GHO_COLUMNS, (2000, 2025)),
    "wb_hospital_beds_per_1000": (BANK_COLUMNS, (2000, 2025)),
    "wb_physicians_per_1000": (BANK_COLUMNS, (2000, 2025)),
    "who_outbreaks": (NOTICE_COLUMNS, (2000, 2030)),
}
UNION_VIEWS = {
    "who_indicators": ["life_expectancy", "malaria_incidence", "cholera"],
    "worldbank_indicators": ["wb_hospital_beds_per_1000", "wb_physicians_per_1000"],
}


def read_clean(spark: SparkSession, base: str, dataset: str) -> DataFrame:
    """A clean dataset with `year` from its partition folders; an empty one is an error."""
    path = f"{base.rstrip('/')}/{dataset}"
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no parquet files for {dataset} at {path}") from error
    return table


def within_years(df: DataFrame, years: tuple[int, int]) -> DataFrame:
    return df.where(F.col("year").between(*years))


def _read_table(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """The dataset with its declared columns, None if its folder is absent."""
    schema = T.StructType.fromDDL(TABLES[name][0])
    try:
        return spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{name}")
    except AnalysisException:
        return None


def register_views(spark: SparkSession, base: str) -> list[str]:
    """A temporary view per dataset found, limited to its years, and the two union views.

    Fails if there is no dataset at all.
    """
    found = []
    for name, (_, years) in TABLES.items():
        table = _read_table(spark, base, name)
        if table is not None:
            within_years(table, years).createOrReplaceTempView(name)
            found.append(name)
    if not found:
        raise FileNotFoundError(f"no dataset found under {base}")
    for view, parts in UNION_VIEWS.items():
        present = [p for p in parts if p in found]
        if present:
            code = "indicator_code" if view == "who_indicators" else "indicator_id"
            selects = [f"SELECT country_code, {code}, year, value FROM {p}" for p in present]
            spark.sql(" UNION ALL ".join(selects)).createOrReplaceTempView(view)
            found.append(view)
    return found


def create_tables(spark: SparkSession, database: str, base: str) -> list[str]:
    """External partitioned tables over the clean zone, with partitions found on disk.

    Tables hold all years; views made by `register_views` apply the visible range.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = []
    for name, (columns, _) in TABLES.items():
        if _read_table(spark, base, name) is None:
            continue
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) "
            f"USING parquet PARTITIONED BY (year) LOCATION '{base.rstrip('/')}/{name}'"
        )
        repair_partitions(spark, f"{database}.{name}")
        made.append(name)
    return made


def repair_partitions(spark: SparkSession, table: str) -> None:
    """Register partition folders added outside the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def read_first(spark: SparkSession, roots: list[str], name: str, schema: str | None = None) -> DataFrame:
    """The file or folder `name` under the first root that has it, read by its suffix.

    Parquet and CSV are known; another suffix is tried as Parquet, then as CSV. With no
    match the result is empty.
    """
    is_csv = name.lower().endswith((".csv", ".txt"))
    for root in roots:
        path = f"{root.rstrip('/')}/{name}"
        for kind in ("csv",) if is_csv else ("parquet", "csv"):
            options = {"header": True, "inferSchema": True} if kind == "csv" else {}
            try:
                return spark.read.options(**options).format(kind).load(path)
            except AnalysisException:
                continue
    return spark.createDataFrame([], schema or "value string")


def read_metadata(spark: SparkSession, roots: list[str], name: str = "metadata.json") -> dict:
    """A small metadata document, {} if there is none."""
    for root in roots:
        try:
            row = spark.read.text(f"{root.rstrip('/')}/{name}", wholetext=True).first()
            return json.loads(row["value"]) if row else {}
        except AnalysisException:
            continue
        except json.JSONDecodeError:
            return {}
    return {}
