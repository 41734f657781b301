"""Parsers from raw JSON documents to clean rows.

A parser takes a frame with a `body` column and returns one row per record with the
columns of `keep` carried along. Documents of the wrong shape give no rows; use
`readable` to tell them apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.functions.countries import with_country
from almanac.functions.dates import parse_utc
from almanac.functions.hashing import row_key
from almanac.functions.numbers import to_number
from almanac.functions.text import country_candidates, disease_from_title, html_to_text, or_null

GHO_RECORDS = (
    "array<struct<SpatialDim:string,SpatialDimType:string,TimeDim:string,NumericValue:string,"
    "IndicatorCode:string>>"
)
BANK_RECORDS = (
    "array<struct<countryiso3code:string,country:struct<id:string,value:string>,date:string,"
    "value:string,indicator:struct<id:string,value:string>>>"
)
NOTICE_RECORDS = (
    "array<struct<Id:string,DonId:string,SystemSourceKey:string,Title:string,MetaTitle:string,"
    "Summary:string,Overview:string,PublicationDate:string,ItemDefaultUrl:string,"
    "regionscountries:string,Countries:string,healthtopics:string,Diseases:string>>"
)
WHOLE_YEAR = r"^\s*[+-]?\d+\s*$"


def readable(body: Column) -> Column:
    """Whether the text is JSON at all."""
    return F.get_json_object(body, "$").isNotNull()


def _records(df: DataFrame, shape: str, keep: list[str], bare_list: bool = False) -> DataFrame:
    """Records of `{"value": [...]}`, or of a document that is the list itself."""
    if bare_list:
        records = F.from_json("body", shape)
    else:
        records = F.from_json("body", f"struct<value:{shape}>")["value"]
    return df.select(*keep, F.explode(records).alias("r")).where("r is not null")


def _year(text: Column) -> Column:
    """Whole-number text, or a number cut to its whole part; else NULL."""
    return F.when(text.rlike(WHOLE_YEAR), F.trim(text).try_cast("int")).otherwise(
        F.when(text.rlike(r"^-?\d+\.\d+$"), text.try_cast("double").try_cast("int"))
    )


def real_country(code: Column) -> Column:
    """Three-character codes only; two-letter codes and blanks are not countries."""
    return F.coalesce(F.length(code) == 3, F.lit(False))


def parse_gho(
    df: DataFrame,
    keep: list[str] | None = None,
    allow_list_root: bool = False,
    countries_only: bool = False,
    from_year: int | None = None,
) -> DataFrame:
    """Indicator documents `{"value": [...]}`: rows with a whole year and a country code.

    A NULL value is kept. `allow_list_root` also reads documents that are a bare list.
    `countries_only` and `from_year` apply the filters of the source's query interface to
    documents that were fetched without them.
    """
    keep = keep or []
    rows = _records(df, GHO_RECORDS, keep)
    if allow_list_root:
        bare = df.where(F.col("body").rlike(r"^\s*\["))
        rows = rows.unionByName(_records(bare, GHO_RECORDS, keep, bare_list=True))
    if countries_only:
        rows = rows.where(F.col("r.SpatialDimType") == "COUNTRY")
    parsed = rows.select(
        *keep,
        F.col("r.SpatialDim").alias("country_code"),
        _year(F.col("r.TimeDim")).alias("year"),
        to_number(F.col("r.NumericValue")).alias("value"),
        F.col("r.IndicatorCode").alias("indicator_code"),
    ).where(real_country(F.col("country_code")) & F.col("year").isNotNull())
    return parsed if from_year is None else parsed.where(F.col("year") >= from_year)


def _bank_rows(df: DataFrame, keep: list[str]) -> DataFrame:
    # [meta, [records]]; a bare list of records is read too
    paired = F.get_json_object("body", "$[1]")
    source = F.when(F.ltrim(paired).startswith("["), paired).otherwise(F.col("body"))
    return df.select(*keep, F.explode(F.from_json(source, BANK_RECORDS)).alias("r")).where("r is not null")


def parse_world_bank(
    df: DataFrame, keep: list[str] | None = None, labels: bool = False, drop_null: bool = False
) -> DataFrame:
    """World Bank documents `[meta, [...]]`: rows with a year and a three-character code.

    `labels` adds country name and indicator label and takes the country id where the code
    is empty; `drop_null` leaves out rows without a value.
    """
    keep = keep or []
    code = or_null(F.col("r.countryiso3code"))
    if labels:
        code = F.coalesce(code, F.col("r.country.id"))
    columns = [
        code.alias("country_code"),
        _year(F.col("r.date")).alias("year"),
        to_number(F.col("r.value")).alias("value"),
        F.col("r.indicator.id").alias("indicator_id"),
    ]
    if labels:
        columns.insert(1, F.col("r.country.value").alias("country_name"))
        columns.append(F.col("r.indicator.value").alias("indicator_label"))
    rows = _bank_rows(df, keep).select(*keep, *columns)
    rows = rows.where(real_country(F.col("country_code")) & F.col("year").isNotNull())
    return rows.where(F.col("value").isNotNull()) if drop_null else rows


def unreadable_years(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """World Bank records whose date is neither empty nor a whole year, for quarantine."""
    keep = keep or []
    date = or_null(F.col("r.date"))
    return _bank_rows(df, keep).where(date.isNotNull() & ~date.rlike(WHOLE_YEAR)).select(
        *keep, F.to_json("r").alias("record")
    )


def notice_records(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """All records of outbreak documents (`r`) with their publication date, NULL where it cannot be read."""
    return _records(df, NOTICE_RECORDS, keep or []).withColumn("publication_date", parse_utc(F.col("r.PublicationDate")))


def undated_notices(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The records without a readable date, for quarantine, and whether they had a date text at all."""
    reason = F.when(or_null(F.col("r.PublicationDate")).isNull(), "no date").otherwise("unreadable date")
    return records.where("publication_date is null").select(
        *(keep or []), F.to_json("r").alias("record"), reason.alias("reason")
    )


def parse_outbreaks(
    df: DataFrame, countries: DataFrame, keep: list[str] | None = None
) -> DataFrame:
    """Outbreak documents: rows with a readable publication date, markup turned to text.

    Disease and country come from the title; the country dimension resolves names.
    """
    return outbreak_rows(notice_records(df, keep), countries, keep)


def outbreak_rows(records: DataFrame, countries: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows of the dated ones of `notice_records`; the others are those of `undated_notices`."""
    keep = keep or []
    rows = records.where("publication_date is not null")
    title = or_null(F.col("r.Title"))
    titled = rows.withColumn("_title_text", title)
    resolved = with_country(titled, "_title_text", country_candidates(F.col("_title_text")), countries, "_country")
    return resolved.select(
        *keep,
        F.coalesce(or_null(F.col("r.Id")), F.col("r.DonId")).alias("outbreak_id"),
        html_to_text("r.Title").alias("title"),
        html_to_text("r.Summary").alias("summary"),
        html_to_text("r.Overview").alias("overview"),
        disease_from_title(title).alias("disease"),
        F.col("_country.name").alias("country"),
        F.col("_country.alpha_2").alias("country_iso2"),
        F.col("_country.alpha_3").alias("country_iso3"),
        "publication_date",
        F.col("r.ItemDefaultUrl").alias("source_url"),
        F.year("publication_date").alias("year"),
    )


def _first_item(text: Column) -> Column:
    """The first element of a JSON list, or the plain text itself."""
    listed = F.from_json(text, "array<string>")
    return F.when(F.ltrim(text).startswith("["), F.get(listed, F.lit(0))).otherwise(text)


def normalise_notices(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Notices for the flat export: first usable key, title and topic.

    A notice without any key gets a hash of its fields, which is the same on every retry.
    """
    keep = keep or []
    rows = _records(df, NOTICE_RECORDS, keep)
    own_key = row_key(F.col("r.Title"), F.col("r.Summary"), F.col("r.PublicationDate"))
    return rows.select(
        *keep,
        F.coalesce(or_null(F.col("r.SystemSourceKey")), or_null(F.col("r.Id")), own_key).alias("outbreak_id"),
        F.coalesce(or_null(F.col("r.Title")), F.col("r.MetaTitle"), F.lit("")).alias("title"),
        F.coalesce("r.Summary", F.lit("")).alias("summary"),
        F.col("r.PublicationDate").alias("publication_date"),
        _first_item(F.coalesce(or_null(F.col("r.regionscountries")), F.col("r.Countries"))).alias("country_guid"),
        F.coalesce(or_null(F.col("r.healthtopics")), F.col("r.Diseases")).alias("disease_topic"),
    )


Parser = Callable[[DataFrame, list[str]], DataFrame]


BANK_DATASETS = {"wb_hospital_beds_per_1000", "wb_physicians_per_1000"}
NOTICE_DATASETS = {"who_outbreaks"}


def parsers(countries: DataFrame) -> dict[str, Parser]:
    """Dataset name -> parser."""
    return {
        "life_expectancy": parse_gho,
        "malaria_incidence": parse_gho,
        "cholera": parse_gho,
        "wb_hospital_beds_per_1000": parse_world_bank,
        "wb_physicians_per_1000": parse_world_bank,
        "who_outbreaks": lambda df, keep: parse_outbreaks(df, countries, keep),
    }
