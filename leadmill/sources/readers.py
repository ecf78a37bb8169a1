"""Readers for landed files: CSV, text, JSON pages and payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from leadmill.functions import json_features as J

# names under which exports carry the address, in order of preference (fixed values)
EMAIL_COLUMN_NAMES = ["email", "email_address", "e_mail", "contact_email", "lead_email"]


def read_csv(spark: SparkSession, path: str, schema: TY.StructType, corrupt: str = "_corrupt_record") -> DataFrame:
    """CSV with header and a fixed schema; lines that do not fit are kept with their text in ``corrupt``."""
    full = TY.StructType([*schema.fields, TY.StructField(corrupt, TY.StringType())])
    return (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt).csv(path))


def good_lines(df: DataFrame, corrupt: str = "_corrupt_record") -> DataFrame:
    return df.filter(F.col(corrupt).isNull()).drop(corrupt)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int,
              properties: dict[str, str]) -> DataFrame:
    """Database table in parallel ranges of a numeric key."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high, numPartitions=parts, properties=properties)


def first_non_empty(candidates: Sequence[tuple[str, DataFrame]]) -> tuple[str, DataFrame] | None:
    """First candidate with a row; each probe stops at one row."""
    for name, df in candidates:
        if not df.limit(1).isEmpty():
            return name, df
    return None


def emails_from_text(spark: SparkSession, path: str) -> DataFrame:
    """One address per line; lines without ``@`` are skipped."""
    line = F.trim("value")
    return spark.read.text(path).filter(F.contains("value", F.lit("@"))).select(line.alias("email"))


def email_column(columns: Sequence[str]) -> str | None:
    """The address column by its usual names, else the first whose name contains ``email``."""
    lower = {c.lower(): c for c in columns}
    for name in EMAIL_COLUMN_NAMES:
        if name in lower:
            return lower[name]
    return next((c for c in columns if "email" in c.lower()), None)


def emails_from_table(df: DataFrame, column: str | None = None) -> DataFrame:
    """Distinct addresses of the detected column."""
    name = column or email_column(df.columns)
    if name is None:
        raise ValueError("no address column found")
    return df.select(F.trim(F.col(name)).alias("email")).filter(F.contains("email", F.lit("@"))).dropDuplicates()


# --- landed JSON -----------------------------------------------------------------------
def unwrap_page(document: Column, item: str) -> Column:
    """Items of an API page: an ``items`` list, a bare list or a single object."""
    listed = F.from_json(F.get_json_object(document, "$.items"), f"array<{item}>")
    bare = J.parse_array(document, f"array<{item}>")
    single = F.array(J.parse_object(document, item))
    return F.coalesce(listed, bare, single)


LEAD_ITEM = ("struct<id:string, campaign_id:string, email:string, first_name:string, last_name:string, company:string, title:string, "
             "industry:string, status:string, open_rate:string, click_rate:string, reply_rate:string, bounce_rate:string, "
             "last_activity_date:string, created_date:string>")


def normal_leads(df: DataFrame, column: str) -> DataFrame:
    """One row per lead of the batches: names, rates with default 0, and the lead as JSON."""
    batch = F.from_json(F.get_json_object(column, "$.data"), f"array<{LEAD_ITEM}>")
    lead = df.select(F.explode(batch).alias("lead"))
    rates = [F.coalesce(F.col(f"lead.{r}").try_cast("double"), F.lit(0.0)).alias(r)
             for r in ("open_rate", "click_rate", "reply_rate", "bounce_rate")]
    plain = [F.col(f"lead.{c}") for c in ("campaign_id", "email", "first_name", "last_name", "company", "title", "industry",
                                          "last_activity_date", "created_date")]
    return lead.select(F.col("lead.id").alias("lead_id"), *plain, F.col("lead.status").alias("lead_status"), *rates,
                       F.to_json("lead").alias("raw_data"))


PERSON = ("struct<id:string, first_name:string, last_name:string, name:string, email:string, email_status:string, linkedin_url:string, "
          "title:string, headline:string, photo_url:string, city:string, state:string, country:string, seniority:string, "
          "departments:array<string>, functions:array<string>, "
          "employment_history:array<struct<organization_name:string, title:string, start_date:string, current:boolean>>, "
          "organization:struct<id:string, name:string, website_url:string, linkedin_url:string, phone:string, industry:string, "
          "estimated_num_employees:bigint, annual_revenue:string, founded_year:int, short_description:string, city:string, "
          "state:string, country:string, technologies:array<string>>>")


def normal_enrichment(df: DataFrame, key: str, column: str) -> DataFrame:
    """Organisation facts of the first person of an enrichment answer, with a joined place and JSON parts."""
    people = F.from_json(F.get_json_object(column, "$.people"), f"array<{PERSON}>")
    held = df.select(key, F.get(people, F.lit(0)).alias("p"))
    org = "p.organization."
    return held.select(
        key, F.col("p.email").alias("email"), F.col(org + "industry").alias("company_industry"),
        F.col(org + "annual_revenue").alias("company_revenue"), F.col(org + "estimated_num_employees").alias("employee_count"),
        F.nullif(F.concat_ws(", ", org + "city", org + "state", org + "country"), F.lit("")).alias("company_location"),
        F.to_json(org + "technologies").alias("technologies"), F.col(org + "short_description").alias("company_description"))


def flat_person(df: DataFrame, key: str, column: str) -> DataFrame:
    """Person and organisation as flat columns, the current job, and joined list columns."""
    held = df.select(key, F.from_json(F.get_json_object(column, "$.person"), PERSON).alias("p"))
    current = F.coalesce(F.get(F.filter("p.employment_history", lambda j: j.current), F.lit(0)),
                         F.get("p.employment_history", F.lit(0)))
    org = [(f"p.organization.{a}", b) for a, b in (
        ("id", "organization_id"), ("name", "organization_name"), ("website_url", "organization_website"),
        ("linkedin_url", "organization_linkedin"), ("phone", "organization_phone"), ("industry", "organization_industry"),
        ("estimated_num_employees", "organization_employees"), ("annual_revenue", "organization_revenue"),
        ("founded_year", "organization_founded"), ("short_description", "organization_description"))]
    person = [("p.id", "enrichment_id"), ("p.name", "full_name")] + [(f"p.{c}", c) for c in (
        "first_name", "last_name", "email", "email_status", "linkedin_url", "title", "headline", "photo_url", "city", "state",
        "country", "seniority")]
    lists = [F.nullif(F.array_join(f"p.{c}", ", "), F.lit("")).alias(c) for c in ("departments", "functions")]
    return held.withColumn("job", current).select(
        key, *[F.col(a).alias(b) for a, b in person + org],
        F.col("job.organization_name").alias("current_company"), F.col("job.title").alias("current_title"),
        F.col("job.start_date").alias("current_start_date"), *lists)


def flat_search(df: DataFrame, key: str, column: str) -> DataFrame:
    """Contact, organisation and place of each person of a search answer."""
    people = F.from_json(F.get_json_object(column, "$.people"), f"array<{PERSON}>")
    return df.select(key, F.explode(people).alias("p")).select(
        key, F.col("p.id").alias("person_id"), F.col("p.name").alias("name"), F.col("p.email").alias("email"), F.col("p.title").alias("title"),
        F.col("p.organization.name").alias("company"), F.col("p.organization.estimated_num_employees").alias("employees"),
        F.concat_ws(", ", "p.city", "p.state", "p.country").alias("location"))


def campaign_parts(df: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """Steps and variants of nested campaign sequences, without repeated keys."""
    schema = "array<struct<type:string, delay:int, variants:array<struct<subject:string, body:string>>>>"
    steps = df.select(key, F.posexplode(F.from_json(column, schema)).alias("step_index", "s"))
    variants = steps.select(key, "step_index", F.posexplode("s.variants").alias("variant_index", "v"))
    return (steps.select(key, "step_index", F.col("s.type").alias("type"), F.col("s.delay").alias("delay"))
            .dropDuplicates([key, "step_index"]),
            variants.select(key, "step_index", "variant_index", F.col("v.subject").alias("subject"), F.col("v.body").alias("body"))
            .dropDuplicates([key, "step_index", "variant_index"]))


def first_per_lead(feed: DataFrame, lead: str, order: Sequence[str]) -> DataFrame:
    """First feed row of each lead; rows without lead are skipped."""
    from leadmill.operators.quality import latest_per_key

    return latest_per_key(feed.filter(F.coalesce(F.col(lead).cast("string"), F.lit("")) != ""), [lead],
                          [F.col(c) for c in order], newest=False)
