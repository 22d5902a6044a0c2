"""Titles resolved to pages, and the hit/miss report kept from run to run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaward.functions.text import title_variants


def find_titles(titles: DataFrame, pages: DataFrame) -> DataFrame:
    """W1 inside C1: one row per distinct title with its first successful variant.

    Pages are first reduced to the lowest id per title, so the variant join meets
    at most one page and the choice is a combinable ``min_by``, not a window.
    """
    by_title = pages.groupBy(F.col("title").alias("variant")).agg(F.min("page_id").alias("page_id"))
    tried = titles.select("given_title").distinct().select(
        "given_title", F.posexplode(title_variants(F.col("given_title"))).alias("pos", "variant"))
    return (
        tried.join(by_title, "variant", "left")
        .groupBy("given_title")
        .agg(
            F.count("*").cast("int").alias("variants"),
            F.min_by(F.struct(F.col("variant").alias("found_title"), "page_id", (F.col("pos") + 1).alias("attempt")),
                     F.when(F.col("page_id").isNotNull(), F.col("pos"))).alias("hit"),
        )
        .select(
            "given_title",
            F.when(F.col("hit").isNotNull(), "HIT").otherwise("MISS").alias("status"),
            F.col("hit.found_title").alias("found_title"),
            F.col("hit.page_id").alias("page_id"),
            F.when(F.col("hit").isNotNull(),
                   F.concat(F.lit("Matched using variation: '"), F.col("hit.found_title"), F.lit("'")))
            .otherwise(F.concat(F.lit("Page not found after all "), F.col("variants"), F.lit(" variations.")))
            .alias("notes"),
            F.coalesce("hit.attempt", "variants").alias("attempts_made"),
        )
    )


def resolve_titles(titles: DataFrame, pages: DataFrame) -> DataFrame:
    """Every given title, duplicates included, with status, page and attempts."""
    return titles.join(find_titles(titles, pages), "given_title", "left")


def to_search(titles: DataFrame, prev: DataFrame) -> DataFrame:
    """Titles that a run has to look up: all but verified hits of the previous report."""
    return titles.join(approved(prev).select("given_title"), "given_title", "left_anti")


def merge_report(titles: DataFrame, prev: DataFrame, found: DataFrame, as_of: str,
                 approvals: DataFrame | None = None) -> DataFrame:
    """C4: this run's report from the title list, the previous report and the search results.

    First-checked time and approval survive; verified hits keep their old result;
    titles no longer listed fall out. ``approvals`` (given_title, user_verified),
    the reviewer's table, replaces the approval flag where present.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    fields = ["status", "found_title", "page_id", "notes", "attempts_made"]
    kept = ["first_checked_on", "last_checked_on", "user_verified", *fields]
    # the latest entry of a title; of equally late ones an approved one
    late = F.struct(F.coalesce("last_checked_on", now), F.coalesce("user_verified", F.lit(False)), F.struct(*kept))
    old = prev.groupBy("given_title").agg(F.max_by(F.struct(*kept), late).alias("old"))
    new = found.select("given_title", F.struct(*fields).alias("new"))
    joined = titles.join(old, "given_title", "left").join(new, "given_title", "left")
    verified = F.coalesce("old.user_verified", F.lit(False))
    if approvals is not None:
        joined = joined.join(approvals.groupBy("given_title").agg(F.max("user_verified").alias("_ok")), "given_title", "left")
        verified = F.coalesce("_ok", verified)
    frozen = F.coalesce((F.col("old.status") == "HIT") & F.col("old.user_verified"), F.lit(False))
    default = {"status": F.lit("PENDING"), "notes": F.lit(""), "attempts_made": F.lit(0)}

    def result(name: str):
        then = F.when(frozen | F.col("new").isNull(), F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))
        return (F.coalesce(then, default[name]) if name in default else then).alias(name)

    return joined.select(
        *titles.columns, *[result(f) for f in fields],
        F.coalesce("old.first_checked_on", now).alias("first_checked_on"),
        now.alias("last_checked_on"), verified.alias("user_verified"))


def approved(report: DataFrame) -> DataFrame:
    """verified hits."""
    return report.where((F.col("status") == "HIT") & F.col("user_verified"))


def with_page_id(report: DataFrame) -> DataFrame:
    """entries that carry a page id."""
    return report.where(F.col("page_id").isNotNull())


def status_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Number of rows per status."""
    return df.groupBy(*(columns or ("status",))).agg(F.count("*").alias("n"))
