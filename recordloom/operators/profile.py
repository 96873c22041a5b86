"""Counts and distributions over issues, runs and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordloom.functions.json import object_keys, read_object


def issues_by(issues: DataFrame, column: str) -> DataFrame:
    """Number of issues per ``severity`` or ``code``."""
    return issues.groupBy(column).agg(F.count("*").alias("n"))


def top_issue_signatures(issues: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` most frequent ``code: message`` texts; ties in alphabetical order."""
    signature = F.concat(F.col("code"), F.lit(": "), F.col("message"))
    return (
        issues.groupBy(signature.alias("signature"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc("signature"))
        .limit(n)
    )


def _rolled_up(counts: DataFrame, key: str) -> DataFrame:
    return counts.groupBy(key).agg(F.sum("n").alias("n"))


def _as_map(counts: DataFrame, key: str, name: str) -> DataFrame:
    """Counts of a fixed, small set of keys as one map, sorted by key."""
    entries = F.array_sort(F.collect_list(F.struct(key, "n")))
    return counts.agg(F.map_from_entries(entries).alias(name))


def document_totals(judged: DataFrame) -> DataFrame:
    """One row: documents processed and failed. ``judged`` needs only ``error_code``."""
    return judged.agg(
        F.count("*").alias("processed_files"),
        F.count_if(F.col("error_code").isNotNull()).alias("fatal_parse_errors"),
    )


def signature_counts(issues: DataFrame) -> DataFrame:
    """``severity, code, message, n``. Sums of such counts are the counts of all they come from, unlike lists of the most frequent."""
    return issues.groupBy("severity", "code", "message").agg(F.count("*").alias("n"))


def run_summary(judged: DataFrame, issues: DataFrame, top_n: int = 50) -> DataFrame:
    """One row: documents processed and failed, issue counts, top signatures."""
    return summarize(document_totals(judged), signature_counts(issues), top_n)


def summarize(totals: DataFrame, counts: DataFrame, top_n: int = 50) -> DataFrame:
    """The one row of ``totals`` with reports on the issues that ``signature_counts`` counted, in one run or several.

    The maps hold severities and codes, of which there is a fixed handful; the signatures are limited to ``top_n``.
    """
    severities = _as_map(_rolled_up(counts, "severity"), "severity", "issue_counts_by_severity")
    codes = _as_map(_rolled_up(counts, "code"), "code", "issue_counts_by_code")
    signature = F.concat(F.col("code"), F.lit(": "), F.col("message"))
    signatures = _rolled_up(counts.withColumn("signature", signature), "signature")
    ranked = (
        signatures.orderBy(F.desc("n"), F.asc("signature"))
        .limit(top_n)
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct((-F.col("n")).alias("rank"), "signature", F.col("n").alias("count"))
                )
            ).alias("ranked")
        )
    )
    top = ranked.select(
        F.transform(
            "ranked",
            lambda r: F.struct(r["signature"].alias("signature"), r["count"].alias("count")),
        ).alias("top_issue_signatures")
    )
    # Each side is one aggregated row, so these are scalar subqueries, not joins.
    return totals.select(
        "*",
        severities.scalar().alias("issue_counts_by_severity"),
        codes.scalar().alias("issue_counts_by_code"),
        top.scalar().alias("top_issue_signatures"),
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0) * part / whole, 1)


def harvest_profile(
    records: DataFrame, created: str, updated: str, flags: dict[str, Column]
) -> DataFrame:
    """One row: total, first and last of both timestamps, and how many rows have each flag."""
    shares = []
    for name, flag in flags.items():
        n = F.count_if(flag)
        shares += [n.alias(f"{name}_count"), _percent(n, F.count("*")).alias(f"{name}_percent")]
    return records.agg(
        F.count("*").alias("total"),
        F.min(created).alias("created_min"),
        F.max(created).alias("created_max"),
        F.min(updated).alias("updated_min"),
        F.max(updated).alias("updated_max"),
        *shares,
    )


def distribution(records: DataFrame, column: str) -> DataFrame:
    """Count and share in percent of every value of a column.

    The total is the sum of the counts, as a scalar subquery over the same exchange; a
    window over all groups would gather them in one task.
    """
    counts = records.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.withColumn("percent", _percent(F.col("n"), total))


def key_inventory(records: DataFrame, json_col: str, *paths: str) -> DataFrame:
    """``path, key, n``: which keys the JSON objects at the paths have, and in how many records.

    ``json_col`` holds the text of a record, or what ``read_object`` made of it. One pass and one scan
    of a record for all paths, by default for the record itself. A repeated key counts once.
    """
    column = F.col(json_col)
    is_text = records.schema[json_col].dataType.typeName() == "string"
    read = records.select((read_object(column) if is_text else column).alias("record_"))
    found = [
        F.transform(
            F.coalesce(object_keys(F.col("record_"), *path.split(".")[1:]), F.array().cast("array<string>")),
            lambda key: F.struct(F.lit(path).alias("path"), key.alias("key")),  # noqa: B023
        )
        for path in paths or ("$",)
    ]
    keys = read.select(F.explode(F.concat(*found)).alias("at")).select("at.path", "at.key")
    return keys.groupBy("path", "key").agg(F.count("*").alias("n"))
