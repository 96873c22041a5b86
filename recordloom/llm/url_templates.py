"""URL filters: listed rules first, then a tree of path templates for each host, by built-in functions only.

Numbers and long hexadecimal names in a path become wildcards at once. The tree then grows
level by level: under each node, segments whose pages are labelled like those of their
siblings are merged into a wildcard ``*``; one stays on its own if a chi-square test tells
it from the rest. A template is rejected if, of its labelled pages, the smoothed part of
bad ones is high enough and enough of its pages are labelled.

Everything is counted before it is joined: a level works on distinct paths of each host, and
sums under a node are made before they are shuffled, so a host with a third of all pages is
no task of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import work_table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A listed host with all its subdomains, and how a path must begin."""

    verdict: str  # block or allow
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case, and from there
    up to ``?``, ``#`` or the end; both empty for null and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def fitting_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does; a list given by hand, so one CASE."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        text = F.when(rule.fits(host, path), rule.text).otherwise(text)
        verdict = F.when(rule.fits(host, path), rule.verdict).otherwise(verdict)
    return text, verdict


def has_word(host: Column, path: Column, words: list[str]) -> Column:
    """Whether one of ``words`` (a-z) is a whole word of host or path, in any case; false for empty ones."""
    parts = F.split(F.translate(F.concat(host, F.lit("/"), path), _UPPER, _LOWER), "[^a-z]+")
    return F.arrays_overlap(parts, F.array(*map(F.lit, words)))


def general_segments(path: Column, depth: int) -> Column:
    """Segments of a path, numbers and hexadecimal names as wildcards; those beyond ``depth`` are one segment together."""
    parts = F.transform(
        F.split(F.regexp_replace(path, "^/", ""), "/"),
        lambda s: F.regexp_replace(F.regexp_replace(s, r"^(?=.*[0-9])[0-9a-fA-F]{8,}(?=$|\.)", "{hex}"), "[0-9]+", "{n}"))
    cut = F.concat(F.slice(parts, 1, depth), F.array(F.array_join(F.slice(parts, depth + 1, F.size(parts)), "/")))
    return F.when(F.size(parts) > depth, cut).otherwise(parts)


def path_templates(
    pages: DataFrame, depth: int = 5, chi_square: float = 9.21, least_pages: int = 5
) -> DataFrame:
    """``host, segments, template, n, bad, good`` for each distinct host and list of general segments.

    ``pages`` has ``host``, ``segments`` and ``bad`` (true, false, or null without a label).
    ``chi_square`` is the bound of the test, by default that of one in a hundred at two
    degrees of freedom; segments of fewer than ``least_pages`` pages, for which it does not hold, are
    merged.
    """
    counts = [F.sum(c).alias(c) for c in ("n", "bad", "good")]
    now = work_table(pages.groupBy("host", "segments").agg(
        F.count("*").alias("n"), F.count_if(F.col("bad")).alias("bad"), F.count_if(~F.col("bad")).alias("good")
    ).withColumn("template", F.lit("")))
    for level in range(depth + 1):
        child = F.get("segments", F.lit(level))
        rows = now.withColumn("child", child)
        children = rows.where("child is not null").groupBy("host", "template", "child").agg(*counts)
        parents = children.groupBy("host", "template").agg(
            *(F.sum(c).alias(f"all_{c}") for c in ("n", "bad", "good")), F.count("*").alias("children"))
        judged = children.join(parents, ["host", "template"])
        rest = F.col("all_n") - F.col("n")
        test = F.lit(0.0)
        for one, whole in (("bad", "all_bad"), ("good", "all_good"), ("n - bad - good", "all_n - all_bad - all_good")):
            total, seen = F.expr(f"cast({whole} as double)"), F.expr(f"cast({one} as double)")
            for size, hits in ((F.col("n"), seen), (rest, total - seen)):
                expected = total * size / F.col("all_n")
                test = test + F.coalesce(F.pow(hits - expected, 2) / F.nullif(expected, F.lit(0.0)), F.lit(0.0))
        own = (F.col("children") == 1) | ((test > chi_square) & (F.col("n") >= least_pages))
        names = judged.select("host", "template", "child", F.when(own, F.col("child")).otherwise("*").alias("name"))
        moved = rows.join(names, ["host", "template", "child"], "left")
        now = work_table(moved.select("host", "segments", "n", "bad", "good", F.when(
            F.col("name").isNotNull(), F.concat("template", F.lit("/"), "name")).otherwise(F.col("template")).alias("template")))
    return now


def rejected_templates(
    paths: DataFrame, least_purity: float = 0.8, least_labelled: float = 0.5, prior: float = 4.0
) -> DataFrame:
    """``host, template, purity, rejected``: the smoothed part of bad pages among the labelled ones.

    The part of the template is drawn to that of its host with the weight of ``prior`` pages,
    and the host's to that of all hosts. Without labels purity is the host's and nothing is rejected.
    """
    counts = [F.sum(c).alias(c) for c in ("n", "bad", "good")]
    templates = paths.groupBy("host", "template").agg(*counts)
    hosts = paths.groupBy("host").agg(F.sum("bad").alias("host_bad"), F.sum("good").alias("host_good"))
    overall = paths.agg((F.sum("bad") + 1) / (F.sum("bad") + F.sum("good") + 2)).scalar()
    smooth = lambda bad, good, base: (F.col(bad) + prior * base) / (F.col(bad) + F.col(good) + prior)
    both = templates.join(hosts, "host").withColumn("base", overall)
    purity = smooth("bad", "good", smooth("host_bad", "host_good", F.col("base")))
    labelled = F.col("bad") + F.col("good")
    return both.select("host", "template", purity.alias("purity"), (
        (F.col("bad") > 0) & (purity >= least_purity) & (labelled >= least_labelled * F.col("n"))).alias("rejected"))


def judge_urls(
    pages: DataFrame, rules: list[Rule], bad: Column | None = None, depth: int = 5, id_col: str = "page_id", url_col: str = "url",
    least_purity: float = 0.8, least_labelled: float = 0.5, bad_words: list[str] | None = None,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` for every row of ``pages``.

    The longest fitting rule decides; without one, ``block`` if the page's template is
    rejected, else ``allow``. ``bad`` labels pages; by default the rules do, those they
    block and those they allow. With ``bad_words`` pages without such a label are bad if their host or path has one
    of these words, and good if it has none: a template whose pages mostly have them is rejected as a whole, with
    those of its pages that have none, and a page with such a word in a good template is allowed. Null urls and urls without ``://`` have an empty host and
    path, and one template together. Repeated rows are judged each, other columns are only
    read by ``bad``; no rows give no rows. The tree has ``depth`` levels and one more, where all further
    segments of a path, however many, are one name; paths that differ there differ in it.
    """
    host, path = host_and_path(F.col(url_col))
    parsed = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                          (F.lit(None).cast("boolean") if bad is None else bad).alias("bad"))
    rule, verdict = fitting_rule(rules, F.col("host"), F.col("path"))
    ruled = parsed.withColumn("rule", rule).withColumn("ruled", verdict)
    if bad is None:
        ruled = ruled.withColumn("bad", F.col("ruled") == "block")
    if bad_words:
        ruled = ruled.withColumn("bad", F.coalesce("bad", has_word(F.col("host"), F.col("path"), bad_words)))
    ruled = ruled.withColumn("segments", general_segments(F.col("path"), depth))
    paths = path_templates(ruled, depth)
    known = paths.select("host", "segments", "template").join(
        rejected_templates(paths, least_purity, least_labelled), ["host", "template"])
    method = F.when(F.col("rejected"), "block").otherwise("allow")
    return ruled.join(known, ["host", "segments"]).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "purity")
