"""Articles out of large XML files, read in splits.

Spark's text reader cuts records at any separator and knows how to read on over the end of a split, so the end tag of an
article is the separator: a file of any size is read by as many tasks as it has splits, and each record is one article
with what stands before it. What an article says is found in its own record, so nothing carries over to the next one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partsieve.sources.markup import unescaped

# Parts of identifiers and the journals they stand for, and the journal of all others.
JOURNALS = {
    "journal.pone": "plosone", "journal.pmed": "plosmedicine", "journal.pcbi": "ploscompbiol", "journal.pgen": "plosgenetics",
    "journal.ppat": "plospathogens", "journal.pbio": "plosbiology", "journal.pntd": "plosntds",
}
OTHER_JOURNAL = "plosone"
# Links to repositories, in the order in which they are looked for.
REPOSITORIES = [r"https?://(?:www\.)?github\.com/[^\s)\],;]+", r"https?://(?:www\.)?gitlab\.com/[^\s)\],;]+", r"https?://gitlab\.[^\s/]+/[^\s)\],;]+"]


def read_articles(spark: SparkSession, path: str, tag: str = "article") -> DataFrame:
    """place, record: the markup of every element of that name in the files of a path, without its end tag; place orders
    them by file and position. Elements do not nest; end tags are written without white space. What stands behind the last
    one, or holds no start tag, is no record."""
    lines = spark.read.option("lineSep", f"</{tag}>").text(path)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("number"))
    begin = F.regexp_instr("value", F.lit(rf"<{tag}[\s>]"))
    rows = lines.select(place.alias("place"), begin.alias("begin"), "value").where("begin > 0")
    return rows.select("place", F.expr("substring(value, begin)").alias("record"))


def last_text(record: Column, tag: str, attribute: str = "") -> Column:
    """All text inside the last element of a name (and attribute, such as kind="x"), its tags left out, unescaped and stripped;
    null without such an element."""
    inside = F.regexp_extract_all(record, F.lit(rf"(?s)<{tag}(?=[\s>])[^>]*{attribute}[^>]*(?<!/)>(.*?)</{tag}\s*>"))
    text = unescaped(F.regexp_replace(F.try_element_at(inside, F.lit(-1)), r"(?s)<!--.*?-->|<[^>]*>", ""))
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def titles_by_doi(articles: DataFrame) -> DataFrame:
    """doi, title: of articles that have both; the last one of a doi."""
    both = articles.select("place", last_text(F.col("record"), "article-id", "pub-id-type=[\"']doi[\"']").alias("doi"), last_text(F.col("record"), "article-title").alias("title"))
    return both.where("doi <> '' and title <> ''").groupBy("doi").agg(F.max_by("title", "place").alias("title"))


def journal(doi: Column) -> Column:
    """The journal's part of an address, by the identifier."""
    known = reduce(lambda c, x: c.when(doi.contains(x[0]), x[1]), list(JOURNALS.items())[1:], F.when(doi.contains(next(iter(JOURNALS))), next(iter(JOURNALS.values()))))
    return known.otherwise(OTHER_JOURNAL)


def manuscript_url(doi: Column) -> Column:
    """Where an article's XML is."""
    return F.concat(F.lit("https://journals.plos.org/"), journal(doi), F.lit("/article/file?id="), doi, F.lit("&type=manuscript"))


def data_availability(record: Column) -> Column:
    """The statement on data availability: the first value of the entry of that id, or else the first value of an entry of that
    name; its pieces of text stripped and joined without a space. Null if there is none, or only empty ones."""
    inside = lambda m, tag: F.regexp_extract(m, rf"(?s)<{tag}(?:\s[^>]*)?(?<!/)>(.*?)</{tag}\s*>", 1)
    value = lambda m: F.trim(unescaped(F.regexp_replace(inside(m, "meta-value"), r"\s*<[^>]*>\s*", "")))
    entries = F.regexp_extract_all(record, F.lit(r"(?s)(<custom-meta(?:\s[^>]*)?(?<!/)>.*?</custom-meta\s*>)"))
    by_id = F.get(F.filter(entries, lambda m: m.rlike(r"^<custom-meta[^>]*\sid=[\"']data-availability[\"']")), F.lit(0))
    named = F.filter(entries, lambda m: F.lower(F.regexp_replace(inside(m, "meta-name"), "<[^>]*>", "")).contains("data availability") & (value(m) != ""))
    return F.coalesce(F.nullif(value(by_id), F.lit("")), value(F.get(named, F.lit(0))))


def repository_links(record: Column) -> Column:
    """Array of (repo_url, platform): links to repositories in an article's text, each once."""
    text = F.regexp_replace(unescaped(F.regexp_replace(record, "<[^>]*>", " ")), r"\s+", " ")
    found = F.array_distinct(F.concat(*[F.regexp_extract_all(text, F.lit(f"(?i)({p})")) for p in REPOSITORIES]))
    return F.transform(found, lambda u: F.struct(u.alias("repo_url"), F.when(F.lower(u).contains("github"), "GitHub").otherwise("GitLab").alias("platform")))
