"""Articles read in splits and a work queue as a stream, over files written from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsieve.functions.text import doi
from partsieve.session import table as t
from partsieve.sources.articles import data_availability, journal, last_text, read_articles, repository_links, titles_by_doi
from partsieve.staging import scratch
from partsieve.streaming.queue import queue_state, run_queue, to_do

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


_CODES = ["pone", "PMED", "pcbi", "pxyz"]


def _articles(s: SparkSession, d: str) -> str:
    """Files of articles, one a document, whole texts as their bodies: a fifth has no doi, and all have references with titles of
    their own before theirs."""
    escaped = F.replace(F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    doi = F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit('<article-id pub-id-type="doi"> 10.1/'), "doc_id", F.lit("</article-id>"))).otherwise('<article-id pub-id-type="pmid">7</article-id>')
    title = F.concat(F.lit("<article-title>Other</article-title><title-group>\n<article-title> On <i>"), "source", F.lit("</i> &amp; "), "doc_id", F.lit("</article-title></title-group>"))
    uri = F.concat(F.lit("<self-uri>https://doi.org/10.1371/Journal."), F.element_at(F.array(*map(F.lit, _CODES)), (F.col("doc_id") % 4 + 1).cast("int")), F.lit("."), "doc_id", F.lit("</self-uri>"))
    said = F.concat(F.lit("<meta-name>Data <b>Availability</b></meta-name><meta-value> All at <ext-link>here</ext-link> "), "doc_id", F.lit(" </meta-value></custom-meta>"))
    meta = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<custom-meta><meta-name>Other</meta-name><meta-value>no</meta-value></custom-meta><custom-meta>"), said)).when(F.col("doc_id") % 3 == 1, F.concat(F.lit('<custom-meta id="data-availability"><meta-name>x</meta-name><meta-value>In '), "doc_id", F.lit("</meta-value></custom-meta>"))).otherwise("<custom-meta/>")
    back = F.concat(F.lit("<back>Code: https://github.com/o"), "doc_id", F.lit("/r, (http://gitlab.com/g/h) <p>https://gitlab.cern.ch/p/q; https://github.com/o"), "doc_id", F.lit("/r</p></back>"))
    article = F.concat(F.lit("<article>\n<front>"), doi, title, uri, meta, F.lit("</front>\n<body>"), escaped, F.lit("</body>"), back, F.lit("</article>"))
    path = scratch(s, "articles")
    t(s, d, "documents").select(article.alias("value")).write.text(path)
    return path


@query("SELECT '10.1/' || doc_id AS doi, 'On ' || source || ' & ' || doc_id AS title FROM documents WHERE doc_id % 5 <> 0")
def article_titles(s: SparkSession, d: str) -> DataFrame:
    """Titles by doi out of files of articles."""
    return titles_by_doi(read_articles(s, _articles(s, d)))


@query(r"SELECT 'On ' || source || ' & ' || doc_id AS title, md5(regexp_replace(regexp_replace(coalesce(text, ''), '^[ \t\n\x0B\f\r]+', ''), '[ \t\n\x0B\f\r]+$', '')) AS body FROM documents")
def article_bodies(s: SparkSession, d: str) -> DataFrame:
    """Title and digest of the body of every article, with or without a doi."""
    record = F.col("record")
    return read_articles(s, _articles(s, d)).select(last_text(record, "article-title").alias("title"), F.md5(last_text(record, "body")).alias("body"))


@query("""SELECT '10.1371/journal.' || lower(['pone', 'PMED', 'pcbi', 'pxyz'][doc_id % 4 + 1]) || '.' || doc_id AS doi, ['plosone', 'plosmedicine', 'ploscompbiol', 'plosone'][doc_id % 4 + 1] AS journal,
CASE doc_id % 3 WHEN 0 THEN 'All athere' || doc_id WHEN 1 THEN 'In ' || doc_id END AS statement FROM documents""")
def article_statements(s: SparkSession, d: str) -> DataFrame:
    """Identifier, journal and statement on data availability of every article."""
    found = read_articles(s, _articles(s, d)).select(doi(last_text(F.col("record"), "self-uri")).alias("doi"), data_availability(F.col("record")).alias("statement"))
    return found.select("doi", journal(F.col("doi")).alias("journal"), "statement")


@query("""SELECT doc_id, unnest(['https://github.com/o' || doc_id || '/r', 'http://gitlab.com/g/h', 'https://gitlab.cern.ch/p/q']) AS repo_url, unnest(['GitHub', 'GitLab', 'GitLab']) AS platform FROM documents""")
def article_repositories(s: SparkSession, d: str) -> DataFrame:
    """Repositories that the back matter of every article links to, with their platforms."""
    back = F.concat(F.lit("<back>"), F.substring_index("record", "<back>", -1))
    number = F.regexp_extract(last_text(F.col("record"), "self-uri"), r"(\d+)$", 1).cast("long")
    found = read_articles(s, _articles(s, d)).select(number.alias("doc_id"), F.explode(repository_links(back)).alias("link"))
    return found.select("doc_id", "link.*")


_DAY = 86_400_000


@query(f"""WITH l AS (SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1), m AS (SELECT max(ts) AS last FROM events),
q AS (SELECT l.user_id AS item, CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS component_count, 'v' || l.event_id % 3 AS version, epoch_ms(ts) AS done, epoch_ms(last) AS final FROM l JOIN events e ON e.event_id = l.event_id, m),
p AS (SELECT item, CASE WHEN component_count = 0 AND done + {_DAY} < final - {_DAY} THEN 0 ELSE 1 END AS processed, component_count, version FROM q)
SELECT *, processed = 0 OR version <> 'v2' AS to_do FROM p""")
def queue_stream(s: SparkSession, d: str) -> DataFrame:
    """The queue after four runs of a stream over events, each from the checkpoint of the last one; users stand for items,
    errors for empty results, which are taken back after a day."""
    run = scratch(s, "queue")
    events = t(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    ends = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).select(F.unix_micros("first").alias("first"), F.unix_micros("last").alias("last")).first()
    count = F.when(F.col("event_type") == "error", 0).otherwise(F.floor("value")).cast("long")
    result = {"item": F.col("user_id"), "ts": F.col("ts"), "number": F.col("event_id"), "component_count": count, "version": F.concat(F.lit("v"), F.col("event_id") % 3)}
    at = F.least(F.floor((F.unix_micros("ts") - F.lit(ends["first"])) * 4 / F.lit(max(1, ends["last"] - ends["first"]))), F.lit(3))
    for arrival in range(4):
        events.where(at == arrival).write.mode("append").parquet(f"{run}/in")
        run_queue(s, f"{run}/in", f"{run}/out", f"{run}/checkpoint", result, _DAY, "1 day")
    state = queue_state(s, f"{run}/out")
    return state.withColumn("to_do", to_do(state, "v2"))
