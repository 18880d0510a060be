"""JSON in noisy texts: the outermost object of a response, price feeds."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from partsieve.functions.text import price

_TOKEN = re.compile(r'[{}"\\]')
_BAD_ESCAPE = re.compile(r'\\(?!["\\/bfnrtu])')


def _span(text: str) -> str | None:
    """From the first brace to the one that closes it; braces in strings do not count."""
    start = text.find("{")
    depth, quoted, skip = 0, False, -1
    for m in _TOKEN.finditer(text, max(start, 0)) if start >= 0 else ():
        at, c = m.start(), m.group()
        if at == skip:
            continue
        if c == "\\":
            skip = at + 1 if quoted else skip
        elif c == '"':
            quoted = not quoted
        elif not quoted:
            depth += 1 if c == "{" else -1
            if not depth:
                return text[start : at + 1]
    return None


def _parsed(span: str | None) -> str | None:
    for candidate in (span, _BAD_ESCAPE.sub(r"\\\\", span)) if span else ():
        try:
            return candidate if isinstance(json.loads(candidate), dict) else None
        except ValueError:
            continue
    return None


@F.arrow_udf(StringType())
def outer_object(texts: pa.Array) -> pa.Array:
    """The outermost JSON object of a text, escapes that JSON lacks doubled; null if there is none that parses."""
    return pa.array([None if x is None else _parsed(_span(x)) for x in texts.to_pylist()], pa.string())


def event_payload(text: Column) -> Column:
    """The first line of a server-sent-event response behind "data: " that is JSON; null if there is none."""
    lines = F.filter(F.split(text, "\r\n|\r|\n"), lambda x: x.startswith("data: "))
    payloads = F.transform(lines, lambda x: F.substring(x, 7, F.length(x)))
    return F.get(F.filter(payloads, lambda x: F.try_parse_json(x).isNotNull()), F.lit(0))


def _field(v: Column, *names: str) -> Column:
    """The first of several fields that is neither null, empty, zero nor false, as text."""
    texts = [F.try_variant_get(v, f"$.{n}", "string") for n in names]
    return F.coalesce(*[F.when(~x.isin("", "0", "0.0", "false"), x) for x in texts])


def feed_prices(rows: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """key, mpn, distributor, price, currency of each priced item of a feed: texts that hold an object or a list of objects.

    A price is a number, with the item's currency or USD, or a price text, with its own. Items without one, and texts that
    are no JSON, give no row.
    """
    v = F.try_parse_json(text_col)
    items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(F.schema_of_variant(v).startswith("OBJECT"), F.array(v)))
    item = rows.select(key, F.explode(items).alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    said = _field(F.col("v"), "price", "unitPrice")
    is_text = F.when(_field(F.col("v"), "price").isNotNull(), F.schema_of_variant(F.variant_get("v", "$.price", "variant"))).otherwise(F.schema_of_variant(F.variant_get("v", "$.unitPrice", "variant"))) == "STRING"
    found = price(said)
    currency = F.when(is_text, found["currency"]).otherwise(F.coalesce(F.try_variant_get("v", "$.currency", "string"), F.lit("USD")))
    out = item.select(key, _field(F.col("v"), "mpn", "partNumber").alias("mpn"), F.coalesce(_field(F.col("v"), "distributor", "vendor"), F.lit("")).alias("distributor"), found["value"].alias("price"), currency.alias("currency"))
    return out.where("price is not null")


def offers(rows: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """key, mpn, seller, quantity, price of every price of a nested feed."""
    shape = "results array<struct<mpn: string, sellers: array<struct<name: string, offers: array<struct<prices: array<struct<quantity: long, price: double>>>>>>>>"
    r = rows.select(key, F.explode(F.from_json(text_col, shape)["results"]).alias("r"))
    r = r.select(key, "r.mpn", F.explode("r.sellers").alias("s")).select(key, "mpn", F.col("s.name").alias("seller"), F.explode("s.offers").alias("o"))
    return r.select(key, "mpn", "seller", F.explode("o.prices").alias("p")).select(key, "mpn", "seller", "p.quantity", "p.price")
