"""URL parts, rebuilding, and token addresses inside URLs, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Public suffixes of two labels, as far as told apart here; others have one. A longer list can be given.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za")


def url_parts(column: str, suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    """scheme, subdomain, domain, tld and path of a URL as a struct; one trailing colon of the path is dropped. No URL: null parts."""
    c = F.col(column)
    host = F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    labels = F.split(host, r"\.")
    n = F.size(labels)
    two = F.concat_ws(".", F.slice(labels, -2, 2)) if suffixes else host
    k = F.when((n >= 2) & F.when(n >= 2, two).isin(*suffixes), 2).otherwise(1)
    none = F.lit(None).cast("string")
    known = host != ""
    return F.struct(
        F.when(known, F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))).alias("scheme"),
        F.when(known & (n - k >= 2), F.concat_ws(".", F.slice(labels, F.lit(1), F.greatest(n - k - 1, F.lit(0))))).otherwise(none).alias("subdomain"),
        F.when(known & (n - k >= 1), F.element_at(labels, F.greatest(n - k, F.lit(1)))).otherwise(none).alias("domain"),
        F.when(known & (n - k >= 1), F.concat_ws(".", F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k))).otherwise(none).alias("tld"),
        F.when(known, F.regexp_replace(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), ":$", "")).alias("path"),
    )


def rebuilt(parts: str) -> Column:
    """scheme://[subdomain.]domain.tld path of a struct of url_parts."""
    p = lambda x: F.col(f"{parts}.{x}")
    return F.concat(p("scheme"), F.lit("://"), F.when(p("subdomain").isNotNull(), F.concat(p("subdomain"), F.lit("."))).otherwise(""), p("domain"), F.lit("."), p("tld"), F.coalesce(p("path"), F.lit("")))


def erc20_of(column: str) -> Column:
    """chain and token of an eip155:<chain>/erc20:<address> inside a URL, as a struct; null where there is none."""
    pattern = r"eip155:(\d+)/erc20:(0x[0-9a-fA-F]{40})"
    hit = F.regexp_extract(column, pattern, 2) != ""
    return F.when(hit, F.struct(F.regexp_extract(column, pattern, 1).cast("bigint").alias("chain"), F.lower(F.regexp_extract(column, pattern, 2)).alias("token")))


def category_of(html: str) -> Column:
    """frame, if a page has the meta property of a frame, else page; null for null."""
    meta = r"(?i)<meta[^>]+(?:property|name)\s*=\s*[\"']fc:frame"
    return F.when(F.col(html).rlike(meta), "frame").when(F.col(html).isNotNull(), "page")
