"""Stable keys of a bid and of its web address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlens.functions import as_column

# Fixed value: the portal's bid-number format.
BID_NUMBER = "(?iU)\\bGEM/\\d{4}/[A-Z]/\\d+\\b"
_HOST = "(?i)^(?:[a-z][a-z0-9+.\\-]*:)?//(?:[^/?#]*@)?([^/?#:@]*)"


def bid_number(text: Column | str) -> Column:
    """First bid number in a text, upper-cased; '' if there is none."""
    return F.upper(F.regexp_extract(as_column(text), BID_NUMBER, 0))


def host(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(as_column(url), _HOST, 1))


def is_allowed_host(url: Column | str, hosts: list[str]) -> Column:
    """True for a listed host or one of its subdomains; false for blank."""
    h = host(url)
    checks = [(h == x) | h.endswith("." + x) for x in hosts]
    out = F.lit(False)
    for check in checks:
        out = out | check
    return F.coalesce(out, F.lit(False))


def identity_key(
    bid: Column | str = "bid_number",
    tender_id: Column | str = "gem_tender_id",
    url: Column | str = "source_url",
    title: Column | str = "title",
    buyer: Column | str = "buyer_organization",
    closing: Column | str = "bid_end_at",
) -> Column:
    """Bid number, else tender id, else hash of the URL, else of title+buyer+closing."""
    b, t, u = as_column(bid), as_column(tender_id), as_column(url)
    closing_text = F.coalesce(
        F.concat(F.date_format(as_column(closing), "yyyy-MM-dd HH:mm:ss"), F.lit("+05:30")),
        F.lit("None"),
    )
    print_of = F.concat_ws(
        "|", F.coalesce(as_column(title), F.lit("")), F.coalesce(as_column(buyer), F.lit("")), closing_text
    )

    def short_hash(c: Column) -> Column:
        return F.left(F.sha2(c, 256), F.lit(32))

    return (
        F.when(b != "", F.concat(F.lit("bid:"), F.upper(F.trim(b))))
        .when(t != "", F.concat(F.lit("gem:"), F.upper(F.trim(t))))
        .when(u != "", F.concat(F.lit("url:"), short_hash(u)))
        .otherwise(F.concat(F.lit("fp:"), short_hash(print_of)))
    )
