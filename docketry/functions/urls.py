"""Addresses: rewriting to the publisher's service, building, and redacting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The site whose text addresses are rewritten, with and without www.
HOSTS = ("congress.gov", "www.congress.gov")


def _steps(url: Column) -> Column:
    """The steps of the path of an address on the site; null for addresses of other sites and those that can't be read."""
    ours = F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https") & F.try_parse_url(url, F.lit("HOST")).isin(*HOSTS)
    return F.when(ours & ~url.contains("#"), F.split(F.substring(F.try_parse_url(url, F.lit("PATH")), F.lit(2), F.length(url)), "/"))


def _step(steps: Column, k: int) -> Column:
    return F.coalesce(F.try_element_at(steps, F.lit(k)), F.lit(""))


def _is_number(c: Column) -> Column:
    return (c != "") & (F.translate(c, "0123456789", "") == "")


def _name_and_kind(file: Column) -> tuple[Column, Column]:
    return F.substring_index(file, ".", 1), F.substring(file, F.length(F.substring_index(file, ".", 1)) + 2, F.length(file))


def bill_text_url(url: Column, base: str) -> Column:
    """The service's address of a bill text; null for other addresses.

    A text stands at {congress}/bills/{bill}/{package}.{htm, xml or pdf}, its package being BILLS- and letters and digits."""
    steps = _steps(url)
    package, kind = _name_and_kind(_step(steps, 4))
    fits = (F.size(steps) == 4) & _is_number(_step(steps, 1)) & (_step(steps, 2) == "bills") & (_step(steps, 3) != "") & package.startswith("BILLS-") & F.regexp_replace(package, "^BILLS-", "").rlike("^[A-Za-z0-9]+$") & kind.isin("htm", "xml", "pdf")
    return F.when(fits, F.concat(F.lit(base.rstrip("/") + "/packages/"), package, F.lit("/"), kind))


def record_text_url(url: Column, base: str) -> Column:
    """The service's address of a piece of the record; null for other addresses and those with a step up ("..").

    A piece stands at {congress}/crec/{year}/{month}/{day}/{volume}/{issue}/[modified/]{granule}.{htm or pdf}; its granule is that day's package
    CREC-yyyy-mm-dd and a part and page, -pt1-PgS52 and so on."""
    steps = F.filter(_steps(url), lambda s: s != "modified")
    granule, kind = _name_and_kind(_step(steps, 8))
    package = F.substring_index(granule, "-", 4)
    day = F.substring(package, F.lit(6), F.length(package))
    rest = F.split(F.substring(granule, F.length(package) + 2, F.length(granule)), "-")
    part, page = _step(rest, 1), _step(rest, 2)
    fits = (F.size(steps) == 8) & (_step(steps, 2) == "crec") & package.startswith("CREC-") & (F.length(day) == 10)
    for k in (1, 3, 4, 5, 6, 7):
        fits = fits & _is_number(_step(steps, k))
    fits = fits & _is_number(F.translate(day, "-", "")) & part.startswith("pt") & _is_number(F.substring(part, F.lit(3), F.length(part))) & page.startswith("Pg") & (F.length(page) > 2) & kind.isin("htm", "pdf")
    return F.when(fits & ~url.contains(".."), F.concat(F.lit(base.rstrip("/") + "/packages/"), package, F.lit("/granules/"), granule, F.lit("/"), kind))


def redact(url: Column) -> Column:
    """Without its query."""
    return F.regexp_replace(url, r"\?.*$", "")


def vote_url(base: str, congress: Column, session: Column, number: Column) -> Column:
    c, s = congress.cast("string"), session.cast("string")
    return F.concat(F.lit(base + "/roll_call_votes/vote"), c, s, F.lit("/vote_"), c, F.lit("_"), s, F.lit("_"), F.format_string("%05d", number.cast("int")), F.lit(".xml"))


def vote_list_url(base: str, congress: Column, session: Column) -> Column:
    return F.concat(F.lit(base + "/roll_call_lists/vote_menu_"), congress.cast("string"), F.lit("_"), session.cast("string"), F.lit(".xml"))
