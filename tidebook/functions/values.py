"""Column functions: field parsing, and the classes of regions and HTTP answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Priority of the named trade regions; all others come after them.
REGION_PRIORITY = {10000043: 1, 10000002: 2, 10000030: 3, 10000042: 4, 10000032: 5}
OTHER_PRIORITY = 6
RETRY_PRIORITY = 4

DECIMAL = r"^[+-]?(?:[0-9]{1,18}(?:\.[0-9]*)?|\.[0-9]+)$"


def whole_number(text: Column) -> Column:
    """A base-10 64-bit integer without blanks or decimals, else null."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def day(text: Column) -> Column:
    """A strict yyyy-MM-dd date, else null."""
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))


def instant(text: Column) -> Column:
    """An RFC 3339 time with a zone, else null."""
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})$"), text.try_cast("timestamp"))


def http_date(text: Column) -> Column:
    """An HTTP date such as Tue, 05 Aug 2026 11:02:44 GMT, else null.  The weekday is not looked at."""
    return F.try_to_timestamp(F.substring(text, 6, 20), F.lit("dd MMM yyyy HH:mm:ss"))


def price(text: Column) -> Column:
    """A plain decimal of at most 18 digits before the point, else null: no exponent, no blanks, no words."""
    return F.when(text.rlike(DECIMAL), text.try_cast("decimal(20,2)"))


def region_priority(region_id: Column, named: dict[int, int] | None = None) -> Column:
    table = REGION_PRIORITY if named is None else named
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, region_id.cast("int")), F.lit(OTHER_PRIORITY))


def may_retry(priority: Column) -> Column:
    return priority <= RETRY_PRIORITY


def token_cost(status: Column) -> Column:
    """What an answer costs of the request budget."""
    return (
        F.when(status == 304, 1)
        .when(status.between(200, 299), 2)
        .when(status.between(300, 399), 1)
        .when(status.between(400, 499), 5)
        .otherwise(0)
    )


def error_class(status: Column) -> Column:
    return (
        F.when(status == 200, F.lit(None).cast("string"))
        .when(status == 429, "rate_limited")
        .when(status == 420, "error_limited")
        .when(status >= 500, "server_error")
        .otherwise("http_error")
    )


def retryable(status: Column, error_kind: Column) -> Column:
    """Whether a page may be asked for again.  Without a status the kind of the failure decides."""
    by_status = F.when(status == 420, False).when((status == 429) | (status >= 500), True).otherwise(False)
    return F.when(status.isNotNull(), by_status).otherwise(F.coalesce(error_kind.isin("timeout", "network"), F.lit(False)))


def admitted(remaining: Column, pages: Column, floor: int = 600, reserve: int = 300) -> Column:
    """Whether a sweep may start and, with its page count known, go on.  An unknown budget admits."""
    return remaining.isNull() | ((remaining >= floor) & (pages.isNull() | (remaining - 2 * (pages - 1) >= reserve)))


def cycle_outcome(deferred: Column, consistent: Column, store_failed: Column, fetch_failed: Column, first_load: Column, drifted: Column) -> Column:
    """How a refresh cycle ended.  A failure of the store outweighs all else."""
    return (
        F.when(store_failed, "failed")
        .when(deferred, "deferred")
        .when(~consistent, "inconsistent")
        .when(fetch_failed, "failed")
        .when(first_load | drifted, "resync")
        .otherwise("ok")
    )
