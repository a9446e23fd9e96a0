"""Failures of rows: which are worth another run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statuses that a later try may not meet again.
RETRY_STATUSES = (429, 500, 502, 503, 504)
#: Kinds of failures without a status that come from the network, the store or the model server.
PASSING = ("timeout", "connection", "io", "embedding", "store_busy")


def error_class(kind: Column, status: Column | None = None) -> Column:
    """Transient or Systemic; null for rows that didn't fail. A status decides before the kind; unknown kinds, records that can't be resolved or parsed, and texts
    over a model's context are systemic: another try ends the same way."""
    by_kind = F.when(kind.isin(*PASSING), F.lit("Transient")).otherwise(F.lit("Systemic"))
    if status is not None:
        by_kind = F.when(status.isin(*RETRY_STATUSES), F.lit("Transient")).when(status >= 400, F.lit("Systemic")).when(kind.isNotNull(), by_kind)
        return by_kind
    return F.when(kind.isNotNull(), by_kind)
