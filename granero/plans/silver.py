"""Cleaning: duplicates out, rejects tagged, personal data masked."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from granero.catalog import TableSpec
from granero.functions.columns import masked
from granero.operators.dedup import deduplicate
from granero.operators.ingest import drop_audit
from granero.operators.quarantine import tag
from granero.operators.references import PackedKeys


def cleaned(
    raw: DataFrame,
    spec: TableSpec,
    as_of: dt.date,
    parents: Mapping[str, DataFrame | PackedKeys],
    report_nulls: bool = True,
    keyed: bool = False,
    copies: str | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Rows of a raw table without duplicates, masked, with ``motivo`` on the rejected ones.

    Valid and rejected rows come out of the same pass; ``parents`` are the
    cleaned parent tables, so a rejected parent rejects its children too.
    ``keyed``: the raw table was written by the keyed load. ``copies`` names a
    column for the number of raw rows that each row stands for. ``repeated``: where copies can stand.
    """
    unique = deduplicate(drop_audit(raw), spec, keyed, copies, repeated)
    tagged = tag(unique, spec, as_of, parents, report_nulls)
    return tagged.withColumns({c: masked(c) for c in spec.masked}) if spec.masked else tagged
