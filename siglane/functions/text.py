"""Names, codes and dates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def coded(code: Column, table: dict[str, object], default=None) -> Column:
    """The table's value for a code, ``default`` for any other."""
    out = None
    for k, v in table.items():
        out = F.when(code == k, F.lit(v)) if out is None else out.when(code == k, F.lit(v))
    return out.otherwise(F.lit(default))


def month_of(date: Column) -> Column:
    """First six characters of a date of six bytes at least; digits aren't checked."""
    return F.when(F.octet_length(date) >= 6, F.substring(date, 1, 6))


def joined(values: Column, by: str = "|") -> Column:
    """Values put together; null for none."""
    return F.when(F.size(values) > 0, F.concat_ws(by, values))


def therapy_summary(therapy: Column) -> Column:
    """start|end|seq of each entry, entries parted by ||; null for none."""
    blank = F.lit("")
    return joined(F.transform(therapy, lambda t: F.concat_ws("|", F.coalesce(t["start"], blank), F.coalesce(t["end"], blank), t["seq"].cast("string"))), "||")


def normalize_ndc(code: Column) -> Column:
    return F.regexp_replace(code, "[^0-9]", "")


def normalize_drug_name(name: Column) -> Column:
    kept = F.regexp_replace(name, r"[^\p{L}\p{N}\s]", "")
    return F.lower(F.trim(F.regexp_replace(kept, r"\s+", " ")))
