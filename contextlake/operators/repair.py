"""Cleaning rules for damaged order, payment and stock rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import clamp_enum, ensure_float, ensure_int, ensure_str


@dataclass(frozen=True)
class Repair:
    """How to restore one column: kind, fallback column and the allowed values of enums."""

    kind: str
    fallback: str | Column
    allowed: Sequence[str] = ()


# ---- fixed values: retail enumerations ----
PAYMENT_STATUS = ("PENDING", "SETTLED", "FAILED")


def repair(df: DataFrame, spec: Mapping[str, Repair]) -> DataFrame:
    """Replace unusable values by their fallbacks, all columns in one projection."""

    def fixed(name: str, rule: Repair) -> Column:
        fallback = F.col(rule.fallback) if isinstance(rule.fallback, str) else rule.fallback
        if rule.kind == "str":
            return ensure_str(name, fallback)
        if rule.kind == "int":
            return ensure_int(name, fallback)
        if rule.kind == "float":
            return ensure_float(name, fallback)
        if rule.kind == "enum":
            return clamp_enum(name, rule.allowed, fallback)
        raise ValueError(f"unknown repair kind {rule.kind!r}")

    return df.withColumns({name: fixed(name, rule) for name, rule in spec.items()})
