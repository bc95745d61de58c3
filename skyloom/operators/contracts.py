"""Declarative data contracts: coerce, check every rule, split valid rows from reported ones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIOLATIONS = "_violations"


class ContractError(Exception):
    """Input that breaks a contract in a way no row can be blamed for, or on request."""


@dataclass(frozen=True)
class ColumnRule:
    """Type, nullability and allowed values of one column; bounds are inclusive."""

    column: str
    kind: str = "double"
    nullable: bool = True
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple = ()
    required: bool = True

    def coerced(self) -> Column:
        value = F.col(self.column).try_cast(self.kind)
        return F.when(~F.isnan(value), value) if self.kind == "double" else value

    def failures(self, raw: str) -> list[tuple[str, Column]]:
        """Names and conditions of the checks a row can fail; ``raw`` is the value as read."""
        value = F.col(self.column)
        found = []
        if self.kind != "string":
            unreadable = F.col(raw).isNotNull() & value.isNull()
            if self.kind == "double":
                unreadable = unreadable & ~F.coalesce(
                    F.isnan(F.col(raw).try_cast("double")), F.lit(False)
                )
            found.append((f"coerce_{self.kind}", unreadable))
        if not self.nullable:
            found.append(("not_null", value.isNull()))
        if self.minimum is not None or self.maximum is not None:
            outside = F.lit(False)
            if self.minimum is not None:
                outside = outside | (value < self.minimum)
            if self.maximum is not None:
                outside = outside | (value > self.maximum)
            found.append((f"in_range({self.minimum:g}, {self.maximum:g})", outside))
        if self.allowed:
            found.append(("isin", ~value.isin(*self.allowed)))
        return found


@dataclass(frozen=True)
class Contract:
    name: str
    rules: Sequence[ColumnRule] = field(default_factory=tuple)


def judge(df: DataFrame, contract: Contract | None) -> tuple[DataFrame, Column, Column]:
    """Coerced rows with their values as read beside them, whether a row fails, and its violations.

    Columns without a rule pass through; a missing required column raises. The second column is all
    that a good row costs; the third is only worth working out for rows that fail.
    """
    if contract is None:
        return df, F.lit(False), F.lit(None).cast("array<struct<column:string,check:string,value:string>>")
    missing = [r.column for r in contract.rules if r.required and r.column not in df.columns]
    if missing:
        raise ContractError(f"{contract.name}: required columns are absent: {missing}")
    rules = [r for r in contract.rules if r.column in df.columns]
    raw = {f"_raw_{r.column}": F.col(r.column) for r in rules}
    out = df.withColumns(raw).withColumns({r.column: r.coerced() for r in rules})
    tests = [(r.column, name, F.coalesce(failed, F.lit(False))) for r in rules for name, failed in r.failures(f"_raw_{r.column}")]
    cases = [
        F.when(
            failed,
            F.struct(
                F.lit(column).alias("column"),
                F.lit(name).alias("check"),
                F.col(f"_raw_{column}").cast("string").alias("value"),
            ),
        )
        for column, name, failed in tests
    ]
    fails = reduce(Column.__or__, [failed for _, _, failed in tests], F.lit(False))
    return out, fails, F.array_compact(F.array(*cases))


def check(df: DataFrame, contract: Contract | None) -> DataFrame:
    """Coerced rows plus an array of violations, empty where the row is valid."""
    out, fails, cases = judge(df, contract)
    none = F.array().cast("array<struct<column:string,check:string,value:string>>")
    told = out.withColumn(VIOLATIONS, cases if contract is None else F.when(fails, cases).otherwise(none))
    return told.select(*df.columns, VIOLATIONS)


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid rows, failure cases)`` of a frame that ``check`` made, for one that has been stored."""
    columns = [c for c in checked.columns if c != VIOLATIONS]
    clean = F.coalesce(F.size(VIOLATIONS) <= 0, F.lit(True))
    return checked.where(clean).select(*columns), _cases(checked.where(~clean), columns, F.col(VIOLATIONS))


def _cases(rows: DataFrame, columns: Sequence[str], violations: Column) -> DataFrame:
    told = rows.withColumn("_violation", F.explode(violations))
    return told.select(*columns, *[F.col(f"_violation.{c}").alias(f"failed_{c}") for c in ("column", "check", "value")])


def validate(
    df: DataFrame, contract: Contract | None, *, fail_on_violation: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(valid rows, failure cases)``; a row with several failures is dropped once.

    Failure cases hold one row per row and failed check, with every column of the row.
    """
    judged, fails, cases = judge(df, contract)
    valid = judged.where(~fails).select(*df.columns)
    failures = _cases(judged.where(fails), df.columns, cases)
    if fail_on_violation and contract is not None and not failures.isEmpty():
        raise ContractError(f"{contract.name}: the data violates its contract")
    return valid, failures
