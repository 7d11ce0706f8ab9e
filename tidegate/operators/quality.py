"""Quality rules, the failing-row mark, the split into clean and review, and re-queueing.

Row rules are plain predicates. Rules about a set of rows (unique, references) find
the offending or known keys by aggregation, which is partial before the shuffle, and
join them back to the rows from the left, so a value held by very many rows neither
gathers in one window task nor blocks AQE from splitting it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import any_null, apart, keys_equal, quoted
from tidegate.functions.names import key_list
from tidegate.operators.dml import update_from
from tidegate.operators.sizing import settle

FAILED = "_failed_rules"


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"not_null({self.column})"

    def fails(self) -> Column:
        return quoted(self.column).isNull()


@dataclass(frozen=True)
class Accepted:
    column: str
    values: tuple

    @property
    def name(self) -> str:
        return f"accepted_values({self.column})"

    def fails(self) -> Column:
        return quoted(self.column).isNotNull() & ~quoted(self.column).isin(*self.values)


@dataclass(frozen=True)
class Where:
    """A free row rule: rows meeting the SQL predicate fail."""

    name: str
    predicate: str

    def fails(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


@dataclass(frozen=True)
class Unique:
    column: str

    @property
    def name(self) -> str:
        return f"unique({self.column})"


@dataclass(frozen=True)
class References:
    column: str
    parent: DataFrame
    parent_column: str

    @property
    def name(self) -> str:
        return f"relationships({self.column})"


Rule = NotNull | Accepted | Where | Unique | References


def _flag_copies(df: DataFrame, rule: Unique, scope: list[str], flag: str, measured: bool) -> DataFrame:
    names = [*scope, rule.column]
    copies = (
        df.where(~any_null(names))
        .groupBy(*[quoted(n) for n in names])
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > 1)
        .select(*[apart(n).alias(f"{flag}{i}") for i, n in enumerate(names)], F.lit(True).alias(flag))
    )
    if measured:
        copies = settle(copies).frame
    side = [f"{flag}{i}" for i in range(len(names))]
    return df.join(copies, keys_equal(names, side), "left").drop(*side)


def _flag_orphans(df: DataFrame, rule: References, flag: str) -> DataFrame:
    known = (
        rule.parent.where(quoted(rule.parent_column).isNotNull())
        .select(quoted(rule.parent_column).alias(f"{flag}0"))
        .distinct()
        .select(apart(f"{flag}0").alias(f"{flag}0"), F.lit(True).alias(flag))
    )
    return df.join(known, keys_equal([rule.column], [f"{flag}0"]), "left").drop(f"{flag}0")


def mark(df: DataFrame, rules: Sequence[Rule], scope: Sequence[str] = (), measured: bool = False) -> DataFrame:
    """Add `_failed_rules`: the names of the rules each row fails, in rule order.

    `scope` names columns within which uniqueness holds, such as file and attempt.
    `measured` computes the set of duplicate values first and broadcasts it if small,
    which spares shuffling the rows; it starts a job of its own.
    """
    verdicts, fails, flags, kept = [], [], [], df.columns
    for i, rule in enumerate(rules):
        if isinstance(rule, Unique):
            flag = f"__rule{i}_"
            df = _flag_copies(df, rule, list(scope), flag, measured)
            failing = F.col(flag).isNotNull()
            flags.append(flag)
        elif isinstance(rule, References):
            flag = f"__rule{i}_"
            df = _flag_orphans(df, rule, flag)
            failing = quoted(rule.column).isNotNull() & F.col(flag).isNull()
            flags.append(flag)
        else:
            failing = rule.fails()
        verdicts.append(F.when(failing, F.lit(rule.name)))
        fails.append(F.coalesce(failing, F.lit(False)))
    failed = none = F.array().cast("array<string>")
    if verdicts:
        # Names are gathered for failing rows only: a function over an array's elements is not compiled.
        failed = F.when(reduce(or_, fails), F.array_compact(F.array(*verdicts))).otherwise(none)
    return df.select(*[quoted(c) for c in kept], failed.alias(FAILED))


def failing_any(rules: Sequence[Rule]) -> Column:
    """OR of the row rules' predicates, for rules that need only the row itself."""
    return reduce(lambda a, b: a | b, [r.fails() for r in rules], F.lit(False))


def clean_rows(marked: DataFrame) -> DataFrame:
    return marked.where(F.size(FAILED) == 0).drop(FAILED)


def review_rows(marked: DataFrame) -> DataFrame:
    return marked.where(F.size(FAILED) > 0)


def verdict(marked: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per file (or whatever `by` names): rows read, rows failing, and success."""
    return (
        marked.groupBy(*[quoted(b) for b in by])
        .agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(F.size(FAILED) > 0).alias("rows_failed"))
        .withColumn("success", F.col("rows_failed") == 0)
    )


def failures(marked: DataFrame, by: Sequence[str]) -> DataFrame:
    """How many rows fail each rule, per file; rules nobody fails do not appear."""
    return (
        marked.select(*[quoted(b) for b in by], F.explode(FAILED).alias("rule"))
        .groupBy(*[quoted(b) for b in by], "rule")
        .agg(F.count(F.lit(1)).alias("rows_failed"))
    )


def requeue(review: DataFrame, fixes: DataFrame, keys: str | Sequence[str], increment: str = "increment") -> DataFrame:
    """Quarantined rows as the next attempt's staged rows, corrected where a fix exists.

    `fixes` holds the keys and the columns it corrects, at most one row per key.
    """
    fixed = update_from(review.drop(FAILED), fixes, key_list(keys))
    if increment in review.columns:
        fixed = fixed.withColumn(increment, quoted(increment) + F.lit(1))
    return fixed
