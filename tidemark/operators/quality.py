"""The quality gate: which rows of a batch break which declared rule.

Rules that look at one row are plain columns. Uniqueness needs the whole batch; it is counted over
the key alone, never by moving whole rows, and the few repeated keys are joined back only when
something was found and the bad rows themselves are asked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import MONEY, field_type, has_column, is_missing, is_positive, key_digest
from tidemark.sources.csv import MALFORMED

FAILED = "_failed"

ON_FAIL = ("abort", "warn", "quarantine")

# Repeated keys are broadcast up to this count (a key is at most 32 bytes, see key_digest);
# above it they are joined by a shuffle, where AQE splits a key that holds many rows.
BROADCAST_KEYS = 1_000_000


class QualityError(Exception):
    """A batch broke its rules and the gate is set to abort."""


@dataclass(frozen=True)
class Rules:
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    on_fail: str = "abort"
    #: Amounts that have to fit the type that money is stored in.
    money: tuple[str, ...] = ()

    def __post_init__(self):
        if self.on_fail not in ON_FAIL:
            raise ValueError(f"on_fail is {self.on_fail!r}; use one of {', '.join(ON_FAIL)}")

    @classmethod
    def of(cls, rules: Mapping | Rules) -> Rules:
        if isinstance(rules, Rules):
            return rules
        lists = {k: tuple(rules.get(k) or ()) for k in ("not_null", "unique", "positive")}
        return cls(**lists, on_fail=rules.get("on_fail", "abort"))


@dataclass(frozen=True)
class Report:
    total: int
    failures: dict[str, int] = field(default_factory=dict)
    bad_count: int = 0

    @property
    def passed(self) -> bool:
        return not self.failures

    def summary(self) -> str:
        counts = "; ".join(f"{rule}={n}" for rule, n in self.failures.items())
        return f"{self.bad_count} of {self.total} rows break rules" + (f" ({counts})" if counts else "")


def row_rules(df: DataFrame, rules: Rules) -> dict[str, Column]:
    """Rules decided by the row alone, as never-null boolean columns that are true for bad rows.

    A missing column is bad everywhere for not_null and is skipped by positive.
    """
    checks = {}
    for name in rules.not_null:
        present = has_column(df, name)
        checks[f"not_null:{name}"] = (
            is_missing(F.col(name), field_type(df, name)) if present else F.lit(True)
        )
    for name in rules.positive:
        if has_column(df, name):
            checks[f"positive:{name}"] = ~is_positive(F.col(name), field_type(df, name))
    return {**checks, **unstorable(df, rules.money)}


def unstorable(df: DataFrame, money: Iterable[str]) -> dict[str, Column]:
    """Rules that always hold: lines that could be read, and amounts that fit the type of money."""
    checks = {}
    if has_column(df, MALFORMED):
        checks["malformed"] = F.col(MALFORMED).isNotNull()
    for name in money:
        if has_column(df, name) and field_type(df, name) != MONEY:
            value = F.col(name)
            checks[f"money:{name}"] = ~is_missing(value, field_type(df, name)) & value.try_cast(MONEY).isNull()
    return checks


def unique_columns(df: DataFrame, rules: Rules, primary_key: str | None) -> list[str]:
    """The declared columns and always the primary key, each checked on its own."""
    named = dict.fromkeys([*rules.unique, *([primary_key] if primary_key else [])])
    return [c for c in named if has_column(df, c)]


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Key values that occur more than once, with their row counts; nulls count as equal.

    Counts are combined before the shuffle, so a value that fills a third of the batch costs one
    row per task.
    """
    keys = df.select(key_digest(df, column).alias("_key"))
    return keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")


def measure(df: DataFrame, rules: Rules, primary_key: str | None) -> DataFrame:
    """All counts of the gate in long form ``(rule, rows, keys)``, as one job.

    One scan counts the total, every row rule and the rows that break any of them; each unique
    column adds one aggregation over its keys.
    """
    checks = row_rules(df, rules)
    any_bad = F.lit(False)
    for check in checks.values():
        any_bad = any_bad | check
    counted = {"total": F.count(F.lit(1)), "any_row_rule": F.count_if(any_bad)}
    counted.update({name: F.count_if(check) for name, check in checks.items()})
    pairs = [F.struct(F.lit(n).alias("rule"), c.alias("rows")) for n, c in counted.items()]
    counts = df.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))
    counts = counts.withColumn("keys", F.lit(0).cast("bigint"))
    for name in unique_columns(df, rules, primary_key):
        counts = counts.unionByName(
            repeated_keys(df, name).agg(
                F.lit(f"unique:{name}").alias("rule"),
                F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
                F.count(F.lit(1)).alias("keys"),
            )
        )
    return counts


def flag_rows(
    df: DataFrame,
    rules: Mapping | Rules,
    primary_key: str | None = None,
    *,
    unique: Iterable[str] | None = None,
    broadcastable: Iterable[str] = (),
) -> DataFrame:
    """Add ``_failed``, the names of the rules a row breaks (empty for a good row).

    ``unique`` limits the uniqueness joins to the columns known to have repeats, and
    ``broadcastable`` names those whose repeated keys were counted and are few. Without counts
    the join strategy is left to Spark's own size estimates.
    """
    rules = Rules.of(rules)
    columns = unique_columns(df, rules, primary_key) if unique is None else list(unique)
    names = [F.when(check, F.lit(rule)) for rule, check in row_rules(df, rules).items()]
    flagged = df
    for i, column in enumerate(columns):
        own, key, hit = f"_own{i}", f"_key{i}", f"_hit{i}"
        repeats = repeated_keys(df, column).select(F.col("_key").alias(key), F.lit(True).alias(hit))
        if column in set(broadcastable):
            repeats = F.broadcast(repeats)
        # The digest is computed once as a column: as a join key it would be computed twice.
        flagged = flagged.withColumn(own, key_digest(df, column))
        flagged = flagged.join(repeats, F.col(own).eqNullSafe(F.col(key)), "left")
        names.append(F.when(F.col(hit), F.lit(f"unique:{column}")))
    failed = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return flagged.select(*(F.col(f"`{c}`") for c in df.columns), failed.alias(FAILED))


def good_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size(FAILED) == 0).drop(FAILED)


def bad_rows(flagged: DataFrame) -> DataFrame:
    """The rejects, which keep the names of the rules they broke."""
    return flagged.where(F.size(FAILED) > 0)


@dataclass(frozen=True)
class Gate:
    """Outcome of one inspection: the counts, and how to tell the bad rows when they are needed."""

    report: Report
    batch: DataFrame
    rules: Rules
    repeats: dict[str, int]

    def flagged(self) -> DataFrame:
        few = [c for c, keys in self.repeats.items() if keys <= BROADCAST_KEYS]
        return flag_rows(self.batch, self.rules, unique=self.repeats, broadcastable=few)


def inspect(batch: DataFrame, rules: Mapping | Rules, primary_key: str | None = None) -> Gate:
    """Count every violation. The batch must read the same twice (a landed or immutable one).

    A clean batch costs one job and no join. The rows that break any rule are counted by a second
    job only when uniqueness was broken, as only then two rules of different kinds can overlap.
    """
    rules = Rules.of(rules)
    counts = {r["rule"]: r for r in measure(batch, rules, primary_key).collect()}
    total, by_row = counts.pop("total")["rows"], counts.pop("any_row_rule")["rows"]
    failures = {rule: r["rows"] for rule, r in counts.items() if r["rows"]}
    repeats = {
        rule.removeprefix("unique:"): counts[rule]["keys"]
        for rule in failures
        if rule.startswith("unique:")
    }
    gate = Gate(Report(total, failures, by_row), batch, rules, repeats)
    if not repeats:
        return gate
    bad = by_row
    if len(repeats) > 1 or len(failures) > 1:
        bad = bad_rows(gate.flagged()).count()
    else:
        bad = next(iter(failures.values()))
    return Gate(Report(total, failures, bad), batch, rules, repeats)


def report_frame(df: DataFrame, rules: Mapping | Rules, primary_key: str | None = None) -> DataFrame:
    """The report of an inspection as one row: total, one count per rule, and rows that break any rule."""
    rules = Rules.of(rules)
    report = inspect(df, rules, primary_key).report
    names = [*row_rules(df, rules), *(f"unique:{c}" for c in unique_columns(df, rules, primary_key))]
    counts = {n.replace(":", "_"): report.failures.get(n, 0) for n in names}
    row = {"total": report.total, **counts, "bad_count": report.bad_count}
    schema = ", ".join(f"`{name}` bigint" for name in row)
    return df.sparkSession.createDataFrame([tuple(row.values())], schema)
