"""The ingest cycle: source rows become rows of a silver table.

Order of the steps: read from the high-water mark, transform, set soft-deleted rows apart, gate
the rest, upsert what passed, delete what was flagged. Upsert and delete are one write, so a key
that is both ends up deleted.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from contextlib import ExitStack
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import transforms
from tidemark.functions.scalars import MONEY, has_column
from tidemark.functions.transforms import cast_money, normalized_name
from tidemark.operators.incremental import apply_lag, highest_cursor
from tidemark.operators.merge import apply_changes, one_row_per_key, soft_delete_flag, without_keys
from tidemark.operators.quality import (
    Gate,
    QualityError,
    Report,
    Rules,
    bad_rows,
    good_rows,
    inspect,
    unstorable,
)
from tidemark.plans.lake import Lake
from tidemark.plans.specs import Ingest
from tidemark.session import landed
from tidemark.sinks.tables import Table
from tidemark.sources.csv import MALFORMED
from tidemark.sources.extract import extract

log = logging.getLogger(__name__)


Keep = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Split:
    """A gated batch: rows to upsert, rows whose keys are deleted, and rejects."""

    good: DataFrame
    dead: DataFrame | None
    rejects: DataFrame | None
    report: Report | None
    unique: bool  # the gate found the primary key unique among the good rows


def split_deletes(batch: DataFrame, column: str | None) -> tuple[DataFrame, DataFrame | None]:
    """Live rows and soft-deleted rows. Without the flag column there is nothing to split."""
    if not column or not has_column(batch, column):
        return batch, None
    dead = soft_delete_flag(batch, column)
    if has_column(batch, MALFORMED):  # a line that could not be read deletes nothing
        dead = dead & F.col(MALFORMED).isNull()
    return batch.where(~dead), batch.where(dead)


def as_it_is(df: DataFrame) -> DataFrame:
    return df


def gate(
    name: str,
    live: DataFrame,
    rules: Rules | None,
    primary_key: str,
    keep: Keep = as_it_is,
    money: tuple[str, ...] = (),
) -> Split:
    """Apply the rules the way ``on_fail`` says; raise if that is abort and a rule was broken.

    ``keep`` stores a frame that is costly to derive and is read several times. Rows that could not be
    stored (malformed lines, amounts too large) break a rule as well; without rules they raise.
    """
    if rules is None:
        checks = unstorable(live, money)
        if checks:
            counts = live.agg(*(F.count_if(check).alias(rule) for rule, check in checks.items())).first().asDict()
            if any(counts.values()):
                raise QualityError(f"[{name}] rows that cannot be stored: {counts}")
        return Split(live, None, None, None, unique=False)
    rules = replace(rules, money=tuple(money))
    outcome: Gate = inspect(live, rules, primary_key)
    report, keyed = outcome.report, primary_key in outcome.repeats
    if report.passed:
        return Split(live, None, None, report, unique=has_column(live, primary_key))
    log.warning("[%s] %s -> on_fail=%s", name, report.summary(), rules.on_fail)
    if rules.on_fail == "abort":
        raise QualityError(f"[{name}] {report.summary()}")
    if rules.on_fail == "warn":
        return Split(live, None, None, report, unique=not keyed)
    flagged = keep(outcome.flagged()) if outcome.repeats else outcome.flagged()
    return Split(good_rows(flagged), None, bad_rows(flagged), report, unique=True)


def gated(name: str, batch: DataFrame, spec: Ingest, keep: Keep = as_it_is) -> Split:
    """Split a transformed batch that reads the same each time."""
    live, dead = split_deletes(batch, spec.soft_delete_column)
    checked = gate(name, live, spec.quality, spec.primary_key, keep, spec.money_columns)
    dead = None if dead is None else dead.drop(MALFORMED)
    return Split(checked.good.drop(MALFORMED), dead, checked.rejects, checked.report, checked.unique)


def cycle(target: DataFrame, batch: DataFrame, spec: Ingest) -> DataFrame:
    """What the target holds after a load, as a frame: the cycle without reading or writing files.

    ``batch`` must be immutable, such as a Parquet scan.
    """
    parts = gated(spec.name, transforms.apply(spec.transforms, batch), spec)
    good = parts.good if parts.unique else one_row_per_key(parts.good, spec.primary_key, spec.cursor)
    good = cast_money(good, spec.money_columns)
    dead = good.limit(0) if parts.dead is None else parts.dead
    return apply_changes(target, good, dead, spec.primary_key)


def cast_lossless_money(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Cast the amounts that arrive as whole numbers or narrow decimals: no rule can see a difference.

    Floating amounts are cast after the gate, which must see NaN and amounts that round to zero.
    """
    wanted = {c.lower() for c in columns}

    def fits(dtype: T.DataType) -> bool:
        if isinstance(dtype, T.DecimalType):
            return dtype.scale <= MONEY.scale and dtype.precision - dtype.scale <= MONEY.precision - MONEY.scale
        return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType))

    return cast_money(df, [f.name for f in df.schema.fields if f.name.lower() in wanted and fits(f.dataType)])


def money_is_exact(df: DataFrame, columns: tuple[str, ...]) -> bool:
    wanted = {c.lower() for c in columns}
    return all(f.dataType == MONEY for f in df.schema.fields if f.name.lower() in wanted)


def cursor_in(df: DataFrame, cursor: str | None) -> str | None:
    """The cursor as the batch spells it after its transforms."""
    if not cursor:
        return None
    return next((c for c in (cursor, normalized_name(cursor)) if has_column(df, c)), None)


def batch_facts(batch: DataFrame, soft_delete_column: str | None, cursor: str | None) -> tuple:
    """Rows, soft-deleted rows, and the highest cursor: one job over at most two columns."""
    highest = highest_cursor(batch, cursor) if cursor else F.lit(None)
    dead = F.count_if(soft_delete_flag(batch, soft_delete_column))
    return tuple(batch.agg(F.count(F.lit(1)), dead, highest).first())


def run_ingest(lake: Lake, spec: Ingest) -> int:
    """Run one ingest and return the number of rows that passed the gate.

    The batch is read from its source once: it lands in the shared scratch folder, so that the gate
    and the write see the same rows even if the source changes or an executor is lost.
    """
    spark, table, load_id = lake.spark, lake.silver_of(spec), str(uuid.uuid4())
    watermark = None
    if spec.cursor:
        watermark = apply_lag(table.max_cursor(spec.cursor), spec.lag_seconds)
    batch = transforms.apply(spec.transforms, extract(spark, spec.source, spec.cursor, watermark, mark_malformed=True))
    batch = cast_lossless_money(batch, spec.money_columns)
    fresh = spec.write_mode == "overwrite" or not table.exists()
    with ExitStack() as stack:
        batch = stack.enter_context(landed(batch, spec.name))
        cursor = cursor_in(batch, spec.cursor)
        total, deleted, reached = batch_facts(batch, spec.soft_delete_column, cursor)
        if total == 0:
            log.info("[%s] no new rows", spec.name)
            return 0
        parts = gated(spec.name, batch, spec, lambda df: stack.enter_context(landed(df, spec.name)))
        rejected = parts.report.bad_count if parts.rejects is not None else 0
        written = total - deleted - rejected
        keyed = spec.write_mode == "merge"
        good = parts.good
        if keyed and not parts.unique:
            good = one_row_per_key(parts.good, spec.primary_key, cursor)
            if good is not parts.good:
                good = stack.enter_context(landed(good, spec.name))
        store(table, cast_money(good, spec.money_columns), parts.dead, spec, fresh, written, deleted)
        if rejected:  # after the table: a load that fails leaves no rejects behind
            parts.rejects.write.parquet(f"{lake.rejects_path(spec.table)}/_load_id={load_id}")
        lake.loads().record(load_id, spec.table, "loaded", written, rejected, deleted, reached)
        log.info("[%s] %d rows, %d rejected, %d deleted", spec.name, written, rejected, deleted)
        return written


def store(
    table: Table, good: DataFrame, dead: DataFrame | None, spec: Ingest, fresh: bool, written: int, deleted: int
) -> None:
    """Write a gated batch, with its deletes in the same write."""
    key = spec.primary_key
    if fresh:
        if written:
            rows = without_keys(good, dead, key, deleted) if deleted else good
            table.overwrite(rows)
        elif deleted and table.exists():
            table.delete(dead, key)
    elif spec.write_mode == "append":
        table.append_and_delete(good, dead if deleted else None, key)
    elif written or deleted:
        table.merge(good, dead if deleted else None, key=key)
