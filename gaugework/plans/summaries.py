"""Stored summaries of a metric view: kept up by deltas, and chosen to answer queries.

A measure is a formula over partial aggregates. Partials whose values of two groups can be put together (sums,
minima, maxima) are stored by a set of dimensions, the grain; formulas are applied last, so that a ratio is one of
sums. A query is answered from the smallest stored grain that has its dimensions, those of its filters, and all
partials of its measures; otherwise from the source.

A delta is a summary of added rows less one of removed rows. It is merged with the touched partitions alone: the
new state of these is written beside the store first and published by overwriting just them, so that a delta that is
repeated after a failure is published again, never added twice. Deltas of one store take turns.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .semantic import MetricView, metric_query

ROWS = "summarised_rows"
TOGETHER = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Partial:
    """An aggregate over the source, and how its values are put together; ``how`` None: not at all."""

    expression: str
    how: str | None = "sum"


@dataclass(frozen=True)
class Definition:
    """Partials and formulas over them; the view's own measures aren't used."""

    view: MetricView
    partials: Mapping[str, Partial]
    formulas: Mapping[str, str]

    def needed(self, measures: Sequence[str]) -> list[str]:
        """Partials that the formulas mention."""
        unknown = [m for m in measures if m not in self.formulas]
        if unknown:
            raise ValueError(f"unknown field {unknown[0]}")
        words = {w for m in measures for w in re.findall(r"[A-Za-z_]\w*", self.formulas[m])}
        return [p for p in self.partials if p in words]

    def adds_up(self, partials: Sequence[str]) -> bool:
        return all(self.partials[p].how for p in partials)


@dataclass(frozen=True)
class Stored:
    """A summary: its folder, grain, partials, the dimension it is partitioned by, and its schema as JSON."""

    path: str
    grain: tuple[str, ...]
    partials: tuple[str, ...]
    partition: str
    schema: str

    def groups(self, spark: SparkSession) -> DataFrame:
        """All groups, also those that deltas have emptied; folder names are read as what was written."""
        return spark.read.schema(StructType.fromJson(json.loads(self.schema))).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.groups(spark).where(F.col(ROWS) != 0)


def summarise(definition: Definition, grain: Sequence[str], partials: Sequence[str], source: DataFrame | None = None) -> DataFrame:
    """Partials by grain, with the number of rows, from the view or from other rows in place of its source."""
    aggregates = {p: definition.partials[p].expression for p in partials} | {ROWS: "count(1)"}
    view = replace(definition.view, measures=aggregates, **({} if source is None else {"source": source}))
    return metric_query(view, grain, [*partials, ROWS])


def put_together(rows: DataFrame, definition: Definition, grain: Sequence[str], partials: Sequence[str]) -> DataFrame:
    """Partials of equal groups as one; sums keep their type."""
    kinds = {p: rows.schema[p].dataType for p in (*partials, ROWS)}
    how = {**{p: definition.partials[p].how for p in partials}, ROWS: "sum"}
    return rows.groupBy(*grain).agg(*[TOGETHER[h](p).cast(kinds[p]).alias(p) for p, h in how.items()])


def store(definition: Definition, path: str, grain: Sequence[str], partials: Sequence[str], partition: str) -> Stored:
    """Write the summary of the whole source."""
    if not definition.adds_up(partials):
        raise ValueError("only partials that add up can be stored")
    if partition not in grain:
        raise ValueError("the partition is a dimension of the grain")
    rows = summarise(definition, grain, partials)
    rows.hint("rebalance", partition).write.partitionBy(partition).parquet(path)
    return Stored(path, tuple(grain), tuple(partials), partition, rows.schema.json())


def delta(definition: Definition, stored: Stored, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """The summary of added rows less that of removed rows; a correction is both."""
    out = None
    if added is not None:
        out = summarise(definition, stored.grain, stored.partials, added)
    if removed is not None:
        if fixed := [p for p in stored.partials if definition.partials[p].how != "sum"]:
            raise ValueError(f"rows can't be taken out of {fixed[0]}")
        gone = summarise(definition, stored.grain, stored.partials, removed)
        gone = gone.withColumns({p: (-F.col(p)).cast(gone.schema[p].dataType) for p in (*stored.partials, ROWS)})
        out = gone if out is None else out.unionByName(gone)
    if out is None:
        raise ValueError("a delta has added or removed rows")
    return out


def _there(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _mark(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([("done",)], "value string").coalesce(1).write.mode("overwrite").text(path)


def apply_delta(definition: Definition, stored: Stored, change: DataFrame, name: str) -> bool:
    """Merge a delta into the partitions it touches; false if the delta of that name has been applied before."""
    spark, staged = change.sparkSession, f"{stored.path}/_staged/{name}"
    applied, ready = f"{stored.path}/_applied/{name}", f"{stored.path}/_ready/{name}"
    if _there(spark, applied):
        return False
    if not _there(spark, ready):
        change = change.persist()
        try:
            values = [r[0] for r in change.select(stored.partition).distinct().collect()]  # partitions of the store
            touched = F.col(stored.partition).isin([v for v in values if v is not None])
            if None in values:
                touched = touched | F.col(stored.partition).isNull()
            old = stored.groups(spark).where(touched).select(*change.columns)
            kinds = {f.name: f.dataType for f in old.schema.fields}
            both = old.unionByName(change.select(*[F.col(c).cast(kinds[c]).alias(c) for c in change.columns]))
            # groups without rows stay as zeros: else a partition that becomes empty would keep its old rows
            put_together(both, definition, stored.grain, stored.partials).write.mode("overwrite").parquet(staged)
        finally:
            change.unpersist()
        _mark(spark, ready)
    new = spark.read.parquet(staged).hint("rebalance", stored.partition)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(stored.partition).parquet(stored.path)
    _mark(spark, applied)
    return True


def covering(definition: Definition, stores: Mapping[Stored, int], dimensions: Sequence[str], measures: Sequence[str], filters: Sequence[str] = ()) -> Stored | None:
    """The stored summary with the fewest rows that can answer; ``stores`` has their numbers of rows."""
    wanted, partials = {*dimensions, *filters}, definition.needed(measures)
    if not definition.adds_up(partials):
        return None
    able = [s for s in stores if wanted <= set(s.grain) and set(partials) <= set(s.partials)]
    return min(able, key=lambda s: (stores[s], s.path), default=None)


def answer(
    spark: SparkSession, definition: Definition, stores: Mapping[Stored, int], dimensions: Sequence[str], measures: Sequence[str], filters: Mapping[str, Sequence] | None = None
) -> DataFrame:
    """The measures by the dimensions, for rows whose filtered dimensions have one of the given values."""
    filters, partials = filters or {}, definition.needed(measures)
    if unknown := [d for d in (*dimensions, *filters) if d not in definition.view.dimensions]:
        raise ValueError(f"unknown field {unknown[0]}")
    found = covering(definition, stores, dimensions, measures, list(filters))
    if found is not None:
        rows = found.read(spark)
        for name, values in filters.items():
            rows = rows.where(F.col(name).isin(list(values)))
        rows = put_together(rows, definition, dimensions, partials)
    else:
        view = definition.view
        kept = [f"({view.filter})"] if view.filter else []
        kept += [f"({view.dimensions[d]}) IN ({', '.join(map(_literal, values))})" for d, values in filters.items()]
        rows = summarise(replace(definition, view=replace(view, filter=" AND ".join(kept) or None)), dimensions, partials)
    return rows.select(*dimensions, *[F.expr(definition.formulas[m]).alias(m) for m in measures])


def _literal(value) -> str:
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
