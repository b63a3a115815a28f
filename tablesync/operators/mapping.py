"""Declarative column mapping, compiled to a single projection."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import convert


@dataclass(frozen=True)
class MappedColumn:
    """How one source column reaches the output.

    ``using`` replaces the value by an expression over it, ``cast`` is applied after
    that, and ``target`` renames.
    """

    source: str
    target: str | None = None
    cast: str | None = None
    lenient: bool = False
    using: Callable[[Column], Column] | None = None

    @property
    def name(self) -> str:
        return self.target or self.source

    @property
    def only_renames(self) -> bool:
        return self.cast is None and self.using is None

    def value(self, dtype: T.DataType | None = None) -> Column:
        """The target column; ``dtype`` is the type of the source column."""
        column = quoted(self.source)
        if self.using is not None:
            column = self.using(column)
        if self.cast is not None:
            column = convert(column, self.cast, self.lenient, None if self.using else dtype)
        return column.alias(self.name)


@dataclass(frozen=True)
class ColumnMap:
    """Renames, casts, replaced and derived columns of one table.

    Columns without an entry pass through in place unless ``passthrough`` is off. An
    entry that only renames is skipped when its column is absent (``on_missing="ignore"``)
    or raises (``"error"``); an entry that computes always needs its column. Names match
    without regard to case, as in Spark. ``derived`` columns are computed from the source
    columns and go last.
    """

    columns: Sequence[MappedColumn] = ()
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    passthrough: bool = True
    on_missing: str = "ignore"

    def project(self, schema: T.StructType) -> list[Column]:
        entries = self._matched(schema)
        names, projection = [], []
        for source in schema.names:
            entry = entries.get(source.lower())
            if entry is None and not self.passthrough:
                continue
            names.append(entry.name if entry else source)
            projection.append(entry.value(schema[source].dataType) if entry else quoted(source))
        for name, value in self.derived.items():
            names.append(name)
            projection.append(value().alias(name))
        clashes = sorted({n for n in names if [m.lower() for m in names].count(n.lower()) > 1})
        if clashes:
            raise ValueError(f"mapping gives two columns the same name: {clashes}")
        return projection

    def apply(self, df: DataFrame) -> DataFrame:
        return df.select(*self.project(df.schema))

    def cast_losses(self, schema: T.StructType) -> list[Column]:
        """One count per lenient cast: values that were present and became NULL.

        The counts are over the source columns, so they can be observed below the
        projection in the pass that writes it.
        """
        losses = []
        types = {f.name.lower(): f.dataType for f in schema.fields}
        for source, entry in self._matched(schema).items():
            if entry.cast is not None and entry.lenient:
                before = entry.using(quoted(entry.source)) if entry.using else quoted(entry.source)
                dtype = None if entry.using else types[source]
                lost = before.isNotNull() & convert(before, entry.cast, True, dtype).isNull()
                losses.append(F.count_if(lost).alias(f"lost_{entry.name}"))
        return losses

    def _matched(self, schema: T.StructType) -> dict[str, MappedColumn]:
        present = {name.lower() for name in schema.names}
        matched: dict[str, MappedColumn] = {}
        for entry in self.columns:
            source = entry.source.lower()
            if source in matched:
                raise ValueError(f"{entry.source} is mapped twice")
            if source in present:
                matched[source] = entry
            elif self.on_missing == "error" or not entry.only_renames:
                raise ValueError(f"{entry.source} is mapped but the source has no such column")
        return matched


def quoted(name: str) -> Column:
    """Column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def select_typed(df: DataFrame, values: Sequence[Column], target: T.StructType) -> DataFrame:
    """Fill a fixed column list by position and check the result against its types.

    The values meet the names in order, as in ``INSERT INTO t (names) SELECT values``.
    """
    if len(values) != len(target.fields):
        raise ValueError(f"{len(values)} values for {len(target.fields)} target columns")
    out = df.select(*[v.alias(f.name) for v, f in zip(values, target.fields)])
    wrong = [
        f"{got.name}: {got.dataType.simpleString()} is not {want.dataType.simpleString()}"
        for got, want in zip(out.schema.fields, target.fields)
        if got.dataType.simpleString() != want.dataType.simpleString()
    ]
    if wrong:
        raise TypeError("; ".join(wrong))
    return out


def union_rows(base: DataFrame, increment: DataFrame, allow_new_columns: bool = False) -> DataFrame:
    """Bag union by name. A column that changed its type is an error, not a widening."""
    types = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    changed = [
        f"{f.name}: {types[f.name]} became {f.dataType.simpleString()}"
        for f in increment.schema.fields
        if f.name in types and types[f.name] != f.dataType.simpleString()
    ]
    if changed:
        raise TypeError("; ".join(changed))
    return base.unionByName(increment, allowMissingColumns=allow_new_columns)
