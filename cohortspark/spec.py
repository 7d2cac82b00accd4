"""Dataset description shared by every operator.

A :class:`DatasetSpec` says how a source table is named, typed and keyed, so
operators never mention a survey column themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame

UNKNOWN = "DESCONOCIDO"

#: How the text of a field becomes a typed value.
FIELD_KINDS = ("numeric", "code", "open_code", "closed_code", "raw")


class RequiredColumnsError(ValueError):
    """A table or an extract header lacks columns an operator needs."""


def require_columns(df: DataFrame, columns: Sequence[str], context: str) -> None:
    """Fail early, and without a job, when ``df`` lacks one of ``columns``."""
    absent = [name for name in columns if name not in df.columns]
    if absent:
        raise RequiredColumnsError(
            f"{context}: missing columns {', '.join(absent)}; "
            f"available: {', '.join(df.columns)}"
        )


@dataclass(frozen=True)
class FieldSpec:
    """One source field: header name, standard name and typing rule."""

    source: str
    name: str
    kind: str = "raw"
    valid: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.kind not in FIELD_KINDS:
            raise ValueError(f"unknown field kind {self.kind!r}")
        if self.kind == "closed_code" and not self.valid:
            raise ValueError(f"closed_code field {self.source!r} needs valid codes")


@dataclass(frozen=True)
class FilterStep:
    """One step of a population filter.

    ``condition`` receives a mapping of coerced input columns and returns a
    boolean column; a null condition excludes the row.
    """

    step: int
    label: str
    condition: Callable[[Mapping[str, Column]], Column]


@dataclass(frozen=True)
class Cascade:
    """Ordered filter steps plus the inputs they share.

    ``inputs`` maps an input name to ``(column name, kind)`` where kind is
    ``numeric`` or ``code``. ``duration`` optionally names three inputs
    ``(total, years, months)``; the total is derived when its column is absent.
    ``start`` labels the count before the first step.
    """

    inputs: Mapping[str, tuple[str, str]]
    steps: tuple[FilterStep, ...]
    duration: tuple[str, str, str] | None = None
    start: str = "inicio"

    def with_columns(self, mapping: Mapping[str, str] | None) -> "Cascade":
        """Copy of the cascade reading other column names."""
        if not mapping:
            return self
        inputs = {
            name: (mapping.get(name, column), kind)
            for name, (column, kind) in self.inputs.items()
        }
        return replace(self, inputs=inputs)


@dataclass(frozen=True)
class PeriodNaming:
    """How a period is written in file names."""

    survey_token: str
    include: tuple[str, ...]
    exclude_name: tuple[str, ...]
    exclude_path: tuple[str, ...]
    quarter_words: Mapping[str, int]
    quarter_romans: Mapping[str, int]


@dataclass(frozen=True)
class DatasetSpec:
    """Everything the operators need to know about one kind of table."""

    fields: tuple[FieldSpec, ...]
    keys: tuple[str, ...]
    target: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    audited: tuple[str, ...]
    duration: tuple[str, str, str] | None = None  # (total, years, months)
    cascade: Cascade | None = None
    naming: PeriodNaming | None = None
    labels: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    unknown: str = UNKNOWN
    period: str = "periodo_archivo"

    @property
    def profiled(self) -> tuple[str, ...]:
        """Target first, then the numeric predictors."""
        return (self.target, *self.numeric)

    @property
    def source_columns(self) -> tuple[str, ...]:
        return tuple(f.source for f in self.fields)

    def resolve(
        self, selected: Sequence[str] | Mapping[str, str] | None = None
    ) -> tuple[FieldSpec, ...]:
        """Fields to read: all of them, a list of headers, or header -> name."""
        known = {f.source: f for f in self.fields}
        if selected is None:
            return self.fields
        if isinstance(selected, Mapping):
            wanted = {_squeeze(s): _squeeze(t) for s, t in selected.items()}
        else:
            wanted = {
                s: known[s].name if s in known else s for s in map(_squeeze, selected)
            }
        if not wanted:
            raise ValueError("at least one column must be selected")
        targets = list(wanted.values())
        clash = sorted({t for t in targets if targets.count(t) > 1})
        if clash:
            raise ValueError(f"several columns are mapped to {', '.join(clash)}")
        return tuple(
            replace(known.get(s, FieldSpec(s, t)), name=t) for s, t in wanted.items()
        )


def _squeeze(header: str) -> str:
    return " ".join(str(header).split())
