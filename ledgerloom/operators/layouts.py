"""Bring source layouts that name and scale their fields differently to one schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import parsing, text

# What a field of a layout holds, the steps that read it, and the type of its NULL when absent.
READERS = {
    "text": ((F.trim,), "string"),
    "optional_text": ((text.blank_to_null,), "string"),
    "code": ((text.code_key,), "string"),
    "int": ((parsing.whole_number,), "int"),
    "date": (parsing.date_steps(), "date"),
    "money": (parsing.currency_steps(), "double"),
    "percent": ((*parsing.currency_steps()[:-1], lambda x: parsing.finite(x) / F.lit(100.0)), "double"),
    "fraction": (parsing.currency_steps(), "double"),
}


@dataclass(frozen=True)
class Field:
    """A field of the common schema: its kind, and its column in the source (None when it has none)."""

    kind: str
    source: str | None = None

    def start(self) -> Column:
        return F.lit(None).cast(READERS[self.kind][1]) if self.source is None else F.col(self.source)

    def steps(self) -> tuple[parsing.Step, ...]:
        return () if self.source is None else READERS[self.kind][0]


@dataclass(frozen=True)
class Layout:
    """One source layout; ``fields`` maps every column of the common schema to a source field."""

    name: str
    fields: Mapping[str, Field]
    tag: str = "safra"

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The fields take their steps side by side, a projection for each: what a step names several times is computed once.

        The tag passes through a lambda. It keeps a projection out of the code of its neighbours, which would else grow with
        the fields beyond what the JVM compiles; alone, Spark cuts it into small methods.
        """
        out = df.select(F.lit(self.name).alias(self.tag), *[f.start().alias(t) for t, f in self.fields.items()], *keep)
        steps = {target: field.steps() for target, field in self.fields.items()}
        for n in range(max(map(len, steps.values()), default=0)):
            out = out.select(
                text.let(F.col(self.tag), lambda tag: tag).alias(self.tag),
                *[own[n](F.col(t)).alias(t) if n < len(own) else F.col(t) for t, own in steps.items()], *keep)
        return out


def harmonize(sources: Sequence[tuple[Layout, DataFrame]], keep: Sequence[str] = ()) -> DataFrame:
    """All layouts in the common schema, united by column name; ``keep`` names columns that pass through."""
    return reduce(DataFrame.unionByName, [layout.apply(df, keep) for layout, df in sources])
