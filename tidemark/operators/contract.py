"""The feature list a model was trained on, enforced on whatever it is given later (#22)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FeatureContract:
    """Names, types, order and the value that a missing column takes."""

    columns: tuple[tuple[str, str, float | str | None], ...]

    @classmethod
    def of(cls, df: DataFrame, features: Sequence[str], fill: float | None = 0.0,
           fills: dict | None = None) -> "FeatureContract":
        """The contract of ``features`` as ``df`` has them; ``fills`` by name, else ``fill``."""
        types = dict(df.dtypes)
        missing = [c for c in features if c not in types]
        if missing:
            raise ValueError(f"no such columns: {missing}")
        return cls(tuple((c, types[c], (fills or {}).get(c, fill)) for c in features))

    @property
    def names(self) -> list[str]:
        return [c for c, _, _ in self.columns]

    def enforce(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` and then exactly the contract's columns, in its order and types.

        A column that ``df`` lacks is filled; a value that can't be cast is NULL (so is a
        NULL: models have their own way with these); all other columns go.
        """
        have = {c.lower(): (c, t) for c, t in df.dtypes}
        out = []
        for name, kind, fill in self.columns:
            found = have.get(name.lower())
            if found is None:
                out.append(F.lit(fill).cast(kind).alias(name))
            elif found[1] == kind:
                out.append(F.col(f"`{found[0]}`").alias(name))
            else:
                out.append(F.col(f"`{found[0]}`").try_cast(kind).alias(name))
        return df.select(*[F.col(f"`{c}`") for c in keep if c not in self.names], *out)

    def problems(self, df: DataFrame) -> dict[str, list[str]]:
        """What ``enforce`` would mend: missing, extra and mistyped columns."""
        have = {c.lower(): t for c, t in df.dtypes}
        mine = {c.lower(): (c, t) for c, t, _ in self.columns}
        return {"missing": [c for k, (c, _) in mine.items() if k not in have],
                "extra": [c for c in df.columns if c.lower() not in mine],
                "mistyped": [c for k, (c, t) in mine.items() if k in have and have[k] != t]}

    def to_dict(self) -> dict:
        return {"columns": [list(c) for c in self.columns]}

    @classmethod
    def from_dict(cls, value: dict) -> "FeatureContract":
        return cls(tuple(tuple(c) for c in value["columns"]))
