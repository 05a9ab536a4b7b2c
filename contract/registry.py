"""Registration of checks: a Spark query and its SQL twin under one name."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.tables import Tables, oracle_text, tables


@dataclass(frozen=True)
class Check:
    run: Callable[[Tables], DataFrame]
    sql: str | None
    digits: Mapping[str, int]

    def spark(self, spark, folder: str) -> DataFrame:
        df = self.run(tables(spark, folder))
        # Adding 0.0 turns a rounded -0.0 into 0.0, as the SQL twin does.
        return df.withColumns({c: F.round(c, d) + F.lit(0.0) for c, d in self.digits.items()}) if self.digits else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.digits:
            return oracle_text(self.sql)
        swaps = ", ".join(f"round({c}, {d}) + CAST(0 AS DOUBLE) AS {c}" for c, d in self.digits.items())
        return oracle_text(f"SELECT * REPLACE ({swaps}) FROM ({self.sql}) result")


CHECKS: dict[str, Check] = {}


def check(
    name: str, run: Callable[[Tables], DataFrame], sql: str | None = None,
    digits: Mapping[str, int] | Iterable[str] = (),
) -> None:
    """Register one operator. Columns in ``digits`` are rounded on both sides (6 places
    unless stated), since sums of doubles depend on the order of the rows."""
    if name in CHECKS:
        raise ValueError(f"registered twice: {name}")
    places = dict(digits) if isinstance(digits, Mapping) else {c: 6 for c in digits}
    CHECKS[name] = Check(run, sql, places)
