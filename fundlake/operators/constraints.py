"""Declared table constraints, reported as violation counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def required(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """``df``, failing the query on any row that breaks ``condition``. A filter, so that no projection removes it."""
    return df.where(F.when(condition, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


@dataclass(frozen=True)
class TableRules:
    not_null: Sequence[str] = ()
    checks: Mapping[str, Column] = field(default_factory=dict)
    unique: Sequence[Sequence[str]] = ()
    foreign: Mapping[str, str] = field(default_factory=dict)


def violations(name: str, df: DataFrame, rules: TableRules, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rule, violations)`` of one table; ``tables`` holds the tables its foreign keys point to."""
    return all_violations({**tables, name: df}, {name: rules})


@dataclass(frozen=True)
class _KeyRule:
    """A rule on keys: rows of ``table`` are side ``side`` of the key space ``space``; side 0 of a space holds a parent's keys."""

    table: str
    rule: str
    space: str
    side: int
    columns: Sequence[str]
    orphans: bool


def _key_rules(rules: Mapping[str, TableRules]) -> list[_KeyRule]:
    found: list[_KeyRule] = []
    sides: dict[str, int] = {}
    for table, of in rules.items():
        for column, parent in of.foreign.items():
            space = f"{parent}.{column}"
            sides[space] = sides.get(space, 0) + 1
            found.append(_KeyRule(table, f"foreign key: {column} -> {parent}", space, sides[space], [column], True))
    for table, of in rules.items():
        for keys in of.unique:
            # The parent of foreign keys is side 0 of their space: its uniqueness is settled with them.
            own = f"{table}.{keys[0]}" if len(keys) == 1 else f"{table}: {', '.join(keys)}"
            found.append(_KeyRule(table, f"unique: {', '.join(keys)}", own, 0, list(keys), False))
    return found


def all_violations(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> DataFrame:
    """``(table, rule, violations)`` for all rules of all tables.

    Not-null and check rules share one scan of their table. All key rules share one exchange: each table gives its
    keys as (space, 128 bits of hash, side), where a foreign key and the key it points to are one space, and what is
    counted per key, before the shuffle already, are the rows of each side. Uniqueness and missing parents are read off
    these counts. Null keys break "not null" only.
    """
    keyed = _key_rules(rules)
    entries: dict[str, dict[tuple, Column]] = {}
    for rule in keyed:
        needed = [(rule.table, rule.side)] + ([(rule.space.rsplit(".", 1)[0], 0)] if rule.orphans else [])
        for table, side in needed:
            values = [F.col(c) for c in rule.columns]
            known = reduce(lambda a, b: a & b, [v.isNotNull() for v in values])
            text = [v.cast("string") for v in values]
            entry = F.struct(F.lit(rule.space).alias("space"), F.xxhash64(*text).alias("h1"), F.xxhash64(F.lit("second"), *text).alias("h2"), F.lit(side).alias("side"))
            entries.setdefault(table, {})[rule.space, side] = F.when(known, entry)

    parts = []
    for table, of in rules.items():
        row_rules = {f"not null: {c}": F.col(c).isNull() for c in of.not_null}
        row_rules |= {f"check: {label}": ~ok for label, ok in of.checks.items()}
        if row_rules:
            counted = tables[table].agg(F.array(*[
                F.struct(F.lit(table).alias("table"), F.lit(label).alias("rule"), F.count_if(broken).alias("violations"))
                for label, broken in row_rules.items()
            ]).alias("r"))
            parts.append(counted.select(F.inline("r")))
    if keyed:
        keys = None
        for table, found in entries.items():
            own = tables[table].select(F.inline(F.filter(F.array(*found.values()), lambda e: e.isNotNull())))
            keys = own if keys is None else keys.unionByName(own)
        n_sides = 1 + max(rule.side for rule in keyed)
        per_key = keys.groupBy("space", "h1", "h2").agg(*[F.count_if(F.col("side") == i).alias(f"s{i}") for i in range(n_sides)])
        sums = per_key.groupBy("space").agg(
            *[F.sum(F.greatest(F.col(f"s{i}") - 1, F.lit(0))).alias(f"copies{i}") for i in range(n_sides)],
            *[F.sum(F.when(F.col("s0") == 0, F.col(f"s{i}")).otherwise(0)).alias(f"orphans{i}") for i in range(n_sides)])
        wanted = _rule_table(next(iter(tables.values())), keyed)
        value = F.coalesce(*[
            F.when((F.col("side") == i) & (F.col("orphans") == orphans), F.col(f"{'orphans' if orphans else 'copies'}{i}"))
            for i in range(n_sides) for orphans in (False, True)])
        parts.append(wanted.join(sums, "space", "left").select("table", "rule", F.coalesce(value, F.lit(0)).alias("violations")))
    return reduce(DataFrame.unionByName, parts)


def _rule_table(near: DataFrame, keyed: Sequence[_KeyRule]) -> DataFrame:
    """The key rules as a table, so that a rule over empty tables is reported too."""
    rows = [(r.table, r.rule, r.space, r.side, r.orphans) for r in keyed]
    return near.sparkSession.createDataFrame(rows, "table STRING, rule STRING, space STRING, side INT, orphans BOOLEAN")
