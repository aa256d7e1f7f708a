"""Declared tables: keys, references, lengths, precisions and allowed values as
metadata of a ``StructType`` (D1-D5).

The rules of single rows compile to one array of broken rules per row, so one
scan checks them all: ``violations`` counts them, ``split`` parts a batch into
rows to load and rows to set aside with the rules they break, ``observed``
counts while the batch is written. Keys and references, which look at several
rows, take one aggregate and one anti join each. A NULL breaks only NOT NULL,
as in SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from diamondlake.operators.quality import dq_unique

BROKEN = "__broken"
KINDS = {t.simpleString(): t for t in (BooleanType(), DateType(), DoubleType(), IntegerType(), LongType(), StringType(), TimestampType())}


def column(name: str, kind: str, *, key: bool = False, null: bool = True, length: int | None = None, numeric: tuple[int, int] | None = None,
           values: list | None = None, references: tuple[str, str] | None = None) -> StructField:
    """A declared column: ``key`` parts are never NULL; ``length`` of text; ``numeric`` as (precision,
    scale); allowed ``values``; ``references`` as (table, column)."""
    rules = {"key": key, "length": length, "numeric": list(numeric) if numeric else None, "values": values, "references": list(references) if references else None}
    return StructField(name, KINDS[kind], null and not key, {k: v for k, v in rules.items() if v})


def table(*columns: StructField) -> StructType:
    return StructType(list(columns))


def row_rules(schema: StructType) -> dict[str, Column]:
    """Rule name -> predicate of the rows that break it, for every declared rule of single rows."""
    rules: dict[str, Column] = {}
    for f in schema.fields:
        c, m = F.col(f"`{f.name}`"), f.metadata
        if not f.nullable:
            rules[f"{f.name} not null"] = c.isNull()
        if "length" in m:
            rules[f"{f.name} length {m['length']}"] = F.length(c.cast("string")) > m["length"]
        if "numeric" in m:
            p, s = m["numeric"]
            rules[f"{f.name} numeric {p},{s}"] = (F.round(F.abs(c), s) >= 10 ** (p - s)) | F.isnan(c.cast("double"))
        if "values" in m:
            rules[f"{f.name} in values"] = ~c.isin(m["values"])
    return rules


def with_broken(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the names of the rules that each row breaks (an empty array: none)."""
    names = [F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in row_rules(schema).items()]
    return df.withColumn(BROKEN, F.array_compact(F.array(*names)) if names else F.array().cast("array<string>"))


def violations(df: DataFrame, schema: StructType) -> DataFrame:
    """(rule, violations) of every declared rule of single rows, in one scan; rules that nothing breaks have 0."""
    rules = row_rules(schema)
    wide = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, name in enumerate(rules)])
    return wide.select(F.explode(pairs).alias("__r")).select("__r.*")


def split(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that keep every rule of single rows, the others with ``broken``, the comma-joined rules they break)."""
    marked = with_broken(df, schema)
    good = marked.where(F.size(BROKEN) == 0).drop(BROKEN)
    return good, marked.where(F.size(BROKEN) > 0).withColumn("broken", F.concat_ws(", ", BROKEN)).drop(BROKEN)


def observed(df: DataFrame, schema: StructType, name: str | None = None) -> tuple[DataFrame, Observation]:
    """``df`` and an observation that has the violations by rule as soon as ``df`` has been written: no scan of its own."""
    seen = Observation(name) if name else Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(bad, F.lit(False))).alias(rule) for rule, bad in row_rules(schema).items()]), seen


def key_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if f.metadata.get("key")]


def duplicate_keys(df: DataFrame, schema: StructType) -> DataFrame:
    """Keys that occur more than once, with their count ``n``."""
    return dq_unique(df, key_columns(schema))


def orphans(df: DataFrame, schema: StructType, tables: dict[str, DataFrame]) -> DataFrame:
    """(column, n): for each declared reference the rows whose value the other table lacks; NULL refers to
    nothing (D2). Values are counted before the join, so a hot value is one row in it."""
    found = []
    for f in schema.fields:
        if "references" in f.metadata:
            other, col = f.metadata["references"]
            values = df.where(F.col(f.name).isNotNull()).groupBy(F.col(f.name).alias("__v")).agg(F.count(F.lit(1)).alias("n"))
            lost = values.join(tables[other].select(F.col(col).alias("__v")), "__v", "left_anti")
            found.append(lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit(f.name).alias("column"), "n"))
    return reduce(DataFrame.unionByName, found) if found else df.sparkSession.createDataFrame([], "column string, n long")


def check(tables: dict[str, DataFrame], schemas: dict[str, StructType]) -> DataFrame:
    """(table, rule, violations) of everything declared: rules of single rows, keys and references."""
    parts = []
    for name, schema in schemas.items():
        df = tables[name]
        if row_rules(schema):
            parts.append(violations(df, schema))
        if keys := key_columns(schema):
            parts.append(duplicate_keys(df, schema).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(f"{'+'.join(keys)} unique").alias("rule"), "violations"))
        if any("references" in f.metadata for f in schema.fields):
            parts.append(orphans(df, schema, tables).select(F.concat("column", F.lit(" references")).alias("rule"), F.col("n").alias("violations")))
        parts = [p if "table" in p.columns else p.select(F.lit(name).alias("table"), "rule", "violations") for p in parts]
    return reduce(DataFrame.unionByName, parts)
