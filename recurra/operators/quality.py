"""Data quality: keys, references, required values, domains, row counts, and agreement of two results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.schemas import DOMAINS, FOREIGN_KEYS, PRIMARY_KEYS, REQUIRED

_COMPARED = "decimal(28,6)"


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _present(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def duplicate_keys(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Keys held more than once, the rows beyond the first of each, and rows whose key is missing or incomplete."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("n")).select("n", _present(keys).alias("present"))
    repeated = F.col("present") & (F.col("n") > 1)
    return counted.agg(
        F.count_if(repeated).alias("n_duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), F.lit(0)).cast("bigint").alias("n_surplus_rows"),
        F.coalesce(F.sum(F.when(~F.col("present"), F.col("n"))), F.lit(0)).cast("bigint").alias("n_null_keys"),
    ).select(F.lit(table).alias("table_name"), "n_duplicate_keys", "n_surplus_rows", "n_null_keys")


def pk_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(duplicate_keys(df, name, PRIMARY_KEYS[name]) for name, df in tables.items())


def _used_keys(child: DataFrame, column: str) -> DataFrame:
    """Values counted before they move, so one that many rows share reaches a join as one row."""
    return child.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("bigint").alias("_key")).agg(F.count("*").alias("n"))


def orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """n_orphans: child rows whose value the parent lacks."""
    missing = _used_keys(child, column).join(parent.select(F.col(parent_column).alias("_key")), "_key", "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_orphans"))


def fk_orphans(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Child rows whose value the parent lacks; all children of one parent meet it in one join, so a parent is read once."""
    found = []
    for parent, key in dict.fromkeys((p, k) for _, _, p, k in FOREIGN_KEYS):
        children = [(c, column) for c, column, p, k in FOREIGN_KEYS if (p, k) == (parent, key)]
        used = _union(
            _used_keys(tables[child], column).select(F.lit(f"{child}.{column}").alias("use"), "_key", "n") for child, column in children
        )
        # An anti-join would be moved below the union, into one for each child.
        known = tables[parent].select(F.col(key).cast("bigint").alias("_key"), F.lit(True).alias("known"))
        missing = used.join(known, "_key", "left").where("known is null")
        counts = [F.coalesce(F.sum(F.when(F.col("use") == f"{c}.{k}", F.col("n"))), F.lit(0)).cast("bigint") for c, k in children]
        rows = F.array(*[
            F.struct(F.lit(c).alias("child_table"), F.lit(k).alias("fk_column"), count.alias("n_orphans"))
            for (c, k), count in zip(children, counts)
        ])
        found.append(missing.agg(rows.alias("rows")).select(F.inline("rows")))
    return _union(found)


def _rules(table: str) -> dict[str, Column]:
    missing = {f"{c} is required": F.col(c).isNull() for c in REQUIRED[table]}
    unknown = {
        f"{c} in {', '.join(values)}": ~F.col(c).isin(list(values)) for c, values in DOMAINS.get(table, {}).items()
    }
    return {**missing, **unknown}


def domain_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations per rule; every rule of a table is counted in the same pass."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(*[F.count_if(broken).alias(rule) for rule, broken in _rules(name).items()])
        rules = [F.col(f"`{c}`") for c in counts.columns]
        parts.append(
            counts.unpivot([], rules, "rule", "n_violations").select(
                F.lit(name).alias("table_name"), "rule", "n_violations"
            )
        )
    return _union(parts)


def table_row_counts(tables: Mapping[str, DataFrame], expected: Mapping[str, int] | None = None) -> DataFrame:
    """Rows of each table; with `expected`, also what was expected (NULL where nothing was) and whether they match."""
    counts = _union(
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    )
    if expected is None:
        return counts
    wanted = reduce(lambda c, item: c.when(F.col("table_name") == item[0], F.lit(item[1])), expected.items(), F.when(F.lit(False), F.lit(0)))
    status = F.when(wanted.isNull(), "unknown").when(wanted == F.col("n_rows"), "match").otherwise("diff")
    return counts.withColumns({"expected_rows": wanted.cast("bigint"), "status": status})


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str], *, tolerance: float = 0.0
) -> DataFrame:
    """Two results side by side, one row per key and measure, with their difference and a status.

    Status is match, diff, left_only or right_only.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        values = [F.col(m).cast(_COMPARED).alias(f"{name}_{m}") for m in measures]
        return df.select(*keys, *values, F.lit(True).alias(f"in_{name}"))

    both = side(left, "left").join(side(right, "right"), list(keys), "full")
    pairs = F.array(
        *[
            F.struct(
                F.lit(m).alias("measure"), F.col(f"left_{m}").alias("left_value"),
                F.col(f"right_{m}").alias("right_value"),
            )
            for m in measures
        ]
    )
    long = both.select(*keys, "in_left", "in_right", F.inline(pairs))
    difference = F.col("left_value") - F.col("right_value")
    equal = F.coalesce(F.abs(difference) <= F.lit(str(tolerance)).cast(_COMPARED), F.lit(False))
    both_missing = F.col("left_value").isNull() & F.col("right_value").isNull()
    status = (
        F.when(F.col("in_right").isNull(), "left_only").when(F.col("in_left").isNull(), "right_only")
        .when(equal | both_missing, "match").otherwise("diff")
    )
    return long.select(
        *keys, "measure", "left_value", "right_value", difference.alias("difference"), status.alias("status")
    )
