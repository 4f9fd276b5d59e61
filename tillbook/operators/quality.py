"""Data quality checks. Checks on rows return a Column or the failing rows; suites return one row per
rule with the number of bad rows, and all column rules of a table share one pass over it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillbook.functions.columns import at, seconds_between, surrogate_key
from tillbook.operators.scale import broadcast_if_small
from tillbook.session import pin


# ------------------------------------------------------------------ rules on single rows
@dataclass(frozen=True)
class Rule:
    """A named condition that is TRUE on a bad row; NULL passes."""

    name: str
    bad: Column
    severity: str = "error"


def not_null(column: str, where: Column | None = None, severity: str = "error") -> Rule:
    bad = F.col(column).isNull()
    return Rule(f"not_null {column}", bad if where is None else bad & where, severity)


def accepted_values(column: str, values: list) -> Rule:
    return Rule(f"accepted_values {column}", ~F.col(column).isin(values))


def accepted_range(column: str, lo=None, hi=None, inclusive: bool = True) -> Rule:
    c, bad = F.col(column), F.lit(False)
    if lo is not None:
        bad = bad | (c < lo if inclusive else c <= lo)
    if hi is not None:
        bad = bad | (c > hi if inclusive else c >= hi)
    return Rule(f"accepted_range {column}", bad)


def expression_is_true(expression: str) -> Rule:
    return Rule(f"expression {expression}", ~F.expr(expression))


def check_rows(df: DataFrame, table: str, rules: list[Rule], min_rows: int | None = None) -> DataFrame:
    """(table, rule, severity, bad_rows) of all rules in one aggregate."""
    counts = [F.count_if(r.bad).alias(f"r{i}") for i, r in enumerate(rules)]
    named = [(r.name, r.severity, F.col(f"r{i}")) for i, r in enumerate(rules)]
    if min_rows is not None:
        counts.append(F.count(F.lit(1)).alias("n"))
        named.append((f"row_count >= {min_rows}", "error", F.when(F.col("n") < min_rows, 1).otherwise(0)))
    return df.agg(*counts).select(F.inline(_rule_rows(table, named)))


class Watched:
    """Row rules measured while a table is written: `watch` the frame, write it, then read the `results`.

    The counts are taken by the write itself, so the rules need no scan of what was written.
    """

    def __init__(self, table: str, rules: list[Rule]):
        self.table, self.rules = table, rules
        self._seen: list[Observation] = []

    def counts(self) -> list[Column]:
        return [F.count(F.lit(1)).alias("n"), *[F.count_if(r.bad).alias(f"r{i}") for i, r in enumerate(self.rules)]]

    def watch(self, df: DataFrame) -> DataFrame:
        self._seen.append(Observation())
        return df.observe(self._seen[-1], *self.counts())

    def results(self) -> list[tuple]:
        """(table, rule, severity, bad_rows, rows) of every watched write; waits for the writes."""
        return [row for seen in self._seen for row in self.named(seen.get)]

    def named(self, counts: dict) -> list[tuple]:
        return [(self.table, r.name, r.severity, counts[f"r{i}"], counts["n"]) for i, r in enumerate(self.rules)]


WATCHED = "table string, rule string, severity string, bad_rows bigint, rows bigint"


def watched_results(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Measured counts as a table, a few rows for each write."""
    return spark.createDataFrame(rows, WATCHED)


def sum_watched(results: DataFrame, min_rows: int | None = None) -> DataFrame:
    """(table, rule, severity, bad_rows) over all writes, as check_rows over the whole tables gives them."""
    out = results.groupBy("table", "rule", "severity").agg(F.sum("bad_rows").alias("bad_rows"))
    if min_rows is None:
        return out
    # Every rule of a table saw the same rows.
    totals = results.groupBy("table", "rule").agg(F.sum("rows").alias("n")).groupBy("table").agg(F.max("n").alias("n"))
    few = totals.select(
        "table",
        F.lit(f"row_count >= {min_rows}").alias("rule"),
        F.lit("error").alias("severity"),
        F.when(F.col("n") < min_rows, 1).otherwise(0).cast("bigint").alias("bad_rows"),
    )
    return out.unionByName(few)


def _rule_rows(table: str, named: list[tuple[str, str, Column]]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(table).alias("table"),
                F.lit(name).alias("rule"),
                F.lit(severity).alias("severity"),
                n.cast("bigint").alias("bad_rows"),
            )
            for name, severity, n in named
        ]
    )


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    return df.filter(rule.bad)


# ------------------------------------------------------------------ rules on groups and tables
def groups_having(df: DataFrame, by: list[str], agg: Column, condition: Column) -> DataFrame:
    return df.groupBy(*by).agg(agg).filter(condition)


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values that occur more than once; rows with a NULL in the columns are not compared."""
    known = df.na.drop(subset=columns)
    return groups_having(known, columns, F.count(F.lit(1)).alias("rows"), F.col("rows") > 1)


def check_keys(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Key columns are filled and unique, both from one count per key."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    found = [(f"not_null {c}", F.sum(F.when(F.col(c).isNull(), F.col("n")))) for c in columns]
    found.append(("unique " + " ".join(columns), F.count_if(known & (F.col("n") > 1))))
    totals = groups.agg(*[F.coalesce(v, F.lit(0)).alias(f"r{i}") for i, (_, v) in enumerate(found)])
    return totals.select(F.inline(_rule_rows(table, [(n, "error", F.col(f"r{i}")) for i, (n, _) in enumerate(found)])))


def orphans(child: DataFrame, parent: DataFrame, column: str, parent_column: str | None = None) -> DataFrame:
    """(value, rows) of child values that no parent row has; NULL passes.

    The child is summed per value first, so a hot value is one row when it meets the parent.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    keys = parent.select(F.col(parent_column or column).alias("value"))
    return values.agg(F.count(F.lit(1)).alias("rows")).join(keys, "value", "left_anti")


def tuple_hash(columns: list[str]) -> Column:
    """One 64-bit value per tuple, NULLs told apart by position."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def distinct_tuples(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Number of different value tuples per key; NULLs count as values."""
    return df.groupBy(key).agg(F.count_distinct(F.struct(*columns)).alias("tuples"))


def report(table: str, rule: str, bad: DataFrame, rows: Column | None = None, severity: str = "error") -> DataFrame:
    """One (table, rule, severity, bad_rows) row for a frame of failing rows or groups."""
    n = F.count(F.lit(1)) if rows is None else F.coalesce(F.sum(rows), F.lit(0))
    return bad.agg(n.cast("bigint").alias("bad_rows")).select(
        F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "bad_rows"
    )


def stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def settled(parts: list[DataFrame]) -> DataFrame:
    """`stack` of results that are computed one after the other, so that only one check at a time holds shuffle files."""
    return stack([pin(part, "check-results") for part in parts])


class QualityError(RuntimeError):
    """A blocking check failed."""


def gate(results: DataFrame) -> None:
    """Stop when any error rule has bad rows. Reads only the failing rules, one row each."""
    failed = results.filter("severity = 'error' and bad_rows > 0").collect()
    if failed:
        raise QualityError("; ".join(f"{r['table']}: {r['rule']} {r['bad_rows']} bad rows" for r in failed))


# ------------------------------------------------------------------ comparison of two tables
def same_totals(a: DataFrame, b: DataFrame, sums: list[str], name: str) -> DataFrame:
    """Row count and totals of two tables side by side; bad_rows counts the figures that differ."""

    def side(df: DataFrame, label: str) -> DataFrame:
        return df.agg(
            F.lit(label).alias("side"), F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in sums]
        )

    # Two one-row aggregates, folded into one row.
    both = side(a, "a").unionByName(side(b, "b"))
    figures = ["rows", *sums]
    picked = both.agg(
        *[F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{s}_{c}") for c in figures for s in ("a", "b")]
    )
    differ = [F.when(F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), 0).otherwise(1) for c in figures]
    total = differ[0]
    for d in differ[1:]:
        total = total + d
    return picked.select(
        F.lit(name).alias("table"),
        F.lit("same totals").alias("rule"),
        F.lit("error").alias("severity"),
        total.cast("bigint").alias("bad_rows"),
    )


def reconcile(a: DataFrame, b: DataFrame, on: list[str], measure: str) -> DataFrame:
    """Rows where two aggregates disagree, then one 'total' row if their grand totals do.

    Both sides are stacked and summed per key, which is a full outer join without the join.
    """
    kept = [*on, measure]
    sides = a.select(*kept, F.lit(0).alias("s")).unionByName(b.select(*kept, F.lit(1).alias("s")))
    zero = F.lit(0)
    left = F.coalesce(F.sum(F.when(F.col("s") == 0, F.col(measure))), zero).alias("left_value")
    right = F.coalesce(F.sum(F.when(F.col("s") == 1, F.col(measure))), zero).alias("right_value")
    per_key = sides.groupBy(*on).agg(left, right).withColumn("level", F.lit("key"))
    total = sides.agg(left, right).withColumn("level", F.lit("total"))
    return per_key.unionByName(total, allowMissingColumns=True).filter("left_value <> right_value")


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """Order-free table fingerprint: count, sum and xor of the rows' 63-bit keys, which leave nulls out."""
    return df.select(surrogate_key(*columns).alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"),
    )


# ------------------------------------------------------------------ freshness and contracts
def freshness(
    df: DataFrame,
    table: str,
    as_of: datetime,
    column: str = "updated_at",
    warn: timedelta = timedelta(hours=26),
    error: timedelta = timedelta(days=3),
) -> DataFrame:
    """(table, newest, hours, status). Never blocks: an error is a warning to the reader."""
    newest = F.max(column).alias("newest")
    seconds = seconds_between("newest", at(as_of))
    status = (
        F.when(F.col("newest").isNull(), "missing")
        .when(seconds > int(error.total_seconds()), "error")
        .when(seconds > int(warn.total_seconds()), "warn")
        .otherwise("pass")
    )
    return df.agg(newest).select(
        F.lit(table).alias("table"), "newest", F.round(seconds / 3600.0, 1).alias("hours"), status.alias("status")
    )


# Kinds of types a contract compares.
_KINDS = {
    "number": {"byte", "short", "integer", "long", "float", "double"},
    "varchar": {"string"},
    "timestamp": {"timestamp", "timestamp_ntz"},
}


def base_type(data_type) -> str:
    name = data_type.typeName()
    if name.startswith("decimal"):
        return "number"
    return next((kind for kind, names in _KINDS.items() if name in names), name)


def contract_mismatches(schema: StructType, contract: StructType) -> list[tuple[str, str, str, str]]:
    """(column, definition type, contract type, reason); only the kind of a type counts."""
    have = {f.name: base_type(f.dataType) for f in schema.fields}
    want = {f.name: base_type(f.dataType) for f in contract.fields}
    out = [(c, "", t, "missing in definition") for c, t in want.items() if c not in have]
    out += [(c, t, "", "missing in contract") for c, t in have.items() if c not in want]
    out += [(c, have[c], t, "data type mismatch") for c, t in want.items() if c in have and have[c] != t]
    return sorted(out)


class ContractError(RuntimeError):
    """A table does not have the declared shape."""


def assert_shape(df: DataFrame, contract: StructType, name: str) -> None:
    """Compare columns and types before anything is computed or written."""
    wrong = contract_mismatches(df.schema, contract)
    if wrong:
        lines = [" | ".join(row) for row in wrong]
        raise ContractError(f"{name}: column | definition | contract | reason\n" + "\n".join(lines))


def contract_nulls(df: DataFrame, contract: StructType, name: str) -> DataFrame:
    required = [f.name for f in contract.fields if not f.nullable]
    return check_rows(df, name, [not_null(c) for c in required])


def broadcastable_orphans(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    return orphans(child, broadcast_if_small(parent.select(column)), column)
