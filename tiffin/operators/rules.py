"""Row rules and key rules of a quality check, evaluated in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that the rows of one duplicated key are dealt to; the keys are repeated for each.
PARTS = 8


@dataclass(frozen=True)
class RuleSet:
    """Rules by name. A row breaks a rule when its predicate is true; NULL is not a break."""

    rules: dict[str, str]
    unique_key: str | None = None

    @property
    def duplicate_rule(self) -> str:
        return f"duplicate_{self.unique_key}"

    def _broken(self) -> Column:
        checks = [F.coalesce(F.expr(p), F.lit(False)) for p in self.rules.values()]
        return reduce(lambda a, b: a | b, checks)

    def report(self, df: DataFrame, times: Column | None = None) -> DataFrame:
        """`rule`, `violations`: rows per row rule, keys for the duplicate rule. A row of `df` stands for `times`
        rows, one by default.

        With a unique key the rows are counted per key, in the tasks already, and the counts are
        summed; so the table is read once.
        """
        names = [f"_rule_{i}" for i in range(len(self.rules))]
        times = (F.lit(1) if times is None else times).cast("long")
        broken = [F.sum(F.when(F.expr(p), times)) for p in self.rules.values()]
        counted = [F.coalesce(count, F.lit(0)).alias(n) for n, count in zip(names, broken)]
        if self.unique_key is None:
            counts = df.agg(*counted)
        else:
            per_key = df.groupBy(self.unique_key).agg(F.sum(times).alias("_copies"), *counted)
            sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]
            counts = per_key.agg(*sums, F.count_if(F.col("_copies") > 1).alias("_duplicates"))
        rules = dict(zip(self.rules, names))
        if self.unique_key is not None:
            rules[self.duplicate_rule] = "_duplicates"
        lines = [
            F.struct(F.lit(rule).alias("rule"), F.col(name).alias("violations"))
            for rule, name in rules.items()
        ]
        return counts.select(F.inline(F.array(*lines)))

    def valid(self, df: DataFrame) -> DataFrame:
        """Rows that break no row rule. Duplicates are reported, not removed."""
        return df.filter(~self._broken())

    def issues(self, df: DataFrame, parts: int = PARTS) -> DataFrame:
        """Offending rows, once per broken rule, with the rule's name as `issue`."""
        names = [F.when(F.expr(p), F.lit(name)) for name, p in self.rules.items()]
        columns = df.columns
        if self.unique_key is not None:
            key = self.unique_key
            counts = df.groupBy(key).agg(F.count("*").alias("_copies"))
            part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
            repeated = counts.filter("_copies > 1").withColumn("_part", part)
            content = F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(parts))
            df = df.withColumn("_part", content.cast("int")).join(repeated, [key, "_part"], "left")
            names.append(F.when(F.col("_copies").isNotNull(), F.lit(self.duplicate_rule)))
        return df.select(*columns, F.explode(F.array_compact(F.array(*names))).alias("issue"))


def not_null(*columns: str) -> dict[str, str]:
    return {f"null_{c}": f"{c} IS NULL" for c in columns}


def sql_list(values) -> str:
    quoted = ["'" + v.replace("'", "''") + "'" for v in values]
    return "(" + ", ".join(quoted) + ")"
