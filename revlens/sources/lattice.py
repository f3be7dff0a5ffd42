"""Aggregate navigation: a few stored sums of the P&L fact, and the choice of the smallest that answers.

Dashboard pages ask for a few dimensions of a fact that holds every customer,
product and day. ``Lattice.build`` stores the fact's amounts summed by some sets
of dimensions, each from the smallest stored set that contains it, so the fact
is read once per set that no other contains. ``Lattice.fact_for(dims)`` then
hands a page the smallest table that holds its dimensions, under the fact's own
column names: the operators run on it as on the fact, and sums of exact decimal
sums are the same amounts. Dimensions that no table holds are answered from the
fact. Measures that can't be summed again (absolute errors, accuracies, counts of
distinct things) are refused.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.measures import BASE, DERIVED
from revlens.sources.raw import path_exists
from revlens.sources.star import TABLES, Star

ALWAYS = "fiscal_year"
AMOUNTS = list(BASE.values())
#: Measures that sums of the amounts give: the sums themselves and what is derived from them.
ADDITIVE = {*BASE, *DERIVED, *AMOUNTS}
#: The pages' dimensions: places by month, products by month, and the scorecards' own.
DEFAULT_SETS = (("region", "market", "channel", "segment", "date"), ("region", "market", "date"), ("segment", "division"), ("region", "market"), ("segment",))
SIZES = "_sizes"


def set_name(dims: Iterable[str]) -> str:
    return "by_" + "_".join(sorted(dims))


class Lattice:
    """Stored sums: the dimensions and rows of each table, and the fact they were made of."""

    def __init__(self, spark: SparkSession, path: str, sizes: dict[frozenset[str], int], fact: DataFrame) -> None:
        self.spark, self.path, self.sizes, self.fact = spark, path.rstrip("/"), sizes, fact

    @classmethod
    def build(cls, spark: SparkSession, fact: DataFrame, path: str, sets: Iterable[Iterable[str]] = DEFAULT_SETS) -> "Lattice":
        """Store the sums of ``fact`` by each set of dimensions, partitioned by fiscal year; sizes are written last."""
        path = path.rstrip("/")
        wanted = sorted({frozenset(s) - {ALWAYS} for s in sets}, key=lambda s: (-len(s), sorted(s)))
        types = dict(fact.dtypes)
        if missing := sorted({d for s in wanted for d in s if d not in types}):
            raise ValueError(f"the fact has no columns {missing}")
        sizes: dict[frozenset[str], int] = {}
        for dims in wanted:
            lattice = cls(spark, path, sizes, fact)
            source = lattice.fact_for(dims)
            sums = [F.sum(c).cast("bigint" if types[c] == "bigint" else "decimal(34,2)").alias(c) for c in AMOUNTS]
            summed = source.groupBy(*sorted(dims), ALWAYS).agg(*sums)
            folder = f"{path}/{set_name(dims)}"
            summed.hint("rebalance", ALWAYS).write.mode("overwrite").partitionBy(ALWAYS).parquet(folder)
            sizes = {**sizes, dims: lattice._stored(dims).count()}
        rows = [(sorted(d), n) for d, n in sizes.items()]
        spark.createDataFrame(rows, "dims array<string>, n long").coalesce(1).write.mode("overwrite").parquet(f"{path}/{SIZES}")
        return cls(spark, path, sizes, fact)

    @classmethod
    def read(cls, spark: SparkSession, path: str, fact: DataFrame) -> "Lattice":
        """A lattice stored by ``build``; without one at ``path``, every page is answered from the fact."""
        path = path.rstrip("/")
        stored = spark.read.parquet(f"{path}/{SIZES}").collect() if path_exists(spark, f"{path}/{SIZES}/_SUCCESS") else []  # a row a table
        return cls(spark, path, {frozenset(r.dims): r.n for r in stored}, fact)

    def choose(self, dims: Iterable[str], measures: Iterable[str] = ()) -> frozenset[str] | None:
        """The dimensions of the smallest table that holds ``dims``; None for the fact itself."""
        if refused := sorted(set(measures) - ADDITIVE):
            raise ValueError(f"{refused} can't be computed from sums; use the facts")
        needed = frozenset(dims) - {ALWAYS}
        holding = [s for s in self.sizes if needed <= s]
        return min(holding, key=lambda s: (self.sizes[s], len(s), sorted(s)), default=None)

    def fact_for(self, dims: Iterable[str], measures: Iterable[str] = ()) -> DataFrame:
        """The fact as pages over ``dims`` need it: a stored table of its sums, or itself."""
        chosen = self.choose(dims, measures)
        if chosen is None:
            return self.fact
        return self._stored(chosen)

    def _stored(self, dims: frozenset[str]) -> DataFrame:
        types = dict(self.fact.dtypes)
        columns = [f"{d} {types[d]}" for d in sorted(dims)]
        columns += [f"{c} {'bigint' if types[c] == 'bigint' else 'decimal(34,2)'}" for c in AMOUNTS]
        return self.spark.read.schema(", ".join([*columns, f"{ALWAYS} int"])).parquet(f"{self.path}/{set_name(dims)}")

    def star_for(self, t: Star, dims: Iterable[str], measures: Iterable[str] = ()) -> Star:
        """``t`` with its P&L fact replaced by the table that answers ``dims``. Targets that ``t`` derives
        from that fact are derived from its stored sums, too, not from its lines once more."""
        fact = self.fact_for(dims, measures)
        loaders = {name: (lambda name=name: getattr(t, name)) for name in TABLES}
        if t.derives_targets_from(self.fact) and self.choose(["market"]) is not None:
            loaders["ns_gm_target"] = lambda: Star.targets_of(self.fact_for(["market"]))
        return Star(loaders | {"fact_actuals_estimates": lambda: fact})
