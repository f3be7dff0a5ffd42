"""Mixing sources to target weights: temperature mixing realised by budgeted block permutations.

Token shares p of the sources are raised to an exponent a in [0, 1] and normalised
(1: as they are, 0: all alike). The exponent is searched on a grid of `GRID` steps until a
limit is met: the smallest one for which no source is repeated more than `max_epochs` times,
or the largest one that reaches an entropy. The budget of tokens is dealt by the weights; a
source gets whole epochs of its documents, then a part of one more. In every epoch documents
are dealt to blocks of about `block_tokens` tokens by a hash of (doc_id, epoch); of the last
epoch a source takes blocks in order while they fit, and of the next block documents in hash
order while they fit. So only block totals are summed in a row, never the documents of a source.

Defined results: tokens are runs of characters other than space and U+0009..U+000D; a null or
empty text has none. A null source is a source of its own. A source without tokens has weight
0 and leaves no rows; an empty table gives none. Rows that repeat count each. With no budget
given, it is the smallest one that gives every source one epoch, so that no document is lost.
Extra columns are kept by `mix` and never read; the names it adds start with `mix_`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.shared import cut

MAX_EPOCHS = 1.5
BLOCK_TOKENS = 1_000_000
GRID = 1_000_000
SECTIONS = 100
BROADCAST_SOURCES = 10_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def exponent(totals: DataFrame, budget: float | None, max_epochs: float | None, min_entropy: float | None) -> tuple[float, float, float]:
    """The exponent, the sum of p^a over sources, and the budget in tokens.

    Each round tries up to SECTIONS grid points at once in one aggregation over the sources;
    both conditions are monotone in the exponent.
    """
    tokens = totals.agg(F.sum("mix_total").alias("t")).first()["t"] or 0
    if not tokens:
        return 1.0, 1.0, 0.0
    low, high = 0, GRID
    while True:
        step = max(1, (high - low) // SECTIONS)
        tried = sorted({*range(low, high, step), high})
        p = F.col("mix_total") / F.lit(float(tokens))
        weight = F.pow(p, F.col("a"))
        points = totals.where("mix_total > 0").withColumn("k", F.explode(F.lit(tried))).withColumn("a", F.col("k") / F.lit(float(GRID)))
        rows = points.groupBy("k").agg(
            F.sum(weight).alias("z"), F.max(weight / p).alias("most"), F.min(weight / p).alias("least"), F.sum(weight * F.ln(weight)).alias("wlogw")
        ).collect()  # at most SECTIONS + 2 rows
        rows = {r["k"]: r for r in rows}

        def size(r) -> float:
            return tokens * r["z"] / r["least"] if budget is None else float(budget)

        def meets(r) -> bool:
            if max_epochs is not None:
                return size(r) / tokens * r["most"] / r["z"] <= max_epochs
            return math.log(r["z"]) - r["wlogw"] / r["z"] >= min_entropy

        good = [k for k in tried if meets(rows[k])]
        if max_epochs is not None:
            found = good[0] if good else GRID
            low, high = max([k for k in tried if k < found], default=found), found
        else:
            found = good[-1] if good else 0
            low, high = found, min([k for k in tried if k > found], default=found)
        if step == 1:
            return found / GRID, rows[found]["z"], size(rows[found])


def hashed(epoch: Column) -> Column:
    """52 bits of a hash of (doc_id, epoch) as a double."""
    text = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), epoch.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")


def block_of(key: Column, blocks: Column) -> Column:
    return F.floor(key / F.lit(float(1 << 52)) * blocks).cast("long")


def mix(docs: DataFrame, tokens: Column | None = None, budget: float | None = None, max_epochs: float | None = MAX_EPOCHS, min_entropy: float | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """`docs` (doc_id, source, ..), each row as often as its source's weight asks for, with
    mix_tokens, mix_epoch, mix_block and mix_key; order by (mix_epoch, mix_block, mix_key) to read."""
    if max_epochs is not None and max_epochs < 1:
        raise ValueError("max_epochs must be 1 or more")
    if (max_epochs is None) == (min_entropy is None):
        raise ValueError("give either max_epochs or min_entropy")
    tokens = word_count() if tokens is None else tokens
    thin = cut(docs.select("doc_id", "source", tokens.alias("mix_tokens")))
    totals = cut(thin.groupBy("source").agg(F.sum("mix_tokens").alias("mix_total")))
    a, z, size = exponent(totals, budget, max_epochs, min_entropy)
    shares = totals.where("mix_total > 0").select(F.col("source").alias("mix_source"), "mix_total")
    whole = totals.agg(F.sum("mix_total").alias("t")).first()["t"] or 1
    quota = F.round(F.pow(F.col("mix_total") / F.lit(float(whole)), F.lit(a)) / F.lit(z) * F.lit(size)).cast("long")
    plan = (
        shares.withColumn("mix_quota", quota)
        .withColumn("mix_epochs", F.expr("mix_quota div mix_total").cast("int"))
        .withColumn("mix_rest", F.expr("mix_quota % mix_total"))
        .withColumn("mix_blocks", F.ceil(F.col("mix_total") / F.lit(block_tokens)).cast("double"))
    )
    many = totals.count()
    sized = (lambda x: F.broadcast(x)) if many <= BROADCAST_SOURCES else (lambda x: x)
    last = thin.join(sized(plan), F.col("source").eqNullSafe(F.col("mix_source"))).select(
        "mix_source", "mix_tokens", "mix_rest", block_of(hashed(F.col("mix_epochs")), F.col("mix_blocks")).alias("mix_block")
    )
    sums = last.groupBy("mix_source", "mix_block").agg(F.sum("mix_tokens").alias("mix_sum"), F.max("mix_rest").alias("mix_rest"))
    running = Window.partitionBy("mix_source").orderBy("mix_block").rowsBetween(Window.unboundedPreceding, 0)
    edges = sums.withColumn("mix_upto", F.sum("mix_sum").over(running)).where("mix_upto > mix_rest")
    edge = edges.groupBy(F.col("mix_source").alias("edge_source")).agg(F.min("mix_block").alias("mix_edge"), F.min(F.col("mix_upto") - F.col("mix_sum")).alias("mix_before"))
    plan = cut(plan.join(edge, F.col("mix_source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source"))
    rows = docs.withColumn("mix_tokens", tokens).join(sized(plan), F.col("source").eqNullSafe(F.col("mix_source")))
    rows = rows.withColumn("mix_epoch", F.explode(F.expr("sequence(0, mix_epochs)")))
    rows = rows.withColumn("mix_key", hashed(F.col("mix_epoch"))).withColumn("mix_block", block_of(F.col("mix_key"), F.col("mix_blocks")))
    surely = rows.where("mix_epoch < mix_epochs OR mix_block < mix_edge")
    border = rows.where("mix_epoch = mix_epochs AND mix_block = mix_edge")
    ordered = Window.partitionBy("mix_source").orderBy("mix_key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    border = border.withColumn("mix_cum", F.col("mix_before") + F.sum("mix_tokens").over(ordered)).where("mix_cum <= mix_rest").drop("mix_cum")
    names = [*docs.columns, "mix_tokens", "mix_epoch", "mix_block", "mix_key"]
    return surely.select(*names).unionByName(border.select(*names))


def op6_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    thin = cut(docs.select("doc_id", "source", word_count().alias("n_tokens")))
    rows = mix(thin, F.col("n_tokens"))
    return rows.select("doc_id", "source", "n_tokens", F.col("mix_epoch").alias("epoch"), F.col("mix_block").alias("block"), F.col("mix_key").cast("long").alias("place"))


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents
), s AS (SELECT source, sum(n_tokens)::DOUBLE AS t FROM d GROUP BY source HAVING sum(n_tokens) > 0),
p AS (SELECT source, t, t / (SELECT sum(t) FROM s) AS p FROM s),
b(lo, hi) AS (
  SELECT 0, {GRID}
  UNION ALL
  SELECT CASE WHEN ok THEN lo ELSE mid + 1 END, CASE WHEN ok THEN mid ELSE hi END
  FROM (SELECT lo, hi, (lo + hi) // 2 AS mid,
          (SELECT max(pow(p, ((lo + hi) // 2) / {GRID}.0::DOUBLE) / p) / min(pow(p, ((lo + hi) // 2) / {GRID}.0::DOUBLE) / p) FROM p) <= {MAX_EPOCHS} AS ok
        FROM b WHERE lo < hi)
), e AS (SELECT max(lo) / {GRID}.0::DOUBLE AS a FROM b),
w AS (SELECT source, t, pow(p, a) / p AS r, pow(p, a) AS w FROM p, e),
q AS (SELECT source, t::BIGINT AS t, round(w / (SELECT min(r) FROM w) * (SELECT sum(t) FROM s))::BIGINT AS quota FROM w),
plan AS (SELECT source, quota // t AS epochs, quota % t AS rest, ceil(t / {BLOCK_TOKENS}.0)::DOUBLE AS blocks FROM q),
r AS (SELECT d.doc_id, d.source, n_tokens, epochs, rest, blocks, unnest(range(0, epochs + 1)) AS epoch FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source),
h AS (SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || epoch::VARCHAR), 1, 13))::BIGINT AS place FROM r),
k AS (SELECT *, floor(place::DOUBLE / {1 << 52} * blocks)::BIGINT AS block FROM h),
c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY block, place, doc_id ROWS UNBOUNDED PRECEDING) AS cum FROM k)
SELECT doc_id, source, n_tokens::BIGINT AS n_tokens, epoch::INTEGER AS epoch, block, place FROM c WHERE epoch < epochs OR cum <= rest
"""
