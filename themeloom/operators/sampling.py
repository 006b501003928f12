"""Deterministic stratified samples: exact counts for each stratum, members by the rank of an md5."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Quotas by rating of the development, smoke and blind samples.
DEV, SMOKE, BLIND = {1: 10, 2: 4, 3: 3, 4: 2, 5: 1}, {1: 5, 2: 2, 3: 2, 4: 1}, {1: 18, 2: 12, 3: 10, 4: 5, 5: 5}
#: Parts that a stratum is cut into before its members are ranked.
SALT = 32


def draw_rank(seed: int, id_col: str = "review_id"):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def allocate(pools: DataFrame, target: int, by: str = "platform") -> DataFrame:
    """(by, rating, pool, n): largest-remainder shares of min(target, all) for pools(by, rating, pool).

    Doubles throughout; remainders go to the largest fraction, ties to the higher rating; no stratum gives
    more than it has.
    """
    every = Window.partitionBy(by)
    held = pools.withColumn("total", F.sum("pool").over(every)).withColumn("goal", F.least(F.lit(target), F.col("total")))
    held = held.withColumn("share", F.col("goal").cast("double") * F.col("pool") / F.col("total")).withColumn("base", F.floor("share"))
    held = held.withColumn("left", F.col("goal") - F.sum("base").over(every))
    rank = F.row_number().over(every.orderBy((F.col("share") - F.col("base")).desc(), F.col("rating").desc()))
    extra = (rank <= F.col("left")).cast("bigint")
    return held.withColumn("n", F.least(F.col("base") + extra, F.col("pool"))).select(by, "rating", "pool", "n")


def draw(rows: DataFrame, quotas: DataFrame, keys: list[str], seed: int = 42, id_col: str = "review_id") -> DataFrame:
    """The rows of each stratum with the least md5 ranks, as many as quotas(keys, n) says, with their place `pos` from 1.

    First the last rank of each stratum is found among ranks and ids alone: each stratum is cut into SALT parts by a hash,
    and the first n of each part hold the first n of all. Then rows up to it are ranked; no others are dealt anew. Quotas
    have a row for each stratum and are broadcast.
    """
    rank, quotas = draw_rank(seed, id_col), quotas.select(*keys, F.col("n").alias("_n"))
    ids = rows.select(*keys, F.struct(rank.alias("r"), F.col(id_col).alias("i")).alias("_o")).join(F.broadcast(quotas), keys)
    ids = ids.withColumn("_salt", F.pmod(F.xxhash64("_o.i"), F.lit(SALT)))
    ids = ids.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy("_o"))).where("_rn <= _n")
    ids = ids.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy("_o"))).where("_rn <= _n")
    last = ids.groupBy(*keys).agg(F.max("_o").alias("_last"), F.first("_n").alias("_n"))
    held = rows.join(F.broadcast(last), keys).where(F.struct(rank.alias("r"), F.col(id_col).alias("i")) <= F.col("_last"))
    held = held.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy(rank, F.col(id_col))))
    return held.where("pos <= _n").select(*rows.columns, "pos")


def fixed(rows: DataFrame, quotas: dict[int, int], seed: int = 42, by: str | None = None, strict: bool = True) -> DataFrame:
    """Fixed quotas by rating (for each `by`); a short stratum is an error if strict, else it gives all it has."""
    spark = rows.sparkSession
    keys = [*([by] if by else []), "rating"]
    want = spark.createDataFrame(list(quotas.items()), "rating int, n int")
    if by:
        each = F.explode(F.array(*[F.struct(F.lit(r).alias("rating"), F.lit(n).alias("n")) for r, n in quotas.items()])).alias("q")
        want = rows.select(by).where(F.col(by).isNotNull()).distinct().select(by, each).select(by, "q.*")
    if strict:
        have = rows.groupBy(*keys).count()
        short = want.join(have, keys, "left").where("coalesce(count, 0) < n")
        if (x := short.first()) is not None:
            raise ValueError(f"stratum {x.asDict()} is too small")
    return draw(rows, want, keys, seed)


def with_pins(picked: DataFrame, corpus: DataFrame, pins: DataFrame, id_col: str = "review_id") -> DataFrame:
    """picked and the pinned rows of corpus that it lacks, without a pos; pins(id) outside corpus are ignored."""
    missing = corpus.join(pins, id_col, "left_semi").join(picked.select(id_col), id_col, "left_anti")
    return picked.unionByName(missing, allowMissingColumns=True)
