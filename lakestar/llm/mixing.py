"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Each source gets the mean repetition rate that brings its share of the output bytes to its target weight.
A document's number of copies is a Poisson variable of that mean, inverted from a uniform number that is a
hash of (seed, document id): no state, the same result on every run and after every retry. Copies are
exploded and shuffled globally by a hash key.

A mean above MAX_MEAN is drawn in parts of equal means. Rows with such means (all of a source that is small beside its weight) are exploded in two
levels: groups of GROUP parts, dealt to tasks, draw and make their copies on their own, so no task makes an array of more than a bounded number of a row's copies.

Defined results: a null text has no bytes but is replicated like its source's other rows; a null source is a
source of its own; the rows of a source without bytes, which no rate gives a share of bytes, have a mean of ``epochs``; a source without a positive weight is left out; rows with the same id
draw the same number; an empty table gives an empty result. Input columns named like the added ones give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import spare, with_columns, written

#: Means above this are split into equal parts with a draw each, so that exp(-mean) stays far from underflow.
MAX_MEAN = 500.0
#: Parts that are drawn in one group.
GROUP = 256


def uniform(*parts: Column) -> Column:
    """Uniform number in [0, 1): the first 52 bits of an MD5 over the parts."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def poisson_cdf(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until the tail is below the resolution of a uniform number."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))
    return F.aggregate(
        F.sequence(F.lit(1), last), start,
        lambda a, k: F.struct((a["p"] * mean / k).alias("p"),
                              F.concat(a["cdf"], F.array(F.element_at(a["cdf"], -1) + a["p"] * mean / k)).alias("cdf")),
        lambda a: a["cdf"])


def source_rates(docs: DataFrame, weights: dict | None, epochs: float, source: str, text: str) -> DataFrame:
    """Source, rate, parts and the CDF of rate / parts: a row for each source. ``weights`` None: equal weights."""
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint")
    stats = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("bytes"))
    if weights is None:
        stats = stats.withColumn("weight", F.lit(1.0))
    else:
        given = docs.sparkSession.createDataFrame(
            [(k, float(v)) for k, v in weights.items()], f"name {docs.select(source).schema[0].dataType.simpleString()}, weight double")
        stats = stats.join(given, F.col("source").eqNullSafe(F.col("name")), "left").drop("name")
    stats = written(stats.where("weight > 0"), "mix-sources")
    total = stats.where("bytes > 0").agg(F.sum("bytes").alias("bytes"), F.sum("weight").alias("weight")).first()
    rate = F.col("weight") / F.lit(total["weight"]) * F.lit(float(epochs)) * F.lit(total["bytes"]) / F.col("bytes")
    rates = stats.withColumn("rate", F.when(F.col("bytes") > 0, rate).otherwise(F.lit(float(epochs))))
    rates = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_MEAN)).cast("bigint"))
    return rates.withColumn("cdf", poisson_cdf(F.col("rate") / F.col("parts")))


def mix_sources(docs: DataFrame, weights: dict | None = None, epochs: float = 1.0, seed: int = 17,
                id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` replicated to the target weights, with ``copy_no`` (1 to ``n_copies``), ``n_copies`` and
    ``shuffle_key``; rows lie in the random order of that key within hash partitions of it."""
    own = {k: spare(docs, f"mix_{k}") for k in ("source", "parts", "cdf", "first", "drawn", "before", "total", "row")}
    parts, cdf, first, drawn, before, total, row = (F.col(own[k]) for k in ("parts", "cdf", "first", "drawn", "before", "total", "row"))
    rates = written(source_rates(docs, weights, epochs, source_col, text_col), "mix-rates")
    rates = rates.select(F.col("source").alias(own["source"]), F.col("parts").alias(own["parts"]), F.col("cdf").alias(own["cdf"]))

    def draws(start: Column, end: Column) -> Column:
        """Copies that the parts from ``start`` to ``end`` draw."""
        return F.aggregate(F.sequence(start, end), F.lit(0).cast("bigint"), lambda n, part: n + F.size(
            F.filter(cdf, lambda c: c <= uniform(F.lit(seed), F.col(id_col), part))))

    one = F.lit(1).cast("bigint")
    joined = docs.join(rates, F.col(source_col).eqNullSafe(F.col(own["source"])))
    few = joined.where(parts == 1).withColumn(own["drawn"], draws(one, one)).withColumn(own["before"], F.lit(0).cast("bigint")).withColumn(own["total"], drawn)
    kept = [F.col(f"`{c}`") for c in docs.columns] + [drawn, before, total]
    copies = few.select(*kept)
    if rates.where(parts > 1).limit(1).count():
        # Written, so that a row has one number; its groups then know what was drawn before them.
        many = written(joined.where(parts > 1).withColumn(own["row"], F.monotonically_increasing_id()), "mix-many")
        groups = many.select(row, F.col(id_col), parts, cdf, F.explode(F.sequence(one, parts, F.lit(GROUP).cast("bigint"))).alias(own["first"]))
        groups = groups.repartition(row, first).withColumn(own["drawn"], draws(first, F.least(first + GROUP - 1, parts)))
        groups = written(groups.select(row, first, drawn), "mix-draws")
        order = Window.partitionBy(own["row"]).orderBy(own["first"])
        placed = groups.withColumn(own["before"], F.sum(drawn).over(order) - drawn).withColumn(
            own["total"], F.sum(drawn).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        copies = copies.unionByName(many.join(placed, own["row"]).repartition(row, first).select(*kept))
    counted = copies.where(drawn > 0)
    copies = with_columns(counted, {"n_copies": total, "copy_no": F.explode(F.sequence(before + 1, before + drawn))}).drop(*own.values())
    key = F.md5(F.concat_ws("|", F.lit(f"order-{seed}"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("copy_no")))
    copies = with_columns(copies, {"shuffle_key": key})
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
