"""Mixing sources to target weights by Poisson replication (operator 4), in DataFrame functions only.

A source's mean repetition rate is its target share of the text over the share it has. Each document draws its number of copies from
the Poisson distribution of that mean: a uniform number hashed from its id and a seed is looked up in the source's table of
cumulative probabilities. Copies are exploded and shuffled globally by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lampyris.llm.scratch import free_name, materialise

#: A mean above this is drawn as a sum of independent parts, each with a mean of at most this; 64 terms hold its distribution
#: to below 2^-53.
PART, TERMS = 16.0, 64
SEED = 20240607


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits, from the MD5 of the parts joined by '/'."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 13), 16, 10).cast("double") / float(2**52)


def repetition_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0) -> DataFrame:
    """(source, rate): target share of characters times all characters times `epochs`, over the characters of the source.

    Without `weights` all sources get the same share; with them, shares are the weights over their sum and a source that is
    not named gets none. A null source is a source of its own. Sources without any text get a rate of 0.
    """
    sizes = materialise(docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")), "sources")
    if weights is None:
        sizes = sizes.withColumn("weight", F.when(F.col("chars") > 0, 1.0).otherwise(0.0))
    else:
        named = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, weight double")
        sizes = sizes.join(named, F.col("source").eqNullSafe(F.col("name")), "left").drop("name").fillna(0.0, ["weight"])
    total = sizes.agg(F.sum("chars").alias("chars"), F.sum("weight").alias("weight")).first()
    scale = float(epochs) * float(total.chars or 0) / float(total.weight or 1)
    return sizes.select("source", F.when(F.col("chars") > 0, F.col("weight") * scale / F.col("chars")).otherwise(0.0).alias("rate"))


def _with_tables(rates: DataFrame) -> DataFrame:
    """Adds `parts`, the number of independent draws, and `cdf`, the cumulative probabilities of one draw."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    mean = F.col("rate") / F.col("parts")
    terms = F.transform(F.sequence(F.lit(0), F.lit(TERMS - 1)), lambda k: F.when(k == 0, F.exp(-mean)).otherwise(mean / k))
    products = F.aggregate(
        terms, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("c"), F.array().cast("array<double>").alias("cdf")),
        lambda a, t: F.struct((a.p * t).alias("p"), (a.c + a.p * t).alias("c"), F.concat(a.cdf, F.array(a.c + a.p * t)).alias("cdf")),
        lambda a: a.cdf,
    )
    return rates.withColumn("parts", parts).withColumn("cdf", products)


def replicated(docs: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """`docs` once for each copy, with `copy` (from 1) and `n_copies`, in globally shuffled order.

    Rows are drawn by doc_id alone: equal ids get equal counts. Rows without an id are drawn, and shuffled, by the digest of their text.
    Columns of `docs` that are named like the added ones are replaced.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("copy", "n_copies")]
    docs = docs.select(keep)
    table, uniform = free_name("draw", docs), free_name("uniform", docs)
    tables = _with_tables(rates.select("source", "rate")).select(F.struct("source", "parts", "cdf").alias(table))
    if tables.count() <= 100_000:
        tables = F.broadcast(tables)
    no_id = F.concat(F.lit("text:"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    doc, cdf, parts = F.coalesce(F.col("doc_id").cast("string"), no_id), F.col(f"{table}.cdf"), F.col(f"{table}.parts")

    def draw(part: Column) -> Column:
        return F.size(F.filter(cdf, lambda p: p <= _uniform(F.lit(str(seed)), part.cast("string"), doc)))

    first = F.size(F.filter(cdf, lambda p: p <= F.col(uniform)))
    rest = F.aggregate(F.sequence(F.lit(1), parts - 1), F.lit(0), lambda s, part: s + draw(part))
    return (
        docs.withColumn(uniform, _uniform(F.lit(str(seed)), F.lit("0"), doc))
        .join(tables, F.col("source").cast("string").eqNullSafe(F.col(f"{table}.source")))
        .withColumn("n_copies", F.when(parts > 1, first + rest).otherwise(first)).where("n_copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
        .select(*keep, "copy", "n_copies")
        .orderBy(F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), no_id, "copy")).otherwise(F.xxhash64(F.lit(seed), "doc_id", "copy")))
    )


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """`docs` replicated so that the sources' shares of the text meet the target weights; see `replicated`."""
    return replicated(docs, materialise(repetition_rates(docs, weights, epochs), "rates"), seed)
