"""An inverted index for keyword_search: postings by word in slabs of texts, with the greatest count of each, and an early stop.

Texts of like length share a slab of at most about ``SLAB`` texts. A slab's bound for a query is the sum over its words of their greatest
count there times their weight. The slabs of the highest bounds that hold n texts are scored first; the n-th score then rules out all slabs
whose bound is below it, and the rest is scored. So the result is that of scoring every text; long texts are mostly enough.
The index is sorted by word, so a query reads the row groups of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLAB = 4096


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def build(df: DataFrame, ident: str, text: str, path: str, slab: int = SLAB) -> None:
    """Writes the index of ``text`` below ``path``: postings (word, slab, n, top, ids, counts), and the number of texts."""
    own = df.select(F.col(ident).alias("id"), _words(F.coalesce(F.col(text), F.lit(""))).alias("w"))
    kind = F.floor(F.log2(F.size("w") + 1.0) * 4).cast("int")
    own = own.withColumn("kind", kind)
    sizes = own.groupBy("kind").agg(F.count("*").alias("n"))  # a row for each class of lengths, some hundred at most
    parts = sizes.select("kind", F.ceil(F.col("n") / slab).cast("int").alias("parts"))
    dealt = own.join(F.broadcast(parts), "kind").withColumn("slab", F.struct("kind", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")))
    each = dealt.select("id", "slab", F.explode("w").alias("word")).groupBy("word", "slab", "id").agg(F.count("*").alias("tf"))
    rows = each.groupBy("word", "slab").agg(F.count("*").alias("n"), F.max("tf").alias("top"), F.collect_list(F.struct("id", "tf")).alias("held"))  # a slab's texts
    rows = rows.select("word", "slab", "n", "top", F.col("held.id").alias("ids"), F.col("held.tf").alias("counts"))
    rows.repartitionByRange("word", "slab").sortWithinPartitions("word", "slab").write.parquet(f"{path}/postings")
    df.agg(F.count("*").alias("n_texts")).write.parquet(f"{path}/texts")


class TextIndex:
    """The index below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.postings = spark, spark.read.parquet(f"{path}/postings")
        self.n_texts = spark.read.parquet(f"{path}/texts").first()[0]

    def _bounds(self, query: str) -> tuple[DataFrame, DataFrame]:
        """(weights of the query's words, bounds of the slabs that hold any), from the columns without the lists."""
        words = sorted({w for w in query.lower().split() if w})
        own = self.postings.where(F.col("word").isin(words))
        weights = own.groupBy("word").agg(F.sum("n").alias("df")).select("word", F.log1p(F.lit(self.n_texts) / F.col("df")).alias("idf"))
        met = own.select("word", "slab", "n", "top").join(F.broadcast(weights), "word")  # a row for each word of the query
        return weights, met.groupBy("slab").agg(F.sum(F.col("top") * F.col("idf")).alias("bound"), F.max("n").alias("texts"), F.sum("n").alias("postings"))

    def _scores(self, weights: DataFrame, slabs: DataFrame) -> DataFrame:
        held = self.postings.join(F.broadcast(weights), "word").join(slabs.select("slab"), "slab", "left_semi")
        each = held.select("idf", F.explode(F.arrays_zip("ids", "counts")).alias("x"))
        return each.groupBy(F.col("x.ids").alias("id")).agg(F.sum(F.col("x.counts") * F.col("idf")).alias("score"))

    def search(self, query: str, ident: str, n: int = 50) -> tuple[DataFrame, dict]:
        """(ident and score of the n best texts, what was read: postings, of how many)."""
        weights, bounds = self._bounds(query)
        # the first slabs by bound that hold n texts; their number is that of n texts at most, however many slabs there are
        first = bounds.orderBy(F.desc("bound"), "slab").limit(n).withColumn("before", F.coalesce(F.sum("texts").over(Window.orderBy(F.desc("bound"), "slab").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        first = first.where(F.col("before") < n)
        floor = self._scores(weights, first).orderBy(F.desc("score"), "id").limit(n).agg(F.min("score").alias("score"), F.count("*").alias("n")).first()
        # sums of doubles may differ in their last digits by order
        least = floor["score"] * (1 - 1e-9) if floor["n"] == n else 0.0
        chosen = bounds.where(F.col("bound") >= least)
        read = bounds.agg(F.sum(F.when(F.col("bound") >= least, F.col("postings")).otherwise(0)).alias("postings"), F.sum("postings").alias("of")).first()
        best = self._scores(weights, chosen).orderBy(F.desc("score"), "id").limit(n).withColumnRenamed("id", ident)
        return best, {"postings": read["postings"] or 0, "of": read["of"] or 0}
