"""Text clusters: TF-IDF over words and pairs, reduced and clustered by k-means."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, CountVectorizer, NGram, Normalizer, RegexTokenizer, SQLTransformer, StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Words of the domain that say nothing about a cluster.
DOMAIN_WORDS = ["study", "trial", "group", "patients", "participants", "treatment"]
SEED = 42


def model(df: DataFrame, text: str, k: int, terms: int = 2500, least_docs: int = 3):
    """Fitted pipeline; ``weights`` are the TF-IDF vectors and ``cluster`` the assignment. The vocabulary is bounded by ``terms``."""
    words = RegexTokenizer(inputCol=text, outputCol="_raw", pattern=r"\b\w\w+\b", gaps=False)
    plain = StopWordsRemover(inputCol="_raw", outputCol="_words", stopWords=StopWordsRemover.loadDefaultStopWords("english") + DOMAIN_WORDS)
    pairs = NGram(n=2, inputCol="_words", outputCol="_pairs")
    both = SQLTransformer(statement="SELECT *, concat(_words, _pairs) AS _terms FROM __THIS__")
    counts = CountVectorizer(inputCol="_terms", outputCol="_counts", vocabSize=terms, minDF=least_docs)
    idf = IDF(inputCol="_counts", outputCol="_idf")
    unit = Normalizer(inputCol="_idf", outputCol="weights")
    means = KMeans(featuresCol="weights", predictionCol="cluster", k=k, seed=SEED)
    return Pipeline(stages=[words, plain, pairs, both, counts, idf, unit, means]).fit(df)


def clusters(df: DataFrame, text: str, k: int, top: int = 10) -> DataFrame:
    """(cluster, n, terms): the size of each cluster and its terms of greatest mean weight."""
    from pyspark.ml.functions import vector_to_array

    kept = df.where(F.trim(text) != "")
    fitted = model(kept, text, k)
    words = fitted.stages[4].vocabulary  # bounded by the vocabulary's size
    rows = fitted.transform(kept).select("cluster", vector_to_array("weights").alias("w"))
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("n"))
    weights = rows.select("cluster", F.posexplode("w").alias("at", "x")).where("x > 0").groupBy("cluster", "at").agg(F.sum("x").alias("x"))
    place = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("x"), "at"))
    named = weights.withColumn("place", place).where(F.col("place") <= top).withColumn("term", F.element_at(F.array(*map(F.lit, words)), F.col("at") + 1))
    lists = named.groupBy(F.col("cluster").alias("c")).agg(F.array_sort(F.collect_list(F.struct("place", "term"))).alias("t"))
    return sizes.join(lists, F.col("cluster") == F.col("c"), "left").select("cluster", "n", F.array_join(F.transform("t", lambda x: x["term"]), ", ").alias("terms"))
