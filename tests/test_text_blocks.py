"""Functions that take a batch of texts apart at once give what the native ones give for each text."""

from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.sql import functions as F

from linksift.functions.text import entropy, shannon
from linksift.operators.mutate import mutate_urls
from linksift.operators.ngrams import CharNGramHasher, char_ngrams
from linksift.operators.parse import with_url_features
from linksift.sources.corpus import url_corpus

ODD = [(None,), ("",), ("  ",), ("a",), ("a b cd\nef",), ("\U0001f600x é ж漢字漢",), ("x" * 9000 + "ж" * 3000,)]


def texts(spark, sf):
    urls = url_corpus(spark, sf).select("url")
    return urls.union(mutate_urls(urls, 1).select("url")).union(spark.createDataFrame(ODD, "url string"))


def test_ngrams_hash_as_in_the_library(spark, sf):
    """The same vectors, without a string for each n-gram in the plan."""
    listed = texts(spark, sf).withColumn("g", char_ngrams(F.coalesce("url", F.lit(""))))
    counted = HashingTF(inputCol="g", outputCol="c", numFeatures=64).transform(listed)
    wanted = Normalizer(inputCol="c", outputCol="wanted", p=2.0).transform(counted).drop("g", "c")
    both = CharNGramHasher(inputCol="url", outputCol="given", numFeatures=64).transform(wanted)
    assert both.filter("given IS NULL OR given <> wanted").count() == 0
    assert both.schema["given"].metadata == {"ml_attr": {"num_attrs": 64}}
    alone = CharNGramHasher(inputCol="url", outputCol="given", numFeatures=64).transform(spark.createDataFrame(ODD, "url string"))
    assert "substring" not in alone._jdf.queryExecution().optimizedPlan().toString()


def test_entropies_as_by_runs(spark, sf):
    both = texts(spark, sf).select(shannon(F.col("url")).alias("wanted"), entropy(F.col("url")).alias("given"))
    assert both.filter("(wanted IS NULL) <> (given IS NULL) OR abs(wanted - given) > 1e-12").count() == 0


def test_last_labels_are_joined_once(spark):
    """They are searched for each brand, but made only once."""
    found = with_url_features(spark.createDataFrame([("http://a.example/",)], "url string"), similarity=False, flags=False)
    shown = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", shown)
    assert 1 <= plan.count("array_join(slice(u_labels") <= 3
