"""A language column with very many values: the fit stays bounded and knows every one."""

import pickle

from pyspark.sql import functions as F

from rootwise.llm.language import languages, train_languages


def test_many_languages_share_the_bound(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("text of "), F.col("id").cast("string")).alias("text"),
        F.concat(F.lit("l"), (F.col("id") % 40).cast("string")).alias("lang"),
    )
    net = pickle.loads(train_languages(docs, epochs=1, max_rows=200))
    assert set(net.languages) <= {f"l{i}" for i in range(40)} and len(net.languages) > 30
    assert sorted(net.languages) == net.languages


def test_a_rare_language_is_learned(spark):
    rows = [(i, "der die das und ist nicht " * 3, "de") for i in range(60)]
    rows += [(100 + i, "the and that with this is " * 3, "en") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = {(r["doc_id"] >= 100, r["lang_pred"]) for r in languages(docs).collect()}
    assert told == {(False, "de"), (True, "en")}
