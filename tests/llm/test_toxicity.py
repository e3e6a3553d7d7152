import random

import pytest
from pyspark.sql import functions as F

from lakeload.llm import toxicity
from lakeload.llm.common import remainder
from lakeload.llm.queries import QUERIES
from lakeload.llm.toxicity import Fit, score, train, without_toxic
from llm.helpers import awkward, empty, prose


@pytest.fixture(scope="module")
def planted(spark):
    """Toxic texts hold one of four words now and then; a clean text may be mostly one word."""
    rng, rows = random.Random(4), []
    for i in range(900):
        words = prose(i, rng.randrange(20, 200)).split() if i % 50 else ["w3"] * 80
        if toxic := i % 7 == 0:
            for _ in range(max(1, len(words) // 40)):
                words.insert(rng.randrange(len(words)), rng.choice(["grobble", "snarkle", "vilemost", "vilest"]))
        rows.append((i, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()
    return df.select("doc_id", "text"), df.select("doc_id", F.lit(1).alias("quality"), "toxic")


def test_held_out(spark, planted):
    docs, labels = planted
    told = labels.filter("doc_id % 3 <> 1")
    rows = score(docs, train(docs, told)).join(labels, "doc_id").filter(remainder(F.col("doc_id"), 4) == 2).collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == t] for t in (1, 0))
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.03 * len(clean)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_used(spark, planted):
    docs, labels = planted
    turned = labels.withColumn("toxic", F.when(remainder(F.col("doc_id"), 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert train(docs, labels) == train(docs.repartition(3), turned)


def test_query(spark):
    rows = QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.predicted == (r.score >= 0.3) for r in rows)


def test_awkward_rows(spark, planted):
    model = train(*planted)
    docs = awkward(spark, extra=True)
    kept = without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    blank = {r.score for r in score(docs.select("doc_id", "text"), model).collect() if not (r.text or "").strip()}
    assert len(blank) == 1
    none = train(empty(spark), planted[1].limit(0))
    assert without_toxic(empty(spark), none).count() == 0 and without_toxic(docs, none).count() == docs.count()
    score(docs.select("doc_id", "text"), train(docs, planted[1])).collect()


@pytest.mark.parametrize("same", [True, False])
def test_one_id_with_a_third_of_the_rows(spark, planted, monkeypatch, same):
    """Its rows, equal or not, are one example of each kind; the others still fill the samples."""
    docs, labels = planted
    hot = docs.filter(remainder(F.col("doc_id"), 4) != 2).join(labels.filter("toxic = 1"), "doc_id").agg(F.min("doc_id")).head()[0]
    text = F.lit("grobble w1 w2") if same else F.concat(F.lit("grobble w1 x"), F.col("id").cast("string"))
    more = spark.range(450).select(F.lit(hot).alias("doc_id"), text.alias("text"))
    fitted, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda row, column, share, toxic, *rest: fitted.append(toxic) or fit(row, column, share, toxic, *rest))
    how = Fit(positives=1000, unlabelled=1000)
    train(docs.unionByName(more), labels, how)
    usable = docs.filter(remainder(F.col("doc_id"), 4) != 2)
    (toxic,) = fitted
    assert toxic.sum() == usable.join(labels.filter("toxic = 1"), "doc_id").count()
    assert (~toxic).sum() == usable.count()
    train(docs.unionByName(more), labels, Fit(positives=20, unlabelled=40))
    assert fitted[1].sum() == 20 and len(fitted[1]) == 60
