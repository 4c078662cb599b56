"""Rows are told apart wherever they come from: plain scans, joins, explodes, unions, files named twice."""

import pytest
from pyspark.sql import functions as F

from daybridge.llm.common import located, without
from daybridge.llm.exactdedup import exact_dedup
from daybridge.llm.licenses import license_spans
from daybridge.llm.simhash import simhash_components


def _doubled(documents, spark, sf, how):
    if how == "explode":
        return documents.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    if how == "join":
        return documents.crossJoin(F.broadcast(spark.range(2).withColumnRenamed("id", "copy"))).drop("copy")
    if how == "union":
        return documents.unionByName(documents)
    return spark.read.parquet(*[f"{sf}/documents.parquet"] * 2)


@pytest.mark.parametrize("how", ["explode", "join", "union", "twice"])
def test_doubled_rows(spark, sf, documents, how):
    once = documents.count()
    both = _doubled(documents, spark, sf, how)
    assert both.count() == 2 * once
    placed, place = located(both)
    assert placed.select(*place).distinct().count() == 2 * once
    found, _, _ = exact_dedup(both)
    kept = found.where("kept").count()
    assert kept == exact_dedup(documents)[0].where("kept").count() and found.count() == 2 * once
    assert sorted(r.group_size for r in found.collect())[0] == 2


def test_other_operators_behind_an_explode(spark, sf, documents):
    once, both = documents.count(), _doubled(documents, spark, sf, "explode")
    spans = license_spans(both)
    assert spans.count() == 2 * once
    assert spans.agg(F.sum("n_base")).first()[0] == 2 * license_spans(documents).agg(F.sum("n_base")).first()[0]
    found, placed, place = simhash_components(both)
    stays = found.groupBy("component_id").agg(F.min(F.struct("doc_id", *place)).alias("s")).select("s.*")
    assert stays.count() == simhash_components(documents)[0].select("component_id").distinct().count()
    gone = found.join(stays.select(*place), place, "left_anti").select(*place)
    assert without(placed, place, gone).count() == stays.count()


def test_scans_stay_unstaged(documents):
    plain = located(documents.where("doc_id > 3").select("doc_id", F.upper("text").alias("text")))[0]
    assert [f.split("/")[-1] for f in plain.inputFiles()] == ["documents.parquet"]
