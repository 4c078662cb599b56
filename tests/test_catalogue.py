import datetime as dt
import glob
import os
import xml.etree.ElementTree as ET
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from daybridge.operators.catalogue import catalogue_lite, catalogue_offers
from daybridge.session import few_listing_tasks
from daybridge.sinks import catalogue as sink
from daybridge.sinks.catalogue import catalogue_xml, catalogue_xml_lite

NOW = dt.datetime(2026, 2, 2, 16, 34)
COLUMNS = ("mercant_id string, mercant_name string, product_id long, title string, url string, price double, "
           "original_price double, time_scrap timestamp, pars_date_created_at timestamp")


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([
        ("m1", "Ann & Co", 2, "a <b> & \"c\" 'd'", "http://x?a=1&b=2", 10.5, None, at("2026-02-02 10:00:00"), at("2026-02-02 00:00:00")),
        ("m1", "Ann & Co", 1, None, None, 2e7, 1.0, None, at("2026-02-03 10:00:00")),
        ("a/b c", None, 3, "x", "", 1.0, 1.0, None, at("2026-02-02 23:59:59")),
        ("", "none", 4, "x", "", 1.0, 1.0, None, at("2026-02-02 23:59:59")),
        (None, "none", 5, "x", "", 1.0, 1.0, None, at("2026-02-02 23:59:59")),
    ], COLUMNS)


def documents(path):
    """Merchant -> its documents in fragment order; each file is one."""
    found = {}
    for merchant in glob.glob(f"{path}/mercant_id=*"):
        fragments = sorted(glob.glob(f"{merchant}/fragment=*"), key=lambda f: int(f.rsplit("=", 1)[1]))
        texts = []
        for fragment in fragments:
            files = glob.glob(f"{fragment}/*.txt")
            assert len(files) == 1
            texts.append(open(files[0], encoding="utf-8").read())
        found[unquote(os.path.basename(merchant).split("=", 1)[1])] = texts
    return found


def test_one_document_per_merchant(products, folder):
    catalogue_xml(products, f"{folder}/x", generated_at=NOW)
    found = documents(f"{folder}/x")
    assert set(found) == {"m1", "a/b c"}
    assert found["m1"][0] == """<yml_catalog date="2026-02-02 16:34">
<shop>
<name>Ann &amp; Co</name>
<company>m1</company>
<categories/>
<offers>
<offer id="1">
<name/>
<url/>
<price>20000000.0</price>
<oldprice>1.0</oldprice>
<path/>
<category/>
<picture/>
<scrappedat/>
<measure/>
<city/>
</offer>
<offer id="2">
<name>a &lt;b&gt; &amp; "c" 'd'</name>
<url>http://x?a=1&amp;b=2</url>
<price>10.5</price>
<oldprice/>
<path/>
<category/>
<picture/>
<scrappedat>2026-02-02T10:00:00+00:00</scrappedat>
<measure/>
<city/>
</offer>
</offers>
</shop>
</yml_catalog>
"""
    root = ET.fromstring(found["a/b c"][0])
    assert root.find("shop/company").text == "a/b c" and root.find("shop/name").text is None


def test_only_the_given_day(products, folder):
    catalogue_xml(products, f"{folder}/x", "2026-02-02", NOW)
    root = ET.fromstring(documents(f"{folder}/x")["m1"][0])
    assert [o.get("id") for o in root.iter("offer")] == ["2"]


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_large_merchant_is_written_by_many_tasks(spark, folder, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(sink, "BROADCAST_ROWS", 0)
    rows = spark.range(30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), F.col("id") % 200)).alias("mercant_id"),
        F.lit("n").alias("mercant_name"),
        # Every other offer of the large merchant is the same copy.
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("product_id"))
    catalogue_xml(rows, f"{folder}/x", generated_at=NOW, max_offers=1000)
    found = documents(f"{folder}/x")
    assert len(found["hot"]) == 10 and {ET.fromstring(t).find("shop/company").text for t in found["hot"]} == {"hot"}
    assert sum(len(ET.fromstring(t).findall("shop/offers/offer")) for t in found["hot"]) == 10_000
    for part in glob.glob(f"{folder}/x/mercant_id=hot/fragment=*/*.txt"):
        assert 900 <= open(part).read().count("<offer id") <= 1100
    assert {len(texts) for m, texts in found.items() if m != "hot"} == {1}
    assert sum(len(ET.fromstring(t).findall("shop/offers/offer")) for texts in found.values() for t in texts) == 30_000


def test_publishing_again_leaves_no_old_fragments(spark, folder):
    rows = spark.range(100).select(F.lit("m").alias("mercant_id"), F.col("id").alias("product_id"))
    catalogue_xml(rows, f"{folder}/x", generated_at=NOW, max_offers=10)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        catalogue_xml(rows.limit(5), f"{folder}/x", generated_at=NOW, max_offers=10)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    text, = documents(f"{folder}/x")["m"]
    assert len(ET.fromstring(text).findall("shop/offers/offer")) == 5


def test_offer_id_falls_back_only_when_the_column_is_missing(spark):
    both = spark.createDataFrame([("m", None, 7)], "mercant_id string, product_id long, id long")
    assert catalogue_offers(both).first().offer_id == ""
    assert catalogue_offers(both.drop("product_id")).first().offer_id == "7"
    with pytest.raises(ValueError, match="mercant_id"):
        catalogue_offers(both.drop("mercant_id"))


def test_merchants_are_counted_without_sorting_offers(products, capsys):
    sink.merchants(catalogue_offers(products), 10).explain()
    plan = capsys.readouterr().out
    scan_side = plan[plan.rindex("Exchange"):]
    assert "HashAggregate" in scan_side and "Sort" not in scan_side


def test_lite(spark, folder):
    rows = spark.range(3000).select(
        F.col("id"), F.lit("Ann & Co").alias("mercant_name"), F.lit("m1").alias("mercant_id"),
        F.concat(F.lit("t"), F.col("id")).alias("title"), (F.col("id") + 0.99).alias("price"))
    def written(path):
        return [ET.parse(f).getroot() for f in sorted(glob.glob(f"{path}/fragment=*/*.txt"))]

    assert catalogue_xml_lite(rows, f"{folder}/all", NOW, order_by="id")
    whole, = written(f"{folder}/all")
    offers = whole.findall("shop/offers/offer")
    assert [o.get("id") for o in offers] == [str(i) for i in range(3000)]
    assert offers[7].find("price").text == "7" and [e.tag for e in offers[7]] == ["name", "price"]
    assert catalogue_xml_lite(rows, f"{folder}/parts", NOW, max_offers=500)
    parts = written(f"{folder}/parts")
    assert len(parts) == 6 and {p.find("shop/name").text for p in parts} == {"Ann & Co"}
    assert sorted(int(o.get("id")) for p in parts for o in p.iter("offer")) == list(range(3000))
    assert catalogue_xml_lite(rows, f"{folder}/few", NOW, order_by="id", rows=10)
    assert [o.get("id") for o in written(f"{folder}/few")[0].iter("offer")] == [str(i) for i in range(10)]
    with pytest.raises(ValueError, match="order"):
        catalogue_lite(rows, NOW, rows=10)
    file, = glob.glob(f"{folder}/all/fragment=0/*.txt")
    assert open(file).read().startswith("<?xml version='1.0' encoding='utf-8'?>\n<yml_catalog date=\"2026")
    assert not catalogue_xml_lite(rows.limit(0), f"{folder}/none", NOW)
    assert glob.glob(f"{folder}/none*") == []


def test_listing_the_fragments_takes_few_tasks(spark, folder):
    """Not a task for each of a merchant's folders."""
    rows = spark.range(200).select(F.lit("m").alias("mercant_id"), F.col("id").alias("product_id"))
    catalogue_xml(rows, f"{folder}/x", generated_at=NOW, max_offers=1)
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, context = spark.conf.get(key), spark.sparkContext
    context.setJobGroup(folder, "listing")
    try:
        with few_listing_tasks(spark):
            lines = spark.read.option("basePath", f"{folder}/x").text(f"{folder}/x")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup(folder) for s in tracker.getJobInfo(job).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get(key) == before and lines.select("fragment").distinct().count() == 200
