"""The registered payload parsing reads every row of its table."""

from pyspark.sql import functions as F

from talkweave.plans import queries as plans


def test_conversations_are_parsed(spark, tmp_path):
    rows = [(0, 0, 'x <SEG id="0">one</SEG><SEG id="1"> two </SEG>'), (0, 1, "plain"), (7, 2, None)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string").withColumn("role", F.lit("user")).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.text_id: r.texts for r in plans.seg_parse(spark, str(tmp_path)).collect()}
    assert len(got) == len(plans.GIVEN) + 3 and (got[1000], got[1001], got[8002]) == ("one|two", "", "")


def test_ids_of_any_length(spark):
    from talkweave.functions import text as T

    rows = [('<SEG id="99999999999999999999">x</SEG><SEG id="0">a</SEG>', "a"), ('<SEG id="4294967296">x</SEG><SEG id="0">a</SEG><seg id=0>b</seg>', "b"), ('<SEG id="1">b</SEG>', "")]
    df = spark.createDataFrame(rows, "p string, expect string").withColumn("got", F.array_join(T.seg_parse(F.col("p"), F.lit(1)), "|"))
    assert all(r.got == r.expect for r in df.collect())
