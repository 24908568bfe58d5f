"""Text expressions on hand-made rows; expected values are worked out by hand."""

import pytest
from pyspark.sql import functions as F

from talkweave.functions import text as T


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items()))
    return df.select(column).first()[0]


@pytest.mark.parametrize("token, label", [("қазir", "kk"), ("приvet", "mixed"), ("мир", "ru"), ("hi", "lat"), ("123", "other"), ("ë", "other")])
def test_token_language(spark, token, label):
    assert one(spark, T.token_language(F.col("t")), t=token) == label


def test_strip_knows_unicode_spaces(spark):
    assert one(spark, T.strip(F.col("t")), t="\x1c \u0085a b ") == "a b"


def test_light_enhance(spark):
    assert one(spark, T.light_enhance(F.col("t")), t="  алло   милиция  да   это  ") == "Алло милиция да это"
    assert one(spark, T.light_enhance(F.col("t")), t=" 1 a") == "1 a"
    assert one(spark, T.light_enhance(F.col("t")), t=" ") == ""


def test_switching_ratio(spark):
    assert one(spark, T.switching_ratio(F.col("t")), t=["сәлем как дела", "мен қазір приду"]) == pytest.approx(0.6)
    assert one(spark, T.switching_ratio(F.col("t")), t=["hi 1 2"]) == 0.0


def test_punctuation_density(spark):
    assert one(spark, T.punctuation_density(F.col("t")), t=["a.", "", "b!"]) == pytest.approx(0.4)
    assert one(spark, T.punctuation_density(F.col("t")), t=[""]) == 0.0


@pytest.mark.parametrize("text, label", [("да hi", "ru"), ("123", "unknown"), ("hi да hi", "lat"), ("приvet", "mixed"), ("", "unknown")])
def test_dominant_language(spark, text, label):
    assert one(spark, T.dominant_language(F.col("t")), t=text) == label


def test_code_switch(spark):
    assert one(spark, T.code_switched(F.col("t")), t="hi 1 да") is True
    assert one(spark, T.code_switched(F.col("t")), t="hi there") is False


def test_placeholders_and_pii(spark):
    assert one(spark, T.placeholder_counts(F.col("t")), t="[ИМЯ] [ИМЯ] [EMAIL]") == {"NAME": 2, "EMAIL": 1}
    for text, found in (("+7 (701) 123-45-67", True), ("a@b.org", True), ("12345678", True), ("ж12345678", False), ("12 a", False)):
        assert one(spark, T.pii_candidate(F.col("t")), t=text) is found, text


def test_payload_round_trip(spark):
    texts = ["a\nb", "x </SEG> & <y>", ""]
    payload = one(spark, T.seg_payload(F.col("t")), t=texts)
    assert one(spark, T.seg_parse(F.col("t"), F.lit(3)), t=payload) == ["a b", "x </SEG> & <y>", ""]
    assert one(spark, T.seg_parse(F.col("t"), F.lit(2)), t='<SEG id="0">a</SEG>') == []
    assert one(spark, T.seg_parse(F.col("t"), F.lit(2)), t="<seg id='1'>b</SEG><SEG id=0>c</SEG><SEG id='1'>d</SEG>") == ["c", "d"]


def test_drift(spark):
    assert one(spark, T.drifted(F.col("a"), F.col("b")), a="ну нашу курят", b="ну нашу крадут") is True
    assert one(spark, T.drifted(F.col("a"), F.col("b")), a="Ну, нашу курят!", b="ну нашу курят") is False
