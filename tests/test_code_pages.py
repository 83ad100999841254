import pytest
from pyspark.sql import functions as F

from tidewater.functions.code_pages import decode_bytes, encode_text


@pytest.mark.parametrize("charset", ["cp1252", "cp1250", "latin-1", "cp437"])
def test_every_byte(spark, charset):
    df = spark.createDataFrame([(b, bytearray([65, b])) for b in range(256)], "n int, v binary")
    got = dict(df.select("n", decode_bytes("v", charset)).collect())
    def want(b):
        try:
            return bytes([65, b]).decode(charset)
        except UnicodeDecodeError:
            return None
    assert got == {b: want(b) for b in range(256)}
    back = df.select("v", encode_text(decode_bytes("v", charset), charset).alias("w")).where("w IS NOT NULL")
    assert all(r.v == r.w for r in back.collect())
    assert back.count() == sum(want(b) is not None for b in range(256))


def test_unknown_characters_nulls_and_wide_code_pages(spark):
    df = spark.createDataFrame([("日本",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(encode_text("t", "cp1252")).collect()] == [None, b"", None]
    assert spark.range(1).select(decode_bytes(F.lit(None).cast("binary"), "cp1252")).first()[0] is None
    with pytest.raises(ValueError):
        decode_bytes("t", "utf-8")
