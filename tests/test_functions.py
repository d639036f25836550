import hashlib

from pyspark.sql import functions as F

from idloom.functions.keys import email_key, md5_key, surrogate_key


def md5(s: str) -> str:
    return hashlib.md5(s.encode()).hexdigest()


def test_md5_key_coalesces_null_parts(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], "x string, y string, z string")
    got = [r[0] for r in df.select(md5_key("x", "y", "z")).collect()]
    assert got == [md5("a||c"), md5("||")]


def test_md5_key_separator_prevents_collisions(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    a, b = [r[0] for r in df.select(md5_key("x", "y")).collect()]
    assert a != b


def test_surrogate_key(spark):
    df = spark.createDataFrame([("42", "h"), (None, "h")], "id string, handle string")
    got = [r[0] for r in df.select(surrogate_key("id", "handle")).collect()]
    assert got == ["42", "h_" + md5("h")]


def test_email_key_styles(spark):
    df = spark.createDataFrame([("1", "a@b")], "tiktok_id string, email string")
    r = df.select(email_key("tiktok_id", "email").alias("m"),
                  email_key("tiktok_id", "email", "int64").alias("i")).collect()[0]
    assert r.m == md5("1|a@b")
    assert r.i.isdigit() and int(r.i) < 2 ** 63 + 1


def test_least_non_null(spark):
    from idloom.functions.text import least_non_null
    df = spark.createDataFrame([(1, None), (None, None), (3, 2)], "a int, b int")
    assert [r[0] for r in df.select(least_non_null("a", "b")).collect()] == [1, None, 2]
