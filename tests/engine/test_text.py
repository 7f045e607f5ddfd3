from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx


@pytest.mark.parametrize(("text", "key"), [("C++", "c++"), (" .NET Core ", ".net core"), ("front‐end", "front-end"), ("Straße", "strasse"), ("CI/CD", "ci/cd"), ("it’s “x”", 'it\'s "x"'), ("ﬁsh", "fish"), ("", "")])
def test_label_keys(spark, text, key):
    assert tx.label_key_of(text) == key
    df = spark.createDataFrame([(text,), (None,)], "t string")
    assert [r[0] for r in df.select(tx.label_key(F.col("t"))).collect()] == [key, None]
    if key not in ("strasse", "fish"):
        assert df.select(tx.ascii_key(F.col("t"))).first()[0] == key


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) if not isinstance(v, list) else F.array(*map(F.lit, v)).alias(k) for k, v in values.items()])
    return df.select(column).first()[0]


def test_cleaning(spark):
    assert one(spark, tx.clean_optional(F.col("t")), t="  a \n b\t") == "a \n b" and one(spark, tx.clean_optional(F.col("t")), t="   ") is None
    assert one(spark, tx.split_labels(F.col("t")), t=" a \r\n\n b\n ") == ["a", "b"]
    assert one(spark, tx.clean_text(F.col("t")), t="<p>a&amp;b</p>\n <i>c</i>") == "a&amp;b c" and one(spark, tx.clean_text(F.col("t")), t="<br>") is None
    assert one(spark, tx.clean_strings(F.col("t")), t=["<b>x</b>", " ", "y"]) == ["x", "y"]
    assert one(spark, tx.consecutive_distinct(F.col("t")), t=[1, 1, 2, 1]) == [1, 2, 1]
    uri = "https://x.org/occupation/ABCDEF00-0000-4000-8000-000000000001"
    assert one(spark, tx.id_of_uri(F.col("t")), t=uri) == "abcdef00-0000-4000-8000-000000000001" and one(spark, tx.id_of_uri(F.col("t")), t=uri + "x") is None


def test_ids_keep_special_ends(spark):
    cut = lambda ids, n: one(spark, tx.truncate_ids(F.col("t"), F.array(F.lit(0)), n), t=ids)
    assert cut([1, 2, 3, 4, 5, 0], 4) == [1, 2, 3, 0] and cut([1, 0, 0, 0], 2) == [0, 0] and cut([1, 0], 4) == [1, 0]


def test_hash_and_hint(spark):
    df = spark.createDataFrame([("a", None)], "y string, x string")
    import hashlib

    assert df.select(tx.content_hash("y", "x")).first()[0] == hashlib.sha256(b'{"x":null,"y":"a"}').hexdigest()
    assert [one(spark, tx.lang_hint(F.col("t"), "ạé"), t=t) for t in ("abc", "abạ", "a" * 20 + "é", "12")] == ["en", "vi", "mixed", "empty"]
