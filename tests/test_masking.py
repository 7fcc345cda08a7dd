from __future__ import annotations

import hashlib

import pytest

from tillmart.functions.masking import UnknownMask, mask_columns


def masked(spark, value, kind, type_="string"):
    df = spark.createDataFrame([(value,)], f"c {type_}")
    return mask_columns(df, {"c": kind}).first()[0]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(
    "value, hashed, fixed, partial",
    [
        (None, None, "XXX", None),
        ("", digest(""), "XXX", "*****"),
        ("+6391", digest("+6391"), "XXX", "+*****"),
        (" a", digest(" a"), "XXX", " *****"),
        ("Ñandú", digest("Ñandú"), "XXX", "Ñ*****"),
    ],
)
def test_masks(spark, value, hashed, fixed, partial):
    assert masked(spark, value, "hash") == hashed
    assert masked(spark, value, "fixed") == fixed
    assert masked(spark, value, "partial") == partial


def test_numbers_are_masked_as_text(spark):
    assert masked(spark, 42, "hash", "int") == digest("42")
    assert masked(spark, 42, "partial", "int") == "4*****"


def test_fixed_mask_is_never_null(spark):
    df = mask_columns(spark.createDataFrame([(None,)], "c string"), {"c": "fixed"})
    assert not df.schema["c"].nullable


def test_case_and_missing_columns(spark):
    df = spark.createDataFrame([("a", "b")], "Name string, other string")
    out = mask_columns(df, {"name": "HASH", "absent": "hash", "gone": "no such mask"})
    assert out.columns == ["Name", "other"]
    assert tuple(out.first()) == (digest("a"), "b")


def test_unknown_mask_raises(spark):
    df = spark.createDataFrame([("a",)], "c string")
    with pytest.raises(UnknownMask):
        mask_columns(df, {"c": "scramble"})
