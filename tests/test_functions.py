from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bibweave.functions import text as tx
from bibweave.functions.marc8 import to_unicode
from bibweave.operators.lookup import parse_query


def values(spark, inputs, f):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_publishers(spark):
    given = ["U.S. GOVT. PRINT. OFF.", "GPO", "UNITED STATES. DEPARTMENT OF THE INTERIOR", "[THE] BUREAU OF THE CENSUS", "DEPTOF STATE", "FOR SALE BY THE SUPT. OF DOCS., U.S. G.P.O.", None]
    assert values(spark, given, tx.normalize_publisher) == ["USGPO", "USGPO", "US DEPT OF INTERIOR", "BUREAU OF CENSUS", "DEPT OF STATE", "", ""]


def test_sudoc_stems(spark):
    assert values(spark, ["A 13.2:F 76", "c 3.5", "y-3.1", "123.4", ".5", None], tx.stem_sudoc) == ["A 13", "C 3", None, None, None, None]
    assert values(spark, ["Y4", "Y 4", "y4"], tx.space_sudoc) == ["Y 4", "Y 4", "y4"]


def test_unicode_fold(spark):
    assert values(spark, ["École—Straße, №5!", None, ""], tx.unicode_fold) == ["ecole strasse  no5 ", None, ""]


def test_lenient_int(spark):
    assert values(spark, ["12abc", "abc", "", None, "7"], tx.lenient_int) == [12, 0, 0, None, 7]


def test_replace_first(spark):
    assert values(spark, ["aXbXc", "none"], lambda c: tx.replace_first(c, "X", "-")) == ["a-bXc", "none"]


@pytest.mark.parametrize(
    "raw, text",
    [(b"caf\xe2e", "café"), (b"\xa1\xb1", "Łł"), (b"x\x1bp2\x1bs", "x²"), (b"&#x4E00;", "一"), (b"\x1b(Nabc\x1b(Bd", "АБЦd"), (b"\x1b(Qabc\x1b(Bd", "���d"), (b"", "")],
)
def test_marc8(raw, text):
    assert to_unicode(raw) == text


def test_parse_query():
    assert parse_query("oclc=1=2\n!title\n;\nlccn=3") == ([("oclc", "1=2")], ["title"])
    with pytest.raises(ValueError):
        parse_query("colour=red")
