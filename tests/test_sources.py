from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from bibweave.functions import marc as mc
from bibweave.sources import dump as dp
from bibweave.sources import marc as ms
from bibweave.sources.profiles import read_profiles

LINE = '{"leader":"00000nam a2200000 a 4500","fields":[{"001":"ocm\\"1"},{"245":{"ind1":"1","ind2":" ","subfields":[{"a":"Téxt  one "},{"b":"two"}]}}]}'
FIELDS = [
    {"tag": "001", "ind1": None, "ind2": None, "value": 'ocm"1', "subfields": None},
    {"tag": "245", "ind1": "1", "ind2": " ", "value": None, "subfields": [{"code": "a", "value": "Téxt  one "}, {"code": "b", "value": "two"}]},
]


def fields(row):
    return [f.asDict(recursive=True) for f in row["fields"]]


def test_json_lines(spark, tmp_path):
    with gzip.open(tmp_path / "a.ndj.gz", "wt") as f:
        f.write("a banner\n" + LINE + "\n")
    df = ms.read_json(spark, str(tmp_path / "a.ndj.gz"))
    assert [fields(r) for r in df.collect()] == [FIELDS]
    again = df.select(ms.parse_json(ms.to_json()).alias("r")).select("r.*")
    assert [fields(r) for r in again.collect()] == [FIELDS]
    assert df.select(F.array_join(mc.values_of("245"), "|").alias("v")).first()["v"] == "Téxt one|two"
    assert df.select(ms.to_hash().alias("h")).first()["h"].endswith('["001","ocm\\"1"],["245","1"," ",[["a","Téxt  one "],["b","two"]]]]}')


def test_binary_round_trip(spark, tmp_path):
    raw = ms.encode_record("00000nam a2200000 a 4500", FIELDS)
    assert int(raw[:5]) == len(raw) and ms.decode_record(raw)["fields"] == FIELDS
    (tmp_path / "x.dat").write_bytes(raw * 3)
    for forgiving in (False, True):
        got = ms.read_binary(spark, str(tmp_path / "x.dat"), forgiving).collect()
        assert [fields(r) for r in got] == [FIELDS] * 3
    (tmp_path / "y.dat").write_bytes(raw + b"junkjunk\x1d" + raw)
    got = ms.read_binary(spark, str(tmp_path / "y.dat"), forgiving=True).collect()
    assert [r["corrupt"] is None for r in got] == [True, False, True]
    with pytest.raises(ValueError):
        ms.encode_record("", [{**FIELDS[0], "value": "x" * 10_000}])
    assert ms.encode_record("", [{**FIELDS[0], "value": "x" * 100_000}], allow_oversized=True)[:5] == b"00000"


def test_xml_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("00000nam  2200000 a 4xyz", FIELDS)], mc.RECORD)
    ms.write_xml(df, str(tmp_path / "x"))
    got = ms.read_xml(spark, str(tmp_path / "x")).collect()
    assert [fields(r) for r in got] == [FIELDS] and got[0]["leader"] == "00000nam  2200000 a 4500"


def test_sequential(spark, tmp_path):
    (tmp_path / "s").write_text("000000001 LDR   L 00000nam\n000000001 001   L 12\n000000001 24510 L $$aOne$$bTwo\n000000002 001   L 13\n")
    got = {r["number"]: r for r in ms.read_sequential(spark, str(tmp_path / "s")).collect()}
    assert got["000000001"]["leader"] == "00000nam" and [f["tag"] for f in got["000000001"]["fields"]] == ["001", "245"]
    assert [s["value"] for s in got["000000001"]["fields"][1]["subfields"]] == ["One", "Two"]


def test_profiles(spark, tmp_path):
    (tmp_path / "p1.tsv").write_text("001\trecord_id\n974z\titem_id\n974z\tenumc\n# no line\n955v\tenumc # note\n")
    got = {(r["profile"], r["spec"]): r["label"] for r in read_profiles(spark, str(tmp_path)).collect()}
    assert got == {("p1", "001"): "record_id", ("p1", "974z"): "enumc", ("p1", "955v"): "enumc # note"}


def test_dump_and_files(spark, tmp_path):
    cols = ["h1", "", "", "r1", "v.1", "", "", "1,2", "", "", "", 'a "quoted" title', "GPO", "", "", "1", "1990"]
    (tmp_path / "d").write_text("\t".join(cols) + "\n")
    row = dp.government_documents(dp.read_dump(spark, str(tmp_path / "d"))).first()
    assert (row["htid"], row["title"], row["pubdate"]) == ("h1", 'a "quoted" title', "1990")
    lines = spark.createDataFrame([("duplicates", 0.5, [1, 2]), ("related", None, [3])], "relation string, score double, ids array<bigint>")
    dp.write_relations(lines, str(tmp_path / "r"))
    assert sorted(map(tuple, dp.read_relations(spark, str(tmp_path / "r")).collect())) == [("duplicates", 0.5, [1, 2]), ("related", None, [3])]
    (tmp_path / "p").write_text("1\t2\t0.9\twords\n1\t3\t-0.2\n")
    assert [tuple(r) for r in dp.read_pairs(spark, str(tmp_path / "p")).collect()] == [(1, 2, 0.9)]


def test_008(spark):
    f = "890123s1990    xxu          f    eng  "
    df = spark.createDataFrame([([f],), ([f, f],), ([],), (["890123suuuu"],)], "v array<string>")
    one = mc.single_008(F.col("v"))
    got = [(r["ok"], r["d"]) for r in df.select(F.coalesce(mc.is_us_federal(one), F.lit(False)).alias("ok"), mc.publication_date(one).alias("d")).collect()]
    assert got == [(True, "1990"), (False, None), (False, None), (False, None)]


def test_streaming_ingest(spark, tmp_path):
    from bibweave.streaming.ingest import new_lines

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a").write_text('{"a":"1","n":1}\nbanner\n{"a":"1","n":2}\n{"a":"2","n":3}\n')
    q = new_lines(spark, str(tmp_path / "in"), "a string, n int", ["a"]).select("a").writeStream.format("memory").queryName("ingested").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["a"] for r in spark.table("ingested").collect()) == ["1", "2"]


def test_newest_file_is_fetched(spark, tmp_path):
    (tmp_path / "there").mkdir()
    (tmp_path / "here").mkdir()
    for day in ("20140101", "20140801"):
        with gzip.open(tmp_path / "there" / f"full_{day}.txt.gz", "wb") as f:
            f.write(f"a\t{day}\n".encode())
    links = "".join(f'<a href="file://{tmp_path}/there/full_{d}.txt.gz">x</a>' for d in ("20140801", "20140101"))
    pages = spark.createDataFrame([(links + '<a href="file:///other.txt.gz">y</a>',)], "body string")
    for name, day in (("", "20140801"), ("20140101", "20140101")):
        path = dp.fetch_newest(pages, str(tmp_path / "here"), name)
        assert open(path).read() == f"a\t{day}\n"
    with pytest.raises(FileNotFoundError):
        dp.fetch_newest(pages, str(tmp_path / "here"), "1999")


def test_bad_text_is_mended_or_refused(spark):
    raw = spark.createDataFrame([(bytearray(b"ok \xc3\xa9"),), (bytearray(b"bad \xff."),)], "raw binary")
    assert [r[0] for r in raw.select(ms.valid_text(F.col("raw"))).collect()] == ["ok é", "bad \ufffd."]
    with pytest.raises(Exception, match="INVALID_UTF8"):
        raw.select(ms.checked_text(F.col("raw"))).collect()


def test_a_rare_agency_with_one_trigger_phrase_goes(spark):
    from bibweave.operators.agencies import agency_map

    rows = [(["A 1.2"], ["White House of it"]), (["A 1.2"], ["Naval Air of it"])]
    got = agency_map(spark.createDataFrame(rows, "sudoc array<string>, agency array<string>"), ("NASA",)).collect()
    assert [(r["sudoc_stem"], r["agency"]) for r in got] == [("A 1", "NAVAL AIR OF IT")]


def test_sequential_values_of_any_length(spark, tmp_path):
    long = "x" * 2_000_000
    (tmp_path / "s").write_text(f"000000001 LDR   L 00000nam\n000000001 001   L {long}\n000000001 24510 L $$a{long}$$bend\n")
    (r,) = ms.read_sequential(spark, str(tmp_path / "s")).collect()
    control, title = r["fields"]
    assert control["value"] == long and [(x["code"], x["value"]) for x in title["subfields"]] == [("a", long), ("b", "end")]


def test_fragments_are_kept_with_a_reason(spark, tmp_path):
    (tmp_path / "x.dat").write_bytes(b"ab\x1d\r\n\x1d00026     2200026   4500 no directory\x1d1\x1d \n")
    got = ms.read_binary(spark, str(tmp_path / "x.dat"), forgiving=True).collect()
    assert len(got) == 3 and all(r["corrupt"] and r["fields"] is None for r in got)


def test_collection_of_one_file_opens_no_other(spark, tmp_path):
    lines = [('{"source":' + LINE + "}", f"file {i}/x") for i in range(3)]
    ms.write_collection(spark.createDataFrame(lines, "value string, file_path string"), str(tmp_path / "c"))
    for folder in (tmp_path / "c").glob("file_path=*"):
        if "1" not in folder.name:
            for f in folder.glob("*.gz"):
                f.write_bytes(b"no gzip")  # reading it would fail
    read = ms.read_collection(spark, str(tmp_path / "c"), "file 1/x")
    assert "PartitionFilters: [isnotnull(file_path" in read._jdf.queryExecution().toString()
    assert [r["file_path"] for r in read.collect()] == ["file 1/x"]
    (tmp_path / "d").write_text("\n".join(json.dumps({"file_path": p, "source": json.loads(LINE)}) for p in ("a", "b", "b")))
    assert ms.read_collection(spark, str(tmp_path / "d"), "b").count() == 2 and ms.read_collection(spark, str(tmp_path / "d")).count() == 3


def _record(n: int, note: str = "a note") -> bytes:
    return ms.encode_record("00000nam a2200000 a 4500", [{"tag": "001", "ind1": None, "ind2": None, "value": str(n), "subfields": None}, {"tag": "500", "ind1": "1", "ind2": " ", "value": None, "subfields": [{"code": "a", "value": note}]}])


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _notes(df):
    return sorted((int(r["fields"][0]["value"]), r["fields"][1]["subfields"][0]["value"]) for r in df.collect())


@pytest.mark.parametrize("between", [b"", b"\n"])
def test_a_strict_file_is_read_by_many_tasks(spark, tmp_path, small_splits, between):
    (tmp_path / "x.dat").write_bytes(b"".join(_record(n) + between for n in range(300)))
    read = ms.read_binary(spark, str(tmp_path / "x.dat"))
    assert _notes(read) == [(n, "a note") for n in range(300)]
    tasks = read.where("fields is not null").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 5


def test_strict_lengths_hold_over_marks_within_records(spark, tmp_path, small_splits):
    note = "a\x1db" + "x" * 700  # the record goes on after the mark, into another split
    (tmp_path / "odd.dat").write_bytes(b"".join(_record(n, note if n % 3 == 0 else "plain") for n in range(60)) + b"\r\n")
    (tmp_path / "plain.dat").write_bytes(b"".join(_record(n, "plain") for n in range(60, 120)))
    (tmp_path / "cut.dat").write_bytes(_record(120, "plain")[:-1])  # no end mark
    assert _notes(ms.read_binary(spark, str(tmp_path))) == [(n, note if n < 60 and n % 3 == 0 else "plain") for n in range(121)]


@pytest.mark.parametrize("bad", [b"00000" + _record(2)[5:], b"junk\x1d", b"\x1d"])
def test_strict_reader_raises_on_a_bad_length(spark, tmp_path, bad):
    (tmp_path / "x.dat").write_bytes(_record(1) + bad + _record(3))
    with pytest.raises(Exception, match="ValueError"):
        ms.read_binary(spark, str(tmp_path / "x.dat")).collect()


def test_an_xml_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    one = '<record><leader>L</leader>\n <controlfield tag="001">{}</controlfield><datafield tag="500" ind1="1" ind2=" "><subfield code="a"> {}</subfield></datafield></record>\n'
    head, end = '<?xml version="1.0"?><!-- <about> --><collection xmlns="x">\n', "</collection>\n"
    notes = ["a &amp; b", "c"]
    (tmp_path / "plain.xml").write_text(head + "".join(one.format(n, notes[n % 2]) for n in range(100)) + end)
    (tmp_path / "odd one.xml").write_text(head + "".join(one.format(n, "<![CDATA[</record>]]>" if n == 150 else "c") for n in range(100, 200)) + end)
    read = ms.read_xml(spark, str(tmp_path))
    assert _notes(read) == [(n, " a & b" if n < 100 and n % 2 == 0 else " </record>" if n == 150 else " c") for n in range(200)]
    tasks = ms.read_xml(spark, str(tmp_path / "plain.xml")).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 5


def test_rows_of_a_small_file_are_many_tasks(spark, monkeypatch):
    from bibweave.plans import spread as sp
    from bibweave.queries import Source
    from bibweave.queries_marc import marc_lines
    from tests.conftest import DATA

    dealt = sp.spread(spark.range(1000).coalesce(1), "id", rows=100)
    assert dealt.rdd.getNumPartitions() == 10 and dealt.distinct().count() == 1000
    monkeypatch.setattr(sp.spread, "__kwdefaults__", {"rows": 40})
    assert marc_lines(Source(spark, DATA)).rdd.getNumPartitions() > 4
