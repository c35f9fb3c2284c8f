"""Readers and writers of MARC records: JSON lines, XML, ISO 2709 and sequential text.

All give ``leader`` and ``fields``: structs of tag, indicators, a control value or subfields.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bibweave.functions.marc import FIELD, RECORD, SUBFIELDS
from bibweave.functions.marc8 import to_unicode

# The layout of ISO 2709.
LEADER, ENTRY, MOST = 24, 12, 99_999
SUB, FIELD_END, RECORD_END = b"\x1f", b"\x1e", b"\x1d"

_XML = (
    "leader string, controlfield array<struct<_tag:string,_VALUE:string>>, "
    "datafield array<struct<_tag:string,_ind1:string,_ind2:string,subfield:array<struct<_code:string,_VALUE:string>>>>"
)


def is_control(tag: Column) -> Column:
    return tag.rlike("^00.$")


def parse_json(line: Column) -> Column:
    """A struct ``leader, fields`` of a line of MARC in JSON; null if the line is no JSON object."""
    raw = F.from_json(line, "leader string, fields array<map<string,string>>")

    def field(f):
        subs = F.transform(f["data"]["subfields"], lambda s: F.struct(F.get(F.map_keys(s), F.lit(0)).alias("code"), F.get(F.map_values(s), F.lit(0)).alias("value")))
        plain = ~f["value"].startswith("{")
        return F.struct(
            F.lpad(f["tag"], 3, "0").alias("tag"), F.when(~plain, F.coalesce(f["data"]["ind1"], F.lit(" "))).alias("ind1"), F.when(~plain, F.coalesce(f["data"]["ind2"], F.lit(" "))).alias("ind2"),
            F.when(plain, f["value"]).alias("value"), F.when(~plain, subs).alias("subfields"),
        )

    # in steps, so that a line, and a field's value, is parsed once and not for each of its parts
    data = lambda v: F.when(v.startswith("{"), F.from_json(v, "ind1 string, ind2 string, subfields array<map<string,string>>"))

    def record(r):
        named = F.transform(r["fields"], lambda m: F.struct(F.get(F.map_keys(m), F.lit(0)).alias("tag"), F.get(F.map_values(m), F.lit(0)).alias("value")))
        read = F.transform(named, lambda f: F.struct(f["tag"].alias("tag"), f["value"].alias("value"), data(f["value"]).alias("data")))
        return F.struct(r["leader"].alias("leader"), F.transform(read, field).alias("fields"))

    return F.when(line.startswith("{"), F.get(F.transform(F.array(raw), record), F.lit(0)))


def parsed(line: Column) -> Column:
    """``leader, fields`` of a line of MARC in JSON as columns to select; a line that is none gives no row.

    Conditions on a generated row are not moved ahead of it, where they would parse the line once more for every time they name it.
    """
    return F.inline(F.array_compact(F.array(parse_json(line))))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Records of JSON lines, compressed or not, with ``infile``; other lines are left out."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("infile"), parsed(F.col("value")))


def write_collection(lines: DataFrame, path: str, compression: str = "gzip") -> None:
    """JSON lines (``value``: a record under ``source``) in a folder for each ``file_path``, which readers of one file need only open."""
    lines.select("value", "file_path").write.partitionBy("file_path").option("compression", compression).text(path)


def read_collection(spark: SparkSession, path: str, file_path: str | None = None) -> DataFrame:
    """Records of an exported collection: JSON lines with ``file_path`` and ``source`` (a record), of one file if it is named.

    Of a collection kept by :func:`write_collection` only the named file's folder is read. In any other the path stands in the lines, so
    all lines are read, but records of other files are not parsed.
    """
    lines = spark.read.text(path)
    if "file_path" in lines.columns:
        lines = spark.read.schema("value string, file_path string").text(path)
    else:
        lines = lines.withColumn("file_path", F.get_json_object("value", "$.file_path"))
    if file_path is not None:
        lines = lines.where(F.col("file_path") == file_path)
    return lines.select("file_path", parsed(F.get_json_object("value", "$.source")))


def to_json(leader="leader", fields="fields") -> Column:
    """A record as a line of MARC in JSON."""

    def field(f):
        subs = F.transform(f["subfields"], lambda s: F.create_map(s["code"], s["value"]))
        data = F.struct(f["ind1"].alias("ind1"), f["ind2"].alias("ind2"), subs.alias("subfields"))
        named = lambda v: F.to_json(F.create_map(F.coalesce(f["tag"], F.lit("")), v))
        return F.when(f["value"].isNotNull(), named(f["value"])).otherwise(named(data))

    return F.concat(F.lit('{"leader":'), _quoted(F.col(leader)), F.lit(',"fields":['), F.array_join(F.transform(fields, field), ","), F.lit("]}"))


def _quoted(s: Column) -> Column:
    return F.regexp_replace(F.to_json(F.struct(F.coalesce(s, F.lit("")).alias("x"))), r'^\{"x":|\}$', "")  # of {"x":"..."}


def to_hash(leader="leader", fields="fields") -> Column:
    """A record as positional arrays in JSON: ``[tag, value]`` and ``[tag, ind1, ind2, [[code, value]...]]``."""

    def field(f):
        subs = F.array_join(F.transform(f["subfields"], lambda s: F.concat(F.lit("["), _quoted(s["code"]), F.lit(","), _quoted(s["value"]), F.lit("]"))), ",")
        data = F.concat(_quoted(f["tag"]), F.lit(","), _quoted(f["ind1"]), F.lit(","), _quoted(f["ind2"]), F.lit(",["), subs, F.lit("]"))
        plain = F.concat(_quoted(f["tag"]), F.lit(","), _quoted(f["value"]))
        return F.concat(F.lit("["), F.when(f["value"].isNotNull(), plain).otherwise(data), F.lit("]"))

    head = F.lit('{"type":"marc-hash","version":[1,0],"leader":')
    return F.concat(head, _quoted(F.col(leader)), F.lit(',"fields":['), F.array_join(F.transform(fields, field), ","), F.lit("]}"))


def _pieces(spark: SparkSession, path: str, mark: str) -> DataFrame:
    """What stands between marks in some files, in order: ``infile, block, at, size`` (of the file) and ``value``. Large files are split."""
    rows = spark.read.option("lineSep", mark).text(path)
    told = [F.col(f"_metadata.{c}").alias(k) for c, k in (("file_path", "infile"), ("file_block_start", "block"), ("file_size", "size"))]
    return rows.select(*told, F.monotonically_increasing_id().alias("at"), "value")


def _ends(pieces: DataFrame, mark: str, **columns: Column) -> DataFrame:
    """``infile`` with aggregates of its pieces, and ``closed``: whether a mark ends it."""
    whole = F.sum(F.octet_length("value") + len(mark)) == F.max("size")
    return pieces.groupBy("infile").agg(*(c.alias(k) for k, c in columns.items()), whole.alias("closed"))


def read_xml(spark: SparkSession, path: str, row_tag: str = "record") -> DataFrame:
    """Records of MARCXML files; name-space prefixes do not matter beyond ``row_tag``. Control fields come first.

    Files are split at the ends of records. One in which an end can stand within a comment or CDATA, or where a
    record is cut off, holds none or is empty, is read by one task from its beginning.
    """
    mark, options = f"</{row_tag}>", {"ignoreSurroundingSpaces": "false"}
    pieces = _pieces(spark, path, mark)
    count = lambda part: F.size(F.split("value", part))
    starts = count(rf"<{row_tag}[\s/>]") - 1
    open_ = (count("<!--") != count("-->")) | (count(r"<!\[CDATA\[") != count(r"\]\]>"))
    files = _ends(pieces, mark, mixed=F.bool_or((starts > 1) | open_), cut=F.max_by(starts > 0, F.struct("block", "at")), holes=F.count_if(starts == 0))
    # what follows the last record holds none
    odd = [r["infile"] for r in files.where("mixed or (cut and not closed) or holes > if(cut, 0, 1)").select("infile").collect()]  # names of files
    body = F.concat(F.regexp_extract("value", rf"(?s)<{row_tag}[\s>].*", 0), F.lit(mark))
    some = pieces.where(~F.col("infile").isin(odd)) if odd else pieces
    raw = some.where(starts > 0).select(F.from_xml(body, _XML, options).alias("r")).select("r.*")
    if odd:
        whole = spark.read.format("xml").option("rowTag", row_tag).options(**options).schema(_XML).load([unquote(x) for x in odd])
        raw = raw.unionByName(whole)
    none = F.array().cast(f"array<{FIELD}>")
    control = F.transform("controlfield", lambda c: F.struct(c["_tag"].alias("tag"), F.lit(None).cast("string").alias("ind1"), F.lit(None).cast("string").alias("ind2"), c["_VALUE"].alias("value"), F.lit(None).cast(SUBFIELDS).alias("subfields")))

    def data(d):
        subs = F.transform(d["subfield"], lambda s: F.struct(s["_code"].alias("code"), F.coalesce(s["_VALUE"], F.lit("")).alias("value")))
        return F.struct(d["_tag"].alias("tag"), F.coalesce(d["_ind1"], F.lit(" ")).alias("ind1"), F.coalesce(d["_ind2"], F.lit(" ")).alias("ind2"), F.lit(None).cast("string").alias("value"), subs.alias("subfields"))

    return raw.select("leader", F.concat(F.coalesce(control, none), F.coalesce(F.transform("datafield", data), none)).cast(f"array<{FIELD}>").alias("fields"))


def clean_leader(leader: Column) -> Column:
    """A leader as MARCXML allows it: other characters become Z, the end is 4500, a blank type of record is Z."""
    s = F.regexp_replace(F.rpad(leader, LEADER, " "), r"[^\w| ]", "Z")
    s = F.concat(F.substring(s, 1, 20), F.lit("4500"))
    return F.when(F.substring(s, 7, 1) == " ", F.overlay(s, F.lit("Z"), 7)).otherwise(s)


def write_xml(records: DataFrame, path: str) -> None:
    """MARCXML files; bad indicators become z, bad subfield codes a space."""
    good = lambda c, pattern, to: F.when(c.rlike(pattern), c).otherwise(F.lit(to))
    control = F.transform(F.filter("fields", lambda f: f["value"].isNotNull()), lambda f: F.struct(f["tag"].alias("_tag"), f["value"].alias("_VALUE")))

    def data(f):
        subs = F.transform(f["subfields"], lambda s: F.struct(good(s["code"], r"^[\dA-Za-z!\"#$%&'()*+,\-./:;<=>?{}_^`~\[\]\\]$", " ").alias("_code"), s["value"].alias("_VALUE")))
        return F.struct(f["tag"].alias("_tag"), good(f["ind1"], r"^[\da-z ]$", "z").alias("_ind1"), good(f["ind2"], r"^[\da-z ]$", "z").alias("_ind2"), subs.alias("subfield"))

    out = records.select(clean_leader(F.col("leader")).alias("leader"), control.alias("controlfield"), F.transform(F.filter("fields", lambda f: f["value"].isNull()), data).alias("datafield"))
    out.write.format("xml").option("rootTag", "collection").option("rowTag", "record").save(path)


def _decoder(charset: str):
    if charset == "marc8":
        return to_unicode
    return lambda b: b.decode(charset, errors="replace")


def _field(tag: str, raw: bytes, decode) -> dict | None:
    if tag[:2] == "00":
        return {"tag": tag, "ind1": None, "ind2": None, "value": decode(raw), "subfields": None}
    parts = raw.split(SUB)
    if len(parts) < 2:
        return None
    marks = parts[0].decode("latin-1").ljust(2)
    subs = [{"code": p[:1].decode("latin-1"), "value": decode(p[1:])} for p in parts[1:] if p]
    return {"tag": tag, "ind1": marks[0], "ind2": marks[1], "value": None, "subfields": subs}


def decode_record(raw: bytes, forgiving: bool = False, charset: str = "utf-8") -> dict:
    """One ISO 2709 record. The strict way trusts the directory's offsets and raises on a bad length; the
    forgiving one takes fields in the order of the directory from between their end marks."""
    decode = _decoder(charset)
    base = int(raw[12:17])
    entries = raw[LEADER : raw.index(FIELD_END, LEADER)]
    if not forgiving and (not raw[:5].isdigit() or int(raw[:5]) == 0):
        raise ValueError("a record length of zero")
    pieces = raw[base:].split(FIELD_END)
    fields = []
    for k in range(len(entries) // ENTRY):
        e = entries[k * ENTRY : (k + 1) * ENTRY]
        if forgiving:
            body = pieces[k] if k < len(pieces) else b""
        else:
            lo = base + int(e[7:12])
            body = raw[lo : lo + int(e[3:7])]
        field = _field(e[:3].decode("latin-1"), body.rstrip(FIELD_END), decode)
        if field is not None:
            fields.append(field)
    return {"leader": raw[:LEADER].decode("latin-1"), "fields": fields}


def split_records(data: bytes, forgiving: bool = False) -> Iterator[bytes]:
    """Records of a file, by their length prefix or, forgiving, by their end mark."""
    if forgiving:
        yield from (p + RECORD_END for p in data.split(RECORD_END) if p.strip())
        return
    at = 0
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        size = int(data[at : at + 5])
        if size == 0:
            raise ValueError("a record length of zero")
        yield data[at : at + size]
        at += size


_READ = pa.schema([
    ("infile", pa.string()), ("leader", pa.string()),
    ("fields", pa.list_(pa.struct([("tag", pa.string()), ("ind1", pa.string()), ("ind2", pa.string()), ("value", pa.string()), ("subfields", pa.list_(pa.struct([("code", pa.string()), ("value", pa.string())])))]))),
    ("corrupt", pa.string()),
])
#: Records that are decoded or encoded at a time.
RECORDS_A_BATCH = 500


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, RECORDS_A_BATCH)):
        yield pa.RecordBatch.from_pylist(some, schema)


def walk_records(pieces: Iterator[tuple[str, int, bytes]]) -> Iterator[tuple[str, bytes]]:
    """``infile, record`` from the pieces between end marks (``infile, size, raw``) of whole files in order, by length prefixes as in :func:`split_records`.

    No more than a record and a piece are held.
    """
    for name, some in groupby(pieces, key=lambda p: p[0]):
        data, seen, held = b"", 0, None
        for _, size, raw in some:
            if held is not None:
                data += held + RECORD_END
            held, seen = raw, seen + len(raw) + 1
            at = 0
            while True:
                while data[at : at + 1] in (b"\n", b"\r"):
                    at += 1
                if len(data) - at < 5:
                    break
                length = int(data[at : at + 5])
                if length <= 0:
                    raise ValueError("a record length of zero")
                if len(data) - at < length:
                    break
                yield name, data[at : at + length]
                at += length
            data = data[at:]
        for record in split_records(data + held + (RECORD_END if seen == size else b"")):
            yield name, record


def read_binary(spark: SparkSession, path: str, forgiving: bool = False, charset: str = "utf-8") -> DataFrame:
    """Records of ISO 2709 files, with ``infile`` and ``corrupt`` (why a record was not read, else null).

    Files are split at the record mark. For the forgiving reader, whatever stands between two marks is a record, however short;
    only blank stretches are none. For the strict one length prefixes tell where records begin: where each of a file
    is that of the piece it stands in, the pieces are the records; a file with any other is walked from its beginning by one task, piece by piece.
    """
    schema = f"infile string, {RECORD}, corrupt string"

    def one(name, raw):
        try:
            return {"infile": name, **decode_record(raw, forgiving, charset), "corrupt": None}
        except (ValueError, IndexError) as e:
            if not forgiving:
                raise
            return {"infile": name, "leader": None, "fields": None, "corrupt": str(e)[:200]}

    def told(batches):
        for batch in batches:
            for name, size, raw in zip(*(c.to_pylist() for c in batch.columns)):
                yield name, size, raw

    def run(batches):
        yield from _batches((one(name, raw.lstrip(b"\r\n") + RECORD_END) for name, _, raw in told(batches)), _READ)

    def walk(batches):
        yield from _batches((one(name, raw) for name, raw in walk_records(told(batches))), _READ)

    pieces = _pieces(spark, path, RECORD_END.decode())
    columns = ["infile", "size", F.col("value").cast("binary").alias("raw")]
    if forgiving:
        return pieces.where(F.col("value").rlike(r"\S")).select(*columns).mapInArrow(run, schema)
    inner = F.ltrim("value", F.lit("\r\n"))
    prefix = F.substring(inner, 1, 5)
    good = prefix.rlike("^[0-9]{5}$") & (F.octet_length(inner) + 1 == F.try_to_number(prefix, F.lit("99999")))
    blank = F.octet_length(inner) == 0
    files = _ends(pieces, RECORD_END.decode(), bad=F.bool_or(~blank & ~F.coalesce(good, F.lit(False))), blanks=F.count_if(blank), after=F.max_by(blank, F.struct("block", "at")))
    odd = F.broadcast(files.where("bad or blanks > if(after and not closed, 1, 0)").select("infile"))  # names of files, which a reader's plan lists too
    plain = pieces.where(~blank).join(odd, "infile", "left_anti").select(*columns).mapInArrow(run, schema)
    rest = pieces.join(odd, "infile", "left_semi").repartition("infile").sortWithinPartitions("infile", "block", "at").select(*columns)
    return plain.unionByName(rest.mapInArrow(walk, schema))


def encode_record(leader: str, fields, allow_oversized: bool = False) -> bytes:
    """A record in ISO 2709; one over 99999 bytes raises, or has zeros where lengths do not fit."""
    directory, body = b"", b""
    for f in fields:
        if f["value"] is not None:
            raw = f["value"].encode()
        else:
            raw = (f["ind1"] + f["ind2"]).encode() + b"".join(SUB + (s["code"] + s["value"]).encode() for s in f["subfields"])
        raw += FIELD_END
        if len(raw) > 9999 and not allow_oversized:
            raise ValueError(f"field {f['tag']} is too long")
        size, at = (len(raw), len(body)) if len(raw) <= 9999 and len(body) <= MOST else (0, 0)
        directory += f"{f['tag']}{size:04d}{at:05d}".encode()
        body += raw
    base = LEADER + len(directory) + 1
    total = base + len(body) + 1
    if total > MOST:
        if not allow_oversized:
            raise ValueError("the record is too long")
        total = 0
    head = leader.ljust(LEADER)[:LEADER]
    head = f"{total:05d}{head[5:12]}{base if base <= MOST else 0:05d}{head[17:]}"
    return head.encode("latin-1") + directory + FIELD_END + body + RECORD_END


def to_binary(records: DataFrame, allow_oversized: bool = False) -> DataFrame:
    """``record``: each row in ISO 2709."""

    def run(batches):
        rows = (r for batch in batches for lo in range(0, batch.num_rows, RECORDS_A_BATCH) for r in batch.slice(lo, RECORDS_A_BATCH).to_pylist())
        yield from _batches(({"record": encode_record(r["leader"], r["fields"], allow_oversized)} for r in rows), pa.schema([("record", pa.binary())]))

    return records.select("leader", "fields").mapInArrow(run, "record binary")


def write_binary(records: DataFrame, path: str, allow_oversized: bool = False) -> None:
    """ISO 2709 files in UTF-8, which either reader takes."""
    lines = to_binary(records, allow_oversized).select(F.decode("record", "UTF-8").alias("value"))
    lines.select(F.expr("substring(value, 1, length(value) - 1)").alias("value")).write.option("lineSep", "\x1d").text(path)


def write_sequential(records: DataFrame, path: str, number: str = "number") -> None:
    """Sequential text: the leader and every field on a line of their own; ``number`` is padded to nine digits."""
    def line(f):
        subs = F.concat_ws("", F.transform(f["subfields"], lambda s: F.concat(F.lit("$$"), s["code"], s["value"])))
        marks = F.concat(F.coalesce(f["ind1"], F.lit(" ")), F.coalesce(f["ind2"], F.lit(" ")))
        return F.concat(F.lpad(F.col(number).cast("string"), 9, "0"), F.lit(" "), f["tag"], marks, F.lit(" L "), F.coalesce(f["value"], subs))

    head = F.concat(F.lpad(F.col(number).cast("string"), 9, "0"), F.lit(" LDR   L "), F.col("leader"))
    records.select(F.array_join(F.concat(F.array(head), F.transform("fields", line)), "\n").alias("value")).write.text(path)


def valid_text(raw: Column) -> Column:
    """Bytes as UTF-8 text with every bad sequence replaced."""
    return F.make_valid_utf8(raw.cast("string"))


def checked_text(raw: Column) -> Column:
    """Bytes as UTF-8 text; bad ones raise."""
    return F.validate_utf8(raw.cast("string"))


def read_sequential(spark: SparkSession, path: str) -> DataFrame:
    """Records of sequential text: number, tag and indicators, format letter, value with ``$$`` subfields, a line each."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("at"))
    part = lambda i, n: F.substring("value", i, n)
    body = F.substr(F.col("value"), F.lit(19))
    subs = F.transform(F.filter(F.split(body, r"\$\$"), lambda s: s != ""), lambda s: F.struct(F.substring(s, 1, 1).alias("code"), F.substr(s, F.lit(2)).alias("value")))
    plain = is_control(part(11, 3)) | (part(11, 3) == "LDR")
    field = F.struct(
        part(11, 3).alias("tag"), F.when(~plain, part(14, 1)).alias("ind1"), F.when(~plain, part(15, 1)).alias("ind2"), F.when(plain, body).alias("value"), F.when(~plain, subs).alias("subfields")
    )
    rows = lines.where(F.length("value") > 18).select(part(1, 9).alias("number"), "at", field.alias("f"))
    # a record has a bounded number of lines
    got = rows.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("at", "f"))).alias("l"))
    all_fields = F.transform("l", lambda x: x["f"])
    leader = F.get(F.filter(all_fields, lambda f: f["tag"] == "LDR"), F.lit(0))["value"]
    return got.select("number", leader.alias("leader"), F.filter(all_fields, lambda f: f["tag"] != "LDR").alias("fields"))
