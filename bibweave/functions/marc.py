"""Column functions over MARC records of the struct in :data:`RECORD`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUBFIELDS = "array<struct<code:string,value:string>>"
FIELD = f"struct<tag:string,ind1:string,ind2:string,value:string,subfields:{SUBFIELDS}>"
RECORD = f"leader string, fields array<{FIELD}>"


def fields_of(tag, last=None, fields="fields") -> Column:
    """Fields of a tag, of a list of tags, or of the tags from ``tag`` to ``last``, in record order."""
    if last is not None:
        return F.filter(fields, lambda f: f["tag"].between(tag, last))
    tags = [tag] if isinstance(tag, str) else list(tag)
    return F.filter(fields, lambda f: f["tag"].isin(*tags))


def first_field(tag: str, fields="fields") -> Column:
    """The first field of a tag, null without one."""
    return F.get(fields_of(tag, fields=fields), F.lit(0))


def subfield_of(field: Column, code: str) -> Column:
    """The value of a field's first subfield with a code."""
    return F.get(F.filter(field["subfields"], lambda s: s["code"] == code), F.lit(0))["value"]


def _strip(v: Column) -> Column:
    return F.regexp_replace(F.trim(F.regexp_replace(v, r"^\s+|\s+$", "")), " +", " ")


def values_of(spec: str, fields="fields") -> Column:
    """Stripped values of ``ddd`` (control value or all subfields) or ``dddc`` (those subfields) as an array."""
    tag, code = spec[:3], spec[3:]
    wanted = lambda s: (s["code"] == code) if code else F.lit(True)
    none = F.array().cast("array<string>")

    def of(f):
        subs = F.transform(F.filter(F.coalesce(f["subfields"], F.array().cast(SUBFIELDS)), wanted), lambda s: s["value"])
        return F.when(f["value"].isNotNull(), F.array(f["value"])).otherwise(F.coalesce(subs, none))

    return F.transform(F.flatten(F.transform(fields_of(tag, fields=fields), of)), _strip)


def field_value(f: Column) -> Column:
    """A control field's value, or a data field's subfield values run together."""
    return F.coalesce(f["value"], F.array_join(F.transform(f["subfields"], lambda s: s["value"]), ""))


def field_text(f: Column) -> Column:
    """A field as one line."""
    subs = F.array_join(F.transform(f["subfields"], lambda s: F.concat(F.lit("$"), s["code"], F.lit(" "), s["value"])), " ")
    return F.concat(f["tag"], F.lit(" "), F.coalesce(f["value"], F.concat(f["ind1"], f["ind2"], F.lit(" "), subs)))


def record_text(leader="leader", fields="fields") -> Column:
    """A record as text, a line per field."""
    return F.concat(F.lit("LEADER "), F.col(leader), F.lit("\n"), F.array_join(F.transform(fields, field_text), "\n"))


def codes_of(f: Column) -> Column:
    """The distinct subfield codes of a field."""
    return F.array_distinct(F.transform(f["subfields"], lambda s: s["code"]))


def flat_lines(fields="fields") -> Column:
    """``tag+code<TAB>value`` of every subfield, ``tag<TAB>value`` of control fields."""

    def of(f):
        subs = F.transform(f["subfields"], lambda s: F.concat(f["tag"], s["code"], F.lit("\t"), s["value"]))
        return F.when(f["value"].isNotNull(), F.array(F.concat(f["tag"], F.lit("\t"), f["value"]))).otherwise(subs)

    return F.flatten(F.transform(fields, of))


def _any_line(lines: Column, pattern: str) -> Column:
    return F.exists(lines, lambda x: x.rlike(pattern))


def matches_lines(lines: Column, conditions: list[str]) -> Column:
    """Whether for each ``TAG=VALUE`` some line matches; both are patterns, case does not count, text after a second ``=`` is lost."""
    ok = F.lit(True)
    for c in conditions:
        tag, value = (c.split("=") + [""])[:2]
        ok &= _any_line(lines, f"(?i){tag}\t{value}")
    return ok


def matching_lines(lines: Column, conditions: list[str]) -> Column:
    """The lines that match any of the conditions."""
    patterns = "|".join(f"(?:{t}\t{v})" for t, v in ((c.split("=") + [""])[:2] for c in conditions))
    return F.filter(lines, lambda x: x.rlike(f"(?i)(?:{patterns})"))


def single_008(values: Column) -> Column:
    """The one 008 value; null when there is none or more than one."""
    return F.when(F.size(values) == 1, F.get(values, F.lit(0)))


def is_us_federal(f008: Column) -> Column:
    """Published in the United States by the federal government."""
    return (F.substring(f008, 18, 1) == "u") & (F.substring(f008, 29, 1) == "f")


def publication_date(f008: Column) -> Column:
    """The first date of 008 (characters 8 to 11) if it is a year, our own reading of the public layout."""
    date = F.substring(f008, 8, 4)
    return F.when(date.rlike("^[0-9]{4}$"), date)


# Elements of Dublin Core and the tags (and subfield) that they come from.
DUBLIN_CORE = {
    "title": (["245"], "a"), "creator": (["100", "110", "111", "700", "710", "711", "720"], None), "subject": (["600", "610", "611", "630", "650", "653"], None),
    "publisher": (["260"], "b"), "date": (["260"], "c"), "type": (["655"], None), "format": (["856"], "q"), "identifier": (["856"], "u"), "source": (["786"], "t"),
    "language": (["546"], None), "coverage": (["651", "752"], None), "rights": (["506", "540"], None),
}


def dublin_core(fields="fields") -> Column:
    """A struct of arrays, one for each Dublin Core element.

    Descriptions are all notes (500 to 599 but for 506, 530, 540, 546) and relations 530 and the titles of
    760 to 787, as the crosswalk intends.
    """

    def of(found, code):
        value = (lambda f: subfield_of(f, code)) if code else field_value
        return F.filter(F.transform(found, value), lambda v: v.isNotNull())

    parts = [of(fields_of(tags, fields=fields), code).alias(name) for name, (tags, code) in DUBLIN_CORE.items()]
    notes = F.filter(fields_of("500", "599", fields=fields), lambda f: ~f["tag"].isin("506", "530", "540", "546"))
    parts.append(of(notes, None).alias("description"))
    parts.append(F.concat(of(fields_of("530", fields=fields), None), of(fields_of("760", "787", fields=fields), "t")).alias("relation"))
    return F.struct(*parts)
