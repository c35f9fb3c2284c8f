"""Agencies: counts, the map from classification stems, and separation of imprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bibweave.functions.text import canonical_imprint, normalize_agency, one_of, space_sudoc, stem_sudoc

# Names of US states, words that are no agency alone, and words that keep a rare agency.
STATES = tuple(
    "ALABAMA|ALASKA|ARIZONA|ARKANSAS|CALIFORNIA|COLORADO|CONNECTICUT|DELAWARE|DISTRICT OF COLUMBIA|FLORIDA|GEORGIA|HAWAII|IDAHO|ILLINOIS|INDIANA|IOWA|"
    "KANSAS|KENTUCKY|LOUISIANA|MAINE|MARYLAND|MASSACHUSETTS|MICHIGAN|MINNESOTA|MISSISSIPPI|MISSOURI|MONTANA|NEBRASKA|NEVADA|NEW HAMPSHIRE|NEW JERSEY|"
    "NEW MEXICO|NEW YORK|NORTH CAROLINA|NORTH DAKOTA|OHIO|OKLAHOMA|OREGON|PENNSYLVANIA|RHODE ISLAND|SOUTH CAROLINA|SOUTH DAKOTA|TENNESSEE|TEXAS|UTAH|"
    "VERMONT|VIRGINIA|WASHINGTON|WEST VIRGINIA|WISCONSIN|WYOMING".split("|")
)
STOP_WORDS = tuple(
    "ACADEMY ADMINISTRATION AGENCY ASSOCIATION BOARD BRANCH BUREAU CENTER COMMAND COMMISSION COMMITTEE CORPS COUNCIL COURT DEPT DIRECTORATE DISTRICT "
    "DIVISION FOUNDATION GROUP INSTITUTE LABORATORY LIBRARY OFFICE PROGRAM REGION SCHOOL SECTION SERVICE SERVICES SN STAFF STATION SURVEY TEAM US".split()
)
KEEP_WORDS = tuple(
    "ADMIN|ADVISORY|AGENCY|AID|AIR|ARMED|ARMY|ATTORNEY|BOARD|BUREAU|CENSUS|CENTER|CHIEF|COMMAND|COMMISSION|COMMITTEE|COMPTROLLER|CONGRESS|CORPS|COUNCIL|"
    "COUNSEL|COURT|DEFENSE|DELEGATION|DEPT|DIRECTORATE|DIVISION|EEUU|ENDOWMENT|ESTADOS UNIDOS|FEDERAL|FORCE|GEOLOGICAL SURVEY|GOVT|GROUP|HEARING|INSTITUTE|"
    "JOINT VENTURE|LEGISL|MANAGEMENT|MARINE|MARITIME|MISSION|NATIONAL|NAVAL|NAVY|OFFICE|PANEL|PEACE|POLICY|PRESIDENT|PROGRAM|PROJECT|RESERVE|RURAL|"
    "SCIENCE CENTER|SECRETARY|SENATE|SERVICE|SUPERINTENDENT|TASK FORCE|TEAM|TRADE|US|VETERAN|WAR|WHITE HOUSE".split("|")
)
# What an agency name must not match, and what excuses it.
EXCLUDED = (
    (r"UNIVERSITY OF", None),
    (r"UNIVERSITY", r"OFFICE|US DEPT|ADMINISTRATION"),
    (r"COLLEGE|SCHOOL", r"DEFENSE|NAVAL|ARMED FORCES|USAF|INFANTRY|COMMITTEE|COMMISSION|OFFICE"),
    (r"CORPORATION", r"^US.+(AGENCY|COMMITTEE|CONGRESS|DEPT|SENATE)"),
    (r"\b((AND)? CO(MPANY)?|INC(ORPORATED)?|L(IMI)?TE?D|ASSOCIATES|FIRM|LLC)\b", None),
    (r"FOUNDATION", r"(AFRICAN DEVELOPMENT|INTER-AMERICAN|NATIONAL SCIENCE)"),
    (r"^[^ ]+ AND [^ ]+$", None),
    (r"(SOCIETY (OF|FOR)|SOCIETY( US)?$)", None),
    (r"\bCOUNTY\b", r"\bUS\b"),
)


def state_patterns(states: Sequence[str] = STATES) -> tuple[str, ...]:
    """Patterns of agencies of a state, names that begin with one, and a city with its state."""
    s = one_of(states)
    return rf"{s}\s*(STATE)?\s*DEPT OF", rf"^((NORTH|EAST|SOUTH|WEST)(ERN)?|CENTRAL| )*{s}", rf"^[^ ]+ {s}"


def is_agency(name: Column, stem: Column, acronyms: Sequence[str], stop_words: Sequence[str] = STOP_WORDS, states: Sequence[str] = STATES) -> Column:
    """Whether a normalised name is a federal agency for the documents of a classification stem."""
    ok = (name != "") & ~name.rlike(one_of(stop_words, True)) & (name.rlike(r"\s") | name.rlike(one_of(acronyms, True)))
    ok &= stem.rlike("GP|PR") | ~name.rlike("GPO")
    for pattern, excuse in EXCLUDED:
        hit = name.rlike(pattern)
        ok &= ~(hit & ~name.rlike(excuse)) if excuse else ~hit
    for pattern in state_patterns(states):
        ok &= ~name.rlike(pattern)
    return ok


def agency_map(records: DataFrame, acronyms: Sequence[str], threshold: int = 2, normalize=normalize_agency, keep_words: Sequence[str] = KEEP_WORDS) -> DataFrame:
    """``sudoc_stem, agency`` from records with arrays ``sudoc`` and ``agency``.

    An agency is counted once for each stem and record it occurs with, before it is judged; one below the
    threshold stays only with two or more different words of ``keep_words`` or acronyms.
    """
    rows = records.where("sudoc is not null and agency is not null").select(
        F.explode(F.transform("sudoc", stem_sudoc)).alias("sudoc_stem"), F.transform("agency", normalize).alias("names")
    ).where("sudoc_stem is not null").select("sudoc_stem", F.explode("names").alias("agency"))
    counts = rows.groupBy("agency").agg(F.count("*").alias("c"))
    good = rows.where(is_agency(F.col("agency"), F.col("sudoc_stem"), acronyms)).distinct().join(counts, "agency")
    words = F.array_distinct(F.regexp_extract_all("agency", F.lit(f"({'|'.join(keep_words)}|\\b(?:{'|'.join(acronyms)})\\b)"), F.lit(1)))
    return good.where((F.col("c") >= threshold) | (F.size(words) >= 2)).select("sudoc_stem", "agency")


def agency_map_lines(mapping: DataFrame) -> DataFrame:
    """The map as blocks of text: a stem, then its agencies after a tab, in order (``sudoc_stem, block``)."""
    each = mapping.groupBy("sudoc_stem").agg(F.array_sort(F.collect_set("agency")).alias("a"))
    return each.select("sudoc_stem", F.concat("sudoc_stem", F.array_join(F.transform("a", lambda x: F.concat(F.lit("\n\t"), x)), "")).alias("block"))


def read_agency_map(blocks: DataFrame) -> DataFrame:
    """``sudoc_stem, agency`` from such blocks."""
    lines = F.split("block", "\n")
    return blocks.select(F.get(lines, F.lit(0)).alias("sudoc_stem"), F.explode(F.slice(lines, 2, F.size(lines))).alias("a")).select("sudoc_stem", F.regexp_replace("a", "^\t", "").alias("agency"))


def agency_counts(records: DataFrame, column: str = "agency") -> DataFrame:
    """How often each agency occurs."""
    return records.select(F.explode(column).alias("agency")).groupBy("agency").agg(F.count("*").alias("c"))


def normalized_counts(counts: DataFrame) -> DataFrame:
    """Counts summed over normalised names, empty ones dropped."""
    return counts.select(normalize_agency("agency").alias("agency"), "c").where("agency <> ''").groupBy("agency").agg(F.sum("c").alias("c"))


def candidate_lines(records: DataFrame, blocks: DataFrame) -> DataFrame:
    """``line``: the id and the stems, tab-separated, of records (``id``, array ``agency``) with an agency in a written map."""
    found = likely_documents(records, read_agency_map(blocks))
    return found.select(F.concat_ws("\t", F.col("id").cast("string"), F.array_join("stems", "\t")).alias("line"))


def likely_documents(records: DataFrame, mapping: DataFrame) -> DataFrame:
    """``id, stems`` of records (``id``, array ``agency``) whose agencies are in the map; stems spaced, distinct and sorted."""
    # normalised before they are exploded: what the map's names fulfil is inferred for these too, and would repeat the rewrites in every test
    asked = records.select("id", F.explode(F.transform("agency", normalize_agency)).alias("agency")).distinct()
    found = asked.join(mapping, "agency")
    return found.groupBy("id").agg(F.array_sort(F.collect_set(space_sudoc("sudoc_stem"))).alias("stems"))


def separate_imprints(rows: DataFrame, imprint: str = "imprint", flag: str = "gov_doc") -> DataFrame:
    """Imprints by whom they belong to: ``imprint, side`` (gov, non, both), ``originals`` (sorted).

    A flag other than 0 and 1 and an imprint without letters are left out.
    """
    kept = rows.select(canonical_imprint(imprint).alias("name"), F.col(imprint).alias("original"), F.col(flag).cast("string").alias("flag"))
    kept = kept.where("name is not null and flag in ('0', '1')")
    each = kept.groupBy("name").agg(F.bool_or(F.col("flag") == "1").alias("gov"), F.bool_or(F.col("flag") == "0").alias("non"), F.array_sort(F.collect_set("original")).alias("originals"))
    side = F.when(F.col("gov") & F.col("non"), "both").when(F.col("gov"), "gov").otherwise("non")
    return each.select(F.col("name").alias("imprint"), side.alias("side"), "originals")
