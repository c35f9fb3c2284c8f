"""License detection by ordered signature rules.

A rule is a regular expression over a text's words (A-Z lower-cased, runs of other bytes
than letters, digits and other scripts become one space), a label, a priority and the
words without which it cannot match. All words of a slice are looked up by hash at once; a
text is only searched with rules whose words it has. Of the matches, one whose interval lies
within that of a match of better or equal priority is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.llm.license_texts import GRANTS
from bibweave.llm.textvec import ALNUM, alnum_words, map_batches, slices

#: Label, words that name the license, and a word that each such name holds.
LICENSES = (
    ("0bsd", r"(?:zero clause bsd|0bsd|bsd zero clause)", "bsd 0bsd"),
    ("aal", r"attribution assurance license", "attribution"),
    ("afl", r"academic free license(?: (?:version |v)?[123](?: \d)?)?", "academic"),
    ("agpl-3.0", r"(?:gnu )?affero general public license(?: (?:version |v)?3(?: 0)?)?", "affero"),
    ("agpl-3.0", r"agpl(?: version)? ?v?3(?: 0)?", "agpl agplv3 agpl3"),
    ("apache-1.1", r"apache (?:software )?licen[sc]e(?: version| v)? ?1 1", "apache"),
    ("apache-2.0", r"apache (?:software )?licen[sc]e(?: version| v)? ?2(?: 0)?", "apache"),
    ("apsl-2.0", r"apple public source license(?: (?:version |v)?2(?: 0)?)?", "apple"),
    ("artistic-1.0", r"artistic license(?: version)? 1(?: 0)?", "artistic"),
    ("artistic-2.0", r"artistic license(?: version)? 2(?: 0)?", "artistic"),
    ("beerware", r"beer ?ware license", "beer beerware"),
    ("blueoak-1.0.0", r"blue oak model license(?: 1 0 0)?", "oak"),
    ("bsd-2-clause", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?", "bsd freebsd"),
    ("bsd-3-clause", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?", "bsd"),
    ("bsd-4-clause", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: licen[sc]e)?", "bsd"),
    ("bsl-1.0", r"boost software license(?: (?:version )?1 0)?", "boost"),
    ("busl-1.1", r"business source license(?: (?:version )?1 1)?", "business"),
    ("cc-by", r"(?:cc by|creative commons attribution)(?: [1234] [05])?(?: international| unported)?(?: public)?(?: licen[sc]e)?", "cc creative"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1234] [05])?(?: international| unported)?", "cc creative"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)(?: [1234] [05])?", "cc creative"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1234] [05])?", "cc creative"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)(?: [1234] [05])?", "cc creative"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: [1234] [05])?", "cc creative"),
    ("cc-pdm", r"(?:creative commons )?public domain mark(?: 1 0)?", "mark"),
    ("cc0-1.0", r"(?:cc0(?: 1 0)?|creative commons zero)(?: universal)?(?: licen[sc]e)?", "cc0 zero"),
    ("cddl-1.0", r"(?:common development and distribution license|cddl)(?: (?:version )?1 [01])?", "cddl development"),
    ("cecill-2.1", r"cecill(?: free software license agreement)?(?: (?:version )?2 [01])?", "cecill"),
    ("cpal-1.0", r"common public attribution license(?: (?:version )?1 0)?", "attribution"),
    ("cpl-1.0", r"common public license(?: (?:version )?1 0)?", "common"),
    ("ecl-2.0", r"educational community license(?: (?:version )?2 0)?", "educational"),
    ("elastic-2.0", r"elastic license(?: (?:version )?2(?: 0)?)?", "elastic"),
    ("epl-1.0", r"eclipse public license(?: (?:version |v ?)?1(?: 0)?)", "eclipse"),
    ("epl-2.0", r"eclipse public license(?: (?:version |v ?)?2(?: 0)?)?", "eclipse"),
    ("eupl-1.2", r"european union public licen[sc]e(?: (?:version )?1 [12])?", "european"),
    ("gfdl", r"gnu free documentation license(?: (?:version )?1 [123])?", "documentation"),
    ("gpl-1.0", r"(?:gnu )?general public license(?: version| v)? ?1(?: 0)?", "general"),
    ("gpl-2.0", r"(?:gnu )?general public license(?: version| v)? ?2(?: 0)?", "general"),
    ("gpl-3.0", r"(?:gnu )?general public license(?: version| v)? ?3(?: 0)?", "general"),
    ("gpl-2.0", r"(?:gnu )?gpl(?: version)? ?v?2(?: 0)?(?: only| or later)?", "gpl gplv2 gpl2"),
    ("gpl-3.0", r"(?:gnu )?gpl(?: version)? ?v?3(?: 0)?(?: only| or later)?", "gpl gplv3 gpl3"),
    ("hpnd", r"historical permission notice and disclaimer", "historical"),
    ("ijg", r"independent jpeg group(?: s)? licen[sc]e", "jpeg"),
    ("ipl-1.0", r"ibm public license(?: (?:version )?1 0)?", "ibm"),
    ("isc", r"(?:isc|internet systems consortium) licen[sc]e", "isc consortium"),
    ("lgpl-2.0", r"(?:(?:gnu )?library general public license(?: (?:version |v)?2(?: 0)?)?|lgpl(?: version)? ?v?2 0)", "library lgpl lgplv2 lgpl2"),
    ("lgpl-2.1", r"(?:(?:gnu )?lesser general public license(?: version| v)? ?2(?: 1)?|lgpl(?: version)? ?v?2(?! 0)(?: 1)?)", "lesser lgpl lgplv2 lgpl2"),
    ("lgpl-3.0", r"(?:(?:gnu )?lesser general public license(?: version| v)? ?3(?: 0)?|lgpl(?: version)? ?v?3(?: 0)?)", "lesser lgpl lgplv3 lgpl3"),
    ("lppl-1.3c", r"latex project public license(?: (?:version )?1 3c?)?", "latex"),
    ("mit", r"(?:mit|expat)(?: x11)? licen[sc]e", "mit expat"),
    ("mit-0", r"mit no attribution(?: license)?", "mit"),
    ("mpl-1.1", r"mozilla public license(?: version| v)? ?1 [01]", "mozilla"),
    ("mpl-2.0", r"(?:mozilla public license(?: version| v)? ?2(?: 0)?|mpl(?: version)? ?v?2(?: 0)?)", "mozilla mpl mplv2 mpl2"),
    ("ms-pl", r"microsoft public license", "microsoft"),
    ("ms-rl", r"microsoft reciprocal license", "microsoft"),
    ("mulanpsl-2.0", r"mulan (?:permissive software license|psl)(?: v?2)?", "mulan"),
    ("ncsa", r"university of illinois ncsa open source license", "ncsa"),
    ("nposl-3.0", r"non profit open software license(?: 3 0)?", "profit"),
    ("odbl-1.0", r"open (?:data commons open )?database license(?: 1 0)?", "database"),
    ("odc-by-1.0", r"open data commons attribution license(?: 1 0)?", "commons"),
    ("ofl-1.1", r"(?:sil )?open font license(?: (?:version )?1 [01])?", "font"),
    ("ogl-3.0", r"open government licen[sc]e(?: v?3(?: 0)?)?", "government"),
    ("openssl", r"openssl license", "openssl"),
    ("osl-3.0", r"open software license(?: (?:version |v)?[123](?: \d)?)?", "software"),
    ("pddl-1.0", r"(?:public domain dedication and license|pddl)(?: 1 0)?", "pddl dedication"),
    ("php-3.01", r"php license(?: (?:version )?3(?: 01| 0)?)?", "php"),
    ("postgresql", r"postgresql licen[sc]e", "postgresql"),
    ("psf-2.0", r"(?:python software foundation|psf) license(?: (?:version )?2)?", "python psf"),
    ("qpl-1.0", r"q public license(?: (?:version )?1 0)?", "q"),
    ("rpl-1.5", r"reciprocal public license(?: 1 [15])?", "reciprocal"),
    ("ruby", r"ruby license", "ruby"),
    ("sleepycat", r"sleepycat license", "sleepycat"),
    ("sspl-1.0", r"server side public license(?: (?:version )?1)?", "server"),
    ("unicode", r"unicode(?: inc)? license(?: agreement)?", "unicode"),
    ("unlicense", r"(?:the )?unlicense", "unlicense"),
    ("upl-1.0", r"universal permissive license(?: (?:version |v)?1 0)?", "permissive"),
    ("vim", r"vim license", "vim"),
    ("w3c", r"w3c software(?: notice)?(?: and)?(?: document)? license", "w3c"),
    ("wtfpl", r"(?:wtfpl|do what the fuck you want to public license)", "wtfpl fuck"),
    ("x11", r"x11 license", "x11"),
    ("zlib", r"zlib(?: libpng)? license", "zlib"),
    ("zpl-2.1", r"zope public license(?: (?:version )?2 [01])?", "zope"),
)
#: Label, words of its text or notice, and a word that they hold.
NOTICES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby"),
    ("mit", r"the software is provided as is without warranty of any kind express or implied", "warranty"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee", "fee"),
    ("bsd-2-clause", r"redistributions in binary form must reproduce the above copyright notice", "redistributions"),
    ("bsd-2-clause", r"redistributions of source code must retain the above copyright notice", "redistributions"),
    ("bsd-3-clause", r"neither the name of .{1,80}? nor the names of its contributors may be used", "contributors"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "advertising"),
    ("apache-2.0", r"you may not use this file except in compliance with the license", "compliance"),
    ("apache-2.0", r"www apache org licenses license 2 0", "apache"),
    ("gpl", r"you can redistribute it and or modify it under the terms of the gnu general public license", "gnu"),
    ("gpl-2.0", r"either version 2 of the license or at your option any later version", "option"),
    ("gpl-3.0", r"either version 3 of the license or at your option any later version", "option"),
    ("lgpl", r"under the terms of the gnu (?:lesser|library) general public license", "gnu"),
    ("agpl", r"under the terms of the gnu affero general public license", "affero"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", r"(?:released|dedicated|placed) (?:in ?to|to|in) the public domain", "domain"),
    ("cc", r"creativecommons org licenses", "creativecommons"),
    ("cc0-1.0", r"to the extent possible under law .{1,120}? waived all copyright", "waived"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "authors"),
    ("proprietary", r"all rights reserved", "reserved"),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", "proprietary"),
    ("proprietary", r"unauthorized (?:copying|reproduction|use) .{0,60}?(?:is )?(?:strictly )?prohibited", "prohibited"),
)
#: The same for names of families without a version.
FAMILIES = (
    ("gpl", r"gnu (?:gpl|general public license)", "gnu"),
    ("lgpl", r"(?:gnu )?(?:lgpl|lesser general public license)", "lgpl lesser"),
    ("agpl", r"(?:gnu )?(?:agpl|affero general public license)", "agpl affero"),
    ("bsd", r"bsd (?:style )?licen[sc]e", "bsd"),
    ("cc", r"creative commons(?: public)? licen[sc]e", "creative"),
    ("apache", r"apache software foundation", "apache"),
)
#: Label and SPDX identifier, as words.
IDENTIFIERS = (
    ("0bsd", "0bsd"), ("aal", "aal"), ("afl", r"afl [123] \d"), ("agpl-3.0", "agpl 3 0"), ("apache-1.1", "apache 1 1"), ("apache-2.0", "apache 2 0"), ("apsl-2.0", "apsl 2 0"),
    ("artistic-1.0", "artistic 1 0(?: perl| cl8)?"), ("artistic-2.0", "artistic 2 0"), ("beerware", "beerware"), ("blueoak-1.0.0", "blueoak 1 0 0"),
    ("bsd-2-clause", "bsd 2 clause(?: patent| views)?"), ("bsd-3-clause", "bsd 3 clause(?: clear)?"), ("bsd-4-clause", "bsd 4 clause(?: uc)?"), ("bsl-1.0", "bsl 1 0"), ("busl-1.1", "busl 1 1"),
    ("cc-by", "cc by [1234] [05]"), ("cc-by-nc", "cc by nc [1234] [05]"), ("cc-by-nc-nd", "cc by nc nd [1234] [05]"), ("cc-by-nc-sa", "cc by nc sa [1234] [05]"), ("cc-by-nd", "cc by nd [1234] [05]"),
    ("cc-by-sa", "cc by sa [1234] [05]"), ("cc-pdm", "cc pdm 1 0"), ("cc0-1.0", "cc0 1 0"), ("cddl-1.0", "cddl 1 [01]"), ("cecill-2.1", "cecill 2 [01]"), ("cpal-1.0", "cpal 1 0"), ("cpl-1.0", "cpl 1 0"),
    ("ecl-2.0", "ecl 2 0"), ("elastic-2.0", "elastic 2 0"), ("epl-1.0", "epl 1 0"), ("epl-2.0", "epl 2 0"), ("eupl-1.2", "eupl 1 [12]"), ("gfdl", "gfdl 1 [123]"),
    ("gpl-1.0", "gpl 1 0"), ("gpl-2.0", "gpl 2 0"), ("gpl-3.0", "gpl 3 0"), ("hpnd", "hpnd"), ("ijg", "ijg"), ("ipl-1.0", "ipl 1 0"), ("isc", "isc"),
    ("lgpl-2.0", "lgpl 2 0"), ("lgpl-2.1", "lgpl 2 1"), ("lgpl-3.0", "lgpl 3 0"), ("lppl-1.3c", "lppl 1 3[ac]"), ("mit", "mit"), ("mit-0", "mit 0"), ("mpl-1.1", "mpl 1 [01]"), ("mpl-2.0", "mpl 2 0"),
    ("ms-pl", "ms pl"), ("ms-rl", "ms rl"), ("mulanpsl-2.0", "mulanpsl 2 0"), ("ncsa", "ncsa"), ("nposl-3.0", "nposl 3 0"), ("odbl-1.0", "odbl 1 0"), ("odc-by-1.0", "odc by 1 0"),
    ("ofl-1.1", "ofl 1 [01](?: no rfn| rfn)?"), ("ogl-3.0", "ogl uk 3 0"), ("openssl", "openssl"), ("osl-3.0", r"osl [123] \d"), ("pddl-1.0", "pddl 1 0"), ("php-3.01", "php 3 01?"), ("postgresql", "postgresql"),
    ("psf-2.0", r"(?:psf 2 0|python 2 0(?: \d)?)"), ("qpl-1.0", "qpl 1 0"), ("rpl-1.5", "rpl 1 [15]"), ("ruby", "ruby"), ("sleepycat", "sleepycat"), ("sspl-1.0", "sspl 1 0"), ("unicode", r"unicode (?:3 0|tou|dfs \d+)"),
    ("unlicense", "unlicense"), ("upl-1.0", "upl 1 0"), ("vim", "vim"), ("w3c", r"w3c(?: \d+)?"), ("wtfpl", "wtfpl"), ("x11", "x11"), ("zlib", "zlib"), ("zpl-2.1", "zpl 2 [01]"),
)
#: What may follow an identifier, the tag before the first one, and what stands between two of an expression.
_LATER = r"(?: only| or later)?(?: with (?:(?!(?:or|and|with) )[^ ]+ )+?exception(?: \d)*)?"
_TAG = re.compile(r"(?<![^ ])spdx licen[sc]e identifier (?=[^ ])")
_NEXT = re.compile(r" (?:or|and) (?=[^ ])")
#: The places every scan counts: phrase and label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Text before a name, its priority (1 is best) and its weight in the score.
FORMS = (
    (r"spdx licen[sc]e identifier ", 1, 0.95),
    (r"(?:licensed|released|distributed|available|published|provided|offered) (?:to you )?under (?:the )?(?:terms (?:of|and conditions of) (?:the )?)?(?:gnu )?", 2, 0.9),
    (r"", 4, 0.7),
)
NOTICE_FORM, FAMILY_FORM, BASE_FORM = (3, 0.8), (5, 0.6), (6, 0.6)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    weight: float
    pattern: re.Pattern
    words: frozenset  # one of them must occur
    base: bool = False
    listed: tuple = ()  # first words of an identifier, which counts only in an expression behind the tag


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, best priority first."""

    def rule(label, form, pattern, words, base=False, listed=()):
        return Rule(label, *form, re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])"), frozenset(words.split()), base, listed)

    made = [rule(label, form[1:], form[0] + name, words) for form in FORMS for label, name, words in LICENSES]
    made += [rule(label, FORMS[0][1:], f"{name}{_LATER}", "spdx", listed=tuple(re.findall(r"(?:^|\|)(?:\(\?:)?([a-z0-9]+)", name))) for label, name in IDENTIFIERS]
    made += [rule(label, NOTICE_FORM, text, words) for label, text, words in (*NOTICES, *GRANTS)]
    made += [rule(label, FAMILY_FORM, text, words) for label, text, words in FAMILIES]
    made += [rule(label, BASE_FORM, phrase, phrase.split()[0], True) for phrase, label in BASE]
    return tuple(sorted(made, key=lambda r: r.priority))


@cache
def _gate() -> tuple[np.ndarray, list[frozenset]]:
    """Hashes of the rules' words in order, and for each the numbers of its rules."""
    by_word: dict[str, set[int]] = {}
    for i, r in enumerate(rules()):
        for w in r.words:
            by_word.setdefault(w, set()).add(i)
    names = sorted(by_word)
    data = np.frombuffer(" ".join(names).encode(), np.uint8)
    h = alnum_words(data, np.array([0, len(data)])).hashes()
    order = np.argsort(h)
    return h[order], [frozenset(by_word[names[i]]) for i in order]


@cache
def _identifiers() -> dict[str, list[Rule]]:
    out: dict[str, list[Rule]] = {}
    for r in rules():
        for word in r.listed:
            out.setdefault(word, []).append(r)
    return out


def expressions(text: str) -> Iterator[tuple[int, int, Rule]]:
    """The identifiers of every tagged expression, however many it lists; the longest that stands at a place."""
    for tag in _TAG.finditer(text):
        at = tag.end()
        while True:
            end = text.find(" ", at)
            found = [(m.end(), r) for r in _identifiers().get(text[at : end if end >= 0 else len(text)], ()) if (m := r.pattern.match(text, at))]
            if not found:
                break
            last, r = max(found, key=lambda x: x[0])
            yield at, last, r
            more = _NEXT.match(text, last)
            if not more:
                break
            at = more.end()


def matches(text: str, numbers: list[int]) -> list[tuple[int, int, Rule]]:
    """All matches (start, end, rule) of some rules in normalised text."""
    own = [rules()[i] for i in numbers]
    found = [(*m.span(), rule) for rule in own if not rule.listed for m in rule.pattern.finditer(text)]
    return found + (list(expressions(text)) if any(rule.listed for rule in own) else [])


def resolve(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Matches that do not lie within one of better or equal priority; of equal ones the first rule's.

    One pass from left to right, longer ones first, with the furthest end so far of every priority.
    """
    kept: list[tuple[int, int, Rule]] = []
    furthest: dict[int, int] = {}
    for s, e, r in sorted(found, key=lambda m: (m[0], -m[1], m[2].priority, m[2].label)):
        if not any(end >= e for p, end in furthest.items() if p <= r.priority):
            kept.append((s, e, r))
        furthest[r.priority] = max(furthest.get(r.priority, 0), e)
    return sorted(kept, key=lambda m: (m[0], m[1]))


_NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_matches"]
_SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_matches long"


def _scan(batches):
    keys, owners = _gate()
    for batch in batches:
        out: list[list] = [[] for _ in _NAMES[1:]]
        for _, _, data, offsets in slices(batch.column(1)):
            w = alnum_words(data, offsets)
            h = w.hashes()
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == h)
            rows = w.row[hit]
            place = np.searchsorted(rows, np.arange(w.rows + 1))
            raw = None
            for row in range(w.rows):
                lo, hi = int(w.bounds[row]), int(w.bounds[row + 1])
                line = [hi - lo, 0, None, None, "", "", 0.0, 0]
                if place[row + 1] > place[row]:
                    if raw is None:
                        clean = np.where(ALNUM[w.data], w.data, 32).astype(np.uint8)
                        raw = clean.tobytes()
                    words = raw[offsets[row] : offsets[row + 1]].split()
                    text = b" ".join(words).decode()
                    some = set().union(*(owners[i] for i in np.unique(at[hit[place[row] : place[row + 1]]])))
                    line[1:] = _judge(text, sorted(some))
                for col, x in zip(out, line):
                    col.append(x)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], names=_NAMES)


def _judge(text: str, numbers: list[int]) -> list:
    found = matches(text, numbers)
    kept = resolve(found)
    base = [(s, r) for s, _, r in found if r.base]
    starts = []
    if base:
        spaces = [i for i, c in enumerate(text) if c == " "]
        starts = [bisect_right(spaces, s - 1) for s, _ in base]
    base_labels = {r.label for _, r in base}
    weights: dict[str, float] = {}
    for _, _, r in kept:
        weights[r.label] = max(weights.get(r.label, 0), r.weight)
    score = 1 - float(np.prod([1 - x for x in weights.values()])) if weights else 0.0
    return [len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(base_labels | weights.keys())), score, len(kept)]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licenses of every row.

    Returns ``doc_id, n_words, n_base`` (places of :data:`BASE` phrases, suppressed or not),
    ``first_word, last_word`` (their smallest and largest first word, from 0), ``base_labels``,
    ``labels`` (of those and of matches that stay; distinct, sorted, comma-joined), ``score``
    (0 without a match, else 1 - product of (1 - weight) over labels) and ``n_matches``.
    Null texts are empty. Repeated rows and null ids are scanned like others, other columns are ignored and
    an empty table gives no rows.
    """
    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col)), _scan, _SCHEMA)
