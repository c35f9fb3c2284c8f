"""MARC-8 to Unicode, with escapes; sets that are not covered give U+FFFD for each character.

Covered: ASCII, extended Latin (ANSEL) with combining marks, subscripts, superscripts and Greek
symbols, basic Greek, Cyrillic, Hebrew and Arabic, and numeric references ``&#xHHHH;``. Not covered: extended
Cyrillic and Arabic, and East Asian characters.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F

# Combining marks of the extended Latin set from E0, in order.
_MARKS = (0x309, 0x300, 0x301, 0x302, 0x303, 0x304, 0x306, 0x307, 0x308, 0x30C, 0x30A, 0xFE20, 0xFE21, 0x315, 0x30B, 0x310, 0x327, 0x328, 0x323, 0x324, 0x325, 0x333, 0x332, 0x326, 0x31C, 0x32E, 0xFE22, 0xFE23)
_MARKS_AT = [*range(0xE0, 0xFC)]


def _extended() -> dict[int, str]:
    # Its other characters, in order; a dot marks a free place.
    spacing = dict(zip([*range(0xA1, 0xAF), 0xAF], "ŁØĐÞÆŒʹ·♭®±ƠƯʼ."))
    spacing.pop(0xAF)
    spacing |= dict(zip(range(0xB0, 0xBE), "ʻłøđþæœʺı£ð.ơư"))
    spacing.pop(0xBB)
    spacing |= dict(zip(range(0xC0, 0xC9), "°ℓ℗©♯¿¡ß€"))
    marks = dict(zip(_MARKS_AT, map(chr, _MARKS))) | {0xFE: "̓"}
    return spacing | marks


_EXTENDED = _extended()
_SMALL = {b"b": dict(zip(b"()+-0123456789", "₍₎₊₋₀₁₂₃₄₅₆₇₈₉")), b"p": dict(zip(b"()+-0123456789", "⁽⁾⁺⁻⁰¹²³⁴⁵⁶⁷⁸⁹")), b"g": dict(zip(b"abc", "αβγ"))}


def _scripts() -> dict[bytes, dict[int, str]]:
    """Basic sets of other scripts, by the byte that designates them; codes are those of the lower half."""
    # Letters of the Cyrillic set from 40 (small) and 60 (capital), in order.
    small = "юабцдефгхийклмнопярстужвьызшэщчъ"
    cyrillic = dict(zip(range(0x40, 0x60), small)) | dict(zip(range(0x60, 0x80), small.upper()))
    # The Greek set from 41 (capital) and 61 (small), dots for free places, and its marks from 21.
    greek = dict(zip(range(0x41, 0x5F), "ΑΒ.ΓΔΕϚϜΖΗΘΙΚΛΜΝΞΟΠϞΡΣ.ΤΥΦΧΨΩϠ")) | dict(zip(range(0x61, 0x7F), "αβϐγδεϛϝζηθικλμνξοπϟρσςτυφχψωϡ"))
    greek |= {0x21 + i: chr(c) for i, c in enumerate((0x300, 0x301, 0x308, 0x342, 0x313, 0x314, 0x345))}
    # Hebrew points from 40; the letters follow their order in Unicode.
    points = (0x5B7, 0x5B8, 0x5B6, 0x5B5, 0x5B4, 0x5B9, 0x5BB, 0x5B0, 0x5B2, 0x5B3, 0x5B1, 0x5BC, 0x5BF, 0x5C1, 0xFB1E)
    hebrew = {0x40 + i: chr(c) for i, c in enumerate(points)} | {0x60 + i: chr(0x5D0 + i) for i in range(27)}
    # the Arabic set has the order of its Unicode block
    arabic = {c: chr(c + 0x5E0) for c in (*range(0x41, 0x5B), *range(0x60, 0x73), 0x2C, 0x3B, 0x3F)} | {0x30 + i: chr(0x660 + i) for i in range(10)}
    return {b"N": cyrillic, b"S": {k: v for k, v in greek.items() if v != "."}, b"2": hebrew, b"3": arabic}


_SCRIPTS = _scripts()
_REFERENCE = re.compile(r"&#x([0-9A-Fa-f]{4,6});")


def to_unicode(raw: bytes, form: str | None = "NFC") -> str:
    """Text of MARC-8 bytes; marks, which precede their letter, are moved behind it."""
    out: list[str] = []
    marks: list[str] = []
    low, high, at = b"B", b"E", 0
    while at < len(raw):
        c = raw[at]
        if c == 0x1B:
            kind = raw[at + 1 : at + 2]
            if kind in (b"b", b"p", b"g"):
                low, at = kind, at + 2
            elif kind == b"s":
                low, at = b"B", at + 2
            elif kind in (b"(", b",", b")", b"-", b"$"):
                step = 2 if kind != b"$" else 3 if raw[at + 2 : at + 3] in (b",", b")", b"-") else 2
                target = raw[at + step : at + step + 1]
                if target == b"!":
                    step += 1
                    target = raw[at + step : at + step + 1]
                if kind in (b")", b"-"):
                    high = target
                else:
                    low = target
                at += step + 1
            else:
                at += 1
            continue
        at += 1
        if low == b"1":  # three bytes a character
            at += 2
            ch = "�"
        elif c < 0x80:
            ch = _SCRIPTS[low].get(c, chr(c) if c < 0x40 else "�") if low in _SCRIPTS and c > 0x20 else chr(c) if low == b"B" or c < 0x21 else _SMALL.get(low, {}).get(c, "�")
        else:
            ch = _SCRIPTS[high].get(c - 0x80, "�") if high in _SCRIPTS else _EXTENDED.get(c, "�") if high == b"E" else "�"
        if unicodedata.combining(ch) or "︠" <= ch <= "︯":
            marks.append(ch)
        else:
            out += [ch, *marks]
            marks.clear()
    text = _REFERENCE.sub(lambda m: chr(int(m[1], 16)), "".join(out + marks))
    return unicodedata.normalize(form, text) if form else text


def decoded(form: str | None = "NFC"):
    """A function of a column of MARC-8 bytes."""

    @F.pandas_udf("string")
    def run(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: None if b is None else to_unicode(bytes(b), form))

    return run
