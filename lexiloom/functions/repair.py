"""Encoding repair as a rule over code points.

UTF-8 bytes read as windows-1252 or Latin-1 leave recognisable runs: a character
that stands for a lead byte and as many for trailing bytes as it asks for. A text
is split at its maximal runs, each is mapped back to bytes, and what is valid
UTF-8 is decoded, whatever the script. A single pair that real text may well
contain, such as a capital before a closing quote, is left alone. Two levels of
damage are undone; no plausibility score is taken and text is not put into NFC.
"""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.binding import let

# What windows-1252 shows for the bytes 0x80-0x9f it defines.
_CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_C1 = _CP1252.encode("cp1252").decode("latin-1")
_TRAIL = rf"[\x{{80}}-\x{{bf}}{_CP1252}]"
# What may follow a letter in undamaged text: quotes, dashes, ellipsis, no-break space.
_USUAL = r"[”’“‘…»–—\x{a0}]"
_TWO = rf"[\x{{c2}}-\x{{df}}]{_TRAIL}"
_THREE = rf"[\x{{e0}}-\x{{ef}}]{_TRAIL}{_TRAIL}"
_FOUR = rf"[\x{{f0}}-\x{{f4}}]{_TRAIL}{_TRAIL}{_TRAIL}"
# Several sequences side by side, or one that real text does not have. The lead
# characters of Latin-1 letters and signs are none that text puts before these.
_RUN = (
    rf"(?:{_FOUR}|{_THREE}|{_TWO}){{2,}}+|{_FOUR}|[\x{{e0}}-\x{{ef}}](?!{_USUAL}{_USUAL}){_TRAIL}{_TRAIL}"
    rf"|[ÂÃ]{_TRAIL}|[Ä-ß](?!{_USUAL}){_TRAIL}"
)

_ENTITY_NAMES = json.dumps({name: chr(code) for name, code in name2codepoint.items()})
_ENTITY = r"&#?[0-9A-Za-z]{1,24};"

# One-character ligatures and what they stand for.
_LIGATURES = {
    "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st",
    "ĳ": "ij", "Ĳ": "IJ",
}
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "
_CURLY = "ʼ‘’‚‛“”„‟"
_STRAIGHT = "'''''" + '""""'
_RARE = (
    r"[\x{80}-\x{9f}\x{132}-\x{ff5e}&&"
    r"[\x{80}-\x{9f}\x{2bc}\x{2018}-\x{201f}"
    rf"\x{{ff01}}-\x{{ff5e}}\x{{3000}}{''.join(_LIGATURES)}]]"
)
_LINE_END = r"[\r\x{85}\x{2028}\x{2029}](?:(?<=\r)\n)?"
_CONTROL = (
    r"[\x00-\x1f\x7f\x{206a}-\x{fffc}&&"
    r"[\x00-\x08\x0b\x0e-\x1f\x7f\x{206a}-\x{206f}\x{feff}\x{fff9}-\x{fffc}]]"
)
# One pass over one class finds the texts that need a closer look: controls,
# ampersands, characters that stand for trailing bytes, and typography.
_SUSPECT = (
    r"[\x{7f}-\x{fffc}\x{26}\x00-\x1f&&"
    r"[\x00-\x08\x0b\x0d-\x1f&\x7f-\xbf\x{132}\x{133}\x{152}\x{153}\x{160}\x{161}\x{178}\x{17d}\x{17e}"
    r"\x{192}\x{2bc}\x{2c6}\x{2dc}\x{2013}\x{2014}\x{2020}-\x{2022}\x{2026}\x{2030}\x{2039}\x{203a}\x{20ac}\x{2122}"
    r"\x{2018}-\x{201f}\x{2028}\x{2029}\x{206a}-\x{206f}\x{3000}\x{fb00}-\x{fb06}\x{feff}"
    r"\x{ff01}-\x{ff5e}\x{fff9}-\x{fffc}]]"
)


def _replace_found(text: Column, pattern: str, mend) -> Column:
    """Replace every match of the pattern by ``mend(match)``, in one pass: what comes out is not looked at again."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), mend)
    between = F.split(text, pattern, -1)
    joined = F.zip_with(between, F.concat(found, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    return F.when(F.rlike(text, F.lit(pattern)), F.array_join(joined, "")).otherwise(text)


def _from_code_point(number: Column) -> Column:
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


def _unescape(ref: Column) -> Column:
    # One literal, folded into a constant map: far quicker to build than a call per entry.
    names = F.from_json(F.lit(_ENTITY_NAMES), "map<string,string>")
    body = F.substring(ref, 2, 30)
    body = F.substring(body, F.lit(1), F.length(body) - 1)
    digits = F.regexp_extract(body, r"^#([0-9]{1,7})$", 1)
    hexes = F.regexp_extract(body, r"^#[xX]([0-9A-Fa-f]{1,6})$", 1)
    return (
        F.when(digits != "", F.coalesce(_from_code_point(digits.cast("long")), ref))
        .when(hexes != "", F.coalesce(_from_code_point(F.conv(hexes, 16, 10).cast("long")), ref))
        .otherwise(F.coalesce(F.try_element_at(names, body), ref))
    )


def _entities(text: Column) -> Column:
    # Markup is left alone: where a tag opens, entities belong to it.
    return F.when(F.contains(text, F.lit("<")), text).otherwise(
        _replace_found(text, _ENTITY, _unescape)
    )


def _decoded(run: Column) -> Column:
    whole = F.encode(F.translate(run, _CP1252, _C1), "ISO-8859-1").cast("string")
    return F.coalesce(F.try_validate_utf8(whole), run)


def _mojibake(text: Column) -> Column:
    return _replace_found(text, _RUN, _decoded)


def _typography(text: Column) -> Column:
    plain = F.translate(text, _C1 + _WIDE, _CP1252 + _NARROW)
    plain = F.translate(plain, _CURLY, _STRAIGHT)
    for ligature, letters in _LIGATURES.items():
        plain = F.replace(plain, F.lit(ligature), F.lit(letters))
    return F.when(F.rlike(text, F.lit(_RARE)), plain).otherwise(text)


def _line_ends(text: Column) -> Column:
    return F.regexp_replace(text, _LINE_END, "\n")


def _controls(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, "")


def repair_raw(text: Column) -> Column:
    """Repair a text; one without suspect characters is returned as it is."""

    def mend(value: Column) -> Column:
        # Twice, for text that was damaged twice.
        fixed = let(let(let(value, _entities), _mojibake), _mojibake)
        fixed = let(fixed, _typography)
        return F.when(F.rlike(value, F.lit(_SUSPECT)), _controls(_line_ends(fixed))).otherwise(value)

    return let(text, mend)
