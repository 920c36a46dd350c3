"""Text predicates and cleaning steps.

Every public step maps null, empty and whitespace-only input to ``""``. The
``_raw`` forms skip that guard; ``clean_text`` chains them, which gives the same
result because the closing whitespace step turns any blank remainder into
``""``. All patterns are written so that the matcher does work linear in the
length of the text, also on long unbroken runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiloom.functions.binding import let
from lexiloom.functions.repair import repair_raw

# The characters that count as whitespace. The outer ranges of a
# class are tested first and turn most characters away in two comparisons.
_MEMBERS_HEAD = r"\t-\r\x1c-\x1f"
_MEMBERS_TAIL = r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_OUTER = r"\x00-\x20\x{85}-\x{3000}"
SPACE = rf"[{_OUTER}&&[{_MEMBERS_HEAD}\x20{_MEMBERS_TAIL}]]"
SPACE_BUT_BLANK = rf"[{_OUTER}&&[{_MEMBERS_HEAD}{_MEMBERS_TAIL}]]"
SPACE_IN_LINE = rf"[{_OUTER}&&[\t\x0b-\r\x1c-\x20{_MEMBERS_TAIL}]]"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# First line that is neither blank nor "Word-word: ...", and all after it.
_BODY = rf"(?md)^(?!{SPACE_IN_LINE}*+(?:[A-Za-z\-]++:[^\n]*+)?$)(?s:.*)"
_QUOTED_LINE = rf"\n{SPACE_IN_LINE}*+>[^\n]*+"
_SIGNATURE = rf"\n{SPACE_IN_LINE}*+--{SPACE_IN_LINE}*+(?:\n(?s:.*))?\z"
_TAG = r"<[^>]++>"
_URL = rf"https?://[^{SPACE}]++|www\.[^{SPACE}]++"
# A whole token with an @ after its first character and, at least two further
# on, a dot that is not its last character. Tokens are entered from the
# whitespace before them, which spares a lookbehind at every position, and the
# inner classes are intersections, which match much faster than negated unions.
_EMAIL = (
    rf"({SPACE})[^{SPACE}][[^{SPACE}]&&[^@]]*+@"
    rf"[^{SPACE}][[^{SPACE}]&&[^.]]*+\.[^{SPACE}]++"
)
# A lone plain blank is already normal, so only other runs are rewritten.
_RUN = rf"{SPACE}(?:(?<!\x20){SPACE}*+|{SPACE}++)"

# Emoji code points of the Unicode emoji data file.
_PICTURE = (
    r"\x{a9}\x{ae}\x{203c}\x{2049}\x{2122}\x{2139}\x{2194}-\x{2199}\x{21a9}\x{21aa}"
    r"\x{231a}\x{231b}\x{2328}\x{23cf}\x{23e9}-\x{23f3}\x{23f8}-\x{23fa}\x{24c2}"
    r"\x{25aa}\x{25ab}\x{25b6}\x{25c0}\x{25fb}-\x{25fe}\x{2600}-\x{2604}\x{260e}"
    r"\x{2611}\x{2614}\x{2615}\x{2618}\x{261d}\x{2620}\x{2622}\x{2623}\x{2626}\x{262a}"
    r"\x{262e}\x{262f}\x{2638}-\x{263a}\x{2640}\x{2642}\x{2648}-\x{2653}\x{265f}\x{2660}"
    r"\x{2663}\x{2665}\x{2666}\x{2668}\x{267b}\x{267e}\x{267f}\x{2692}-\x{2697}\x{2699}"
    r"\x{269b}\x{269c}\x{26a0}\x{26a1}\x{26a7}\x{26aa}\x{26ab}\x{26b0}\x{26b1}\x{26bd}\x{26be}"
    r"\x{26c4}\x{26c5}\x{26c8}\x{26ce}\x{26cf}\x{26d1}\x{26d3}\x{26d4}\x{26e9}\x{26ea}"
    r"\x{26f0}-\x{26f5}\x{26f7}-\x{26fa}\x{26fd}\x{2702}\x{2705}\x{2708}-\x{270d}\x{270f}"
    r"\x{2712}\x{2714}\x{2716}\x{271d}\x{2721}\x{2728}\x{2733}\x{2734}\x{2744}\x{2747}"
    r"\x{274c}\x{274e}\x{2753}-\x{2755}\x{2757}\x{2763}\x{2764}\x{2795}-\x{2797}\x{27a1}"
    r"\x{27b0}\x{27bf}\x{2934}\x{2935}\x{2b05}-\x{2b07}\x{2b1b}\x{2b1c}\x{2b50}\x{2b55}"
    r"\x{3030}\x{303d}\x{3297}\x{3299}\x{1f004}\x{1f0cf}\x{1f170}\x{1f171}\x{1f17e}\x{1f17f}"
    r"\x{1f18e}\x{1f191}-\x{1f19a}\x{1f201}\x{1f202}\x{1f21a}\x{1f22f}\x{1f232}-\x{1f23a}"
    r"\x{1f250}\x{1f251}\x{1f300}-\x{1f321}\x{1f324}-\x{1f393}\x{1f396}\x{1f397}"
    r"\x{1f399}-\x{1f39b}\x{1f39e}-\x{1f3f0}\x{1f3f3}-\x{1f3f5}\x{1f3f7}-\x{1f4fd}"
    r"\x{1f4ff}-\x{1f53d}\x{1f549}-\x{1f54e}\x{1f550}-\x{1f567}\x{1f56f}\x{1f570}"
    r"\x{1f573}-\x{1f57a}\x{1f587}\x{1f58a}-\x{1f58d}\x{1f590}\x{1f595}\x{1f596}\x{1f5a4}"
    r"\x{1f5a5}\x{1f5a8}\x{1f5b1}\x{1f5b2}\x{1f5bc}\x{1f5c2}-\x{1f5c4}\x{1f5d1}-\x{1f5d3}"
    r"\x{1f5dc}-\x{1f5de}\x{1f5e1}\x{1f5e3}\x{1f5e8}\x{1f5ef}\x{1f5f3}\x{1f5fa}-\x{1f64f}"
    r"\x{1f680}-\x{1f6c5}\x{1f6cb}-\x{1f6d2}\x{1f6d5}-\x{1f6d7}\x{1f6dc}-\x{1f6e5}\x{1f6e9}"
    r"\x{1f6eb}\x{1f6ec}\x{1f6f0}\x{1f6f3}-\x{1f6fc}\x{1f7e0}-\x{1f7eb}\x{1f7f0}"
    r"\x{1f90c}-\x{1f93a}\x{1f93c}-\x{1f945}\x{1f947}-\x{1f9ff}\x{1fa70}-\x{1faff}"
)
_MODIFIER = r"\x{fe0f}\x{20e3}\x{1f3fb}-\x{1f3ff}\x{e0020}-\x{e007f}"
_OUTER_PICTURE = r"\x{a9}\x{ae}\x{203c}-\x{3299}\x{1f004}-\x{1faff}"
_PICTURE_CLASS = rf"[{_OUTER_PICTURE}&&[{_PICTURE}]]"
# One match per emoji: a flag pair, a keycap, or a picture with its modifiers
# and everything glued to it by zero-width joiners.
_EMOJI = (
    r"[\x{1f1e6}-\x{1f1ff}]{2}|[0-9#*]\x{fe0f}?\x{20e3}"
    rf"|{_PICTURE_CLASS}[{_MODIFIER}]*+(?:\x{{200d}}{_PICTURE_CLASS}[{_MODIFIER}]*+)*+"
)


def is_valid_text(text: Column) -> Column:
    """True when the text is not null and holds a non-whitespace character."""
    return F.coalesce(F.rlike(text, F.lit(f"[^{SPACE}]")), F.lit(False))


def strip(text: Column) -> Column:
    """Drop whitespace of any kind at both ends."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def _guarded(text: Column, cleaned: Column) -> Column:
    return F.when(is_valid_text(text), cleaned).otherwise(F.lit(""))


def _when(holds: Callable[[Column], Column], step: Callable[[Column], Column]):
    """A step that runs only on texts with a cheap sign of work to do."""
    return lambda text: let(text, lambda value: F.when(holds(value), step(value)).otherwise(value))


def _holds(part: str) -> Callable[[Column], Column]:
    return lambda value: F.contains(value, F.lit(part))


def _drop(pattern: str, by: str = " ") -> Callable[[Column], Column]:
    return lambda value: F.regexp_replace(value, pattern, by)


def _after_newline(pattern: str, by: str = "") -> Callable[[Column], Column]:
    # A leading newline makes every line and token, the first too, follow one.
    return lambda value: F.substring(
        F.regexp_replace(F.concat(F.lit("\n"), value), pattern, by), 2, 2**31 - 1
    )


def _headers_raw(text: Column) -> Column:
    return F.regexp_extract(text, _BODY, 0)


_quotes_raw = _when(_holds(">"), _after_newline(_QUOTED_LINE))
_signature_raw = _when(_holds("--"), _after_newline(_SIGNATURE))
_html_raw = _when(_holds("<"), _drop(_TAG))
_urls_raw = _when(lambda v: F.contains(v, F.lit("http")) | F.contains(v, F.lit("www.")), _drop(_URL))
_emails_raw = _when(_holds("@"), _after_newline(_EMAIL, "$1 "))
_emoji_raw = _when(lambda v: F.rlike(v, F.lit(f"[{_OUTER_PICTURE}]")), _drop(_EMOJI))


def _whitespace_raw(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _RUN, " "))


def fix_encoding(text: Column) -> Column:
    """Repair mis-decoded text, entities, curly quotes, line ends and controls."""
    return _guarded(text, repair_raw(text))


def strip_headers(text: Column) -> Column:
    """Drop the leading run of blank and ``Key: value`` lines."""
    return _guarded(text, _headers_raw(text))


def strip_quotes(text: Column) -> Column:
    """Drop lines whose first visible character is ``>``."""
    return _guarded(text, _quotes_raw(text))


def strip_signature(text: Column) -> Column:
    """Cut at the first line that holds only ``--``."""
    return _guarded(text, _signature_raw(text))


def strip_html(text: Column) -> Column:
    """Replace each tag by a blank."""
    return _guarded(text, _html_raw(text))


def strip_urls(text: Column) -> Column:
    """Replace http(s) and bare www links by a blank."""
    return _guarded(text, _urls_raw(text))


def strip_emails(text: Column) -> Column:
    """Replace each token shaped like an e-mail address by a blank."""
    return _guarded(text, _emails_raw(text))


def strip_emoji(text: Column) -> Column:
    """Replace each emoji by a blank."""
    return _guarded(text, _emoji_raw(text))


def normalize_whitespace(text: Column) -> Column:
    """Collapse whitespace runs to one blank and trim."""
    return _guarded(text, _whitespace_raw(text))


def clean_text(text: Column) -> Column:
    """All steps in order; null and blank input give ``""``."""
    cleaned = repair_raw(F.coalesce(text, F.lit("")))
    for step in (
        _headers_raw,
        _quotes_raw,
        _signature_raw,
        _html_raw,
        _urls_raw,
        _emails_raw,
        _emoji_raw,
        _whitespace_raw,
    ):
        cleaned = step(cleaned)
    return cleaned


def text_length(text: Column) -> Column:
    """Length in code points, 0 for null."""
    return F.coalesce(F.length(text), F.lit(0))


def has_encoding_issue(raw: Column) -> Column:
    """True when the bytes are not valid UTF-8; null counts as fine."""
    return F.coalesce(~F.is_valid_utf8(raw), F.lit(False))


def preview(text: Column, width: int = 100) -> Column:
    """First characters on one line."""
    return F.replace(F.substring(text, 1, width), F.lit("\n"), F.lit(" "))


def printable_ratio(text: Column) -> Column:
    """Share of letters, marks, numbers, punctuation, symbols and whitespace."""
    kept = F.length(F.regexp_replace(text, rf"[^\p{{L}}\p{{M}}\p{{N}}\p{{P}}\p{{S}}{SPACE}]", ""))
    return F.when(F.length(text) > 0, kept / F.length(text)).otherwise(F.lit(0.0))


def longest_token(text: Column) -> Column:
    """Length of the longest run without whitespace."""
    return F.coalesce(
        F.array_max(
            F.transform(F.split(text, f"{SPACE}+"), lambda token: F.length(token))
        ),
        F.lit(0),
    )


def looks_printable(text: Column, min_ratio: float = 0.9, max_token: int = 200) -> Column:
    """False for binary leftovers.

    Encoded attachments are printable ASCII, so a ratio alone misses them; they
    do come as very long unbroken tokens.
    """
    return is_valid_text(text) & (printable_ratio(text) >= min_ratio) & (longest_token(text) <= max_token)
