"""Text extraction and its limits as native expressions."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that do not break a word, and those whose content is not shown.
INLINE = (
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
)
NOT_SHOWN = ("script", "style", "noscript", "title", "template")
# Names of the character set that bytes are read in when they are no UTF-8, and its characters from 80 to 9F
# where they are others than the control characters there.
WESTERN = ("iso-8859-1", "iso8859-1", "latin1", "l1", "windows-1252", "cp1252", "x-cp1252", "us-ascii", "ascii")
WESTERN_HIGH = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰", 0x8A: "Š", 0x8B: "‹",
    0x8C: "Œ", 0x8E: "Ž", 0x91: "‘", 0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—", 0x98: "˜", 0x99: "™",
    0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}

# Loops are possessive: such a loop is run in place, any other goes a level deeper with every turn.
# a quote matters only behind an equals sign; one that is never closed does not
_REST = r"""(?:=\s*"[^"]*+"|=\s*'[^']*+'|[^>=]++|=)*+>"""
_TAG = rf"</?[a-z][^\s/>=]*+{_REST}"  # a lone "smaller than" is text
_INLINE = rf"</?(?:{'|'.join(INLINE)})(?=[\s/>]){_REST}"
_COMMENT = r"<!--.*?(?:-->|\z)"
_DECLARATION = r"<[!?][^>]*+>"
# each ends only with its own name
_HIDDEN = rf"<({'|'.join(NOT_SHOWN)})(?=[\s/>]){_REST}.*?(?:</\1\s*>|\z)"
_BEFORE_BODY = rf"(?is)^(?:{_COMMENT}|{_HIDDEN}|[^<]++|<(?!body[\s/>]))*+<body(?=[\s/>]){_REST}"
_CDATA = r"<!\[CDATA\[.*?\]\]>"
_DOCTYPE = r"<!DOCTYPE[^>\[]*+(?:\[.*?\]\s*+)?>"
_XML_TOKEN = rf"(?is){_COMMENT}|{_CDATA}|{_DOCTYPE}|{_DECLARATION}|{_TAG}|[^<]++|<"
_REFERENCE = r"(?s)&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});|[^&]++|&"
# a run of white space that is not already one blank
_SPACE = r"[\t\r\n][ \t\r\n]*| [ \t\r\n]+"
_DECLARED = r"""(?is)^(?:\s*<\?xml[^>]*?\sencoding\s*=\s*["']|.*?<meta\s[^>]*?charset\s*=\s*["']?\s*)([a-z0-9_:.-]+)"""


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _western(content: Column) -> Column:
    return F.translate(F.decode(content, "ISO-8859-1"), "".join(map(chr, WESTERN_HIGH)), "".join(WESTERN_HIGH.values()))


def _utf16(content: Column, big: bool) -> Column:
    """Halves of a pair without the other half, and an odd last byte, become U+FFFD; the decoder would fail on them."""
    high, low, any_half = r"[\xD8-\xDB]", r"[\xDC-\xDF]", r"[\xD8-\xDF]"
    if big:
        whole, lone, mark = rf"[^\xD8-\xDF].|{high}.{low}.", rf"{any_half}.|.\z", "\u00ff\u00fd"
    else:
        whole, lone, mark = rf".[^\xD8-\xDF]|.{high}.{low}", rf".{any_half}|.\z", "\u00fd\u00ff"
    latin = F.regexp_replace(F.decode(content, "ISO-8859-1"), rf"(?s)\G((?:{whole})*+)(?:{lone})", f"$1{mark}")
    return F.decode(F.encode(latin, "ISO-8859-1"), "UTF-16BE" if big else "UTF-16LE")


def decode(content: Column, markup: Column | None = None) -> Column:
    """Bytes as text, in the character set they are in; a byte order mark tells it and goes.

    Without a mark it is the Western one where ``markup`` declares that, else UTF-8, unless more of what is not ASCII is no
    UTF-8 than is; then the Western one.  Bytes that are no UTF-8 become U+FFFD.
    """
    mark = F.substring(content, 1, 2)
    behind = F.substring(content, F.lit(3), F.length(content))

    def by_validity(text: Column) -> Column:
        broken = F.length(F.regexp_replace(text, "[^\ufffd]+", ""))
        high = F.length(F.regexp_replace(text, "[\\x00-\\x7F]+", ""))
        return F.when(2 * broken <= high, text).otherwise(_western(content))

    def told(text: Column) -> Column:
        western = F.lit(False)
        if markup is not None:  # what is all ASCII is the same in either set
            head = F.decode(F.substring(content, 1, 1024), "ISO-8859-1")
            declared = F.lower(F.regexp_extract(head, _DECLARED, 1)).isin(*WESTERN)
            western = markup & (F.octet_length(text) != F.char_length(text)) & ~text.startswith("\ufeff") & declared
        return (
            F.when(F.is_valid_utf8(text) & ~western, F.when(text.startswith("\ufeff"), F.substring(text, F.lit(2), F.length(text))).otherwise(text))
            .when(mark == F.unhex(F.lit("FEFF")), _utf16(behind, True))
            .when(mark == F.unhex(F.lit("FFFE")), _utf16(behind, False))
            .when(F.substring(content, 1, 3) == F.unhex(F.lit("EFBBBF")), F.substring(F.make_valid_utf8(text), F.lit(2), F.length(text)))
            .when(western, _western(content))
            .otherwise(_with(F.make_valid_utf8(text), by_validity))
        )

    return _with(content.cast("string"), told)


def _character(code: Column) -> Column:
    """The character of a code point; what is none becomes U+FFFD, and a blank that does not break is a blank."""
    known = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
    point = F.when(known, code).otherwise(F.lit(0xFFFD))
    found = F.decode(F.unhex(F.lpad(F.hex(point.cast("long")), 8, "0")), "UTF-32")
    return F.translate(found, "\u00a0" + "".join(map(chr, WESTERN_HIGH)), " " + "".join(WESTERN_HIGH.values()))


def _references(text: Column, names: dict[str, str]) -> Column:
    """Numeric references and those of ``names`` as the characters they stand for; others stay."""
    known = F.from_json(F.lit(json.dumps(names)), "map<string,string>")

    def resolved(piece: Column) -> Column:
        inside = F.substring(piece, F.lit(3), F.length(piece) - 3)
        digits = F.when(F.lower(F.substring(inside, 1, 1)) == "x", F.conv(F.substring(inside, F.lit(2), F.length(inside)), 16, 10))
        name = F.try_element_at(known, F.substring(piece, F.lit(2), F.length(piece) - 2))
        return (
            F.when(~piece.startswith("&") | (piece == "&"), piece)
            .when(piece.startswith("&#"), _character(digits.otherwise(inside).cast("int")))
            .otherwise(F.coalesce(name, piece))
        )

    usual = [name for name in USUAL if name in names]
    unusual = rf"&(?!(?:{'|'.join(usual)}|amp);)[#a-zA-Z]"

    def replaced(t: Column) -> Column:
        for name in usual:
            t = F.replace(t, F.lit(f"&{name};"), F.lit(names[name]))
        return F.replace(t, F.lit("&amp;"), F.lit("&"))  # the last, so that nothing is resolved twice

    def whole(t: Column) -> Column:
        pieces = F.regexp_extract_all(t, F.lit(_REFERENCE), F.lit(0))
        each = F.concat_ws("", F.transform(pieces, resolved))
        return F.when(~t.contains("&"), t).when(t.rlike(unusual), each).otherwise(replaced(t))

    return _with(text, whole)


# names that whole texts are searched for at once; any other reference is looked up by itself
USUAL = ("lt", "gt", "quot", "apos", "nbsp", "copy", "middot")
XML_NAMES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}
# the published names, of which the blank that does not break is a blank here
HTML_NAMES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'", "nbsp": " "}


def _collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _SPACE, " "))


def html_text(html: Column) -> Column:
    """The text of an HTML body, or of all that is shown where there is none.

    Comments and elements within a line leave no trace, any other tag is a break between words, and runs of white space
    become one blank.
    """
    shown = F.regexp_replace(html, _BEFORE_BODY, "")
    shown = F.regexp_replace(shown, rf"(?is){_COMMENT}|{_HIDDEN}|{_INLINE}|{_DECLARATION}|({_TAG})", "$2")
    return _collapsed(_references(F.regexp_replace(shown, rf"(?is){_TAG}", " "), HTML_NAMES))


def xml_text(xml: Column) -> Column:
    """The character data of an XML document; every tag is a break, and what a CDATA section holds is taken as it is."""
    def told(token: Column) -> Column:
        return (
            F.when(token.startswith("<![CDATA["), F.substring(token, F.lit(10), F.length(token) - 12))
            .when(token.startswith("<!--"), "")
            .when(token.rlike("(?s)^<."), " ")
            .otherwise(_references(token, XML_NAMES))
        )

    return _collapsed(F.concat_ws("", F.transform(F.regexp_extract_all(xml, F.lit(_XML_TOKEN), F.lit(0)), told)))


def cut_chars(text: Column, limit: int) -> Column:
    return text if limit == -1 else F.when(F.length(text) > limit, F.substring(text, 1, limit)).otherwise(text)


def cut_bytes(text: Column, limit: int) -> Column:
    """The longest run of whole characters whose UTF-8 form fits ``limit`` bytes.

    Departure from the original semantics, on purpose: exact, where an estimate from the first character's width was
    used.  The cut lands in a character when the byte after it continues one; at most three bytes then go too.
    """
    if limit == -1:
        return text
    data = F.encode(text, "UTF-8")

    def continues(position: int) -> Column:
        # only positions inside the text are asked for; 0 and below start a character
        byte = F.conv(F.hex(F.substring(data, position + 1, 1)), 16, 10).cast("int")
        return byte.bitwiseAND(0xC0) == 0x80 if position > 0 else F.lit(False)

    keep = F.when(~continues(limit), limit)
    for back in (1, 2):
        keep = keep.when(~continues(limit - back), limit - back)
    whole = F.substring(data, F.lit(1), keep.otherwise(max(limit - 3, 0)).cast("int")).cast("string")
    return F.when(F.octet_length(text) > limit, whole).otherwise(text)


def estimated_bytes(text: Column) -> Column:
    """The size of the text if every character took as many bytes as the first one."""
    return F.octet_length(F.substring(text, 1, 1)) * F.length(text)


def cut_estimated_bytes(text: Column, limit: int) -> Column:
    """The byte limit by that estimate: as many characters of the first one's width as fit."""
    if limit == -1:
        return text
    allowed = F.floor(F.lit(limit) / F.octet_length(F.substring(text, 1, 1))).cast("int")
    return F.when(estimated_bytes(text) > limit, F.substring(text, F.lit(1), allowed)).otherwise(text)


def limit_kind(text: Column, max_chars: int, max_bytes: int, exact: bool = True) -> Column:
    """Which limit the text breaks: ``bytes`` is reported before ``chars``, NULL when both hold."""
    kind = F.lit(None).cast("string")
    if max_chars != -1:
        kind = F.when(F.length(text) > max_chars, "chars")
    if max_bytes != -1:
        size = F.octet_length(text) if exact else estimated_bytes(text)
        kind = F.when(size > max_bytes, "bytes").otherwise(kind)
    return kind


def limit_message(kind: Column, max_chars: int, max_bytes: int) -> Column:
    shown = F.when(kind == "bytes", f"{max_bytes} bytes").otherwise(f"{max_chars} characters")
    return F.concat(F.lit("the document holds more text than the limit of "), shown)
