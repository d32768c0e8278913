"""File-type rules as data: which bytes at which offsets mean which type.

A rule is ``(type, extension, parts, needle)``.  Every part ``(offset, hex)`` must be present and, where a needle is
given, the file must also contain that text somewhere.  Rules are tried from top to bottom; the first that holds wins.
The same table is a constant in Catalyst expressions (``functions.mime``), and ``Teller`` follows it piece by piece for the
archive walker, which reads no more of a file than its type takes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

OCTET_STREAM = "application/octet-stream"
TEXT_PLAIN = "text/plain"
ZIP_MAGIC = "504B0304"


class Rule(NamedTuple):
    mime: str
    ext: str
    parts: tuple[tuple[int, str], ...]
    needle: str | None = None


def _ascii(text: str) -> str:
    return text.encode("latin-1").hex().upper()


def _zip_first_entry(name: str) -> tuple[tuple[int, str], ...]:
    """A zip whose first local header carries an entry name starting with ``name`` (names begin at byte 30)."""
    return ((0, ZIP_MAGIC), (30, _ascii(name)))


_OOXML = "application/vnd.openxmlformats-officedocument."
_ODF = "application/vnd.oasis.opendocument."

# Published magic numbers, media types and usual file extensions.
RULES: tuple[Rule, ...] = (
    # documents and packages that live in a zip container
    Rule(_OOXML + "wordprocessingml.document", ".docx", _zip_first_entry("[Content_Types].xml"), "word/document.xml"),
    Rule(_OOXML + "spreadsheetml.sheet", ".xlsx", _zip_first_entry("[Content_Types].xml"), "xl/workbook.xml"),
    Rule("application/vnd.ms-excel.sheet.binary.macroenabled.12", ".xlsb", _zip_first_entry("[Content_Types].xml"), "xl/workbook.bin"),
    Rule(_OOXML + "presentationml.presentation", ".pptx", _zip_first_entry("[Content_Types].xml"), "ppt/presentation.xml"),
    Rule(_ODF + "text", ".odt", _zip_first_entry("mimetype" + _ODF + "text")),
    Rule(_ODF + "spreadsheet", ".ods", _zip_first_entry("mimetype" + _ODF + "spreadsheet")),
    Rule(_ODF + "presentation", ".odp", _zip_first_entry("mimetype" + _ODF + "presentation")),
    Rule("application/epub+zip", ".epub", _zip_first_entry("mimetypeapplication/epub+zip")),
    Rule("application/java-archive", ".jar", _zip_first_entry("META-INF/")),
    # archives and compressed streams
    Rule("application/zip", ".zip", ((0, ZIP_MAGIC),)),
    Rule("application/zip", ".zip", ((0, "504B0506"),)),
    Rule("application/zip", ".zip", ((0, "504B0708"),)),
    Rule("application/gzip", ".tgz", ((0, "1F8B"),)),
    Rule("application/x-bzip2", ".bz2", ((0, "425A68"),)),
    Rule("application/x-xz", ".xz", ((0, "FD377A585A00"),)),
    Rule("application/zstd", ".zst", ((0, "28B52FFD"),)),
    Rule("application/x-lz4", ".lz4", ((0, "04224D18"),)),
    Rule("application/x-lzip", ".lz", ((0, "4C5A495001"),)),
    Rule("application/x-compress", ".z", ((0, "1F9D"),)),
    Rule("application/x-snappy-framed", ".sz", ((0, "FF060000734E61507059"),)),
    Rule("application/x-7z-compressed", ".7z", ((0, "377ABCAF271C"),)),
    Rule("application/x-rar-compressed; version=4", "", ((0, "526172211A0700"),)),
    Rule("application/x-rar-compressed; version=5", "", ((0, "526172211A070100"),)),
    Rule("application/x-tar", ".tar", ((257, "7573746172"),)),
    Rule("application/x-cpio", ".cpio", ((0, _ascii("070701")),)),
    Rule("application/x-cpio", ".cpio", ((0, _ascii("070707")),)),
    Rule("application/x-debian-package", ".deb", ((0, _ascii("!<arch>\ndebian")),)),
    Rule("application/x-archive", ".ar", ((0, _ascii("!<arch>\n")),)),
    Rule("application/x-rpm", ".rpm", ((0, "EDABEEDB"),)),
    Rule("application/vnd.ms-cab-compressed", ".cab", ((0, _ascii("MSCF")),)),
    # documents
    Rule("application/pdf", ".pdf", ((0, _ascii("%PDF-")),)),
    Rule("application/postscript", ".ps", ((0, _ascii("%!PS")),)),
    Rule("application/rtf", ".rtf", ((0, _ascii("{\\rtf")),)),
    Rule("application/x-ole-storage", "", ((0, "D0CF11E0A1B11AE1"),)),
    Rule("image/vnd.djvu", ".djvu", ((0, _ascii("AT&TFORM")),)),
    # images
    Rule("image/png", ".png", ((0, "89504E470D0A1A0A"),)),
    Rule("image/jpeg", ".jpg", ((0, "FFD8FF"),)),
    Rule("image/gif", ".gif", ((0, _ascii("GIF87a")),)),
    Rule("image/gif", ".gif", ((0, _ascii("GIF89a")),)),
    Rule("image/tiff", ".tiff", ((0, "49492A00"),)),
    Rule("image/tiff", ".tiff", ((0, "4D4D002A"),)),
    Rule("image/webp", ".webp", ((0, _ascii("RIFF")), (8, _ascii("WEBP")))),
    Rule("image/bmp", ".bmp", ((0, _ascii("BM")), (6, "00000000"))),
    Rule("image/vnd.microsoft.icon", ".ico", ((0, "00000100"),)),
    Rule("image/vnd.adobe.photoshop", ".psd", ((0, _ascii("8BPS")),)),
    Rule("image/heic", ".heic", ((4, _ascii("ftypheic")),)),
    Rule("image/avif", ".avif", ((4, _ascii("ftypavif")),)),
    Rule("image/jp2", ".jp2", ((0, "0000000C6A5020200D0A"),)),
    # audio and video
    Rule("audio/mpeg", ".mp3", ((0, _ascii("ID3")),)),
    Rule("audio/x-flac", ".flac", ((0, _ascii("fLaC")),)),
    Rule("audio/vnd.wave", ".wav", ((0, _ascii("RIFF")), (8, _ascii("WAVE")))),
    Rule("audio/midi", ".mid", ((0, _ascii("MThd")),)),
    Rule("audio/amr", ".amr", ((0, _ascii("#!AMR")),)),
    Rule("application/ogg", ".ogx", ((0, _ascii("OggS")),)),
    Rule("video/x-msvideo", ".avi", ((0, _ascii("RIFF")), (8, _ascii("AVI ")))),
    Rule("video/quicktime", ".qt", ((4, _ascii("ftypqt")),)),
    Rule("video/quicktime", ".qt", ((4, _ascii("moov")),)),
    Rule("audio/mp4", ".m4a", ((4, _ascii("ftypM4A")),)),
    Rule("video/mp4", ".mp4", ((4, _ascii("ftyp")),)),
    Rule("application/x-matroska", ".mkv", ((0, "1A45DFA3"),)),
    Rule("video/x-flv", ".flv", ((0, _ascii("FLV\x01")),)),
    Rule("video/mpeg", ".mpeg", ((0, "000001BA"),)),
    Rule("video/mpeg", ".mpeg", ((0, "000001B3"),)),
    Rule("video/x-ms-asf", ".asf", ((0, "3026B2758E66CF11"),)),
    Rule("application/x-shockwave-flash", ".swf", ((0, _ascii("FWS")), (3, "0A"))),
    # programs
    Rule("application/x-elf", "", ((0, "7F454C46"),)),
    Rule("application/x-msdownload", ".exe", ((0, _ascii("MZ")), (3, "00"))),
    Rule("application/java-vm", ".class", ((0, "CAFEBABE"),)),
    Rule("application/x-mach-o", "", ((0, "CFFAEDFE"),)),
    Rule("application/wasm", ".wasm", ((0, "0061736D"),)),
    # data
    Rule("application/x-sqlite3", ".sqlite", ((0, _ascii("SQLite format 3\x00")),)),
    Rule("application/x-parquet", ".parquet", ((0, _ascii("PAR1")),)),
    Rule("application/x-orc", ".orc", ((0, _ascii("ORC")), (3, "0A"))),
    Rule("application/avro", ".avro", ((0, _ascii("Obj\x01")),)),
    Rule("application/x-arrow-file", ".arrow", ((0, _ascii("ARROW1")),)),
    Rule("application/x-hdf", ".hdf", ((0, "894844460D0A1A0A"),)),
    Rule("application/x-netcdf", ".nc", ((0, _ascii("CDF\x01")),)),
    Rule("application/vnd.tcpdump.pcap", ".pcap", ((0, "D4C3B2A1"),)),
    Rule("application/vnd.tcpdump.pcap", ".pcap", ((0, "A1B2C3D4"),)),
    Rule("application/dicom", ".dcm", ((128, _ascii("DICM")),)),
    Rule("application/x-bittorrent", ".torrent", ((0, _ascii("d8:announce")),)),
    # fonts
    Rule("font/woff", ".woff", ((0, _ascii("wOFF")),)),
    Rule("font/woff2", ".woff2", ((0, _ascii("wOF2")),)),
    Rule("font/otf", ".otf", ((0, _ascii("OTTO")),)),
    Rule("font/ttf", ".ttf", ((0, "0001000000"),)),
    # text that says its width by a byte order mark
    Rule(TEXT_PLAIN, ".txt", ((0, "FEFF"),)),
    Rule(TEXT_PLAIN, ".txt", ((0, "FFFE"),)),
    # structured text with a fixed beginning
    Rule("application/x-x509-cert; format=pem", "", ((0, _ascii("-----BEGIN CERTIFICATE")),)),
    Rule("application/pgp-encrypted", ".pgp", ((0, _ascii("-----BEGIN PGP MESSAGE-")),)),
    Rule("text/calendar", ".ics", ((0, _ascii("BEGIN:VCALENDAR")),)),
    Rule("text/x-vcard", ".vcf", ((0, _ascii("BEGIN:VCARD")),)),
    Rule("application/x-sh", ".sh", ((0, _ascii("#!/bin/sh")),)),
    Rule("application/x-sh", ".sh", ((0, _ascii("#!/bin/bash")),)),
)

# Types that are told apart by their text rather than by magic bytes.
TEXT_EXTENSIONS = (
    ("text/html", ".html"),
    ("application/xhtml+xml", ".xhtml"),
    ("image/svg+xml", ".svg"),
    ("application/rss+xml", ".rss"),
    ("application/atom+xml", ".atom"),
    ("application/xml", ".xml"),
    ("text/plain", ".txt"),
    ("application/x-rar-compressed", ".rar"),
)

# How many leading bytes decide a type, given the offsets above and the window of the text tests.
TEXT_WINDOW = 512
HEAD_BYTES = 512

# What the archive walker opens, and what it only recognises.
ZIP_TYPES = ("application/zip", "application/java-archive")
TAR_TYPES = ("application/x-tar",)
TAR_STREAM_TYPES = ("application/gzip", "application/x-bzip2", "application/x-xz")
ARCHIVE_TYPES = ZIP_TYPES + TAR_TYPES + TAR_STREAM_TYPES
UNREADABLE_ARCHIVE_TYPES = (
    "application/x-7z-compressed",
    "application/x-rar-compressed",
    "application/x-cpio",
    "application/x-archive",
    "application/vnd.ms-cab-compressed",
)


class Teller:
    """Tells the type of a file fed to it in pieces, in memory that does not grow; ``kind`` is None until it is certain.

    The same rules as ``functions.mime.detect``.  Magic bytes and the text test need the head.  A rule with a needle goes on
    looking for it, and a file that begins with a tag is read on until its prolog and comments, however long, are over.
    """

    def __init__(self):
        self.kind: str | None = None
        self._head: bytes | None = b""  # None once it has been looked at
        self._needles: list[tuple[Rule, bytes]] = []
        self._fallback = OCTET_STREAM
        self._tail = b""
        self._markup: Markup | None = None

    def feed(self, piece: bytes) -> None:
        if self.kind is not None or not piece:
            return
        if self._head is not None:
            self._head += piece
            if len(self._head) < HEAD_BYTES:
                return
            piece, self._head = self._head, None
            self._begin(piece)
        if self.kind is None:
            self._go_on(piece)

    def finish(self) -> str:
        """The type of what was fed, if that was all."""
        if self.kind is None and self._head:
            piece, self._head = self._head, None
            self._begin(piece)
            if self.kind is None:
                self._go_on(piece)
        if self.kind is None:
            end = self._markup.finish() if self._markup else None
            self.kind = end or self._fallback
        return self.kind

    def _begin(self, head: bytes) -> None:
        for rule, (offset, magic), others in _BY_FIRST_BYTE[head[0]]:
            if head.startswith(magic, offset) and all(head.startswith(m, at) for at, m in others):
                if rule.needle is None:
                    self._fallback = rule.mime
                    break
                self._needles.append((rule, rule.needle.encode()))
        else:
            self._fallback = TEXT_PLAIN if is_text(head[:TEXT_WINDOW]) else OCTET_STREAM
            if not self._needles and _MAY_BE_MARKUP.match(head):
                self._markup = Markup()
        if not self._needles and self._markup is None:
            self.kind = self._fallback

    def _go_on(self, piece: bytes) -> None:
        if self._markup is not None:
            told = self._markup.feed(piece)
            if told is not None:
                self.kind = told or self._fallback
            return
        piece = self._tail + piece
        for at, (rule, needle) in enumerate(self._needles):
            if needle in piece:
                # those behind it no longer matter, those before it still win if they show up
                self._needles, self._fallback = self._needles[:at], rule.mime
                break
        if not self._needles:
            self.kind = self._fallback
        else:
            self._tail = piece[1 - max(len(needle) for _, needle in self._needles) :]


class Markup:
    """HTML and XML by how a text begins: white space and comments, a declaration, a document type, then the root.

    ``feed`` gives a type, ``""`` when the text is none of them, and None while that is open.
    """

    def __init__(self):
        self._text, self._at_start, self._until = b"", True, b""
        self._declared = False  # begins with an XML declaration
        self._first = True  # only white space and comments so far

    def feed(self, piece: bytes) -> str | None:
        self._text += piece
        while True:
            if self._at_start:
                if len(self._text) < len(BOM) and BOM.startswith(self._text):
                    return None
                self._text, self._at_start = self._text.removeprefix(BOM), False
            if self._until:
                end = self._text.find(self._until)
                if end < 0:
                    self._text = self._text[1 - len(self._until) :] if len(self._until) > 1 else b""
                    return None
                self._text, self._until = self._text[end + len(self._until) :], b""
            self._text = self._text.lstrip(SPACES)
            low = self._text[:LONGEST_TAG].lower()
            if low.startswith(b"<!--"):
                self._text, self._until = self._text[4:], b"-->"
            elif low.startswith(b"<?xml") and (len(low) > 5 or not self._first):
                if self._first:
                    self._declared = low[5:6] in SPACE_BYTES
                self._first, self._text, self._until = False, self._text[5:], b"?>"
            elif low.startswith(b"<!doctype"):
                if self._first:
                    name = self._text[9:]
                    rest = name.lstrip(SPACES)
                    if len(rest) < 5 and b">" not in rest:
                        # white space before the name says no more than one blank
                        self._text = self._text[:9] + name[:1] + rest if name != rest else self._text
                        return None
                    if name != rest and _HTML_NAME.match(rest):
                        return HTML
                self._first, self._text, self._until = False, self._text[9:], b">"
            elif len(low) < LONGEST_TAG and not any(c in low[1:] for c in b"> \t\r\n\x0b\x0c"):
                return None if not low or low.startswith(b"<") else self._none()
            else:
                return self._root(low)

    def _root(self, low: bytes) -> str:
        found = _TAG.match(low)
        name = found.group(1) if found else b""
        if self._declared and name == b"html":
            return XHTML
        if self._first and name in HTML_STARTS:
            return HTML
        return ROOTS.get(name) or self._none()

    def _none(self) -> str:
        return XML if self._declared else ""

    def finish(self) -> str:
        return self._none()


# How markup begins.
BOM = b"\xef\xbb\xbf"
SPACES = b" \t\r\n\x0b\x0c"
SPACE_BYTES = tuple(SPACES[i : i + 1] for i in range(len(SPACES)))
LONGEST_TAG = 10
HTML, XHTML, XML = "text/html", "application/xhtml+xml", "application/xml"
HTML_STARTS = (b"html", b"head", b"body", b"title", b"h1")
ROOTS = {b"svg": "image/svg+xml", b"rss": "application/rss+xml", b"feed": "application/atom+xml"}
_HTML_NAME = re.compile(rb"html[\s>]", re.IGNORECASE)
_TAG = re.compile(rb"<([a-z0-9]+)[\s>]")
_MAY_BE_MARKUP = re.compile(rb"(?:\xef\xbb\xbf)?\s*(?:<|\Z)")
_CONTROLS = re.compile(rb"[\x00-\x08\x0B\x0E-\x1A\x1C-\x1F]")
_CUT_OFF = re.compile(rb"[\xC0-\xFF][\x80-\xBF]{0,2}\Z")


def is_text(window: bytes) -> bool:
    """No control bytes other than tab, line ends, form feed and escape, and the rest is UTF-8 or mostly ASCII."""
    if _CONTROLS.search(window):
        return False
    try:
        _CUT_OFF.sub(b"", window).decode()
        return True
    except UnicodeDecodeError:
        return 10 * len(window.translate(None, bytes(range(128)))) < len(window)


def tell(pieces: Iterable[bytes]) -> str:
    """The full type of the bytes that come in ``pieces``, reading no further than it takes."""
    teller = Teller()
    for piece in pieces:
        teller.feed(piece)
        if teller.kind is not None:
            break
    return teller.finish()


def may_start_with(rule: Rule, byte: int) -> bool:
    offset, magic = rule.parts[0]
    return offset > 0 or bytes.fromhex(magic)[0] == byte


def _spelled(rule: Rule) -> tuple:
    first, *others = ((offset, bytes.fromhex(magic)) for offset, magic in rule.parts)
    return rule, first, others


_BY_FIRST_BYTE = tuple(tuple(_spelled(rule) for rule in RULES if may_start_with(rule, byte)) for byte in range(256))
