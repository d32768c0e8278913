"""Reading archive bytes inside a Spark task.

Only what Catalyst cannot do sits here: decompressing members and following nested archives.  Naming, routing,
permissions, types, fragments and lineage are column expressions over the rows this produces.
"""

from __future__ import annotations

import bz2
import gzip
import hashlib
import io
import lzma
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from functools import partial
from typing import BinaryIO, NamedTuple

from satchel.functions import magic

SNIFF_BYTES = 4096
PIECE_BYTES = 2**18
MAX_CELL_BYTES = 2**31 - 2**20
NESTED_HOLD_BYTES = 32 * 2**20
NESTED_MEMORY_BYTES = 2**29
ZIP_HEADER = "<4s5H3L2H"  # of a file in a zip
# Device numbers, as tar writers leave them where there are none, and the beginning of an empty prefix.
NO_DEVICE = (bytes(17), (b"0" * 7 + b"\0") * 2 + b"\0")


class WalkError(Exception):
    """An archive that could not be walked to its end; ``code`` is one of the error codes of ``satchel.schema``."""

    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code


class BudgetError(WalkError):
    """A breach of the size budget, which no sub-archive policy may swallow."""


class StorageFault(Exception):
    """Bytes that could not be fetched; says nothing about the archive, so the task fails and Spark tries it again."""


# What the readers raise for bytes that are no proper archive.
FORMAT_ERRORS = (
    WalkError, zipfile.BadZipFile, tarfile.TarError, zlib.error, lzma.LZMAError, struct.error, EOFError, OSError, ValueError,
    KeyError, IndexError, NotImplementedError, RuntimeError, OverflowError,
)


class Member(NamedTuple):
    name: str
    size: int
    is_dir: bool
    mode: int | None
    owner: str | None
    grp: str | None
    mtime: int | None
    at: int | None
    open: Callable[[], BinaryIO]


class Entry(NamedTuple):
    """A file of an archive.

    ``size`` is what the archive says; ``data`` are its first bytes, at most a chunk of them, and ``rest`` gives the chunks
    behind it and must be used up before the walk goes on.  ``kind`` is its full type, where that was asked for; ``at`` is
    where a walk of the same archive can begin to meet this file first, None where it has to begin at the start.
    """

    name: str
    size: int
    depth: int
    container: str
    mode: int | None
    owner: str | None
    grp: str | None
    mtime: int | None
    kind: str | None
    data: bytes | None
    rest: Iterator[bytes]
    at: int | None = None


class WalkOptions(NamedTuple):
    """``admit(size)`` says whether an entry may still be read and may raise ``BudgetError``.

    ``wants()`` is asked once per file, in order: whether its bytes are needed; None: they never are.  Of a file that is
    not wanted no more is read than its type takes, if ``types`` are needed; with ``whole`` it is read to its end all the
    same, without being kept, so that damage shows.  ``sub_failed(error)`` hears of an error inside a nested archive and
    may raise it; otherwise the walk goes on.
    """

    recursive: bool
    admit: Callable[[int], bool]
    sub_failed: Callable[[WalkError], None]
    wants: Callable[[], bool] | None
    types: bool = False
    whole: bool = False
    chunk: int = MAX_CELL_BYTES


def sound_zip_data(archive: zipfile.ZipFile, info: zipfile.ZipInfo, end: int) -> bytes | None:
    """A small file of a zip in memory, read at once; None where anything is not plainly as the directory says, which is
    left to the standard reader.  ``end`` is where the next file begins."""
    if info.file_size > PIECE_BYTES or info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) or info.flag_bits & ~0x80E:
        return None
    view, at = memoryview(archive.fp.getvalue()), info.header_offset
    try:
        mark, *_, named, extra = struct.unpack_from(ZIP_HEADER, view, at)
        at += struct.calcsize(ZIP_HEADER)
        name = bytes(view[at : at + named]).decode("utf-8" if info.flag_bits & 0x800 else "cp437")
        start = at + named + extra
        packed = view[start : start + info.compress_size]
        if mark != b"PK\3\4" or name != info.orig_filename or start + info.compress_size > end:
            return None
        if info.compress_type == zipfile.ZIP_STORED:
            data, whole = bytes(packed), True
        else:
            inflate = zlib.decompressobj(-15)
            data = inflate.decompress(packed, info.file_size + 1)
            whole = inflate.eof
    except (struct.error, zlib.error, ValueError):
        return None
    return data if whole and len(data) == info.file_size and zlib.crc32(data) == info.CRC else None


def open_zip_member(archive: zipfile.ZipFile, info: zipfile.ZipInfo, end: int | None) -> BinaryIO:
    if info.flag_bits & 1:
        raise WalkError("ENCRYPTED", "encrypted or password protected archive entry")
    data = None if end is None else sound_zip_data(archive, info, end)
    return archive.open(info) if data is None else io.BytesIO(data)


def zip_members(source: BinaryIO, start: int = 0) -> Iterator[Member]:
    """``start`` counts entries of the directory, which names them all and where they lie."""
    archive = zipfile.ZipFile(source)
    infos, ends = archive.infolist(), {}
    if isinstance(source, io.BytesIO):
        offsets = sorted([*(info.header_offset for info in infos), archive.start_dir], reverse=True)
        ends = dict(zip(offsets[1:], offsets))
    for at, info in enumerate(infos[start:], start):
        reader = partial(open_zip_member, archive, info, ends.get(info.header_offset))
        yield Member(info.filename, info.file_size, info.is_dir(), None, None, None, None, at, reader)


class StrictTarInfo(tarfile.TarInfo):
    """Reports a header that is cut off or damaged, where the standard reader takes it for the end of the archive."""

    @classmethod
    def fromtarfile(cls, archive: tarfile.TarFile) -> tarfile.TarInfo:
        try:
            return super().fromtarfile(archive)
        except (tarfile.InvalidHeaderError, tarfile.TruncatedHeaderError) as exc:
            raise tarfile.ReadError(str(exc)) from exc


def tar_data(view: memoryview, at: int, size: int) -> BinaryIO:
    data = view[at : at + size]
    if len(data) < size:
        raise tarfile.ReadError("unexpected end of data")
    return io.BytesIO(data)


def open_tar_member(archive: tarfile.TarFile, info: tarfile.TarInfo) -> BinaryIO:
    # links and devices carry no bytes of their own and must not be followed
    if not info.isreg():
        return io.BytesIO()
    if isinstance(archive.fileobj, io.BytesIO) and not info.issparse():
        return tar_data(memoryview(archive.fileobj.getvalue()), info.offset_data, info.size)
    return archive.extractfile(info)


def plain_tar_member(view: memoryview, at: int) -> Member | None:
    """The member whose header is at this offset of a tar in memory; None where it is not plainly a file or a folder,
    which is left to the standard reader."""
    header = bytes(view[at : at + tarfile.BLOCKSIZE])
    kind = header[156:157]
    if len(header) < tarfile.BLOCKSIZE or kind not in (tarfile.REGTYPE, tarfile.DIRTYPE):
        return None
    if header[257:262] != b"ustar" or header[329:346] not in NO_DEVICE:
        return None
    try:
        mode, _, _, size, mtime, total = (
            int(header[a:b].split(b"\0", 1)[0].strip() or b"0", 8)
            for a, b in ((100, 108), (108, 116), (116, 124), (124, 136), (136, 148), (148, 156))
        )
    except ValueError:
        return None
    is_dir = kind == tarfile.DIRTYPE
    if size < 0 or (is_dir and size) or total != sum(header) - sum(header[148:156]) + 256:
        return None
    name, owner, grp = (
        header[a:b].split(b"\0", 1)[0].decode(tarfile.ENCODING, "surrogateescape") for a, b in ((0, 100), (265, 297), (297, 329))
    )
    reader = partial(tar_data, view, at + tarfile.BLOCKSIZE, size)
    return Member(name.rstrip("/") if is_dir else name, size, is_dir, mode, owner, grp, mtime, at, reader)


def tar_members(source: BinaryIO, start: int = 0) -> Iterator[Member]:
    """``start`` is the offset of a header, in a tar that is not compressed.

    Of a tar in memory plain headers are read here; from the first other one on the standard reader goes on.
    """
    if isinstance(source, io.BytesIO):
        view = memoryview(source.getvalue())  # of the same bytes, not a copy
        while member := plain_tar_member(view, start):
            yield member
            start += tarfile.BLOCKSIZE + -(-member.size // tarfile.BLOCKSIZE) * tarfile.BLOCKSIZE
            if start > len(view):
                raise tarfile.ReadError("unexpected end of data")
        if start and view[start : start + tarfile.BLOCKSIZE] == bytes(tarfile.BLOCKSIZE):
            return
    source.seek(start)
    archive = tarfile.open(fileobj=source, mode="r:" if start else "r:*", tarinfo=StrictTarInfo)
    for info in archive:
        archive.members.clear()  # else every header seen stays in memory
        size = info.size if info.isreg() else 0
        # a compressed tar has no such offset, and a header for all files behind it must not be missed
        at = info.offset if archive.fileobj is source and not archive.pax_headers else None
        reader = partial(open_tar_member, archive, info)
        yield Member(info.name, size, info.isdir(), info.mode, info.uname, info.gname, int(info.mtime), at, reader)


def pieces(stream: BinaryIO) -> Iterator[bytes]:
    """What is left of a stream, a short piece first: mostly that tells the type."""
    size = SNIFF_BYTES
    while piece := stream.read(size):
        yield piece
        size = PIECE_BYTES


def holds_tar(mime: str, source: BinaryIO) -> bool:
    """Whether a compressed stream decompresses to a tar; a lone compressed file is not an archive."""
    decoder = {"application/gzip": gzip.open, "application/x-bzip2": bz2.open, "application/x-xz": lzma.open}
    try:
        return magic.tell([decoder[mime](source).read(magic.HEAD_BYTES)]) in magic.TAR_TYPES
    except (OSError, EOFError, zlib.error, lzma.LZMAError):
        return False


def member_reader(source: BinaryIO) -> Callable[[BinaryIO, int], Iterator[Member]] | None:
    """How to list the archive that ``source`` is, or None when it is no archive we open."""
    source.seek(0)
    mime = magic.tell(pieces(source))
    source.seek(0)
    if mime in magic.ZIP_TYPES:
        return zip_members
    tar = mime in magic.TAR_TYPES or (mime in magic.TAR_STREAM_TYPES and holds_tar(mime, source))
    source.seek(0)
    return tar_members if tar else None


def is_nested(kind: str, member: Member) -> bool:
    if kind in magic.TAR_STREAM_TYPES:
        with member.open() as stream:
            return holds_tar(kind, stream)
    return kind in magic.ZIP_TYPES + magic.TAR_TYPES


def chunks(stream: BinaryIO, held: list[bytes], size: int) -> Iterator[bytes]:
    """``held`` and what is left of ``stream`` in chunks of ``size``; nothing for an empty file."""
    data = b"".join(held)
    while True:
        for at in range(0, len(data) - size + 1, size):
            yield data[at : at + size]
        data = data[len(data) // size * size :]
        more = stream.read(size - len(data))
        if not more:
            if data:
                yield data
            return
        data += more


def read_member(member: Member, options: WalkOptions, place: tuple, room: int) -> Iterator[Entry | bytes | None]:
    """One ``Entry``, or of an archive to descend into its bytes, None if they are more than ``room``."""
    wanted = options.wants() if options.wants and not options.recursive else False
    telling = options.recursive or options.types
    if not (wanted or telling or options.whole):
        yield Entry(*place, None, None, iter(()), member.at)
        return
    with member.open() as stream:
        teller, held, size = magic.Teller(), [], 0
        for piece in pieces(stream) if telling else ():
            teller.feed(piece)
            # unless all bytes are needed anyway, only a short beginning is kept
            if wanted or (options.recursive and (options.wants or not size)):
                held.append(piece)
            size += len(piece)
            if teller.kind is not None:
                break
        kind = teller.finish() if telling else None
        if options.recursive:
            if is_nested(kind, member):
                yield b"".join(held) + stream.read() if member.size <= room and sum(map(len, held)) == size else None
                return
            wanted = bool(options.wants and options.wants())
        if wanted:
            rest = chunks(stream, held, options.chunk)
            yield Entry(*place, kind, next(rest, b""), rest, member.at)
            for _ in rest:
                pass
        else:
            held.clear()
            while options.whole and stream.read(PIECE_BYTES):
                pass
            yield Entry(*place, kind, None, iter(()), member.at)


def own_files(
    source: BinaryIO, options: WalkOptions, depth: int, container: str, nested: list[tuple[Member, bytes | None]], start: int = 0
) -> Iterator[Entry]:
    """The files of one archive in its order; the archives in it are put into ``nested``."""
    reader = member_reader(source)
    if reader is None:
        raise WalkError("NOT_AN_ARCHIVE", "not an archive or not a supported archive")
    room = NESTED_HOLD_BYTES
    for member in reader(source, start):
        if member.is_dir or not options.admit(member.size):
            continue
        place = (member.name, member.size, depth, container, *member[3:7])
        for found in read_member(member, options, place, room):
            if isinstance(found, Entry):
                yield found
            else:
                # few bytes are kept at hand, the rest is read again when its turn comes
                room -= len(found or b"")
                nested.append((member, found))


def opened(member: Member, data: bytes | None) -> tuple[BinaryIO, bytes]:
    """A nested archive and its digest; one too large for memory is read where it lies."""
    if data is None:
        stream = member.open()
        if member.size > NESTED_MEMORY_BYTES:
            digest = hashlib.sha256()
            for piece in pieces(stream):
                digest.update(piece)
            return stream, digest.digest()
        with stream:
            data = stream.read()
    return io.BytesIO(data), hashlib.sha256(data).digest()


def walk(source: BinaryIO, options: WalkOptions, start: int = 0) -> Iterator[Entry]:
    """The files of an archive: its own in archive order, then those of each nested archive by the same rule.

    With ``start``, the ``at`` of one of its own files, the walk begins there; only where nothing is recursive.

    A nested archive is tested against the budget like any entry, yet is never an entry of its own.  What came out of
    it before an error stays delivered.  Archives may lie in one another to any depth, but not in themselves.
    """
    nested: list[tuple[Member, bytes | None]] = []
    yield from own_files(source, options, 0, "", nested, start)
    levels = [(iter(nested), "", frozenset())]
    while levels:
        waiting, container, around = levels[-1]
        member, data = next(waiting, (None, None))
        if member is None:
            levels.pop()
            continue
        inside, path = [], f"{container}{member.name}/"
        try:
            inner, digest = opened(member, data)
            if digest in around:
                raise WalkError("CORRUPT", "an archive lies inside itself")
            yield from own_files(inner, options, len(levels), path, inside)
        except BudgetError:
            raise
        except FORMAT_ERRORS as exc:
            options.sub_failed(as_walk_error(exc))
            continue
        levels.append((iter(inside), path, around | {digest}))


def as_walk_error(exc: Exception) -> WalkError:
    return exc if isinstance(exc, WalkError) else WalkError("CORRUPT", f"{type(exc).__name__}: {exc}")
