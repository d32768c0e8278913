"""The Python stages over archive rows: Arrow batches in, bounded Arrow batches out."""

from __future__ import annotations

import hashlib
import io
import sys
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from satchel.functions import magic, walker

FLUSH_BYTES = 32 * 2**20
FLUSH_ROWS = 10_000
HOLD_BYTES = 64 * 2**20
ENTRY_BYTES = 256  # of a file besides its bytes, while held

PLACE_COLUMNS = {
    "pos": pa.int64(), "name": pa.string(), "size": pa.int64(), "depth": pa.int32(), "container": pa.string(),
    "mode": pa.int32(), "owner": pa.string(), "grp": pa.string(), "mtime_s": pa.int64(), "entry_kind": pa.string(),
}
DATA_COLUMNS = {"chunk_index": pa.int32(), "chunks_sha256": pa.string(), "data": pa.binary()}
ENTRY_COLUMNS = PLACE_COLUMNS | DATA_COLUMNS
TALLY_COLUMNS = {
    "n_unpacked": pa.int64(), "unpack_bytes": pa.int64(), "threshold_breached": pa.bool_(), "sub_errors": pa.int64(),
    "error_class": pa.string(), "error_message": pa.string(),
}
READ_AHEAD_BYTES = 2**20


class UnpackOptions(NamedTuple):
    """``emit``: ``all`` rows, ``parents`` or ``children``; without ``with_data`` files come without their bytes."""

    recursive: bool
    budget: int
    fail_on_breach: bool
    fail_on_sub_error: bool
    emit: str = "all"
    with_data: bool = True
    chunk: int = walker.MAX_CELL_BYTES

    @property
    def columns(self) -> dict[str, pa.DataType]:
        if self.emit == "parents":
            return {"pos": pa.int64()}
        return ENTRY_COLUMNS if self.with_data else PLACE_COLUMNS


class Tally:
    """Running totals of one archive: the size budget, swallowed sub-archive errors and the error that ended it."""

    def __init__(self, options: UnpackOptions):
        self.options = options
        self.files = 0
        self.bytes = 0
        self.breached = False
        self.sub_errors = 0
        self.error: walker.WalkError | None = None

    def admit(self, size: int) -> bool:
        if self.options.budget == -1 or size + self.bytes <= self.options.budget:
            return True
        self.breached = True
        if self.options.fail_on_breach:
            raise walker.BudgetError("SIZE_BUDGET", "unpack size budget reached, the archive holds more data than allowed")
        return False

    def sub_failed(self, exc: walker.WalkError) -> None:
        if self.options.fail_on_sub_error:
            raise exc
        self.sub_errors += 1

    def entries(
        self, source: BinaryIO, first: int = 0, start: int = 0, data: bool = True, types: bool = True, whole: bool = False
    ) -> Iterator[tuple[int, walker.Entry]]:
        """Positions and files in order, without the ``first`` ones, of which no byte is read that can be passed over.

        ``start`` is where the walk may begin.  With ``whole``, files whose bytes are not needed are read to their end all
        the same, so that damage shows.
        """
        def wants() -> bool:
            return self.files >= first

        options = walker.WalkOptions(
            self.options.recursive, self.admit, self.sub_failed, wants if data else None, types and self.options.recursive,
            whole, self.options.chunk,
        )
        try:
            for entry in walker.walk(source, options, start):
                delivered = wants()
                self.files += 1
                self.bytes += entry.size
                if delivered:
                    yield self.files, entry
        except walker.FORMAT_ERRORS as exc:
            self.error = walker.as_walk_error(exc)

    def row(self) -> tuple:
        error = (None, None) if self.error is None else (self.error.code, str(self.error))
        return (self.files, self.bytes, self.breached, self.sub_errors, *error)


def entry_rows(pos: int, entry: walker.Entry, with_data: bool) -> Iterator[tuple]:
    """A row for each chunk of a file, the last one with a digest over all; mostly there is one, without a digest."""
    place = (pos, *entry[:9])
    if not with_data:
        yield place
        return
    digest, last, index = None, entry.data, 0
    for chunk in entry.rest:
        digest = digest or hashlib.sha256()
        digest.update(last)
        yield (*place, index, None, last)
        last, index = chunk, index + 1
    if digest is not None:
        digest.update(last)
    yield (*place, index, digest and digest.hexdigest(), last)


def archive_rows(
    source: BinaryIO, options: UnpackOptions, chosen: Callable[[walker.Entry], bool] | None = None
) -> Iterator[tuple]:
    """The parent row, then the child rows if and only if the walk came to its end; of these only the ``chosen``.

    What was read is kept for the second half up to ``HOLD_BYTES``; an archive that expands further, or has a file of more
    than one chunk, is read again, so memory stays bounded without a budget too.
    """
    tally = Tally(options)
    children = options.emit != "parents"
    held: list | None = [] if children else None
    size = 0
    for pos, entry in tally.entries(source, data=children and options.with_data, types=children, whole=True):
        if chosen and not chosen(entry):
            continue
        size += ENTRY_BYTES + len(entry.data or b"")
        if held is not None:
            rows = list(islice(entry_rows(pos, entry, options.with_data), 2))
            held += rows
            held = held if size <= HOLD_BYTES and len(rows) == 1 else None
    totals = tally.row()
    nothing = (None,) * len(options.columns)
    if options.emit != "children":
        yield nothing + totals
    if tally.error is None and children:
        if held is not None:
            yield from (row + totals for row in held)
            return
        source.seek(0)
        again = Tally(options)
        for pos, entry in again.entries(source, data=options.with_data):
            if chosen and not chosen(entry):
                continue
            yield from (row + totals for row in entry_rows(pos, entry, options.with_data))
        if again.error is not None:
            # it was whole a moment ago: let Spark try the task again
            raise again.error


def unpack_batches(batches: Iterable[pa.RecordBatch], options: UnpackOptions) -> Iterator[pa.RecordBatch]:
    """Parent and child rows for archives held in ``_content``; NULL there gives a bare parent row."""
    for batch in batches:
        content = batch.column("_content")

        def produce(i: int) -> Iterator[tuple]:
            if content[i].is_valid:
                return archive_rows(io.BytesIO(content[i].as_py()), options)
            if options.emit == "children":
                return iter(())
            return iter([(None,) * len(options.columns) + Tally(options).row()])

        yield from bounded_batches(batch.drop_columns(["_content"]), produce, options.columns | TALLY_COLUMNS)


def bounded_batches(
    kept: pa.RecordBatch, produce: Callable[[int], Iterator[tuple]], kinds: dict[str, pa.DataType]
) -> Iterator[pa.RecordBatch]:
    """The rows produced for each input row behind its carried columns, never many bytes in one batch."""
    picked: list[int] = []
    rows: list[tuple] = []
    pending = 0
    data_at = list(kinds).index("data") if "data" in kinds else None
    # carried columns are copied into every row
    carried = kept.nbytes // max(kept.num_rows, 1)
    for i in range(kept.num_rows):
        for row in produce(i):
            size = carried + (len(row[data_at] or b"") if data_at is not None else 0)
            if rows and (pending + size > FLUSH_BYTES or len(rows) >= FLUSH_ROWS):
                yield output_batch(kept, picked, rows, kinds)
                picked, rows, pending = [], [], 0
            picked.append(i)
            rows.append(row)
            pending += size
    if rows:
        yield output_batch(kept, picked, rows, kinds)


def output_batch(
    kept: pa.RecordBatch, picked: list[int], rows: list[tuple], kinds: dict[str, pa.DataType]
) -> pa.RecordBatch:
    carried = kept.take(pa.array(picked, pa.int64()))
    added = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds.values())]
    return pa.RecordBatch.from_arrays(carried.columns + added, names=carried.schema.names + list(kinds))


class SearchOptions(NamedTuple):
    recursive: bool
    fail_on_sub_error: bool
    types: frozenset[str]


def first_match(source: BinaryIO, options: SearchOptions) -> tuple[str | None, walker.WalkError | None]:
    """The type of the first file of one of the types, without its parameters; nothing is read behind that file, and of
    each file before it only what its type takes, or all of a small one in a zip.  An error counts only where no match came first."""
    def sub_failed(exc: walker.WalkError) -> None:
        if options.fail_on_sub_error:
            raise exc

    walking = walker.WalkOptions(options.recursive, lambda size: True, sub_failed, None, types=bool(options.types))
    try:
        for entry in walker.walk(source, walking):
            kind = (entry.kind or "").split(";")[0]
            if kind in options.types:
                return kind, None
    except walker.FORMAT_ERRORS as exc:
        return None, walker.as_walk_error(exc)
    return None, None


SEARCH_COLUMNS = {"found_mime": pa.string(), "_error_class": pa.string(), "_error_message": pa.string()}


def search_batches(batches: Iterable[pa.RecordBatch], options: SearchOptions) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        content = batch.column("_content")
        rows = []
        for i in range(batch.num_rows):
            found, error = first_match(io.BytesIO(content[i].as_py()), options) if content[i].is_valid else (None, None)
            rows.append((found, None, None) if error is None else (None, error.code, str(error)))
        if rows:
            yield output_batch(batch.drop_columns(["_content"]), list(range(len(rows))), rows, SEARCH_COLUMNS)


# what lies before a part, and where a walk that meets its first file begins
CUT_FIELDS = {"files": pa.int64(), "bytes": pa.int64(), "start": pa.int64()}
KIND_COLUMNS = {"_kind": pa.string(), "_cuts": pa.list_(pa.struct(list(CUT_FIELDS.items())))}


class RemoteFile(io.RawIOBase):
    """An Arrow file as Python's readers expect one; a seek before the beginning is an ``OSError`` to them."""

    def __init__(self, file: pa.NativeFile):
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        try:
            return self._file.readinto(buffer)
        except OSError as exc:
            raise walker.StorageFault(str(exc)) from exc

    def tell(self) -> int:
        try:
            return self._file.tell()
        except OSError as exc:
            raise walker.StorageFault(str(exc)) from exc

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        try:
            start = (0, self._file.tell(), self._file.size())[whence]
            if start + offset >= 0:
                return self._file.seek(start + offset)
        except OSError as exc:
            raise walker.StorageFault(str(exc)) from exc
        raise OSError("seek before the beginning of the file")

    def close(self) -> None:
        self._file.close()
        super().close()


def as_uri(path: str) -> str:
    """A path as Spark writes it, as Arrow takes it."""
    return "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path


def remote_source(path: str) -> BinaryIO:
    """A seekable file on whatever filesystem the path names, so an archive may be larger than a row can hold.

    One no larger than what is read ahead anyway is read at once.
    """
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(as_uri(path))
    try:
        file = filesystem.open_input_file(inner)
        if file.size() <= READ_AHEAD_BYTES:
            with file:
                return io.BytesIO(file.read())
    except FileNotFoundError:
        raise
    except OSError as exc:
        raise walker.StorageFault(str(exc)) from exc
    return io.BufferedReader(RemoteFile(file), READ_AHEAD_BYTES)


def tally_batches(batches: Iterable[pa.RecordBatch], options: UnpackOptions, part_bytes: int) -> Iterator[pa.RecordBatch]:
    """Walks the archives at ``_path`` to their end without keeping their files: totals, verdict, type and parts."""
    for batch in batches:
        rows = []
        for path in batch.column("_path").to_pylist():
            tally, kind, cuts = Tally(options), None, [(0, 0, 0)]
            try:
                with remote_source(path) as source:
                    kind = magic.tell(walker.pieces(source))
                    source.seek(0)
                    for pos, entry in tally.entries(source, data=False, types=False, whole=True):
                        before = tally.bytes - entry.size
                        if before >= cuts[-1][1] + part_bytes:
                            cuts.append((pos - 1, before, 0 if options.recursive else entry.at or 0))
            except FileNotFoundError as exc:
                tally.error = walker.WalkError("UNREADABLE", str(exc))
            except walker.FORMAT_ERRORS as exc:
                tally.error = walker.as_walk_error(exc)
            rows.append((*tally.row(), kind, [dict(zip(CUT_FIELDS, cut, strict=True)) for cut in cuts]))
        yield output_batch(batch, list(range(batch.num_rows)), rows, TALLY_COLUMNS | KIND_COLUMNS)


def part_rows(source: BinaryIO, options: UnpackOptions, first: int, counted: int, start: int, to: int) -> Iterator[tuple]:
    """The rows of the files behind the ``first`` ones, which take ``counted`` bytes, up to the ``to``-th."""
    tally = Tally(options)
    if start:
        tally.files, tally.bytes = first, counted
    for pos, entry in tally.entries(source, first, start, data=options.with_data):
        yield from entry_rows(pos, entry, options.with_data)
        if pos >= to:
            return
    if tally.error is not None:
        # it was whole a moment ago: let Spark try the task again
        raise tally.error


def part_batches(batches: Iterable[pa.RecordBatch], options: UnpackOptions) -> Iterator[pa.RecordBatch]:
    """The files of one part of the archive at ``_path``; the first part also gives the parent row.

    Rows of parts that lie side by side are read in one walk, so many small parts do not open their archive each.
    """
    for batch in batches:
        path, part, cut, to, good = (batch.column(c).to_pylist() for c in PART_COLUMNS)
        kept = batch.drop_columns(PART_COLUMNS)

        def goes_on(i: int) -> bool:
            """Whether a part is the one behind the part in the row before, of the same row of the input."""
            same = 0 < i < len(part) and part[i] == part[i - 1] + 1 and path[i] == path[i - 1]
            return same and kept.slice(i, 1).equals(kept.slice(i - 1, 1))

        def produce(i: int) -> Iterator[tuple]:
            if part[i] == 0 and options.emit != "children":
                yield (None,) * len(options.columns)
            if good[i] and options.emit != "parents" and not goes_on(i):
                last = i
                while goes_on(last + 1):
                    last += 1
                with remote_source(path[i]) as source:
                    yield from part_rows(source, options, *cut[i].values(), to[last])

        yield from bounded_batches(kept, produce, options.columns)


def subfolders(count: int) -> list[str]:
    """Names of subfolders that files are dealt out to; with an equals sign, as readers of folders go into no others."""
    return [f"hash={i:03x}" for i in range(count)]


def write_batches(batches: Iterable[pa.RecordBatch], folder: str, folders: int = 0) -> Iterator[pa.RecordBatch]:
    """Writes ``content`` to ``filename`` in the folder; a task that runs again puts the same file in the same place."""
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(as_uri(folder))
    places = [f"{inner}/{name}" for name in subfolders(folders)] or [inner]
    for batch in batches:
        names, content = batch.column("filename").to_pylist(), batch.column("content")
        for name, data in zip(names, content, strict=True):
            place = places[zlib.crc32(str(name).encode()) % len(places)]
            unfinished = f"{place}/.{uuid.uuid4().hex}"
            with filesystem.open_output_stream(unfinished) as out:
                out.write(data.as_buffer() if data.is_valid else b"")
            filesystem.move(unfinished, f"{place}/{name}")
        yield pa.RecordBatch.from_pydict({"filename": pa.array(names, pa.string())})


def passed_over(name: str) -> bool:
    """Whether Spark's readers take a file or folder of this name for none of the data."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def listing(filesystem, folder: str, whole: bool) -> Iterator[tuple]:
    """Files and folders in a folder; with ``whole`` the files at any depth that lie in one named ``key=value``.

    As for Spark's readers, files without a byte are none.
    """
    from pyarrow import fs

    own = folder.rstrip("/")
    for info in filesystem.get_file_info(fs.FileSelector(folder, recursive=whole)):
        *between, name = info.path.removeprefix(f"{own}/").split("/")
        if any(map(passed_over, (*between, name))):
            continue
        modified = info.mtime_ns and info.mtime_ns // 10**6
        if info.type == fs.FileType.Directory:
            if not whole:
                yield info.path, modified, None
        elif info.type == fs.FileType.File and info.size > 0:
            if not whole or any("=" in x for x in (own.rpartition("/")[2], *between)):
                yield info.path, modified, info.size


def place_of(root: str) -> tuple:
    """The filesystem of a folder, the folder's path there, and what paths there lack of those that Spark writes."""
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(as_uri(root))
    return filesystem, inner, root.rstrip("/").removesuffix(inner.rstrip("/"))


def list_batches(batches: Iterable[pa.RecordBatch], root: str, whole: bool) -> Iterator[pa.RecordBatch]:
    """Rows of ``path, mtime_ms, length``, at ``root`` or below it: files as they are, and for each folder, which has no
    length, its ``listing``."""
    filesystem, _, prefix = place_of(root)
    for batch in batches:
        is_file = batch.column("length").is_valid()
        yield batch.filter(is_file)
        for path in batch.filter(pc.invert(is_file)).column("path").to_pylist():
            found = listing(filesystem, path.removeprefix(prefix), whole)
            while rows := list(islice(found, FLUSH_ROWS)):
                paths, *rest = zip(*rows)
                columns = [[prefix + x for x in paths], *rest]
                arrays = [pa.array(values, kind) for values, kind in zip(columns, batch.schema.types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)


PART_COLUMNS = ["_path", "_part", "_cut", "_to", "_good"]

# the reading code travels with the tasks, so executors need no installed copy of this package
for _module in ("satchel.functions.magic", "satchel.functions.walker", __name__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])
