"""Partitions of the archive source."""

from satchel.functions import archive_tasks
from satchel.sources import archive_source

OPTIONS = archive_tasks.UnpackOptions(False, -1, True, True)


def test_few_large_parts_are_still_many_partitions(tmp_path):
    for i in range(24):
        (tmp_path / f"{i}.tar").write_bytes(bytes(2**20))
    chosen = archive_source.Chosen("*", 0, -1)
    reader = archive_source.ArchiveReader(str(tmp_path), OPTIONS, chosen, 256 * 2**20, "*")
    parts = reader.partitions()
    assert len(parts) == 6 and sorted(p for x in parts for p in x.paths) == sorted(map(str, tmp_path.iterdir()))
    small = archive_source.ArchiveReader(str(tmp_path), OPTIONS, chosen, 2**20, "*").partitions()
    assert len(small) == 24
