"""Plain archives in memory are read without the standard readers, with the same files and the same verdicts."""

import io
import random
import tarfile
import zipfile

import pytest

from satchel.functions import archive_tasks, walker
from satchel.sources import samples

FILES = [("é/", b""), ("é/line-0.txt", b"one"), ("line-1.txt", b""), ("a//sub/line-2.txt", b"three\n" * 900), ("/line-3.txt", bytes(range(256)))]
OPTIONS = archive_tasks.UnpackOptions(True, -1, True, False)


def standard_zip(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, data in members:
            archive.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), data, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def standard_tar(members, archive_id):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=tarfile.GNU_FORMAT) as archive:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            info.type = tarfile.DIRTYPE if name.endswith("/") else tarfile.REGTYPE
            info.mode, info.mtime = samples.MODES[archive_id // 2 % 4], samples.BASE_TIME + archive_id
            info.uname, info.gname = f"user{archive_id % 7}", f"group{archive_id % 3}"
            archive.addfile(info, io.BytesIO(data))
    return out.getvalue()


def rows(data):
    return list(archive_tasks.archive_rows(io.BytesIO(data), OPTIONS))


def refuse(*args, **kwargs):
    raise AssertionError("read by the standard reader")


def test_samples_are_what_the_standard_writers_give():
    long = [("x" * 99, b"1"), ("y" * 100, b"2"), ("z" * 101, b"3")]
    assert samples.pack_zip(FILES + long) == standard_zip(FILES + long)
    for archive_id in range(9):
        ours, theirs = samples.pack_tar(FILES + long, archive_id), standard_tar(FILES + long, archive_id)
        assert theirs.startswith(ours) and not theirs[len(ours) :].strip(b"\0")


def test_no_standard_reader_for_plain_archives(monkeypatch):
    tar = samples.pack_tar([*FILES, ("inner.zip", samples.pack_zip(FILES))], 3)
    want = rows(tar), rows(samples.pack_zip([*FILES, ("deep.tar", tar)]))
    monkeypatch.setattr(tarfile, "open", refuse)
    monkeypatch.setattr(zipfile.ZipFile, "open", refuse)
    assert (rows(tar), rows(samples.pack_zip([*FILES, ("deep.tar", tar)]))) == want
    assert len(want[0]) == 9 and want[0][0][-2:] == (None, None)


@pytest.mark.parametrize("pack", [samples.pack_zip, lambda files: samples.pack_tar(files, 5)])
def test_damage_is_told_as_the_standard_readers_tell_it(monkeypatch, pack):
    draw, whole = random.Random(2), pack(FILES)
    damaged = [whole[: draw.randrange(len(whole))] for _ in range(60)]
    for _ in range(400):
        bad = bytearray(whole)
        at = draw.randrange(len(bad))
        bad[at // 512 * 512 + draw.randrange(350) if draw.random() < 0.5 and at // 512 * 512 + 350 < len(bad) else at] ^= 1 << draw.randrange(8)
        damaged.append(bytes(bad))
    ours = [rows(x) for x in damaged]
    monkeypatch.setattr(walker, "plain_tar_member", lambda view, at: None)
    monkeypatch.setattr(walker, "sound_zip_data", lambda archive, info, end: None)
    assert ours == [rows(x) for x in damaged]
