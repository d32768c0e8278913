import io
import sys
import tarfile
import zipfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from satchel.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_files(spark):
    def make(*rows):
        """Rows of ``(file_id, content)`` or ``(file_id, filename, content)``."""
        full = [row if len(row) == 3 else (row[0], row[0], row[1]) for row in rows]
        return spark.createDataFrame(full, "file_id string, filename string, content binary")

    return make


def zip_of(members, stored=False):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED) as archive:
        for name, data in members:
            archive.writestr(name, data)
    return out.getvalue()


def tar_of(members, kind="w", **fields):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=kind) as archive:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            info.type = tarfile.DIRTYPE if name.endswith("/") else tarfile.REGTYPE
            for field, value in fields.items():
                setattr(info, field, value)
            archive.addfile(info, io.BytesIO(data))
    return out.getvalue()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
