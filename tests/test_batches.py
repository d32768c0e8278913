"""What Python is handed at once is bounded by bytes, whatever the session leaves open."""

import pyarrow as pa
import pytest

from satchel.operators import contains, unpack
from satchel.session import BATCH_BYTES
from satchel.sources import files


def sizes(session):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})

    rows = session.range(0, 3000, 1, 1).selectExpr("cast(repeat(cast(id % 10 as string), 10000) as binary) AS content")
    return [tuple(r) for r in rows.mapInArrow(run, "n long, bytes long").collect()]


@pytest.mark.parametrize("use", ["unpack", "contains", "write"])
def test_batches_of_files_are_bounded_by_bytes(spark, tmp_path, use):
    session = spark.newSession()
    session.conf.unset(BATCH_BYTES)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    rows = session.createDataFrame([("a", "a.zip", bytearray(b"no archive"))], "file_id string, filename string, content binary")
    if use == "unpack":
        unpack.unpack(rows)
    elif use == "contains":
        contains.contains_type(rows, ["text/plain"])
    else:
        files.write_files(rows, str(tmp_path))
    found = sizes(session)
    assert sum(n for n, _ in found) == 3000 and max(b for _, b in found) < 5 * 2**20


def test_a_limit_of_the_session_stays(spark):
    session = spark.newSession()
    session.conf.set(BATCH_BYTES, "9MB")
    unpack.unpack(session.createDataFrame([("a", "a", bytearray())], "file_id string, filename string, content binary"))
    assert session.conf.get(BATCH_BYTES) == "9MB"
