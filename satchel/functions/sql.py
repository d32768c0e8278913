"""The functions for use in Spark SQL text."""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from satchel.functions import mime, walker


class UnpackArchive:
    """``unpack_archive(content, recursive)``: one row per file inside, and one row with only ``error`` per error.

    An archive that cannot be read to its end gives no file.  An error inside a nested archive ends only that one.  The
    archive is walked twice, so that nothing is given out before it is known to be whole and nothing is held.
    """

    def eval(self, content: bytes, recursive: bool) -> Iterator[tuple]:
        if content is None:
            return
        source = io.BytesIO(bytes(content))
        errors: list[walker.WalkError] = []
        checking = walker.WalkOptions(bool(recursive), lambda size: True, errors.append, None, whole=True)
        whole = True
        try:
            for _ in walker.walk(source, checking):
                pass
        except walker.FORMAT_ERRORS as exc:
            errors, whole = [walker.as_walk_error(exc)], False
        for error in list(errors):
            yield None, None, None, None, None, None, (error.code, str(error))
        if whole:
            reading = checking._replace(wants=lambda: True, whole=False)
            for pos, entry in enumerate(walker.walk(source, reading), start=1):
                yield pos, entry.name, entry.size, entry.depth, entry.container, entry.data, None


def register(spark: SparkSession) -> None:
    """Makes ``detect_type``, ``type_extension``, ``clean_type`` and the table function ``unpack_archive`` known.

    The scalar ones are SQL functions, which the optimizer inlines.
    """
    known = ", ".join(f"'{kind}', '{ext}'" for kind, ext in mime.known_extensions().items())
    bodies = {
        "detect_type(content BINARY)": mime.detect_sql("content"),
        "clean_type(mime STRING)": "substring_index(mime, ';', 1)",
        "type_extension(mime STRING)": f"""CASE WHEN mime = 'application/gzip' THEN '.gz'
            ELSE coalesce(try_element_at(map({known}), mime), '') END""",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS STRING RETURN {body}")
    kinds = "pos long, name string, size long, depth int, container string, data binary, error struct<class:string,message:string>"
    table_function = F.udtf(UnpackArchive, returnType=kinds)
    spark.udtf.register("unpack_archive", table_function)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
