from satchel.functions import sql
from tests.conftest import zip_of


def test_functions_in_sql(spark, make_files):
    sql.register(spark)
    inner = zip_of([("in.txt", "inner")])
    make_files(("z", zip_of([("inner.zip", inner), ("a.pdf", "%PDF-1.4")])), ("t", b"text"), ("g", b"\x1f\x8bx")).createOrReplaceTempView("inbox")
    types = spark.sql("SELECT file_id, detect_type(content) AS kind, type_extension(detect_type(content)) AS ext FROM inbox").collect()
    assert {tuple(r) for r in types} == {("z", "application/zip", ".zip"), ("t", "text/plain", ".txt"), ("g", "application/gzip", ".gz")}
    members = spark.sql("""
        SELECT file_id, name, depth, clean_type(detect_type(data)) AS kind
        FROM inbox, LATERAL unpack_archive(content, true) WHERE error IS NULL ORDER BY pos""").collect()
    assert [tuple(r) for r in members] == [("z", "a.pdf", 0, "application/pdf"), ("z", "in.txt", 1, "text/plain")]


def test_broken_archives_are_told(spark, make_files):
    sql.register(spark)
    inner = zip_of([("x", b"1")])[:-8]
    make_files(("broken", zip_of([("a", b"1")])[:30]), ("partly", zip_of([("a", b"1"), ("i.zip", inner)], stored=True))).createOrReplaceTempView("inbox")
    rows = spark.sql("SELECT file_id, name, error.class AS class FROM inbox, LATERAL unpack_archive(content, true)").collect()
    found = sorted((r.file_id, r.name, r["class"]) for r in rows if r.file_id == "broken" or r.name)
    assert ("partly", "a", None) in found and any(r[0] == "broken" and r[1] is None and r[2] for r in found)
    assert any(r.file_id == "partly" and r["class"] for r in rows)
