import pytest
from pyspark.sql import functions as F

from satchel.operators import contains
from tests.conftest import plan_of, tar_of, zip_of

PDF = b"%PDF-1.4\n"


def run(df, types, **options):
    return {r.file_id: r for r in contains.contains_type(df, types, **options).collect()}


def outcome(row):
    return row.route, row.found, row.found_mime


def zip_inside_zip():
    return zip_of([("inner.zip", zip_of([("in.txt", "inner text")])), ("out.txt", "outer text")])


def test_finds_text_in_zip_inside_zip(make_files):
    row = run(make_files(("zz", zip_inside_zip())), ["application/pdf", "text/plain"])["zz"]
    assert outcome(row) == ("success", True, "text/plain") and row.archive_mime == "application/zip"


def test_not_an_archive(make_files):
    df = make_files(("txt_file", b"Hello World"))
    row = run(df, ["text/plain"], non_archive_to_failure=False)["txt_file"]
    assert outcome(row) == ("success", None, None) and row.error["class"] == "NOT_AN_ARCHIVE"
    assert run(df, ["text/plain"])["txt_file"].route == "failure"


def test_first_match_in_order(make_files):
    data = tar_of([("d/", b""), ("a", b"text"), ("b", b"GIF89a"), ("c", PDF), ("d", b"GIF87a")])
    df = make_files(("t", data))
    assert run(df, ["application/pdf", "image/gif"])["t"].found_mime == "image/gif"
    assert run(df, ["application/pdf"])["t"].found_mime == "application/pdf"
    assert outcome(run(df, ["image/png"])["t"]) == ("success", False, None)


def test_markup_and_unmarked_types(make_files):
    data = zip_of([("a", b"\x00\x01"), ("p", PDF), ("b", b" \n<html>x"), ("x", b"<?xml version='1.0'?><a/>"), ("c", b"plain")])
    df = make_files(("z", data))
    for wanted in ("text/html", "application/xml", "text/plain", "application/octet-stream"):
        assert run(df, [wanted])["z"].found_mime == wanted
    assert run(df, ["text/plain", "application/xml"])["z"].found_mime == "application/xml"


def test_documents_in_zip_containers_are_told_apart(make_files):
    docx = zip_of([("[Content_Types].xml", "x" * 9000), ("word/document.xml", "x" * 9000)], stored=True)
    word = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
    df = make_files(("z", zip_of([("plain.zip", zip_of([("a", "b")])), ("d.docx", docx)])))
    assert run(df, [word])["z"].found_mime == word
    assert run(df, [word], recursive=True)["z"].found_mime == word
    assert run(df, ["application/zip"])["z"].found


def test_nested_archives_are_descended_and_never_match(make_files):
    df = make_files(("zz", zip_of([("inner.zip", zip_of([("x.pdf", PDF)])), ("own", b"GIF89a")])))
    assert run(df, ["application/zip"])["zz"].found_mime == "application/zip"
    assert outcome(run(df, ["application/zip"], recursive=True)["zz"]) == ("success", False, None)
    assert run(df, ["application/pdf"])["zz"].found is False
    assert run(df, ["application/pdf", "image/gif"], recursive=True)["zz"].found_mime == "image/gif"


def test_sub_archive_errors(make_files):
    cut = zip_of([("a", "x" * 100)])[:60]
    df = make_files(("o", zip_of([("cut.zip", cut), ("in.zip", zip_of([("x.pdf", PDF)]))])))
    assert outcome(run(df, ["application/pdf"], recursive=True)["o"]) == ("success", True, "application/pdf")
    row = run(df, ["application/pdf"], recursive=True, fail_on_sub_error=True)["o"]
    assert outcome(row) == ("failure", None, None) and row.error["class"] == "CORRUPT" and row.archive_mime is None


def test_a_match_ends_the_search_before_later_errors(make_files):
    data = zip_of([("x.pdf", PDF), ("cut.zip", zip_of([("a", "x" * 100)])[:60])])
    df = make_files(("o", data))
    assert run(df, ["application/pdf"], recursive=True, fail_on_sub_error=True)["o"].found


def test_empty_set(make_files):
    df = make_files(("z", zip_inside_zip()), ("t", b"text"))
    rows = run(df, [])
    assert outcome(rows["z"]) == ("success", False, None) and rows["t"].route == "failure"


def test_search_set(spark, tmp_path):
    body = '["application/pdf", null, " ", "", " text/plain", "application/pdf"]'
    assert contains.search_set(spark, body=body) == ["application/pdf", " text/plain"]
    (tmp_path / "set.json").write_text(body.replace(", ", ",\n"))
    assert contains.search_set(spark, path=str(tmp_path / "set.json")) == ["application/pdf", " text/plain"]


@pytest.mark.parametrize("options", [{}, {"body": "[]", "path": "x"}, {"body": "no"}, {"body": "{}"}, {"body": "[1]"}])
def test_bad_search_sets(spark, options):
    with pytest.raises(ValueError):
        contains.search_set(spark, **options)


def test_types_match_exactly(make_files):
    df = make_files(("z", zip_of([("a", PDF)])))
    for wanted in (" application/pdf", "Application/PDF", "application/pdf "):
        assert run(df, [wanted])["z"].found is False


def test_narrow_plan(make_files):
    plan = plan_of(contains.contains_type(make_files(("a", b"x")), ["text/plain"]).filter(F.col("found")))
    assert "Exchange" not in plan and "Join" not in plan and plan.count("MapInArrow") == 1
