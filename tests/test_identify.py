import json
import random

import pytest
from pyspark.sql import functions as F

from satchel.functions import magic, mime
from satchel.operators import identify
from satchel.sources import files
from tests.conftest import plan_of, zip_of


def types_of(df, **options):
    return {r.file_id: (r.mime_type, r.mime_extension) for r in identify.identify(df, **options).collect()}


def test_text_and_pdf(make_files):
    found = types_of(make_files(("txt_file", b"Hello World"), ("pdf_file", b"%PDF-1.4\nHello")))
    assert found == {"txt_file": ("text/plain", ".txt"), "pdf_file": ("application/pdf", ".pdf")}


def test_fallback_and_empty(make_files):
    found = types_of(make_files(("noise", b"\x01\x02\x03\x00"), ("empty", b""), ("null", None)))
    assert set(found.values()) == {("application/octet-stream", "")}


def test_parameters_are_dropped_after_the_extension_lookup(make_files):
    rar = make_files(("rar", bytes.fromhex("526172211A070100") + b"x"))
    assert types_of(rar) == {"rar": ("application/x-rar-compressed", "")}
    assert types_of(rar, clean_only=False) == {"rar": ("application/x-rar-compressed; version=5", "")}


def test_clean_keeps_trailing_blanks(spark):
    row = spark.createDataFrame([("a/b ; c=1",), ("a/b",)], "m string").select(mime.clean(F.col("m"))).collect()
    assert [r[0] for r in row] == ["a/b ", "a/b"]


def test_gzip_is_never_tgz(make_files):
    assert types_of(make_files(("g", b"\x1f\x8b\x08xx")))["g"] == ("application/gzip", ".gz")
    rules = mime.parse_rules('[{"type": "application/gzip", "extension": ".tgz", "hex": "1F8B"}]')
    assert types_of(make_files(("g", b"\x1f\x8b\x08xx")), rules=rules)["g"] == ("application/gzip", ".gz")


@pytest.mark.parametrize(
    "content, expected",
    [
        (b"<!DOCTYPE html><html></html>", "text/html"),
        (b"\xef\xbb\xbf \n<HTML lang='x'>", "text/html"),
        (b"<!-- note --><body>x", "text/html"),
        (b"<?xml version='1.0'?><data/>", "application/xml"),
        (b"<?xml version='1.0'?><!DOCTYPE html><html xmlns='x'></html>", "application/xhtml+xml"),
        (b"<?xml version='1.0'?><!-- c --><svg >", "image/svg+xml"),
        (b"<svg xmlns='x'>", "image/svg+xml"),
        (b"<rss version='2.0'>", "application/rss+xml"),
        (b"<feed >", "application/atom+xml"),
        (b"<htmlish>", "text/plain"),
        ("größe €".encode() * 200, "text/plain"),
        ("x".encode() * 511 + "€".encode(), "text/plain"),
        (b"caf\xe9 " + b"plain ascii text", "text/plain"),
        (b"\xe9\xe8\xea\xff\xfe\xe9", "application/octet-stream"),
        (b"text with \x00 inside", "application/octet-stream"),
    ],
)
def test_text_types(make_files, content, expected):
    assert types_of(make_files(("f", content)))["f"][0] == expected


def test_zip_based_documents(make_files):
    docx = zip_of([("[Content_Types].xml", "<Types/>"), ("word/document.xml", "<w/>")])
    plain = zip_of([("a.txt", "word/document.xml")])
    odt = zip_of([("mimetype", "application/vnd.oasis.opendocument.text")], stored=True)
    found = types_of(make_files(("docx", docx), ("zip", plain), ("odt", odt), ("empty", zip_of([]))))
    assert {k: v[1] for k, v in found.items()} == {"docx": ".docx", "zip": ".zip", "odt": ".odt", "empty": ".zip"}


def sample_of(rule):
    data = bytearray(b"\x01" * 300)
    for offset, part in rule.parts:
        raw = bytes.fromhex(part)
        data[offset : offset + len(raw)] = raw
    return bytes(data) + (rule.needle or "").encode()


def markup_samples():
    comment = b"<!-- " + b"note " * 300 + b"-->"
    starts = [b"", b"\xef\xbb\xbf", b" " * 700, comment, b"<!-- a -->\n" * 40, b"<!-- open ", b"<!-->x-->", b"\xef\xbb"]
    prologs = [
        b"", b"<?xml version='1.0'?>", b"<?XML\tversion='1.0'?> " + comment, b"<?xml-stylesheet x?>", b"<?xml ", b"<?xml",
        b"<!DOCTYPE html>", b"<!doctype \n\t HTML SYSTEM 'x'>", b"<!DOCTYPE svg " + b"x" * 900 + b">", b"<!DOCTYPEhtml>", b"<!DOCTYPE x>",
        b"<!DOCTYPE  html", b"<!DOCTYPE htmlx>", b"<!DOCTYPE",
    ]
    roots = [b"<html>", b"<HTML lang='x'>", b"<svg >", b"<rss\n>", b"<feed>", b"<data/>", b"<htmlish>", b"<h1>", b"text", b"", b"<", b"<title", b"\x00"]
    return [s + p + r for s in starts for p in prologs for r in roots]


def test_every_rule_in_both_engines(make_files):
    contents = [sample_of(rule) for rule in magic.RULES]
    rng = random.Random(7)
    contents += [bytes(rng.choices(range(256), k=300)) for _ in range(200)]
    contents += [c + b"\n" for c in ("größe €".encode() * 200, b"caf\xc3", "x".encode() * 510 + "€".encode(), b"\xc3\xc3", b" " * 600)]
    first = b"PK\x03\x04" + bytes(26) + b"[Content_Types].xml"
    contents += [first + b"x" * n + needle for n in (0, 500, 9000) for needle in (b"", b"xl/workbook.bin", b"ppt/presentation.xml word/document.xml")]
    contents += markup_samples()
    df = make_files(*[(str(i), c) for i, c in enumerate(contents)])
    found = {int(r.file_id): r.m for r in df.select("file_id", mime.detect("content").alias("m")).collect()}
    for size in (1, 7, 4096):
        for i, content in enumerate(contents):
            told = magic.tell(content[at : at + size] for at in range(0, len(content), size))
            assert told == found[i], (content[:80], size)
    matched = {found[i] for i in range(len(magic.RULES))}
    assert matched == {rule.mime for rule in magic.RULES}


@pytest.mark.parametrize("before", [b"<!-- " + b"long " * 1000 + b"-->", b"<!-- a -->" * 20_000, b"\n" * 5000])
def test_markup_behind_a_long_beginning(make_files, before):
    found = types_of(make_files(("h", before + b"<html>x"), ("s", b"<?xml version='1.0'?>" + before + b"<svg >"), ("t", before + b"x")))
    assert {k: v[0] for k, v in found.items()} == {"h": "text/html", "s": "image/svg+xml", "t": "text/plain"}


def test_no_more_is_read_than_the_type_takes():
    def pieces(content):
        for at in range(0, len(content), 64):
            read.append(at)
            yield content[at : at + 64]

    for content, most in ((b"%PDF-1.4" + b"x" * 10_000, 512), (b"plain " * 5000, 512), (b"<!--" + b"c" * 2000 + b"--><html>" + b"x" * 9000, 2112)):
        read = []
        magic.tell(pieces(content))
        assert read[-1] < most


def test_rules_replace_the_table(make_files, spark, tmp_path):
    body = json.dumps([
        {"type": "x/second", "text": "He", "priority": 20},
        {"type": "x/first", "text": "Hello", "priority": 10, "extension": ".one"},
        {"type": "x/quote's", "offset": 2, "hex": "2721"},
    ])
    path = tmp_path / "rules.json"
    path.write_text(body)
    df = make_files(("a", b"Hello"), ("b", b"Help"), ("c", b"%PDF-1.4"), ("d", b"ab'!"), ("e", b"<html>"), ("n", b"\x00"))
    for rules in (files.load_rules(spark, body=body), files.load_rules(spark, path=str(path))):
        assert types_of(df, rules=rules) == {
            "a": ("x/first", ".one"), "b": ("x/second", ""), "c": ("text/plain", ".txt"), "d": ("x/quote's", ""),
            "e": ("text/plain", ".txt"), "n": ("application/octet-stream", ""),
        }


@pytest.mark.parametrize("body", ["", "{}", "[]", "[1]", '[{"type": "a/b"}]', '[{"type": "a/b", "hex": "zz"}]', '[{"type": "a/b", "hex": ""}]'])
def test_bad_rules_are_refused(spark, body):
    with pytest.raises(ValueError):
        files.load_rules(spark, body=body)


def test_both_rule_sources_are_refused(spark):
    with pytest.raises(ValueError):
        files.load_rules(spark, body="[]", path="x")
    assert files.load_rules(spark) is None


def test_narrow_plan_without_python(make_files):
    plan = plan_of(identify.identify(make_files(("a", b"x"))).filter("mime_type = 'text/html'"))
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
