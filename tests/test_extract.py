import random

import pytest
from pyspark.sql import functions as F

from satchel.functions import columns, text
from satchel.operators import extract
from tests.conftest import plan_of, zip_of


def run(df, **options):
    return {r.file_id: r for r in extract.extract_text(df, **options).collect()}


def content(row):
    return bytes(row.content).decode()


HELLO = [("plain", b"Hello World"), ("html", b"<!DOCTYPE html><html><head><title>no</title></head><body><p>Hello <b>World</b></p></body></html>"),
         ("xml", b"<?xml version='1.0'?><data><value>Hello</value><value>World</value></data>")]


@pytest.mark.parametrize("kind, data", HELLO)
def test_hello_world(make_files, kind, data):
    df = make_files((kind, data))
    row = run(df, fail_on_limit=False)[kind]
    assert (content(row), row.mime_type, row.route, row.limit_reached, row.error) == ("Hello World", "text/plain", "success", None, None)
    row = run(df, max_bytes="6 B", fail_on_limit=False)[kind]
    assert (content(row), row.limit_reached, row.route, row.error["class"]) == ("Hello", True, "success", "TEXT_LIMIT")
    row = run(df, max_chars=4, fail_on_limit=False)[kind]
    assert (content(row), row.limit_reached) == ("Hell", True)
    row = run(df, max_chars=4)[kind]
    assert (bytes(row.content), row.limit_reached, row.route) == (data, True, "failure")
    row = run(df, max_chars=11, max_bytes="11 B")[kind]
    assert (content(row), row.limit_reached, row.route) == ("Hello World", None, "success")


def test_zero_bytes(make_files):
    row = run(make_files(("e", b"")), max_chars=0, max_bytes=0)["e"]
    assert (content(row), row.route, row.limit_reached, row.error, row.mime_type) == ("", "success", None, None, "text/plain")


def test_encrypted(make_files):
    zipped = bytearray(zip_of([("a", "b")]))
    zipped[6] |= 1
    office = bytes.fromhex("D0CF11E0A1B11AE1") + "EncryptedPackage".encode("utf-16-le")
    rows = run(make_files(("pdf", b"%PDF-1.4\n<< /Encrypt 1 0 R >>"), ("zip", bytes(zipped)), ("office", office)))
    assert {r.error["class"] for r in rows.values()} == {"ENCRYPTED"} and {r.route for r in rows.values()} == {"failure"}


def test_unsupported_keeps_type_and_bytes(make_files):
    row = run(make_files(("png", bytes.fromhex("89504E470D0A1A0A"))))["png"]
    assert (row.route, row.error["class"], row.mime_type, len(row.content)) == ("failure", "UNSUPPORTED", "image/png", 8)


def test_large_text_over_a_small_limit(make_files):
    row = run(make_files(("big", b"word " * 200_000)), max_bytes="512 KB", max_chars=-1, fail_on_limit=False)["big"]
    assert row.route == "success" and row.limit_reached and len(row.content) == 512 * 1024


def test_bytes_are_reported_before_chars(make_files):
    row = run(make_files(("t", b"Hello World")), max_chars=4, max_bytes="6 B", fail_on_limit=False)["t"]
    assert content(row) == "Hell" and "6 bytes" in row.error["message"]


def test_trim_takes_control_characters_and_only_after_the_cut(make_files):
    row = run(make_files(("t", b" \t\r\n\x0c\x1b Hello World \n")), max_chars=13, fail_on_limit=False)["t"]
    assert content(row) == "Hello"


def test_white_space_uses_up_the_limit(make_files):
    row = run(make_files(("t", b"      Hello")), max_chars=6, fail_on_limit=False)["t"]
    assert content(row) == "" and row.limit_reached


def test_byte_cut_against_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices("aé€😀 �", k=rng.randrange(12))) for _ in range(150)] + ["", "�", "ab�"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for limit in (0, 1, 2, 3, 4, 5, 7, 11):
        got = [r[1] for r in df.select("t", text.cut_bytes(F.col("t"), limit)).collect()]
        for t, cut in zip(texts, got):
            whole = max((t[:n] for n in range(len(t) + 1) if len(t[:n].encode()) <= limit), key=len)
            assert cut == whole, (t, limit)


def test_byte_estimate_by_the_first_character(make_files):
    df = make_files(("wide", "éaaaa".encode()), ("narrow", "aéééé".encode()), ("empty", b""))
    rows = run(df, max_bytes=6, fail_on_limit=False, exact_bytes=False)
    assert (content(rows["wide"]), rows["wide"].limit_reached) == ("éaa", True)
    assert (content(rows["narrow"]), rows["narrow"].limit_reached) == ("aéééé", None)
    assert content(rows["empty"]) == ""


def test_html_entities_and_hidden_parts(make_files):
    page = b"""<!DOCTYPE html><html><head><script>x</script></head><body class='a'><!-- <p>gone</p> --><script>if (a < b) {}</script>
        <p>a &amp;lt; b&nbsp;&lt;&gt;&quot;&#39; &copy;&middot;</p><style>p{}</style><NOSCRIPT>no</NOSCRIPT>end</body></html>"""
    assert content(run(make_files(("p", page)))["p"]) == "a &lt; b <>\"' ©· end"


def test_xml_with_cdata(make_files):
    data = b"<?xml version='1.0'?><a><!-- no --><b>x &apos;y&apos;</b><c><![CDATA[1 and 2]]></c></a>"
    assert content(run(make_files(("x", data)))["x"]) == "x 'y' 1 and 2"


def test_byte_order_mark_and_broken_utf8(make_files):
    rows = run(make_files(("bom", b"\xef\xbb\xbfHello"), ("latin", b"caf\xe9 and some more plain text")))
    assert content(rows["bom"]) == "Hello" and content(rows["latin"]).startswith("café and")
    mostly = "groß und noch mehr einfacher Text ".encode() * 10
    assert content(run(make_files(("m", mostly + b"\xe9 x")))["m"]) == mostly.decode() + "\ufffd x"


@pytest.mark.parametrize(
    "page, shown",
    [
        (b'<a title="x > y">link</a>', "link"), (b"<p>H<b>ello</b> <i class='>'>W</i>orld", "Hello World"), (b"<p>one<br>two<td>three", "one two three"),
        (b"<html><head><title>no</title></head>text only", "text only"), (b"<p>&#233;&#xE9;&eacute;&euro;&#150;&#0;&#xD800;&nosuch;&amp;lt;", "ééé€–��&nosuch;&lt;"),
        (b"<p title=it's>a</p><p title='b'>c", "a c"), (b'<p title="open>a</p>b', "a b"), (b"<p>a<!-- <b -->b<!-- open", "ab"), (b"<p>1 < 2 & 3 > 2", "1 < 2 & 3 > 2"),
        (b"<!-- <body> --><script>'<body>'</script><body>x", "x"), (b"<html><body>a&nbsp;&#160;b</body>", "a b"), (b"<p>a<SCRIPT x='>'>no</Script >b", "ab"),
    ],
)
def test_markup(make_files, page, shown):
    start = b"" if page.startswith(b"<html") else b"<!DOCTYPE html>"
    assert content(run(make_files(("p", start + page)))["p"]) == shown


def test_a_tag_of_any_length(make_files):
    many = b" ".join(b"a%d='x'" % i for i in range(20_000))
    page = b"<html><body><p " + many + b">x</p>" + b"<!-- c -->" * 20_000 + b"y" + b"<i>" * 20_000 + b"z"
    assert content(run(make_files(("p", page)))["p"]) == "x yz"
    assert content(run(make_files(("p", b"<html>" + b"<!-- c --><p>" * 20_000 + b"<body>y")))["p"]) == "y"


@pytest.mark.parametrize(
    "data, shown",
    [
        ("größe €".encode("utf-16"), "größe €"), (b"\xfe\xff" + "a😀b".encode("utf-16-be"), "a😀b"), (b"\xff\xfe" + "a😀b".encode("utf-16-le"), "a😀b"),
        (b"\xff\xfea\x00\x00\xd8b\x00\x00\xdc\x41", "a\ufffdb\ufffd\ufffd"), (b"\xfe\xff\x00a\xd8\x00\x00b\xdc\x00\x41", "a\ufffdb\ufffd\ufffd"),
        (b"<html><meta charset=latin1><body>caf\xe9 \x80", "café €"), (b"<html><body>caf\xe9 na\xefve", "café naïve"),
        (b"<?xml version='1.0' encoding='ISO-8859-1'?><a>\xe9</a>", "é"), ("<html><meta charset='utf-8'><body>é".encode(), "é"),
        (b"<html><meta charset=iso-8859-1><body>\xc3\xa9", "Ã©"), (b"\xef\xbb\xbf<html><meta charset=latin1><body>\xc3\xa9", "é"), (b"\xff\xfe", ""),
    ],
)
def test_character_sets(make_files, data, shown):
    assert content(run(make_files(("p", data)))["p"]) == shown


def test_xml_sections_and_references(make_files):
    data = b"<?xml version='1.0'?><!DOCTYPE a [<!ENTITY x '>'>]><a t='>'><![CDATA[&lt;<b>]]>&lt;&#65;&eacute;<!-- & --></a>"
    assert content(run(make_files(("x", data)))["x"]) == "&lt;<b><A&eacute;"


@pytest.mark.parametrize("options", [{"max_bytes": "6"}, {"max_bytes": "x"}, {"max_chars": -2}])
def test_bad_limits(make_files, options):
    with pytest.raises(ValueError):
        extract.extract_text(make_files(("a", b"")), **options)


def test_data_sizes(spark):
    cases = {"80 MB": 80 * 2**20, "6 B": 6, " -1 ": -1, "1.5kb": 1536, "2 TB": 2 * 2**40, "5": None, "x B": None, "": None, "-2 B": None}
    df = spark.createDataFrame([(k,) for k in cases], "v string").select("v", columns.parse_data_size(F.col("v")).alias("n"))
    assert {r.v: r.n for r in df.collect()} == cases
    for value, size in cases.items():
        if size is None:
            with pytest.raises(ValueError):
                columns.size_option(value)
        else:
            assert columns.size_option(value) == size


def test_filters_do_not_repeat_the_extraction(make_files):
    plan = plan_of(extract.extract_text(make_files(("a", b"x"))).filter("route = 'success'"))
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("noscript") <= 6
