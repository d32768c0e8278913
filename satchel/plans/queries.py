"""The registered queries: each operator over whole tables, from the table scan to its outcome."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satchel.functions import columns, mime
from satchel.operators import contains, extract, identify, keyed, unpack
from satchel.session import shared_folder
from satchel.sources import archive_source, files, samples

Query = Callable[[SparkSession, str], DataFrame]

CUSTOM_RULES = """[
    {"type": "text/x-any-t", "extension": ".t", "priority": 30, "text": "T"},
    {"type": "text/x-the", "extension": ".the", "priority": 10, "text": "The"},
    {"type": "text/x-th", "extension": ".th", "priority": 20, "text": "Th"},
    {"type": "text/x-e-second", "priority": 40, "offset": 1, "hex": "65"}
]"""
SEARCH_BODY = '["application/pdf", " ", null, "text/html", "", "application/pdf", "image/png", "Text/Plain"]'
SKIP_BUDGET = 1000
FAIL_BUDGET = 1500
TINY_BUDGET = 20
ARCHIVE_FOLDERS = 1024


def _error_class() -> Column:
    return F.col("error.class").alias("error_class")


def _text() -> Column:
    return F.col("content").cast("string").alias("text")


def _documents_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = samples.text_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.encode("text", "UTF-8").alias("content"))


def _unpack(archives: DataFrame, **options) -> DataFrame:
    return unpack.unpack(archives, id_col="archive_id", **options)


def _children(unpacked: DataFrame) -> DataFrame:
    return unpack.children(unpacked, id_col="archive_id")


def _described(archives: DataFrame, **options) -> DataFrame:
    """Children without their bytes."""
    return _children(_unpack(archives, emit="children", with_data=False, **options))


# sources and routes


def file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = samples.table(spark, sf_dir, "pages")
    docs = samples.table(spark, sf_dir, "documents")
    scanned = files.table_files(
        pages, F.concat(F.lit("page-"), "page_id"), F.concat("page_id", F.lit(".html")), F.col("html")
    ).unionByName(files.table_files(docs, F.concat(F.lit("doc-"), "doc_id"), F.concat("doc_id", F.lit(".txt")), F.col("text")))
    return scanned.select("file_id", "filename", F.length("content").cast("long").alias("length"), F.md5("content").alias("md5"))


def route_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = extract.extract_text(_encrypted_corpus(spark, sf_dir), max_chars=2000)
    return outcome.groupBy("route").agg(F.count("*").alias("n_files"))


def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = extract.extract_text(_encrypted_corpus(spark, sf_dir), max_chars=2000)
    return outcome.groupBy("route", _error_class()).agg(F.count("*").alias("n_files"))


# type identification


def mime_identify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify.identify(samples.corpus(spark, sf_dir)).select("file_id", "mime_type", "mime_extension", "route")


def mime_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = identify.identify(samples.corpus(spark, sf_dir), clean_only=False)
    return full.select("file_id", F.col("mime_type").alias("full_type"), mime.clean(F.col("mime_type")).alias("clean_type"))


def mime_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify.identify(samples.corpus(spark, sf_dir))
    return found.groupBy("mime_type", "mime_extension").agg(F.count("*").alias("n_files"))


def mime_custom_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = files.load_rules(spark, body=CUSTOM_RULES)
    found = identify.identify(_documents_as_files(spark, sf_dir), rules=rules)
    return found.select("doc_id", "mime_type", "mime_extension")


# unpacking


def archive_recognise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify.identify(samples.corpus(spark, sf_dir))
    kind = F.col("mime_type")
    return found.select(
        "file_id", mime.is_archive_type(kind).alias("can_open"), mime.is_unreadable_archive_type(kind).alias("only_recognised")
    )


def _files_of(unpacked: DataFrame) -> DataFrame:
    return _children(unpacked).select(
        F.col("parent_id").alias("archive_id"), "fragment_index", "entry_name", "size", F.md5("content").alias("md5")
    )


def unpack_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _files_of(_unpack(samples.archives(spark, sf_dir)))


def unpack_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpacked = _unpack(samples.archives(spark, sf_dir, "nested"), recursive=True)
    return _children(unpacked).select(
        F.col("parent_id").alias("archive_id"), "fragment_index", "entry_name", F.col("depth").cast("long").alias("depth"),
        "container", "size", F.md5("content").alias("md5"),
    )


def unpack_budget_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpacked = _unpack(samples.archives(spark, sf_dir), budget=SKIP_BUDGET, fail_on_breach=False, fail_on_nothing=False)
    return _files_of(unpacked)


def unpack_budget_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpacked = _unpack(samples.archives(spark, sf_dir), budget=FAIL_BUDGET, emit="parents")
    return unpack.parents(unpacked).select(
        "archive_id", "route", _error_class(), "unpack_bytes", "threshold_breached", "fragment_count"
    )


def unpack_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpacked = _unpack(samples.archives(spark, sf_dir), budget=TINY_BUDGET, fail_on_breach=False, emit="parents")
    return unpack.parents(unpacked).select("archive_id", "route", _error_class(), "threshold_breached")


def unpack_nonarchive(spark: SparkSession, sf_dir: str) -> DataFrame:
    def with_policy(to_failure: bool) -> DataFrame:
        unpacked = unpack.unpack(samples.corpus(spark, sf_dir), non_archive_to_failure=to_failure, emit="parents")
        return unpack.parents(unpacked).select(F.lit(to_failure).alias("to_failure"), "file_id", "route", _error_class())

    return with_policy(False).unionByName(with_policy(True))


def unpack_sub_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    def with_policy(fail: bool) -> DataFrame:
        unpacked = _unpack(samples.archives(spark, sf_dir, "broken"), recursive=True, fail_on_sub_error=fail, emit="parents")
        return unpack.parents(unpacked).select(
            F.lit(fail).alias("fail_on_sub_error"), "archive_id", "route", _error_class(), "sub_errors", "fragment_count"
        )

    return with_policy(False).unionByName(with_policy(True))


def unpack_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(samples.archives(spark, sf_dir)).select(
        F.col("parent_id").alias("archive_id"), "fragment_index", "filename", "path", "absolute_path", "segment_path",
        "segment_original_filename",
    )


def unpack_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(samples.archives(spark, sf_dir)).select(
        F.col("parent_id").alias("archive_id"), "fragment_id", "fragment_index", "fragment_count"
    )


def unpack_tar_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _described(samples.archives(spark, sf_dir)).select(
        F.col("parent_id").alias("archive_id"), "fragment_index", "owner", "grp", "permissions", "last_modified_time",
        "creation_time",
    )


def unpack_permissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpacked = _unpack(samples.archives(spark, sf_dir), emit="children", with_data=False).filter(F.col("mode").isNotNull())
    rendered = unpacked.select(F.col("mode").cast("long").alias("mode"), columns.permission_string(F.col("mode")).alias("permissions"))
    return rendered.groupBy("mode", "permissions").agg(F.count("*").alias("n_files"))


def unpack_child_mime(spark: SparkSession, sf_dir: str) -> DataFrame:
    def typed(recursive: bool) -> DataFrame:
        return _described(samples.archives(spark, sf_dir, planted=True), recursive=recursive).groupBy("mime_type").agg(F.count("*").alias("n_files")).withColumn("recursive", F.lit(recursive))

    return typed(False).unionByName(typed(True))


def unpack_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpacked = _unpack(samples.archives(spark, sf_dir, "nested"), recursive=True, emit="parents")
    return unpack.parents(unpacked).select(
        "archive_id", "mime_type", "unpack_bytes", "threshold_breached", "fragment_id", "fragment_count", "route"
    )


def unpack_inherit(spark: SparkSession, sf_dir: str) -> DataFrame:
    child = _described(samples.archives(spark, sf_dir, "nested"), recursive=True)
    return child.select(F.col("parent_id").alias("archive_id"), "fragment_index", "lang", "filename")


def unpack_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _described(samples.archives(spark, sf_dir), budget=FAIL_BUDGET)
    return kept.groupBy(F.col("parent_id").alias("archive_id")).agg(F.count("*").alias("n_files"), F.sum("size").alias("n_bytes"))


def unpack_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = unpack.lineage(_described(samples.archives(spark, sf_dir)), id_col="archive_id")
    return edges.select("parent_id", "child_id", "fragment_index")


def _archive_files(spark: SparkSession, sf_dir: str, folders: int = 0) -> str:
    """The archives as files in the shared folder."""
    folder = shared_folder(spark, "archives")
    files.write_files(samples.archives(spark, sf_dir), folder, folders)
    return folder


def _id_of(path: Column) -> Column:
    return F.regexp_extract(path, r"doc-(\d+)\.\w+$", 1).cast("long").alias("archive_id")


def unpack_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives read by path, each in parts of 1 KB."""
    inbox = files.read_files(spark, _archive_files(spark, sf_dir, ARCHIVE_FOLDERS), with_content=False)
    inbox = inbox.withColumn("archive_id", _id_of(F.col("filename")))
    return _files_of(unpack.unpack_large(inbox, id_col="archive_id", part_bytes="1 KB"))


def archive_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives as a table, its small text files of the first directory level."""
    archive_source.register(spark)
    options = {"partBytes": "1 MB", "emit": "children", "name": "line-*", "maxSize": "199 B"}
    small = spark.read.format("archive").options(**options).load(_archive_files(spark, sf_dir))
    return small.select(_id_of(F.col("archive")), "pos", "name", "size", F.md5("data").alias("md5"), "n_unpacked")


def archive_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives as a table, only the archives themselves."""
    archive_source.register(spark)
    parents = spark.read.format("archive").option("emit", "parents").load(_archive_files(spark, sf_dir))
    return parents.select(_id_of(F.col("archive")), "n_unpacked", "unpack_bytes", "error_class")


def change_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = extract.extract_text(_encrypted_corpus(spark, sf_dir), max_chars=2000)
    return unpack.audit(outcome, "extract").groupBy("op", "change", "route").agg(F.count("*").alias("n_files"))


# search in archives


def contains_search_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = contains.search_set(spark, body=SEARCH_BODY)
    found = identify.identify(samples.corpus(spark, sf_dir))
    return found.filter(F.col("mime_type").isin(*wanted)).groupBy("mime_type").agg(F.count("*").alias("n_files"))


def _search_outcome(searched: DataFrame, id_col: str = "archive_id") -> list[Column]:
    return [F.col(id_col), F.col("route"), F.col("archive_mime"), F.col("found"), F.col("found_mime"), _error_class()]


def contains_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["application/pdf", "application/octet-stream"]
    searched = contains.contains_type(samples.archives(spark, sf_dir, planted=True), wanted)
    return searched.select(*_search_outcome(searched))


def contains_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["application/octet-stream", "application/pdf", "application/zip", "application/x-tar"]

    def search(recursive: bool) -> DataFrame:
        nested = samples.archives(spark, sf_dir, "nested", planted=True)
        searched = contains.contains_type(nested, wanted, recursive=recursive)
        return searched.select(F.lit(recursive).alias("recursive"), *_search_outcome(searched))

    return search(False).unionByName(search(True))


def contains_sub_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    def search(fail: bool) -> DataFrame:
        broken = samples.archives(spark, sf_dir, "broken", planted=True)
        searched = contains.contains_type(broken, ["application/pdf"], recursive=True, fail_on_sub_error=fail)
        return searched.select(F.lit(fail).alias("fail_on_sub_error"), *_search_outcome(searched))

    return search(False).unionByName(search(True))


def contains_nonarchive(spark: SparkSession, sf_dir: str) -> DataFrame:
    def search(to_failure: bool) -> DataFrame:
        corpus = samples.corpus(spark, sf_dir)
        searched = contains.contains_type(corpus, ["text/plain"], non_archive_to_failure=to_failure)
        return searched.select(F.lit(to_failure).alias("to_failure"), *_search_outcome(searched, "file_id"))

    return search(False).unionByName(search(True))


# text extraction


def extract_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = samples.text_table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    done = extract.extract_text(pages)
    return done.select("page_id", _text(), "mime_type", "route")


def extract_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known texts, written in six ways of markup and character sets, and read back."""
    docs = samples.text_table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", r"[\x00-\x20\xA0]+", " ").alias("text"))
    t = F.trim(F.substring(F.trim("text"), 1, 400))

    def escaped(text: Column) -> Column:
        for char, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(char), F.lit(reference))
        return text

    def around(before: str, text: Column, after: str) -> Column:
        return F.concat(F.lit(before), text, F.lit(after))

    word = F.concat(escaped(F.substring(t, 1, 3)), F.lit("<!-- </p> --><b class='>'>"), escaped(F.substring(t, 4, 400)), F.lit("</b>"))
    coded = F.replace(F.replace(escaped(t), F.lit("e"), F.lit("&#101;")), F.lit("n"), F.lit("&#x6e;"))
    coded = F.replace(F.replace(coded, F.lit("é"), F.lit("&eacute;")), F.lit("ü"), F.lit("&uuml;"))
    western = F.regexp_replace(t, r"[^\x20-\x7E\xA0-\xFF]", "")
    head = "<html><head><title>gone</title><style>p > a {}</style>"
    kind = F.col("doc_id") % 6
    content = (
        F.when(kind == 0, F.encode(around(f'<!DOCTYPE html>{head}</head><body><p title="x > y">', word, "</p><script>'</p>'</script></body></html>"), "UTF-8"))
        .when(kind == 1, F.encode(around(head + "<div data-a='a > b' data-b=it's>", escaped(t), "</div>"), "UTF-8"))
        .when(kind == 2, F.encode(around("<html><body>", coded, "</body></html>"), "UTF-8"))
        .when(kind == 3, F.concat(F.unhex(F.lit("FFFE")), F.encode(t, "UTF-16LE")))
        .when(kind == 4, F.encode(around(head + '<meta http-equiv=x content="text/html; charset=ISO-8859-1"></head><body>', escaped(western), ""), "ISO-8859-1"))
        .otherwise(F.encode(around("<?xml version='1.0'?><!DOCTYPE a [<!ENTITY b 'c'>]><a><![CDATA[", t, "]]></a>"), "UTF-8"))
    )
    done = extract.extract_text(docs.select("doc_id", content.alias("content")), max_chars=-1)
    return done.select("doc_id", _text())


def extract_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    escaped = F.col("text")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(char), F.lit(entity))
    wrapped = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<data>\n<value>'), escaped, F.lit("</value>\n</data>"))
    docs = samples.text_table(spark, sf_dir, "documents").select("doc_id", F.encode(wrapped, "UTF-8").alias("content"))
    return extract.extract_text(docs, max_chars=-1).select("doc_id", _text(), "mime_type", "route")


def extract_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = extract.extract_text(_documents_as_files(spark, sf_dir), max_chars=-1)
    return done.select("doc_id", _text(), "mime_type", "route")


def extract_char_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = extract.extract_text(_documents_as_files(spark, sf_dir), max_chars=100, fail_on_limit=False)
    return done.select("doc_id", _text(), "limit_reached")


def extract_byte_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = extract.extract_text(_documents_as_files(spark, sf_dir), max_bytes="64 B", max_chars=-1, fail_on_limit=False)
    return done.select("doc_id", _text(), "limit_reached")


def extract_byte_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents_as_files(spark, sf_dir)
    done = extract.extract_text(docs, max_bytes="2 KB", max_chars=-1, fail_on_limit=False, exact_bytes=False)
    return done.select("doc_id", _text(), "limit_reached")


def extract_both_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = extract.extract_text(_documents_as_files(spark, sf_dir), max_bytes="1 KB", max_chars=1000, fail_on_limit=False)
    return done.select("doc_id", _text(), F.col("error.message").alias("error_message"))


def extract_limit_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = extract.extract_text(_documents_as_files(spark, sf_dir), max_chars=1500)
    return done.select("doc_id", "route", "limit_reached", _error_class(), F.md5("content").alias("content_md5"))


def extract_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" \t\n"), F.col("text"), F.lit(" \r\n "))
    docs = samples.text_table(spark, sf_dir, "documents").select("doc_id", F.encode(padded, "UTF-8").alias("content"))
    return extract.extract_text(docs, max_chars=40, fail_on_limit=False).select("doc_id", _text())


def extract_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.when(F.col("doc_id") % 10 == 0, F.lit("")).otherwise(F.col("text"))
    docs = samples.text_table(spark, sf_dir, "documents").select("doc_id", F.encode(content, "UTF-8").alias("content"))
    done = extract.extract_text(docs, max_chars=-1)
    return done.select("doc_id", F.octet_length("content").cast("long").alias("n_bytes"), "route", "mime_type", "limit_reached")


def _encrypted_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus with an encryption dictionary in every other PDF and a zip header that says encrypted."""
    corpus = samples.corpus(spark, sf_dir)
    doc = F.regexp_extract("file_id", r"^doc-(\d+)$", 1).try_cast("long")
    content = (
        F.when((doc % 8 == 1) & (doc % 16 == 1), F.concat("content", F.encode(F.lit("\ntrailer << /Encrypt 5 0 R >>"), "UTF-8")))
        .when((doc % 8 == 2) & (doc % 16 == 2), F.concat(F.unhex(F.lit("504B0304140001000800")), "content"))
        .otherwise(F.col("content"))
    )
    # the other zip headers get a plain flag field in front of the text
    plain_zip = (doc % 8 == 2) & (doc % 16 == 10)
    content = F.when(plain_zip, F.concat(F.unhex(F.lit("504B0304140000000800")), "content")).otherwise(content)
    return corpus.withColumn("content", content)


def extract_error_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = extract.extract_text(_encrypted_corpus(spark, sf_dir), max_chars=-1)
    return done.select("file_id", "route", _error_class(), "mime_type")


# keyed removal


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = samples.table(spark, sf_dir, "customer")
    return customers.select(
        F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("value"), "c_custkey", "c_mktsegment"
    )


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = samples.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    key = F.when(F.col("o_orderkey") % 50 == 0, "  ").when(F.col("o_orderkey") % 50 != 1, F.col("o_custkey").cast("string"))
    return orders.select(F.col("o_orderkey").alias("request_id"), key.alias("key"))


def keyed_delete_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = keyed.route_deletes(_requests(spark, sf_dir), _store(spark, sf_dir))
    return routed.select("request_id", "key", "route", "penalized", _error_class())


def keyed_delete_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a customer asks for the removal of the order with its number; most orders have no such customer
    orders = samples.table(spark, sf_dir, "orders")
    store = orders.select(F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderpriority").alias("value"))
    requests = samples.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    return keyed.survivors(store, requests).select("key", "value")


def keyed_delete_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every other key of the store is of another form
    kept = F.when(F.col("c_custkey") % 2 == 0, F.concat_ws(":", "c_mktsegment", F.col("c_custkey").cast("string")))
    store = _store(spark, sf_dir).select(F.coalesce(kept, "key").alias("key"))
    customers = samples.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    requests = keyed.with_key(customers, "concat(c_mktsegment, ':', CAST(c_custkey AS STRING))")
    return keyed.route_deletes(requests, store, id_col="c_custkey").select("c_custkey", "key", "route")


def keyed_delete_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = samples.table(spark, sf_dir, "events")
    return keyed.replay(events, "user_id", "ts", "event_id", "event_type", "signup", "error")


def keyed_delete_replay_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log on a store that already holds every other customer; one customer makes a third of the operations."""
    events = samples.table(spark, sf_dir, "events").withColumn("who", F.expr("if(event_id % 3 = 0, 0, user_id)"))
    store = samples.table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("key"))
    return keyed.replay(events, "who", "ts", "event_id", "event_type", "signup", "error", store=store)


# options and the whole way


def parse_data_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = samples.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    units = F.array(*[F.lit(u) for u in (" B", "KB", " mb", "GB ", " TB", "", " XB")])
    unit = F.element_at(units, (F.col("doc_id") % 7 + 1).cast("int"))
    size = F.when(F.col("doc_id") % 11 == 0, " -1 ").otherwise(F.concat(F.col("n_chars").cast("string"), unit))
    return docs.select("doc_id", columns.parse_data_size(size).alias("n_bytes"))


def archive_text_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested archives to text: unpack, tell types, extract under a limit, and count what became of it."""
    unpacked = _unpack(samples.archives(spark, sf_dir, "nested", planted=True), recursive=True)
    child = _children(unpacked).select("archive_id", "mime_type", "content").withColumnRenamed("mime_type", "entry_type")
    done = extract.extract_text(child, max_chars=400, fail_on_limit=False)
    return done.groupBy("entry_type", "route", _error_class()).agg(
        F.count("*").alias("n_files"), F.sum(F.octet_length("content").cast("long")).alias("n_bytes")
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        file_scan, route_split, error_summary, mime_identify, mime_clean, mime_extension, mime_custom_rules, archive_recognise,
        unpack_flat, unpack_recursive, unpack_budget_skip, unpack_budget_fail, unpack_nothing, unpack_nonarchive,
        unpack_sub_error, unpack_paths, unpack_fragments, unpack_tar_metadata, unpack_permissions, unpack_child_mime,
        unpack_parents, unpack_inherit, unpack_atomic, unpack_lineage, unpack_large, archive_table, archive_parents, change_audit, contains_search_set, contains_type,
        contains_recursive, contains_sub_error, contains_nonarchive, extract_html, extract_planted, extract_xml, extract_plain,
        extract_char_limit, extract_byte_limit, extract_byte_estimate, extract_both_limits, extract_limit_policy, extract_trim,
        extract_empty,
        extract_error_routes, keyed_delete_route, keyed_delete_survivors, keyed_delete_expr, keyed_delete_replay, keyed_delete_replay_store,
        parse_data_size, archive_text_report,
    )
}
