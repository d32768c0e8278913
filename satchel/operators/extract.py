"""Text extraction of whole rows: every step is a native expression, no Python worker and no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satchel import schema
from satchel.functions import columns, mime, text

# The types with an extractor, by kind.
HTML_TYPES = ("text/html", "application/xhtml+xml")
XML_TYPES = ("application/xml", "image/svg+xml", "application/rss+xml", "application/atom+xml")
PLAIN_TYPES = ("text/plain", "text/calendar", "text/x-vcard", "application/x-sh")


def is_encrypted(content: str, mime_type: Column) -> Column:
    """Encrypted zip entry, PDF with an encryption dictionary, or an encrypted office package."""
    data = F.col(content)
    zip_flag = F.conv(F.hex(F.substring(data, 7, 1)), 16, 10).cast("int").bitwiseAND(1) == 1
    return (
        ((F.substring(data, 1, 4) == F.unhex(F.lit("504B0304"))) & zip_flag)
        | ((mime_type == "application/pdf") & F.contains(data, F.encode(F.lit("/Encrypt"), "UTF-8")))
        | ((mime_type == "application/x-ole-storage") & F.contains(data, F.encode(F.lit("EncryptedPackage"), "UTF-16LE")))
    )


def document_text(content: str, mime_type: Column) -> Column:
    """Text before limits and trimming; NULL for a type without an extractor."""
    decoded = text.decode(F.col(content), mime_type.isin(*HTML_TYPES, *XML_TYPES))
    return (
        F.when(F.length(content) == 0, "")
        .when(mime_type.isin(*HTML_TYPES), text.html_text(decoded))
        .when(mime_type.isin(*XML_TYPES), text.xml_text(decoded))
        .when(mime_type.isin(*PLAIN_TYPES), decoded)
    )


def extract_text(
    files: DataFrame,
    content: str = "content",
    *,
    max_bytes: str | int = "80 MB",
    max_chars: int = 100_000,
    fail_on_limit: bool = True,
    exact_bytes: bool = True,
) -> DataFrame:
    """Replaces ``content`` by its text and sets ``mime_type``, ``limit_reached``, ``route`` and ``error``.

    A failed row keeps its bytes.  ``limit_reached`` is true or NULL: absent unless a limit was hit.  Without
    ``exact_bytes`` the size of a text is estimated from the width of its first character.
    """
    byte_limit = columns.size_option(max_bytes)
    if max_chars < -1:
        raise ValueError(f"not a character limit: {max_chars}")
    found, kind, body = F.col("_type"), F.col("_kind"), F.col("_text")
    limit_error = schema.error(schema.TEXT_LIMIT, text.limit_message(kind, max_chars, byte_limit))
    decided = (
        F.when(F.length(content) == 0, schema.no_error())
        .when(is_encrypted(content, found), schema.error(schema.ENCRYPTED, "encrypted or password protected file"))
        .when(body.isNull(), schema.error(schema.UNSUPPORTED, F.concat(F.lit("no text extractor for "), found)))
        .when(kind.isNotNull(), limit_error)
    )
    staged = (
        files.withColumn("_type", mime.clean(mime.detect(content)))
        .withColumn("_text", document_text(content, found))
        .withColumn("_kind", text.limit_kind(body, max_chars, byte_limit, exact_bytes))
    )
    staged = schema.with_computed(staged, _type=found, _text=body, _kind=kind, error=decided)
    limited = F.col("error.class").eqNullSafe(schema.TEXT_LIMIT)
    failed = F.col("error").isNotNull() & (~limited | F.lit(fail_on_limit))
    cut_bytes = text.cut_bytes if exact_bytes else text.cut_estimated_bytes
    cut = columns.java_trim(cut_bytes(text.cut_chars(body, max_chars), byte_limit))
    kept_type = F.col("mime_type") if "mime_type" in files.columns else found
    return (
        staged.withColumn("limit_reached", F.when(limited, True))
        .withColumn("route", F.when(failed, schema.FAILURE).otherwise(schema.SUCCESS))
        .withColumn("mime_type", F.when(failed, kept_type).otherwise("text/plain"))
        .withColumn(content, F.when(failed, F.col(content)).otherwise(F.encode(cut, "UTF-8")))
        .drop("_type", "_text", "_kind")
    )
