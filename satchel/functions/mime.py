"""Type identification as Catalyst expressions: narrow, no shuffle, no Python worker."""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from satchel.functions.magic import (
    ARCHIVE_TYPES,
    HEAD_BYTES,
    HTML,
    OCTET_STREAM,
    RULES,
    TEXT_EXTENSIONS,
    TEXT_PLAIN,
    TEXT_WINDOW,
    UNREADABLE_ARCHIVE_TYPES,
    XHTML,
    XML,
    Rule,
)


RULE_TYPE = "array<struct<rank:int,mime:string,parts:array<struct<off:int,magic:binary>>,needle:binary>>"


def _rule_json(rank: int, rule: Rule) -> dict:
    def b64(data: bytes) -> str:
        return base64.b64encode(data).decode()

    parts = [{"off": offset, "magic": b64(bytes.fromhex(magic))} for offset, magic in rule.parts]
    needle = {"needle": b64(rule.needle.encode())} if rule.needle else {}
    return {"rank": rank, "mime": rule.mime, "parts": parts} | needle


def _constant(value: object, kind: str) -> str:
    return f"from_json({_quoted(json.dumps(value))}, '{kind}')"


def _magic_sql(head: str, content: str, rules: Sequence[Rule]) -> str:
    """The type of the first rule that holds; the whole content is touched only for a rule with a needle.

    The rules are constants that higher-order functions run over: those for the first byte, by that byte, and those that
    look further in.  One CASE branch per rule would make a single generated method too long for the JVM to compile to
    machine code, and many times slower.
    """
    by_byte: dict[str, list[dict]] = {}
    further_in = []
    for rank, rule in enumerate(rules):
        offset, magic = rule.parts[0]
        (by_byte.setdefault(magic[:2].upper(), []) if offset == 0 else further_in).append(_rule_json(rank, rule))
    first_byte = f"try_element_at({_constant(by_byte, f'map<string,{RULE_TYPE}>')}, hex(substring({head}, 1, 1)))"
    candidates = f"concat(coalesce({first_byte}, {_constant([], RULE_TYPE)}), {_constant(further_in, RULE_TYPE)})"
    return f"""array_min(transform(filter({candidates}, rule ->
        forall(rule.parts, part -> substring({head}, part.off + 1, length(part.magic)) = part.magic)
        AND (rule.needle IS NULL OR contains({content}, rule.needle))),
        rule -> named_struct('rank', rule.rank, 'mime', rule.mime))).mime"""


def _text_case(latin: str) -> str:
    """No control bytes other than tab, line ends, form feed and escape, and the rest is UTF-8 or mostly ASCII."""
    whole_chars = rf"regexp_replace({latin}, r'[\xC0-\xFF][\x80-\xBF]{{0,2}}\z', '')"
    utf8 = f"is_valid_utf8(CAST(encode({whole_chars}, 'ISO-8859-1') AS STRING))"
    high = rf"length(regexp_replace({latin}, r'[\x00-\x7F]+', ''))"
    clean_bytes = rf"NOT {latin} RLIKE r'[\x00-\x08\x0B\x0E-\x1A\x1C-\x1F]'"
    return f"WHEN {clean_bytes} AND ({utf8} OR {high} * 10 < length({latin})) THEN '{TEXT_PLAIN}'"


HTML_START = r"<(?:!DOCTYPE\s+html|html|head|body|title|h1)[\s>]"


def _markup_cases(latin: str) -> str:
    """HTML and XML by how the text begins, behind white space, comments and prolog of any length.

    What may stand before the root is taken off piece by piece, each found where the one before it ended; one pattern for
    all of it would go a level deeper for every comment.
    """
    before = r"^\xEF\xBB\xBF|\s+|<!--.*?-->"
    behind_comments = rf"regexp_replace({latin}, r'(?s)\G(?:{before})', '')"
    behind_prolog = rf"regexp_replace({latin}, r'(?is)\G(?:{before}|<\?xml.*?\?>|<!DOCTYPE[^>]*>)', '')"

    def root(name: str) -> str:
        return rf"x.prolog RLIKE r'(?i)^<{name}[\s>]'"

    xml = r"x.comments RLIKE r'(?i)^<\?xml\s'"
    return f"""get(transform(array(struct({behind_comments} AS comments, {behind_prolog} AS prolog)), x -> CASE
        WHEN {xml} AND {root('html')} THEN '{XHTML}'
        WHEN x.comments RLIKE r'(?i)^{HTML_START}' THEN '{HTML}'
        WHEN {root('svg')} THEN 'image/svg+xml'
        WHEN {root('rss')} THEN 'application/rss+xml'
        WHEN {root('feed')} THEN 'application/atom+xml'
        WHEN {xml} THEN '{XML}' END), 0)"""


def detect_sql(content: str, rules: Sequence[Rule] | None = None) -> str:
    """The head is bound once: every mention of a binary column would copy the whole file out of its row.

    Only a file that may begin with a tag is looked at beyond its head.
    """
    table = RULES if rules is None else rules
    reach = max([HEAD_BYTES] + [offset + len(magic) // 2 for rule in table for offset, magic in rule.parts])
    by_text = f"""get(transform(array(decode(substring(head, 1, {TEXT_WINDOW}), 'ISO-8859-1')), latin -> CASE {_text_case("latin")} END), 0)"""
    if rules is None:
        markup = f"""get(transform(array(decode({content}, 'ISO-8859-1')), whole -> {_markup_cases("whole")}), 0)"""
        tagged = r"decode(head, 'ISO-8859-1') RLIKE r'^(?:\xEF\xBB\xBF)?\s*(?:<|\z)'"
        # most pages say it in their head, and need not be looked at whole
        plainly = rf"decode(head, 'ISO-8859-1') RLIKE r'(?i)^(?:\xEF\xBB\xBF)?\s*{HTML_START}'"
        by_text = f"coalesce(CASE WHEN {plainly} THEN '{HTML}' WHEN {tagged} THEN {markup} END, {by_text})"
    return f"""coalesce(get(transform(array(substring({content}, 1, {reach})), head ->
        CASE WHEN length(head) > 0 THEN coalesce({_magic_sql("head", content, table)}, {by_text}) END), 0), '{OCTET_STREAM}')"""


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def detect(content: str, rules: Sequence[Rule] | None = None) -> Column:
    """The full type of the bytes in column ``content``, parameters included.  A name never influences the answer.

    ``rules`` replaces the built-in table; the text tests for HTML and XML belong to the built-in table, so with own
    rules only plain text and ``application/octet-stream`` remain as fallbacks.
    """
    return F.expr(detect_sql(content, rules))


def clean(mime: Column) -> Column:
    """Drop type parameters: ``a/b; version=5`` becomes ``a/b``."""
    return F.substring_index(mime, ";", 1)


def known_extensions(rules: Sequence[Rule] | None = None) -> dict[str, str]:
    known = dict(TEXT_EXTENSIONS)
    for rule in RULES if rules is None else rules:
        known.setdefault(rule.mime, rule.ext)
    return known


def extension(mime: Column, rules: Sequence[Rule] | None = None) -> Column:
    """Usual extension of a full (uncleaned) type, ``''`` when there is none; gzip is ``.gz``, never ``.tgz``."""
    lookup = F.from_json(F.lit(json.dumps(known_extensions(rules))), "map<string,string>")
    ext = F.coalesce(F.try_element_at(lookup, mime), F.lit(""))
    return F.when((mime == "application/gzip") & (ext == ".tgz"), ".gz").otherwise(ext)


def is_archive_type(mime: Column) -> Column:
    return clean(mime).isin(*ARCHIVE_TYPES)


def is_unreadable_archive_type(mime: Column) -> Column:
    return clean(mime).isin(*UNREADABLE_ARCHIVE_TYPES)


def parse_rules(body: str) -> list[Rule]:
    """A user rule set from a JSON array; lower ``priority`` is tried first, ties keep their order.

    Each item: ``{"type": …, "extension": …, "priority": …, "offset": …, "hex": … or "text": …}``.
    Anything that is not such an array is refused, so a bad rule set stops the operator before any data is read.
    """
    try:
        items = json.loads(body)
        ranked = sorted(items, key=lambda item: int(item.get("priority", 50)))
        rules = [_parse_rule(item) for item in ranked]
    except (ValueError, TypeError, AttributeError, KeyError) as exc:
        raise ValueError(f"failed to load the type rules: {exc}") from exc
    if not rules:
        raise ValueError("failed to load the type rules: no rules given")
    return rules


def _parse_rule(item: dict) -> Rule:
    magic = item["hex"] if "hex" in item else item["text"].encode("utf-8").hex()
    if not bytes.fromhex(magic):
        raise ValueError("a rule needs at least one byte to look for")
    return Rule(str(item["type"]), str(item.get("extension", "")), ((int(item.get("offset", 0)), magic.upper()),))
