"""Text expressions: titles, cleaning, header keys, labels, notes."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from schemaward import constants as K

# Java's \s is ASCII unless (?U) is set.
_BLANKS = r"(?U)\s+"
_NOT_PRINTABLE = r"[^\x20-\x7E\t\n\r]+"


def squeeze(c: Column) -> Column:
    """Collapse whitespace runs to one space and trim."""
    return F.trim(F.regexp_replace(c, _BLANKS, " "))


def strip(c: Column) -> Column:
    """Trim every kind of whitespace (``trim`` alone removes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def title_variants(t: Column) -> Column:
    """H1: ordered search variants of a title as array<string>.

    Equal variants keep their place, because a repeated search still counts as
    an attempt; only the rules' own "differs from" tests remove entries.
    """
    flat = squeeze(t)
    tight = F.replace(F.replace(flat, F.lit(" : "), F.lit(": ")), F.lit(":  "), F.lit(": "))
    dense = F.replace(t, F.lit(" "), F.lit(""))
    wide = squeeze(F.replace(flat, F.lit(":"), F.lit(" : ")))
    return F.array_compact(F.array(
        t,
        F.when(flat != t, flat),
        F.when(tight != flat, tight),
        F.when(dense != t, dense),
        F.when((wide != t) & (wide != flat) & (wide != tight), wide),
    ))


def clean_text(c: Column) -> Column:
    """H2: non-printable runs to a space, whitespace collapsed, trimmed."""
    return squeeze(F.regexp_replace(c, _NOT_PRINTABLE, " "))


def clean_array(c: Column) -> Column:
    """H2 over array<string>."""
    return F.transform(c, clean_text)


def clean_map(c: Column) -> Column:
    """H2 over map values; keys are left alone."""
    return F.transform_values(c, lambda _, v: clean_text(v))


def clean_strings(df, skip=()):
    """H2 over every string column of a DataFrame."""
    return df.select(*[
        clean_text(F.col(n)).alias(n) if t == "string" and n not in skip else F.col(n) for n, t in df.dtypes
    ])


def header_key(c: Column) -> Column:
    """H3: blanks and dashes to underscores, question marks out, lower case."""
    return F.lower(F.translate(c, " -?", "__"))


def is_yes(c: Column) -> Column:
    """True only for 'yes' in any case, blanks around it ignored."""
    return F.coalesce(F.lower(strip(c)) == "yes", F.lit(False))


def cell_default(c: Column, key: Column) -> Column:
    """H4 + H5: flag cells become 'true'/'false'; other missing cells become ''."""
    flag = F.when(F.coalesce(F.lower(c) == "yes", F.lit(False)), "true").otherwise("false")
    return F.when(key.isin(*K.FLAG_KEYS), flag).otherwise(F.coalesce(c, F.lit("")))


def label_value(c: Column, label: str) -> Column:
    """H6: text after the first occurrence of a label; null without the label."""
    at = F.instr(c, label)
    value = strip(F.substring(c, at + F.lit(len(label)), F.length(c)))
    return F.when(at > 0, strip_historisation(value) if label == K.DATABASE_LABEL else value)


def strip_historisation(c: Column) -> Column:
    """H7: remove the historisation suffix of a database name."""
    return strip(F.replace(c, F.lit(K.HISTORISATION_SUFFIX), F.lit("")))


def key_list(c: Column) -> Column:
    """H8: comma list to trimmed non-blank names; null gives an empty array."""
    names = F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")
    return F.coalesce(names, F.array().cast("array<string>"))


def table_name_or_title(name: Column, title: Column) -> Column:
    """H9: table name, or the title without its prefix."""
    return F.coalesce(F.nullif(name, F.lit("")), strip(F.replace(title, F.lit(K.TITLE_PREFIX), F.lit(""))))


def file_key(c: Column) -> Column:
    """Lower case, blanks to underscores, only [a-z0-9_.-] kept."""
    return F.regexp_replace(F.lower(F.replace(c, F.lit(" "), F.lit("_"))), "[^a-z0-9_.-]", "")


# Character references that need no semicolon; longer names first, so that the longest one that fits is read.
_BARE_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
_ATTRIBUTES = r"""(?>[^>"']++|"[^"]*+"|'[^']*+')*+"""
# One token a match: hidden elements with their text, character data (group 1), tags, comments, declarations, then text.
_TOKENS = (
    r"(?is)<(script|style)(?=[\s/>])[^>]*+(?<!/)>.*?(?:</\1(?=[\s/>])[^>]*+>|\z)"
    rf"|<(template|rt|rp)(?=[\s/>]){_ATTRIBUTES}(?<!/)>.*?</\2(?=[\s/>])[^>]*+>"
    r"|<!\[CDATA\[.*?(?:\]\]>|\z)|<!--.*?(?:-->|\z)|</[a-z][^>]*+>"
    rf"|<[a-z][^\s/>]*+{_ATTRIBUTES}>|<[!?][^>]*+(?:>|\z)|[^<]++|<")
_REFERENCE = r"(?s)^(&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[0-9a-zA-Z]++;?))(.*)$"


def _by_number(n: Column) -> Column:
    """The character of a numeric reference as HTML reads it: windows-1252 for 128 to 159, none for codes without character."""
    remapped = {str(k): bytes([k]).decode("cp1252", "replace").replace("\ufffd", chr(k)) for k in range(0x80, 0xA0)}
    table = F.from_json(F.lit(json.dumps(remapped)), "map<string,string>")
    none = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE)
    utf32 = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (F.when(n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd").when(n.between(0x80, 0x9F), table[n.cast("string")])
            .when(none, "").otherwise(utf32))


def _dereferenced(piece: Column) -> Column:
    """A piece of text that may begin with one character reference."""
    head, rest = F.regexp_extract(piece, _REFERENCE, 1), F.regexp_extract(piece, _REFERENCE, 2)
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    name = F.substring(head, F.lit(2), F.length(head))
    digits = F.rtrim(F.substring(head, F.lit(3), F.length(head)), F.lit(";"))
    hexadecimal = F.lower(F.substring(digits, F.lit(1), F.lit(1))) == "x"
    number = F.when(hexadecimal, F.conv(F.substring(digits, F.lit(2), F.length(digits)), 16, 10)).otherwise(digits).try_cast("long")
    known = F.try_element_at(names, name)
    bare = F.regexp_extract(name, f"^({_BARE_NAMES})", 1)
    named = F.when(known.isNotNull(), known).when(bare != "", F.concat(F.try_element_at(names, bare), F.substring(name, F.length(bare) + 1, F.length(name)))).otherwise(head)
    read = F.when(name.startswith("#"), _by_number(number)).otherwise(named)
    return F.when(head == "", piece).otherwise(F.concat(read, rest))


def decode_references(text: Column) -> Column:
    """Character references of HTML to their characters, by name or number; each is read once."""
    pieces = F.transform(F.split(text, "(?=&)"), _dereferenced)
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def cell_text(html: Column) -> Column:
    """H13 as an expression: the shown text, nodes parted by blanks, references decoded, nbsp to blank, collapsed and trimmed.

    Scripts, styles, comments and what stands in template, rt and rp elements are left out. Unlike the outline of a
    page this keeps no tree: a template, rt or rp that is nested in its like or not closed shows its text.
    """
    def shown(token: Column) -> Column:
        data = F.regexp_extract(token, r"(?is)^<!\[CDATA\[(.*?)(?:\]\]>)?$", 1)
        return F.when(F.length(token) == 1, token).when(token.rlike(r"(?is)^<!\[CDATA\["), F.concat(F.lit(" "), data, F.lit(" "))).when(token.startswith("<"), " ").otherwise(decode_references(token))

    text = F.array_join(F.transform(F.regexp_extract_all(html, F.lit(_TOKENS), F.lit(0)), shown), "")
    return squeeze(F.replace(F.replace(text, F.lit("\xa0"), F.lit(" ")), F.lit("&nbsp;"), F.lit(" ")))


def add_note(c: Column, *notes: Column) -> Column:
    """Append notes with ' | '; null notes are skipped."""
    return F.concat_ws(" | ", F.nullif(c, F.lit("")), *notes)


def title_or_default(api_title: Column, found_title: Column, page_id: Column) -> Column:
    """API title, else found title, else a label made of the page id."""
    return F.coalesce(F.nullif(api_title, F.lit("")), found_title, F.concat(F.lit("Page ID:"), page_id.cast("string")))


def labels_json(c: Column) -> Column:
    """Array of labels as JSON text with ', ' between items; null as '[]'."""
    return F.coalesce(F.replace(F.to_json(c), F.lit('","'), F.lit('", "')), F.lit("[]"))
