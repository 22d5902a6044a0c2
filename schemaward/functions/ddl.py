"""Columns of a CREATE TABLE statement, with native string expressions only.

Comments and literals go first, then what is left is read once, into tokens: quoted names, sizes like ``(10, 2)``, single
brackets and commas, and the text between. Every pattern is possessive, so neither long literals nor thousands of columns
cost stack or a second look. Bracket depth is then carried along the tokens; commas at depth one cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# a quoted name is kept; line comments, block comments and literals go
_NOISE = r"(\x22[^\x22]*+\x22)|--[^\n]*+|/\*[\s\S]*?\*/|'[^']*+'"
_TOKEN = r"(\x22[^\x22]*+\x22|\(\s*+\d++\s*+(?:,\s*+\d++\s*+)?\)|[(),]|[^\x22(),]++|\x22)"
_PART = r"(?:\x22[^\x22]*+\x22|[\w$]++)"
_HEAD = (r"(?i)^\s*+create\s++(?:or\s++(?:replace|alter)\s++)?(?:(?:local|global)\s++)?(?:(?:transient|temporary|temp|volatile)\s++)?table\s++"
         rf"(?:if\s++not\s++exists\s++)?{_PART}(?:\s*+\.\s*+{_PART})*\s*+\($")
_CONSTRAINT = r"(?i)^(?:CONSTRAINT|PRIMARY|FOREIGN|UNIQUE|CHECK)\b"
# marks inside a column list: a cut, the two ends of a quoted name, a quote that is doubled inside it, and what went
_CUT, _OPEN, _CLOSE, _DOUBLED, _GONE = "\u0001", "\u0002", "\u0003", "\u0004", "\u0005"
_NAME = rf"^\s*+(?:{_OPEN}([^{_CLOSE}]*+){_CLOSE}|([\w$]++))"
_WORDS = r"(?:DOUBLE\s++PRECISION|(?:NATIONAL\s++)?CHAR(?:ACTER)?\s++VARYING|NCHAR\s++VARYING|BIT\s++VARYING|[A-Z_]\w*+)"
_TYPE = rf"(?i){_NAME}\s++({_WORDS}(?:\s*+\([\d\s,]++\))?(?:\s++WITH(?:OUT)?\s++(?:LOCAL\s++)?TIME\s++ZONE)?)"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _roles(tokens: Column) -> Column:
    """One letter for each token: b before the column list, i inside it, c a comma at depth one, e its end, a after it."""
    state = lambda depth, out: F.struct(depth.alias("depth"), out.alias("out"))

    def step(s: Column, x: Column) -> Column:
        depth = s["depth"]
        add = lambda d, letter: state(d, F.concat(s["out"], F.lit(letter)))
        inside = F.when(x == "(", add(depth + 1, "i")).when(x == ")", F.when(depth == 1, add(F.lit(-1), "e")).otherwise(add(depth - 1, "i"))).when(
            (x == ",") & (depth == 1), add(depth, "c")).otherwise(add(depth, "i"))
        return F.when(depth > 0, inside).when((depth == 0) & (x == "("), add(F.lit(1), "b")).when(depth == 0, add(depth, "b")).otherwise(add(depth, "a"))

    return F.aggregate(tokens, state(F.lit(0), F.lit("")), step, lambda s: s["out"])


def _column(item: Column) -> Column:
    """struct<name, type> of an entry of the column list, null where it is none."""
    kind = F.regexp_extract(item, _TYPE, 3)
    quoted = F.replace(F.regexp_extract(item, _NAME, 1), F.lit(_DOUBLED), F.lit('"'))
    tidy = F.when(kind.rlike(r"[\s(]"), F.regexp_replace(F.regexp_replace(F.regexp_replace(kind, r"\s++", " "), r" ?([(,]) ?", "$1"), r" \)", ")")).otherwise(kind)
    constraint = F.ltrim(F.regexp_replace(item, r"^\s++", "")).rlike(_CONSTRAINT)
    return F.when((kind != "") & ~constraint, F.struct(F.upper(F.when(quoted != "", quoted).otherwise(F.regexp_extract(item, _NAME, 2))).alias("name"), F.upper(tidy).alias("type")))


def ddl_column_array(ddl: Column) -> Column:
    """array<struct<ordinal, name, type>>; empty for views and other statements.

    Comments and literals are no part of it. Names are plain or quoted, with any characters inside the quotes but the
    first five control characters; types may have two words, a length or precision, and a time zone clause. Anything
    else in brackets is skipped, however deep it is nested.
    """
    bare = F.replace(F.regexp_replace(ddl, _NOISE, f"$1{_GONE}"), F.lit(f'"{_GONE}"'), F.lit('""'))
    tokens = F.regexp_extract_all(F.translate(bare, _GONE, " "), F.lit(_TOKEN), F.lit(1))
    marked = lambda x: F.when(x.startswith('"'), F.concat(F.lit(_OPEN), F.substring(x, F.lit(2), F.length(x) - 2), F.lit(_CLOSE))).otherwise(x)

    def columns(t: Column) -> Column:
        head = F.array_join(F.slice(t, F.lit(1), F.array_position(t, "(").cast("int")), "")

        def listed(roles: Column) -> Column:
            inner = F.zip_with(t, F.split(roles, ""), lambda x, r: F.when(r == "c", _CUT).when(r == "i", marked(x)).otherwise(""))
            body = F.replace(F.array_join(inner, ""), F.lit(_CLOSE + _OPEN), F.lit(_DOUBLED))
            found = F.filter(F.transform(F.split(body, _CUT, -1), _column), lambda x: x.isNotNull())
            return F.when(roles.contains("e"), F.transform(found, lambda x, i: F.struct((i + 1).alias("ordinal"), x["name"].alias("name"), x["type"].alias("type"))))

        return F.when(head.rlike(_HEAD), _let(_roles(t), listed))

    return F.coalesce(_let(tokens, columns), F.array().cast("array<struct<ordinal:int,name:string,type:string>>"))


def ddl_columns(df, ddl: str = "ddl"):
    """H15 as rows: every input column except the text, plus ordinal, name, type.

    Statements repeat across runs and environments, but the extraction stays in
    the row: it is cheaper than a shuffle on the text.
    """
    keep = [c for c in df.columns if c != ddl]
    return df.select(*keep, F.inline(ddl_column_array(F.col(ddl))))
