"""Text functions as column expressions; Arrow-batched Python only where Spark has no built-in."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions import rules

WS = r"[ \t\n\r\f\x0B]"
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}"
    r"\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FAFF}\x{2600}-\x{26FF}\x{FE00}-\x{FE0F}\x{200D}]+"
)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{WS}+|{WS}+$", "")


def is_blank(c: Column) -> Column:
    return F.length(F.coalesce(strip(c), F.lit(""))) == 0


def words(c: Column) -> Column:
    """The text split at white space; an empty array for NULL and blank texts."""
    return F.when(is_blank(c), F.array().cast("array<string>")).otherwise(F.split(strip(c), rf"{WS}+"))


def word_count(c: Column) -> Column:
    """len(text.split()), 0 for NULL: white space runs are counted without building the words."""
    return F.when(is_blank(c), 0).otherwise(F.regexp_count(strip(c), F.lit(rf"{WS}+")) + 1)


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, rf"{WS}+", " "))


def content_key(c: Column) -> Column:
    return F.sha2(collapse(F.lower(c)), 256)


def fix_literals(c: Column, table: dict[str, str] = rules.LITERALS) -> Column:
    single = {k: v for k, v in table.items() if len(v) <= 1 and k != "\x00"}
    kept = [(k, v) for k, v in single.items() if v] + [(k, "") for k, v in single.items() if not v]
    c = F.translate(c, "".join(k for k, _ in kept), "".join(v for _, v in kept))
    for k, v in table.items():
        if k not in single:
            c = F.replace(c, F.lit(k), F.lit(v))
    return c


def chain(c: Column, pairs: list[tuple[str, str]]) -> Column:
    for pattern, by in pairs:
        c = F.regexp_replace(c, pattern, by)
    return c


def strip_markdown(c: Column) -> Column:
    return chain(F.regexp_replace(c, r"```[\s\S]*?```", " [code block removed] "), rules.MARKDOWN)


def strip_html(c: Column) -> Column:
    """Text of a page: scripts, styles, navigation and comments dropped, block tags as line breaks."""
    c = F.regexp_replace(c, r"(?is)<(script|style|nav|footer|header|aside|noscript)\b[^>]*>.*?</\1>|<!--.*?-->", "")
    return F.regexp_replace(F.regexp_replace(c, r"(?i)<(p|div|br|h[1-6]|li|tr)\b[^>]*>", "\n"), r"(?s)<[a-zA-Z/!][^>]*>", "")


def strip_boilerplate(c: Column, platform: Column) -> Column:
    by_platform = c
    for name, patterns in rules.PLATFORM_BOILERPLATE.items():
        by_platform = F.when(platform == name, chain(c, [(p, "") for p in patterns])).otherwise(by_platform)
    return chain(by_platform, [(p, "") for p in rules.BOILERPLATE])


def strip_emoji(c: Column) -> Column:
    return F.regexp_replace(c, EMOJI, "")


def tidy_spaces(c: Column) -> Column:
    return strip(chain(c, [(r"[^\S\n]+", " "), (r"\n{3,}", "\n\n"), (r"\n\s+\n", "\n\n"), (r" +\n", "\n")]))


@F.pandas_udf(T.StringType())
def repair_encoding(s: pd.Series) -> pd.Series:
    """HTML entities, text once read as Latin-1, and composed form (NFC)."""

    def one(t: str) -> str:
        t = html.unescape(t)
        try:
            t = t.encode("latin-1").decode("utf-8")
        except UnicodeError:
            pass
        return unicodedata.normalize("NFC", t)

    # nothing can change in a text of plain ASCII without an entity
    return s.map(lambda t: t if t is None or ("&" not in t and t.isascii()) else one(t))


def redactor(pii: list[tuple[str, str, str]]):  # noqa: ANN201
    """A function of a text column: struct(content, counts) after all rules in order, each counted on the text the
    ones before left. One pass in Arrow batches: as nested expressions each rule would evaluate all before it again."""

    @F.pandas_udf("content string, counts map<string,int>")
    def redacted(s: pd.Series) -> pd.DataFrame:
        compiled = [(kind, placeholder, re.compile(pattern)) for kind, placeholder, pattern in pii]
        texts, counts = [], []
        for t in s:
            found: dict[str, int] = {}
            for kind, placeholder, pattern in compiled if t else ():
                t, n = pattern.subn(placeholder, t)
                if n:
                    found[kind] = found.get(kind, 0) + n
            texts.append(t)
            counts.append(found)
        return pd.DataFrame({"content": texts, "counts": counts})

    # so marked, it is not evaluated again in a filter that the planner infers from its counts
    return redacted.asNondeterministic()


def platform(c: Column) -> Column:
    key = F.lower(strip(c))
    pairs = [x for k, v in rules.PLATFORMS.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), key)


def normalize_body(c: Column, source: Column) -> Column:
    c = fix_literals(repair_encoding(c))
    c = F.when(c.contains("<"), strip_html(c)).otherwise(c)
    return tidy_spaces(strip_emoji(strip_boilerplate(strip_markdown(c), platform(source))))


def normalize_title(c: Column) -> Column:
    c = fix_literals(repair_encoding(c))
    return collapse(strip_emoji(F.when(c.contains("<"), strip_html(c)).otherwise(c)))


def document_id(source: Column, url: Column) -> Column:
    """{platform}_ and the first six signs of the URL-safe base64 of the URL's SHA-256."""
    return F.concat(source, F.lit("_"), F.translate(F.substring(F.base64(F.unhex(F.sha2(url, 256))), 1, 6), "+/", "-_"))


def any_of(keywords: list[str]) -> str:
    """One pattern that finds any keyword as a whole word."""
    escaped = ["".join("\\" + x if x in ".^$*+?{}[]()|\\" else x for x in k) for k in keywords]
    return r"(?i)\b(" + "|".join(escaped) + r")\b"


def first_label(c: Column, table: dict[str, list[str]], otherwise: Column | None = None) -> Column:
    """The first label of ``table`` one of whose keywords occurs."""
    out = None
    for label, keywords in table.items():
        out = F.when(c.rlike(any_of(keywords)), label) if out is None else out.when(c.rlike(any_of(keywords)), label)
    return out if otherwise is None else out.otherwise(otherwise)
