"""Company, role and topics of a story by lists of names: tables of names in, one Arrow pass over title and content."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions import rules

#: A level after a role. The text is lower-cased, so only digits are found in titles and after triggers; Roman
#: numerals of canonical names become digits where a name is found by scanning alone.
_LEVEL = r"[\s\-]*(\d{1,2}|I{1,3}|IV|VI{0,3}|IX|X)?"
_ROMAN = re.compile(r"\b(I{1,3}|IV|VI{0,3}|IX|X)\b")
_DIGITS = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "vii": "7", "viii": "8", "ix": "9", "x": "10"}


def alias_map(names: DataFrame | None, key: str, name: str) -> dict[str, str]:
    """Lower-case alias to name, in the order of ``key``; a later entry wins. The table must be a short list."""
    found: dict[str, str] = {}
    for row in names.select(name, "aliases").orderBy(key).collect() if names is not None else []:
        if row[0]:
            found[row[0].lower()] = row[0]
            found.update((a.lower(), row[0]) for a in row[1] or [] if a)
    return found


class Names:
    """Names of one list, the longest alias first; a plain search sorts out aliases before a pattern is tried."""

    def __init__(self, aliases: dict[str, str]):
        self.aliases = aliases
        self.order = sorted(aliases, key=len, reverse=True)
        self.known: dict[str, re.Pattern] = {}

    def pattern(self, p: str) -> re.Pattern:
        got = self.known.get(p)
        if got is None:
            got = self.known[p] = re.compile(p)
        return got

    def scan(self, *texts: str) -> str | None:
        for t in texts:
            for a in self.order:
                if a in t and self.pattern(rf"\b{re.escape(a)}\b").search(t):
                    return self.aliases[a]
        return None

    def _levelled(self, alias: str, level: str | None) -> str:
        return f"{self.aliases[alias]} {_DIGITS.get(level.lower(), level)}" if level else self.aliases[alias]

    def titled(self, t: str) -> str | None:
        for a in self.order:
            if a in t and (m := self.pattern(rf"\b{re.escape(a)}{_LEVEL}\b").search(t)):
                return self._levelled(a, m.group(1))
        return None

    def triggered(self, t: str) -> str | None:
        there = [a for a in self.order if a in t]
        for trigger in rules.ROLE_TRIGGERS if there else []:
            for a in there:
                if m := self.pattern(trigger + re.escape(a) + _LEVEL).search(t):
                    return self._levelled(a, m.group(1))
        return None


def named(title: Column, content: Column, slot: Column, companies: dict[str, str], roles: dict[str, str]) -> Column:
    """struct(company, role, topics). ``slot`` is the company by the title's form, if any: it becomes its listed name,
    else it is put in title case; without it the longest listed name of title, head or text counts. A role is taken
    from the title, then after a trigger in the head, then anywhere. Topics are sorted."""

    @F.pandas_udf("company string, role string, topics array<string>")
    def find(title: pd.Series, content: pd.Series, slot: pd.Series) -> pd.DataFrame:
        firms, jobs = Names(companies), Names(roles)
        topics = [(k, [(w, re.compile(rf"\b{re.escape(w)}\b")) for w in words]) for k, words in sorted(rules.TOPICS.items())]
        rows = []
        for t, c, s in zip(title, content, slot, strict=True):
            t, c = (t or "").lower(), c or ""
            head, c = c[:500].lower(), c.lower()
            company = (companies.get(s.lower()) or s.strip().title()) if s else firms.scan(t, head, c)
            role = jobs.titled(t) or jobs.triggered(head)
            if not role and (role := jobs.scan(t, head, c)):
                role = _ROMAN.sub(lambda m: _DIGITS.get(m.group().lower(), m.group()), role)
            both = f"{t}\n{c}"
            rows.append((company, role, [k for k, words in topics if any(w in both and p.search(both) for w, p in words)]))
        return pd.DataFrame(rows, columns=["company", "role", "topics"])

    return find(title, content, slot)
