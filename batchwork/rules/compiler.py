"""Ordered rules held as data, compiled into few projections.

A rule is a chain of cases: the first case whose condition holds sets its columns (an
``if / else if`` ladder; a plain rule has one case).  Rules run in order and a later rule sees
what the earlier ones set, so the last matching rule wins.

Run one by one they would nest one projection per rule.  ``compile_rules`` draws the graph of what
each rule reads and writes instead and puts every rule at the lowest level that keeps the order's
meaning: above the writers of what it reads, not below the readers and writers of what it
writes.  A level is one projection; within it the rules on one column fold into one nested ``CASE``.

Conditions and values are SQL text, so that what they read can be seen.

A level copies its whole row, so a wide table costs columns times levels.  ``set_aside`` puts the
table into one struct: it passes a level as one value, and the rules read its fields in place.
Only what a rule has written, and a later one reads or writes, is a column of its own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NAME = re.compile(r"'(?:[^']|'')*'|([A-Za-z_][A-Za-z_0-9]*)")
ASIDE = "__aside"


@dataclass(frozen=True)
class Rule:
    """Cases in order, each a condition and the columns that it sets."""

    cases: tuple[tuple[str, dict[str, str]], ...]

    def reads(self, columns: set[str]) -> set[str]:
        text = " ".join(c + " " + " ".join(sets.values()) for c, sets in self.cases)
        return {m.lower() for m in _NAME.findall(text) if m} & columns

    @property
    def writes(self) -> set[str]:
        return {c for _, sets in self.cases for c in sets}


def rule(when: str, **sets: str | int) -> Rule:
    return Rule(((when, {c: str(v) for c, v in sets.items()}),))


def ladder(*cases: tuple[str, dict[str, str | int]]) -> Rule:
    return Rule(tuple((w, {c: str(v) for c, v in sets.items()}) for w, sets in cases))


def within(when: str, name: str, *rules: Rule) -> list[Rule]:
    """Rules of a block: its condition is taken once, on entry, in the flag ``name``."""
    inner = [Rule(tuple((f"{name} AND ({w})", sets) for w, sets in r.cases)) for r in rules]
    return [rule("true", **{name: f"coalesce({when}, false)"}), *inner]


def listed(column: str, values) -> str:
    """``column IN (...)`` over numbers, texts and ranges ``(low, high)``; missing is in no list."""
    single = [v for v in values if not isinstance(v, tuple)]
    parts = [f"{column} IN ({', '.join(repr(v) if isinstance(v, str) else str(v) for v in single)})"] if single else []
    parts += [f"{column} BETWEEN {lo} AND {hi}" for lo, hi in (v for v in values if isinstance(v, tuple))]
    return f"coalesce({' OR '.join(parts)}, false)"


def unlisted(column: str, values) -> str:
    return f"NOT {listed(column, values)}"


def levels(rules: list[Rule], columns: set[str]) -> list[list[Rule]]:
    """The rules by level, each level in the rules' order."""
    known = columns | {c for r in rules for c in r.writes}
    at, out = [], []
    for i, r in enumerate(rules):
        reads, writes, level = r.reads(known), r.writes, 0
        for j in range(i):
            if rules[j].writes & reads:
                level = max(level, at[j] + 1)
            elif (rules[j].reads(known) | rules[j].writes) & writes:
                level = max(level, at[j])
        at.append(level)
        while len(out) <= level:
            out.append([])
        out[level].append(r)
    return out


def set_aside(df: DataFrame, keep: list[str] | None = None, blank: list[str] | None = None) -> DataFrame:
    """``df`` with its columns but ``keep`` in one struct, for ``compile_rules`` (``blank`` is as there)."""
    df = _blanked(df, blank)
    keep = keep or []
    return df.select(*keep, F.struct(*[c for c in df.columns if c not in keep]).alias(ASIDE))


def _led(text: str, places: dict[str, str]) -> str:
    """The text with the names of columns that are in a struct led by its name."""
    return _NAME.sub(lambda m: places.get(m[1].lower(), m[0]) if m[1] else m[0], text)


def _blanked(df: DataFrame, blank: list[str] | None) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.rtrim(F.col(c)), F.lit("")) for c in blank}) if blank else df


def _folded(rules: list[Rule], column: str, base: Column) -> Column:
    """The column after the rules of one level, all of which see the level's input."""
    value = base
    for r in rules:
        if column not in r.writes:
            continue
        others, chain = [], None  # cases above that leave the column alone keep their claim
        for when, sets in r.cases:
            if column not in sets:
                others.append(when)
                continue
            fires = F.expr(when) & ~F.expr(" OR ".join(f"coalesce({o}, false)" for o in others)) if others else F.expr(when)
            chain = F.when(fires, F.expr(sets[column])) if chain is None else chain.when(fires, F.expr(sets[column]))
        value = chain.otherwise(value)
    return value


def compile_rules(df: DataFrame, rules: list[Rule], blank: list[str] | None = None, types: dict[str, str] | None = None,
                  columns: list[str] | None = None) -> DataFrame:
    """``df`` after the rules, one projection per level.

    ``blank`` names text columns in which missing, blank and trailing blanks are all the same
    (the empty text); ``types`` gives the types of columns that the rules create.  Columns
    whose names start with ``_`` are flags of blocks and do not come back.  ``columns`` gives
    the order of the columns of a table that was ``set_aside``; it comes back as columns.
    """
    df = _blanked(df, blank)
    types = types or {}
    if ASIDE in df.columns:
        return _compiled_aside(df, rules, types, columns or [])
    for group in levels(rules, {c.lower() for c in df.columns}):
        df = df.withColumns(_written(group, types, {c.lower(): c for c in df.columns}))
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def _written(group: list[Rule], types: dict[str, str], places: dict[str, str]) -> dict[str, Column]:
    """The columns that the rules of a level write, from those at hand."""
    new = {}
    for c in sorted({c for r in group for c in r.writes}):
        base = F.col(places[c]) if c in places else F.lit(None)
        value = _folded(group, c, base.cast(types[c]) if c in types else base)
        new[c] = value.cast(types[c]) if c in types else value
    return new


# so many columns that no later rule names are worth a struct of their own
SETTLED = 3


def _compiled_aside(df: DataFrame, rules: list[Rule], types: dict[str, str], columns: list[str]) -> DataFrame:
    places = {f.name.lower(): f"{ASIDE}.{f.name}" for f in df.schema[ASIDE].dataType.fields}
    places |= {c.lower(): c for c in df.columns if c != ASIDE}
    known = set(places) | {c for r in rules for c in r.writes}
    groups = levels(rules, set(places))
    last = {c: i for i, group in enumerate(groups) for r in group for c in r.reads(known) | r.writes}
    packs, own, made = [ASIDE], [c.lower() for c in df.columns if c != ASIDE], []
    for i, group in enumerate(groups):
        own = [c for c in own if not c.startswith("_") or last[c] >= i]
        settled = [c for c in own if last.get(c, -1) < i]
        settled = settled if len(settled) >= SETTLED else []
        new = _written([Rule(tuple((_led(when, places), {c: _led(v, places) for c, v in sets.items()}) for when, sets in r.cases)) for r in group], types, places)
        kept, pack = [c for c in own if c not in settled and c not in new], f"{ASIDE}_{i}"
        df = df.select(*packs, *([F.struct(*settled).alias(pack)] if settled else []), *kept, *[v.alias(c) for c, v in new.items()])
        made += [c for c in new if c not in made and c not in columns and not c.startswith("_")]
        packs += [pack] if settled else []
        own = [*kept, *new]
        places |= {c: f"{pack}.{c}" for c in settled} | {c: c for c in new}
    return df.select(*[F.col(places[c.lower()]).alias(c) for c in [*columns, *made]])


def sequentially(df: DataFrame, rules: list[Rule], blank: list[str] | None = None, types: dict[str, str] | None = None) -> DataFrame:
    """The same rules, one projection each: what ``compile_rules`` must equal (for tests)."""
    df = _blanked(df, blank)
    for r in rules:
        df = compile_rules_keeping(df, [r], types or {})
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def compile_rules_keeping(df: DataFrame, rules: list[Rule], types: dict[str, str]) -> DataFrame:
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: _folded(rules, c, (F.col(c) if c in have else F.lit(None)).cast(types[c]) if c in types else (F.col(c) if c in have else F.lit(None)))
                           for r in rules for c in sorted(r.writes)})
