"""First-match rule tables over text: each rule is a template with named slots, guards and an emission.

A template such as ``{start+} and a point {distance} metres {direction}`` is compiled to one expression
with numbered groups; the rules become one ordered decision list of Columns, so a whole grammar is a
projection that Catalyst can fuse and generate code for.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from curblake.functions.rx import first, has


@dataclass(frozen=True)
class Rule:
    kind: str
    template: str
    #: slot -> name of a transform of its text; a slot of this name in the result.
    emit: dict[str, tuple[str, str]] = field(default_factory=dict)
    #: (guard, slot); the slot "" is the whole text.
    guards: tuple[tuple[str, str], ...] = ()


class Grammar:
    def __init__(self, rules: list[Rule], pieces: dict[str, str], guards: dict[str, Callable[[Column], Column]], transforms: dict[str, Callable[[Column], Column]]) -> None:
        self.rules, self.guards, self.transforms = rules, guards, transforms
        self.compiled = [self._compile(r.template, pieces) for r in rules]

    @staticmethod
    def _compile(template: str, pieces: dict[str, str]) -> tuple[str, dict[str, int]]:
        groups: dict[str, int] = {}

        def slot(m: re.Match) -> str:
            name, how = re.fullmatch(r"(\w+?)((?:[+*(<!]\)?)*)", m[1]).groups()
            kind = re.sub(r"\d+$", "", name)
            if how:
                body = pieces[how]
            else:
                body = pieces.get(kind) or pieces["+"]
            groups[name] = len(groups) + 1
            return f"({body})"

        pattern = re.sub(r"\{([^{}]+)\}", slot, re.sub(r"<(\w+)>", lambda m: pieces[m[1]], template).replace(" ", r"\s+"))
        return f"^{pattern}$", groups

    def slot(self, text: Column, i: int, name: str) -> Column:
        pattern, groups = self.compiled[i]
        return F.trim(F.regexp_extract(text, "(?iuUd)" + pattern, groups[name]))

    def number(self, text: Column) -> Column:
        """The number of the first rule that fits, from 1; null if none does."""
        cases = []
        for i, rule in enumerate(self.rules):
            fits = has(text, self.compiled[i][0])
            for guard, name in rule.guards:
                fits = fits & F.coalesce(self.guards[guard](self.slot(text, i, name) if name else text), F.lit(False))
            cases.append((fits, F.lit(i + 1)))
        return first(*cases, default=F.lit(None).cast("int"))

    def kinds(self, number: Column) -> Column:
        return F.when(number.isNotNull(), F.get(F.array(*[F.lit(r.kind) for r in self.rules]), number - 1))

    def values(self, text: Column, number: Column, fields: tuple[str, ...]) -> dict[str, Column]:
        """A Column for each field; null where the rule doesn't give it."""
        out = {}
        for name in fields:
            value = F.lit(None).cast("string")
            for i, rule in enumerate(self.rules):
                how = rule.emit.get(name, (name, "raw") if name in self.compiled[i][1] else None)
                if how:
                    value = F.when(number == i + 1, self.transforms[how[1]](self.slot(text, i, how[0]))).otherwise(value)
            out[name] = F.nullif(value, F.lit(""))
        return out
