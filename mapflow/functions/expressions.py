"""Small text helpers for the SQL expressions a mapping carries.

Logic stays Spark SQL text and goes to ``F.expr``; these helpers only resolve
the mapping conventions around it (the ``main.`` prefix, bare column names,
quoting) and work on whole identifiers outside string literals.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import COMPUTED_MARKERS, COMPUTED_WORD, MAIN_PREFIX

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_$]*$")
_QUOTED = re.compile(r"('(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`(?:[^`]|``)*`)")

# Words that look like bare identifiers but are SQL values.
_SQL_WORDS = {"NULL", "TRUE", "FALSE", "CURRENT_DATE", "CURRENT_TIMESTAMP", "CURRENT_USER"}


def quote(name: str) -> str:
    """Back-tick quote one column or alias name for use inside SQL text."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str, alias: str | None = None) -> Column:
    """Column reference that survives dots, spaces and parentheses in names."""
    return F.col(f"{quote(alias)}.{quote(name)}" if alias else quote(name))


def _map_outside_quotes(text: str, fn) -> str:
    parts = _QUOTED.split(text)
    return "".join(p if i % 2 else fn(p) for i, p in enumerate(parts))


def rewrite_main(text: str | None, main_alias: str = "source") -> str | None:
    """``main.x`` names the main relation; rewrite it to its alias."""
    if text is None:
        return None
    return _map_outside_quotes(text, lambda s: re.sub(rf"(?<![\w.$`]){MAIN_PREFIX}\.", f"{main_alias}.", s, flags=re.I))


def is_bare_identifier(logic: str | None) -> bool:
    return logic is not None and bool(_IDENT.match(logic.strip())) and logic.strip().upper() not in _SQL_WORDS


def qualify_join_lhs(condition: str, main_alias: str = "source") -> str:
    """A bare column on the left of ``=`` belongs to the main relation.

    Only identifiers are prefixed (never numbers), only outside literals, and
    ``<=``, ``>=``, ``!=``, ``==`` and ``<=>`` are left alone.
    """
    pat = re.compile(r"(?<![\w.$`])([A-Za-z_][A-Za-z0-9_$]*)(\s*)=(?![=>])")

    def fix(seg: str) -> str:
        def rep(m):
            word = m.group(1)
            if word.upper() in _SQL_WORDS or word.upper() in ("AND", "OR", "NOT", "ON"):
                return m.group(0)
            return f"{main_alias}.{word}{m.group(2)}="
        return pat.sub(rep, seg)

    return _map_outside_quotes(condition, fix)


def _split_top(text: str, at: str) -> list[str]:
    """Split where the pattern ``at`` matches outside parentheses and literals."""
    out, depth, start = [], 0, 0
    for m in re.finditer(rf"{_QUOTED.pattern}|[()]|(?P<at>{at})", text, re.I):
        if m.group() in "()":
            depth += 1 if m.group() == "(" else -1
        elif m.group("at") and depth == 0:
            out.append(text[start:m.start()].strip())
            start = m.end()
    out.append(text[start:].strip())
    return [c for c in out if c]


def split_list(text: str) -> list[str]:
    """The items of a comma-separated list of expressions."""
    return _split_top(text, ",")


def split_conjuncts(condition: str) -> list[str]:
    """The parts of a conjunction; a condition with a top-level OR is one part, as AND binds tighter."""
    if len(_split_top(condition, r"\bOR\b")) > 1:
        return [condition.strip()]
    return _split_top(condition, r"\bAND\b")


_EQ = re.compile(r"^\(?\s*([A-Za-z_`][\w`$ ]*)\.([\w`$]+)\s*(?:=|==|<=>)\s*([A-Za-z_`][\w`$ ]*)\.([\w`$]+)\s*\)?$")


def equi_pairs(condition: str, right_alias: str) -> tuple[list[tuple[str, str]], bool]:
    """Equality conjuncts between ``right_alias`` and other relations, as
    (other ``alias.column``, right column) pairs; and whether they are all
    the condition has (a pure equi join)."""
    ra = right_alias.strip("`").lower()
    pairs, pure = [], True
    for conj in split_conjuncts(condition):
        m = _EQ.match(conj)
        if not m:
            pure = False
            continue
        a1, c1, a2, c2 = (g.strip("`") for g in m.groups())
        if (a1.lower() == ra) == (a2.lower() == ra):
            pure = False
        elif a1.lower() == ra:
            pairs.append((f"{a2}.{c2}", c1))
        else:
            pairs.append((f"{a1}.{c1}", c2))
    return pairs, pure and bool(pairs)


def is_computed_logic(logic: str | None) -> bool:
    """True for logic beyond a plain column.  CASE counts as a whole word only, so a
    column whose name contains it stays plain."""
    if logic is None:
        return True
    return any(m in logic for m in COMPUTED_MARKERS) or re.search(rf"\b{COMPUTED_WORD}\b", logic, re.I) is not None
