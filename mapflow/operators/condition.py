"""What an ON condition is made of, so that a join without a plain equality can still be planned.

The text is only cut at top-level ``AND``, ``OR`` and comparison signs; which side an operand
belongs to is asked of Spark, by resolving it against each side.
"""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import _QUOTED, _split_top

_FLIPPED = {"<": ">", "<=": ">=", ">": "<", ">=": "<=", "=": "=", "<=>": "<=>"}
_SIGN = r"<=>|<=|>=|<>|!=|==|=|<|>"


def _inner(text: str) -> str:
    """``text`` without parentheses around the whole of it."""
    text = text.strip()
    while text.startswith("(") and text.endswith(")"):
        depth = 0
        for m in re.finditer(rf"{_QUOTED.pattern}|[()]", text):
            depth += {"(": 1, ")": -1}.get(m.group(), 0)
            if depth == 0 and m.end() < len(text):
                return text
        text = text[1:-1].strip()
    return text


def disjuncts(text: str) -> list[str]:
    return [_inner(x) for x in _split_top(_inner(text), r"\bOR\b")]


def conjuncts(text: str) -> list[str]:
    """Parts of a conjunction, nested ones too; a ``BETWEEN`` becomes two comparisons."""
    text = _inner(text)
    if len(_split_top(text, r"\bOR\b")) > 1 or re.search(r"\bCASE\b", _QUOTED.sub("", text), re.I):
        return [text]
    parts, out = _split_top(text, r"\bAND\b"), []
    while parts:
        p = parts.pop(0)
        between = _split_top(p, r"\bBETWEEN\b")
        if len(between) == 2 and parts and not re.search(r"\bNOT$", between[0], re.I):
            out += [f"{between[0]} >= {between[1]}", f"{between[0]} <= {parts.pop(0)}"]
        elif len(between) == 2 and parts:
            out.append(f"{p} AND {parts.pop(0)}")
        else:
            out += conjuncts(p) if _inner(p) != p else [p]
    return out


def _comparison(text: str) -> tuple[str, str, str] | None:
    signs = [m.group("s") for m in re.finditer(rf"{_QUOTED.pattern}|(?P<s>{_SIGN})", text) if m.group("s")]
    ends = _split_top(text, _SIGN)
    return (ends[0], signs[0].replace("==", "="), ends[1]) if len(signs) == 1 and len(ends) == 2 and signs[0] not in ("<>", "!=") else None


def resolves(df: DataFrame, text: str) -> bool:
    """Whether ``text`` is an expression over ``df``'s columns alone."""
    log = logging.getLogger("SQLQueryContextLogger")
    level = log.level
    log.setLevel(logging.CRITICAL + 1)  # not resolving is an answer, not an error
    try:
        df.select(F.expr(text))
        return True
    except (AnalysisException, ParseException):
        return False
    finally:
        log.setLevel(level)


@dataclass
class Condition:
    """An ON condition in parts; operands as SQL text, the left side's first."""

    equal: list[tuple[str, str, str]] = field(default_factory=list)   # (left, "=" or "<=>", right)
    ranges: list[tuple[str, str, str]] = field(default_factory=list)  # (left, "<" "<=" ">" ">=", right)
    left_only: list[str] = field(default_factory=list)
    right_only: list[str] = field(default_factory=list)
    either: list[tuple[str, list[str]]] = field(default_factory=list)  # (part, its alternatives) of a disjunction over both sides
    mixed: list[str] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)                    # all of them, as written

    @property
    def residual(self) -> bool:
        """Whether anything but equalities, ranges and conditions on one side is left."""
        return bool(self.either or self.mixed)


def analyse(left: DataFrame, right: DataFrame, text: str) -> Condition:
    """``text`` in parts; ``left`` and ``right`` under the aliases that it uses."""
    out = Condition()
    for part in conjuncts(text):
        out.parts.append(part)
        on_left, on_right = resolves(left, part), resolves(right, part)
        if on_left or on_right:
            (out.left_only if on_left else out.right_only).append(part)
            continue
        if len(alternatives := disjuncts(part)) > 1:
            out.either.append((part, alternatives))
            continue
        c = _comparison(_inner(part))
        if c and resolves(left, c[0]) and resolves(right, c[2]):
            a, sign, b = c
        elif c and resolves(right, c[0]) and resolves(left, c[2]):
            b, sign, a = c
            sign = _FLIPPED[sign]
        else:
            out.mixed.append(part)
            continue
        (out.equal if sign in ("=", "<=>") else out.ranges).append((a, sign, b))
    return out
