"""Licences named in texts: notice phrases, identifier tags and the expressions behind them.

One Aho-Corasick automaton runs over the words of a text and finds notice phrases and identifier tags.
The expression behind a tag is turned round by a shunting-yard parser and evaluated: an identifier
stands for itself, ``with`` joins an exception to it, ``and`` asks for both sides, ``or`` offers either.
A line may hold several tags. An expression ends at the first part that cannot go on, such as the end of a
comment or the next word of a sentence; of one that breaks off, the longest well-formed start counts.

Results per text: base labels (of three fixed phrases), all labels, and a score from 0 to 1 for how
sure the finding is: 1 for a well-formed tag expression of known identifiers, 0.9 for a notice phrase,
0.6 for a well-formed expression with an unknown identifier, 0.4 for one that is not well formed, 0 for
nothing found; the best finding counts. ``openness`` is what the expressions evaluate to: the grade of
an identifier, the least of both sides of ``and``, the greatest of both sides of ``or``; several
findings hold together like ``and``; null without any.

Defined cases: a null text is an empty one; ids of any type are handed on, null or repeated ones too;
further columns are not looked at; an empty table gives no rows; texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm import common

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Notice phrases beyond the base, by word, and their labels.
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache license": "apache-2",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 3 clause": "bsd-3-clause",
    "bsd 2 clause": "bsd-2-clause",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}

#: The tag that announces an expression, by word and as written.
TAG = "spdx license identifier"
_TAG = re.compile(r"spdx[^a-z0-9]+license[^a-z0-9]+identifier[\x20\t]*:?[\x20\t\"'`]*", re.I | re.A)
_LINE_END = re.compile(r"[\r\n]")

#: How freely a work may be used, from 0 (not at all) to 1, by the start of an identifier.
GRADES = {
    "all-rights-reserved": 0.0,
    "cc-by-nc": 0.2,
    "agpl": 0.3,
    "gpl": 0.4,
    "cc-by-sa": 0.5,
    "lgpl": 0.6,
    "mpl": 0.7,
    "epl": 0.7,
    "cc-by": 0.9,
    "apache": 0.9,
    "bsl": 0.9,
    "bsd": 0.9,
    "isc": 0.9,
    "mit": 0.9,
    "zlib": 0.9,
    "unlicense": 1.0,
    "cc0": 1.0,
    "0bsd": 1.0,
    "public-domain": 1.0,
}
UNKNOWN = 0.1

_NO_WORD = bytes(
    byte if byte >= 0x80 or chr(byte) in "0123456789abcdefghijklmnopqrstuvwxyz" else 0x20
    for byte in range(256)
)
_PART = re.compile(r"[A-Za-z0-9.+_-]+|[()]|\S")
_IDENTIFIER = re.compile(r"[a-z0-9][a-z0-9.+_-]*\Z")
_BINDING = {"or": 1, "and": 2, "with": 3}


def words(text: str) -> list[bytes]:
    """The words of a text, A to Z as a to z; every character beyond ASCII belongs to a word."""
    return text.encode(errors="replace").lower().translate(_NO_WORD).split()


class Value(NamedTuple):
    """What an expression comes to."""

    labels: tuple[str, ...]
    grade: float
    known: bool


def grade_of(label: str) -> float | None:
    starts = [start for start in GRADES if label == start or re.match(re.escape(start) + r"[-.\d+]", label)]
    return GRADES[max(starts, key=len)] if starts else None


def reverse_polish(parts: list[str]) -> list[str]:
    """Operands and operators in the order in which they are carried out; ValueError if ill formed."""
    out: list[str] = []
    held: list[str] = []
    operand_next = True
    for part in parts:
        if part in _BINDING or part == ")":
            if operand_next:
                raise ValueError(f"no licence before {part}")
            while held and held[-1] != "(" and (part == ")" or _BINDING[held[-1]] >= _BINDING[part]):
                out.append(held.pop())
            if part != ")":
                held.append(part)
                operand_next = True
            elif held:
                held.pop()
            else:
                raise ValueError("no bracket to close")
        else:
            if not operand_next:
                raise ValueError(f"no operator before {part}")
            if part == "(":
                held.append(part)
            elif _IDENTIFIER.match(part):
                out.append(part)
                operand_next = False
            else:
                raise ValueError(f"no licence: {part}")
    if operand_next or "(" in held:
        raise ValueError("the expression breaks off")
    return out + held[::-1]


def evaluate(expression: str) -> Value:
    """The labels an expression names and how free they leave one; ValueError if ill formed."""
    stack: list[Value] = []
    for part in reverse_polish([p.lower() for p in _PART.findall(expression)]):
        if part not in _BINDING:
            grade = grade_of(part)
            stack.append(Value((part,), UNKNOWN if grade is None else grade, grade is not None))
            continue
        right, left = stack.pop(), stack.pop()
        if part == "with":
            if len(left.labels) > 1 or len(right.labels) > 1:
                raise ValueError("an exception belongs to one licence")
            label = f"{left.labels[0]}-with-{right.labels[0]}"
            stack.append(Value((label,), left.grade, left.known))
        else:
            pick = min if part == "and" else max
            stack.append(
                Value(
                    left.labels + right.labels,
                    pick(left.grade, right.grade),
                    left.known and right.known,
                )
            )
    return stack.pop()


def expressions(text: str) -> Iterator[str]:
    """What stands behind each tag, up to the next one or the end of the line."""
    tags = [tag.span() for tag in _TAG.finditer(text)]
    for at, (_, start) in enumerate(tags):
        stop = tags[at + 1][0] if at + 1 < len(tags) else len(text)
        line_end = _LINE_END.search(text, start, stop)
        yield text[start : line_end.start() if line_end else stop]


def longest_start(expression: str) -> tuple[list[str], bool]:
    """The parts of the longest well-formed start, and whether the expression ends with it.

    Reading stops at the first part that cannot go on. Where that is a word, a sentence follows, and
    operands at the end that are bare words and name no known licence belong to it.
    """
    parts: list[str] = []
    depth, operand_next, best, known = 0, True, 0, 0
    all_known, prose = True, False
    for found in _PART.finditer(expression):
        part = found[0].lower()
        closed = part.rstrip(".")
        if part == "(" and operand_next and parts[-1:] != ["with"]:
            depth += 1
        elif part == ")" and not operand_next and depth:
            depth -= 1
        elif part in _BINDING and not operand_next:
            operand_next = True
        elif part not in _BINDING and operand_next and _IDENTIFIER.match(closed):
            operand_next = False
            exception = bool(parts) and parts[-1] == "with"
            all_known = all_known and (exception or not closed.isalpha() or grade_of(closed) is not None)
        else:
            prose = not operand_next and part.isalpha()
            break
        parts.append(closed or part)
        if not operand_next and not depth:
            best = len(parts)
            known = best if all_known else known
        if closed != part:  # a full stop
            break
    if prose and known:
        return parts[:known], True
    return parts[:best], bool(best) and best == len(parts)


def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    phrases = {**{p: ("notice", v) for p, v in NOTICES.items()}, TAG: ("tag", "")}
    phrases |= {p: ("base", v) for p, v in BASE.items()}
    for phrase, (kind, label) in phrases.items():
        automaton.add_word(f" {phrase} ", (len(phrase), kind, label))
    automaton.make_automaton()
    return automaton


class Scanner:
    def __init__(self) -> None:
        self.automaton = _automaton()

    def __call__(self, text: str) -> dict:
        found_words = words(text)
        line = f" {b' '.join(found_words).decode(errors='replace')} "
        starts, base, labels, scores, grades = [], set(), set(), [0.0], []
        tagged = False
        for end, (length, kind, label) in self.automaton.iter(line):
            if kind == "tag":
                tagged = True
                continue
            if kind == "base":
                starts.append(end - length)
                base.add(label)
            labels.add(label)
            scores.append(0.9)
            grades.append(grade_of(label))
        for expression in expressions(text) if tagged else ():
            parts, whole = longest_start(expression)
            try:
                value = evaluate(" ".join(parts))
            except ValueError:
                scores.append(0.4)
                continue
            labels.update(value.labels)
            grades.append(value.grade)
            scores.append((1.0 if value.known else 0.6) if whole else 0.4)
        places = [line.count(" ", 0, start) - 1 for start in (min(starts), max(starts))] if starts else [None] * 2
        known = [g for g in grades if g is not None]
        return {
            "n_words": len(found_words),
            "n_base": len(starts),
            "first_word": places[0],
            "last_word": places[1],
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels)),
            "score": max(scores),
            "openness": min(known) if known else None,
        }


COLUMNS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, openness double"
)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document what licences its text names; word places count from 0."""

    def start() -> Callable:
        scanner = Scanner()
        return lambda content: tuple(scanner(content).values())

    return common.map_rows(
        docs.select(F.col(doc_id), common.text_or_empty(text)), COLUMNS, start
    )
