"""Subjects and subject filters as Column expressions.

A subject is a dot-separated list of non-empty tokens. A filter is a subject in
which ``*`` stands for exactly one token and a final ``>`` for one or more.

The *shape* of a filter keeps its structure and drops its words: ``a.*.b`` has
shape ``L*L`` and ``a.b.>`` has shape ``LL>``. For a given shape a subject can
match only one filter string, its *candidate*, which turns wildcard matching
against a table of filters into an equality join.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Columns that already hold one token of the subject: position -> (column, type).
# The physical column can be pruned or pushed into a scan where the assembled
# subject cannot.
TokenColumns = Mapping[int, tuple[str, str]]


def tokens_of(filter_: str) -> list[str]:
    """Split a filter into tokens, raising ValueError when it is not valid."""
    tokens = filter_.split(".") if filter_ else []
    if not tokens or any(not t or re.search(r"\s", t) for t in tokens):
        raise ValueError(f"invalid subject filter {filter_!r}: empty token or whitespace")
    if ">" in tokens[:-1]:
        raise ValueError(f"invalid subject filter {filter_!r}: '>' must be the last token")
    return tokens


def shape_of(filter_: str) -> str:
    return "".join(t if t in ("*", ">") else "L" for t in tokens_of(filter_))


def shape(filter_: Column) -> Column:
    """Column form of :func:`shape_of`, for filters held in a table."""
    letters = F.transform(F.split(filter_, r"\."),
                          lambda t: F.when(t.isin("*", ">"), t).otherwise(F.lit("L")))
    return F.concat_ws("", letters)


def is_valid_filter(filter_: Column) -> Column:
    return filter_.rlike(r"^[^.\s]+(\.[^.\s]+)*$") & ~filter_.rlike(r"(^|\.)>\.")


def is_valid_subject(subject: Column) -> Column:
    """A publishable subject: non-empty tokens and no wildcard token."""
    return F.coalesce(subject.rlike(r"^[^.\s]+(\.[^.\s]+)*$") & ~subject.rlike(r"(^|\.)[*>](\.|$)"),
                      F.lit(False))


def _literal_prefix(tokens: list[str]) -> str:
    head = []
    for token in tokens:
        if token in ("*", ">"):
            break
        head.append(token + ".")
    return "".join(head)


def _pattern(words: list[str]) -> str:
    parts = {"*": "[^.]+", ">": r"[^.]+(?:\.[^.]+)*"}
    return r"\.".join(parts.get(w, re.escape(w)) for w in words)


def no_empty_token(subject: Column) -> Column:
    """No filter matches a subject with an empty token, whatever wildcard would stand for it."""
    return ~subject.contains("..") & ~subject.startswith(".") & ~subject.endswith(".") & (subject != "")


def _column(subject: Column | str) -> Column:
    return F.col(subject) if isinstance(subject, str) else subject


def token_guard(words: Mapping[int, str], tokens: TokenColumns | None) -> Column | None:
    """Equalities on physical token columns implied by the words at given positions."""
    guards = [F.col(tokens[i][0]) == F.lit(word).try_cast(tokens[i][1])
              for i, word in words.items() if tokens and i in tokens]
    return reduce(lambda a, b: a & b, guards) if guards else None


def guard(filter_: str, subject: Column | str = "subject", tokens: TokenColumns | None = None) -> Column:
    """A cheap necessary condition for a match, built only from pushable predicates."""
    words = tokens_of(filter_)
    col = _column(subject)
    if "*" not in words and words[-1] != ">":
        condition = col == F.lit(filter_)
    elif prefix := _literal_prefix(words):
        condition = col.startswith(prefix)
    else:
        condition = col.isNotNull()
    literal = {i: w for i, w in enumerate(words) if w not in ("*", ">")}
    extra = token_guard(literal, tokens)
    return condition if extra is None else extra & condition


def matches(filter_: str, subject: Column | str = "subject", tokens: TokenColumns | None = None) -> Column:
    """True where ``subject`` matches ``filter_``.

    Literal filters become ``=``, ``a.b.>`` becomes a prefix test (both reach a
    Parquet scan); only an inner ``*`` needs a regular expression, behind a guard.
    """
    words = tokens_of(filter_)
    condition = guard(filter_, subject, tokens)
    if "*" not in words:
        return condition & no_empty_token(_column(subject)) if words[-1] == ">" else condition
    return condition & _column(subject).rlike(f"^{_pattern(words)}$")


def matches_any(filters: Iterable[str], subject: Column | str = "subject",
                tokens: TokenColumns | None = None) -> Column:
    """True where any filter matches; literal-only lists become ``IN``."""
    filters = list(filters)
    if all("*" not in tokens_of(f) and not f.endswith(">") for f in filters):
        condition = _column(subject).isin(filters)
        common = {i: w for i, w in enumerate(tokens_of(filters[0]))
                  if all(tokens_of(f)[i:i + 1] == [w] for f in filters)}
        extra = token_guard(common, tokens)
        return condition if extra is None else extra & condition
    guards = guard_any(filters, subject, tokens)
    if all("*" not in f for f in filters):
        return guards & no_empty_token(_column(subject))
    # One alternation for all: a disjunction that holds a regular expression does not push,
    # and one that repeats the guards would be folded into them.
    return guards & _column(subject).rlike("^(?:" + "|".join(_pattern(tokens_of(f)) for f in filters) + ")$")


def guard_any(filters: Iterable[str], subject: Column | str = "subject",
              tokens: TokenColumns | None = None) -> Column:
    """A pushable condition that every message matching one of the filters meets."""
    return reduce(lambda a, b: a | b, [guard(f, subject, tokens) for f in filters])


def collide(a: str, b: str) -> bool:
    """Whether some subject matches both filters."""
    x, y = tokens_of(a), tokens_of(b)
    for p, q in zip(x, y):
        if ">" in (p, q):
            return True
        if p != q and "*" not in (p, q):
            return False
    return len(x) == len(y)


def candidate(shape_: str, words: Column) -> Column:
    """The only filter of this shape that could match a subject split into ``words``."""
    n = len(shape_)
    parts = [F.get(words, F.lit(i)) if mark == "L" else F.lit(mark) for i, mark in enumerate(shape_)]
    fits = F.size(words) >= n if shape_.endswith(">") else F.size(words) == n
    return F.when(fits, F.concat_ws(".", *parts))


def consumer_name(prefix: Column | str, filter_: Column) -> Column:
    """Stable consumer name of a filter: the prefix and five letters drawn from the filter."""
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(head, F.lit("-"), F.substring(F.md5(filter_), 1, 5))


def split_id(stream: Column, consumer: Column) -> Column:
    return F.concat(stream, F.lit(" > "), consumer)


def subject_eq(value: str, subject: str = "subject", tokens: TokenColumns | None = None) -> Column:
    condition = F.col(subject) == F.lit(value)
    extra = token_guard(dict(enumerate(value.split("."))), tokens)
    return condition if extra is None else extra & condition


def subject_in(values: Iterable[str], subject: str = "subject", tokens: TokenColumns | None = None) -> Column:
    """``subject IN (…)``; each token column gets the IN list of its own position."""
    values = list(values)
    condition = F.col(subject).isin(values)
    for i, (column, type_) in (tokens or {}).items():
        if any(v.count(".") < i for v in values):
            continue
        at = sorted({v.split(".")[i] for v in values})
        condition = F.col(column).isin([F.lit(w).try_cast(type_) for w in at]) & condition
    return condition


def subject_like(pattern: str, subject: str = "subject", tokens: TokenColumns | None = None) -> Column:
    """Exact SQL LIKE, plus equalities for the tokens its literal prefix completes."""
    condition = F.col(subject).like(pattern)
    prefix = re.split(r"[%_\\]", pattern, maxsplit=1)[0]
    complete = prefix.split(".")[:-1]
    extra = token_guard(dict(enumerate(complete)), tokens)
    return condition if extra is None else extra & condition
