"""License scans: an Aho-Corasick pass over identifier tags and notice phrases, and a
shunting-yard parser for licence expressions.

The text is lower-cased (A-Z) and mapped to its words, one space apart, in three C-level
passes over its UTF-8 bytes; the automaton then finds every phrase as a run of whole
words.  Where an identifier tag is found, the raw text behind it is parsed as an
expression of identifiers joined by ``and``, ``or`` and ``with``.
"""

from __future__ import annotations

from collections import Counter
import re

import ahocorasick
from pyspark.sql import DataFrame

from panelcast.llm.common import map_batches

# Phrases and their labels as the base result defines them.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Further notice phrases, as words, and the label each one adds.
NOTICE_PHRASES = {
    "apache license": "apache", "apache 2 0": "apache", "mit license": "mit", "bsd license": "bsd",
    "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "mozilla public license": "mpl", "isc license": "isc",
    "lesser general public license": "lgpl", "affero general public license": "agpl",
    "eclipse public license": "epl", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa", "cc by nc nd": "cc-by-nc-nd", "cc0": "cc0", "public domain": "public-domain",
    "creative commons attribution": "cc-by", "unlicense": "unlicense", "boost software license": "bsl",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
#: Identifier tags, as words; what follows one is parsed as an expression.
TAGS = ("spdx license identifier", "license expression")
TAG_SOURCE = re.compile(rb"(?i)(?:spdx-license-identifier|license-expression)[ \t]*:[ \t]*([^\r\n]*)")

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Bytes of words stay (ASCII digits and letters, all bytes of other characters), the rest become spaces.
_WORDS = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
_TABLE = _LOWER.translate(_WORDS)

_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*|\S")
_RANK = {"or": 1, "and": 2, "with": 3}


class ExpressionError(ValueError):
    """Not a licence expression."""


def to_postfix(expression: str) -> list[str]:
    """The expression in postfix order (shunting yard); ``with`` binds closest, then ``and``, then ``or``."""
    out: list[str] = []
    held: list[str] = []
    operand = False
    for tok in _TOKEN.findall(expression):
        low = tok.lower()
        if low in _RANK:
            if not operand:
                raise ExpressionError(f"{tok} without a left side")
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[low]:
                out.append(held.pop())
            held.append(low)
            operand = False
        elif tok == "(":
            if operand:
                raise ExpressionError("operator missing before (")
            held.append(tok)
        elif tok == ")":
            if not operand:
                raise ExpressionError(") without an operand")
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ExpressionError("unbalanced )")
            held.pop()
        elif tok[0].isalnum():
            if operand:
                break  # prose after the expression
            out.append(low.rstrip(".:"))
            operand = True
        else:
            break  # comment ends and other punctuation close the expression
    if not operand:
        raise ExpressionError("no right side")
    while held:
        if (op := held.pop()) == "(":
            raise ExpressionError("unbalanced (")
        out.append(op)
    return out


class TooManyAlternatives(Exception):
    """A well-formed expression that is not expanded."""


def licences(postfix: list[str]) -> frozenset[str]:
    """All licences of a postfix expression, without expanding it."""
    stack: list[frozenset[str]] = []
    for tok in postfix:
        if tok not in _RANK:
            stack.append(frozenset([tok]))
            continue
        right, left = stack.pop(), stack.pop()
        if tok == "with":
            if len(left) != 1 or len(right) != 1:
                raise ExpressionError("with joins one licence and one exception")
            stack.append(frozenset([f"{next(iter(left))}-with-{next(iter(right))}"]))
        else:
            stack.append(left | right)
    return stack[0]


def _narrowest(sets: list[frozenset[str]]) -> list[frozenset[str]]:
    """The sets, in order, without equal ones and those that contain another.  A set can only contain those that are
    listed under one of its members, and each is listed under its rarest."""
    sets = list(dict.fromkeys(sets))
    often = Counter(x for s in sets for x in s)
    under: dict[str, list[frozenset[str]]] = {}
    for s in sets:
        under.setdefault(min(s, key=lambda x: (often[x], x)), []).append(s)
    return [s for s in sets if not any(o < s for x in s for o in under.get(x, ()))]


def alternatives(expression: str) -> list[frozenset[str]]:
    """The expression as its alternatives: each a set of licences that hold together;
    ``x with e`` is the one licence ``x-with-e``.  Equal and wider alternatives are dropped.
    Raises TooManyAlternatives where an ``and`` makes over 256."""
    stack: list[list[frozenset[str]]] = []
    for tok in to_postfix(expression):
        if tok not in _RANK:
            stack.append([frozenset([tok])])
            continue
        right, left = stack.pop(), stack.pop()
        if tok == "or":
            if len(left) < len(right):
                both = left + right
            else:  # the common chain: the longer side grows in place
                left.extend(right)
                both = left
        else:
            left, right = _narrowest(left), _narrowest(right)
            if tok == "and":
                if len(left) * len(right) > 256:
                    raise TooManyAlternatives
                both = _narrowest([a | b for a in left for b in right])
            else:
                if len(left) != 1 or len(left[0]) != 1 or len(right) != 1 or len(right[0]) != 1:
                    raise ExpressionError("with joins one licence and one exception")
                both = [frozenset([f"{next(iter(left[0]))}-with-{next(iter(right[0]))}"])]
        stack.append(both)
    return _narrowest(stack[0])


class Scanner:
    """The automaton and the scan of one text."""

    def __init__(self, base=None, notices=None, tags=TAGS):
        self.base = dict(BASE_PHRASES if base is None else base)
        self.notices = dict(NOTICE_PHRASES if notices is None else notices)
        auto = ahocorasick.Automaton()
        kinds: dict[str, list[tuple[str, str]]] = {}
        for kind, phrases in (("base", self.base), ("notice", self.notices), ("tag", {t: "" for t in tags})):
            for p, label in phrases.items():
                kinds.setdefault(p, []).append((kind, label))
        for p, what in kinds.items():
            # bytes as Latin-1 characters: one character a byte, so places stay byte places
            key = f" {p} ".encode().decode("latin-1")
            auto.add_word(key, (len(key), what))
        auto.make_automaton()
        self.auto = auto

    def __call__(self, text: str) -> dict:
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.translate(_TABLE).split()
        flat = b" " + b" ".join(words) + b" "
        base: list[int] = []
        base_labels: set[str] = set()
        labels: set[str] = set()
        tagged = False
        at = word = 0
        for end, (size, what) in sorted(self.auto.iter(flat.decode("latin-1")), key=lambda m: m[0] - m[1][0]):
            start = end - size + 1  # the space before the phrase
            word += flat.count(b" ", at, start)
            at = start
            for kind, label in what:
                if kind == "base":
                    base.append(word)
                    base_labels.add(label)
                elif kind == "notice":
                    labels.add(label)
                else:
                    tagged = True
        expressions = self.expressions(raw) if tagged else []
        for _, sets in expressions:
            labels.update(x for s in sets for x in s)
        labels |= base_labels
        return {"n_words": len(words), "n_base": len(base), "first_word": min(base, default=None),
                "last_word": max(base, default=None), "base_labels": ",".join(sorted(base_labels)),
                "labels": ",".join(sorted(labels)), "score": self.score(len(base), labels, expressions),
                "expressions": [e for e, _ in expressions]}

    @staticmethod
    def expressions(raw: bytes) -> list[tuple[str, list[frozenset[str]]]]:
        out = []
        for m in TAG_SOURCE.finditer(raw):
            text = m[1].decode("utf-8", "replace")
            try:
                try:
                    sets = alternatives(text)
                except TooManyAlternatives:  # kept in postfix form, with all its licences
                    postfix = to_postfix(text)
                    out.append((" ".join(postfix), [licences(postfix)]))
                    continue
            except ExpressionError:
                continue  # a tag without a well-formed expression adds no label
            out.append((" or ".join(" and ".join(sorted(s)) for s in sets), sets))
        return out

    @staticmethod
    def score(places: int, labels: set, expressions: list) -> float:
        """1 for a well-formed identifier tag, else 1 - 2^-n over the n places and further labels."""
        if expressions:
            return 1.0
        return 1.0 - 0.5 ** min(60, places + len(labels)) if labels else 0.0


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scanner: Scanner | None = None) -> DataFrame:
    """Scan every whole text; one output row for each input row, no shuffle.

    Returns ``id_col, n_words, n_base`` (places of base phrases, overlapping ones
    included), ``first_word, last_word`` (their smallest and largest start, null without
    one), ``base_labels, labels`` (distinct, sorted, comma-joined; empty without one),
    ``score`` in [0, 1] and ``expressions`` (normalised).  A null text is empty: 0 words,
    empty labels, score 0.  Null ids and repeated rows pass through; further columns are
    not read; an empty table gives an empty result.
    """
    scan = scanner or Scanner()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions"]

    def run(batch):
        found = [scan(t or "") for t in batch.column(1).to_pylist()]
        yield {id_col: batch.column(0)} | {n: [f[n] for f in found] for n in names}

    kind = df.schema[id_col].dataType.simpleString()
    return map_batches(
        df.select(id_col, text_col), run,
        f"`{id_col}` {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
        "labels string, score double, expressions array<string>",
    )
