"""Licence scan: an Aho-Corasick automaton finds notices and tags, licence expressions are evaluated.

The words of a text are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z.  The texts of a
slice become one string with a blank before every word and a line end after every text; one pass of the
automaton over it finds every place of every phrase, whole words only, never across texts.
Everything around the automaton is done for a slice at once in arrays.

Phrases are of three kinds.  A *notice* names a licence ("mit license").  An *exception* ("classpath
exception") loosens one.  A *tag* ("spdx license identifier") introduces a licence expression, which is
read from the raw text that follows it, up to the end of its line or the first token that doesn't fit.
Notices with nothing but filler words and a single "and", "or" or "with" between them form an
expression as well ("the MIT License or the Apache License"); of overlapping notices the leftmost longest
stands there.

A shunting-yard parser turns the tokens into postfix order (with before and before or); the evaluation goes
over restrictiveness: both sides of ``and`` must be kept (the stricter counts), of ``or`` one may choose (the
milder), a known exception after ``with`` leaves weak copyleft at most.  The score of a text is its
strictest expression's, 0 without any.

Defined results: null and empty texts have no words and no labels (empty strings, score 0); very long texts
are handled whole, in time proportional to their length; overlapping base places all count; repeated rows
are judged each; an unknown licence id has the label ``unknown`` and weak copyleft's score; an unbalanced or
unfinished expression counts as far as it makes sense; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulcrum.llm.wordhash import release, slices

# The base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

FREE, PERMISSIVE, WEAK, STRONG, RESTRICTED = 0.1, 0.25, 0.5, 0.75, 1.0
UNKNOWN = "unknown"

#: Restrictiveness of a licence family.
FAMILIES = {
    "cc0": FREE, "public-domain": FREE, "unlicense": FREE, "wtfpl": FREE,
    "mit": PERMISSIVE, "apache": PERMISSIVE, "bsd": PERMISSIVE, "isc": PERMISSIVE, "zlib": PERMISSIVE, "boost": PERMISSIVE,
    "python": PERMISSIVE, "cc-by": PERMISSIVE, "artistic": PERMISSIVE,
    "lgpl": WEAK, "mpl": WEAK, "epl": WEAK, "cddl": WEAK, "ofl": WEAK, "odbl": WEAK, UNKNOWN: WEAK,
    "gpl": STRONG, "agpl": STRONG, "eupl": STRONG, "cc-by-sa": STRONG,
    "cc-by-nd": RESTRICTED, "cc-by-nc": RESTRICTED, "proprietary": RESTRICTED,
}

#: Notice phrases beyond the base ones.
NOTICES = {
    "permission is hereby granted free of charge": "mit", "expat license": "mit", "mit licence": "mit",
    "apache licence": "apache", "apache software license": "apache", "apache 2 0": "apache",
    "gnu general public license": "gpl", "general public licence": "gpl", "gnu gpl": "gpl", "gplv2": "gpl", "gplv3": "gpl",
    "lesser general public license": "lgpl", "library general public license": "lgpl", "gnu lgpl": "lgpl",
    "gnu lesser general public license": "lgpl",
    "affero general public license": "agpl", "gnu affero general public license": "agpl", "gnu agpl": "agpl",
    "bsd license": "bsd", "bsd licence": "bsd", "2 clause bsd": "bsd", "3 clause bsd": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc", "zlib license": "zlib", "boost software license": "boost", "python software foundation license": "python",
    "mozilla public license": "mpl", "eclipse public license": "epl", "european union public licence": "eupl",
    "common development and distribution license": "cddl", "sil open font license": "ofl", "open database license": "odbl",
    "artistic license": "artistic", "cc0 1 0": "cc0", "creative commons zero": "cc0", "the unlicense": "unlicense",
    "released into the public domain": "public-domain", "dedicated to the public domain": "public-domain",
    "cc by": "cc-by", "cc by 4 0": "cc-by", "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa", "creative commons attribution sharealike": "cc-by-sa",
    "cc by nd": "cc-by-nd", "cc by nc nd": "cc-by-nc", "creative commons attribution noderivatives": "cc-by-nd",
    "cc by nc": "cc-by-nc", "cc by nc sa": "cc-by-nc", "creative commons attribution noncommercial": "cc-by-nc",
    "all rights reserved": "proprietary", "proprietary and confidential": "proprietary",
}
EXCEPTIONS = {
    "classpath exception": "classpath", "linking exception": "linking", "runtime library exception": "runtime",
    "llvm exceptions": "llvm", "font exception": "font",
}
TAGS = ("spdx license identifier", "spdx licence identifier", "license expression", "licence expression")
OPERATORS = {"with": 3, "and": 2, "or": 1}
FILLERS = frozenset("the a an this under terms of either any both gnu license licence licenses version v2 v3 2 3 4 0 1 later at your option".split())

#: Beginnings of licence ids, in the order they are tried.
IDS = [
    ("cc-by-nc", "cc-by-nc"), ("cc-by-nd", "cc-by-nd"), ("cc-by-sa", "cc-by-sa"), ("cc-by", "cc-by"), ("cc0", "cc0"),
    ("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"), ("apache", "apache"), ("mit", "mit"), ("x11", "mit"), ("0bsd", "bsd"),
    ("bsd", "bsd"), ("isc", "isc"), ("zlib", "zlib"), ("bsl", "boost"), ("psf", "python"), ("python", "python"), ("mpl", "mpl"),
    ("epl", "epl"), ("eupl", "eupl"), ("cddl", "cddl"), ("ofl", "ofl"), ("odbl", "odbl"), ("artistic", "artistic"),
    ("unlicense", "unlicense"), ("wtfpl", "wtfpl"),
]
_EXCEPTION_ID = re.compile(r"(classpath|llvm|gcc|font|autoconf|bison|openssl|linking|qt|u-boot|bootloader)\b.*exception", re.IGNORECASE)
_TOKEN = re.compile(rb"[ \t:=\"'`]*([()]|[A-Za-z0-9][A-Za-z0-9.+_-]*)")

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

NOTICE, EXCEPTION, TAG = 0, 1, 2


def family_of(licence_id: str) -> str:
    known = licence_id.lower().rstrip("+.")
    return next((f for head, f in IDS if known == head or re.match(re.escape(head) + r"[-.0-9]", known)), UNKNOWN)


# ---------------------------------------------------------------- expressions
@dataclass(frozen=True)
class Operand:
    text: str
    label: str = ""
    exception: bool = False

    @property
    def score(self) -> float:
        return FAMILIES.get(self.label, FAMILIES[UNKNOWN])


def postfix(tokens: Iterable[str | Operand]) -> list[str | Operand]:
    """Shunting yard over operands, operators and brackets.  It reads as far as the tokens make
    an expression; what is missing at the end (an operand, a closing bracket) is cut or closed."""
    out: list[str | Operand] = []
    waiting: list[str] = []
    operand_next, complete = True, 0

    def pop() -> None:
        out.append(waiting.pop())

    for token in tokens:
        if isinstance(token, Operand):
            after_with = bool(waiting) and waiting[-1] == "with" and operand_next
            if not operand_next or token.exception and not after_with:
                break
            # whatever follows "with" is an exception, known or not
            out.append(token if token.exception or not after_with else Operand(token.text, UNKNOWN, exception=True))
            operand_next = False
        elif token == "(":
            if not operand_next or waiting and waiting[-1] == "with":
                break
            waiting.append(token)
        elif token == ")":
            if operand_next or "(" not in waiting:
                break
            while waiting[-1] != "(":
                pop()
            waiting.pop()
        else:
            if operand_next or token == "with" and not isinstance(out[-1], Operand):
                break
            while waiting and waiting[-1] != "(" and OPERATORS[waiting[-1]] >= OPERATORS[token]:
                pop()
            waiting.append(token)
            operand_next = True
    if operand_next:  # an operator or bracket without what should follow
        while waiting and waiting[-1] == "(":
            waiting.pop()
        if waiting and out:
            waiting.pop()
    while waiting:
        if waiting[-1] == "(":
            waiting.pop()
        else:
            pop()
    return out


def evaluate(rpn: list[str | Operand]) -> tuple[float, str] | None:
    """(restrictiveness, the expression fully bracketed) of a postfix expression."""
    stack: list[tuple[float, deque[str], bool]] = []
    for token in rpn:
        if isinstance(token, Operand):
            stack.append((token.score, deque([token.text]), token.label != UNKNOWN))
            continue
        (right, right_text, known), (left, left_text, _) = stack.pop(), stack.pop()
        if token == "with":
            score = min(left, WEAK) if known else left
        else:
            score = max(left, right) if token == "and" else min(left, right)
        stack.append((score, _joined(left_text, token, right_text), True))
    return (stack[0][0], "".join(stack[0][1])) if stack else None


def _joined(left: deque[str], operator: str, right: deque[str]) -> deque[str]:
    """The longer side takes the shorter one in, so that a long chain costs little."""
    if len(left) < len(right):
        right.appendleft(f" {operator} ")
        right.extendleft(reversed(left))
        out = right
    else:
        left.append(f" {operator} ")
        left.extend(right)
        out = left
    out.appendleft("(")
    out.append(")")
    return out


def tag_tokens(data: bytes, at: int, end: int) -> Iterator[str | Operand]:
    """Tokens of the expression that begins at ``at``."""
    while match := _TOKEN.match(data, at, end):
        token = match[1].decode("ascii").rstrip(".-_")
        at = match.end()
        if token in ("(", ")") or token.lower() in OPERATORS:
            yield token.lower()
        elif _EXCEPTION_ID.match(token):
            yield Operand(token.lower(), token.lower(), exception=True)
        elif token:
            yield Operand(token.lower(), family_of(token))


# ---------------------------------------------------------------- scanning
def automaton() -> ahocorasick.Automaton:
    """Over a slice's string; every phrase has a blank on both sides."""
    found: dict[str, list] = {}
    for phrase, label in {**NOTICES, **BASE_PHRASES}.items():
        found[phrase] = [NOTICE, label]
    for phrase, label in EXCEPTIONS.items():
        found[phrase] = [EXCEPTION, label]
    for phrase in TAGS:
        found[phrase] = [TAG, ""]
    auto = ahocorasick.Automaton()
    for phrase, (kind, label) in found.items():
        auto.add_word(f" {phrase} ", (kind, label, phrase))
    auto.make_automaton()
    return auto


@dataclass
class Findings:
    """Of one text: places (kind, label, phrase, first word) and evaluated expressions."""

    places: list[tuple[int, str, str, int]] = field(default_factory=list)
    expressions: list[tuple[float, str]] = field(default_factory=list)
    labels: set[str] = field(default_factory=set)


def scan_slice(texts: pa.Array, auto: ahocorasick.Automaton) -> tuple[np.ndarray, dict[int, Findings]]:
    """(number of words of each text, findings by text number)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(len(texts), np.int64), {}
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    bounds = offsets - offsets[0]
    inside = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    start = np.flatnonzero(begins)
    text_of = np.searchsorted(bounds, start, "right") - 1
    n_words = np.bincount(text_of, minlength=len(texts))
    # blank + word, and blank + line end after each text
    held = np.flatnonzero(inside)
    text_held = np.searchsorted(bounds, held, "right") - 1
    at = np.arange(len(held)) + np.cumsum(begins[held]) + 2 * text_held
    line = np.full(len(held) + len(start) + 2 * len(texts), 0x20, np.uint8)
    line[at] = _LOWER[data[held]]
    line[np.cumsum(np.bincount(text_held, minlength=len(texts)) + n_words) + 2 * np.arange(len(texts)) + 1] = 0x0A
    word_at = at[np.searchsorted(held, start)]
    first_word = np.cumsum(n_words) - n_words
    found: dict[int, Findings] = {}
    raw = None
    for last, (kind, label, phrase) in auto.iter(line.tobytes().decode("latin-1")):
        word = int(np.searchsorted(word_at, last - len(phrase)))
        text = int(text_of[word])
        here = found.setdefault(text, Findings())
        here.places.append((kind, label, phrase, word - int(first_word[text])))
        if kind == TAG:
            raw = data.tobytes() if raw is None else raw
            begin = word + phrase.count(" ")
            at_byte, end = int(start[begin]), int(bounds[text + 1])
            while at_byte < end and _WORD[raw[at_byte]]:
                at_byte += 1
            tokens = postfix(tag_tokens(raw, at_byte, end))
            _note(here, tokens)
    for text, here in found.items():
        here.labels.update(label for kind, label, _, _ in here.places if kind == NOTICE)
        if any(kind == NOTICE for kind, *_ in here.places):
            begin = int(first_word[text])
            # a word's bytes: lower-cased, from where it begins to the blank
            for tokens in notice_chains(here.places, lambda i, j: [  # noqa: B023
                    _word(line, int(word_at[begin + w])) for w in range(i, j)]):  # noqa: B023
                _note(here, postfix(tokens))
    return n_words, found


def _word(line: np.ndarray, at: int) -> str:
    piece = line[at:at + 16].tobytes()
    return piece.split(b" ")[0].decode("latin-1")


def _note(here: Findings, rpn: list[str | Operand]) -> None:
    value = evaluate(rpn)
    if value:
        here.expressions.append(value)
        here.labels.update(t.label for t in rpn if isinstance(t, Operand) and not t.exception)


def notice_chains(places: list[tuple[int, str, str, int]], words_between) -> Iterator[list[str | Operand]]:
    """Token lists of the notices (leftmost, then longest) joined by one operator among at most six words."""
    free, chain, end = 0, [], 0
    size = lambda p: p[2].count(" ") + 1
    for place in sorted((p for p in places if p[0] != TAG), key=lambda p: (p[3], -size(p))):
        kind, label, phrase, first = place
        if first < free:
            continue
        free = first + size(place)
        token = Operand(label, label, exception=kind == EXCEPTION)
        operator = None
        if chain and first - end <= 6:
            between = words_between(end, first)
            operators = [w for w in between if w in OPERATORS]
            if len(operators) == 1 and all(w in OPERATORS or w in FILLERS for w in between):
                operator = operators[0]
        if operator and (operator == "with") == (kind == EXCEPTION):
            chain += [operator, token]
        else:
            if chain:
                yield chain
            chain = [] if kind == EXCEPTION else [token]
        end = free
    if chain:
        yield chain


_SCHEMA = ("n_words long, places array<struct<kind:int,label:string,phrase:string,word:long>>, "
           "expressions array<struct<score:double,expression:string>>, labels array<string>")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, places, expressions and sorted labels of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton()
        place = pa.struct([("kind", pa.int32()), ("label", pa.string()), ("phrase", pa.string()), ("word", pa.int64())])
        value = pa.struct([("score", pa.float64()), ("expression", pa.string())])
        none = Findings()
        for batch in batches:
            for part in slices(batch, 1):
                n_words, found = scan_slice(part.column(1), auto)
                each = [found.get(i, none) for i in range(part.num_rows)]
                yield pa.record_batch([
                    part.column(0), pa.array(n_words, pa.int64()),
                    pa.array([[dict(zip(("kind", "label", "phrase", "word"), p)) for p in f.places] for f in each], pa.list_(place)),
                    pa.array([[dict(zip(("score", "expression"), e)) for e in f.expressions] for f in each], pa.list_(value)),
                    pa.array([sorted(f.labels) for f in each], pa.list_(pa.string()))],
                    ["doc_id", "n_words", "places", "expressions", "labels"])
        release()

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {_SCHEMA}")


def report(found: DataFrame) -> DataFrame:
    """``scan``'s result in plain columns: base places and labels, all labels, score, expressions."""
    base = F.filter("places", lambda p: p["phrase"].isin(*BASE_PHRASES))
    starts = F.transform(base, lambda p: p["word"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda p: p["label"]))), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("expressions", lambda e: e["score"])), F.lit(0.0)).alias("score"),
        F.array_join(F.transform("expressions", lambda e: e["expression"]), "; ").alias("expressions"))
