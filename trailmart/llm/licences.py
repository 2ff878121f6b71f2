"""Licence scan: Aho-Corasick for phrases and identifier tags, a shunting-yard parser for expressions.

Texts are lower-cased (A-Z) and cut into words; the words of many documents, one blank between them, run
through one automaton in C. A tag is followed in the original text by an expression up to the line's end.

Defined results: null and empty texts have no words, no labels and score 0; a phrase never reaches from one
document into the next; a tag without a well-formed expression gives the label ``malformed``; an identifier
outside ``PERMISSION`` is reported as it stands and has no permission value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import boundaries, byte_table, flat, ragged, slices
from .frames import fresh, ship

# Phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
NOTICE_PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "bsd license": "bsd",
    "isc license": "isc",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
TAG_PHRASES = ("spdx license identifier",)
#: How freely a text under this licence may be used, 1 freely, 0 not at all.
PERMISSION = {
    "0bsd": 1.0, "apache-2.0": 1.0, "bsd-2-clause": 1.0, "bsd-3-clause": 1.0, "bsl-1.0": 1.0, "cc0-1.0": 1.0,
    "isc": 1.0, "mit": 1.0, "unlicense": 1.0, "zlib": 1.0, "cc-by-4.0": 0.9, "cc-by-3.0": 0.9,
    "mpl-2.0": 0.6, "epl-2.0": 0.6, "lgpl-2.1-only": 0.5, "lgpl-2.1-or-later": 0.5, "lgpl-3.0-only": 0.5,
    "lgpl-3.0-or-later": 0.5, "cc-by-sa-4.0": 0.5, "gpl-2.0-only": 0.3, "gpl-2.0-or-later": 0.3, "gpl-2.0": 0.3,
    "gpl-3.0-only": 0.3, "gpl-3.0-or-later": 0.3, "gpl-3.0": 0.3, "agpl-3.0-only": 0.2, "agpl-3.0-or-later": 0.2,
    "cc-by-nc-4.0": 0.2, "cc-by-nd-4.0": 0.2,
}
#: An exception lifts what its licence forbids by this share.
EXCEPTION_LIFT = 0.5
#: Evidence in a phrase in passing, in a notice, in a tag that cannot be read, in one that can.
WEIGHTS = {"base": 0.5, "notice": 0.8, "malformed": 0.6, "tag": 1.0}

WORDS = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
TOKEN = re.compile(r"\s*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
BINDING = {"or": 1, "and": 2, "with": 3}


def to_postfix(expression: str) -> list[str] | None:
    """Shunting-yard: ids and operators in postfix order, None for a malformed expression."""
    out: list[str] = []
    pending: list[str] = []
    at, operand = 0, False  # operand: the last token ended one
    text = expression.strip()
    while at < len(text):
        m = TOKEN.match(text, at)
        if m is None:
            return None
        at = m.end()
        while at < len(text) and text[at].isspace():
            at += 1
        token = (m.group(1) or m.group(2)).lower()
        if token == "(":
            if operand:
                return None
            pending.append(token)
        elif token == ")":
            if not operand:
                return None
            while pending and pending[-1] != "(":
                out.append(pending.pop())
            if not pending:
                return None
            pending.pop()
        elif token in BINDING:
            if not operand:
                return None
            while pending and pending[-1] != "(" and BINDING[pending[-1]] >= BINDING[token]:
                out.append(pending.pop())
            pending.append(token)
            operand = False
        else:
            if operand:
                return None
            out.append(token)
            operand = True
    if not operand or "(" in pending:
        return None
    return out + pending[::-1]


def evaluate(postfix: list[str]) -> tuple[list[str], float | None] | None:
    """Labels of an expression, and what it permits: the best of an *or*, the least of an *and*."""
    stack: list[tuple[frozenset[str], float | None, bool]] = []  # labels, permission, one bare id
    for token in postfix:
        if token not in BINDING:
            stack.append((frozenset([token]), PERMISSION.get(token.removesuffix("+")), True))
            continue
        (right, b, bare), (left, a, single) = stack.pop(), stack.pop()
        if token == "with":
            if not bare or not single:  # an exception belongs to one licence
                return None
            lifted = None if a is None else a + (1 - a) * EXCEPTION_LIFT
            stack.append((frozenset([f"{min(left)} with {min(right)}"]), lifted, False))
        else:
            known = [x for x in (a, b) if x is not None]
            if token == "or":
                value = max(known, default=None)
            else:
                value = min(known) if len(known) == 2 else None
            stack.append((left | right, value, False))
    labels, value, _ = stack.pop()
    return sorted(labels), value


def read_expression(line: str) -> tuple[list[str], float | None] | None:
    """Labels and permission of the expression in a tag's line; comment ends are not part of it."""
    line = re.sub(r"\s*(\*/|-->|\*\)|[\"'`;,]).*$", "", line, flags=re.S).strip().rstrip(".")
    postfix = to_postfix(line)
    return evaluate(postfix) if postfix else None


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrases, kind in ((NOTICE_PHRASES, "notice"), (BASE_PHRASES, "base")):
        for phrase, label in phrases.items():
            a.add_word(f" {phrase} ", (kind, label, phrase.count(" ") + 1, len(phrase) + 2))
    for phrase in TAG_PHRASES:
        a.add_word(f" {phrase} ", ("tag", "", phrase.count(" ") + 1, len(phrase) + 2))
    a.make_automaton()
    return a


FIELDS = pa.schema(
    [
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("permission", pa.float64()),
    ]
)


def scan_texts(texts: pa.Array, machine: ahocorasick.Automaton) -> list[pa.Array]:
    """The columns of ``FIELDS`` for these texts."""
    data, at = flat(texts)
    n = len(at) - 1
    coded = WORDS[data]
    starts, ends, owner = boundaries(coded, at)
    lengths = ends - starts
    # Words with one blank around each, all documents in a row.
    place = np.cumsum(lengths + 1) - lengths  # of each word in the joined bytes
    joined = np.full(int(lengths.sum()) + len(starts) + 1, 32, np.uint8)
    joined[ragged(np.arange(len(joined)), place, lengths)] = ragged(coded, starts, lengths) - 1
    n_words = np.bincount(owner, minlength=n)
    before = np.cumsum(n_words) - n_words
    found: dict[int, dict] = {}
    raw = None
    for end, (kind, label, words, size) in machine.iter(joined.tobytes().decode("latin-1")):
        word = int(np.searchsorted(place, end - size + 2))
        doc = int(owner[word])
        if owner[word + words - 1] != doc:
            continue
        f = found.setdefault(doc, {"n": 0, "first": None, "last": None, "base": set(), "all": set(), "score": 0.0, "permission": []})
        if kind == "tag":
            raw = data.tobytes() if raw is None else raw
            text = raw[ends[word + words - 1] : at[doc + 1]]
            line = re.match(rb"\s*:?([^\r\n]*)", text).group(1).decode(errors="replace")
            read = read_expression(line)
            if read is None:
                f["all"].add("malformed")
            else:
                f["all"].update(read[0])
                if read[1] is not None:
                    f["permission"].append(read[1])
            f["score"] = max(f["score"], WEIGHTS["malformed" if read is None else "tag"])
            continue
        f["all"].add(label)
        f["score"] = max(f["score"], WEIGHTS[kind])
        if kind == "base":
            k = word - int(before[doc])
            f["n"] += 1
            f["first"] = k if f["first"] is None else min(k, f["first"])
            f["last"] = k if f["last"] is None else max(k, f["last"])
            f["base"].add(label)
    none = {"n": 0, "first": None, "last": None, "base": (), "all": (), "score": 0.0, "permission": ()}
    rows = [found.get(i, none) for i in range(n)]
    return [
        pa.array(n_words, pa.int64()),
        pa.array([r["n"] for r in rows], pa.int64()),
        pa.array([r["first"] for r in rows], pa.int64()),
        pa.array([r["last"] for r in rows], pa.int64()),
        pa.array([",".join(sorted(r["base"])) for r in rows], pa.string()),
        pa.array([",".join(sorted(r["all"])) for r in rows], pa.string()),
        pa.array([r["score"] for r in rows], pa.float64()),
        pa.array([min(r["permission"], default=None) for r in rows], pa.float64()),
    ]


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the licence columns, which replace columns of the same names."""
    ship(docs.sparkSession)
    added = {x.lower() for x in FIELDS.names}
    carried = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    read = fresh(docs, "_scanned")
    rows = docs.select(*carried, F.col(text).cast("string").alias(read))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carried).schema)
    schema += ", n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, permission double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for batch in batches:
            for part in slices(batch, read):
                made = scan_texts(part.column(read), machine)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*carried, *FIELDS.names])

    return rows.mapInArrow(run, schema)
