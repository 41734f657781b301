"""License scans by an exact set-similarity join.

A text block matches a license template when it holds at least the threshold share of the
template's distinct tokens, and those tokens that tell the license from others (`MUST`, `NEVER`). The
blocks are all runs of consecutive words of a text that are up to a quarter longer than the
template; lines, indents and comment signs between the words do not matter. The join is exact and
looks at few blocks. The tokens of all templates are ordered by how many documents hold them,
rarest first, and with need = ceil(t |T|):

- prefix filter: a block that reaches the threshold holds one of the first |T| - need + 1 tokens of T, so
  only the words around these are looked at;
- length filter: the text has at least `need` distinct tokens of T;
- positional filter: around a prefix token the template's tokens that occur are taken in global order; if
  the first is the i-th of T and k of them follow, no block there has more than 1 + min(k, |T| - i) in common.

What is left is counted exactly, in one pass over the places of T's tokens.

Templates are a list of the caller, so they and the counts of their tokens go to every task; the counts are
taken over all documents. Each block is compared inside the row of its document: there is no
shuffle of texts and no group of blocks, however often a notice occurs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import quoted, table, without

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notices as their publishers word them, by label.
TEMPLATES = {
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ],
    "apache-2": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ],
    "gpl-notice": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ],
    "mpl-2": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0."],
    "cc-by-sa": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-4": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related rights to this work."],
}
# Tokens that a block has to hold if the template has them, and those it may not hold, by label.
MUST = {
    "mit": {"mit", "granted"}, "apache-2": {"apache", "2"}, "bsd": {"redistribution"}, "gpl-notice": {"gnu", "3"},
    "mpl-2": {"mozilla"}, "cc-by-nc": {"by", "nc"}, "cc-by-sa": {"attribution", "sharealike"},
    "cc-by-4": {"attribution", "4"}, "cc0": {"waived"},
}
NEVER = {
    "mit": {"bsd", "apache", "gpl"}, "cc-by-nc": {"sa", "nd"}, "cc-by-sa": {"noncommercial"},
    "cc-by-4": {"sharealike", "noncommercial", "noderivatives"}, "gpl-notice": {"lesser", "affero"},
}
THRESHOLD = 0.8
OUTPUTS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks")

# A byte of a word stays, lowered; every other byte becomes a blank.
_BYTES = bytes(
    (b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or b >= 97 and b <= 122 or b >= 128 else 32
    for b in range(256)
)


def tokens(text: bytes) -> list[bytes]:
    """The words of a text: letters and digits, and everything beyond ASCII, A-Z lowered."""
    return text.translate(_BYTES).split()


@dataclass(frozen=True)
class Template:
    label: str
    own: list[bytes]  # distinct tokens in global order
    need: int
    width: int  # words of a block
    must: frozenset[bytes]
    never: frozenset[bytes]


class Templates:
    """Templates with their tokens in global order, and which templates a rare token may start."""

    def __init__(
        self,
        templates: dict[str, list[str]],
        counts: dict[bytes, int],
        threshold: float,
        must: dict[str, set[str]] | None = None,
        never: dict[str, set[str]] | None = None,
    ):
        coded = lambda words: frozenset(w.encode() for w in words)
        self.all: list[Template] = []
        self.starts: dict[bytes, list[tuple[int, int]]] = {}
        for label in sorted(templates):
            for wording in templates[label]:
                words = tokens(wording.encode())
                own = sorted(set(words), key=lambda t: (counts.get(t, 0), t))
                if not own:
                    continue
                need = math.ceil(threshold * len(own) - 1e-9)
                for i, token in enumerate(own[: len(own) - need + 1]):
                    self.starts.setdefault(token, []).append((len(self.all), i))
                self.all.append(
                    Template(
                        label, own, need, len(words) + len(words) // 4,
                        coded((must or {}).get(label, ())) & set(own), coded((never or {}).get(label, ())),
                    )
                )
        self.universe = frozenset(t for template in self.all for t in template.own)

    def matches(self, block: set[bytes]) -> list[tuple[str, float]]:
        """Labels and shares of all templates that one block of tokens contains up to the threshold."""
        numbers = sorted({number for token in block & self.starts.keys() for number, _ in self.starts[token]})
        found = []
        for template in (self.all[n] for n in numbers):
            common = sum(token in block for token in template.own)
            if common >= template.need and template.must <= block and template.never.isdisjoint(block):
                found.append((template.label, common / len(template.own)))
        return found

    def blocks(self, found: list[bytes]) -> list[tuple[int, int, str, float]]:
        """First word, last word, label and share of the best block of each stretch that matches."""
        places: dict[bytes, list[int]] = {}
        for place, token in enumerate(found):
            if token in self.universe:
                places.setdefault(token, []).append(place)
        numbers = sorted({number for token in places.keys() & self.starts.keys() for number, _ in self.starts[token]})
        out = []
        for template in (self.all[n] for n in numbers):
            if sum(t in places for t in template.own) < template.need or not template.must <= places.keys():
                continue
            hits = sorted((place, i) for i, t in enumerate(template.own) for place in places.get(t, ()))
            for stretch in _stretches(template, hits):
                out.extend(_best_blocks(template, stretch, found))
        return sorted(out)


def _stretches(template: Template, hits: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """The hits around prefix tokens, joined where they overlap, that can hold a block.

    A hit is a place in the text and the number of its token in global order.
    """
    rare = len(template.own) - template.need
    spans: list[list[int]] = []
    for place, i in hits:
        if i <= rare:
            low, high = place - template.width + 1, place + template.width - 1
            if spans and low <= spans[-1][1]:
                spans[-1][1] = high
            else:
                spans.append([low, high])
    at = 0
    for low, high in spans:
        while at < len(hits) and hits[at][0] < low:
            at += 1
        end = at
        while end < len(hits) and hits[end][0] <= high:
            end += 1
        ordered = sorted({i for _, i in hits[at:end]})
        if 1 + min(len(ordered) - 1, len(template.own) - ordered[0] - 1) >= template.need:
            yield hits[at:end]
        at = end


def _best_blocks(
    template: Template, hits: list[tuple[int, int]], found: list[bytes]
) -> Iterator[tuple[int, int, str, float]]:
    """Of blocks that match and overlap the one with most tokens, of equal ones the first."""
    held: dict[int, int] = {}
    left, best = 0, None
    for place, i in hits:
        held[i] = held.get(i, 0) + 1
        while place - hits[left][0] >= template.width:
            gone = hits[left][1]
            held[gone] -= 1
            if not held[gone]:
                del held[gone]
            left += 1
        if len(held) < template.need:
            continue
        first = hits[left][0]
        block = set(found[first : place + 1])
        if not template.must <= block or not template.never.isdisjoint(block):
            continue
        if best and first > best[1]:
            yield (*best[:2], template.label, best[2] / len(template.own))
            best = None
        if best is None or len(held) > best[2]:
            best = (first, place, len(held))
    if best:
        yield (*best[:2], template.label, best[2] / len(template.own))


def _counted(wanted: frozenset[bytes]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                if text:
                    for token in wanted.intersection(tokens(text)):
                        seen[token] = seen.get(token, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "n"]
        )

    return run


def token_counts(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> dict[bytes, int]:
    """In how many documents each token of the templates occurs; as many numbers as they have tokens."""
    wanted = frozenset(t for texts in templates.values() for text in texts for t in tokens(text.encode()))
    counted = docs.select(F.col("text").cast("string")).mapInArrow(_counted(wanted), "token binary, n bigint")
    return {bytes(r["token"]): r["n"] for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def _scanned(templates: Templates, phrases: dict[str, str]) -> Callable:
    order = sorted(phrases)
    hints = [set(p.encode().split()) for p in order]
    longest = [p.encode().split() for p in order]

    def phrases_in(found: list[bytes]) -> list[tuple[int, str]]:
        places = []
        for words, phrase in zip(longest, order):
            n = len(words)
            i = -1
            while True:
                try:
                    i = found.index(words[0], i + 1)
                except ValueError:
                    break
                if found[i : i + n] == words:
                    places.append((i, phrases[phrase]))
        return places

    def scan(text: bytes) -> tuple:
        found = tokens(text)
        have = set(found)
        places = phrases_in(found) if any(h <= have for h in hints) else []
        base = sorted({label for _, label in places})
        blocks = [] if have.isdisjoint(templates.starts) else templates.blocks(found)
        labels = sorted({*base, *(label for _, _, label, _ in blocks)})
        score = max([1.0 if base else 0.0, *(share for *_, share in blocks)])
        at = [i for i, _ in places]
        return (
            len(found), len(places), min(at, default=None), max(at, default=None), ",".join(base), ",".join(labels),
            score, [{"first": a, "last": b, "label": label, "share": share} for a, b, label, share in blocks],
        )

    block = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last")] + [("label", pa.string()), ("share", pa.float64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), block]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_license_text")
            rows = [scan(text or b"") for text in batch.column(at).cast(pa.binary()).to_pylist()]
            others = [i for i in range(batch.num_columns) if i != at]
            made = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in others), *made], [*(batch.schema.names[i] for i in others), *OUTPUTS]
            )

    return run


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, list[str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD,
    must: dict[str, set[str]] = MUST,
    never: dict[str, set[str]] = NEVER,
) -> DataFrame:
    """`docs` without text, with the figures of the scan and the matching blocks.

    n_base counts the places of the phrases, first_word and last_word are their least and greatest start;
    labels joins the phrases' labels with those of the templates; score is 1 with a phrase, else
    the greatest share of a matching template. blocks lists (first word, last word, label, share), the best of overlapping ones. A null
    text counts as empty. Repeated rows are scanned one by one, an empty table gives an empty
    table, columns with the names of the outputs are replaced.
    """
    ordered = Templates(templates, token_counts(docs, templates), threshold, must, never)
    kept = without(docs, "text", "_license_text", *OUTPUTS)
    given = docs.select(*[quoted(c) for c in kept.columns], F.col("text").cast("string").alias("_license_text"))
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    fields += [
        "n_words bigint", "n_base bigint", "first_word bigint", "last_word bigint", "base_labels string",
        "labels string", "score double", "blocks array<struct<first:bigint,last:bigint,label:string,share:double>>",
    ]
    return given.mapInArrow(_scanned(ordered, phrases), ", ".join(fields))


def op7_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("blocks")


QUERIES = {"op7_license_join": op7_license_join}
ORACLE: dict[str, str] = {}
