"""License scan by conditional compression.

1. Documents that hold none of the anchors are filtered out by Spark. Of each
   given template, words at more positions than ``slack`` allows differences are
   anchors: a difference changes one position at most, so wording that stands
   holds at least one anchor as it is.
2. Around each anchor, a candidate block as long as the longest template with
   its differences on either side is taken from the whole text; overlapping
   blocks are one.
3. For each template, the block is cut into windows of twice the template's
   length, one length apart, so a place of it lies whole in one of them. A window
   that holds one of its anchors is compressed by zstandard, as plain words,
   without and with the template as a raw dictionary. Templates are ranked by
   their best size reduction, and a template is a candidate in the windows whose
   reduction per byte of template reaches ``CUT``.
4. Candidates are confirmed by exact wording: the words of the template are
   aligned to its windows (edits anywhere, ends free), and the differences
   counted. A template stands with differences in at most ``slack`` of its words;
   of standing templates that overlap, the one with more equal words wins.

``CUT`` lies between what edited wording and other text save: with all allowed
differences, 720 edited templates amid other text saved 0.35 of the template's
size or more, 720 windows of other text 0.11 at most. The tests compare the scan
with an alignment of every template to the whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Wording of widely used license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "all-rights-reserved": "All rights reserved.",
    "public-domain": "This work is dedicated to the public domain.",
}
_WORD = re.compile(r"[^\W_]+")


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def allowed(template: list[str], slack: float) -> int:
    """Differences with which a template stands: at least one word is equal."""
    return min(int(slack * len(template)), len(template) - 1)


def anchors(templates: list[list[str]], slack: float) -> set[str]:
    """Words that stand at ``allowed`` + 1 positions or more of each template;
    long ones and those of many templates first, as they are fewer."""
    shared = Counter(w for t in templates for w in set(t))
    out: set[str] = set()
    for t in templates:
        missing = allowed(t, slack) + 1
        for w, n in sorted(Counter(t).items(), key=lambda x: (-len(x[0]) ** 4 * shared[x[0]], x[0])):
            if missing <= 0:
                break
            out.add(w)
            missing -= n
    return out


def pattern(words: set[str]) -> str:
    """Matches, in Java and Python, any text that holds one of the lower-case
    words in any case (also as part of a word)."""
    kept = sorted(w for w in words if not any(x != w and x in w for x in words))
    # the other capitals whose lower case is the letter: the Kelvin sign and the dotted I
    return "|".join("(?i:%s)" % w.replace("k", "[k\u212a]") if w.isascii() else
                    "(?iu:%s)" % w.replace("i\u0307", "(?:i\u0307|\u0130)") for w in kept) or "(?!)"


KEYWORDS = pattern(anchors([_words(t) for t in TEMPLATES.values()], 0.1))
_KEY = re.compile(KEYWORDS)


def blocks(text: str, reach: int, words: set[str]) -> list[tuple[int, int]]:
    """Spans of ``reach`` words before and after each of the words, joined where
    they overlap."""
    at, found = [], []
    for m in _WORD.finditer(text):
        if m.group().lower() in words:
            found.append(len(at))
        at.append((m.start(), m.end()))
    out: list[tuple[int, int]] = []
    for k in found:
        lo, hi = max(0, k - reach), min(len(at), k + reach + 1)
        span = (at[lo][0], at[hi - 1][1])
        if out and span[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], span[1]))
        else:
            out.append(span)
    return out


def align(template: list[str], block: list[str]) -> list[tuple[int, int, int]]:
    """(differences, first word, end) of the template's best places in the
    block: semi-global word edit distance, places not overlapping, fewest
    differences first."""
    n = len(block)
    cost, origin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    same_as = {w: np.array([b == w for b in block]) for w in set(template)}
    for w in template:
        sub = cost[:-1] + ~same_as[w]
        up = cost[1:] + 1
        new, org = np.minimum(sub, up), np.where(sub <= up, origin[:-1], origin[1:])
        new, org = np.concatenate([[cost[0] + 1], new]), np.concatenate([[origin[0]], org])
        # words of the block skipped: running minimum of new[j] - j
        shifted = new - np.arange(n + 1)
        least = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == least, np.arange(n + 1), 0))
        cost, origin = least + np.arange(n + 1), org[source]
    out: list[tuple[int, int, int]] = []
    for j in np.lexsort((np.arange(n + 1), cost)):
        if cost[j] >= len(template):
            break
        a, b = int(origin[j]), int(j)
        if a < b and all(b <= x or a >= y for _, x, y in out):
            out.append((int(cost[j]), a, b))
    return out


#: Size reduction per byte of template from which on a window is a candidate,
#: and templates of so few bytes that compression can't tell: always candidates.
CUT, TINY = 0.2, 16


class Scanner:
    def __init__(self, templates: dict[str, str], slack: float):
        self.names, self.slack = list(templates), slack
        self.words = [_words(templates[n]) for n in self.names]
        self.own = [anchors([t], slack) | (anchors(self.words, slack) & set(t)) for t in self.words]
        self.anchors = anchors(self.words, slack)
        self.reach = max((len(t) + allowed(t, slack) for t in self.words), default=0)
        self.plain = zstandard.ZstdCompressor(level=19, write_content_size=False)
        given = [" ".join(t).encode() for t in self.words]
        self.size = [len(x) for x in given]
        self.given = [zstandard.ZstdCompressor(level=19, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(
            x, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) if len(x) > TINY else None for x in given]
        self.read, self.aligned = 0, 0  # windows compressed, and aligned

    def windows(self, i: int, ws: list[str]) -> list[tuple[float, int, int]]:
        """(reduction, first word, end) of the windows of template i that hold
        an anchor of it."""
        step, out = len(self.words[i]) + allowed(self.words[i], self.slack), []
        hits = np.array([k for k, w in enumerate(ws) if w in self.own[i]], np.int64)
        for a in range(0, max(1, len(ws) - step), step):
            b = min(len(ws), a + 2 * step)
            if np.searchsorted(hits, a) < np.searchsorted(hits, b):
                out.append((self.reduction(i, ws[a:b]), a, b))
        return out

    def reduction(self, i: int, ws: list[str]) -> float:
        self.read += 1
        if self.given[i] is None:
            return 1.0
        data = " ".join(ws).encode()
        return (len(self.plain.compress(data)) - len(self.given[i].compress(data))) / self.size[i]

    def scan(self, text: str) -> list[dict]:
        """Standing templates: license, start, end (code points), differences,
        reduction, rank."""
        found = []
        for a, b in blocks(text, self.reach, self.anchors):
            block = text[a:b]
            at = [(m.start(), m.end()) for m in _WORD.finditer(block)]
            ws = [block[x:y].lower() for x, y in at]
            cut = [self.windows(i, ws) for i in range(len(self.names))]
            best = [max((w[0] for w in x), default=-1.0) for x in cut]
            order = sorted(range(len(best)), key=lambda i: (-best[i] * self.size[i], i))
            hits = []
            for rank, i in enumerate(order):
                t = self.words[i]
                for low, high in _joined([(x, y) for saved, x, y in cut[i] if saved >= CUT]):
                    self.aligned += 1
                    for d, x, y in align(t, ws[low:high]):
                        if d > self.slack * len(t):
                            break
                        hits.append((d - len(t), d, low + x, low + y, i, best[i], rank))
            taken: list[tuple[int, int]] = []
            for _, d, x, y, i, saved, rank in sorted(hits):
                if all(y <= p or x >= q for p, q in taken):
                    taken.append((x, y))
                    found.append({"license": self.names[i], "start": a + at[x][0], "end": a + at[y - 1][1],
                                  "differences": d, "reduction": saved, "rank": rank + 1})
        return sorted(found, key=lambda r: r["start"])


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for x, y in spans:
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(y, out[-1][1]))
        else:
            out.append((x, y))
    return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, slack: float = 0.1,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, license, start, end, differences, reduction and rank of every
    standing template in the whole texts; documents without any give no row.

    start and end are code points of the text. Null and empty texts give no
    row, repeated documents a row each, a null id is returned as null. An empty
    table gives an empty result; other columns are ignored.
    """
    used = {n: t for n, t in (TEMPLATES if templates is None else templates).items() if _words(t)}
    keywords = pattern(anchors([_words(t) for t in used.values()], slack))
    candidates = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").rlike(keywords))
    kind = "array<struct<license:string,start:long,end:long,differences:long,reduction:double,rank:int>>"

    @F.pandas_udf(kind)
    def standing(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(used, slack)  # one for a task
        for texts in batches:
            yield texts.map(scanner.scan)

    return candidates.select("id", F.explode(standing("text")).alias("f")).select(
        F.col("id").alias(id_col), "f.license", "f.start", "f.end", "f.differences",
        F.round("f.reduction", 6).alias("reduction"), "f.rank")
