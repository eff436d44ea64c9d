"""License scans by conditional compression.

A candidate block (sentences with license words and what little lies between
them) is read in parts: each such sentence, and stretches of the block. A part is
compressed by zstandard alone and with each template as raw dictionary; what a
template takes off the size ranks it. Every template that takes off enough is then
held against the part word by word, and confirmed where the part has a whole
notice of it, or a stretch of one with few words and no number different. Of
templates that claim the same words the one with the fewest differences counts.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that make a line a candidate, for Java and Python alike.
CUES = r"(?i)licen[sc]|copyright|\(c\)|warrant|redistribut|public domain|creative commons|\bcc[ -]?(?:by|0)\b|spdx|as is"
#: Sentences between two candidate sentences of one block, and before and after them, that are read too; sentences of a stretch, which overlap by half, and words likewise of one
#: that is longer than a notice ever is.
GAP, ABOUT, STRETCH, LONG = 2, 4, 32, 600
#: The least share of the size that a template must take off, and the share of words that may differ.
LEAST_GAIN, MOST_DIFFERENT = 0.15, 0.15

#: The usual notices of public licenses, one on each line, and passages of their texts.
TEMPLATES = {
    "MIT": """Released under the MIT License.
Licensed under the MIT License.
This project is licensed under the terms of the MIT license.
SPDX-License-Identifier: MIT
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0.
Released under the Apache License, Version 2.0.
SPDX-License-Identifier: Apache-2.0
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This work is licensed under the GNU General Public License, version 3.
Licensed under the GNU General Public License v3.0.
SPDX-License-Identifier: GPL-3.0
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "GPL-2.0": """This work is licensed under the GNU General Public License, version 2.
Licensed under the GNU General Public License v2.0.
SPDX-License-Identifier: GPL-2.0
This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
    "LGPL-3.0": """This work is licensed under the GNU Lesser General Public License, version 3.
Licensed under the GNU Lesser General Public License v3.0.
SPDX-License-Identifier: LGPL-3.0""",
    "AGPL-3.0": """This work is licensed under the GNU Affero General Public License, version 3.
Licensed under the GNU Affero General Public License v3.0.
SPDX-License-Identifier: AGPL-3.0""",
    "BSD-3-Clause": """Released under the BSD 3-Clause License.
Licensed under the BSD 3-Clause License.
SPDX-License-Identifier: BSD-3-Clause
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "BSD-2-Clause": """Released under the BSD 2-Clause License.
Licensed under the BSD 2-Clause License.
SPDX-License-Identifier: BSD-2-Clause""",
    "MPL-2.0": """Licensed under the Mozilla Public License, version 2.0.
SPDX-License-Identifier: MPL-2.0
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "CC-BY-4.0": """Licensed under CC BY 4.0.
This work is licensed under a Creative Commons Attribution 4.0 International License.
SPDX-License-Identifier: CC-BY-4.0""",
    "CC-BY-SA-4.0": """Licensed under CC BY-SA 4.0.
This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.
SPDX-License-Identifier: CC-BY-SA-4.0""",
    "CC-BY-NC-4.0": """Licensed under CC BY-NC 4.0.
This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.
SPDX-License-Identifier: CC-BY-NC-4.0""",
    "CC0-1.0": """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.
Dedicated to the public domain under CC0 1.0.
SPDX-License-Identifier: CC0-1.0""",
    "ISC": """Released under the ISC License.
SPDX-License-Identifier: ISC
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
SPDX-License-Identifier: Unlicense""",
}

SCHEMA = "id string, n int, block_start int, block_end int, license string, size_alone int, size_with int, gain double, words_different int, exact boolean"
_cue = re.compile(CUES)
_word = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_sentence = re.compile(r"[.!?]\s+")


def _words(text: str) -> list[str]:
    return _word.findall(text.lower())


def sentences(text: str) -> list[tuple[int, int]]:
    """start and end of each; lines end them too."""
    pieces, at = [], 0
    for line in text.split("\n"):
        cuts = [0, *(m.end() for m in _sentence.finditer(line))]
        pieces += [(at + a, at + b) for a, b in zip(cuts, [*cuts[1:], len(line)], strict=True)]
        at += len(line) + 1
    return pieces


def blocks(text: str) -> list[list[tuple[int, int]]]:
    """The sentences of each candidate block and of ABOUT it."""
    pieces, out = sentences(text), []
    for i, (a, b) in enumerate(pieces):
        if _cue.search(text, a, b):
            if out and i - out[-1][1] <= GAP + 1:
                out[-1][1] = i
            else:
                out.append([i, i])
    return [pieces[max(0, a - ABOUT) : b + 1 + ABOUT] for a, b in out]


def parts(text: str, block: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """start and end of what is compressed: each sentence with license words, and stretches of the block; very long ones in pieces that overlap by half."""
    found = [(a, b) for a, b in block if _cue.search(text, a, b)]
    if len(block) > 1:
        found += [(block[i][0], block[min(i + STRETCH, len(block)) - 1][1]) for i in range(0, max(1, len(block) - STRETCH // 2), STRETCH // 2)]
    out = []
    for a, b in found:
        spots = [m.start() for m in _word.finditer(text, a, b)] if b - a > LONG else []
        if len(spots) > LONG:
            ends = [*spots, b]
            out += [(spots[i], ends[min(i + LONG, len(spots))]) for i in range(0, len(spots) - LONG // 2, LONG // 2)]
        else:
            out.append((a, b))
    return list(dict.fromkeys(out))


@cache
def _compressors() -> tuple[zstandard.ZstdCompressor, dict[str, zstandard.ZstdCompressor], dict[str, list[list[str]]]]:
    given = {}
    for name, text in TEMPLATES.items():
        own = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        given[name] = zstandard.ZstdCompressor(level=9, dict_data=own, write_checksum=False, write_content_size=False, write_dict_id=False)
    return zstandard.ZstdCompressor(level=9, write_checksum=False, write_content_size=False), given, {n: [_words(x) for x in t.split("\n")] for n, t in TEMPLATES.items()}


def different(block: list[str], notice: list[str]) -> tuple[int, int, int, int]:
    """Words of the notice that the block's best stretch lacks or has otherwise, what it has besides within it, and where the stretch
    begins and ends; a number that differs counts as the whole notice."""
    match = difflib.SequenceMatcher(None, notice, block, autojunk=False)
    same = [m for m in match.get_matching_blocks() if m.size]
    if not same:
        return len(notice), 0, 0, 0
    begin, end = same[0].b, same[-1].b + same[-1].size
    stretch = block[begin:end]
    kept = sum(m.size for m in same)
    numbers = lambda words: sorted(n for w in words for n in re.findall(r"\d+(?:\.\d+)*", w))
    lacks = len(notice) if numbers(stretch) != numbers(notice) else len(notice) - kept
    return lacks, len(stretch) - kept, begin, end


def confirm(text: str, start: int = 0, end: int | None = None) -> list[tuple[int, int, int, int, str, int, int]]:
    """(words that differ, less the notice's words, begin, end, license, size alone, size with its template) of each notice that a part has; places in the text."""
    alone, given, notices = _compressors()
    own = text[start : len(text) if end is None else end]
    raw = own.encode("utf-8", "surrogatepass")
    spans = [(start + m.start(), start + m.end()) for m in _word.finditer(own)]
    words = [text[a:b].lower() for a, b in spans]
    held, plain, found = set(words), len(alone.compress(raw)), []
    for name, c in given.items():
        size = len(c.compress(raw))
        if plain - size < LEAST_GAIN * plain:
            continue
        for notice in notices[name]:
            if sum(w not in held for w in notice) > MOST_DIFFERENT * len(notice):  # words that it surely lacks
                continue
            lacks, more, begin, stop = different(words, notice)
            if lacks + more <= MOST_DIFFERENT * len(notice):
                found.append((lacks + more, -len(notice), spans[begin][0], spans[stop - 1][1], name, plain, size))
    return found


def licenses_of(text: str) -> list[tuple[int, int, str, int, int, int, bool]]:
    """start and end of the block's license words' sentences, license, size alone, size with its template, words that differ, whether none does."""
    out = []
    for block in blocks(text):
        hits: dict[tuple, None] = {}
        for a, b in parts(text, block):
            hits.update(dict.fromkeys(confirm(text, a, b)))
        taken: list[tuple[int, int]] = []
        best: dict[str, tuple] = {}
        for hit in sorted(hits):
            wrong, _, begin, end, name, plain, size = hit
            # overlapping claims: the first is the closest, and of equal ones the longest notice, then the first name
            at = bisect.bisect_left(taken, (begin, end))
            if (at < len(taken) and taken[at][0] < end) or (at and taken[at - 1][1] > begin):
                continue
            taken.insert(at, (begin, end))
            best.setdefault(name, (name, plain, size, wrong, wrong == 0))
        marked = [x for x in block if _cue.search(text, *x)]
        out += [(marked[0][0], marked[-1][1], *best[name]) for name in sorted(best)]
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n, block_start, block_end, license, size_alone, size_with, gain, words_different, exact: a row for each license of a block.

    Places are code points; sizes are those of the part of the block that has the
    notice, words_different those of the license's closest notice. Null and empty
    texts, and an empty table, have no block; repeated rows are scanned each; texts
    and blocks of any length are read whole.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, text in zip(frame["id"], frame["text"], strict=True):
                for n, (a, b, name, plain, size, wrong, exact) in enumerate(licenses_of(text)):
                    rows.append((doc, n, a, b, name, plain, size, round(1 - size / plain, 6), wrong, exact))
            out = pd.DataFrame(rows, columns=names)
            out["id"] = pd.Series([r[0] for r in rows], dtype=frame["id"].dtype)
            yield out

    some = docs.where(F.col(text_col).rlike(CUES)).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return some.mapInPandas(read, SCHEMA.replace("id string", f"id {kind}", 1)).withColumnRenamed("id", id_col)
