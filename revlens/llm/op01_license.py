"""License scans by conditional compression.

Every licensing cue in a text opens a candidate block for each template: the text around the cue as
far as the template reaches (half as much again, for line ends, blank lines and comment marks), not
into a notice confirmed before it. The block is compressed alone and with the template as a raw
Zstandard dictionary. The size reduction, as a share of what the template saves on itself, ranks the
templates; the `RANKED` leaders with `MIN_SHARE` percent or more are confirmed by exact wording: the
words (lower case, punctuation aside) of template and block are aligned, and the words missing from
the template or put between its words are counted. A leader is confirmed around the cue if these are
few (none of under 10 words, a tenth of under 40, a fifth of more), no number and no word that tells
licenses apart (`TELLING`) is among them, and the span isn't part of a longer identifier. Of several,
one inside a wider one gives way, then the fewest differences win. Blocks are bounded by the templates,
so the work grows with the number of cues.

What remains of the lines with a cue, joined with the next ones while cues go on (a very long
line gives windows around its cues), is compressed and ranked as a whole in the same way, and
reported as unconfirmed when the reduction is `MIN_REDUCTION` percent or more, and dropped if less.

Defined results: one row per confirmed span and reported remainder of every input row, so repeated
rows repeat; null and empty texts give none; null ids stay; bytes and reduction are those of the
span or remainder; ties go to the smaller share of differences, then to the larger reduction, then
to the template first in the alphabet; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession

from revlens.llm import arrowtext

RANKED = 6
MIN_SHARE = 40
MIN_REDUCTION = 40
LEVEL = 3
LONG_LINE = 2000
AROUND = 600

#: Public license notices, the wording that is recognised.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD-2-Clause-short": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission."
    ),
    "BSD-3-Clause-short": "Released under the BSD 3-Clause License.",
    "BSD-short": "Released under the BSD License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-ND-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-SA-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-ND-4.0-long": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/."
    ),
    "ISC": "Released under the ISC License.",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "This project is MIT licensed.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions:"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "all-rights-reserved": "All rights reserved.",
}

#: Public license identifiers; a line that names one after the usual key is a notice.
IDENTIFIERS = (
    "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0",
    "CC-BY-ND-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only",
    "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense",
)
TEMPLATES |= {f"SPDX-{x}": f"SPDX-License-Identifier: {x}" for x in IDENTIFIERS}

#: Words that tell one known license from another; a notice that lacks one of them or has one more is another notice.
TELLING = frozenset(
    "affero agpl apache attribution bsd by cc cc0 clause commercial creative derivatives eclipse epl gnu gpl isc lesser lgpl library mit mozilla mpl nc nd "
    "noncommercial noderivatives noderivs not only sa sharealike unlicense zero".split()
)

#: Words that open a block; a line may end between two of them.
CUES = (
    "licen[cs]e", "copyright", "spdx", r"permission\W+is\W+hereby", "redistribut", r"all\W+rights\W+reserved", r"creative\W+commons",
    r"public\W+domain", "warrant", r"hereby\W+granted",
)
CUE = re.compile("|".join(CUES), re.IGNORECASE)
WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
#: What goes on with the word before it.
PART = re.compile(r"\+|-[^\W_]|\.[0-9]")
SCHEMA = (
    "doc_id long, start long, end long, license string, confirmed boolean, plain_bytes long, with_template_bytes long, "
    "reduction_percent double, n_different long, different string"
)


class Scanner:
    """Compressors, words and reach of the templates."""

    def __init__(self, templates: dict[str, str], level: int = LEVEL) -> None:
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False)
        self.primed, self.words, self.reach, self.saves = {}, {}, {}, {}
        for name, text in sorted(templates.items()):
            dictionary = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=level)
            self.primed[name] = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=False, write_dict_id=False)
            self.words[name] = [x.lower() for x in WORD.findall(text)]
            # few different lengths, so that a block is compressed alone once for many templates
            self.reach[name] = next(r for k in range(64) if (r := int(60 * 1.5**k)) >= 1.5 * len(text) + 30)
            self.saves[name] = max(1, self.plain_size(text) - len(self.primed[name].compress(text.encode())))

    def plain_size(self, block: str) -> int:
        return len(self.plain.compress(block.encode()))

    def ranked(self, block: str) -> tuple[int, list[tuple[int, str]]]:
        """Size alone, and (size with the template, template), smallest first."""
        data = block.encode()
        return len(self.plain.compress(data)), sorted((len(c.compress(data)), name) for name, c in self.primed.items())

    def leaders(self, text: str, begin: int, end: int, floor: int) -> list[tuple[str, int, int]]:
        """Templates ranked by size reduction of their blocks around the cue [begin, end), and the blocks."""
        alone: dict[int, tuple[int, int, bytes, int]] = {}
        ranked = []
        for name, compressor in self.primed.items():
            reach = self.reach[name]
            if reach not in alone:
                a, b = max(floor, begin - reach), min(len(text), end + reach)
                data = text[a:b].encode()
                alone[reach] = a, b, data, len(self.plain.compress(data))
            a, b, data, plain = alone[reach]
            share = 100 * (plain - len(compressor.compress(data))) / self.saves[name]
            if share >= MIN_SHARE:
                ranked.append((-share, name, a, b))
        return [x[1:] for x in sorted(ranked)[:RANKED]]

    def right(self, name: str, changed: list[str], text: str, begin: int, end: int) -> bool:
        """The differences are few and none makes it another license; the span is no part of an identifier."""
        n = len(self.words[name])
        if len(changed) > (0 if n < 10 else n // 10 if n < 40 else n // 5):
            return False
        if any(c[1:].replace(".", "").isdigit() or c[1:] in TELLING for c in changed):
            return False
        return not PART.match(text, end) and not (begin and text[begin - 1] in "-/" and text[begin - 2 : begin - 1].isalnum())

    def differences(self, name: str, found: list[str]) -> tuple[list[str], int, int]:
        """Words dropped (-) or put in (+) against the template, and the matched part of `found`."""
        wanted = self.words[name]
        match = difflib.SequenceMatcher(None, wanted, found, autojunk=False)
        blocks = [m for m in match.get_matching_blocks() if m.size]
        if not blocks:
            return [f"-{x}" for x in wanted], 0, 0
        first, last = blocks[0].b, blocks[-1].b + blocks[-1].size
        out = []
        for tag, i, j, p, q in difflib.SequenceMatcher(None, wanted, found[first:last], autojunk=False).get_opcodes():
            if tag != "equal":
                out += [f"-{x}" for x in wanted[i:j]] + [f"+{x}" for x in found[first:last][p:q]]
        return out, first, last

    def aligned(self, name: str, found: list[str], cue: list[bool]) -> tuple[list[str], int, int]:
        """As `differences`, of the part of `found` that holds the cue and has the fewest: words matched by chance before or after it are left."""
        wanted = self.words[name]
        middle = cue.index(True) if True in cue else 0
        best = None
        for low, high in nearby(wanted, found, middle):
            match = [m for m in difflib.SequenceMatcher(None, wanted, found[low:high], autojunk=False).get_matching_blocks() if m.size]
            if not match:
                continue
            # differences of the part from block i to block k: lead[i] + gaps[k] - gaps[i] + tail[k]
            gaps = [0]
            for x, y in zip(match, match[1:]):
                gaps.append(gaps[-1] + y.a - x.a - x.size + y.b - x.b - x.size)
            k_first = 0
            for k, m in enumerate(match):
                if m.a - gaps[k] < match[k_first].a - gaps[k_first]:
                    k_first = k
                cost = match[k_first].a - gaps[k_first] + gaps[k] + len(wanted) - m.a - m.size
                if best is None or cost < best[0]:
                    best = cost, low + match[k_first].b, low + m.b + m.size
        if best is None:
            return [f"-{x}" for x in wanted], 0, 0
        _, low, high = best
        changed, first, last = self.differences(name, found[low:high])
        return changed, low + first, low + last

    def confirmed(self, text: str, begin: int, end: int, floor: int) -> tuple | None:
        """The notice that holds the cue [begin, end), if a leading template's wording is confirmed."""
        options = []
        for name, a, b in self.leaders(text, begin, end, floor):
            tokens = [(m[0].lower(), *m.span()) for m in WORD.finditer(text, a, b)]
            changed, first, last = self.aligned(name, [x[0] for x in tokens], [x[1] < end and x[2] > begin for x in tokens])
            if last <= first:
                continue
            low, high = tokens[first][1], tokens[last - 1][2]
            if low < end and high > begin and self.right(name, changed, text, low, high):
                data = text[low:high].encode()
                options.append((len(changed) / len(self.words[name]), len(self.primed[name].compress(data)), name, low, high, len(self.plain.compress(data)), changed))
        wide = [x for x in options if not any(y[3] <= x[3] and x[4] <= y[4] and y[4] - y[3] > x[4] - x[3] for y in options)]
        if not wide:
            return None
        _, size, name, low, high, plain, changed = min(wide, key=lambda x: x[:4])
        return low, high, name, True, plain, size, 100 * (plain - size) / plain, len(changed), " ".join(changed)

    def rows(self, text: str) -> list[tuple]:
        """All confirmed spans of a text, and what is reported of its other blocks."""
        out, floor = [], 0
        for m in CUE.finditer(text):
            if m.start() >= floor and (row := self.confirmed(text, *m.span(), floor)):
                out.append(row)
                floor = row[1]
        known = [row[:2] for row in out]
        ends = [b for _, b in known]
        for a, b in blocks(text):
            k = bisect.bisect_right(ends, a)
            while k < len(known) and known[k][0] < b:
                self.remainder(text, a, known[k][0], out)
                a = max(a, known[k][1])
                k += 1
            self.remainder(text, a, b, out)
        return sorted(out, key=lambda x: x[:3])

    def remainder(self, text: str, begin: int, end: int, out: list[tuple]) -> None:
        if begin < end and CUE.search(text, begin, end) and (judged := self.judge(text, begin, end)):
            out.append(judged)

    def judge(self, text: str, begin: int, end: int) -> tuple | None:
        block = text[begin:end]
        plain, order = self.ranked(block)
        tokens = [(m[0].lower(), *m.span()) for m in WORD.finditer(block)]
        options = []
        for size, name in order[:RANKED]:
            changed, first, last = self.differences(name, [x[0] for x in tokens])
            good = last > first and self.right(name, changed, block, tokens[first][1], tokens[last - 1][2])
            options.append((not good, len(changed) / len(self.words[name]), size, name, changed, first, last))
        wrong, _, size, name, changed, first, last = min(options, key=lambda x: x[:4])
        reduction = 100 * (plain - size) / plain
        if wrong and reduction < MIN_REDUCTION:
            return None
        a, b = (tokens[first][1], tokens[last - 1][2]) if not wrong and last > first else (0, len(block))
        return begin + a, begin + b, name, not wrong, plain, size, reduction, len(changed), " ".join(changed)


def nearby(wanted: list[str], found: list[str], middle: int) -> list[tuple[int, int]]:
    """Parts of `found` around place `middle`, each as long as a notice may be: those that begin most like the notice and hold most of its words."""
    extra = len(wanted) // 5
    long, known = len(wanted) + extra + 1, set(wanted)
    first = max(0, middle - long + 1)
    held = [0]
    for x in found[first : middle + long]:
        held.append(held[-1] + (x in known))
    starts = []
    for k in range(first, min(len(found), middle + 1)):
        if found[k] in wanted[: 1 + extra]:
            alike = sum(x == y for x, y in zip(found[k : k + 4], wanted, strict=False))
            starts.append((alike, held[min(k + long - first, len(held) - 1)] - held[k - first], k))
    return [(k, min(len(found), k + long)) for _, _, k in sorted(starts)[-4:]]


def blocks(text: str) -> list[tuple[int, int]]:
    """Candidate blocks of a text, as [start, end) code points."""
    out: list[list[int]] = []
    for m in CUE.finditer(text):
        a = text.rfind("\n", 0, m.start()) + 1
        b = text.find("\n", m.end())
        b = len(text) if b < 0 else b
        if b - a > LONG_LINE:
            a, b = max(a, m.start() - AROUND), min(b, m.end() + AROUND)
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per licensing block found in `docs` (doc_id, text)."""
    chosen = dict(templates or TEMPLATES)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                cued = pc.match_substring_regex(part.column("text"), "|".join(CUES), ignore_case=True)
                part = part.filter(pc.fill_null(cued, False))
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    rows += [(doc, *row) for row in scanner.rows(text or "")]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kinds[x.split()[1]]) for c, x in zip(zip(*rows, strict=True), SCHEMA.split(", "), strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(task, SCHEMA)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
