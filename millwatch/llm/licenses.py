"""License scans: TF-IDF cosine of headers, notices and licence files to templates, inherited along directories."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millwatch.llm.common import table
from millwatch.plans.storage import written
from millwatch.session import ship

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _gnu(kind: str, version: int) -> list[str]:
    """Title and file header of a licence of the GNU family."""
    return [
        f"GNU {kind} PUBLIC LICENSE Version {version}",
        f"Licensed under the GNU {kind} Public License, version {version}.",
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by "
        f"the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
        f"This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
        f"or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details.",
    ]


#: Texts that licences are known by, fixed values: short licences whole, of long ones title and file header, and the usual notices.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "The MIT License (MIT)",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
            '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
            "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
            "Software. " + _WARRANTY],
    "ISC": ["Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004",
                   'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
                   "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
                   "implied. See the License for the specific language governing permissions and limitations under the License."],
    "GPL-2.0": _gnu("General", 2),
    "GPL-3.0": [*_gnu("General", 3), "This work is licensed under the GNU General Public License, version 3."],
    "LGPL-2.1": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1", "Licensed under the GNU Lesser General Public License, version 2.1."],
    "LGPL-3.0": [*_gnu("Lesser General", 3), "GNU LESSER GENERAL PUBLIC LICENSE"],
    "AGPL-3.0": _gnu("Affero General", 3),
    "MPL-2.0": ["Mozilla Public License Version 2.0",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                "You can obtain one at https://mozilla.org/MPL/2.0/."],
    "BSD-2-Clause": [f"{_BSD_START} {_BSD_END}"],
    "BSD-3-Clause": [f"{_BSD_START} {_BSD_NAMES} {_BSD_END}", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met", "Licensed under the BSD 3-Clause License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC0-1.0": ["CC0 1.0 Universal", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
                "software to the public domain worldwide."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
                  "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "All-rights-reserved": ["All rights reserved."],
}
TERM = r"[a-z0-9]+(?:[.-][0-9]+)*"
#: A tag that names a license outright; what follows a name, as -only or -or-later, does not matter here.
TAG = r"spdx-license-identifier:\s*\(?([a-z0-9][a-z0-9.]*(?:-[a-z0-9.]+)*)"
#: A window of words counts as a template's from this cosine on.
LEAST_COSINE = 0.75
#: A file is a licence file if license windows are at least this share of its words.
FILE_SHARE = 0.5
SALTS = 32

_term, _tag = re.compile(TERM), re.compile(TAG)


def terms(text: str | None) -> list[str]:
    """Words of a text, without marks: those of comments go with all others, and lines do not matter."""
    return _term.findall((text or "").lower())


def tagged(text: str | None) -> str | None:
    """The license that the first known tag names."""
    for found in _tag.findall((text or "").lower()) if "SPDX" in (text or "") or "spdx" in (text or "") else ():
        for name in sorted(TEMPLATES, key=len, reverse=True):
            if found == name.lower() or found.startswith((f"{name.lower()}-", f"{name.lower()}+")):
                return name
    return None


class Templates:
    """TF-IDF vectors of the templates under document frequencies of their terms, and the search for them in a text.

    A window of a text has as many words as the template and begins with one of its words. The squared
    cosine of two vectors is at most the share of the template's squared length that lies in the terms that
    the window has too; running sums give that bound for all windows at once, and only those that it leaves are
    compared exactly.
    """

    def __init__(self, df: dict[str, int], total: int):
        texts = [(name, terms(text)) for name, whole in sorted(TEMPLATES.items()) for text in whole]
        self.vocabulary = {t: i for i, t in enumerate(_vocabulary())}
        self.idf = np.array([math.log((1 + total) / (1 + df.get(t, 0))) + 1 for t in self.vocabulary])
        self.other = math.log((1 + total) / 2) + 1
        self.names = [name for name, _ in texts]
        self.sizes = np.array([len(t) for _, t in texts])
        self.weights = np.zeros((len(texts), len(self.idf)))
        for i, (_, found) in enumerate(texts):
            np.add.at(self.weights[i], [self.vocabulary[t] for t in found], 1)
        self.weights *= self.idf
        self.lengths = np.sqrt((self.weights ** 2).sum(1))
        self.shares = (self.weights / self.lengths[:, None]) ** 2

    def cosine(self, template: int, window: np.ndarray) -> float:
        """Of a window of term numbers (-1: another term; each of these counts by itself) with a template."""
        known, times = np.unique(window[window >= 0], return_counts=True)
        weights = times * self.idf[known]
        length = math.sqrt((weights ** 2).sum() + (window < 0).sum() * self.other ** 2)
        return float((weights * self.weights[template, known]).sum() / (length * self.lengths[template]))

    def search(self, found: list[str]) -> tuple[float, str | None, int]:
        """Greatest cosine of a window to a template and its license (ties to the earlier template, then place), and the words in windows that match."""
        numbers = np.array([self.vocabulary.get(t, -1) for t in found], "int64")
        hits = np.flatnonzero(numbers >= 0)
        if len(hits) < 2:
            return 0.0, None, 0
        least = LEAST_COSINE ** 2 - 1e-9
        able = np.flatnonzero(self.shares[:, numbers[hits]].sum(1) >= least)
        best, covered = (0.0, None), np.zeros(len(found) + 1, "int64")
        for template in able:
            share = self.shares[template, numbers[hits]]
            own, size = hits[share > 0], int(self.sizes[template])
            sums = np.r_[0.0, np.cumsum(share[share > 0])]
            upto = np.searchsorted(own, own + size)
            for at in own[sums[upto] - sums[:-1] >= least]:
                cosine = self.cosine(template, numbers[at:at + size])
                if cosine >= LEAST_COSINE:
                    covered[at] += 1
                    covered[min(at + size, len(found))] -= 1
                    if cosine > best[0] + 1e-12:
                        best = cosine, self.names[template]
        return *best, int((np.cumsum(covered)[:-1] > 0).sum())


def _vocabulary() -> list[str]:
    return sorted({t for texts in TEMPLATES.values() for text in texts for t in terms(text)})


def scan(files: DataFrame) -> DataFrame:
    """License of each file (path, file_key, text): its own, or that of the nearest directory above.

    Windows of words, across lines and comment marks, are compared with each template by the cosine of
    TF-IDF vectors; document frequencies of the templates' terms are counted over all files, other
    terms weigh as if one file had them. A window matches from ``LEAST_COSINE`` on. A file's own license is
    what its first known SPDX tag names (cosine 1), else that of its best window, ties to the smaller
    name. A file most of whose words are in matching windows is the licence file
    of its directory (of several, the smallest path's); other files without a license of their own inherit from
    the nearest directory that has one.

    Returns file_key, path, license, cosine, inherited_from (the directory, or null). Null texts have no words; null
    paths have no directory; repeated rows are files of their own; other columns are not read. No rows, no output.
    """
    ship(files.sparkSession)
    vocabulary = set(_vocabulary())
    narrow = files.select(F.col("file_key").cast("long").alias("file_key"), F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            df: Counter = Counter()
            for text in batch.column("text").to_pylist():
                df.update(vocabulary.intersection(terms(text)))
            df[""] += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64())], names=["term", "n"])

    # One row for each term of the templates, and one for the number of files.
    df = {r["term"]: r["n"] for r in narrow.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(df, df.get("", 0))
        for batch in batches:
            out = []
            for key, path, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = terms(text)
                cosine, name, covered = templates.search(found)
                tag = tagged(text)
                own = tag or name
                out.append((key, path, own, 1.0 if tag else cosine if name else None, own is not None and (covered >= FILE_SHARE * len(found) or bool(tag) and len(found) <= 5)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, [pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_()])],
                                             names=["file_key", "path", "license", "cosine", "is_file"])

    told = narrow.mapInArrow(match, "file_key long, path string, license string, cosine double, is_file boolean")
    told = written(told.withColumn("dir", directory(F.col("path"))), "license-files")
    granted = (told.where("is_file and license is not null and dir is not null").groupBy("dir")
               .agg(F.min_by("license", F.struct("path", "file_key")).alias("dir_license")))
    # Directories, not files, look for their ancestors; files then meet their directory in salted copies.
    steps = F.split("dir", "/")
    above = told.where("dir is not null").select("dir").distinct().withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(steps))))
    above = above.withColumn("up", F.array_join(F.slice(steps, 1, F.col("depth")), "/"))
    nearest = (above.join(granted.withColumnRenamed("dir", "up"), "up").groupBy("dir")
               .agg(F.max_by(F.struct("up", "dir_license"), F.col("depth")).alias("from"))
               .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    joined = told.withColumn("salt", F.pmod(F.xxhash64("file_key"), F.lit(SALTS)).cast("int")).join(nearest, ["dir", "salt"], "left")
    return joined.select("file_key", "path", F.coalesce("license", "from.dir_license").alias("license"), "cosine",
                         F.when(F.col("license").isNull(), F.col("from.up")).alias("inherited_from"))


def directory(path: Column) -> Column:
    """Path up to the last slash; empty for a file at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def op8_licenses(spark, sf_dir):
    """Documents as files ``source/lang/doc_id``."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string"))
    found = scan(docs.select(F.col("doc_id").alias("file_key"), path.alias("path"), "text"))
    return found.select(F.col("file_key").alias("doc_id"), "license", F.round("cosine", 6).alias("cosine"), "inherited_from")
