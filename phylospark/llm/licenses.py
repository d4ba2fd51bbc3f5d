"""License scans with DataFrame functions only: MinHash bands over overlapping windows of words.

Every text is cut into shingles of ``WIDTH`` words.  Windows of 16 shingle starts overlap by half.
Templates are cut into pieces of at most 9 shingles, so that wherever a piece stands, one window
holds it whole.  A window and a piece are a candidate when they agree in one of ``BANDS`` MinHash
values (bands of one row): a piece of 3 shingles within a window of 16 is met with probability
1 - (13/16)**24 = 0.993, one of 9 with 1 - (7/16)**24 > 0.999999, and a longer template has several
pieces.  Each candidate is verified by exact containment: the share of the template's shingles in
the stretch of text where the window puts it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH, BANDS, PIECE = 3, 24, 9
_STEP = 8

#: Public license notices, short ones and whole texts: fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    # whole texts, from the first sentence after the line of copyright
    ("MIT", """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Zlib", """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("BSL-1.0", """
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Unlicense", """
This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Apache-2.0", """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-3.0", """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    ("MPL-2.0", """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
]


def _shingles(text: Column) -> Column:
    """Hashes of a text's shingles, in order: words are runs of 0-9, a-z and non-ASCII characters."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), "[\\x00-/:-`{-\\x7f]+", " ")), " ")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.transform(
        F.filter(F.arrays_zip(hashes.alias("a"), F.slice(hashes, 2, 1 << 30).alias("b"), F.slice(hashes, 3, 1 << 30).alias("c")), lambda z: z["c"].isNotNull()),
        lambda z: F.xxhash64(z["a"], z["b"], z["c"]),
    )


def _minima(s: str) -> list[Column]:
    return [F.min(F.xxhash64(s, F.lit(j))).alias(f"m{j}") for j in range(BANDS)]


def _known(spark: SparkSession, templates: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """Templates with their shingles, and the MinHash values of their pieces."""
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    own = spark.createDataFrame(rows, "template int, license string, said string").select("template", "license", F.array_distinct(_shingles("said")).alias("known"), F.size(_shingles("said")).alias("span"), _shingles("said").alias("in_order"))
    # by place in the text, also where a shingle is repeated
    each = own.select("template", "span", F.posexplode("in_order").alias("at", "s"))
    # pieces of nearly equal size, none shorter than it has to be
    parts = F.ceil(F.col("span") / PIECE)
    piece = F.floor(F.col("at") * parts / F.col("span")).cast("int")
    pieces = each.withColumn("piece", piece).groupBy("template", "piece").agg(F.min("at").alias("offset"), *_minima("s"))
    values = pieces.select("template", "offset", F.posexplode(F.array(*[f"m{j}" for j in range(BANDS)])).alias("band", "value"))
    return own.drop("in_order"), values


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, *, key: str = "doc_id", text: str = "text", containment: float = 0.8, max_bytes: int = 4 << 20) -> DataFrame:
    """``key``, ``license``, ``containment`` (best of its templates) and ``first_word`` (its place).

    One row for each document and license with a template of which at least ``containment`` of the
    shingles stand together in the text.  Null and short texts match nothing; templates of fewer
    than ``WIDTH`` words are ignored; repeated documents with one key and text give one row.  Texts
    are shuffled once, by key.  Templates are literals of at most ``max_bytes`` in all: a word gives
    one shingle of 8 bytes and, for its piece, about ``BANDS`` values of 24 bytes for each 9 words.
    """
    if sum(len(said.encode()) for _, said in templates) > max_bytes:
        raise ValueError("too many templates: scan in blocks")
    own, values = _known(docs.sparkSession, templates)
    listed = values.collect()  # BANDS values for each piece of a template, bounded by max_bytes
    texts = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("tie"), F.coalesce(text, F.lit("")).alias("text"))
    # a key without nulls, by which everything below is partitioned
    texts = texts.withColumn("k", F.xxhash64("doc", "tie")).repartition("k")
    # an outer explode leaves no filter that would have to read the texts before the shuffle
    each = texts.select("k", "doc", "tie", F.posexplode_outer(_shingles("text")).alias("at", "s")).where("s is not null")
    blocks = each.groupBy("k", "doc", "tie", F.expr(f"at div {_STEP}").alias("b")).agg(*_minima("s"))
    twice = blocks.withColumn("w", F.explode(F.array("b", F.col("b") - 1)))
    windows = twice.groupBy("k", "doc", "tie", "w").agg(*[F.min(f"m{j}").alias(f"m{j}") for j in range(BANDS)])
    hit = F.lit(False)
    for j in range(BANDS):
        hit = hit | F.col(f"m{j}").isin([r.value for r in listed if r.band == j] or [0])
    met = windows.where(hit).select("k", "doc", "tie", "w", F.posexplode(F.array(*[f"m{j}" for j in range(BANDS)])).alias("band", "value"))
    # the templates' values, bounded by max_bytes, are broadcast
    pairs = met.join(F.broadcast(values), ["band", "value"]).select("k", "doc", "tie", "template", (F.col("w") * _STEP - F.col("offset")).alias("near")).distinct()
    near = pairs.join(F.broadcast(own), "template").groupBy("k").agg(F.collect_set(F.struct("near", "license", "known", "span", "doc", "tie")).alias("met"))
    # the key alone joins, so that the texts' partitioning serves; its hash is checked afterwards
    joined = texts.join(near, "k").select("doc", "tie", _shingles("text").alias("sh"), "met").select("doc", "tie", "sh", F.explode_outer("met").alias("m"))
    joined = joined.where("m.doc <=> doc and m.tie <=> tie")
    first = F.greatest(F.lit(0), F.col("m.near") - _STEP)
    part = F.slice("sh", first + 1, F.col("m.span") + 4 * _STEP)
    share = F.size(F.array_intersect(F.col("m.known"), "part")) / F.size("m.known")
    place = F.array_min(F.transform(F.array_intersect(F.col("m.known"), "part"), lambda s: F.array_position("part", s)))
    found = joined.withColumn("part", part).withColumn("first", first).withColumn("share", share).where(F.col("share") >= containment)
    found = found.select("doc", F.col("m.license").alias("license"), "share", (F.col("first") + place - 1).cast("long").alias("at"))
    best = F.max_by("at", F.struct("share", -F.col("at")))
    return found.groupBy(F.col("doc").alias(key), "license").agg(F.max("share").alias("containment"), best.alias("first_word"))
