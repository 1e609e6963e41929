"""License scans: text compared to licence templates by the Dice coefficient over word bigrams.

A template is compared with stretches of the text that are as long as itself, wherever they
begin: one for each bigram that both have. Only stretches with so many bigrams of the template
that their sizes let the pair reach the threshold are counted out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtab.llm._util import read

#: Wording of public licences and notices, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSL-1.0", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.'),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

LEAST = 0.8


def normalised(text: Column) -> Column:
    """Lower case, letters a to z and digits only, one space between words."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def bigrams(plain: Column) -> Column:
    """Pairs of neighbouring words of a normalised text, in order; null after the last word."""
    w = F.split(plain, " ")
    return F.zip_with(w, F.slice(w, F.lit(2), F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))


def _needed(size: Column, least: float) -> Column:
    """Bigrams that a stretch must share with a template of size, whatever its own number of them."""
    return F.ceil(size * F.lit(least / (2 - least)) - 1e-9).cast("int")


def _best(hits: Column, size: Column, total: Column, least: float) -> Column:
    """The highest coefficient of the stretches that begin at hits (position, bigram) of a text of total bigrams.

    A stretch has size positions, fewer at the end of the text; bigrams that the template lacks count
    once for each time that it has them, others once.
    """

    def of(hits: Column, i: Column) -> Column:
        start = F.get(hits, i - 1)["pos"]
        inside = F.filter(F.slice(hits, i, size), lambda x: x["pos"] < start + size)
        sizes = _bound(inside, lambda w: F.struct(F.size(w).alias("all"), F.size(F.array_distinct(F.transform(w, lambda x: x["id"]))).alias("both")))
        return _bound(sizes, lambda n: 2 * n["both"] / (F.least(size, total - start) - n["all"] + n["both"] + size))

    def best(hits: Column) -> Column:
        need = _needed(size, least)
        dense = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(hits) - need + 1)), lambda i: F.coalesce(F.get(hits, i + need - 2)["pos"] - F.get(hits, i - 1)["pos"] < size, F.lit(False)))
        return F.array_max(F.transform(dense, lambda i: of(hits, i)))

    return _bound(F.array_sort(hits), best)


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value worked out once however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """docs' doc_id with what licences its text holds: license and dice of the best match, licenses, n_matches.

    docs: doc_id, text; other columns are ignored. A match is a template and a stretch of the text
    with a coefficient of least or more, in the midst of other text or lines too; license is null and dice 0 where there is none, as in a null or
    empty text. licenses are the names matched, sorted, joined by commas; n_matches counts templates. The best match has the highest
    coefficient, then the first name. Each row counts, those that repeat a doc_id too: a text that many rows
    hold is told by 128 bits of hash and its bigrams are counted once. An empty table gives none. A very long text has
    one row for each bigram that it shares with a template.
    """
    spark = docs.sparkSession
    given = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, name string, body string")
    sets = given.select("template", "name", F.array_distinct(F.array_compact(bigrams(normalised(F.col("body"))))).alias("b"))
    pairs = sets.select("template", "name", F.size("b").alias("size"), F.posexplode("b").alias("id", "bigram"))  # as many rows as the templates have words
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("k1"), F.xxhash64(F.coalesce("text", F.lit("")), F.lit(1)).alias("k2"), F.coalesce("text", F.lit("")).alias("text"))
    words = keyed.select("k1", "k2", bigrams(normalised(F.col("text"))).alias("b")).select("k1", "k2", (F.size("b") - 1).alias("total"), F.posexplode("b").alias("pos", "bigram"))
    shared = words.join(F.broadcast(pairs), "bigram")
    hits = shared.groupBy("k1", "k2", "template").agg(F.any_value("name").alias("name"), F.any_value("size").alias("size"), F.any_value("total").alias("total"), F.collect_set(F.struct("pos", "id")).alias("hits"))
    hits = hits.where(F.size("hits") >= _needed(F.col("size"), least))
    dice = F.explode(F.array(_best(F.col("hits"), F.col("size"), F.col("total"), least)))  # not worked out again by the filter on it
    matched = hits.select("k1", "k2", "name", dice.alias("dice")).where(F.col("dice") >= least)
    found = matched.groupBy("k1", "k2").agg(
        F.max("dice").alias("dice"), F.min(F.struct(-F.col("dice"), "name")).alias("best"), F.array_join(F.array_sort(F.collect_set("name")), ",").alias("licenses"), F.count("*").alias("n_matches"),
    )
    joined = keyed.select("doc_id", "k1", "k2").join(found, ["k1", "k2"], "left")
    return joined.select("doc_id", F.col("best.name").alias("license"), F.coalesce("dice", F.lit(0.0)).alias("dice"), F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))


def oracle(templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST) -> str:
    rows = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(templates))
    plain = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    return f"""
WITH t(template, name, body) AS (VALUES {rows}),
tw AS (SELECT template, name, string_split({plain.format("body")}, ' ') AS w FROM t),
tb AS (SELECT DISTINCT template, name, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM tw),
ts AS (SELECT *, count(*) OVER (PARTITION BY template) AS size FROM tb),
d AS (SELECT doc_id, string_split({plain.format("coalesce(text, '')")}, ' ') AS w FROM documents),
p AS (SELECT doc_id, len(w) - 1 AS total, w, unnest(range(1, len(w))) AS pos FROM d),
s AS (SELECT doc_id, total, pos - 1 AS pos, template, name, size, bigram FROM (SELECT doc_id, total, pos, w[pos] || ' ' || w[pos + 1] AS bigram FROM p) JOIN ts USING (bigram)),
c AS (SELECT * FROM s QUALIFY count(*) OVER (PARTITION BY doc_id, template) >= {least / (2 - least)} * size - 1e-9),
u AS (
  SELECT a.doc_id, a.template, a.pos, any_value(a.name) AS name, any_value(a.size) AS size, any_value(a.total) AS total, count(*) AS n, count(DISTINCT b.bigram) AS n_both
  FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.template = b.template AND b.pos BETWEEN a.pos AND a.pos + a.size - 1 GROUP BY a.doc_id, a.template, a.pos),
m AS (SELECT doc_id, template, name, max(2 * n_both / (least(size, total - pos) - n + n_both + size)::DOUBLE) AS dice FROM u GROUP BY doc_id, template, name),
g AS (
  SELECT doc_id, max(dice) AS dice, arg_min(name, (-dice, name)) AS license, array_to_string(list_sort(list_distinct(list(name))), ',') AS licenses, count(*) AS n_matches
  FROM m WHERE dice >= {least} GROUP BY doc_id)
SELECT d.doc_id, license, coalesce(dice, 0.0)::DOUBLE AS dice, coalesce(licenses, '') AS licenses, coalesce(n_matches, 0)::BIGINT AS n_matches
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


OP3_SQL = oracle()
