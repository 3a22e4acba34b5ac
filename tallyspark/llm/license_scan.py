"""License notices by diagonal voting, with DataFrame functions only.

All rolling word k-grams of every document are joined to the k-gram positions
of the templates.  Matches vote for (document, template, offset diagonal =
document position - template position); neighbouring diagonals are merged, so
an inserted or missing word does not split a notice.  A span of bounded length
is verified when the template words it holds in the template's order reach the
needed share (nearly all of a short template) and the words that name the
license stand together in it.

The templates' k-gram table is broadcast when it is proven small; only matches
are shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyspark.llm import common
from tallyspark.operators.sizing import broadcast_if_small

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 3
#: Diagonals at most so far apart become one span.
NEIGHBOURS = 3
#: Share of a template's words that a span must cover.
COVERED = 0.6
#: The same for templates of fewer than ``SHORT`` words.
NEARLY_ALL, SHORT = 0.9, 24
#: Words by which a span may be longer than its template: this share, and at
#: least ``NEIGHBOURS``.
LONGER = 0.25
#: Template k-grams up to this many rows are broadcast.
FEW = 200_000
#: Score of a document that only names a license.
NAMED = 0.5

# Phrases that name a license, and public notice texts.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "mit-terms": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "apache-terms": "you may not use this file except in compliance with the License",
    "gpl-terms": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                 "GNU General Public License as published by the Free Software Foundation",
    "bsd-terms": "Redistribution and use in source and binary forms, with or without modification, are permitted",
}
#: Further default templates: the texts of public licenses, by clause where
#: several licenses share one.  They add labels beside those of the SQL, which
#: knows ``TEMPLATES`` alone.
TEXTS = {
    "mit-permission": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies
        of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.""",
    "as-is-warranty": """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
        ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "apache-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License.""",
    "bsd-conditions": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution.""",
    "bsd-endorsement": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse
        or promote products derived from this software without specific prior written permission.""",
    "bsd-disclaimer": """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
        DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
        CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
        DAMAGE.""",
    "isc-terms": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "isc-disclaimer": """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
        INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
        SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA
        OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "mpl-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "mpl-short": "Licensed under the Mozilla Public License, Version 2.0.",
    "lgpl-terms": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation""",
    "agpl-terms": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation""",
    "gnu-warranty": """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
        for any purpose, commercial or non-commercial, and by any means.""",
    "zlib-terms": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use
        this software for any purpose, including commercial applications, and to alter it and redistribute it freely,
        subject to the following restrictions""",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-terms": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-terms": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-terms": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
}
#: Words of a template that must stand together in a span.
NAMING = {"mit-notice": "MIT License", "apache-notice": "Apache License", "cc-by-nc-notice": "CC BY-NC 4.0",
          "gpl-notice": "GNU General Public License", "gpl-terms": "GNU General Public License",
          "apache-header": "Apache License", "isc-terms": "provided that the above copyright notice",
          "mpl-notice": "Mozilla Public License", "mpl-short": "Mozilla Public License",
          "lgpl-terms": "GNU Lesser General Public License", "agpl-terms": "GNU Affero General Public License",
          "cc-by-notice": "CC BY 4.0", "cc-by-sa-notice": "CC BY-SA 4.0", "cc-by-terms": "Attribution 4.0",
          "cc-by-sa-terms": "Attribution-ShareAlike 4.0", "cc-by-nc-terms": "Attribution-NonCommercial 4.0"}


def words_of(text: Column) -> Column:
    low = F.translate(common.text_or_empty(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(WORD), 0)


def grams(words: Column, k: int = K) -> Column:
    """The rolling k-grams of a word array, in order."""
    last = F.size(words) - k
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last), lambda i: F.concat_ws(" ", *[words[i + F.lit(j)] for j in range(k)])))


def template_words() -> dict[str, list[str]]:
    return {name: re.findall(WORD, text.lower()) for name, text in TEMPLATES.items()}


def default_templates(spark: SparkSession) -> DataFrame:
    """(name, text, naming) of the notices and license texts shipped here."""
    return spark.createDataFrame([(n, t, NAMING.get(n)) for n, t in {**TEMPLATES, **TEXTS}.items()],
                                 "name string, text string, naming string")


def template_table(templates: DataFrame, k: int = K) -> DataFrame:
    """(t_no, template, t_words, t_size, named_at, named_size) of ``templates``
    (name, text and, if there is one, naming: words that must stand together).
    A template without k words, or without its naming words, fails."""
    naming = F.col("naming").cast("string") if "naming" in templates.columns else F.lit(None).cast("string")
    words, named = words_of(F.col("text").cast("string")), words_of(naming)
    size = F.size("named").cast("int")
    at = F.filter(F.sequence(F.lit(0), F.size("t_words") - 1),
                  lambda i: F.slice("t_words", i + 1, F.greatest(size, F.lit(1))) == F.col("named"))
    table = templates.select(F.col("name").cast("string").alias("template"), words.alias("t_words"),
                             named.alias("named")).distinct()
    table = common.stored(table.select(
        F.xxhash64("template", "t_words", "named").alias("t_no"), "template", "t_words",
        F.size("t_words").alias("t_size"), F.when(F.size("t_words") > 0, at).alias("named_at"),
        size.alias("named_size")), "license-templates")
    bad = table.where((F.col("t_size") < k) | F.col("template").isNull()
                      | (F.col("named_size") > 0) & (F.size("named_at") <= 0)).select("template").limit(5).collect()
    if bad:
        raise ValueError(f"templates of under {k} words, or without their naming words: {[r.template for r in bad]}")
    return table


def starts(words: Column, phrase: str) -> Column:
    """Where the words of ``phrase`` stand consecutively."""
    parts = phrase.split(" ")
    here = F.array_position(words, parts[0]) > 0
    for p in parts[1:]:
        here &= F.array_contains(words, p)

    def at(i):
        ok = words[i] == parts[0]
        for j, p in enumerate(parts[1:], 1):
            ok &= F.coalesce(F.get(words, i + F.lit(j)) == p, F.lit(False))
        return ok

    none = F.array().cast("array<int>")
    return F.when(here, F.filter(F.sequence(F.lit(0), F.size(words) - 1), at)).otherwise(none)


def in_order(pairs: Column) -> Column:
    """How many of ``pairs`` (struct p, back = -q; sorted) rise in both p and
    q: the longest increasing run of q, by its smallest ends."""
    none = F.slice(F.array(F.lit(None).cast("int")), 1, 0)
    ends = F.aggregate(pairs, none, lambda e, x: F.concat(
        F.filter(e, lambda y: y < -x.back), F.array(-x.back), F.slice(F.filter(e, lambda y: y >= -x.back), 2, 1 << 30)))
    return F.size(ends)


def spans(rows: DataFrame, k: int = K, templates: DataFrame | None = None) -> DataFrame:
    """(__f, __r, template, from_word, to_word, coverage) of the verified spans
    of ``rows`` (__f, __r, words): the best of each chain of neighbouring
    diagonals, or of each stretch of a chain that is longer than a span."""
    if templates is None:
        templates = default_templates(rows.sparkSession)
    table = template_table(templates, k)
    gram_rows = table.select("t_no", F.posexplode(grams(F.col("t_words"), k)).alias("t_at", "t_gram")).withColumn(
        "t_hash", F.xxhash64("t_gram"))
    gram_rows, few = broadcast_if_small(gram_rows, FEW)
    own = table.select(F.col("t_no").alias("no"), "template", "t_size", "named_at", "named_size")
    own = F.broadcast(own) if few else own.hint("merge")
    posted = rows.select("__f", "__r", F.posexplode(grams(F.col("words"), k)).alias("at", "gram"))
    hits = (posted.withColumn("hash", F.xxhash64("gram"))
            .join(gram_rows if few else gram_rows.hint("merge"),
                  (F.col("hash") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram"))))
    votes = (hits.groupBy("__f", "__r", "t_no", (F.col("at") - F.col("t_at")).alias("diagonal"))
             .agg(F.collect_set("t_at").alias("covers")))
    by = Window.partitionBy("__f", "__r", "t_no").orderBy("diagonal")
    gap = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by) > NEIGHBOURS).cast("int"), F.lit(0))
    merged = votes.withColumn("gap", gap).withColumn("span", F.sum("gap").over(by))
    merged = merged.withColumn("covers", F.array_distinct(F.flatten(F.transform(
        "covers", lambda p: F.sequence(p, p + F.lit(k - 1))))))

    chain = ["__f", "__r", "t_no", "span"]
    share = F.when(F.col("t_size") < SHORT, NEARLY_ALL).otherwise(COVERED)
    enough = lambda words: words / F.col("t_size") >= share
    longest = F.col("t_size") + F.greatest(F.lit(NEIGHBOURS), F.floor(F.col("t_size") * LONGER)).cast("int")
    low, high = F.col("diagonal") + F.array_min("covers"), F.col("diagonal") + F.array_max("covers")
    near = (merged.groupBy(*chain).agg(F.size(F.array_distinct(F.flatten(F.collect_list("covers")))).alias("words"),
                                       F.min(low).alias("low"), F.max(high).alias("high"))
            .join(own, F.col("t_no") == F.col("no")).where(enough(F.col("words"))).drop("no", "words"))
    # The words that stand where the template has them; a naming place counts when all its words are there.
    named = F.exists("named_at", lambda n: (n == F.col("q")) & (F.col("named_size") > 0) & F.forall(
        F.sequence(n, n + F.greatest(F.col("named_size"), F.lit(1)) - 1), lambda x: F.array_contains("covers", x)))
    pairs = (merged.join(near.hint("merge"), chain).withColumn("longest", longest)
             .select("*", F.explode("covers").alias("q")).withColumn("p", F.col("diagonal") + F.col("q"))
             .withColumn("named", F.coalesce(named, F.lit(False))))
    # A chain longer than a span is cut into stretches; each sees the next one too.
    cut = F.floor((F.col("p") - F.col("low")) / F.col("longest")).cast("int")
    stretch = F.when(F.col("high") - F.col("low") < F.col("longest"), F.array(F.lit(0))).otherwise(F.array(cut, cut - 1))
    parts = (pairs.withColumn("stretch", F.explode(stretch)).where("stretch >= 0")
             .groupBy(*chain, "stretch", "template", "t_size", "named_size", "low", "high", "longest")
             .agg(F.array_sort(F.collect_set(F.struct("p", (-F.col("q")).alias("back"), "named"))).alias("pairs"))
             .where(enough(F.size(F.array_distinct(F.col("pairs.back"))))))
    begin = F.col("low") + F.col("stretch") * F.col("longest")
    begins = F.when(F.col("high") - F.col("low") < F.col("longest"), F.array("low")).otherwise(
        F.filter(F.array_distinct(F.col("pairs.p")), lambda p: p < begin + F.col("longest")))

    def held(b):
        inside = F.filter("pairs", lambda x: (x.p >= b) & (x.p < b + F.col("longest")))
        last = F.array_max(F.transform(inside, lambda x: x.p))
        name = (F.col("named_size") == 0) | F.exists(
            inside, lambda x: x.named & (x.p + F.col("named_size") - 1 <= last))
        return F.struct(F.when(name, in_order(inside) / F.col("t_size")).otherwise(0.0).alias("coverage"),
                        (-b).alias("back"), last.alias("to_word"))

    best = parts.select(*chain, "template", "t_size", F.array_max(F.transform(begins, held)).alias("best"))
    return best.where(F.col("best.coverage") >= share).select(
        "__f", "__r", "template", (-F.col("best.back")).alias("from_word"), "best.to_word", "best.coverage").distinct()


def scan(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """The contract's row per document.  ``labels`` are the base labels and
    the names of the templates found; ``score`` is the best coverage of a
    template, and at least ``NAMED`` where a license is named.  ``templates``:
    see ``template_table``.

    Null and empty texts have no words and score 0; rows are told apart by
    their place in the input, so repeated rows each give a row."""
    common.ready(docs.sparkSession)
    rows = common.with_identity(docs, F.col("doc_id").cast("long").alias("doc_id"),
                                words_of(F.col("text").cast("string")).alias("words"))
    places = {label: starts(F.col("words"), phrase) for phrase, label in PHRASES.items()}
    base = rows.select("__f", "__r", "doc_id", F.size("words").cast("long").alias("n_words"),
                       *[p.alias(label) for label, p in places.items()])
    every = F.concat(*places)
    found = F.array_compact(F.array(*[F.when(F.size(x) > 0, x_) for x, x_ in ((n, F.lit(n)) for n in sorted(places))]))
    base = base.select("__f", "__r", "doc_id", "n_words", F.size(every).cast("long").alias("n_base"),
                       F.array_min(every).cast("long").alias("first_word"),
                       F.array_max(every).cast("long").alias("last_word"), found.alias("base"))
    own = spans(rows, templates=templates).groupBy("__f", "__r").agg(F.collect_set("template").alias("more"),
                                                F.max("coverage").alias("best"))
    joined = base.join(own.hint("merge"), ["__f", "__r"], "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base", F.coalesce("more", none)))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                         F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                         F.greatest(F.coalesce("best", F.lit(0.0)),
                                    F.when(F.col("n_base") > 0, NAMED).otherwise(0.0)).alias("score"))


def oracle_sql(k: int = K) -> str:
    """The same in DuckDB SQL."""
    words = template_words()
    table = ",\n".join(f"('{' '.join(w[i:i + k])}', '{name}', {i}, {len(w)})"
                       for name, w in words.items() for i in range(len(w) - k + 1))
    place = []
    for phrase, label in PHRASES.items():
        parts = phrase.split(" ")
        test = " AND ".join(f"w[i + {j + 1}] = '{p}'" for j, p in enumerate(parts))
        place.append(f"list_filter(range(len(w)), lambda i: coalesce({test}, false)) AS p_{label}")
    labels = [f"CASE WHEN len(p_{n}) > 0 THEN '{n}' END" for n in sorted(PHRASES.values())]
    every = " || ".join(f"p_{n}" for n in PHRASES.values())
    gram = " || ' ' || ".join(f"w[i + {j + 1}]" for j in range(k))
    return f"""
WITH t(gram, template, t_at, t_size) AS (VALUES {table}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
b AS (SELECT r, doc_id, len(w)::BIGINT AS n_words, {', '.join(place)} FROM d),
c AS (SELECT *, {every} AS p, list_filter([{', '.join(labels)}], lambda x: x IS NOT NULL) AS base FROM b),
g AS (SELECT r, i, {gram} AS gram FROM (SELECT r, w, unnest(range(len(w) - {k - 1})) AS i FROM d)),
v AS (SELECT r, template, t_size, i - t_at AS diagonal, list(DISTINCT t_at) AS covers
  FROM g JOIN t USING (gram) GROUP BY ALL),
m AS (SELECT *, sum(gap) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {NEIGHBOURS}
    THEN 1 ELSE 0 END AS gap FROM v)),
s AS (SELECT r, template, len(list_distinct(flatten(list_transform(flatten(list(covers)),
    lambda x: range(x, x + {k})))))::DOUBLE / any_value(t_size) AS coverage FROM m GROUP BY r, template, span),
o AS (SELECT r, list(DISTINCT template) AS more, max(coverage) AS best FROM s WHERE coverage >= {COVERED} GROUP BY r)
SELECT doc_id, n_words, len(p)::BIGINT AS n_base, list_min(p)::BIGINT AS first_word, list_max(p)::BIGINT AS last_word,
  array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(base || coalesce(more, []))), ',') AS labels,
  greatest(coalesce(best, 0.0::DOUBLE), CASE WHEN len(p) > 0 THEN {NAMED}::DOUBLE ELSE 0.0::DOUBLE END) AS score
FROM c LEFT JOIN o USING (r)"""
