"""License scans by diagonal voting.

Texts are lower-cased (A-Z) and cut into words. Every rolling k-gram of words is hashed and joined by Spark to the positions
of the same k-gram in license templates. A match votes for the diagonal (position in the text minus position in the
template); votes are counted per text, template and diagonal, neighbouring diagonals whose matches lie together are merged,
so a few inserted or missing words do no harm, and the span of each merged diagonal is verified: the words that text and
template share in order must cover enough of the template.

Besides, base phrases are found exactly, wherever their words stand consecutively. The score is the best verified share of a
template, or 1 where a base phrase stands. Null or empty texts have no words and no labels; an empty table gives no row.
Equal texts are judged once, every row is returned, with or without an id. Of templates that share a place the one with the
highest share counts, of equal ones the later. Texts are read whole. Other columns are not read.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from lexiloom.llm.common import append_columns, shingle_hashes, small, stored, word_hashes
from lexiloom.operators.lookup import lookup_join

#: Words of the base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Opening or naming sentences, and notices and bodies, of widespread licenses, as words. Public license texts.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
        "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed "
        "to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any "
        "kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do "
        "so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software the software is provided as is without warranty of any kind express or implied including "
        "but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
        "authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or "
        "otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later version this program is "
        "distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or "
        "fitness for a particular purpose see the gnu general public license for more details you should have received a copy of the gnu "
        "general public license along with this program if not see http www gnu org licenses",
    ),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution this software is provided by "
        "the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied "
        "warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or "
        "contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited "
        "to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any "
        "theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of "
        "the use of this software even if advised of the possibility of such damage",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
        "that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author "
        "disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no "
        "event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting "
        "from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in "
        "connection with the use or performance of this software",
    ),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed "
        "with this file you can obtain one at http mozilla org mpl 2 0",
    ),
    ("reserved", "copyright all rights reserved"),
)
GRAM_WORDS = 3
#: How far diagonals may be apart to be merged, and the least share of a template that a span must cover.
NEIGHBOURS, LEAST_COVER = 3, 0.75

_ASCII = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_ASCII).split() if text else []


_BASE = [(words_of(phrase), label) for phrase, label in PHRASES]
_TEMPLATE_WORDS = [(label, words_of(text)) for label, text in TEMPLATES]

BASE = T.StructType(
    [
        T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
        T.StructField("_base", T.ArrayType(T.StringType())),
    ]
)
GRAMS = T.StructType([T.StructField("_grams", T.ArrayType(T.LongType()))])
FOUND = T.StructType([T.StructField("_found", T.ArrayType(T.StringType())), T.StructField("_score", T.DoubleType())])


def base_places(text: str | None) -> tuple[int, int, int | None, int | None, list[str]]:
    words = words_of(text)
    places, labels = [], []
    for phrase, label in _BASE:
        at = -1
        found = []
        if phrase[-1] in words:
            while True:
                try:
                    at = words.index(phrase[0], at + 1)
                except ValueError:
                    break
                if words[at : at + len(phrase)] == phrase:
                    found.append(at)
        if found:
            labels.append(label)
            places += found
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels)


def gram_hashes(words: list[bytes]) -> list[int]:
    if len(words) < GRAM_WORDS:
        return []
    return shingle_hashes(word_hashes(words), GRAM_WORDS).view(np.int64).tolist()


def template_positions(spark: SparkSession) -> DataFrame:
    rows = [
        (gram, template, at)
        for template, (_, words) in enumerate(_TEMPLATE_WORDS)
        for at, gram in enumerate(gram_hashes(words))
    ]
    return spark.createDataFrame(rows, "gram long, template int, place int")


def _merged(votes: list[dict]) -> list[tuple[int, int, int]]:
    """(template, first, last position) of merged neighbouring diagonals, from rows of template, diagonal, first, last."""
    spans: list[list[int]] = []
    for vote in sorted(votes, key=lambda v: (v["template"], v["diagonal"], v["first"])):
        for span in reversed(spans):
            if span[0] != vote["template"] or vote["diagonal"] - span[3] > NEIGHBOURS:
                break
            reach = len(_TEMPLATE_WORDS[span[0]][1])
            if vote["first"] <= span[2] + reach and span[1] <= vote["last"] + reach:
                span[1:] = [min(span[1], vote["first"]), max(span[2], vote["last"]), vote["diagonal"]]
                break
        else:
            spans.append([vote["template"], vote["first"], vote["last"], vote["diagonal"]])
            continue
        if span[0] != vote["template"] or vote["diagonal"] > span[3]:
            spans.append([vote["template"], vote["first"], vote["last"], vote["diagonal"]])
    return [(t, first, last) for t, first, last, _ in spans]


def _cover(words: list[bytes], template: int, first: int, last: int) -> float:
    """Share of a template's words that stand in order in some template-sized part of the span."""
    wanted = _TEMPLATE_WORDS[template][1]
    best = 0.0
    step = len(wanted)
    at = max(0, first - step)
    while at <= last:
        part = words[at : at + 2 * step + GRAM_WORDS]
        blocks = SequenceMatcher(None, part, wanted, autojunk=False).get_matching_blocks()
        used = [b for b in blocks if b.size]
        if used and used[-1].a + used[-1].size - used[0].a <= step + 2 * NEIGHBOURS:
            best = max(best, sum(b.size for b in used) / step)
        elif used:
            best = max(best, max(b.size for b in used) / step)
        at += max(1, step // 2)
    return best


def _verify(lists: list[list]) -> list[list]:
    labels, scores = [], []
    for text, votes in zip(*lists, strict=True):
        words = words_of(text)
        spans = [(_cover(words, *span), *span) for span in _merged(votes)]
        found: dict[str, float] = {}
        taken: list[tuple[float, int, int]] = []
        for cover, template, first, last in sorted(spans, reverse=True):
            # Of templates that share a place, only the best ones count.
            rival = any(c > cover and first < end + GRAM_WORDS and begin < last + GRAM_WORDS for c, begin, end in taken)
            if cover >= LEAST_COVER and not rival:
                taken.append((cover, first, last))
                label = _TEMPLATE_WORDS[template][0]
                found[label] = max(found.get(label, 0.0), cover)
        labels.append(sorted(found))
        scores.append(max(found.values(), default=0.0))
    return [labels, scores]


def template_labels(docs: DataFrame) -> DataFrame:
    """_key (digest of the text), _found (labels) and _score of the distinct texts that match some template."""
    source = docs.where("text is not null").select("text", F.unhex(F.md5("text")).alias("_key"))
    grams = append_columns(source, ["text"], GRAMS, lambda lists: [[gram_hashes(words_of(text)) for text in lists[0]]])
    # Texts stay behind: only the key travels with a match. Equal texts vote together, and once.
    placed = grams.select("_key", F.posexplode("_grams").alias("position", "gram"))
    matched = placed.join(small(template_positions(docs.sparkSession)), "gram")
    diagonals = (
        matched.withColumn("diagonal", F.col("position") - F.col("place"))
        .groupBy("_key", "template", "diagonal")
        .agg(F.min("position").alias("first"), F.max("position").alias("last"))
    )
    votes = diagonals.groupBy("_key").agg(F.collect_list(F.struct("template", "diagonal", "first", "last")).alias("_votes"))
    found = append_columns(source.join(small(stored(votes, "votes")), "_key"), ["text", "_votes"], FOUND, _verify)
    return found.groupBy("_key").agg(F.first("_found").alias("_found"), F.first("_score").alias("_score"))


def scan(docs: DataFrame) -> DataFrame:
    """Base places and labels of every row of ``docs`` (doc_id, text)."""
    source = docs.select("doc_id", "text").withColumn("_key", F.unhex(F.md5("text")))
    base = append_columns(
        source, ["text"], BASE, lambda lists: list(zip(*map(base_places, lists[0]), strict=True))
    ).drop("text")
    joined = lookup_join(base, template_labels(docs), "_key", "left")
    every = F.array_sort(F.array_union("_base", F.coalesce("_found", F.expr("cast(array() as array<string>)"))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_score", F.lit(0.0))).alias("score"),
    )
