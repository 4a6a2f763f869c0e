"""License scan over a positional rare-token index (DataFrame functions only).

The licence words that occur in the corpus are counted once over all documents. Each phrase is
looked up by its rarest word (the one with the highest IDF): its places in a document, less its
place in the phrase, are the candidate starts; the other words' places must agree with them.
Around every verified phrase the templates that hold it are laid over the document at the same
relative position and the share of words that agree is their score.

Results for special rows: a null or empty text has no words, no places, no labels and score 0;
repeated rows and repeated ids each give a row; a null id is kept; columns other than ``doc_id``
and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm.common import land, table

# Fixed values of the contract: the base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Templates of the method itself: label -> (words of the notice, its mandatory key phrases).
#: A template counts where all its key phrases stand at their relative positions; its score is the
#: share of all its words that do. The first key phrase is the one that is looked up.
TEMPLATES = {
    "mit-notice": ("released under the mit license", ["under the mit license"]),
    "apache-2.0": ("licensed under the apache license version 2 0", ["apache license version 2 0"]),
    "gpl-3.0": (
        "this work is licensed under the gnu general public license version 3",
        ["gnu general public license", "version 3"],
    ),
    "gpl-2.0": (
        "this work is licensed under the gnu general public license version 2",
        ["gnu general public license", "version 2"],
    ),
    "lgpl": ("licensed under the gnu lesser general public license", ["lesser general public license"]),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    "cc-by-4.0": ("licensed under cc by 4 0", ["cc by 4 0"]),
    "mpl-2.0": ("subject to the terms of the mozilla public license version 2 0", ["mozilla public license"]),
    "bsd-3-clause": ("licensed under the bsd 3 clause license", ["bsd 3 clause"]),
}

# Wording of the licences themselves (their texts, or the notice that they ask for in
# every file), as words of the contract, in their order; then the key phrases that must stand there.
TEXTS = {
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"
        " files the software to deal in the software without restriction including without limitation the rights to use copy modify"
        " merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is"
        " furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be"
        " included in all copies or substantial portions of the software the software is provided as is without warranty of any kind"
        " express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and"
        " noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability"
        " whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or"
        " other dealings in the software",
        ["modify merge publish distribute sublicense", "permission is hereby granted free of charge"],
    ),
    "isc-text": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided"
        " that the above copyright notice and this permission notice appear in all copies the software is provided as is and the"
        " author disclaims all warranties with regard to this software including all implied warranties of merchantability and"
        " fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages"
        " whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action"
        " arising out of or in connection with the use or performance of this software",
        ["with or without fee is hereby granted", "this permission notice appear in all copies"],
    ),
    "bsd-2-clause-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
        " conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the"
        " following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and"
        " the following disclaimer in the documentation and or other materials provided with the distribution",
        ["redistribution and use in source and binary forms", "redistributions in binary form must reproduce"],
    ),
    "bsd-3-clause-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
        " conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the"
        " following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and"
        " the following disclaimer in the documentation and or other materials provided with the distribution 3 neither the name of"
        " the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this"
        " software without specific prior written permission",
        ["used to endorse or promote products derived", "redistribution and use in source and binary forms"],
    ),
    "apache-2.0-notice": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you"
        " may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to"
        " in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any"
        " kind either express or implied see the license for the specific language governing permissions and limitations under the"
        " license",
        ["except in compliance with the license", "apache license version 2 0"],
    ),
    "gpl-3.0-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as"
        " published by the free software foundation either version 3 of the license or at your option any later version this program"
        " is distributed in the hope that it will be useful but without any warranty without even the implied warranty of"
        " merchantability or fitness for a particular purpose see the gnu general public license for more details",
        ["gnu general public license as published by the free software foundation", "either version 3 of the license"],
    ),
    "gpl-2.0-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as"
        " published by the free software foundation either version 2 of the license or at your option any later version this program"
        " is distributed in the hope that it will be useful but without any warranty without even the implied warranty of"
        " merchantability or fitness for a particular purpose see the gnu general public license for more details",
        ["gnu general public license as published by the free software foundation", "either version 2 of the license"],
    ),
    "mpl-2.0-notice": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed"
        " with this file you can obtain one at http mozilla org mpl 2 0",
        ["terms of the mozilla public license v 2 0"],
    ),
    "zlib-text": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any"
        " damages arising from the use of this software permission is granted to anyone to use this software for any purpose"
        " including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
        ["to alter it and redistribute it freely", "permission is granted to anyone to use this software"],
    ),
    "unlicense-text": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell"
        " or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial"
        " and by any means",
        ["free and unencumbered software released into the public domain"],
    ),
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _find(words: list[str], part: list[str]) -> int:
    return next(i for i in range(len(words) - len(part) + 1) if words[i : i + len(part)] == part)


def _entries() -> list[tuple]:
    """One entry for each base phrase and template: the key phrase looked up, and what it proves."""
    out = [("base", label, p.split(), 0, p.split(), [p.split()]) for p, label in BASE_PHRASES.items()]
    for label, (notice, keys) in (TEMPLATES | TEXTS).items():
        words = notice.split()
        first = keys[0].split()
        out.append(("method", label, first, _find(words, first), words, [k.split() for k in keys]))
    return out


def licence_words() -> list[str]:
    return sorted({w for entry in _entries() for w in entry[2]})


def words_of(text):
    """Words of the contract: ASCII lower-casing only, then runs outside the ASCII non-letters."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))


def _strings(words: list[str]):
    return F.array(*[F.lit(w) for w in words])


def tokenized(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_words, and the words of the rows that hold at least one licence word."""
    words = docs.select(F.col("doc_id"), words_of(F.col("text")).alias("words"))
    hit = F.arrays_overlap(F.col("words"), _strings(licence_words()))
    return words.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.when(hit, F.col("words")).alias("words"),
    )


def rarity(tokens: DataFrame) -> dict[str, int]:
    """Documents that hold each licence word, over the whole corpus: one row per licence word."""
    found = tokens.filter("words IS NOT NULL").select(
        F.explode(F.array_intersect("words", _strings(licence_words()))).alias("word")
    )
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: counts.get(w, 0) for w in licence_words()}


def find_places(tokens: DataFrame, document_frequency: dict[str, int]) -> DataFrame:
    """row, kind, label, start, share: every verified place of a phrase or template.

    ``start`` is the first word of the key phrase; ``share`` the part of the entry's words that
    agree at their relative positions.
    """
    spark = tokens.sparkSession
    postings = []
    for kind, label, phrase, offset, words, keys in _entries():
        rare = min(phrase, key=lambda w: (document_frequency[w], w))
        for place in [j for j, w in enumerate(phrase) if w == rare][:1]:
            must = [(_find(words, k) - offset, k) for k in keys]
            postings.append((rare, place, kind, label, offset, words, [m[0] for m in must], [m[1] for m in must]))
    index = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(word).alias("word"),
                        F.lit(place).alias("place"),
                        F.lit(kind).alias("kind"),
                        F.lit(label).alias("label"),
                        F.lit(offset).alias("offset"),
                        _strings(template).alias("template"),
                        F.array(*[F.lit(o) for o in key_offsets]).alias("key_offsets"),
                        F.array(*[_strings(k) for k in key_words]).alias("key_words"),
                    )
                    for word, place, kind, label, offset, template, key_offsets, key_words in postings
                ]
            )
        )
    )
    rare_words = sorted({p[0] for p in postings})
    held = tokens.filter("words IS NOT NULL").select("row", "words", F.posexplode("words").alias("pos", "word"))
    # the index has one row per phrase of this module, a fixed number
    hits = held.filter(F.col("word").isin(rare_words)).join(F.broadcast(index), "word")
    hits = hits.withColumn("start", F.col("pos") - F.col("place")).filter("start >= 0")
    mandatory = F.expr(
        "forall(arrays_zip(key_offsets, key_words), k -> start + k.key_offsets >= 0 AND "
        "slice(words, greatest(start + k.key_offsets, 0) + 1, size(k.key_words)) = k.key_words)"
    )
    agree = F.expr(
        "size(filter(sequence(0, size(template) - 1), i -> coalesce(get(words, start - offset + i) = template[i], false)))"
    )
    return hits.filter(mandatory).select(
        "row", "kind", "label", F.col("start").cast("long").alias("start"), (agree / F.size("template")).alias("share")
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row."""
    tokens = land(tokenized(docs), "licences")
    places = find_places(tokens, rarity(tokens))
    base = F.col("kind") == "base"
    found = places.groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.when(base, F.col("label"))))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set("label"))).alias("labels"),
        F.max(F.when(~base, F.col("share")).otherwise(0.5)).alias("score"),
    )
    return (
        tokens.select("row", "doc_id", "n_words")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
            "first_word",
            "last_word",
            F.coalesce("base_labels", F.lit("")).alias("base_labels"),
            F.coalesce("labels", F.lit("")).alias("labels"),
            F.round(F.coalesce("score", F.lit(0.0)), 9).alias("score"),
        )
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and notices in every whole text of ``documents``."""
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    entries = []
    for kind, label, phrase, offset, words, keys in _entries():
        quote = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
        must = " AND ".join(
            f"s + {_find(words, k) - offset} >= 0 AND words[s + {_find(words, k) - offset} + 1 : s + {_find(words, k) - offset + len(k)}] = {quote(k)}"
            for k in keys
        )
        share = " + ".join(
            f"CASE WHEN s - {offset} + {i} >= 0 AND words[s - {offset} + {i + 1}] = '{w}' THEN 1 ELSE 0 END" for i, w in enumerate(words)
        )
        entries.append(
            f"SELECT r, '{kind}' AS kind, '{label}' AS label, s, ({share}) / {len(words)}.0 AS share FROM places "
            f"WHERE words[s + 1] = '{phrase[0]}' AND {must}"
        )
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
  FROM documents),
w AS (SELECT r, words, unnest(range(len(words))) AS s FROM d),
places AS (SELECT r, words, s FROM w WHERE words[s + 1] IN ({", ".join(repr(x) for x in sorted({e[2][0] for e in _entries()}))})),
found AS ({" UNION ALL ".join(entries)}),
g AS (
  SELECT r, count(*) FILTER (kind = 'base') AS n_base, min(s) FILTER (kind = 'base') AS first_word,
         max(s) FILTER (kind = 'base') AS last_word,
         array_to_string(list_sort(list_distinct(list(label) FILTER (kind = 'base'))), ',') AS base_labels,
         array_to_string(list_sort(list_distinct(list(label))), ',') AS labels,
         max(CASE WHEN kind = 'base' THEN 0.5 ELSE share END) AS score
  FROM found GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(round(coalesce(score, 0), 9) AS DOUBLE) AS score
FROM d LEFT JOIN g USING (r)"""


QUERIES = {"op9_license_scan": op9_license_scan}
ORACLE_SQL = {"op9_license_scan": _sql()}
