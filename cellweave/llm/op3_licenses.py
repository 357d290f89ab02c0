"""Operator 3: licence scan with a positional index of rare words, in DataFrame functions only.

Each text becomes the list of its words. The index holds, for each notice below, the places of its
words of highest inverse document frequency. Each index word of a text is looked up; a posting gives
the place where its notice would start in the text, so hits that agree on a start support one
placing. A placing counts if the notice's mandatory phrase stands at its own place in that placing
(not just anywhere in the text) and the index words that stand at theirs have SHARE of the notice's
indexed weight. All of it happens within a row: no shuffle, no join, no cap.

Defined results: a null or empty text has 0 words, no labels, score 0 and null places; each input
row gives one output row (repeated and null ids included); other columns are ignored. ``score`` is
1 where a base phrase stands, else the best placing's share of the weight, else 0; equal shares
are one score. A notice that starts before the text still counts if its phrase and enough of its
index words are there.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, notice, mandatory phrase. Public notices and licence paragraphs in lower case, words only.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied", "unless required by applicable law or agreed to in writing software"),
    ("apache-2.0", "spdx license identifier apache 2 0", "apache 2 0"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "person or organization obtaining a copy of the software and accompanying documentation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "may be used to endorse or promote products derived from this software"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc0-1.0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-2.0", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "free software foundation either version 2 of the license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "free software foundation either version 3 of the license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "this permission notice shall be included in all copies or substantial portions"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "in no event will the authors be held liable for any damages"),
]
#: Rarest words kept of each notice, and the share of a notice's kept weight that a placing needs.
RARE, SHARE = 4, 0.6
#: Placings are packed as notice * 2**33 + start + MARGIN: no notice is longer than MARGIN words.
MARGIN = 1 << 20


def postings() -> list[list[tuple[str, int, float]]]:
    """For each notice (word, place, weight): all places of its RARE words of highest IDF among the notices."""
    df = Counter(w for _, notice, _ in TEMPLATES for w in set(notice.split()))
    out = []
    for _, notice, _ in TEMPLATES:
        words = notice.split()
        idf = {w: math.log(1 + len(TEMPLATES) / df[w]) for w in words if len(w) > 1}
        rare = sorted(idf, key=lambda w: (-idf[w], -len(w), w))[:RARE]
        out.append([(w, at, idf[w]) for at, w in enumerate(words) if w in rare])
    return out


def phrase_places() -> list[int]:
    """Where each notice's mandatory phrase starts in it."""
    return [f" {notice} "[: f" {notice} ".index(f" {phrase} ") + 1].count(" ") - 1 for _, notice, phrase in TEMPLATES]


def _placings(words: Column) -> Column:
    """array<struct<label, share>> of the placings of notices that count in one text's list of words."""
    index, at = postings(), phrase_places()
    by_word: dict[str, list[tuple[int, int]]] = {}
    for t, rows in enumerate(index):
        for w, place, _ in rows:
            by_word.setdefault(w, []).append((t, place))
    lookup = F.create_map(*[x for w, p in by_word.items() for x in (F.lit(w), F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(k).alias("k")) for t, k in p]))])
    notices = F.array(*[
        F.struct(
            F.lit(label).alias("label"), F.lit(at[t]).alias("at"), F.array(*map(F.lit, phrase.split())).alias("phrase"),
            F.array(*[F.struct(F.lit(w).alias("w"), F.lit(k).alias("k"), F.lit(x).alias("x")) for w, k, x in index[t]]).alias("posts"),
            F.lit(sum(x for _, _, x in index[t])).alias("whole"),
        )
        for t, (label, _, phrase) in enumerate(TEMPLATES)
    ])
    none = F.array().cast("array<struct<label:string,share:double>>")

    def found(ws: Column) -> Column:
        hits = F.filter(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: F.get(ws, i).isin(list(by_word)))
        starts = F.flatten(F.transform(hits, lambda i: F.transform(F.element_at(lookup, F.get(ws, i)), lambda p: p["t"] * F.lit(1 << 33) + i - p["k"] + MARGIN)))

        def judged(key: Column) -> Column:
            start = (key.bitwiseAND(F.lit((1 << 33) - 1)) - MARGIN).cast("int")
            t = F.get(notices, F.shiftright(key, 33).cast("int"))
            first = start + t["at"]
            stands = F.when(first >= 0, F.slice(ws, first + 1, F.size(t["phrase"])) == t["phrase"]).otherwise(False)
            weight = F.aggregate(t["posts"], F.lit(0.0), lambda acc, p: acc + F.when(F.get(ws, start + p["k"]) == p["w"], p["x"]).otherwise(0.0))
            return F.struct(t["label"].alias("label"), F.when(stands, weight / t["whole"]).otherwise(0.0).alias("share"))

        return F.filter(F.transform(F.array_distinct(starts), judged), lambda p: p["share"] >= SHARE)

    # The words are bound once for all lambdas; texts without an index word are done at once.
    return F.transform(F.array(words), lambda ws: F.when(F.arrays_overlap(ws, F.array(*map(F.lit, by_word))), found(ws)).otherwise(none))[0]


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Letters are folded by ``lower``: beyond A-Z it maps word characters to word characters only and
    none to an ASCII letter of a base phrase, so words and places are those of folding A-Z.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    flat = F.trim(F.regexp_replace(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    rows = docs.select(F.col(id_col).alias("doc_id"), flat.alias("flat"))
    rows = rows.withColumn("padded", F.concat(F.lit(" "), "flat", F.lit(" ")))
    n_words = F.when(F.col("flat") == "", 0).otherwise(_spaces(F.col("flat")) + 1)
    padded = F.col("padded")
    n, first, last, base = [], [], [], []
    for phrase, label in BASE.items():
        there, size = padded.contains(f" {phrase} "), len(phrase.split())
        n.append(F.when(there, F.regexp_count(padded, F.lit(f" {phrase}(?= )"))).otherwise(0))
        first.append(F.when(there, _spaces(F.substring_index(padded, f" {phrase} ", 1))))
        last.append(F.when(there, n_words - size - _spaces(F.substring_index(padded, f" {phrase} ", -1))))
        base.append(F.when(there, F.lit(label)))
    rows = rows.select(
        "doc_id", n_words.cast("long").alias("n_words"), sum(n[1:], n[0]).cast("long").alias("n_base"),
        F.least(*first).cast("long").alias("first_word"), F.greatest(*last).cast("long").alias("last_word"),
        F.array_compact(F.array(*base)).alias("base"), _placings(F.split("flat", " ")).alias("own"),
    )
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.coalesce(F.array_max("own.share"), F.lit(0.0))))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "own.label")), ",").alias("labels"),
        score.alias("score"),
    )
