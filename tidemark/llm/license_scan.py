"""License scans by diagonal voting.

Templates are license notices as word sequences. Every word k-gram of a text is hashed and joined to
the template positions with the same hash; the words themselves then confirm the hit. A hit votes for
a diagonal, text position minus template position. Votes are summed by diagonal, diagonals within a
few words of each other are merged (a notice with inserted or missing words), and a merged span is
reported if enough of the template stands in it, with a gram that no other license's notice has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NOT_ALNUM, text_key

#: Phrases that count wherever they stand, with their labels. Fixed values.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Notices and opening paragraphs of public licenses, with labels of our own. Wordings are fixed values.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2.0"),
    (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an"
        " as is basis without warranties or conditions of any kind either express or implied see the license for the specific"
        " language governing permissions and limitations under the license",
        "apache-2.0",
    ),
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation the rights"
        " to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to"
        " whom the software is furnished to do so subject to the following conditions",
        "mit",
    ),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction",
        "mit",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the"
        " following conditions are met",
        "bsd",
    ),
    (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
        " disclaimer in the documentation and or other materials provided with the distribution",
        "bsd-2-clause",
    ),
    (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
        " derived from this software without specific prior written permission",
        "bsd-3-clause",
    ),
    (
        "all advertising materials mentioning features or use of this software must display the following acknowledgement",
        "bsd-4-clause",
    ),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
        " license as published by the free software foundation",
        "gpl-notice",
    ),
    ("either version 2 of the license or at your option any later version", "gpl-2.0-or-later"),
    ("either version 3 of the license or at your option any later version", "gpl-3.0-or-later"),
    ("gnu general public license version 2", "gpl-2.0"),
    ("gnu general public license version 3", "gpl-3.0"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("gnu lesser general public license version 2 1", "lgpl-2.1"),
    ("gnu lesser general public license version 3", "lgpl-3.0"),
    ("gnu affero general public license", "agpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("made available under the terms of the eclipse public license", "epl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("boost software license version 1 0", "bsl-1.0"),
    (
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable"
        " for any damages arising from the use of this software",
        "zlib",
    ),
    ("this work is licensed under a creative commons attribution", "cc-attribution"),
    ("creative commons attribution 4 0 international", "cc-by-4.0"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution noderivatives", "cc-by-nd"),
    ("dedicated to the public domain under cc0", "cc0"),
    ("the software is provided as is without warranty of any kind express or implied", "no-warranty"),
    ("spdx license identifier", "spdx"),
)


#: A notice of fewer words than this stands only if nearly all of it does: one of its words is its license's name.
SHORT, SHORT_COVERAGE = 10, 0.8


def template_grams(spark: SparkSession, k: int, notices=NOTICES, base=BASE) -> DataFrame:
    """(template, label, is_base, len, tpos, k, gram, own): the k-grams of the templates; shorter templates are one gram.

    own: no template of another label has the gram.
    """
    rows, labels = [], {}
    for t, (phrase, label) in enumerate([*base, *notices]):
        words = phrase.split()
        size = min(k, len(words))
        for i in range(len(words) - size + 1):
            gram = " ".join(words[i : i + size])
            rows.append((t, label, t < len(base), len(words), i, size, gram))
            labels.setdefault(gram, set()).add(label)
    quoted = ", ".join(f"({t}, '{a}', {b}, {n}, {i}, {s}, '{g}', {len(labels[g]) == 1})" for t, a, b, n, i, s, g in rows)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t(template, label, is_base, len, tpos, k, gram, own)")


def license_spans(
    docs: DataFrame, k: int = 3, slip: int = 3, least: float = 0.6, id_col: str = "doc_id", text_col: str = "text", notices=NOTICES, base=BASE
) -> DataFrame:
    """(doc_id, h, template, label, is_base, first, last, coverage, places) of every verified span.

    h is the text's key; rows alike in id and text give one set of spans. first and last are words from
    0, coverage is the share of the template's words found, places the starts of complete, unbroken
    occurrences. Spans below `least` (SHORT_COVERAGE for short notices) and those of grams that other
    licenses' notices share, unless the whole notice stands, are dropped, and base phrases count complete only. slip: how far neighbouring
    diagonals may lie apart.
    """
    grams = template_grams(docs.sparkSession, k, notices, base)
    sizes = sorted({min(k, len(p.split())) for p, _ in (*base, *notices)})
    words = F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), NOT_ALNUM)
    d = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("h"), words.alias("w"))
    d = d.select("doc_id", "h", "w", F.when(F.col("w")[0] == "", 1).otherwise(0).alias("lead"), F.posexplode("w").alias("p", "word"))
    nth = lambda i: F.get("w", F.col("p") + i)
    # A gram past the text's end has nulls, which a hash skips; its words then fail the comparison.
    hashes = F.array(*[F.xxhash64(F.lit(s), *[nth(i) for i in range(s)]) for s in sizes])
    d = d.select("doc_id", "h", "w", "lead", "p", F.explode(hashes).alias("hash"))
    table = grams.select("*", F.split("gram", " ").alias("tw"))
    by_size = F.coalesce(*[F.when(F.col("k") == s, F.xxhash64(F.lit(s), *[F.get("tw", F.lit(i)) for i in range(s)])) for s in sizes])
    table = F.broadcast(table.select("template", "label", "is_base", "len", "tpos", "k", "gram", "own", by_size.alias("thash")))
    same = F.concat_ws(" ", F.slice("w", F.col("p") + 1, F.col("k"))) == F.col("gram")
    hits = d.join(table, (F.col("hash") == F.col("thash")) & same).select(
        "doc_id", "h", "template", "label", "is_base", "len", "tpos", "k", "own", (F.col("p") - F.col("lead")).alias("pos")
    )
    votes = (
        hits.groupBy("doc_id", "h", "template", "label", "is_base", "len", "k", (F.col("pos") - F.col("tpos")).alias("diagonal"))
        .agg(F.collect_set("tpos").alias("at"), F.max("own").alias("own"))
        .withColumn("complete", F.size("at") == F.col("len") - F.col("k") + 1)
    )
    one = Window.partitionBy("doc_id", "h", "template").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(one) > slip).cast("int"), F.lit(1))
    votes = votes.withColumn("new", new).withColumn("span", F.sum("new").over(one))
    merged = votes.groupBy("doc_id", "h", "template", "label", "is_base", "len", "k", "span").agg(
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
        F.max("own").alias("own"),
        F.min(F.col("diagonal") + F.array_min("at")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("at") + F.col("k") - 1).alias("last"),
        F.array_sort(F.collect_list(F.when(F.col("complete"), F.col("diagonal")))).alias("places"),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda t: F.sequence(t, t + F.col("k") - 1)))))
    merged = merged.withColumn("coverage", covered / F.col("len"))
    enough = F.col("coverage") >= F.when(F.col("len") < SHORT, max(least, SHORT_COVERAGE)).otherwise(least)
    whole = (F.size("places") > 0) | (~F.col("is_base") & F.col("own"))
    return merged.where(enough & whole).drop("at", "span", "k", "len", "own")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of docs.

    n_base counts the places where a base phrase stands, first_word and last_word are their least and
    greatest start; labels are distinct, sorted and comma-joined; score is the greatest coverage, 0
    where nothing is found. A null or empty text has no words. Null ids are allowed, and repeated rows
    get the same result. Other columns are not read. Words are split on the text lower-cased as a
    whole, which neither moves a bound between words nor turns another letter into one of a phrase.
    An empty table gives an empty one.
    """
    spans = license_spans(docs, id_col=id_col, text_col=text_col, **options)
    starts = F.flatten(F.collect_list(F.when(F.col("is_base"), F.col("places"))))
    found = spans.groupBy("doc_id", "h").agg(
        starts.alias("starts"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("is_base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("coverage").alias("score"),
    )
    found = found.withColumnsRenamed({"doc_id": "of", "h": "oh"})
    words = F.split(F.coalesce(F.col(text_col), F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("h"), words.alias("w"))
    edge = lambda at: F.when(F.element_at("w", at) == "", 1).otherwise(0)
    rows = rows.select("doc_id", "h", F.greatest(F.size("w") - edge(1) - edge(-1), F.lit(0)).cast("long").alias("n_words"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("oh")), "left").select(
        "doc_id",
        "n_words",
        F.when(F.col("starts").isNull(), 0).otherwise(F.size("starts")).cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
