r"""License scans by diagonal voting.

Every run of ``GRAM`` consecutive words of every text is hashed and joined to the
same runs of the license templates; a hit votes for the diagonal (place in the
text minus place in the template).  Votes are counted per document, template and
diagonal; diagonals of one template that lie closer than a fifth of its length
are merged, which lets words be missing or added; a merged span is verified by
the share of template words that its votes cover.  Each vote is verified by a
second, independent hash of its words in the reverse order (96 bits in all).  Where
spans of several templates overlap, one gives its label: that with the largest share,
then the longest and tightest one, then the first in the table.  A phrase whose runs all vote on one
diagonal stands there word for word: these are the base places.

The template table is a parameter; up to ``BROADCAST_RUNS`` runs are broadcast, so
that the join needs no shuffle of the documents and only votes are shuffled.  All steps are DataFrame
functions.

Rows: one result row per row of the documents (repeated rows give equal
results); a null text counts as empty; a null id stays null.  A text of any length is
scanned whole.  An empty table gives an empty result.  Only the id and the text column are
read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.store import stored

GRAM = 3
#: Phrases that must stand word for word, and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# Wordings of common licenses, in the words that ``licenses`` sees, and their labels.
#: Longer wordings that may differ in a few words.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions "
     "of the software", "mit"),
    ("the software is provided as is without warranty of any kind express or implied including but not limited to "
     "the warranties of merchantability fitness for a particular purpose and noninfringement", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is "
     "distributed on an as is basis without warranties or conditions of any kind", "apache-2"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("creative commons attribution noderivatives 4 0 international license", "cc-by-nd"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("creative commons attribution noncommercial sharealike 4 0 international license", "cc-by-nc-sa"),
    ("creative commons attribution noncommercial noderivatives 4 0 international license", "cc-by-nc-nd"),
    ("creative commons cc0 1 0 universal public domain dedication", "cc0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this work is licensed under the gnu general public license version 2", "gpl-2"),
    ("distributed under the terms of the gnu general public license version 3", "gpl-3"),
    ("distributed under the terms of the gnu general public license version 2", "gpl-2"),
    ("under the terms of the gnu general public license as published by the free software foundation either "
     "version 3 of the license or at your option any later version", "gpl-3"),
    ("under the terms of the gnu general public license as published by the free software foundation either "
     "version 2 of the license or at your option any later version", "gpl-2"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("under the terms of the gnu affero general public license", "agpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission", "bsd-3"),
    ("bsd 3 clause license", "bsd-3"),
    ("bsd 2 clause license", "bsd-2"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("distributed under the boost software license version 1 0", "bsl-1"),
    ("spdx license identifier mit", "mit"),
    ("spdx license identifier apache 2 0", "apache-2"),
    ("spdx license identifier bsd 2 clause", "bsd-2"),
    ("spdx license identifier bsd 3 clause", "bsd-3"),
    ("spdx license identifier gpl 2 0", "gpl-2"),
    ("spdx license identifier gpl 3 0", "gpl-3"),
    ("spdx license identifier lgpl 2 1", "lgpl"),
    ("spdx license identifier lgpl 3 0", "lgpl"),
    ("spdx license identifier agpl 3 0", "agpl"),
    ("spdx license identifier mpl 2 0", "mpl-2"),
    ("spdx license identifier isc", "isc"),
    ("spdx license identifier cc0 1 0", "cc0"),
    ("spdx license identifier unlicense", "unlicense"),
    ("spdx license identifier bsl 1 0", "bsl-1"),
)
MIN_SHARE = 0.75
#: Templates of fewer words have none to spare: they must stand in full.
FULL_BELOW = 8
#: Template runs that may be broadcast (some 100 bytes each).
BROADCAST_RUNS = 50_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lowered(text):
    # lower() equals lower-casing A-Z for comparisons with ASCII words, but for the
    # Kelvin sign, the only other character whose lower case is an ASCII letter.
    return F.lower(F.replace(text, F.lit("K"), F.lit("ķ")))


def _words(text):
    return F.filter(F.split(_lowered(text), SEPARATORS), lambda w: w != "")


def _grams(spark, phrases, templates):
    rows = []
    for number, (text, label) in enumerate((*phrases, *templates)):
        words = text.split()
        if len(words) < GRAM:
            raise ValueError(f"a template needs {GRAM} words or more: {text!r}")
        slack = 0 if number < len(phrases) else len(words) // 5
        rows += [(number, label, number < len(phrases), len(words), slack, k, *words[k:k + GRAM])
                 for k in range(len(words) - GRAM + 1)]
    gram = [f"g{k}" for k in range(GRAM)]
    schema = "template int, label string, base boolean, length int, slack int, place int, " \
        + ", ".join(f"{g} string" for g in gram)
    table = spark.createDataFrame(rows, schema) \
        .withColumns({"gram": F.xxhash64(*gram), "proof": F.hash(*gram[::-1])}).drop(*gram)
    # the table's size is known here: broadcast up to a bound, sort and merge beyond it
    return F.broadcast(table) if len(rows) <= BROADCAST_RUNS else table.hint("merge")


def license_spans(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES,
                  templates=TEMPLATES, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per verified span: (id, text_hash, template, label, base, start, share);
    base rows are exact places of a phrase, the others the best templates of a place."""
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .where(F.col("text").isNotNull())
    words = source.select("id", F.xxhash64("text").alias("text_hash"), _words(F.col("text")).alias("words")) \
        .where(F.size("words") >= GRAM)
    def run(i):
        own = [F.get(F.col("words"), i + k) for k in range(GRAM)]
        return F.struct(F.xxhash64(*own).alias("gram"), F.hash(*own[::-1]).alias("proof"))

    # the outer form: the inner one adds filters that compute the whole array again
    runs = words.select("id", "text_hash", F.posexplode_outer(F.transform(
        F.sequence(F.lit(0), F.size("words") - GRAM), run)).alias("at", "run")) \
        .select("id", "text_hash", "at", "run.gram", "run.proof")
    votes = runs.join(_grams(documents.sparkSession, phrases, templates), ["gram", "proof"]) \
        .select("id", "text_hash", "template", "label", "base", "length", "slack", "place", "at")
    keys = ["id", "text_hash", "template", "label", "base", "length", "slack"]
    lines = stored(votes.groupBy(*keys, (F.col("at") - F.col("place")).alias("diagonal"))
                   .agg(F.collect_set("place").alias("places")), "votes")

    base = lines.where(F.col("base") & (F.size("places") == F.col("length") - GRAM + 1)) \
        .select("id", "text_hash", "template", "label", "base", F.col("diagonal").alias("start"), F.lit(1.0).alias("share"))

    # neighbouring diagonals of one template become one span
    order = W.partitionBy("id", "text_hash", "template").orderBy("diagonal")
    fresh = F.when(F.col("diagonal") - F.lag("diagonal").over(order) <= F.col("slack"), 0).otherwise(1)
    spans = lines.where(~F.col("base")).withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(order))
    merged = spans.groupBy(*keys, "span").agg(
        F.min("diagonal").alias("start"), F.max("diagonal").alias("last"),
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        F.col("places"), lambda p: F.sequence(p, p + GRAM - 1)))))
    verified = merged.withColumn("share", covered / F.col("length")) \
        .where((F.col("share") >= min_share) & ((F.col("length") >= FULL_BELOW) | (F.col("share") == 1)))
    # of overlapping spans one: the largest share, then the longest and tightest, then the first template
    merit = F.struct("share", "length", (F.col("start") - F.col("last")).alias("tight"), (-F.col("template")).alias("t"),
                     (-F.col("start")).alias("s"))
    by_start = W.partitionBy("id", "text_hash").orderBy("start", "template", "span")
    before = by_start.rowsBetween(W.unboundedPreceding, -1)
    island = verified.withColumn("end", F.col("last") + F.col("length")) \
        .withColumn("fresh", F.when(F.col("start") < F.max("end").over(before), 0).otherwise(1)) \
        .withColumn("island", F.sum("fresh").over(by_start)) \
        .withColumn("merit", merit).withColumn("best", F.max("merit").over(W.partitionBy("id", "text_hash", "island")))
    close = island.where(F.col("merit") == F.col("best")) \
        .select("id", "text_hash", "template", "label", "base", "start", "share")
    return base.union(close)


def licenses(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES,
             templates=TEMPLATES, min_share: float = MIN_SHARE) -> DataFrame:
    """Per row: ``n_words``; of the base places their number, smallest and largest
    start and labels; ``labels`` with those of the verified spans; ``score``, the
    largest share of a template that the text covers."""
    spans = license_spans(documents, id_col, text_col, phrases, templates, min_share)
    place = F.when(F.col("base"), F.struct("template", "start"))
    labels = F.collect_set(F.when(F.col("base"), F.col("label")))
    found = spans.groupBy(F.col("id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.count_if("base").alias("n_base"), F.min(place["start"]).alias("first_word"),
        F.max(place["start"]).alias("last_word"), F.array_join(F.sort_array(labels), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"),
                            F.regexp_count(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")
                            .alias("n_words"))
    joined = rows.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "left")
    return joined.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
