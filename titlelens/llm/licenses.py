"""License scan by diagonal voting.

Every two-word window of a text is hashed and joined with the places of the same window in the
license phrases.  A match votes for the diagonal: its place in the text less its place in the
phrase.  A phrase that stands in the text word for word gets all its votes on one diagonal, at
the place where it starts.  Inserted or missing words move votes to neighbouring diagonals, which
are merged to spans; a span counts if enough of the phrase is in it and it is not much longer
than the phrase.

Text windows whose hash no phrase has are left out inside the row; those found are joined and
compared as text.

Edge cases: a null text has no words; no matches give empty labels, null places and score 0;
phrases that overlap or repeat count at each place; each row of a repeated document gets its own
result; an empty table gives no rows.  Further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titlelens.llm.common import gram_hash, grams, words

# Fixed values: (label, phrase) that are counted word for word.
BASE = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"),
        ("mit", "mit license"))
# Usual license lines and the texts of licenses, found also with a few words more or less.
OWN = (("all-rights-reserved", "all rights reserved"),
       ("apache-2.0", "licensed under the apache license version 2 0"),
       ("bsd", "redistribution and use in source and binary forms with or without modification "
               "are permitted"),
       ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
       ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
       ("gpl-3.0", "licensed under the gnu general public license version 3"),
       ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy"),
       ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of "
                    "this software and associated documentation files the software to deal in the "
                    "software without restriction including without limitation the rights to use "
                    "copy modify merge publish distribute sublicense and or sell copies of the "
                    "software and to permit persons to whom the software is furnished to do so "
                    "subject to the following conditions the above copyright notice and this "
                    "permission notice shall be included in all copies or substantial portions of "
                    "the software"),
       ("bsd-2-text", "redistribution and use in source and binary forms with or without "
                      "modification are permitted provided that the following conditions are met "
                      "redistributions of source code must retain the above copyright notice this "
                      "list of conditions and the following disclaimer redistributions in binary "
                      "form must reproduce the above copyright notice this list of conditions and "
                      "the following disclaimer in the documentation and or other materials "
                      "provided with the distribution"),
       ("apache-2.0-notice", "licensed under the apache license version 2 0 the license you may "
                             "not use this file except in compliance with the license you may "
                             "obtain a copy of the license at"),
       ("gpl-notice", "this program is free software you can redistribute it and or modify it "
                      "under the terms of the gnu general public license as published by the free "
                      "software foundation either version 3 of the license or at your option any "
                      "later version"),
       ("as-is", "the software is provided as is without warranty of any kind express or implied "
                 "including but not limited to the warranties of merchantability fitness for a "
                 "particular purpose and noninfringement"))
GRAM = 2
SHIFT = 2
LEAST_COVER = 0.75


def phrase_places(spark: SparkSession, base=BASE, own=OWN) -> DataFrame:
    """(label, exact, length, gram, place): every window of every phrase."""
    rows = [(label, exact, len(ws), " ".join(ws[i:i + GRAM]), i)
            for exact, phrases in ((True, base), (False, own)) for label, phrase in phrases
            for ws in [phrase.split()] for i in range(len(ws) - GRAM + 1)]
    return spark.createDataFrame(
        rows, "label string, exact boolean, length int, known string, place int")


def scan(docs: DataFrame, base=BASE, own=OWN) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    places = phrase_places(spark, base, own)
    # As many as the phrases have words.
    hashes = [r[0] for r in places.select(gram_hash(
        F.split("known", " "), F.lit(0), GRAM)).distinct().collect()]
    rows = (docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                        words(F.col("text")).alias("w"))
            .select("doc_id", "text_key", F.size("w").cast("bigint").alias("n_words"),
                    grams(F.col("w"), GRAM, hashes).alias("found"))
            # Rows alike are put together in each task; from here on all is by text, so this one
            # shuffle is enough.
            .groupBy("doc_id", "text_key")
            .agg(F.max("n_words").alias("n_words"), F.first("found").alias("found"),
                 F.count("*").cast("int").alias("rows")))
    marker = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(0).alias("n"),
                              F.lit(None).cast("string").alias("gram")))
    spread = rows.select("doc_id", "text_key", "n_words", "rows",
                         F.explode(F.concat(marker, "found")).alias("g")).select(
        "doc_id", "text_key", "n_words", "rows", "g.pos", "g.gram")
    votes = spread.join(F.broadcast(places), F.col("gram") == F.col("known"), "left")
    diagonals = (votes.withColumn("diagonal", F.col("pos") - F.col("place"))
                 .groupBy("doc_id", "text_key", "label", "exact", "length", "diagonal")
                 .agg(F.max("n_words").alias("n_words"), F.collect_set("place").alias("voted"),
                      F.min("pos").alias("first"), F.max("pos").alias("last"),
                      F.max("rows").alias("rows")))
    line = Window.partitionBy("doc_id", "text_key", "label", "exact").orderBy("diagonal")
    near = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(line) > SHIFT).cast("int"),
                      F.lit(0))
    spans = (diagonals.withColumn("new", near)
             .withColumn("span", F.sum("new").over(line))
             .groupBy("doc_id", "text_key", "label", "exact", "length", "span")
             .agg(F.max("n_words").alias("n_words"), F.max("rows").alias("rows"),
                  F.collect_list(F.when(F.size("voted") == F.col("length") - GRAM + 1,
                                        F.col("diagonal"))).alias("starts"),
                  F.size(F.array_distinct(F.flatten(F.collect_list("voted")))).alias("voted"),
                  (F.max("last") + GRAM - F.min("first")).alias("width")))
    # Of a span that is too wide, a single diagonal with all votes is left.
    cover = F.when(F.size("starts") > 0, 1.0).when(
        F.col("width") <= F.col("length") + 2 * SHIFT,
        F.col("voted") / (F.col("length") - GRAM + 1)).otherwise(0.0)
    judged = spans.withColumn("cover", F.when(F.col("label").isNotNull(), cover))
    starts = F.when(F.col("exact"), F.col("starts"))
    is_found = F.when(F.col("exact"), F.size("starts") > 0).otherwise(
        F.col("cover") >= LEAST_COVER)
    return (judged.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.max("rows").alias("rows"),
        F.coalesce(F.sum(F.size(starts)), F.lit(0)).cast("bigint").alias("n_base"),
        F.min(F.array_min(starts)).cast("bigint").alias("first_word"),
        F.max(F.array_max(starts)).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(
            F.col("exact") & is_found, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(is_found, F.col("label")))), ",")
        .alias("labels"),
        F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"))
        .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                "score", F.explode(F.array_repeat(F.lit(0), F.col("rows"))).alias("copy"))
        .drop("copy"))
