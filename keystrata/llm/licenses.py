"""Licence scans by a positional index of rare words, in DataFrame operations only.

Every file's words that occur in any licence template are kept with their positions. Joined with the templates'
postings, each gives the place where the template would start; hits that agree on it are counted by one
aggregation. A place counts when one of the template's rarest words, by document frequency over all files, and
every word of its key phrase stand where they should.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keystrata.session import written

#: Phrases whose places are counted, with their labels (fixed values).
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]

#: Longer wordings: label, words, and the key phrase among them without which they do not count (fixed values).
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl-3", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license version 2 0", "mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]

_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _find(words: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def postings(phrases=PHRASES, templates=TEMPLATES) -> list[tuple]:
    """(template, label, base, words, key words, word, offset, key) for every word of every template."""
    out = []
    for n, (label, text, key) in enumerate([(a, b, b) for a, b in phrases] + list(templates)):
        words, need = text.split(), key.split()
        at = _find(words, need)
        out += [(n, label, n < len(phrases), len(words), len(need), w, i, at <= i < at + len(need)) for i, w in enumerate(words)]
    return out


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    phrases=PHRASES,
    templates=TEMPLATES,
    rarest: int = 3,
    coverage: float = 0.7,
) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    Words are runs of digits, letters a-z after lower-casing A-Z, and signs beyond ASCII. ``n_base`` counts the places
    where all words of a phrase stand one after the other; first and last are the smallest and largest of them,
    counted in words from 0, NULL without any. ``labels`` adds templates whose key phrase stands there and whose words
    found in place weigh at least ``coverage`` of the template, weighed by inverse document frequency. ``score``
    is the largest such share among places that have the key phrase and a rare word, 0 without any. A NULL text
    counts as empty; ids may be NULL or repeat, each row gets its own result. Other columns are not read, whatever
    their names. Phrases have two words or more.
    """
    entries = postings(phrases, templates)
    vocabulary = sorted({e[5] for e in entries})
    lowered = F.translate(F.coalesce(F.col(text_column), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    split = docs.select(F.col(id_column).alias("id"), F.filter(F.split(lowered, _BETWEEN), lambda w: w != "").alias("words"))
    tagged = F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(i.alias("p"), w.alias("w"))))
    found = split.select("id", F.size("words").cast("long").alias("n_words"), F.filter(tagged, lambda h: h.isNotNull()).alias("hits"))
    # All words of a phrase are in the vocabulary, so a hit without one beside it belongs to no phrase.
    beside = lambda h, i: (F.get("hits", i + 1)["p"] == h["p"] + 1) | ((i > 0) & (F.get("hits", F.greatest(i - 1, F.lit(0)))["p"] == h["p"] - 1))
    indexed = written(
        found.select(F.monotonically_increasing_id().alias("row"), "id", "n_words", F.filter("hits", lambda h, i: F.coalesce(beside(h, i), F.lit(False))).alias("hits")),
        "licence-index",
    )
    spark = docs.sparkSession
    total = indexed.count()
    frequency = indexed.select(F.explode(F.array_distinct("hits.w")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    given = spark.createDataFrame(entries, "t int, label string, base boolean, n int, n_key int, word string, offset int, key boolean")
    weighed = given.join(frequency, "word", "left").withColumn("idf", F.log((F.lit(float(total)) + 2) / (F.coalesce("df", F.lit(0)) + 1)))
    rank = F.row_number().over(Window.partitionBy("t").orderBy(F.col("idf").desc(), "offset"))
    whole = F.sum("idf").over(Window.partitionBy("t"))
    # As many rows as the templates have words.
    index = F.broadcast(weighed.select("*", (rank <= rarest).cast("int").alias("rare"), whole.alias("whole")).drop("df"))

    places = (
        indexed.select("row", F.explode("hits").alias("h"))
        .select("row", F.col("h.p").alias("p"), F.col("h.w").alias("word"))
        .join(index, "word")
        .groupBy("row", "t", (F.col("p") - F.col("offset")).alias("place"))
        .agg(
            F.first("label").alias("label"),
            F.first("base").alias("base"),
            F.sum("rare").alias("rare"),
            (F.sum(F.col("key").cast("int")) == F.first("n_key")).alias("key"),
            F.least(F.lit(1.0), F.sum("idf") / F.first("whole")).alias("share"),
        )
        .filter("key and (base or rare > 0)")
    )
    share = F.when(F.col("base"), 1.0).otherwise(F.col("share"))
    named = F.when(F.col("base") | (F.col("share") >= coverage), F.col("label"))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    by_row = places.groupBy("row").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("place"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("place"))).cast("long").alias("last_word"),
        listed(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        listed(named).alias("labels"),
        F.max(share).alias("score"),
    )
    return indexed.select("row", "id", "n_words").join(by_row, "row", "left").select(
        F.col("id").alias(id_column),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
