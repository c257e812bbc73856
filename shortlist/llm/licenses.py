"""Licence notices by sentences, wrapped or not: known ones become identifiers, rules are runs of identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shortlist.session import durable

# fixed: identifiers of sentences that occur in public licence texts and notices
SENTENCES = {
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-terms": "This project is licensed under the terms of the MIT license.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights"
    " to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to"
    " whom the Software is furnished to do so, subject to the following conditions:",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of"
    " the Software.",
    "apache-2-licensed": "Licensed under the Apache License, Version 2.0.",
    "apache-2-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-2-comply": "you may not use this file except in compliance with the License.",
    "apache-2-copy": "You may obtain a copy of the License at",
    "gpl-3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
    " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "bsd-redistribute": "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
    " that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
    " disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the"
    " following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission.",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc0-1": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}

# fixed: ordered rules; a rule holds where its identifiers follow one another with no other known one between
RULES = [
    ("Apache-2.0", ["apache-2-licensed"]),
    ("Apache-2.0", ["apache-2-header", "apache-2-comply", "apache-2-copy"]),
    ("BSD-3-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribute", "bsd-source", "bsd-binary"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC0-1.0", ["cc0-1"]),
    ("GPL-3.0-only", ["gpl-3-work"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-terms"]),
    ("MIT", ["mit-grant", "mit-keep"]),
    ("MPL-2.0", ["mpl-2"]),
    ("Proprietary", ["reserved"]),
    ("Unlicense", ["unlicense"]),
]


# marks in a text's normal form: the end of a line, of a sentence, and of a paragraph
_LINE, _SENTENCE, _BLOCK = "\n", "\u0001", "\u0002"


def marked(text: Column) -> Column:
    """The normal form of a whole text: words of a-z and 0-9, and between them blanks and marks.

    A sentence ends after . ! ? ; : followed by white space, a paragraph at a line without words.
    Whatever stands before the first word of a line, such as a comment mark, goes.
    """
    out = F.lower(F.concat(F.lit("\n"), text, F.lit("\n")))
    out = F.regexp_replace(out, r"\n[^a-z0-9\n]*+\n[^a-z0-9]*+", _BLOCK)
    out = F.regexp_replace(out, r"\n[^a-z0-9\n]*+(?:(?:rem|dnl)[ \t]++)?", _LINE)
    out = F.regexp_replace(out, r"[.!?;:][ \t\r\n][^a-z0-9\x02]*+", _SENTENCE)
    return F.regexp_replace(out, r"[^a-z0-9\n\x01\x02]++", " ")


def _single(form: Column) -> Column:
    """``form`` with one character between two words: the strongest mark, or else a blank."""
    return F.regexp_replace(F.regexp_replace(form, r"[ \n\x01]+(?=[\x01\x02])", ""), r" \n", _LINE)


def _first_word(form: Column) -> Column:
    return F.regexp_extract(form, "^[a-z0-9]+", 0)


def known_sentences(spark: SparkSession, sentences: dict[str, str] = SENTENCES) -> DataFrame:
    """sentence_id, its normal form with blanks for line ends, and its first word."""
    rows = spark.createDataFrame([(k, v) for k, v in sentences.items()], "sentence_id string, sentence string")
    form = F.translate(_single(marked(F.col("sentence"))), _LINE, " ")
    trimmed = rows.select("sentence_id", F.regexp_replace(form, r"^[ \x01\x02]+|[ \x01\x02]+$", "").alias("normal"))
    return trimmed.where("normal <> ''").withColumn("word", _first_word(F.col("normal")))


def license_scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules: list = RULES) -> DataFrame:
    """doc_id, n_sentences (known ones), sentence_ids (in order), licenses (names, sorted, by comma).

    A known sentence is found where its words follow one another, from the start of a line or
    sentence to the end of one. Line ends and comment marks within it count as blanks, so wrapped
    texts are read like others; a line without words ends every sentence. Where it has ends of
    sentences itself, the text must have them too. What lies within a longer known sentence is not
    found. The sequence of identifiers is searched for each rule's sequence. A rule that is the start
    of another one which holds for the same sentences is not reported, so the longer rule wins. Null and empty texts
    have no sentences. Rows with equal doc_id and text are one document and get a row each. Other
    columns are not read.

    The table of known sentences is a constant of this module or an argument, so it is broadcast.
    Only pieces that begin with the first word of a known sentence become rows, each with as many
    of the next pieces as the longest known sentence can span.
    """
    spark = docs.sparkSession
    table = known_sentences(spark, sentences)
    most = table.agg(F.max(F.length("normal")), F.max(F.size(F.split("normal", r"[ \x01]"))), F.collect_set("word")).first()
    longest, pieces, words = most[0] or 0, most[1] or 1, most[2]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("_key", F.struct("doc_id", F.xxhash64("text")))
    cut = keyed.select("_key", F.split(marked(F.col("text")), r"(?<=[\n\x01\x02])").alias("pieces"))

    def start(piece: Column, at: Column) -> Column:
        rest = F.substring(F.array_join(F.slice("pieces", at + 1, pieces), ""), 1, longest + pieces + 1)
        return F.when(_first_word(piece).isin(words), F.struct(at.alias("at"), rest.alias("rest")))

    starts = cut.select("_key", F.explode(F.array_compact(F.transform("pieces", start))).alias("s"))
    one = starts.select("_key", "s.at", _single(F.col("s.rest")).alias("rest")).withColumn("word", _first_word(F.col("rest")))
    head = F.substring("rest", F.lit(1), F.length("normal") + 1)
    ends = F.substring("rest", F.length("normal") + 1, F.lit(1)).isin("", _LINE, _SENTENCE, _BLOCK)
    same = F.startswith(F.translate("rest", _LINE, " "), F.col("normal"))
    found = (
        one.join(F.broadcast(table), "word").where(same & ends)
        .select("_key", "at", (F.col("at") + F.greatest(F.length(F.regexp_replace(head, r"[^\n\x01\x02]", "")), F.lit(1))).alias("stop"), "sentence_id")
        .groupBy("_key", "at", "stop").agg(F.collect_set("sentence_id").alias("ids"))
    )
    before = Window.partitionBy("_key").orderBy("at", F.desc("stop")).rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("reached", F.max("stop").over(before)).where("reached is null or stop > reached")
    found = found.select("_key", "at", F.explode("ids").alias("sentence_id"))
    ordered = durable(
        found.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("at", "sentence_id"))).alias("hits"))
        .select(F.col("_key").alias("_found"), F.transform("hits", lambda h: h["sentence_id"]).alias("sentence_ids"))
    )
    line = F.concat(F.lit(" "), F.array_join("sentence_ids", " "), F.lit(" "))
    # longer rules take their sentences first
    names = []
    for name, ids in sorted(rules, key=lambda r: (-len(r[1]), r[0], r[1])):
        run = f" {' '.join(ids)} "
        names.append(F.when(F.contains(line, F.lit(run)), F.lit(name)))
        line = F.replace(line, F.lit(run), F.lit(" | "))
    licenses = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))), ",")
    matched = ordered.withColumn("licenses", licenses)
    return keyed.select("_key", "doc_id").join(matched, F.col("_key") == F.col("_found"), "left").select(
        "doc_id", F.coalesce(F.size("sentence_ids"), F.lit(0)).cast("long").alias("n_sentences"),
        F.coalesce(F.array_join("sentence_ids", ","), F.lit("")).alias("sentence_ids"),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
    )
