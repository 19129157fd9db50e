"""Licence recognition by sentence rules.

Each text is cut into sentences, which are normalised and looked up among known licence sentences.  The identifiers of
those found, in order, are matched against rules: a rule is a sequence of identifiers that must follow one another,
with any number of other sentences in between.
"""

from pyspark.sql import DataFrame, Window, functions as F

# Sentences of public licences, and the rules over them.
SENTENCES = {
    "mit-reference": "Released under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "apache-reference": "Licensed under the Apache License, Version 2.0",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "gpl3-reference": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-no-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "by-nc-reference": "Licensed under CC BY-NC 4.0",
    "by-reference": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "bsd-permission": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
}
RULES = {
    "mit-by-reference": ("MIT", ["mit-reference"]),
    "mit-in-full": ("MIT", ["mit-permission", "mit-notice"]),
    "apache-by-reference": ("Apache-2.0", ["apache-reference"]),
    "apache-in-full": ("Apache-2.0", ["apache-grant", "apache-copy", "apache-as-is"]),
    "gpl-by-reference": ("GPL-3.0", ["gpl3-reference"]),
    "gpl-in-full": ("GPL-3.0-or-later", ["gpl-free", "gpl-no-warranty"]),
    "by-nc-by-reference": ("CC-BY-NC-4.0", ["by-nc-reference"]),
    "by-by-reference": ("CC-BY-4.0", ["by-reference"]),
    "bsd-in-full": ("BSD-2-Clause", ["bsd-permission", "bsd-source", "bsd-binary"]),
}
#: A sentence ends at these marks before white space or the end.  It is also tried up to each line end, since a notice
#: often stands on a line of its own; a wrapped sentence is tried as a whole.
SENTENCE_END, ENDED = r"[.!?]+([ \t\r\n]|\z)", "\x01"


def plain(sentence: str) -> str:
    """A known sentence as ``sentences`` normalises it."""
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower()).split())


def cue() -> str:
    """A pattern that finds, in any text with a known sentence, the longest word of that sentence."""
    return "(?i)" + "|".join(sorted({max(plain(s).split(), key=lambda w: (len(w), w)) for s in SENTENCES.values()}))


def sentences(docs: DataFrame) -> DataFrame:
    """The normalised sentences of texts that may hold a known one: ``row``, ``doc_id``, ``at`` (the piece in
    which it starts, from 0), ``sentence``."""
    likely = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").where(F.col("text").rlike(cue()))
    cut = likely.select("row", "doc_id", F.posexplode(F.split(F.regexp_replace("text", SENTENCE_END, f"{ENDED}\n"), "\n")).alias("at", "_line"))
    words = F.trim(F.regexp_replace(F.lower("_line"), "[^a-z0-9]+", " "))
    lines = cut.select("row", "doc_id", "at", words.alias("sentence"), (F.col("_line").endswith(ENDED) | (words == "")).alias("_ends"))
    before = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    wrapped = (lines.withColumn("_nth", F.coalesce(F.sum(F.col("_ends").cast("int")).over(before), F.lit(0)))
               .where("sentence <> ''").groupBy("row", "doc_id", "_nth").agg(F.array_sort(F.collect_list(F.struct("at", "sentence"))).alias("_lines")).where("size(_lines) > 1")
               .select("row", "doc_id", F.col("_lines")[0]["at"].alias("at"), F.trim(F.array_join(F.col("_lines.sentence"), " ")).alias("sentence")))
    return lines.select("row", "doc_id", "at", "sentence").unionByName(wrapped)


def scan(docs: DataFrame) -> DataFrame:
    """Licences that texts name or hold: ``doc_id``, ``licence``, ``rule``, ``first_sentence``, ``last_sentence``.

    Takes ``doc_id`` and ``text``; other columns are ignored.  One row per match of a rule; a text may have many, of
    several licences.  Null and empty texts have none.  Repeated rows are scanned each; a null ``doc_id`` is carried.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame([(name, plain(s)) for name, s in SENTENCES.items()], "name string, sentence string")
    steps = spark.createDataFrame([(rule, licence, k, name, len(names)) for rule, (licence, names) in RULES.items() for k, name in enumerate(names)],
                                  "rule string, licence string, step int, name string, steps int")
    # both tables are the fixed values above
    found = sentences(docs).join(F.broadcast(known), "sentence").select("row", "doc_id", "at", "name")
    found = found.withColumn("nth", F.row_number().over(Window.partitionBy("row").orderBy("at")))
    tried = found.join(F.broadcast(steps), "name")
    return (tried.groupBy("row", "doc_id", "licence", "rule", "steps", (F.col("nth") - F.col("step")).alias("begin"))
            .agg(F.count("*").alias("met"), F.min("at").alias("first_sentence"), F.max("at").alias("last_sentence"))
            .where("met = steps").select("doc_id", "licence", "rule", F.col("first_sentence").cast("long").alias("first_sentence"),
                                         F.col("last_sentence").cast("long").alias("last_sentence")))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def scan_sql() -> str:
    """The same in SQL over ``documents``."""
    known = ", ".join(f"({quoted(name)}, {quoted(plain(s))})" for name, s in SENTENCES.items())
    steps = ", ".join(f"({quoted(rule)}, {quoted(licence)}, {k}, {quoted(name)}, {len(names)})" for rule, (licence, names) in RULES.items() for k, name in enumerate(names))
    return rf"""
        WITH known(name, sentence) AS (VALUES {known}), steps(rule, licence, step, name, steps) AS (VALUES {steps}),
        cut AS (SELECT doc_id, string_split(regexp_replace(text, '{SENTENCE_END}', chr(1) || chr(10), 'g'), chr(10)) AS parts FROM documents),
        each AS (SELECT doc_id, UNNEST(parts) AS part, UNNEST(range(len(parts))) AS pos FROM cut),
        lines AS (SELECT doc_id, pos, trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) AS sentence, ends_with(part, chr(1)) AS marked FROM each),
        counted AS (SELECT *, COALESCE(SUM(CASE WHEN marked OR sentence = '' THEN 1 ELSE 0 END)
                        OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp FROM lines),
        every_one AS (SELECT doc_id, pos, sentence FROM lines UNION ALL
                      SELECT doc_id, MIN(pos), trim(string_agg(sentence, ' ' ORDER BY pos)) FROM counted WHERE sentence <> '' GROUP BY doc_id, grp HAVING COUNT(*) > 1),
        found AS (SELECT doc_id, pos, name, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY pos) AS nth FROM every_one JOIN known USING (sentence))
        SELECT doc_id, licence, rule, MIN(pos) AS first_sentence, MAX(pos) AS last_sentence
        FROM found JOIN steps USING (name) GROUP BY doc_id, licence, rule, steps, nth - step HAVING COUNT(*) = steps"""
