"""License scans: exact phrases and a set-similarity join with templates (native).

Whole texts are tokenised once. Fixed phrases are found at every place. Beyond them, an
exact set-similarity join finds every text block that contains at least ``threshold`` of a
template's distinct words, the words that tell it from others among them. A block is about as long as its
template: templates are in classes of length (``CLASSES``), and a class of ``c`` words has blocks of ``c + c // 4`` words,
one from every ``c // 4 + 1`` words on, whatever marks or line breaks are between the words, so a notice of up to ``c``
words lies whole in a block however it is wrapped.

* words are ordered by the number of documents that have them, over all documents,
  rarest first;
* prefix filter: a block that has ``need`` of a template's words has at least one of the
  template's ``size - need + 1`` rarest, so only those are joined on;
* length filter: the block has ``need`` template words at least;
* positional filter: from the first common word on, both have enough words left.

Candidates are then counted exactly. Words in any order are no notice, so of the template's pairs of
neighbouring words at least a share of ``PAIRS`` must be pairs of the block (the one with the word before it
included). A block is none if a pair of words in it, or within a step before it, denies it ("not released"). A license gives way to its kinds (``KINDS``: an
attribution license to its non-commercial kind) in a block where both are found. Only template words take part; other words never match. A block yields one row
per prefix word and template at most.

Null texts count as empty and have no words. Repeated rows are scanned each for itself.
An empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landspark.llm.common import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of the longest template of each class.
CLASSES = [9, 11, 15, 19, 24, 31]
#: The share of a template's pairs of neighbouring words that a block must have.
PAIRS = 0.5
#: A word of the first before a word of the second denies a license.
DENYING, DENIED = "not never longer t cannot without".split(), "released licensed distributed permitted granted hereby available made free subject under being".split()

#: Phrases whose places are counted, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Notices that public licenses ask for, as templates: label, words, and those that must be there.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "associated files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "substantial portions permission"),
    ("mit", "released under the terms of the mit license", "mit license"),
    ("mit", "this project is licensed under the mit license", "mit license"),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache compliance 2"),
    ("apache-2", "licensed under the apache license version 2 0", "apache 2"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "applicable agreed basis"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general foundation"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty", "program hope useful warranty"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser foundation"),
    ("agpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution binary conditions"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "redistributions retain disclaimer"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", "contributors endorse promote"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "fee purpose granted"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages", "authors held damages"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "organization accompanying"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered domain"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived neighboring"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons noncommercial"),
    ("cc-by-nc-sa", "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license", "creative commons noncommercial sharealike"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license", "creative commons noderivatives"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons sharealike"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public 2"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public materials"),
]


#: Licenses whose notices hold much of the key's notice too.
KINDS = {"gpl": ["lgpl", "agpl"], "cc-by": ["cc-by-nc", "cc-by-sa", "cc-by-nd", "cc-by-nc-sa"], "cc-by-nc": ["cc-by-nc-sa"], "cc-by-sa": ["cc-by-nc-sa"]}


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case; null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrase_places(words: Column, line: Column, phrase: str) -> Column:
    """Start words of every place of ``phrase``; ``line`` is the words joined by spaces."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        found = F.lit(True)
        for k, p in enumerate(parts):
            found &= F.get(words, (i + k).cast("int")) == p
        return found

    starts = F.filter(F.sequence(F.lit(0).cast("long"), F.size(words).cast("long") - len(parts)), here)
    return F.when(line.contains(f" {phrase} "), starts).otherwise(F.array().cast("array<bigint>"))


def block_size(c: int) -> tuple[int, int]:
    """Words of a block of class ``c``, and from one block's start to the next one's."""
    return c + c // 4, c // 4 + 1


def templates(threshold: float) -> list[tuple[int, str, int, list[str], int, list[str], list[str], list[str]]]:
    """``id, label, class, distinct words, words needed, words that must be there, labels it gives way to, distinct pairs`` of each template."""
    out = []
    for k, (label, text, musts) in enumerate(TEMPLATES):
        words = text.split(" ")
        own = sorted(set(words))
        pairs = sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})
        out.append((k, label, next(c for c in CLASSES if c >= len(words)), own, math.ceil(threshold * len(own) - 1e-9), musts.split(" "), KINDS.get(label, []), pairs))
    return out


def denials() -> list[str]:
    """Pairs of words that deny a license."""
    return [f"{a} {b}" for a in DENYING for b in DENIED]


def matched_blocks(blocks: DataFrame, known: DataFrame, frequency: DataFrame) -> DataFrame:
    """The set-similarity join: ``row, class, block, template, label, containment``.

    ``blocks`` has ``row, class, block, words, pairs`` (distinct words and pairs of templates), ``known`` has
    ``template, label, class, word, need, n, musts, over, template_pairs``, ``frequency`` has ``word, documents``.
    """
    rank = frequency.select("word", F.struct("documents", "word").alias("rank"))
    # a template's words from the rarest on; words that no document has come first
    placed = known.join(rank, "word", "left").withColumn("rank", F.coalesce("rank", F.struct(F.lit(0).cast("long").alias("documents"), F.col("word"))))
    of = ["template", "label", "class", "need", "n", "musts", "over", "template_pairs"]
    by_template = placed.groupBy(*of).agg(F.array_sort(F.collect_list("rank")).alias("ordered"))
    prefix = by_template.select(*of, F.posexplode("ordered").alias("i", "rank"), F.transform("ordered", lambda r: r["word"]).alias("template_words"))
    prefix = prefix.filter(F.col("i") <= F.col("n") - F.col("need")).select(*of, "i", F.col("rank.word").alias("word"), "template_words")
    at = ["row", "class", "block"]
    own = blocks.select(*at, "words", "pairs", F.explode("words").alias("word")).join(rank, "word")
    own = own.groupBy(*at).agg(F.array_sort(F.collect_list("rank")).alias("ordered"), F.first("words").alias("words"), F.first("pairs").alias("pairs"))
    own = own.select(*at, "words", "pairs", F.size("words").alias("m"), F.posexplode("ordered").alias("j", "rank")).withColumn("word", F.col("rank.word"))
    joined = own.join(prefix, ["class", "word"]).filter((F.col("m") >= F.col("need")) & (F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) >= 1))
    first = joined.groupBy(*at, *[c for c in of if c != "class"]).agg(
        F.min_by(F.struct("i", "j"), "i").alias("at"), *[F.first(c).alias(c) for c in ("words", "pairs", "m", "template_words")]
    )
    # from the first common word on, both must have as many words left as are needed
    first = first.filter(F.least(F.col("n") - F.col("at.i"), F.col("m") - F.col("at.j")) >= F.col("need"))
    common = F.size(F.array_intersect("words", "template_words"))
    must = F.forall("musts", lambda w: F.array_contains("words", w))
    told = F.size(F.array_intersect("pairs", "template_pairs")) >= PAIRS * F.size("template_pairs")
    found = first.withColumn("common", common).filter((F.col("common") >= F.col("need")) & must & told)
    found = found.groupBy(*at).agg(F.collect_list(F.struct("template", "label", (F.col("common") / F.col("n")).alias("containment"), "over")).alias("own"))
    stays = F.filter("own", lambda x: ~F.exists("own", lambda y: F.array_contains(x["over"], y["label"])))
    return found.select(*at, F.inline(stays)).drop("over")


def _spans(c: int, least: int) -> Column:
    """The blocks of class ``c`` with ``least`` template words or more, of ``own_words`` and ``own_pairs``, that no pair at the places ``denied`` denies."""
    size, step = block_size(c)

    def of(column: str, i: Column) -> Column:
        return F.array_compact(F.array_distinct(F.slice(column, i + 1, size)))

    starts = F.sequence(F.lit(0), F.greatest(F.size("own_words") - 1, F.lit(0)), F.lit(step))
    starts = F.filter(starts, lambda i: ~F.exists("denied", lambda k: (k >= i - step) & (k < i + size)))
    spans = F.transform(starts, lambda i: F.struct(F.lit(c).alias("class"), i.alias("block"), of("own_words", i).alias("words"), of("own_pairs", i).alias("pairs")))
    return F.filter(spans, lambda b: F.size(b["words"]) >= least)


def scan(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The tokenised documents with phrase places, and the blocks that match a template.

    The first has ``row, doc_id, n_words, places`` (an array of start words for each
    phrase), the second is as :func:`matched_blocks` returns it.
    """
    spark, known = docs.sparkSession, templates(threshold)
    vocabulary = sorted({w for _, _, _, own, *_ in known for w in own})
    told = sorted({p for *_, pairs in known for p in pairs})
    words, line = F.col("words"), F.col("line")
    hits = F.array_intersect(words, F.array(*[F.lit(w) for w in vocabulary]))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), lowered(F.col(text_col)).alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).withColumn("line", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    # a block's words are words of its document, so other documents have no match
    may = {c: F.lit(False) for c in CLASSES}
    for _, _, c, own, need, musts, _, _ in known:
        must = F.forall(F.array(*[F.lit(w) for w in musts]), lambda w: F.array_contains("hits", w))
        may[c] |= must & (F.size(F.array_intersect("hits", F.array(*[F.lit(w) for w in own]))) >= need)
    rows = rows.select("row", "doc_id", F.size(words).cast("long").alias("n_words"), F.array(*[phrase_places(words, line, p) for p in PHRASES]).alias("places"), hits.alias("hits"), "words")
    rows = rows.withColumn("may", F.filter(F.array(*[F.when(may[c], c) for c in CLASSES]), lambda c: c.isNotNull()))
    # words and pairs of templates in their places, null between them; a pair's place is that of its second word
    follow = F.concat(F.array(F.lit("")), F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b)))
    marked = lambda own, of: F.transform(own, lambda w: F.when(w.isin(of), w))
    rows = rows.withColumn("own_words", F.when(F.size("may") > 0, marked(words, vocabulary))).withColumn("own_pairs", F.when(F.size("may") > 0, marked(follow, told)))
    denied = F.array_compact(F.transform(follow, lambda p, k: F.when(p.isin(denials()), k)))
    rows = rows.withColumn("denied", F.when(F.size("may") > 0, denied)).drop("words")
    spans = [F.when(F.array_contains("may", c), _spans(c, min(need for _, _, k, _, need, *_ in known if k == c))) for c in CLASSES]
    none = F.array().cast("array<struct<class:int,block:int,words:array<string>,pairs:array<string>>>")
    rows = rows.withColumn("blocks", F.concat(*[F.coalesce(x, none) for x in spans]))
    rows = materialize(rows.drop("may", "own_words", "own_pairs", "denied"), "scanned")
    frequency = rows.select(F.explode("hits").alias("word")).groupBy("word").agg(F.count("*").alias("documents"))
    blocks = rows.select("row", F.inline("blocks"))
    schema = "template int, label string, class int, word string, need int, n int, musts array<string>, over array<string>, template_pairs array<string>"
    table = spark.createDataFrame([(k, label, c, w, need, len(own), musts, over, pairs) for k, label, c, own, need, musts, over, pairs in known for w in own], schema)
    return rows, matched_blocks(blocks, table, frequency)


def label(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row.

    ``score`` is 1 for a document with a phrase, else the highest containment of a
    template in one of its blocks, 0 if none reaches the threshold.
    """
    rows, blocks = scan(docs, threshold)
    found = blocks.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("containment").alias("containment"))
    places = F.flatten("places")
    base = F.array_compact(F.array(*[F.when(F.size(F.col("places")[k]) > 0, F.lit(v)) for k, v in enumerate(PHRASES.values())]))
    return rows.join(found, "row", "left").select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size(places) > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
