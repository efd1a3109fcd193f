"""Licence scan with a positional rare-token index (DataFrame functions only).

Templates are short public notices.  Their words, function words aside, are
the licence words; inverse document frequencies of these are counted over all
files.  A template whose key phrases all stand in a file is looked up by its
rarest words: each of their places in the file proposes a relative position.
Every licence word of the template is then counted at every proposed position.
As many rare words are looked up as may be missing, and one more, so that no
position with enough words in place goes unproposed.

Base phrases are found in every file beside that.

Results: a null text is the empty text; files without licence words have no
labels and score 0; rows sharing an id and a text get the same labels; an
empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonescope.llm.common import stored

#: Phrases whose places count, and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Public notices as (label, notice, key phrases that must stand in the file).
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    ("apache", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    ("gpl", "licensed under the gnu general public license version 3", ("gnu general public license",)),
    ("gpl", "free software you can redistribute it and or modify it under the terms of the gnu general public license", ("free software", "general public license")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source and binary forms",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    ("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
)
#: Function words, no licence words.
FUNCTION_WORDS = frozenset("a all and any are by can for in into is it of or the this to under use with without you".split())
#: Share of a template's licence words that must stand in place.
COVERAGE = 0.6
_NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _postings() -> list[tuple[str, int, int, int]]:
    """(word, template, position, the template's number of licence words)."""
    out = []
    for number, (_, notice, _) in enumerate(TEMPLATES):
        words = notice.split()
        places = [i for i, w in enumerate(words) if w not in FUNCTION_WORDS]
        out += [(words[i], number, i, len(places)) for i in places]
    return out


def _sql_strings(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, base places, and licence words with positions, and the file's words, where a key phrase stands."""
    words = sorted({w for w, *_ in _postings()})
    phrases = sorted({p for _, _, keys in TEMPLATES for p in keys})
    plain = F.translate(F.coalesce(df[text_col].cast("string"), F.lit("")), _UPPER, _LOWER)
    rows = df.select(df[id_col].cast("long").alias("doc_id"), F.trim(F.regexp_replace(plain, _NO_WORD, " ")).alias("_line"))
    rows = rows.withColumn("_w", F.expr("case when _line = '' then cast(array() as array<string>) else split(_line, ' ') end"))
    rows = rows.withColumn("present", F.expr(f"array_intersect(_w, {_sql_strings(words)})"))
    rows = rows.withColumn("_ends", F.expr("""case when array_contains(present, 'license') then filter(sequence(0, size(_w) - 1), i -> _w[i] = 'license' and coalesce(
        get(_w, i - 1) in ('mit', 'apache') or (get(_w, i - 1) = 'public' and get(_w, i - 2) = 'general'), false)) end"""))
    rows = rows.withColumn("base", F.expr("""transform(_ends, i -> named_struct(
        'start', cast(case when get(_w, i - 1) = 'public' then i - 2 else i - 1 end as bigint),
        'label', case get(_w, i - 1) when 'mit' then 'mit' when 'apache' then 'apache' else 'gpl' end))"""))
    rows = rows.withColumn("phrases", F.expr(f"""case when size(present) > 0 then filter({_sql_strings(phrases)}, p -> contains(concat(' ', _line, ' '), concat(' ', p, ' '))) end"""))
    rows = rows.withColumn("words", F.expr("case when size(phrases) > 0 then _w end"))
    rows = rows.withColumn("hits", F.expr("""case when size(phrases) > 0 then filter(transform(_w, (w, i) -> named_struct('word', w, 'place', i)), h -> array_contains(present, h.word)) end"""))
    return rows.select(
        "doc_id", F.size("_w").cast("long").alias("n_words"), "present", "hits", "phrases", "words",
        F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.expr("array_min(transform(base, b -> b.start))").alias("first_word"),
        F.expr("array_max(transform(base, b -> b.start))").alias("last_word"),
        F.expr("coalesce(array_sort(array_distinct(transform(base, b -> b.label))), cast(array() as array<string>))").alias("base_set"),
    )


def _templates(rarity: DataFrame) -> DataFrame:
    """One row: an array of all templates, with all their postings and the rarest ones for the lookup."""
    spark = rarity.sparkSession
    notices = _inline(spark, "template int, label string, keys array<string>, need int", ", ".join(
        f"({n}, '{label}', {_sql_strings(keys)}, {math.ceil(COVERAGE * of)})" for n, (label, _, keys) in enumerate(TEMPLATES) for of in [sum(t == n for _, t, *_ in _postings())]))
    postings = _inline(spark, "word string, template int, position int, of int", ", ".join(f"('{w}', {t}, {p}, {n})" for w, t, p, n in _postings()))
    ranked = postings.join(F.broadcast(rarity), "word", "left").groupBy("template", "of").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("idf")).alias("r"), "word", "position"))).alias("postings"))
    whole = ranked.join(notices, "template").withColumn("lookups", F.expr("slice(postings, 1, of - need + 1)"))
    return whole.agg(F.collect_list(F.struct("label", "keys", "need", "of", "postings", "lookups")).alias("templates"))


def _inline(spark: SparkSession, names: str, values: str) -> DataFrame:
    columns = ", ".join(part.split()[0] for part in names.split(", "))
    return spark.sql(f"select * from values {values} as t({columns})")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = df.sparkSession
    files = stored(measured(df, id_col, text_col), "licence-files")
    with_words = files.where(F.size("present") > 0)
    seen = with_words.select(F.explode("present").alias("word")).groupBy("word").agg(F.count("*").alias("files"))
    total = files.agg(F.count("*").alias("total"))
    rarity = seen.crossJoin(F.broadcast(total)).select("word", F.log((F.col("total") + 1) / (F.col("files") + 1)).alias("idf"))
    # The most words of each template in place at one relative position.
    placed = files.crossJoin(F.broadcast(_templates(rarity))).withColumn("placed", F.expr("""
        transform(filter(templates, t -> size(phrases) > 0 and size(array_except(t.keys, phrases)) = 0), t -> named_struct('label', t.label, 'need', t.need, 'of', t.of,
            'n', coalesce(array_max(transform(
                array_distinct(flatten(transform(t.lookups, p -> transform(filter(hits, h -> h.word = p.word), h -> h.place - p.position)))),
                shift -> size(filter(t.postings, p -> coalesce(get(words, shift + p.position) = p.word, false))))), 0)))"""))
    verified = placed.withColumn("verified", F.expr("filter(placed, t -> t.n >= t.need)"))
    every = F.expr("array_sort(array_union(base_set, transform(verified, t -> t.label)))")
    best = F.expr("array_max(transform(verified, t -> t.n / t.of))")
    score = F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0))
    return verified.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_set", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), score.cast("double").alias("score"))
