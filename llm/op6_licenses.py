"""License scans: MinHash bands over overlapping text windows, then exact containment.

Texts and license templates are sets of five-word shingles.  Every text is read in windows
of three shingles that start at every second one, so each two neighbouring shingles of a
text share a window.  Templates are indexed by all runs of two shingles (or their only one).
A window and a run are compared by the least values of several orders of their shingles, a
band each; one equal band retrieves the template.  A shared pair has similarity 2/3, a
shared single shingle 1/3 with a template's only one and 1/4 with a run of two, so
``bands_needed`` orders find it with the stated probability also at a template's edge.
Retrieved templates are checked exactly: the share of their shingles that the windows hold
within the template's length.  All of it is built-in functions; texts never move, templates
are broadcast as long as they are small.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

SHINGLE = 5
CONTAINMENT = 0.8
#: Shingles of a window, and of the step from one to the next.
WINDOW, STEP = 3, 2
RECALL = 0.999
#: What may be broadcast, in bytes of templates, unless the caller names another size: their index
#: has about 130 bytes for each.  The join is the same beyond, by a shuffle.
BROADCAST_BYTES = 256 << 10

# fixed values: notices as licenses word them
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def bands_needed(recall: float = RECALL, similarity: float = 1 / (WINDOW + 1)) -> int:
    """Orders after which sets of this similarity have met in one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity))


def _words(text: str):
    """Lower-cased runs of letters and digits; none of a null."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _BREAKS), "")


def _shingles(words: str):
    """Hashes of all shingles in order, of at least ``SHINGLE`` words."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE),
                       lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))


def _order(k: int) -> int:
    """A mask; the order of the hashes under it ranks first what agrees with it longest."""
    mask = (k * 0x9E3779B97F4A7C15 + 0x6A09E667F3BCC909) % (1 << 64)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def template_shingles(templates: DataFrame) -> DataFrame:
    """``license, s``: the shingles of every template in order."""
    words = templates.select("license", _words("text").alias("w")).where(F.size("w") >= SHINGLE)
    return words.select("license", _shingles("w").alias("s")).distinct()


def template_index(whole: DataFrame, bands: int) -> DataFrame:
    """``license, band, value``: the bands of every run of two shingles."""
    runs = whole.select("license", "s", F.explode(F.sequence(F.lit(0), F.greatest(F.size("s") - 2, F.lit(0)))).alias("i"))
    a, b = F.get("s", F.col("i")), F.coalesce(F.get("s", F.col("i") + 1), F.get("s", F.col("i")))
    least = [F.struct(F.lit(k).alias("band"), F.least(a.bitwiseXOR(F.lit(_order(k))), b.bitwiseXOR(F.lit(_order(k)))).alias("value"))
             for k in range(bands)]
    return runs.select("license", F.inline(F.array(*least))).distinct()


def scan(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT, recall: float = RECALL,
         broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, license, containment, first_word``: the templates (``license, text``) that
    occur in a text to that share, their best share, and the word at which the first begins.

    Null, empty and texts of under five words match nothing, nor do templates of under five
    words; a license given twice with other words is one with the shingles of both; rows that
    share a doc_id are reported together, a null doc_id like any other; no documents or no
    templates give no rows.  Other columns are not read.
    """
    bands = bands_needed(recall)
    whole = template_shingles(templates)
    members = whole.groupBy("license").agg(F.array_distinct(F.flatten(F.collect_list("s"))).alias("s"))
    members = members.select("license", F.size("s").alias("n"), F.explode("s").alias("shingle"))
    index = template_index(whole, bands)
    size, longest = templates.agg(F.sum(F.octet_length("text"))).first()[0] or 0, members.agg(F.max("n")).first()[0] or 1
    if size <= broadcast_bytes:
        index, members = F.broadcast(index), F.broadcast(members)
    words = docs.select("doc_id", _words("text").alias("w")).where(F.size("w") >= SHINGLE)
    shingles = words.select("doc_id", _shingles("w").alias("s"))
    at = F.sequence(F.lit(0), F.size("s") - 1, F.lit(STEP))
    window = lambda i: F.struct(i.alias("at"), *[F.get("s", i + j).alias(f"h{j}") for j in range(WINDOW)])
    windows = shingles.select("doc_id", F.inline(F.transform(at, window)))
    value = lambda k: F.least(*[F.col(f"h{j}").bitwiseXOR(F.lit(_order(k))) for j in range(WINDOW)])
    banded = windows.select("*", F.posexplode(F.array(*[value(k) for k in range(bands)])).alias("band", "value"))
    met = banded.join(index, ["band", "value"])
    places = F.array(*[F.struct((F.col("at") + j).alias("place"), F.col(f"h{j}").alias("shingle")) for j in range(WINDOW)])
    shared = met.select("doc_id", "license", F.inline(places)).distinct().join(members, ["license", "shingle"])
    # an occurrence begins at a shared shingle and is as long as the template
    ahead = Window.partitionBy("doc_id", "license").orderBy("place").rangeBetween(0, longest - 1)
    met_by = F.collect_set(F.struct("place", "shingle")).over(ahead)
    inside = F.filter("_ahead", lambda x: x["place"] < F.col("place") + F.col("n"))
    share = F.size(F.array_distinct(inside["shingle"])) / F.col("n")
    found = shared.select("*", met_by.alias("_ahead")).select("doc_id", "license", "place", share.alias("containment"))
    return found.where(F.col("containment") >= containment).groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.min("place").alias("first_word"))


def template_table(spark) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, text string")


def q_op6_licenses(spark, sf_dir):
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"), template_table(spark)).select("doc_id", "license", "containment")


_VALUES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES)
_W = r"list_filter(regexp_split_to_array(lower({}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
SQL = rf"""
with t as (select license, {_W.format('text')} as w from (values {_VALUES}) v(license, text)),
ti as (select license, w, unnest(range(1, len(w) - 3)) as i from t),
ts as (select distinct license, array_to_string(w[i:i + 4], ' ') as s from ti),
tn as (select license, count(*) as n from ts group by license),
d as (select doc_id, {_W.format('text')} as w from documents where text is not null),
di as (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d),
m as (select doc_id, license, i - 1 as p, s from (select doc_id, i, array_to_string(w[i:i + 4], ' ') as s from di) join ts using (s)),
c as (select a.doc_id, a.license, a.p, n, count(distinct b.s) as k from m a join tn using (license)
      join m b on b.doc_id = a.doc_id and b.license = a.license and b.p between a.p and a.p + n - 1 group by all)
select doc_id, license, max(cast(k as double) / n) as containment from c where cast(k as double) / n >= 0.8 group by doc_id, license
"""
