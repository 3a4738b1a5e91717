"""Licence statements in texts, with DataFrame and SQL functions only.

Texts and templates are shingles of words. A window of a text, as long as a template, is compared
with templates by MinHash: windows and templates that agree on both minima of one of the bands meet,
and their shingles are then compared exactly. A window that holds none of a template's shingles
shares no minimum with it, so only windows that begin with a template's shingle are looked at;
shifting a window up to its first such shingle loses none.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

# Statements by which works are commonly licensed.
TEMPLATES = (
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under Apache License 2.0"),
    ("Apache-2.0", "Released under the Apache License, Version 2.0"),
    ("BSD", "Released under the BSD License"),
    ("BSD", "Licensed under the BSD License"),
    ("Artistic-2.0", "licensed under the Artistic License 2.0"),
    ("BSD-2-Clause", "licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "licensed under the BSD 3-Clause License"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-SA-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "dedicated to the public domain under CC0 1.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
    ("ISC", "Released under the ISC License"),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Released under an MIT License"),
    ("MIT", "Licensed under an MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "free and unencumbered software released into the public domain"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL-2.0", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-3.0", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-2.1", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
)


@dataclass(frozen=True)
class Scan:
    words: int = 5
    containment: float = 0.8  # of a template's shingles, in a window as long
    bands: int = 20  # of two minima: at this containment a pair of sets is at least 2/3 alike and meets but for 1 in 100 000
    templates: tuple[tuple[str, str], ...] = field(default=TEMPLATES)


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(words: str, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order; fewer words make one, none make none."""
    n = F.size(words)
    run = lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(size)])
    several = F.transform(F.sequence(F.lit(1), n - (size - 1)), run)
    return F.when(n >= size, several).when(n > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))


def _bands(window: str, bands: int) -> Column:
    """A number for each band, made of the minima of two hash functions over the window's shingles."""
    least = lambda j: F.array_min(F.transform(window, lambda x: F.xxhash64(x, F.lit(j))))
    return F.array(*[F.xxhash64(F.lit(k), least(2 * k), least(2 * k + 1)) for k in range(bands)])


def _templates(spark: SparkSession, scan: Scan) -> DataFrame:
    """(template, license, own, length, versions): a fixed number of rows. versions: the shingles that hold all words of the template with a digit."""
    rows = spark.createDataFrame([(i, code, text) for i, (code, text) in enumerate(scan.templates)], "template int, license string, text string")
    rows = rows.withColumn("words", words_of(F.col("text"))).withColumn("own", F.array_distinct(shingles("words", scan.words)))
    numbers = F.filter("words", lambda w: w.rlike("[0-9]"))
    at = lambda i: F.slice("words", i, scan.words)
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size("words") - (scan.words - 1), F.lit(1))), lambda i: F.size(F.array_except(numbers, at(i))) == 0)
    versions = F.when(F.size(numbers) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(places, lambda i: F.element_at(shingles("words", scan.words), i)))
    return rows.select("template", "license", "own", F.size("own").alias("length"), versions.alias("versions"))


def licenses(docs: DataFrame, scan: Scan | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, license, containment, first_word): a row for each licence that a whole text states.

    A licence is stated where a window of as many shingles as one of its templates has holds at
    least the share ``scan.containment`` of the template's and, if the template names a version, one
    of the shingles that hold it whole: another version is another licence. The best window counts,
    of equal ones the first. first_word is the window's first word, from 0. Null texts and texts without words
    state none. Rows are scanned one by one, so a repeated row gives its results again; other
    columns are ignored. An empty table gives no rows.
    """
    scan = scan or Scan()
    spark = docs.sparkSession
    templates = _templates(spark, scan)
    # The templates' shingles are few and of a fixed number: they become a set in the filter.
    known = sorted({h for row in templates.select("own").collect() for h in row[0]})
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), words_of(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("words"))
    # The row number also keeps the filter above the shingles, which are then made once for each text.
    rows = rows.select("doc_id", shingles("words", scan.words).alias("h"), F.monotonically_increasing_id().alias("row"))
    rows = common.written(rows.where(F.exists("h", lambda x: x.isin(known))), "licensed")
    hits = rows.select("doc_id", "row", "h", F.posexplode("h").alias("at", "shingle")).where(F.col("shingle").isin(known))
    lengths = F.broadcast(templates.select(F.explode("own").alias("shingle"), "length").distinct())
    windows = hits.join(lengths, "shingle").select("doc_id", "row", "at", "length", F.slice("h", F.col("at") + 1, F.col("length")).alias("window"))
    banded = windows.select("doc_id", "row", "at", "length", "window", F.explode(_bands("window", scan.bands)).alias("band"))
    meant = templates.select("template", "license", "own", "versions", "length", F.explode(_bands("own", scan.bands)).alias("band"))
    met = banded.join(F.broadcast(meant), ["length", "band"]).dropDuplicates(["row", "at", "template"])
    share = F.size(F.array_intersect("window", "own")) / F.col("length")
    of_version = (F.size("versions") == 0) | F.arrays_overlap("window", "versions")
    found = met.where(of_version).select("doc_id", "row", "license", "at", share.alias("containment")).where(F.col("containment") >= scan.containment)
    top = F.max("containment").over(Window.partitionBy("row", "at"))
    found = found.withColumn("top", top).where("containment = top").drop("top")
    best = found.groupBy("row", "license").agg(F.first("doc_id").alias("doc_id"), F.min(F.struct((-F.col("containment")).alias("less"), F.col("at"))).alias("best"))
    return best.select("doc_id", "license", (-F.col("best.less")).alias("containment"), F.col("best.at").cast("long").alias("first_word"))


def oracle(scan: Scan | None = None) -> str:
    """DuckDB SQL for the same rows, by comparing all windows that begin with a template's shingle."""
    scan = scan or Scan()
    values = ",\n  ".join(f"({i}, '{code}', '{text}')" for i, (code, text) in enumerate(scan.templates))
    split = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    pieces = f"case when len(w) >= {scan.words} then list_transform(range(1, len(w) - {scan.words - 2}), lambda i: array_to_string(w[i:i + {scan.words - 1}], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end"
    return f"""
with t(template, license, phrase) as (values
  {values}
), tw as (select template, license, {split.format("phrase")} as w from t),
ts as (select template, license, list_distinct({pieces}) as own, list_filter(w, lambda x: regexp_matches(x, '[0-9]')) as numbers from tw),
tu as (select template, license, length, shingle, len(numbers) = 0 or list_has_all(string_split(shingle, ' '), numbers) as of_version from (select template, license, numbers, len(own) as length, unnest(own) as shingle from ts)),
dw as (select row_number() over () as r, doc_id, {split.format("coalesce(text, '')")} as w from documents),
ds as (select r, doc_id, {pieces} as s from dw),
du as (select r, doc_id, unnest(s) as shingle, generate_subscripts(s, 1) - 1 as pos from ds),
hit as (select du.r, du.doc_id, du.pos, du.shingle, template, license, length, of_version from du join tu using (shingle)),
win as (
  select a.r, a.doc_id, a.template, a.license, a.pos, count(distinct b.shingle) / cast(a.length as double) as containment
  from hit a join hit b on a.r = b.r and a.template = b.template and b.pos >= a.pos and b.pos < a.pos + a.length
  group by a.r, a.doc_id, a.template, a.license, a.pos, a.length
  having bool_or(b.of_version)
), topped as (
  select *, max(containment) over (partition by r, pos) as top from win where containment >= {scan.containment}
), ranked as (
  select *, row_number() over (partition by r, license order by containment desc, pos) as place from topped where containment = top
)
select doc_id, license, containment, cast(pos as bigint) as first_word from ranked where place = 1
"""
