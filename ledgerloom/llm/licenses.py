"""License texts inside documents: MinHash bands retrieve templates, exact shingle containment verifies them.

Documents and templates are words; a shingle is five words, and a template of fewer words is one shingle of its
own length. For every template length there is a window length, and a document's windows overlap by three quarters.
A window's sketch is the first of its shingles under several independent hashes, each a band of its own, so one
agreement retrieves the template. A window can only agree in a band if it holds the template's least shingle of that
band, so sketches are made around those shingles, which is the same as making all and keeping those that agree. Templates of up to four shingles have windows of exactly their length at every
place: a full match has the same set of shingles and is retrieved for certain. Longer ones have 16 bands: a verbatim
template shares at least half the shingles of the best window, and is missed with probability below 2^-16; one that
barely holds four fifths of its shingles shares at least 0.45, and is missed with probability below 10^-4.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import settle

SHINGLE = 5
LEAST_CONTAINED = 0.8
BANDS = 16
# Window lengths in shingles: up to four exactly the template's, then steps of at most one half.
EXACT_WINDOWS = 4
LADDER = (6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024)
MOST_TEMPLATES = 1024
NOT_WORD = "[^a-z0-9]+"

# Names and texts of the templates.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("all-rights-reserved", "All rights reserved."),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "Apache-2.0-notice",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    (
        "BSD-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    (
        "GPL-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "ISC-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def _between(first: Column, last: Column) -> Column:
    """The whole numbers from first to last; none if last is below."""
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _stretch(values: Column, first: Column, length: Column) -> Column:
    """``length`` values from place ``first`` (from 1), as far as there are any; reads nothing else of a long array."""
    last = F.least(first + length - 1, F.size(values))
    return F.transform(_between(first, last), lambda at: F.get(values, at - 1))


def shingle_hashes(words: Column, width: int) -> Column:
    """A hash for every run of ``width`` words."""
    return F.transform(
        _between(F.lit(0), F.size(words) - width), lambda at: F.xxhash64(*(F.get(words, at + i) for i in range(width)))
    )


def window_of(shingles: int) -> int:
    """Window length for a template of so many shingles."""
    if shingles <= EXACT_WINDOWS:
        return shingles
    return next((w for w in LADDER if w >= shingles), shingles)


def _bands(window: int) -> int:
    return 1 if window <= EXACT_WINDOWS else BANDS


def _sketch(hashes: Column, bands: int) -> Column:
    """The hash that comes first in each band: every band hashes the hashes anew, so their orders are independent."""
    numbers = F.sequence(F.lit(1), F.lit(bands))
    ranked = lambda n: F.transform(hashes, lambda h: F.struct(F.xxhash64(n, h).alias("rank"), h.alias("hash")))
    return F.transform(numbers, lambda n: F.array_min(ranked(n))["hash"])


def _places(width: int, window: int, group: list[dict]) -> Column:
    """The windows of a document that agree with a template of the group in a band, each with its sketch and words.

    Reads the columns words, h<width> (shingle hashes) and s<width> (places of shingles that are least in a band of a
    template). Only a window that holds such a shingle can agree, so no sketch of another window is made.
    """
    step, bands, hashes = max(1, window // 4), _bands(window), F.col(f"h{width}")

    def around(spot: Column) -> Column:
        first = F.greatest(F.lit(0), F.ceil((spot - window) / step).cast("int"))
        return F.transform(F.sequence(first, F.floor((spot - 1) / step).cast("int")), lambda n: n * step + 1)

    starts = F.array_distinct(F.flatten(F.transform(F.col(f"s{width}"), around)))
    sought = F.array(*(F.array(*map(F.lit, sorted({t["bands"][n] for t in group}))) for n in range(bands)))

    def agrees(found: Column) -> Column:
        return F.exists(F.zip_with(found["sketch"], sought, lambda value, values: F.array_contains(values, value)), lambda same: same)

    def place(at: Column) -> Column:
        begin = F.greatest(F.lit(1), at - window)
        return F.struct(
            F.lit(width).alias("width"),
            F.lit(window).alias("window"),
            _sketch(_stretch(hashes, at, F.lit(window)), bands).alias("sketch"),
            # With a window on either side, the place holds the whole template wherever it was cut.
            begin.alias("from"),
            _stretch(F.col("words"), begin, F.lit(3 * window + width - 1)).alias("part"),
        )

    return F.filter(F.transform(starts, place), agrees)


def _spots(hashes: Column, values: list[int]) -> Column:
    """Places of the hashes that are among the values."""
    return F.filter(_between(F.lit(1), F.size(hashes)), lambda at: F.get(hashes, at - 1).isin(values))


def template_table(spark: SparkSession, templates) -> list[dict]:
    """license, words, shingle width and window of each template, and its band values; without words none."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    table = spark.createDataFrame(list(templates), "license string, text string")
    rows = table.select("license", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0).collect()
    by_width = defaultdict(list)
    for r in rows:
        by_width[min(SHINGLE, len(r["words"]))].append((r["license"], r["words"]))
    out = []
    for width, group in sorted(by_width.items()):
        made = spark.createDataFrame(group, "license string, words array<string>")
        hashes = F.array_distinct(shingle_hashes(F.col("words"), width))
        made = made.select("license", "words", hashes.alias("hashes")).select(
            "license", "words", F.size("hashes").alias("n"), _sketch(F.col("hashes"), BANDS).alias("bands")
        )
        for r in made.collect():
            window = window_of(r["n"])
            out.append({"license": r["license"], "words": r["words"], "width": width, "window": window, "bands": r["bands"][: _bands(window)]})
    return out


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, license, containment and first_word of every template found in every document.

    ``containment`` is the share of the template's distinct shingles in the best stretch of its own length and four words
    more, at least 0.8, and ``first_word`` the number of the first word there, from 0. A row with several licenses comes out for each, one without for
    none, a repeated row as often as it goes in. NULL and empty texts hold no license. Words are runs of ASCII letters
    and digits in lower case. Other columns are ignored.
    """
    spark = settle(docs.sparkSession)
    table = template_table(spark, templates)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row_no"), words_of(F.col("text")).alias("words"))
    classes = defaultdict(list)
    for t in table:
        classes[(t["width"], t["window"])].append(t)
    widths = sorted({width for width, _ in classes})
    rows = rows.withColumns({f"h{w}": shingle_hashes(F.col("words"), w) for w in widths})
    least = {w: sorted({v for t in table if t["width"] == w for v in t["bands"]}) for w in widths}
    rows = rows.withColumns({f"s{w}": _spots(F.col(f"h{w}"), least[w]) for w in widths})
    hits = [_places(width, window, group) for (width, window), group in sorted(classes.items())]
    # Outer: for an inner explode Spark would make the array once more to leave out empty ones first.
    candidates = rows.select("doc_id", "row_no", F.explode_outer(F.concat(*hits)).alias("hit")).filter(F.col("hit").isNotNull())
    candidates = candidates.select("doc_id", "row_no", "hit.*")
    known = spark.createDataFrame(
        [(t["license"], t["width"], t["window"], t["words"], t["bands"]) for t in table],
        "license string, of_width int, of_window int, template array<string>, bands array<bigint>",
    )
    runs = lambda words, width: F.transform(
        _between(F.lit(1), F.size(words) - width + 1), lambda at: F.array_join(_stretch(words, at, width), " ")
    )
    met = candidates.join(F.broadcast(known), (F.col("width") == F.col("of_width")) & (F.col("window") == F.col("of_window"))).filter(
        F.exists(F.zip_with("sketch", "bands", lambda a, b: a == b), lambda same: same)
    )
    met = met.withColumns({"own": F.array_distinct(runs(F.col("template"), F.col("width"))), "seen": runs(F.col("part"), F.col("width"))})
    # The best stretch of the template's own length, with room for a few words put in; it begins with one of its shingles.
    begins = F.filter(_between(F.lit(1), F.size("seen")), lambda at: F.array_contains("own", F.get("seen", at - 1)))
    length = F.size("own") + SHINGLE - 1
    shared = lambda at: F.size(F.array_intersect("own", F.slice("seen", at, length)))
    stretch = F.array_max(F.transform(begins, lambda at: F.struct(shared(at).alias("shared"), (-at).alias("nearest"))))
    met = met.withColumn("stretch", stretch)
    return (
        met.select(
            "doc_id", "row_no", "license", (F.col("stretch.shared") / F.size("own")).alias("containment"), (F.col("from") - F.col("stretch.nearest") - 2).alias("first_word")
        )
        .filter(F.col("containment") >= LEAST_CONTAINED)
        .groupBy("doc_id", "row_no", "license")
        .agg(F.max(F.struct("containment", (-F.col("first_word")).alias("nearest"))).alias("best"))
        .select("doc_id", "license", "best.containment", (-F.col("best.nearest")).cast("long").alias("first_word"))
    )
