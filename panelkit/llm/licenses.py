"""License scan: MinHash bands over overlapping windows, then exact shingle containment.

Texts and templates are sequences of lower-case words (letters and digits) and their 5-word
shingles. Templates are grouped by size (classes that double); for each class a text is
searched by overlapping windows of up to three times the shingles of a template. Each of 52
bands is the least shingle of a window under a permutation of its own. A template's least
shingle is in a text that holds 0.8 of it with probability 0.8, and is then the least of a
window around it with probability a quarter at least, in however many pieces the template
stands. So a band retrieves it with probability 0.2, and all bands miss it with probability
0.8 ** 52 = 1e-5 at most. Windows only retrieve: what decides is how many of the template's
shingles, compared as words, stand anywhere in the whole text.

A band's least shingle is one of the template's, so texts without a shingle of any template
have no windows to search. Texts are hashed many at a time, in arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import in_batches, table
from panelkit.llm.decontaminate import hashed_texts, item_keys, shingle_hashes, shingles, size_class, windows

SHINGLE = 5
CONTAINMENT = 0.8
#: Shingles of the templates of one broadcast index (about 50 bytes each); more templates take
#: further indexes, each in a pass of its own.
INDEX_SHINGLES = 1_000_000
#: log2 of the places of the table that tells which hashes may be a template's.
TABLE_BITS = 24

# Public license notices by identifier.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                  "and associated documentation files (the \"Software\"), to deal in the Software without "
                  "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                  "distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
                         "file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                  "GNU General Public License as published by the Free Software Foundation",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the "
                   "GNU Lesser General Public License as published by the Free Software Foundation",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                  "fee is hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring "
               "rights to this work",
}

_WORD = re.compile(r"[^\W_]+")


def normalised(text: str | None) -> bytes:
    """The words of a text, joined by one blank."""
    return " ".join(_WORD.findall((text or "").lower())).encode("utf-8", "surrogatepass")


class Index:
    """Templates by the keys of their bands."""

    def __init__(self, templates: Mapping[str, str]):
        self.sets: dict[str, set[bytes]] = {}
        self.owners: dict[int, list[str]] = {}
        hashes, keys, short = [], [], []
        for name, text in templates.items():
            words = normalised(text).split()
            if len(words) < SHINGLE:
                short.append(name)
                continue
            self.sets[name] = set(shingles(words))
            own = shingle_hashes(words)
            hashes.append(own)
            keys.append(item_keys(own))
            for key in keys[-1].tolist():
                self.owners.setdefault(key, []).append(name)
        if short:
            raise ValueError(f"templates need {SHINGLE} words: {short}")
        none = np.zeros(0, np.uint64)
        self.hashes = np.unique(np.concatenate([none, *hashes]))
        self.keys = np.unique(np.concatenate([none, *keys]))
        self.classes = sorted({size_class(len(s)) for s in self.sets.values()})
        self.places = np.zeros(1 << TABLE_BITS, bool)
        self.places[self.hashes >> np.uint64(64 - TABLE_BITS)] = True
        # Every key passes; those that are no template's are looked up and not found.
        self.all_keys = np.full(1, ~np.uint64(0))

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the shingles that a template has."""
        at = np.flatnonzero(self.places[hashes >> np.uint64(64 - TABLE_BITS)])
        where = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        return at[self.hashes[where] == hashes[at]] if len(at) else at

    def find(self, words: list[bytes], hashes: np.ndarray) -> dict[str, tuple[float, int]]:
        """Template -> (containment, first word of its first shingle), over the whole text."""
        at = self.hits(hashes)
        if not len(at):
            return {}
        names = set()
        for _, _, keys in windows(hashes, self.classes, self.all_keys, at):
            where = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            for key in keys[self.keys[where] == keys].tolist():
                names.update(self.owners[key])
        first: dict[bytes, int] = {}
        for j in at.tolist():
            first.setdefault(b" ".join(words[j:j + SHINGLE]), j)
        found = {}
        for name in sorted(names):
            there = self.sets[name] & first.keys()
            if len(there) >= CONTAINMENT * len(self.sets[name]):
                found[name] = (len(there) / len(self.sets[name]), min(first[s] for s in there))
        return found


def indexes(templates: Mapping[str, str]) -> Iterator[Index]:
    """Indexes of bounded size that hold all templates between them."""
    part, size = {}, 0
    for name, text in templates.items():
        n = len(normalised(text).split())
        if part and size + n > INDEX_SHINGLES:
            yield Index(part)
            part, size = {}, 0
        part[name] = text
        size += n
    if part:
        yield Index(part)


def find_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id, license, containment, word): one row per input row and template of which the whole
    text holds 0.8 of the shingles, in one piece or several; ``word`` is where the first of
    them begins.

    Null and empty texts, and texts under 5 words, match nothing. Texts of any length are
    read whole. Ids pass through; repeated rows give repeated results; templates of equal
    words are each reported; other columns are ignored; an empty table, or no templates, give
    an empty result. A template of fewer than 5 words is an error.
    """
    kind = dict(docs.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, license string, containment double, word bigint"
    texts = in_batches(docs.select(id_col, F.col(text_col).cast("string")))
    out = None
    for own in indexes(templates):
        index = docs.sparkSession.sparkContext.broadcast(own)

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, rows = batch.column(0).to_pylist(), []
                clean = [normalised(t) for t in batch.column(1).to_pylist()]
                for k, hashes in hashed_texts(clean):
                    if len(index.value.hits(hashes)):
                        found = index.value.find(clean[k].split(), hashes)
                        rows += [(ids[k], name, share, at) for name, (share, at) in found.items()]
                columns = list(zip(*rows)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.schema.field(0).type), pa.array(columns[1], pa.string()),
                     pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int64())],
                    [id_col, "license", "containment", "word"])

        part = texts.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"))
