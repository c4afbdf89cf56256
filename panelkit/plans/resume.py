"""Stages that go on from what an earlier run finished.

Every stage has a fingerprint: the files of the inputs (names, sizes, times), the version that
the caller gives, the stage's parameters and the fingerprints of the stages before it. It is
stored with the stage's table or model. A run with the same fingerprint reads that back instead
of computing it; any other runs the stage again, and those after it.

A table and its fingerprint appear at once, by rename (:mod:`panelkit.sources.publish`). A model
loses its fingerprint before it is written and gets one when it is whole. A run that dies at
any moment leaves stages that are finished or count as not begun.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import ml as ML
from panelkit.sources import publish as PB


def files_of(spark: SparkSession, path: str) -> list[int]:
    """How many files a table has, their bytes, and a checksum of names, bytes and times. Spark
    lists them; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    mark = F.xxhash64("path", "length", "modificationTime")
    row = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(mark), F.sum(mark % F.lit(1 << 31))).first()
    return [int(x or 0) for x in row]


class Resumable:
    """The stages of one run, kept in ``folder``, which must be shared by the cluster.

    ``inputs`` are the paths of all tables that the stages read. ``version`` stands for what
    files do not tell: give another when the code that derives the frames changes.
    """

    def __init__(self, spark: SparkSession, folder: str, inputs: Sequence[str], version: str = ""):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._before: list = [version, [[p, files_of(spark, p)] for p in inputs]]
        #: Names of the stages that this run computed, and of those that it found finished.
        self.computed: list[str] = []
        self.found: list[str] = []

    def _fingerprint(self, name: str, params: dict) -> str:
        text = json.dumps([self._before, name, params], sort_keys=True)
        mark = hashlib.sha256(text.encode()).hexdigest()
        self._before = [self._before, mark]
        return mark

    def _is_finished(self, name: str, path: str, mark: str) -> bool:
        done = (PB.manifest(self.spark, path) or {}).get("fingerprint") == mark
        (self.found if done else self.computed).append(name)
        return done

    def table(self, name: str, build: Callable[[], DataFrame], **params) -> DataFrame:
        """The table of a stage. ``params`` are JSON values and tell all that ``build`` depends on."""
        path, mark = f"{self.folder}/{name}", self._fingerprint(name, params)
        PB.recover(self.spark, path)
        if not self._is_finished(name, path, mark):
            PB.publish(build(), path, notes={"fingerprint": mark})
        return self.spark.read.parquet(path)

    def model(self, name: str, fit: Callable[[], ML.FittedModel], **params) -> ML.FittedModel:
        """The fitted model of a stage, likewise."""
        path, mark = f"{self.folder}/{name}", self._fingerprint(name, params)
        if self._is_finished(name, path, mark):
            return ML.FittedModel.load(self.spark, path)
        model = fit()
        PB.drop_manifest(self.spark, path)
        model.save(path)
        PB.write_manifest(self.spark, path, {"fingerprint": mark})
        return model
