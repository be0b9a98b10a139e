"""Helpers the operators share: table reads, lineage cuts, word patterns."""

from __future__ import annotations

import uuid
from itertools import chain, islice

from pyspark.sql import DataFrame, SparkSession

from panelmart.session import ensure_checkpoint_dir

# ASCII white space, the separators of every word contract: \x20 and \x09-\x0D
# (exactly what ``bytes.split()`` splits on).
SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared folder (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and reread it.

    Cuts the lineage: a lost executor costs a re-read of the files, never a
    recomputation of the plan above them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Memo:
    """Values of frequent keys in two generations of at most ``size`` entries each.

    A full generation becomes the old one; what is still asked for moves over, the
    rest is forgotten, so memory stays bounded for any vocabulary.
    """

    def __init__(self, size: int):
        self.size, self.now, self.old = size, {}, {}

    def early(self, size: int) -> dict:
        """``size`` entries, those asked for first in each generation: frequent keys come early."""
        return dict(islice(chain(self.now.items(), ((k, v) for k, v in self.old.items() if k not in self.now)), size))

    def missing(self, keys: list) -> list:
        """Keys (once each) without a value; afterwards all others are in ``now``."""
        absent = set(keys).difference(self.now)
        if absent and len(self.now) + len(absent) > self.size:
            self.old, self.now, absent = self.now, {}, set(keys)
        out = []
        for key in absent:
            value = self.old.get(key)
            if value is None:
                out.append(key)
            else:
                self.now[key] = value
        return out


def once_per_worker(key: str, build):
    """``build()``, once in a Python worker process, for all tasks it runs.

    Compiled vocabularies and memos outlive a task this way.  They are held by an
    importable module, since the functions of this package travel by value.
    """
    import pyspark

    held = pyspark.__dict__.setdefault("_panelmart_worker", {})
    if key not in held:
        held[key] = build()
    return held[key]
