"""Hash predicates: samples, shards, folds, holdouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _crc(c: Column | str, salt: str = "") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.crc32(F.concat(F.lit(salt), c).cast("binary"))


def in_sample(c: Column | str, percent: float) -> Column:
    return _crc(c) % 10_000 < percent * 100


def in_train_fraction(c: Column | str, fraction: float) -> Column:
    return F.lit(True) if fraction >= 1 else _crc(c, "trainfrac|") % 1000 < fraction * 1000


def in_shard(c: Column | str, shard: int, shards: int) -> Column:
    return _crc(c, "shard|") % shards == shard


def fold_of(c: Column | str, folds: int) -> Column:
    return (_crc(c) % folds).cast("int")


def is_holdout(c: Column | str) -> Column:
    return _crc(c) % 5 == 0


def tuning_half(c: Column | str) -> Column:
    return (_crc(c, "h") % 2).cast("int")


def sample_closure(entities: DataFrame, linked: DataFrame, percent: float, is_s1: bool) -> DataFrame:
    """Sampled rows; of the other sources also those linked to a sampled one."""
    if is_s1:
        return entities.where(in_sample("entity_id", percent))
    marked = entities.join(linked.select("entity_id", F.lit(True).alias("_linked")).distinct(), "entity_id", "left")
    return marked.where(F.coalesce("_linked", F.lit(False)) | in_sample("entity_id", percent)).drop("_linked")
