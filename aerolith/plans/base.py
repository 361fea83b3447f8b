"""Shared lazy inputs of the registered queries (all derived from the driver tables)."""

from __future__ import annotations

from aerolith.operators import features
from aerolith.sources import fixtures as fx


def air(spark, sf_dir):
    return fx.air(spark, sf_dir)


def weather(spark, sf_dir):
    return fx.weather(spark, sf_dir)


def air_clean(spark, sf_dir):
    return features.clean_readings(fx.air(spark, sf_dir))


def merged(spark, sf_dir):
    return features.merge_clean(*fx.landed(spark, sf_dir))


def feature_table(spark, sf_dir, strategy="auto", before=None):
    return features.build_features(*fx.landed(spark, sf_dir, before), strategy=strategy)
