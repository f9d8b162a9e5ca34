"""All registered queries by name."""

from __future__ import annotations

from tsengine.queries import evaluation, features, ingest, models, streams

MODULES = (features, ingest, evaluation, models, streams)


def flagship(spark, sf_dir):
    return features.hourly_event_features(spark, sf_dir)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
