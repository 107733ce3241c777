"""Inputs, SQL counterparts and the list of queries for the driver and the tests."""

from __future__ import annotations

from functools import cache
from importlib import import_module

from leadloom.checks.compose import Inputs
from leadloom.checks.registry import Registry

SQL_PARTS = (
    ("fixtures", "FIXTURES"), ("fixtures_layers", "LAYER_FIXTURES"), ("fixtures_platform", "PLATFORM_FIXTURES"),
    ("fixtures_sellers", "SELLER_FIXTURES"),
    ("fixtures_streams", "STREAM_FIXTURES"), ("oracle_graph", "GRAPH_FIXTURES"), ("oracle_models", "MODEL_FIXTURES"),
    ("oracle_trade", "TRADE"), ("oracle_factory", "FACTORY"), ("oracle_layers", "LAYERS"),
    ("oracle_platform", "PLATFORM"), ("oracle_sellers", "SELLERS"), ("oracle_views", "VIEWS"), ("oracle_graph", "GRAPH"), ("oracle_models", "MODELS"), ("oracle_learned", "LEARNED"),
    ("oracle_state", "STATE_FIXTURES"), ("oracle_state", "STATE"),
    ("oracle_entities", "ENTITY_FIXTURES"), ("oracle_entities", "ENTITY_SQL"), ("oracle_feeds", "FEED_FIXTURES"), ("oracle_feeds", "FEED_SQL"),
)
QUERY_PARTS = ("queries_trade", "queries_factory", "queries_layers", "queries_platform", "queries_sellers", "queries_views", "queries_graph", "queries_models", "queries_learned", "queries_state", "queries_feeds")


def fixture_inputs(spark, folder: str) -> Inputs:
    return Inputs(spark, folder, registry().pieces)


@cache
def registry() -> Registry:
    pieces: dict[str, str] = {}
    for module, name in SQL_PARTS:
        part = getattr(import_module(f"leadloom.checks.{module}"), name)
        twice = pieces.keys() & part.keys()
        if twice:
            raise ValueError(f"SQL pieces defined twice: {sorted(twice)}")
        pieces.update(part)
    made = Registry(pieces)
    for module in QUERY_PARTS:
        import_module(f"leadloom.checks.{module}").register(made)
    return made
