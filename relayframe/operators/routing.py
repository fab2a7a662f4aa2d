"""Ordered regex routes: the first match wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Routes = Sequence[tuple[str, str]]


def _first_match(name: Column, routes: Routes, default: Column) -> Column:
    if not routes:
        return default
    routed = None
    for pattern, target in routes:
        branch = F.when if routed is None else routed.when
        routed = branch(name.rlike(pattern), F.lit(target))
    return routed.otherwise(default)


def route_table(topic: Column, routes: Routes = ()) -> Column:
    """Target table of a topic; a topic no route matches goes to the table of its own name."""
    return _first_match(topic, routes, topic)


def route_topic(relation: Column, routes: Routes = (), prefix: str = "") -> Column:
    """Topic of a relation, under an optional prefix that a target may already carry."""
    dotted = f"{prefix}." if prefix else ""
    targets = [(pattern, dotted + target.removeprefix(dotted)) for pattern, target in routes]
    return _first_match(relation, targets, F.concat(F.lit(dotted), relation))
