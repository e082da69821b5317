"""The three linkage pipelines, end to end."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.cluster import connected_components, expand_pairs
from ..operators.evaluate import (
    cell_metrics,
    classify_pairs,
    evaluate_baseline,
    evaluate_links,
    evaluate_pairs,
    outcome_cells,
    outcome_members,
)
from ..operators.keys import STRUCTURED_KEYS, UNSTRUCTURED_KEYS, add_structured_keys, add_unstructured_keys
from ..operators.matching import (
    STRUCTURED,
    UNSTRUCTURED,
    baseline_classes,
    baseline_matches,
    similar_clusters,
    similar_pairs,
)
from ..operators.normalize import normalize_structured, normalize_unstructured
from ..rules import StopGroup
from ..session import materialize
from ..sources import store
from ..sources.sinks import write_evaluation, write_pairs
from ..sources.tables import read_metadata, read_results


def block_unstructured(products: DataFrame, stop_groups: Iterable[StopGroup]) -> DataFrame:
    """Normalised free-text products with their blocking keys."""
    return add_unstructured_keys(normalize_unstructured(products, stop_groups))


def block_structured(
    products: DataFrame, dictionary: Mapping[str, str], stop_groups: Iterable[StopGroup]
) -> DataFrame:
    """Normalised structured products with their blocking keys."""
    return add_structured_keys(normalize_structured(products, dictionary, stop_groups))


def cluster_unstructured(
    products: DataFrame, stop_groups: Iterable[StopGroup], prior: DataFrame | None = None
) -> DataFrame:
    """Clusters of free-text products: keys and comparison both use the title."""
    blocked = block_unstructured(products, stop_groups)
    return similar_clusters(blocked, UNSTRUCTURED_KEYS, "title", UNSTRUCTURED, prior)


def cluster_structured(
    products: DataFrame,
    dictionary: Mapping[str, str],
    stop_groups: Iterable[StopGroup],
    prior: DataFrame | None = None,
) -> DataFrame:
    """Clusters of structured products: keys use the title, the comparison the name."""
    blocked = block_structured(products, dictionary, stop_groups)
    return similar_clusters(blocked, STRUCTURED_KEYS, "name", STRUCTURED, prior)


def pairs_unstructured(products: DataFrame, stop_groups: Iterable[StopGroup]) -> DataFrame:
    """Scored match edges of free-text products."""
    return similar_pairs(block_unstructured(products, stop_groups), UNSTRUCTURED_KEYS, "title", UNSTRUCTURED)


def pairs_structured(
    products: DataFrame, dictionary: Mapping[str, str], stop_groups: Iterable[StopGroup]
) -> DataFrame:
    """Scored match edges of structured products."""
    blocked = block_structured(products, dictionary, stop_groups)
    return similar_pairs(blocked, STRUCTURED_KEYS, "name", STRUCTURED)


def run_and_evaluate(
    clusters: DataFrame,
    truth: DataFrame,
    products: DataFrame,
    results_path: str,
    evaluation_path: str,
    read_limit: int | None = None,
    dataset: object = None,
) -> DataFrame:
    """Write result pairs and classified pairs, return the metrics row.

    The pair files list closed pairs, as asked for by their readers; the metrics
    themselves are counted from the clusters.
    """
    spark = products.sparkSession
    write_pairs(expand_pairs(clusters), results_path, read_limit, dataset)
    found, _ = read_results(spark, results_path)
    known = expand_pairs(connected_components(truth))
    write_evaluation(classify_pairs(known, found), products, evaluation_path)
    return evaluate_pairs(truth, found)


def link_and_score(
    clusters: DataFrame, truth: DataFrame, products: DataFrame, path: str, settings: dict
) -> DataFrame:
    """Commit the outcome of a clustering at ``path`` and return its metrics row.

    The result holds every record of a known or found cluster with its product
    (``members``), and the counts per truth and found cluster (``cells``). Known pairs,
    matched pairs, true positives, false negatives and false positives all follow from
    them, see :func:`outcome_cells`; :func:`outcome_pairs` lists one kind if asked to.
    """
    spark = products.sparkSession
    members = materialize(outcome_members(connected_components(truth), clusters))
    tables = {"members": members.join(products, "id", "left"), "cells": outcome_cells(members)}
    manifest = store.commit(spark, path, tables, settings)
    return cell_metrics(store.read_table(spark, manifest, "cells"))


def link_and_score_baseline(products: DataFrame, text: str, truth: DataFrame) -> DataFrame:
    """Baseline matching and its metrics row, without listing a pair."""
    classes = baseline_classes(products, text)
    return evaluate_links(truth, materialize(classes.links), materialize(classes.members))


def results_are_current(spark: SparkSession, path: str, read_limit: int | None, dataset: object) -> bool:
    """Whether results at ``path`` were computed with these settings."""
    try:
        return read_metadata(spark, path) == {"read_limit": read_limit, "dataset": dataset}
    except AnalysisException:
        return False


def run_baseline(products: DataFrame, text: str, truth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Baseline matches and their metrics."""
    matches = baseline_matches(products, text)
    return matches, evaluate_baseline(truth, matches)
