"""Registered queries over the given tables, each with its SQL counterpart."""

from textforge.catalog.registry import ORACLES, QUERIES


def load() -> tuple[dict, dict]:
    from textforge.catalog import (  # noqa: F401
        q_batches, q_examples, q_holdout, q_io, q_markup, q_metrics, q_runlog, q_tokens, q_vectors)

    return QUERIES, ORACLES
