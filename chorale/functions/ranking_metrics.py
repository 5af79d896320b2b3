"""Ranking metrics of one user, as SQL expressions.

They read the column ``hits``, the ascending positions (from 1) at which relevant
items were ranked, and ``n_relevant``, the number of the user's relevant items. A
user with no relevant item scores 0. Text takes one call where building the same
from column objects takes hundreds.
"""

from __future__ import annotations


def hits_within(k: int) -> str:
    return f"filter(hits, pos -> pos <= {k})"


def _sum(values: str) -> str:
    return f"aggregate({values}, 0D, (total, value) -> total + value)"


def _gains(positions: str) -> str:
    return f"transform({positions}, pos -> 1D / ln(pos + 1D))"


def _or_zero(value: str) -> str:
    return f"CASE WHEN n_relevant > 0 THEN {value} ELSE 0D END"


def precision_at(k: int) -> str:
    """Hits in the first k places over k, also where the list is shorter than k."""
    return f"size({hits_within(k)}) / {k}D"


def recall_at(k: int) -> str:
    """Hits in the first k places over the number of relevant items."""
    return _or_zero(f"size({hits_within(k)}) / n_relevant")


def average_precision_at(k: int) -> str:
    """Sum over hits of (hits so far / position), over min(relevant, k)."""
    shares = f"transform({hits_within(k)}, (pos, i) -> (i + 1D) / pos)"
    return _or_zero(f"{_sum(shares)} / least(n_relevant, {k})")


def ndcg_at(k: int) -> str:
    """Binary gain 1 / ln(position + 1) over that of min(relevant, k) hits at the top."""
    best = f"sequence(1, CAST(least(n_relevant, {k}) AS INT))"
    return _or_zero(f"{_sum(_gains(hits_within(k)))} / {_sum(_gains(best))}")


def metrics_at(k: int) -> str:
    """All of them as one struct."""
    named = {
        "map": average_precision_at(k),
        "precision": precision_at(k),
        "ndcg": ndcg_at(k),
        "recall": recall_at(k),
    }
    fields = ", ".join(f"{value} AS `{name}`" for name, value in named.items())
    return f"struct({k} AS k, {fields})"


def auc() -> str:
    """Share of (relevant, other) item pairs in the right order, from the rank sum.

    Reads ``n_ranked`` relevant items with places of ``position_sum`` in all, among
    ``n_items``. Every relevant item beats the items below it, less the relevant
    ones among them. Null where the ranking holds no relevant item or nothing else.
    """
    misordered = "(position_sum - n_ranked * (n_ranked + 1) / 2)"
    pairs = "(n_ranked * (n_items - n_ranked))"
    return f"CASE WHEN {pairs} > 0 THEN 1D - {misordered} / {pairs} END"


def reciprocal_rank() -> str:
    """One over ``first_position``."""
    return "1D / first_position"
