"""Named queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from . import (embedding_dedup, line_dedup, mixing, ngram_join, packing, periodic_runs,  # noqa: F401
               secret_ledger, sharding, substring_dedup, token_counts, topk, toxicity, whitening)
from .common import ORACLES, QUERIES  # noqa: F401
