"""Importing this module registers all queries of the folder."""

from __future__ import annotations

from epiloom.llm import (  # noqa: F401
    collocations_queries,
    decontaminate_queries,
    hyperminhash_queries,
    maintext_queries,
    mixing_queries,
    packing_queries,
    quality_queries,
    secrets_queries,
    spelling_queries,
    spotsigs_queries,
    toxicity_queries,
    url_queries,
    warc_queries,
)
from epiloom.llm.registry import ORACLES, PLANS

__all__ = ["ORACLES", "PLANS"]
