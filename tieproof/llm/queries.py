"""All queries of the operators, by import."""

from tieproof.llm import (  # noqa: F401
    chat_format,
    collocations,
    decontaminate,
    mixture,
    near_copies,
    nearest,
    order_minhash,
    quality,
    secrets,
    token_count,
    toxicity,
    url_filter,
    whitening,
)
from tieproof.llm.tables import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
