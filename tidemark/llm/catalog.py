"""All registered queries of the subpackage."""

from tidemark.llm import chat, collocations, decontaminate, embeddings, html_text, language, lexical, ngram_join, packing, quality, secrets, tokenfile, toxicity  # noqa: F401  (registration)
from tidemark.llm.queries import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
