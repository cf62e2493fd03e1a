"""All queries of this subpackage."""

from runlens.llm import anchors, decontaminate, maxent, merkle, neardup, packing, pii, quality, secrets, suffixdedup, toxicity, warc, zonemaps
from runlens.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "anchors", "decontaminate", "maxent", "merkle", "neardup", "packing", "pii", "quality", "secrets", "suffixdedup", "toxicity", "warc", "zonemaps"]
