"""All registered queries and their SQL oracles (importing the modules fills the registry)."""

from . import q_dialogue, q_io, q_json, q_prompts, q_score, q_sft, q_sheets, q_split, q_tokens  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
