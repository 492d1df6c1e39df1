"""All registered queries. Importing the query modules registers them."""

from __future__ import annotations

from pitchline.plans import q_build, q_cdc, q_marts, q_quality, q_semantic, q_stats  # noqa: F401
from pitchline.plans.registry import ORACLE, QUERIES  # noqa: F401
