"""Named queries over the given tables, one per operator, with equivalent SQL where SQL can
say it on whole tables."""

from . import (  # noqa: F401
    catalog_queries, export_queries, extraction_queries, match_queries, offer_queries, order_queries,
    summary_queries, text_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401
