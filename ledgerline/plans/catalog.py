"""All registered queries; importing a module of queries registers them."""

from . import audit_queries, entity_queries, evidence_queries, hit_queries, promotion_queries, record_queries, retrieval_queries, scalar_queries  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
