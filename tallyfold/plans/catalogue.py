"""All named queries; importing this module registers them."""

from tallyfold.plans import (  # noqa: F401
    assess_queries,
    decision_queries,
    feature_queries,
    model_queries,
    relational_queries,
    series_text_queries,
    stats_queries,
    synth_queries,
)
from tallyfold.plans.registry import REGISTRY  # noqa: F401
