"""Star-schema analytics over periodic measures, expressed as Spark DataFrame operators."""

from starmill.config import StarConfig
from starmill.plans.build import build_grain, build_star
from starmill.plans.load import load_star, read_star
from starmill.plans.star import Star

__all__ = ["Star", "StarConfig", "build_grain", "build_star", "load_star", "read_star"]
