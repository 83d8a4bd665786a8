"""All registered queries; importing the package fills the registry."""

from riskmart.plans.queries import cleaning, featuring, kpi, profiling, sketched, staged, storing, streams, thresholds
from riskmart.plans.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "featuring", "kpi", "profiling", "sketched", "staged", "storing", "streams", "thresholds"]
