"""riskmart: transaction-risk analytics as lazily planned Spark DataFrame operators."""

from riskmart.config import Layout, RiskConfig

__all__ = ["Layout", "RiskConfig"]
