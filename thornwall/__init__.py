"""Vulnerability and security-telemetry tables on Spark."""

from thornwall.plans.medallion import Medallion

__all__ = ["Medallion"]
