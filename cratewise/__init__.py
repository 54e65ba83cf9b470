"""Sales-volume KPI engine expressed as Spark DataFrame plans."""

from cratewise.config import BrandRules, ReportConfig
from cratewise.plans.report import ReportBundle, build_report

__all__ = ["BrandRules", "ReportBundle", "ReportConfig", "build_report"]
