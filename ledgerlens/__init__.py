"""ledgerlens: payments warehouse analytics (KPI marts, analysis queries,
data-quality checks, churn features, labels, models and outreach lists)
expressed as Spark DataFrame / SQL plans."""

__all__ = ["session", "sources", "functions", "operators", "plans"]
