"""Metric plans: KPI queries, the semantic layer, scoring, costs, rollups."""
