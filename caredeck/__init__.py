"""Customer-care analytics on Spark: lifecycle, billing and complaint features,
risk scoring and routing, rollups, risk ranking, and knowledge-base retrieval."""
