"""Query plans: analytics (Q1–Q8), the batch pipeline and the registry."""
