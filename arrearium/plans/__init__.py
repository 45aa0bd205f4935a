"""Portfolio tables and KPIs."""
