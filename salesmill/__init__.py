"""Sales warehouse on Spark: staging, type-1 dimensions, an order-line fact, checks and KPI reports."""
