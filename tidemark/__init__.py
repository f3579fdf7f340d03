"""Subscription analytics on Spark: cleaning, customer features, revenue, churn,
cohort retention, risk scores and segments as distributed DataFrame plans."""
