"""Subscription analytics on Spark: cleaning, recurring revenue, churn, retention and customer value."""
