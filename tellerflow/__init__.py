"""Bank-churn data pipeline: cleaning, change data, publishing and churn reports on Spark."""
