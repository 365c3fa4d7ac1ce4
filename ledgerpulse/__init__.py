"""Account-churn analytics and intent monitoring on Spark DataFrames."""
