"""Product analytics and experiment statistics as Spark jobs.

Every public function takes DataFrames and returns a DataFrame. User-level rows
stay on the executors; only sufficient statistics (one row per group and metric)
reach the closed-form formulas.
"""
