"""Control-date pipelines as set-oriented Spark jobs.

Every operator takes and returns DataFrames and covers all jobs, dependencies
and dates of its input in one plan.
"""
