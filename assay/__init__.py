"""Data quality for large tables and streams, written as Spark jobs.

Layout
    sources    reading tables, rule files and histories; writing results and alerts
    functions  column expressions: validators, null policies, guarded statistics
    operators  profiling, checks, expectations, rules, identity fraud, monitoring, trends
    plans      plan shapes shared by operators: skew-safe joins, graph components, lineage
    streaming  Structured Streaming jobs for metrics and for rule validation
"""
