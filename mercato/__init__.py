"""mercato: retail medallion analytics expressed as Spark DataFrame jobs.

Layers
------
sources    raw files, layered tables and the views the checks run on
functions  reusable Column builders (metrics, time, status, casts)
operators  reusable DataFrame -> DataFrame building blocks
plans      bronze, silver and gold builds, business questions, data checks
streaming  late-event jobs on Structured Streaming
"""
