"""Larder: analytics over a weekly changing menu catalogue, written as plain Spark jobs.

Layers
------
``sources``    landed pages, published Parquet tables, the star-schema fixture mapping
``functions``  Column helpers (calendar, text, ranking)
``operators``  bronze, flatten, keyed merge, version history, gold metrics
``plans``      the table catalogue, report datasets, rebuild/append pipelines
``library``    the ad-hoc query library
``streaming``  the incremental load as a Structured Streaming job
"""

__version__ = "0.1.0"
