"""Recurring, incremental data extracts as Spark jobs.

``functions``  Column -> Column rules (codes, dates, text, fingerprints)
``operators``  DataFrame -> DataFrame building blocks (joins, latest row, upsert, rules)
``sources``    reading and writing tables, snapshots and extract files
``plans``      the four extracts, composed from the layers above
``queries``    the same building blocks on the benchmark tables
"""
