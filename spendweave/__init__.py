"""Cross-channel advertising analytics on Spark.

``sources``    layouts of the raw feeds, CSV reading, loading, publishing
``functions``  indicators and number formats as SQL expressions
``operators``  unification, selection, ranks, shares and changes, reshapes
``plans``      marts, dashboard panels, findings, audits, the batch job
"""
